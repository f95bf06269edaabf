"""Vectorised 64-bit hashes of words and byte strings (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from screenwell.llm.store import worker_state

BASE = np.uint64(0x9E3779B97F4A7C15)
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit integers, another one for each ``salt``."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((salt * 0xD1B54A32D192ED03 + 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE ** i`` and its inverse modulo 2**64 for i up to ``n``; kept by the worker."""
    state = worker_state()
    if "powers" not in state or len(state["powers"][0]) <= n:
        size = max(n + 1, 1 << 16)
        up, down = np.full(size, BASE), np.full(size, np.uint64(pow(int(BASE), -1, 2**64)))
        up[0] = down[0] = 1
        with np.errstate(over="ignore"):
            state["powers"] = np.cumprod(up), np.cumprod(down)
    return state["powers"]


def prefix(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums: the hash of data[i:j] follows from entries i and j."""
    up, _ = powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=out[1:])
    return out


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end] from ``prefix``; equal bytes give equal hashes anywhere."""
    _, down = powers(len(sums))
    return mix((sums[end] - sums[start]) * down[start], 1) ^ mix((end - start).astype(np.uint64), 2)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word of ``texts``, in order, the number of words before each text, and where
    each word starts in the texts joined by one byte.

    Words are runs without bytes 9 to 13 and 32.
    """
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    gap = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.concatenate([[False], ~gap])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return spans(prefix(data), start, end), np.searchsorted(start, bounds), start


def parts(texts: list, limit: int = 1 << 19) -> Iterator[list]:
    """Consecutive runs of ``texts`` of about ``limit`` bytes or one text."""
    held, size = [], 0
    for value in texts:
        if held and size + len(value) > limit:
            yield held
            held, size = [], 0
        held.append(value)
        size += len(value)
    if held:
        yield held

"""Quality scores by attention over passages, learnt from document labels."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.hashing import LOWER, mix, parts, words_of
from screenwell.llm.language import held_out
from screenwell.llm.store import Scratch

PASSAGE = 512
HASHED = 64
#: Byte classes: control, lower, upper, digit, space, line break, sentence marks, commas, exclamation
#: and question marks, bars, signs, quotes and brackets, dashes and underscores, other, above ASCII.
CLASSES = ["", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r",
           ".:;", ",", "!?", "|", "#$%&*+=@^~\\", "\"'`()[]{}<>", "-_/"]
KINDS = len(CLASSES) + 2
KIND = np.full(256, len(CLASSES), np.uint8)
KIND[:32], KIND[128:] = 0, len(CLASSES) + 1
for _number, _letters in enumerate(CLASSES[1:], 1):
    KIND[list(_letters.encode())] = _number
WIDTH = KINDS + KINDS * KINDS + HASHED + 4


def encode(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A vector for every passage (512 bytes) of ``texts`` and the number of passages before each.

    Shares of byte classes and of pairs of classes, hashed pairs of letters, mean word length, the
    share of words seen before in the passage and before in the text, and the passage's fill.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    count = -(-sizes // PASSAGE)
    first = np.concatenate([[0], np.cumsum(count)])
    total = int(first[-1])
    if not total:
        return np.zeros((0, WIDTH), np.float32), first
    data = np.frombuffer(b"".join(texts), np.uint8)
    start = np.concatenate([[0], np.cumsum(sizes)])
    owner = np.repeat(np.arange(len(texts)), sizes)
    passage = first[owner] + (np.arange(len(data)) - start[owner]) // PASSAGE
    size = np.bincount(passage, minlength=total).astype(np.float64)[:, None]
    kind = KIND[data].astype(np.int64)
    one = np.bincount(passage * KINDS + kind, minlength=total * KINDS).reshape(total, KINDS)
    same = passage[1:] == passage[:-1]
    pair = (kind[:-1] * KINDS + kind[1:])[same]
    two = np.bincount(passage[1:][same] * KINDS**2 + pair, minlength=total * KINDS**2).reshape(total, -1)
    low = np.frombuffer(LOWER, np.uint8)[data].astype(np.uint32)
    bucket = ((low[:-1] * np.uint32(257) + low[1:]) * np.uint32(2654435761)) >> np.uint32(26)
    grams = np.bincount(passage[1:][same] * HASHED + bucket[same].astype(np.int64),
                        minlength=total * HASHED).reshape(total, -1)
    words, before, at = words_of(texts)
    owner_of_word = np.repeat(np.arange(len(texts)), np.diff(before))
    near = first[owner_of_word] + (at - start[owner_of_word] - owner_of_word) // PASSAGE
    near = np.minimum(near, total - 1)
    n_words = np.maximum(np.bincount(near, minlength=total), 1)
    def old(group: np.ndarray) -> np.ndarray:
        _, seen = np.unique(words ^ mix(group.astype(np.uint64), 5), return_index=True)
        return 1 - np.bincount(near[seen], minlength=total) / n_words
    extra = np.stack([size[:, 0] / n_words / 10, old(near), old(owner_of_word),
                      size[:, 0] / PASSAGE], axis=1)
    return np.concatenate([one / size, two / size, grams / size, extra], axis=1).astype(np.float32), first


def shapes(hidden: int, attention: int) -> dict[str, tuple[int, ...]]:
    return {"W": (WIDTH, hidden), "b": (hidden,), "V": (hidden, attention), "U": (hidden, attention),
            "w": (attention,), "c": (hidden,), "d": (1,)}


def split(params: np.ndarray, hidden: int, attention: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in shapes(hidden, attention).items():
        size = int(np.prod(shape))
        out[name] = params[at: at + size].reshape(shape)
        at += size
    return out


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of consecutive rows; empty runs give 0."""
    run = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, axis=0, dtype=np.float64)])
    return run[first[1:]] - run[first[:-1]]


def forward(x: np.ndarray, first: np.ndarray, p: dict) -> dict:
    """Gated attention: passages h, their weights a in each document, the weighted passage z."""
    h = np.tanh(x @ p["W"] + p["b"])
    t, g = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-h @ p["U"]))
    raw = np.exp(np.clip((t * g) @ p["w"], -15, 15))
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    a = raw / np.maximum(sums(raw, first), 1e-30)[owner]
    z = sums(a[:, None] * h, first)
    return {"h": h, "t": t, "g": g, "a": a, "z": z, "owner": owner,
            "score": 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["d"], -30, 30)))}


def gradient(x: np.ndarray, first: np.ndarray, y: np.ndarray, p: dict) -> np.ndarray:
    """Of the mean log loss over documents."""
    f = forward(x, first, p)
    e = (f["score"] - y) / len(y)
    dz = np.outer(e, p["c"])[f["owner"]]
    da = (dz * f["h"]).sum(axis=1)
    ds = f["a"] * (da - sums(f["a"] * da, first)[f["owner"]])
    dt = ds[:, None] * p["w"] * f["g"] * (1 - f["t"] ** 2)
    dg = ds[:, None] * p["w"] * f["t"] * f["g"] * (1 - f["g"])
    dh = f["a"][:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
    du = dh * (1 - f["h"] ** 2)
    parts = [x.T @ du, du.sum(axis=0), f["h"].T @ dt, f["h"].T @ dg,
             ds @ (f["t"] * f["g"]), f["z"].T @ e, np.array([e.sum()])]
    return np.concatenate([np.ravel(v) for v in parts])


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """Rows (y, text) of about ``max_rows`` labelled documents, chosen by a hash of their id."""
    known = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(modulus=5, rest=0))
             .groupBy("doc_id").agg(F.max("quality").cast("double").alias("y")))
    share = max_rows / max(1, known.count())
    spread = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(23)), F.lit(1_000_000)) / 1_000_000
    return known.where(spread < share).join(docs.select("doc_id", "text"), "doc_id").select("y", "text")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 6000, rounds: int = 5, epochs: int = 6,
        hidden: int = 24, attention: int = 12, rate: float = 0.01) -> dict:
    """Fit the model on a bounded sample of labelled documents outside the held-out fold.

    In each round every task takes ``epochs`` passes of Adam over its own documents, beginning from
    the shared parameters; the driver averages the results, weighted by documents. Without any label
    the model scores 0.5 everywhere.
    """
    scratch = Scratch(docs.sparkSession)

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, first = encode([(t or "").encode("utf-8", "replace") for t in batch["text"]])
            yield pd.DataFrame({"y": batch["y"], "n": np.diff(first),
                                "x": [x[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]})

    rows = scratch.cut(training_rows(docs, labels, max_rows).mapInPandas(
        features, "y double, n long, x binary").repartition(4, F.xxhash64("x")))
    size = sum(int(np.prod(s)) for s in shapes(hidden, attention).values())
    params = np.random.default_rng(3).normal(0, 0.1, size).astype(np.float32)

    def load(batches: Iterator[pd.DataFrame]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        frame = pd.concat([pd.DataFrame({"y": [], "n": [], "x": []}), *batches])
        x = np.frombuffer(b"".join(frame["x"]), np.float32).reshape(-1, WIDTH)
        return x, frame["n"].to_numpy(np.int64), frame["y"].to_numpy(float)

    def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        x, _, _ = load(batches)
        own = np.stack([x.sum(axis=0, dtype=float), (x.astype(float) ** 2).sum(axis=0)])
        yield pd.DataFrame({"n": [len(x)], "v": [own.tobytes()]})

    found = [(r.n, np.frombuffer(r.v).reshape(2, WIDTH)) for r in
             rows.mapInPandas(moments, "n long, v binary").collect()]
    total = sum(n for n, _ in found)
    if not total:
        scratch.delete()
        return {"params": np.zeros(size, np.float32), "mean": np.zeros(WIDTH, np.float32),
                "spread": np.ones(WIDTH, np.float32), "hidden": hidden, "attention": attention}
    mean, square = sum(v for _, v in found) / total
    spread = np.sqrt(np.maximum(square - mean**2, 0)) + 1e-3
    mean, spread = mean.astype(np.float32), spread.astype(np.float32)

    def local(start: np.ndarray, seed: int):
        def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            x, n, y = load(batches)
            x = (x - mean) / spread
            first = np.concatenate([[0], np.cumsum(n)])
            own, m, v, step = start.astype(float), np.zeros(size), np.zeros(size), 0
            random = np.random.default_rng(seed)
            for _ in range(epochs):
                for pick in np.array_split(random.permutation(len(y)), max(1, len(y) // 64)):
                    if not len(pick):
                        continue
                    take = np.concatenate([np.arange(first[i], first[i + 1]) for i in pick])
                    bounds = np.concatenate([[0], np.cumsum(n[pick])])
                    g = gradient(x[take], bounds, y[pick], split(own, hidden, attention)) + 1e-5 * own
                    step += 1
                    m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
                    own = own - rate * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            yield pd.DataFrame({"n": [len(y)], "p": [own.tobytes()]})
        return train

    for k in range(rounds):
        got = rows.mapInPandas(local(params, k), "n long, p binary").collect()
        params = (sum(r.n * np.frombuffer(r.p) for r in got) / sum(r.n for r in got)).astype(np.float32)
    scratch.delete()
    return {"params": params, "mean": mean, "spread": spread, "hidden": hidden, "attention": attention}


def score(docs: DataFrame, model: dict, text: str = "text") -> DataFrame:
    """(doc_id, held_out, score) of every row from its whole text; null and empty texts have no
    passage and get the model's base score; repeated rows stay; other columns are not read."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = split(model["params"], model["hidden"], model["attention"])
        for batch in batches:
            values = []
            for part in parts([(t or "").encode("utf-8", "replace") for t in batch["t"]]):
                x, first = encode(part)
                values.append(forward((x - model["mean"]) / model["spread"], first, p)["score"])
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"],
                                "score": np.concatenate(values) if values else []})

    rows = docs.select("doc_id", held_out(modulus=5, rest=0).alias("held_out"), F.col(text).alias("t"))
    return rows.mapInPandas(run, "doc_id long, held_out boolean, score double")

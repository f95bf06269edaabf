"""Removal of byte strings that occur twice in a corpus: sampled anchors, sharded suffix arrays."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.hashing import prefix, spans
from screenwell.llm.store import Scratch, small
from screenwell.llm.suffixes import repeated

SIZE, GRAM = 200, 32
PLACE = np.uint64((1 << 24) - 1)
PIECE = 1 << 22
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def lows(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values."""
    n = len(values) - width + 1
    whole = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    whole[: len(values)] = values
    table = whole.reshape(-1, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1: width - 1 + n])


def anchors(data: np.ndarray, size: int = SIZE, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Start, length, anchor hash and content hash of stretches that cover one text.

    Each string of ``size`` bytes has an anchor, the smallest hash of its grams, the same wherever
    the string stands. Neighbouring strings with the same anchor are one stretch, so every string of
    the text starts in exactly one stretch and lies in it as a whole.
    """
    width = size - gram + 1
    out: list[list[np.ndarray]] = [[], [], [], []]
    for begin in range(0, len(data) - size + 1, PIECE):
        part = data[begin: begin + PIECE + size - 1]
        sums = prefix(part)
        gram_at = np.arange(len(part) - gram + 1)
        h = spans(sums, gram_at, gram_at + gram)
        ranked = (h & ~PLACE) | gram_at.astype(np.uint64)
        chosen = (lows(ranked, width) & PLACE).astype(np.int64)
        chosen = thinned(chosen, h, width)
        first = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
        length = np.diff(np.concatenate([first, [len(chosen)]])) + size - 1
        for held, own in zip(out, (first + begin, length, h[chosen[first]], spans(sums, first, first + length)), strict=True):
            held.append(own)
    return tuple(np.concatenate(x) if x else np.zeros(0, np.int64) for x in out)


def thinned(chosen: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
    """Fewer anchors where neighbours have the same hash (periodic text): ``chosen`` holds the anchor
    of each window, and some move to another one of equal hash in the same window."""
    at = chosen[np.concatenate([[True], chosen[1:] != chosen[:-1]])]
    if len(at) < 3:
        return chosen
    own = h[at]
    inner = np.zeros(len(at), bool)
    inner[1:-1] = (own[1:-1] == own[:-2]) & (own[1:-1] == own[2:]) & (at[2:] - at[:-2] <= width)
    if not inner.any():
        return chosen
    keep, last = np.ones(len(at), bool), at[0]
    for i in range(1, len(at) - 1):
        if inner[i] and at[i + 1] - last <= width:
            keep[i] = False
        else:
            last = at[i]
    kept = at[keep]
    k = np.searchsorted(kept, chosen, side="right") - 1
    lower, upper = kept[k], kept[np.minimum(k + 1, len(kept) - 1)]
    return np.where((lower == chosen) | (lower >= np.arange(len(chosen))), lower, upper)


def all_anchors(docs: DataFrame) -> DataFrame:
    """(tk, pos, n, h, c) of every row's stretches; ``tk`` identifies its text."""
    def run(batches):
        import pyarrow as pa

        kinds = (np.int64, np.int64, np.uint64, np.uint64)
        for batch in batches:
            found = [anchors(np.frombuffer((x or "").encode(), np.uint8)) for x in batch.column(1).to_pylist()]
            keys = np.repeat(batch.column(0).to_numpy(), np.array([len(f[0]) for f in found], np.int64))
            flat = [np.concatenate([f[k].astype(kind) for f in found]) if found else np.zeros(0, kind)
                    for k, kind in enumerate(kinds)]
            for i in range(0, len(keys), 1 << 18):
                cut = slice(i, i + (1 << 18))
                yield pa.RecordBatch.from_arrays([pa.array(keys[cut]), *(pa.array(x[cut].view(np.int64)) for x in flat)],
                                                 ["tk", "pos", "n", "h", "c"])

    rows = docs.where(F.octet_length("text") >= SIZE).select(text_key().alias("tk"), "text")
    return rows.mapInArrow(run, "tk long, pos long, n long, h long, c long")


def text_key():
    return F.xxhash64(F.octet_length("text"), F.col("text"))


def contents(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(h, c, body): the bytes of one place (tk, pos, n) of each wanted (h, c)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, places in zip(batch["text"], batch["places"], strict=True):
                data = text.encode()
                out += [(p["h"], p["c"], data[p["pos"]: p["pos"] + p["n"]]) for p in places]
            yield pd.DataFrame(out, columns=["h", "c", "body"])

    by_text = wanted.groupBy("tk").agg(F.collect_list(F.struct("h", "c", "pos", "n")).alias("places"))
    texts = docs.where(F.octet_length("text") >= SIZE).select(text_key().alias("tk"), "text")
    texts = texts.join(small(wanted.select("tk").distinct(), 500_000), "tk", "left_semi").dropDuplicates(["tk"])
    return texts.join(by_text, "tk").select("text", "places").mapInPandas(run, "h long, c long, body binary")


def in_shards(found: DataFrame, shard_bytes: int) -> DataFrame:
    """(h, c, low, high): repeated runs in the stretches, from a suffix array of each shard. All
    stretches of an anchor are in one shard, and equal strings have the same anchor."""
    total = found.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    shards = int(total // shard_bytes) + 1

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["h", "c"])
        h, c = group["h"].to_numpy(), group["c"].to_numpy()
        runs = repeated(group["body"].tolist(), SIZE)
        return pd.DataFrame([(h[i], c[i], a, b) for i, a, b in runs], columns=["h", "c", "low", "high"])

    return (found.withColumn("shard", F.pmod(F.xxhash64("h"), F.lit(shards))).groupBy("shard")
            .applyInPandas(run, "h long, c long, low long, high long"))


def by_window(found: DataFrame) -> DataFrame:
    """The same for anchors with very many stretches: each string in them is counted by its hash, so
    that no task meets all stretches of one anchor."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            h, c, body = (batch.column(k).to_pylist() for k in range(3))
            for i in range(len(h)):
                data = np.frombuffer(body[i], np.uint8)
                start = np.arange(len(data) - SIZE + 1)
                w = spans(prefix(data), start, start + SIZE)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(w), h[i])), pa.array(np.full(len(w), c[i])),
                                                  pa.array(start), pa.array(w.view(np.int64))], ["h", "c", "low", "w"])

    rows = found.mapInArrow(run, "h long, c long, low long, w long")
    twice = rows.groupBy("h", "w").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("h", "w")
    return rows.join(twice, ["h", "w"]).select("h", "c", "low", (F.col("low") + SIZE).alias("high"))


def repeated_spans(docs: DataFrame, scratch: Scratch, shard_bytes: int = 1 << 20, many: int = 4096) -> DataFrame:
    """(tk, low, high): spans of the texts that are covered by repeated strings."""
    found = all_anchors(docs)
    twice = (found.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("c").alias("a"), F.max("c").alias("b"))
             .where("k > 1").select("h", (F.col("a") < F.col("b")).alias("mixed")))
    here = scratch.cut(found.join(twice, "h").groupBy("tk", "pos", "n", "h", "c", "mixed").agg(F.count(F.lit(1)).alias("k")))
    mixed = here.where("mixed")
    kinds = scratch.cut(mixed.groupBy("h", "c").agg(
        F.sum("k").alias("k"), F.min("tk").alias("tk"), F.min_by("pos", "tk").alias("pos"), F.min("n").alias("n")))
    bodies = scratch.cut(contents(docs, kinds))
    crowded = scratch.cut(kinds.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).where(F.col("kinds") > many).select("h"))
    marks = in_shards(bodies.join(small(crowded), "h", "left_anti"), shard_bytes)
    if not crowded.isEmpty():
        marks = marks.unionByName(by_window(bodies.join(small(crowded), "h")))
    whole = kinds.where("k > 1").select("h", "c", F.lit(0).cast("long").alias("low"), F.col("n").alias("high"))
    marks = scratch.cut(marks.unionByName(whole).groupBy("h", "c").agg(F.collect_set(F.struct("low", "high")).alias("runs")))
    some = mixed.join(marks, ["h", "c"]).select("tk", "pos", F.explode("runs").alias("run")).select(
        "tk", (F.col("pos") + F.col("run.low")).alias("low"), (F.col("pos") + F.col("run.high")).alias("high"))
    return some.union(here.where("not mixed").select("tk", F.col("pos").alias("low"), (F.col("pos") + F.col("n")).alias("high")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row: every byte covered by a 200-byte
    string that also starts elsewhere in the corpus is removed.

    Texts are UTF-8 bytes and strings are judged on the input. Anchors sampled from the content bring
    all places of a string to one hash; anchors met once are dropped. Stretches of an anchor that are
    equal as a whole are one with a weight. The different ones of the remaining anchors are sorted in
    shards by induced sorting, and runs come from the permuted common prefixes.

    Null and empty texts have 0 bytes; texts under 200 bytes lose nothing; copies lose all of 200 or
    more bytes; a null doc_id stays; other columns are not read; an empty table gives an empty one.
    """
    scratch = Scratch(docs.sparkSession)
    found = repeated_spans(docs, scratch)
    by_text = scratch.cut(found.groupBy("tk").agg(F.collect_list(F.struct("low", "high")).alias("runs")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for key, text, runs in zip(batch["doc_id"], batch["text"], batch["runs"], strict=True):
                data = (text or "").encode()
                spans_, last = [], -1
                for low, high in sorted((r["low"], r["high"]) for r in (runs if runs is not None else [])):
                    if low <= last:
                        last = max(last, high)
                        spans_[-1][1] = last
                    else:
                        spans_.append([low, high])
                        last = high
                kept, at = hashlib.sha256(), 0
                for low, high in spans_:
                    kept.update(data[at:low])
                    at = high
                kept.update(data[at:])
                out.append((key, len(data), sum(b - a for a, b in spans_), len(spans_), kept.hexdigest()))
            yield pd.DataFrame(out, columns=[f.split(" ")[0] for f in RESULT.split(", ")]).astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("long"), "text", text_key().alias("tk")).join(by_text, "tk", "left")
    return scratch.finish(rows.select("doc_id", "text", "runs").mapInPandas(run, RESULT))

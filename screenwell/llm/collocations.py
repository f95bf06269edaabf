"""Frequent phrases and how strongly they hold together, from Misra-Gries summaries and an exact recount."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from screenwell.llm.hashing import LOWER, mix, parts, prefix, spans
from screenwell.llm.store import Scratch

THRESHOLD, LONGEST, TOP, INSIDE = 30, 4, 2000, 80
PART_MASS, HELD, ROWS, FILTER_BYTES = 1 << 21, 1 << 20, 512, 64 << 20
# Bytes by class: 0 in a word, 1 between words, 2 between pieces.
CLASSES = np.zeros(256, np.uint8)
CLASSES[[0x20, 0x09]] = 1
CLASSES[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
PIECE_END, CUT = re.compile(rb"[.,;:!?\x0A-\x0D]"), 1 << 20


def tokens(texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(joined bytes, start, end, piece and hash of every word) of lower-cased ``texts``."""
    joined = b"\n".join(texts) + b"\n"
    data = np.frombuffer(joined, np.uint8)
    kind = CLASSES[data]
    inside = np.concatenate([[False], kind == 0])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int64)[start]
    return joined, start, end, piece, spans(prefix(data), start, end)


def phrases(piece: np.ndarray, words: np.ndarray, salt: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``LONGEST`` words: (first words, hashes) of the phrases inside pieces."""
    run = np.full(len(words), salt, np.uint64)
    for k in range(min(LONGEST, len(words))):
        n = len(words) - k
        with np.errstate(over="ignore"):
            run = mix(run[:n] + words[k:], 11 + k)
        at = np.flatnonzero(piece[:n] == piece[k:])
        yield at, mix(run[at], 31)


def pieces_of(text: bytes) -> Iterator[bytes]:
    """``text`` in parts of about ``CUT`` bytes that end at the end of a piece."""
    while len(text) > CUT and (found := PIECE_END.search(text, CUT)):
        yield text[:found.end()]
        text = text[found.end():]
    yield text


def by_language(batch) -> Iterator[tuple[str, list[bytes]]]:
    """Lower-cased texts of an Arrow batch (lang, text) in blocks of one language, ``ROWS`` rows at a time."""
    for at in range(0, batch.num_rows, ROWS):
        some = batch.slice(at, ROWS)
        blocks: dict[str, list[bytes]] = {}
        for lang, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
            blocks.setdefault(lang, []).extend(pieces_of((text or "").encode("utf-8", "replace").translate(LOWER)))
        for lang, texts in blocks.items():
            for block in parts(texts):
                yield lang, block


def salt_of(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "replace"))


def merged(keys: np.ndarray, counts: np.ndarray, capacity: int | None = None) -> tuple[np.ndarray, np.ndarray, int]:
    """A Misra-Gries summary of all entries: (keys, counts, what each kept count lost).

    Above ``capacity`` entries the (capacity + 1)-th largest count is taken from all of them; each
    unit of it takes away more than ``capacity`` units of mass.
    """
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    lost = 0
    if capacity is not None and len(keys) > capacity:
        lost = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
        keep = counts > lost
        keys, counts = keys[keep], counts[keep] - lost
    return keys, counts, lost


def summaries(docs: DataFrame, n_parts: int) -> DataFrame:
    """(part, mass, keys, counts): summaries of runs of documents by hash partition.

    A run ends when about ``HELD`` different phrases are held, which is below any capacity that a
    merge may use, so nothing is lost yet. Keys are the upper 32 bits of a phrase's hash, the
    partition its lower bits. Two phrases with the same bits only add up.
    """
    def emit(held):
        import pyarrow as pa

        keys, counts, _ = merged(*map(np.concatenate, zip(*held, strict=True)))
        part = (keys & np.uint64(n_parts - 1)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part, tails, counts = part[order], (keys[order] >> np.uint64(32)).astype(np.uint32), counts[order]
        at = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        ends = [*at[1:], len(part)]
        size = np.uint8 if counts.max() < 256 else np.int64
        yield pa.RecordBatch.from_arrays([
            pa.array(part[at]), pa.array(np.add.reduceat(counts, at)),
            pa.array([tails[i:j].tobytes() for i, j in zip(at, ends, strict=True)], pa.binary()),
            pa.array([counts[i:j].astype(size).tobytes() for i, j in zip(at, ends, strict=True)], pa.binary())],
            ["part", "mass", "keys", "counts"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for lang, block in by_language(batch):
                _, _, _, piece, words = tokens(block)
                found = [h for _, h in phrases(piece, words, salt_of(lang))]
                if not found:
                    continue
                keys, counts = np.unique(np.concatenate(found), return_counts=True)
                held.append((keys, counts))
                size += len(keys)
                if size > HELD:
                    held = [merged(*map(np.concatenate, zip(*held, strict=True)))[:2]]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield from emit(held)
                        held, size = [], 0
        if held:
            yield from emit(held)

    return docs.mapInArrow(run, "part long, mass long, keys binary, counts binary")


def slot_of(tails: np.ndarray, slots: int, way: int) -> np.ndarray:
    """One of the two places of a key in its partition's slice of the filter."""
    tails = tails.astype(np.uint64)
    return (mix(tails, 41) if way else tails) & np.uint64(slots - 1)


def survivors(held: DataFrame, threshold: int, slots: int) -> DataFrame:
    """(part, bits): two bits for every key that may belong to a phrase with ``threshold`` uses.

    All summaries of a hash partition are merged at a capacity above its mass divided by the
    threshold. Counts are then short by less than the threshold, so every frequent phrase is left.
    """
    def merge(group: pd.DataFrame) -> pd.DataFrame:
        capacity = int(group["mass"].sum()) // threshold + 1
        keys, counts, lost = np.zeros(0, np.uint32), np.zeros(0, np.int64), 0
        wait, size = [], 0
        rows = list(zip(group["keys"], group["counts"], strict=True))
        for i, (k, c) in enumerate(rows):
            more = np.frombuffer(k, np.uint32)
            wait.append((more, np.frombuffer(c, np.uint8 if len(c) == len(more) else np.int64).astype(np.int64)))
            size += len(more)
            if size > 4 * capacity or i == len(rows) - 1:
                keys, counts, gone = merged(np.concatenate([keys, *(w[0] for w in wait)]),
                                            np.concatenate([counts, *(w[1] for w in wait)]), capacity)
                wait, size, lost = [], 0, lost + gone
        bits = np.zeros(slots, bool)
        for way in range(2):
            bits[slot_of(keys[counts + lost >= threshold], slots, way).astype(np.int64)] = True
        return pd.DataFrame({"part": [int(group["part"].iloc[0])], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    return held.groupBy("part").applyInPandas(merge, "part long, bits binary")


def recount(docs: DataFrame, n_parts: int, slots: int, bits) -> DataFrame:
    """(lang, phrase, n): uses of every phrase whose bits are set, counted on the words themselves;
    the row with a null phrase counts the words of its language. Python adds up a few blocks of text,
    Spark's map-side aggregation the rest of the task."""
    def run(batches):
        import pyarrow as pa

        table = np.frombuffer(bits.value, np.uint8)
        counts, words_in = Counter(), Counter()

        def emit():
            rows = [*((lang, phrase.decode("utf-8", "replace"), n) for (lang, phrase), n in counts.items()),
                    *((lang, None, n) for lang, n in words_in.items())]
            counts.clear(), words_in.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                                               pa.array([r[2] for r in rows], pa.int64())], ["lang", "phrase", "n"])

        def let_through(hashes: np.ndarray) -> np.ndarray:
            left = np.arange(len(hashes))
            for way in range(2):
                own = hashes[left]
                slot = (own & np.uint64(n_parts - 1)) * np.uint64(slots) + slot_of((own >> np.uint64(32)).astype(np.uint32), slots, way)
                left = left[(table[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1]
            return left

        for batch in batches:
            for lang, block in by_language(batch):
                joined, start, end, piece, words = tokens(block)
                words_in[lang] += len(words)
                for k, (at, hashes) in enumerate(phrases(piece, words, salt_of(lang))):
                    at = at[let_through(hashes)]
                    first, last = start[at].tolist(), end[at + k].tolist()
                    if k == 0:
                        counts.update((lang, joined[i:j]) for i, j in zip(first, last, strict=True))
                    else:
                        counts.update((lang, b" ".join(joined[i:j].split())) for i, j in zip(first, last, strict=True))
                if len(counts) > HELD // 16:
                    yield emit()
        if words_in:
            yield emit()

    return docs.mapInArrow(run, "lang string, phrase string, n long")


def frequent(docs: DataFrame, threshold: int = THRESHOLD, scratch: Scratch | None = None) -> DataFrame:
    """(lang, phrase, f): phrases of one to four words with at least ``threshold`` uses in ``docs``
    (lang, text), and a row with a null phrase for all words of the language.

    The first pass writes Misra-Gries summaries, the second counts what they let through. The
    filter between them has at most ``FILTER_BYTES``; a corpus with very many frequent phrases lets
    more rare ones pass, which the exact count then drops.
    """
    own = scratch or Scratch(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text")
    volume = docs.agg(F.sum(F.octet_length("text").cast("decimal(38,0)"))).first()[0] or 0
    n_parts = 1 << max(3, math.ceil(math.log2(max(1, int(volume) // 2 / PART_MASS))))
    slots = max(8, min(1 << 17, FILTER_BYTES * 8 // n_parts))
    # One slice of at most 16 kB per partition, FILTER_BYTES in all.
    slices = survivors(summaries(docs, n_parts), threshold, slots).collect()
    table = bytearray(n_parts * slots // 8)
    for part, bits in slices:
        table[part * slots // 8:(part + 1) * slots // 8] = bits
    shared = docs.sparkSession.sparkContext.broadcast(bytes(table))
    counted = recount(docs, n_parts, slots, shared).groupBy("lang", "phrase").agg(F.sum("n").alias("f"))
    return own.cut(counted.where((F.col("f") >= threshold) | F.col("phrase").isNull()))


def collocations(docs: DataFrame, threshold: int = THRESHOLD, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the phrases of each language that hold together best.

    ``docs`` has lang (null: ``und``) and text (null: empty). Texts are lower-cased (A-Z), cut at
    ``.,;:!?`` and line ends into pieces and those at spaces and tabs into words. A candidate is a
    phrase of two to four words with a >= ``threshold`` uses. Cut after its first k words, its parts
    have l and r uses, and its score is floor(2000000 a / (l + r)), of the cut where that is lowest
    (ties: smallest k). Candidates that stand inside a longer one with at least ``inside`` percent
    of their uses go. The first ``top`` of a language by score, uses and phrase (in bytes) are kept;
    n is its number of words. Arithmetic is exact.

    Equal rows count each; long texts are read whole; texts of separators only have no words; an
    empty table gives an empty result. Other columns are not read.
    """
    scratch = Scratch(docs.sparkSession)
    counts = frequent(docs, threshold, scratch)
    uses = counts.where("phrase is not null")
    words = F.split("phrase", " ")
    long = uses.where(F.size(words) > 1).withColumnRenamed("f", "a").withColumn("words", words)
    part = lambda k, n: F.array_join(F.slice("words", k, n), " ")
    cuts = long.withColumn("k", F.explode(F.sequence(F.lit(1), F.size("words") - 1))).select(
        "lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("one"),
        part(F.col("k") + 1, F.size("words") - F.col("k")).alias("two"))
    left = uses.select("lang", F.col("phrase").alias("one"), F.col("f").alias("l"))
    right = uses.select("lang", F.col("phrase").alias("two"), F.col("f").alias("r"))
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + r)")
    scored = cuts.join(left, ["lang", "one"]).join(right, ["lang", "two"]).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    shorter = F.expr("flatten(transform(sequence(2, size(words) - 1), n -> "
                     "transform(sequence(1, size(words) - n + 1), i -> array_join(slice(words, i, n), ' '))))")
    inner = long.where(F.size("words") > 2).select("lang", F.col("a").alias("outer"), F.explode(F.array_distinct(shorter)).alias("phrase"))
    gone = inner.groupBy("lang", "phrase").agg(F.max("outer").alias("outer"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = scored.join(gone, ["lang", "phrase"], "left").where(
        F.col("outer").isNull() | (wide("outer") * 100 < wide("a") * inside))
    order = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    best = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counts.where("phrase is null").select("lang", F.col("f").alias("n"))
    return scratch.finish(best.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"),
        "n", F.col("cut.score").cast("long").alias("score")))

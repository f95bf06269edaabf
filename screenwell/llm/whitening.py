"""Whitening of embeddings: covariance on Spark, leading components by tridiagonal bisection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.store import Scratch

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
MODEL_BYTES, MERGE_WAYS = 64 << 20, 64
LARGEST = float(1 << 62)


# ---- leading eigenvectors of one symmetric matrix ------------------------------------------------

def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reduction: (diagonal, off-diagonal, unit reflectors of columns 0, 1, ...)."""
    a, d = matrix.copy(), len(matrix)
    reflectors = []
    for j in range(d - 2):
        v = a[j + 1:, j].copy()
        size = np.linalg.norm(v)
        if size > 0:
            v[0] += size if v[0] >= 0 else -size
            v /= np.linalg.norm(v)
            block = a[j + 1:, j + 1:]
            p = block @ v
            q = p - (v @ p) * v
            block -= 2 * (np.outer(v, q) + np.outer(q, v))
            a[j + 1:, j] -= 2 * v * (v @ a[j + 1:, j])
        reflectors.append(v)
    return np.diag(a).copy(), np.array([a[j + 1, j] for j in range(d - 1)]), reflectors


def counts_below(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each value of ``at``."""
    tiny = np.finfo(float).tiny
    floor = max(tiny, np.finfo(float).eps ** 2 * float(np.max(off ** 2, initial=0.0)))
    q = diagonal[0] - at
    below = (q < 0).astype(np.int64)
    for j in range(1, len(diagonal)):
        q = np.where(np.abs(q) < floor, -floor, q)
        q = diagonal[j] - at - off[j - 1] ** 2 / q
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each bisected until its ends are neighbours."""
    d = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    low, high = np.full(k, np.min(diagonal - reach)), np.full(k, np.max(diagonal + reach))
    wanted = d - 1 - np.arange(k)
    while True:
        middle = low + (high - low) / 2
        if np.all((middle <= low) | (middle >= high)):
            return middle
        above = counts_below(diagonal, off, middle) > wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, right: np.ndarray, floor: float) -> np.ndarray:
    """(T - shift) x = right by elimination with row exchanges; pivots are at least ``floor``."""
    d = len(diagonal)
    main, up, up2 = (diagonal - shift).tolist(), [*off.tolist(), 0.0], [0.0] * d
    low, b = off.tolist(), right.tolist()
    for j in range(d - 1):
        if abs(low[j]) > abs(main[j]):
            f = main[j] / low[j]
            main[j], main[j + 1], up[j] = low[j], up[j] - f * main[j + 1], main[j + 1]
            up2[j], up[j + 1] = up[j + 1], -f * up[j + 1]
            b[j], b[j + 1] = b[j + 1], b[j] - f * b[j + 1]
        else:
            if abs(main[j]) < floor:
                main[j] = floor
            f = low[j] / main[j]
            main[j + 1] -= f * up[j]
            b[j + 1] -= f * b[j]
    if abs(main[-1]) < floor:
        main[-1] = floor
    x = [0.0] * (d + 2)
    for j in range(d - 1, -1, -1):
        x[j] = (b[j] - up[j] * x[j + 1] - up2[j] * x[j + 2]) / main[j]
        if abs(x[j]) > 1e200:
            scale = abs(x[j])
            x, b = [v / scale for v in x], [v / scale for v in b]
    return np.array(x[:d])


def leading_vectors(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values falling, unit vectors as rows) of the ``k`` leading components of a symmetric matrix.

    Inverse iteration on the tridiagonal form; vectors whose values are within a thousandth of its
    norm of their neighbour are kept orthogonal to each other (Gram-Schmidt, twice). Equal values
    are moved apart by a few units in the last place. Reflectors take the vectors back.
    """
    diagonal, off, reflectors = tridiagonal(matrix)
    values = leading_values(diagonal, off, k)
    norm = float(np.max(np.abs(diagonal), initial=0.0) + 2 * np.max(np.abs(off), initial=0.0)) or 1.0
    gap, eps = norm * 1e-3, np.finfo(float).eps
    random = np.random.default_rng(1)
    out: list[np.ndarray] = []
    cluster, shift = 0, 0.0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > gap:
            cluster = i
        shift = min(value, shift - 10 * eps * norm) if i > cluster else value
        x = random.standard_normal(len(diagonal))
        for _ in range(5):
            for _ in range(2):
                for other in out[cluster:i]:
                    x = x - (other @ x) * other
            x = x / np.linalg.norm(x)
            last, x = x, solved(diagonal, off, shift, x, eps * norm)
            x = x / np.linalg.norm(x)
            if not out[cluster:i] and abs(abs(last @ x) - 1) < 4 * eps:
                break
        for _ in range(2):
            for other in out[cluster:i]:
                x = x - (other @ x) * other
            x = x / np.linalg.norm(x)
        out.append(x)
    vectors = np.array(out)
    for j in range(len(reflectors) - 1, -1, -1):
        v = reflectors[j]
        vectors[:, j + 1:] -= 2 * np.outer(vectors[:, j + 1:] @ v, v)
    return values, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# ---- Spark passes -------------------------------------------------------------------------------

def integers(vectors: DataFrame) -> DataFrame:
    """Rows with a usable vector, and ``x``: floor(64 c) + 1000000 of every entry as bytes of longs.

    Entries beyond 2^62 are held there.
    """
    usable = vectors.where("vec is not null and size(vec) > 0").where(
        ~F.exists("vec", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            x = np.clip(np.floor(flat * SCALE), -LARGEST, LARGEST).astype(np.int64)
            x = np.minimum(x, int(LARGEST) - OFFSET) + OFFSET
            ends = np.cumsum(column.value_lengths().to_numpy()) * 8
            packed = pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(
                np.concatenate([[0], ends]).astype(np.int32).tobytes()), pa.py_buffer(x.tobytes())])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], packed], [*batch.schema.names[:-1], "x"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return usable.select("vec_id", "vec").mapInArrow(run, f"vec_id {kind}, x binary")


def by_width(batch, at: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(width, row numbers, matrix of longs) of the vectors in column ``at`` of an Arrow batch."""
    import pyarrow.compute as pc

    lengths = pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False)
    for size in np.unique(lengths):
        rows = np.flatnonzero(lengths == size)
        values = batch.column(at).take(rows).to_pylist()
        yield int(size) // 8, rows, np.frombuffer(b"".join(values), np.int64).reshape(len(rows), -1)


def sums(fit: DataFrame) -> DataFrame:
    """(width, n, S): number of vectors and exact sum of every dimension, as decimal text."""
    def run(batches):
        import pyarrow as pa

        held: dict[int, list] = {}
        for batch in batches:
            for width, rows, x in by_width(batch, 0):
                own = held.setdefault(width, [0, 0, 0])
                own[0] += len(rows)
                own[1] = own[1] + (x >> 31).sum(axis=0)
                own[2] = own[2] + (x & (2**31 - 1)).sum(axis=0)
        for width, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([width] * width), pa.array(range(width), pa.int64()), pa.array([n] * width),
                                              pa.array(high), pa.array(low)], ["width", "dim", "n", "high", "low"])

    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    parts = fit.select("x").mapInArrow(run, "width long, dim long, n long, high long, low long")
    per_dim = parts.groupBy("width", "dim").agg(F.sum("n").alias("n"), (big("high") * F.lit(2**31) + big("low")).cast("string").alias("s"))
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("dim", "s"))), lambda p: p["s"])
    return per_dim.groupBy("width", "n").agg(ordered.alias("S"))


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """x - S/n in double precision, the difference taken in whole numbers where they fit."""
    base = np.array([s // n for s in total], dtype=np.int64)
    rest = np.array([(s % n) / n for s in total])
    return (x - base).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, total: list[int]) -> list:
    """Exact sum over the dimensions of (n x - S)^2 for each row; null beyond a long."""
    largest = np.abs(centred(x, n, total)).max(initial=0.0) * n
    if np.abs(x).max(initial=0) * float(n) < LARGEST and largest * largest * len(total) < LARGEST:
        return ((x * n - np.array(total, dtype=np.int64)) ** 2).sum(axis=1).tolist()
    out = [sum((n * v - s) ** 2 for v, s in zip(row, total, strict=True)) for row in x.tolist()]
    return [v if v < 2**63 else None for v in out]


def covariance(fit: DataFrame, models: dict) -> DataFrame:
    """(width, row, values): rows of the covariance of each width, divisor n.

    Every task adds up its own products; rows of the matrix are merged in two rounds, so that no
    task meets those of all others at once.
    """
    def run(batches):
        import pyarrow as pa

        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for width, _, x in by_width(batch, 0):
                n, total = models[width]
                c = centred(x, n, total)
                held[width] = held.get(width, 0) + c.T @ c
        for width, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([width] * width), pa.array(range(width), pa.int64()), pa.array(list(m / models[width][0]))],
                                             ["width", "row", "values"])

    def added(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"width": group["width"].iloc[:1], "row": group["row"].iloc[:1],
                             "values": [np.sum(np.vstack(group["values"].to_list()), axis=0)]})

    kind = "width long, row long, values array<double>"
    parts = fit.select("x").mapInArrow(run, kind).withColumn("way", F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)))
    return parts.groupBy("width", "row", "way").applyInPandas(added, kind).groupBy("width", "row").applyInPandas(added, kind)


def eigen(rows: DataFrame, components: int) -> DataFrame:
    """(width, trace, values, vectors): one task per width solves a matrix of width x width."""
    def solve(group: pd.DataFrame) -> pd.DataFrame:
        matrix = np.vstack(group.sort_values("row")["values"].to_list())
        matrix = (matrix + matrix.T) / 2
        values, vectors = leading_vectors(matrix, min(components, len(matrix)))
        kept = values > len(matrix) * np.finfo(float).eps * max(values[0], 0.0)
        return pd.DataFrame({"width": [int(group["width"].iloc[0])], "trace": [float(np.trace(matrix))],
                             "values": [values[kept]], "vectors": [vectors[kept].ravel()]})

    return rows.groupBy("width").applyInPandas(solve, "width long, trace double, values array<double>, vectors array<double>")


def identity_errors(fit: DataFrame, models: dict) -> DataFrame:
    """(width, error): largest entry of the whitened vectors' covariance minus the identity."""
    def run(batches):
        import pyarrow as pa

        held: dict[int, list] = {}
        for batch in batches:
            for width, _, x in by_width(batch, 0):
                w = centred(x, *models[width][:2]) @ models[width][2].T
                own = held.setdefault(width, [])
                own.append((len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0))))
                if len(own) > 64:
                    held[width] = [together(own)]
        for width, own in held.items():
            n, mean, m2 = together(own)
            yield pa.RecordBatch.from_arrays([pa.array([width]), pa.array([n]), pa.array([mean]), pa.array([m2.ravel()])], ["width", "n", "mean", "m2"])

    def together(own):
        n = sum(o[0] for o in own)
        mean = sum(o[0] * o[1] for o in own) / n
        return n, mean, sum(o[2] + o[0] * np.outer(o[1] - mean, o[1] - mean) for o in own)

    def added(group: pd.DataFrame) -> pd.DataFrame:
        n, mean, m2 = together([(n, m, v.reshape(len(m), -1)) for n, m, v in zip(group["n"], group["mean"], group["m2"], strict=True)])
        error = np.abs(m2 / n - np.eye(len(mean))).max(initial=0.0)
        return pd.DataFrame({"width": group["width"].iloc[:1], "n": [n], "mean": [mean], "m2": [m2.ravel()], "error": [error]})

    kind = "width long, n long, mean array<double>, m2 array<double>"
    parts = fit.select("x").mapInArrow(run, kind).withColumn("way", F.pmod(F.spark_partition_id(), F.lit(MERGE_WAYS)))
    wide = f"{kind}, error double"
    return parts.groupBy("width", "way").applyInPandas(added, wide).groupBy("width").applyInPandas(added, wide).select("width", "error")


def projected(rows: DataFrame, models: dict) -> DataFrame:
    """A row per vector and component."""
    kind = rows.schema["vec_id"].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for width, at, x in by_width(batch, 1):
                if width not in models:
                    continue
                n, total, whiten, explained, error = models[width]
                k = len(whiten)
                size = len(at) * k
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(size, n)), pa.array(deviations(x, n, total), pa.int64()).take(pa.array(np.repeat(np.arange(len(at)), k))),
                    pa.array((centred(x, n, total) @ whiten.T).ravel()), pa.array(np.tile(explained, len(at))), pa.array(np.full(size, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whitened(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of ``vectors``
    (vec_id, embedding), a row for each usable vector and leading component.

    Rows whose vector is null or empty, or holds a null or non-finite entry, are left out. Entries
    become whole numbers x = floor(64 c) + 1000000; the model is fitted on each distinct x once, so
    copies do not weigh. Sums are exact, products are taken of centred values. Components are
    numbered by falling eigenvalue; directions without variance (all vectors equal there) are none,
    so equal vectors alone give no rows. Vectors of another length form a fit of their own. Rows
    that repeat a vec_id, or have none, each give their rows; tied eigenvalues give some orthogonal
    basis, stored once and so the same for all rows. Other columns are not read. ``deviation`` is
    null where it passes a long. An empty table gives an empty result.

    Models have width x (components + 1) numbers and one per different length; their bytes are
    checked, and beyond ``MODEL_BYTES`` the widths are projected in several rounds.
    """
    scratch = Scratch(vectors.sparkSession)
    rows = scratch.cut(integers(vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vec"))))
    fit = scratch.cut(rows.select("x").distinct())
    totals = scratch.cut(sums(fit))
    rounds, size = [[]], 0
    for width in [r[0] for r in totals.select("width").orderBy("width").toLocalIterator()]:
        size += width * (components + 2) * 8
        if rounds[-1] and size > MODEL_BYTES:
            rounds, size = [*rounds, []], width * (components + 2) * 8
        rounds[-1].append(width)
    out = None
    for widths in rounds:
        some = F.length("x").isin([8 * w for w in widths])
        known = {r["width"]: (r["n"], [int(s) for s in r["S"]]) for r in totals.where(F.col("width").isin(widths)).collect()}
        solved_rows = scratch.cut(eigen(covariance(fit.where(some), known), components))
        models = {}
        for r in solved_rows.collect():
            values, n = np.array(r["values"]), known[r["width"]][0]
            if len(values):
                basis = np.array(r["vectors"]).reshape(len(values), -1) / np.sqrt(values)[:, None]
                models[r["width"]] = (n, known[r["width"]][1], basis, values / r["trace"])
        errors = {r[0]: r[1] for r in scratch.cut(identity_errors(fit.where(some & F.length("x").isin([8 * w for w in models])), models)).collect()}
        models = {w: (*m, errors[w]) for w, m in models.items()}
        part = projected(rows.where(some), models)
        out = part if out is None else out.unionByName(part)
    return scratch.finish(out)

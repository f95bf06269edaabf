"""Near-duplicate embeddings by sorted projection passes."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.llm.graph import components
from screenwell.llm.store import Scratch, small

BITS = 60


def passes_for(rows: int, cosine: float, window: int, miss: float) -> int:
    """Passes of a round: as many as miss a pair at the threshold with probability ``miss`` at most in
    vectors spread evenly; whether they do is measured.

    Two vectors at angle t share a random hash bit with probability 1 - t / pi, and meet in a
    window when they share about log2(rows / window) bits of a pass.
    """
    bits = max(1.0, math.log2(max(2, rows) / window))
    meet = min(0.999, (1 - math.acos(cosine) / math.pi) ** bits)
    return max(4, math.ceil(math.log(miss) / math.log(1 - meet)))


def unit(vectors) -> np.ndarray:
    x = np.array(vectors.tolist(), np.float64)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links_in_order(x: np.ndarray, group: np.ndarray, window: int, cosine: float) -> np.ndarray:
    """Smallest position that each row is joined to through verified pairs at most ``window`` apart."""
    root = np.arange(len(x))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    near = x @ x.T >= cosine
    near &= group[:, None] == group[None, :]
    a, b = np.nonzero(np.triu(near, 1) & ~np.triu(near, window + 1))
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        i, j = find(i), find(j)
        if i != j:
            root[max(i, j)] = min(i, j)
    return np.array([find(i) for i in range(len(x))])


def centres(nodes: DataFrame) -> DataFrame:
    """(label, centre): mean direction of each label's vectors, summed per batch before the shuffle."""
    def partial(batches):
        for batch in batches:
            x = unit(batch["v"])
            label, at = np.unique(batch["label"].to_numpy(), return_inverse=True)
            total = np.zeros((len(label), x.shape[1]))
            np.add.at(total, at, x)
            yield pd.DataFrame({"label": label, "n": np.bincount(at), "total": list(total)})

    sums = nodes.select("label", "v").mapInPandas(partial, "label long, n long, total array<double>")
    means = sums.select("label", "n", F.posexplode("total").alias("i", "x")).groupBy("label", "i").agg(
        (F.sum("x") / F.sum("n")).alias("x"))
    return means.groupBy("label").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "x"))),
                                                  lambda e: e["x"]).alias("centre"))


def bits_needed(key: np.ndarray, group: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """For each i with a row ``window`` further on: how many leading bits part the two, 0 where another
    group begins in between, BITS + 1 where all bits agree; and i."""
    i = np.arange(max(0, len(key) - window))
    differ = key[i] ^ key[i + window]
    parted = BITS + 1 - np.frexp(differ.astype(np.float64))[1]
    return np.where(group[i] == group[i + window], parted, 0), i


def in_passes(nodes: DataFrame, width: int, passes: int, seed: int, window: int, block: int, cosine: float,
              scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) between nodes that a pass brings together, and (node, missed): the logarithm of the
    probability that these passes miss a pair of the node that lies at the threshold.

    Rows are ordered by label and the concatenated hashes of a pass, signs of random projections of the
    direction less its label's centre, and each is compared with the next ``window`` rows. A pair meets
    for certain when it shares as many bits as part a row from those ``window`` places before and after
    it; this number is measured. Two directions at distance d, one of them r from the centre, have at
    most the angle asin(d / r) there and share a bit with probability 1 - angle / pi.
    """
    planes = np.random.default_rng([11, seed]).normal(size=(width, passes * BITS))
    weights = 1 << np.arange(BITS - 1, -1, -1, dtype=np.int64)

    def hashed(batches):
        for batch in batches:
            x = unit(batch["v"]) - np.array(batch["centre"].tolist(), np.float64)
            bits = (x @ planes > 0).reshape(len(batch), passes, BITS)
            key = (bits * weights).sum(axis=2)
            yield pd.DataFrame({"node": np.repeat(batch["node"].to_numpy(), passes),
                                "label": np.repeat(batch["label"].to_numpy(), passes),
                                "r": np.repeat(np.linalg.norm(x, axis=1), passes),
                                "pass": np.tile(np.arange(passes), len(batch)), "key": key.ravel()})

    order = ["pass", "label", "key", "node"]
    rows = nodes.select("node", "label", "v").join(small(scratch.cut(centres(nodes)), 10_000), "label")
    rows = rows.select("node", "label", "v", "centre").mapInPandas(
        hashed, "node long, label long, r double, pass long, key long")
    rows = scratch.cut(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                       .withColumn("at", F.monotonically_increasing_id()))
    part, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = rows.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, starts = 0, []
    for r in sizes:
        starts.append((r["part"], before))
        before += r["count"]
    starts = nodes.sparkSession.createDataFrame(starts or [(0, 0)], "part long, before long")
    rows = rows.join(F.broadcast(starts), part == F.col("part")).withColumn("place", F.col("before") + place)
    home = F.floor(F.col("place") / block)
    rows = rows.withColumn("block", F.explode(F.when(
        F.col("place") % block < window, F.array(home, home - 1)).otherwise(F.array(home))))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        label = group["label"].to_numpy() * passes + group["pass"].to_numpy()
        root = links_in_order(unit(group["v"]), label, window, cosine)
        node = group["node"].to_numpy()
        moved = root != np.arange(len(root))
        need, i = bits_needed(group["key"].to_numpy(), label, window)
        most = np.zeros(len(node), np.int64)
        np.maximum.at(most, i, need)
        np.maximum.at(most, i + window, need)
        return pd.concat([
            pd.DataFrame({"a": node[moved], "b": node[root[moved]], "pass": -1, "need": 0, "r": 0.0}),
            pd.DataFrame({"a": node, "b": node, "pass": group["pass"], "need": most, "r": group["r"]})])

    rows = rows.select("node", "label", "r", "pass", "key", "place", "block").join(nodes.select("node", "v"), "node")
    found = scratch.cut(rows.groupBy("block").applyInPandas(compare, "a long, b long, pass long, need long, r double"))
    angle = F.asin(F.least(F.lit(1.0), F.lit(math.sqrt(2 - 2 * cosine)) / F.col("r")))
    share = F.when(F.col("r") <= math.sqrt(2 - 2 * cosine), 0.0).otherwise(1 - angle / math.pi)
    meet = F.when(F.col("need") > BITS, 0.0).otherwise(F.pow(share, F.col("need")))
    missed = found.where("pass >= 0").groupBy("a", "pass").agg(F.max("need").alias("need"), F.first("r").alias("r"))
    missed = missed.groupBy(F.col("a").alias("node")).agg(
        F.sum(F.log1p(-F.least(meet, F.lit(1 - 1e-12)))).alias("missed"))
    return found.where("pass < 0").select("a", "b").distinct(), missed


def in_tiles(nodes: DataFrame, tile: int, cosine: float) -> DataFrame:
    """Edges (a, b) between components of ``nodes`` (node, label, v, component), from comparing all of
    them label by label, a pair of tiles in a task; links inside one component are not passed on."""
    sizes = nodes.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / tile).alias("tiles"))
    rows = nodes.join(sizes, "label").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")))
    rows = rows.withColumn("theirs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.select("label", "component", "v", "mine", F.least("mine", "theirs").alias("i"),
                       F.greatest("mine", "theirs").alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        one = group[group["mine"] == group["i"].iloc[0]]
        two = group[group["mine"] == group["j"].iloc[0]]
        if not len(one) or not len(two):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        a, b = one["component"].to_numpy(), two["component"].to_numpy()
        near = (unit(one["v"]) @ unit(two["v"]).T >= cosine) & (a[:, None] != b[None, :])
        x, y = np.nonzero(near)
        return pd.DataFrame({"a": a[x], "b": b[y]}).drop_duplicates()

    return rows.groupBy("label", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def edges_between(nodes: DataFrame, width: int, cosine: float, window: int, block: int, tile: int, miss: float,
                  most_passes: int, scratch: Scratch) -> DataFrame:
    """Edges (a, b) that connect what links connect, in rounds of passes over the rows still open.

    A row is open while the passes so far may miss a pair of it with more than ``miss``; a closed one
    needs no further pass, as its pairs are covered from its side. Rows still open lie in clouds so
    narrow that hashes hardly part them. All of a label's are compared in tiles once they are so few
    that this takes no more comparisons than a round of passes, or after ``most_passes`` passes.
    """
    open_rows, edges, rest, done, missed = nodes, None, None, 0, None
    step = passes_for(nodes.count(), cosine, window, miss)
    while True:
        found, more = in_passes(open_rows, width, step, done, window, block, cosine, scratch)
        edges = found if edges is None else edges.union(found)
        missed = more if missed is None else missed.union(more).groupBy("node").agg(F.sum("missed").alias("missed"))
        missed = scratch.cut(missed)
        open_rows = scratch.cut(open_rows.join(missed.where(F.col("missed") > math.log(miss)), "node", "left_semi"))
        done += step
        sizes = scratch.cut(open_rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")))
        few = sizes if done >= most_passes else sizes.where(F.col("n") <= 2 * step * window)
        left = open_rows.join(small(few, 10_000), "label", "left_semi")
        rest = left if rest is None else rest.union(left)
        open_rows = open_rows.join(small(few, 10_000), "label", "left_anti")
        if sizes.count() == few.count():
            break
        open_rows = scratch.cut(open_rows)
    rest = scratch.cut(rest)
    if rest.isEmpty():
        return edges
    known = components(scratch.cut(edges), scratch)
    rows = rest.join(known.withColumnRenamed("id", "node"), "node", "left").select(
        "node", "label", "v", F.coalesce("component", "node").alias("component"))
    return edges.union(in_tiles(scratch.cut(rows), tile, cosine))


def link_counts(members: DataFrame, tile: int, cosine: float) -> DataFrame:
    """(node, n): summed weights of the other nodes linked with each one of the same component.

    Exact for components of any size: a component's members are dealt to tiles of about ``tile`` and
    each pair of tiles is compared by a task of its own, which passes on one count per member.
    """
    sizes = members.groupBy("component").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "tiles", F.ceil(F.col("n") / tile))
    rows = members.join(sizes, "component").withColumn("mine", F.pmod(F.xxhash64("node"), F.col("tiles")))
    rows = rows.withColumn("theirs", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)))
    rows = rows.select("component", "node", "label", "v", "weight", "mine",
                       F.least("mine", "theirs").alias("i"), F.greatest("mine", "theirs").alias("j"))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = group["i"].iloc[0], group["j"].iloc[0]
        one = group[group["mine"] == i]
        two = group[group["mine"] == j]
        near = unit(one["v"]) @ unit(two["v"]).T >= cosine if len(one) and len(two) else np.zeros((len(one), len(two)), bool)
        near &= one["label"].to_numpy()[:, None] == two["label"].to_numpy()[None, :]
        near &= one["node"].to_numpy()[:, None] != two["node"].to_numpy()[None, :]
        out = [pd.DataFrame({"node": one["node"].to_numpy(), "n": near @ two["weight"].to_numpy()})]
        if i != j:
            out.append(pd.DataFrame({"node": two["node"].to_numpy(), "n": one["weight"].to_numpy() @ near}))
        return pd.concat(out)

    return rows.groupBy("component", "i", "j").applyInPandas(compare, "node long, n long").groupBy("node").agg(
        F.sum("n").alias("n"))


def near_duplicates(table: DataFrame, cosine: float = 0.98, window: int = 64, block: int = 1024,
                    tile: int = 512, miss: float = 1e-4, most_passes: int = 64) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``table`` (vec_id, embedding, label).

    Equal vectors of a label are one weighted node. Sorted projection passes find components; their
    number follows, row by row, from the measured crowding and the wanted ``miss``, and rows that
    ``most_passes`` cannot settle are compared exactly (``edges_between``). Links are then counted
    exactly inside each component, so a window's bound costs no link there.

    Rows with a null label, or a vector that is null, empty, zero or holds null or non-finite
    components, link with nothing: n_links 0, their own component, kept. Vectors of different
    lengths are never linked. Repeated rows are linked copies. An empty table gives an empty one.
    """
    scratch = Scratch(table.sparkSession)
    v = F.col("embedding").cast("array<double>")
    good = (F.col("label").isNotNull() & (F.size(v) > 0)
            & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))
    rows = table.select("vec_id", F.col("label").cast("long").alias("label"), v.alias("v"),
                        F.coalesce(good, F.lit(False)).alias("good"))
    valid = rows.where("good")
    nodes = scratch.cut(valid.groupBy("label", "v").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("first"))
                        .withColumn("node", F.monotonically_increasing_id()))
    edges = None
    for r in nodes.groupBy(F.size("v").alias("width")).count().orderBy("width").collect():
        own = nodes.where(F.size("v") == r["width"])
        found = edges_between(own, r["width"], cosine, window, block, tile, miss, most_passes, scratch)
        edges = found if edges is None else edges.union(found)
    if edges is None:
        edges = table.sparkSession.createDataFrame([], "a long, b long")
    labels = scratch.cut(components(scratch.cut(edges), scratch))
    members = scratch.cut(nodes.join(labels.withColumnRenamed("id", "node"), "node"))
    counts = scratch.cut(link_counts(members, tile, cosine))
    first = members.groupBy("component").agg(F.min("first").alias("component_id"))
    linked = members.join(first, "component").join(counts, "node", "left").select(
        "node", "component_id", F.coalesce("n", F.lit(0)).alias("others"))
    known = scratch.cut(nodes.join(linked, "node", "left").select(
        "label", "v", "weight", "first", "component_id", F.coalesce("others", F.lit(0)).alias("others")))
    matched = valid.join(known, ["label", "v"]).select(
        "vec_id", (F.col("others") + F.col("weight") - 1).cast("long").alias("n_links"),
        F.coalesce("component_id", "first").cast("long").alias("component_id"))
    alone = rows.where("not good").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").cast("long").alias("component_id"))
    return scratch.finish(matched.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))

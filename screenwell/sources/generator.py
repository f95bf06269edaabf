"""Screening tables drawn from a seed, by native expressions.

Every value is a function of (seed, row id, draw name), so the table does not depend on how its
rows are spread over partitions, and lost partitions come back the same.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwell.fixed_texts import NARRATIVES
from screenwell.fixed_values import (BAND_ORDER, CLINICAL, GAD_CUTS, GAD_ITEMS, IDEATION_ITEM,
                                     ITEM_NOISE_SD, PHQ_CUTS, PHQ_ITEMS, POPULATION)
from screenwell.functions.bands import gad_band, item_total, phq_band
from screenwell.functions.hashing import choice, digest_uuid, normal, uniform
from screenwell.functions.numeric import clip
from screenwell.sources.files import screening_schema


def row_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).withColumnRenamed("id", "row_id")


def _whole(u: Column, low: int, high: int) -> Column:
    return (F.floor(u * (high - low + 1)) + low).cast("int")


def _totals(df: DataFrame) -> DataFrame:
    df = df.withColumns({"phq9_total": item_total(PHQ_ITEMS).cast("int"),
                         "gad7_total": item_total(GAD_ITEMS).cast("int")})
    return df.withColumns({"phq9_band": phq_band(F.col("phq9_total")),
                           "gad7_band": gad_band(F.col("gad7_total"))})


def population_table(ids: DataFrame, seed: int = 42, profile: dict = POPULATION) -> DataFrame:
    """Population profile for a table of row ids (column ``row_id``).

    A latent severity is shifted by diagnosis, age and gender; the anxiety latent follows it with
    correlation 0.65. An item counts how many of its cut-offs latent + noise exceeds.
    """
    row = F.col("row_id")
    u = lambda draw: uniform(seed, row, draw)
    df = ids.select("row_id").withColumns({
        "age": _whole(u("age"), *profile["age"]),
        "gender": choice(u("gender"), profile["gender"]),
        "education": choice(u("education"), profile["education"]),
        "prior_diagnosis": u("diagnosis") < profile["diagnosis"]})
    df = df.withColumn("on_medication",
                       F.col("prior_diagnosis") & (u("medication") < profile["medication"]))
    shift = lambda test, size: F.when(test, size).otherwise(0.0)
    latent = (normal(seed, row, "latent")
              + shift(F.col("prior_diagnosis"), profile["shift_diagnosis"])
              + shift(F.col("age") < 25, profile["shift_young"])
              + shift(F.col("gender") == "female", profile["shift_female"]))
    df = df.withColumn("_latent", latent)
    link = profile["anxiety_link"]
    df = df.withColumn("_anxiety", F.col("_latent") * link
                       + normal(seed, row, "anxiety") * math.sqrt(1 - link ** 2))
    noisy = {}
    for latent_name, items in (("_latent", PHQ_ITEMS), ("_anxiety", GAD_ITEMS)):
        for item in items:
            noisy[f"_n_{item}"] = F.col(latent_name) + normal(seed, row, item) * ITEM_NOISE_SD
    df = df.withColumns(noisy)
    answers = {}
    for items, table in ((PHQ_ITEMS, PHQ_CUTS), (GAD_ITEMS, GAD_CUTS)):
        for item, cuts in zip(items, table, strict=True):
            answers[item] = sum(((F.col(f"_n_{item}") > c).cast("int") for c in cuts), F.lit(0))
    df = _totals(df.withColumns(answers)).withColumns({
        "subject_id": F.format_string("SUBJ-%08d", row),
        "latent_severity": F.round("_latent", 4)})
    return df.select(*[f.name for f in screening_schema()])


def _spread_items(total: Column, n_items: int, seed: int, row: Column, name: str) -> Column:
    """Spread a total over items in hash order.

    Each item takes up to 3 of what is left, less 0 or 1 by a draw; what remains at the end goes
    to one drawn item, up to 3. The running state is (items so far, rest).
    """
    draws = F.array(*[F.struct(uniform(seed, row, f"{name}/o{i}").alias("o"), F.lit(i).alias("i"),
                               (uniform(seed, row, f"{name}/l{i}") < 0.5).cast("int").alias("less"))
                      for i in range(n_items)])
    start = F.struct(F.expr("CAST(array() AS array<struct<i:int,v:int>>)").alias("got"),
                     total.alias("rest"))

    def take(acc, d):
        value = F.greatest(F.lit(0), F.least(F.lit(3), acc["rest"]) - d["less"])
        entry = F.struct(d["i"].alias("i"), value.alias("v"))
        return F.struct(F.concat(acc["got"], F.array(entry)).alias("got"),
                        (acc["rest"] - value).alias("rest"))

    spread = F.aggregate(F.array_sort(draws), start, take)
    slot = _whole(uniform(seed, row, f"{name}/slot"), 0, n_items - 1)
    ordered = F.array_sort(spread["got"])
    return F.transform(ordered, lambda e: e["v"] + F.when(
        e["i"] == slot, F.least(F.lit(3) - e["v"], spread["rest"])).otherwise(0))


def clinical_table(ids: DataFrame, seed: int = 42, profile: dict = CLINICAL) -> DataFrame:
    """Clinical profile for a table of row ids: severity groups, item 9 drawn apart, narratives
    and a split."""
    row = F.col("row_id")
    u = lambda draw: uniform(seed, row, draw)
    groups = list(enumerate(profile["group_weights"]))
    df = ids.select("row_id").withColumn("severity_group", choice(u("group"), groups))
    at = lambda key: F.element_at(
        F.array(*[F.lit(x) for x in profile[key]]), F.col("severity_group") + 1)
    df = df.withColumn("_phq", at("group_means") + normal(seed, row, "phq") * at("group_sds"))
    df = df.withColumn("_gad", F.col("_phq") * (profile["anxiety_link"] * 21 / 27)
                       + normal(seed, row, "gad") * profile["anxiety_sd"])
    for name, items, top in (("_phq", PHQ_ITEMS, 27), ("_gad", GAD_ITEMS, 21)):
        goal = clip(F.col(name), 0.0, float(top)).cast("int")
        df = df.withColumn(f"{name}_items", _spread_items(goal, len(items), seed, row, name))
        df = df.withColumns({item: F.col(f"{name}_items")[i] for i, item in enumerate(items)})
    group = F.col("severity_group")
    level = choice(u("ideation/level"), profile["ideation_high_levels"])
    df = df.withColumn(IDEATION_ITEM, F.when(
        (group >= 3) & (u("ideation") < profile["ideation_high"]), level).when(
        (group == 2) & (u("ideation") < profile["ideation_moderate"]), 1).otherwise(0))
    texts = F.array(*[F.array(*[F.lit(t) for t in NARRATIVES[b]]) for b in BAND_ORDER])
    df = _totals(df).withColumns({
        "session_id": digest_uuid(seed, row),
        "age": _whole(u("age"), *profile["age"]),
        "gender": choice(u("gender"), profile["gender"]),
        "education": choice(u("education"), profile["education"]),
        "prior_diagnosis": (u("diagnosis") < profile["diagnosis"]).cast("int"),
        "narrative": F.get(F.get(texts, group), _whole(u("narrative"), 0, 3)),
        "split": choice(u("split"), profile["split"])})
    df = df.withColumn("on_medication", F.col("prior_diagnosis")
                       * (u("medication") < profile["medication"]).cast("int"))
    return df.select("session_id", *PHQ_ITEMS, *GAD_ITEMS, "phq9_total", "gad7_total", "age",
                     "gender", "education", "prior_diagnosis", "on_medication", "narrative",
                     "phq9_band", "gad7_band", "severity_group", "split")

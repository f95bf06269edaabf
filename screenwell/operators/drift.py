"""Distribution drift between a reference and a current table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import DRIFT_CATEGORICAL, DRIFT_NUMERIC
from screenwell.functions.numeric import (chi_square_tail, kolmogorov_tail, normal_two_sided,
                                          ratio)
from screenwell.operators.running import running_sums
from screenwell.session import cut_lineage

LARGE_REFERENCE = 1000
FEW_VALUES = 5
DISTANCE_AT = 0.1
P_VALUE_AT = 0.05


def shared_columns(reference: DataFrame, current: DataFrame, wanted: list[str]) -> list[str]:
    """Wanted columns present on both sides, in the wanted order."""
    return [c for c in wanted if c in reference.columns and c in current.columns]


def value_counts(reference: DataFrame, current: DataFrame, numeric: list[str],
                 categorical: list[str]) -> tuple[DataFrame, DataFrame]:
    """(column, value, n_ref, n_cur) aligned by value, NULLs left out: numeric and categorical.

    Both tables are unioned and all columns counted in one aggregation, so each table is read
    once; the counts are stored, as every statistic starts from them.
    """
    none = F.lit(None)

    def entry(name: str, number: Column, text: Column) -> Column:
        return F.struct(F.lit(name).alias("column"), number.cast("double").alias("number"),
                        text.cast("string").alias("text"))

    pairs = F.array(*[entry(c, F.col(c), none) for c in numeric],
                    *[entry(c, none, F.col(c)) for c in categorical])

    def long(df: DataFrame, is_ref: int) -> DataFrame:
        return df.select(F.inline(pairs)).withColumn("_ref", F.lit(is_ref))

    both = long(reference, 1).unionByName(long(current, 0))
    counts = cut_lineage(both.groupBy("column", "number", "text").agg(
        F.sum("_ref").alias("n_ref"), F.sum(1 - F.col("_ref")).alias("n_cur")))
    parts = [counts.select("column", F.col(kind).alias("value"), "n_ref", "n_cur").filter(
        F.col("value").isNotNull()) for kind in ("number", "text")]
    return parts[0], parts[1]


def value_counts_by_join(reference: DataFrame, current: DataFrame, column: str) -> DataFrame:
    """The same alignment for one column as a full outer join of two count tables."""
    ref = reference.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_ref"))
    cur = current.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n_cur"))
    return ref.join(cur, "value", "full_outer").na.fill(0, ["n_ref", "n_cur"])


def column_sizes(counts: DataFrame) -> DataFrame:
    """Rows per side and distinct reference values of each column."""
    return counts.groupBy("column").agg(
        F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur"),
        F.count_if(F.col("n_ref") > 0).alias("values_ref"),
        F.count("*").alias("values_all"))


def curve_distances(counts: DataFrame) -> DataFrame:
    """Normalised Wasserstein distance and Kolmogorov-Smirnov statistic per numeric column."""
    run = running_sums(counts, ["column"], "value", ["n_ref", "n_cur"], stored=True)
    # A side without any value has an empty curve.
    ref = F.coalesce(F.try_divide(F.col("before_n_ref") + F.col("n_ref"), F.col("total_n_ref")), F.lit(0.0))
    cur = F.coalesce(F.try_divide(F.col("before_n_cur") + F.col("n_cur"), F.col("total_n_cur")), F.lit(0.0))
    gap = F.abs(ref - cur)
    step = F.coalesce(F.col("next_value") - F.col("value"), F.lit(0.0))
    # One row per column on the broadcast side.
    means = counts.groupBy("column").agg(
        F.try_divide(F.sum(F.col("value") * F.col("n_ref")), F.sum("n_ref")).alias("_mean"))
    spread = F.try_divide(F.sum(F.col("n_ref") * F.pow(F.col("value") - F.col("_mean"), 2)),
                          F.sum("n_ref"))
    return run.join(F.broadcast(means), "column").groupBy("column").agg(
        F.sum(gap * step).alias("_area"), F.max(gap).alias("ks"),
        F.greatest(F.sqrt(spread), F.lit(0.001)).alias("_sd")).select(
        "column", (F.col("_area") / F.col("_sd")).alias("wasserstein"), "ks")


def share_distances(counts: DataFrame) -> DataFrame:
    """Jensen-Shannon distance (base 2), chi-square and two-proportion z per column."""
    sizes = column_sizes(counts)
    joined = counts.join(F.broadcast(sizes), "column")
    p = F.coalesce(F.try_divide("n_ref", "rows_ref"), F.lit(0.0))
    q = F.coalesce(F.try_divide("n_cur", "rows_cur"), F.lit(0.0))
    m = (p + q) / 2
    part = lambda a: F.when(a > 0, a * F.log2(a / m)).otherwise(0.0)
    expected = F.try_divide(F.col("n_ref") * F.col("rows_cur"), F.col("rows_ref"))
    miss = F.try_divide(F.pow(F.col("n_cur") - expected, 2), expected)
    unseen = F.count_if((F.col("n_ref") == 0) & (F.col("n_cur") > 0))
    first = F.min_by(F.struct("n_ref", "n_cur"), "value")
    out = joined.groupBy("column", "rows_ref", "rows_cur", "values_ref", "values_all").agg(
        F.sum(part(p) + part(q)).alias("_js"), F.sum(miss).alias("_chi"),
        unseen.alias("_unseen"), first.alias("_first"))
    p1 = F.coalesce(F.try_divide(F.col("_first.n_ref"), F.col("rows_ref")), F.lit(0.0))
    p2 = F.coalesce(F.try_divide(F.col("_first.n_cur"), F.col("rows_cur")), F.lit(0.0))
    pooled = (F.col("_first.n_ref") + F.col("_first.n_cur")) / (F.col("rows_ref") + F.col("rows_cur"))
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), F.col("rows_ref"))
                                            + F.try_divide(F.lit(1), F.col("rows_cur"))))
    return out.select(
        "column", "rows_ref", "rows_cur", "values_ref", "values_all",
        F.sqrt(F.greatest(F.col("_js") / 2, F.lit(0.0))).alias("jensen_shannon"),
        F.when(F.col("_unseen") == 0, F.col("_chi")).alias("chi_square"),
        ratio(p1 - p2, error).alias("z"))


def drift_table(reference: DataFrame, current: DataFrame, numeric: list[str] = DRIFT_NUMERIC,
                categorical: list[str] = DRIFT_CATEGORICAL,
                large: int = LARGE_REFERENCE) -> DataFrame:
    """One row per shared column: test used, score, whether it drifted.

    Above ``large`` reference rows: Wasserstein for numeric columns with more than 5 values,
    Jensen-Shannon otherwise, drifted from 0.1. Below: KS, chi-square or (two values) z test,
    drifted for p < 0.05. A value the reference never had makes the chi-square p-value 0.
    """
    numeric = shared_columns(reference, current, numeric)
    categorical = shared_columns(reference, current, categorical)
    num, cat = value_counts(reference, current, numeric, categorical)
    shares = share_distances(num).withColumn("kind", F.lit("num")).unionByName(
        share_distances(cat).withColumn("kind", F.lit("cat")))
    table = shares.join(curve_distances(num), "column", "left")
    is_large = F.col("rows_ref") > large
    many = (F.col("kind") == "num") & (F.col("values_ref") > FEW_VALUES)
    test = (F.when(is_large & many, "wasserstein").when(is_large, "jensen_shannon")
            .when(many, "ks").when(F.col("values_ref") > 2, "chi_square").otherwise("z"))
    ks_p = kolmogorov_tail(F.col("ks"), F.col("rows_ref"), F.col("rows_cur"))
    chi_p = F.coalesce(chi_square_tail(F.col("chi_square"), F.greatest(
        F.col("values_all") - 1, F.lit(1))), F.lit(0.0))
    scored = table.withColumn("test", test).withColumn("score", (
        F.when(F.col("test") == "wasserstein", F.col("wasserstein"))
        .when(F.col("test") == "jensen_shannon", F.col("jensen_shannon"))
        .when(F.col("test") == "ks", ks_p).when(F.col("test") == "chi_square", chi_p)
        .otherwise(normal_two_sided(F.col("z")))))
    drifted = F.when(is_large, F.col("score") >= DISTANCE_AT).otherwise(
        F.col("score") < P_VALUE_AT)
    return scored.select("column", "test", "score", drifted.alias("drifted"), "rows_ref",
                         "rows_cur")


def dataset_drift(table: DataFrame, share: float = 0.5) -> DataFrame:
    """Share of drifted columns and whether it reaches ``share``."""
    portion = F.avg(F.col("drifted").cast("double"))
    return table.agg(F.count("*").alias("n_columns"),
                     F.count_if(F.col("drifted")).alias("n_drifted"),
                     portion.alias("drift_share"), (portion >= share).alias("dataset_drift"))

"""Evaluation of predictions: confusion, reports, kappa, AUC, calibration, fairness."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from screenwell.functions.bands import age_band
from screenwell.functions.numeric import clip, ratio
from screenwell.operators.running import running_sums


def confusion(df: DataFrame, y: str = "y", p: str = "prediction", by: list[str] = ()) -> DataFrame:
    """Counts per (slice, true class, predicted class)."""
    return df.groupBy(*by, F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count("*").alias("n"))


def confusion_shares(conf: DataFrame, by: list[str] = ()) -> DataFrame:
    """Each count with its share of the true class."""
    row = Window.partitionBy(*by, "y")
    return conf.withColumn("share", F.col("n") / F.sum("n").over(row))


def class_report(conf: DataFrame, by: list[str] = ()) -> DataFrame:
    """Precision, recall, F1 and support for every class seen as truth or prediction."""
    hit = F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0)
    sides = F.array(
        F.struct(F.col("y").alias("cls"), F.col("n").alias("support"),
                 F.lit(0).cast("long").alias("predicted"), hit.cast("long").alias("tp")),
        F.struct(F.col("p").alias("cls"), F.lit(0).cast("long").alias("support"),
                 F.col("n").alias("predicted"), F.lit(0).cast("long").alias("tp")))
    per_class = conf.select(*by, F.inline(sides)).groupBy(*by, "cls").agg(
        *[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    return per_class.select(
        *by, "cls", ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        ratio(F.col("tp"), F.col("support")).alias("recall"),
        ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
        "support", "tp")


def report_summary(report: DataFrame, by: list[str] = ()) -> DataFrame:
    """Accuracy, macro and support-weighted averages, one row per slice."""
    weighted = lambda c: ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    return report.groupBy(*by).agg(
        F.sum("support").alias("n"), ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[weighted(c).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")])


def quadratic_kappa(conf: DataFrame, by: list[str] = ()) -> DataFrame:
    """Quadratic-weighted kappa per slice; NULL when it is undefined.

    Weights use class positions among the classes present. The expected disagreement needs only
    the first two moments of the marginals. The lists hold at most classes x classes counts.
    """
    present = conf.groupBy(*by).agg(F.sort_array(F.array_distinct(F.concat(
        F.collect_set("y"), F.collect_set("p")))).alias("_classes"),
        F.collect_list(F.struct("y", "p", "n")).alias("_cells"))
    cells = present.select(*by, "_classes", F.inline("_cells")).withColumns({
        "i": F.array_position("_classes", F.col("y")).cast("double"),
        "j": F.array_position("_classes", F.col("p")).cast("double")})
    i, j, n = F.col("i"), F.col("j"), F.col("n")
    sums = cells.groupBy(*by).agg(
        F.sum("n").alias("n"), F.countDistinct("y").alias("true_classes"),
        F.sum(n * (i - j) * (i - j)).alias("seen"), F.sum(n * i).alias("si"),
        F.sum(n * j).alias("sj"), F.sum(n * i * i).alias("sii"), F.sum(n * j * j).alias("sjj"))
    expected = (F.col("n") * (F.col("sii") + F.col("sjj")) - 2 * F.col("si") * F.col("sj"))
    return sums.select(*by, "n", "true_classes", (
        1 - ratio(F.col("seen") * F.col("n"), expected, None)).alias("quadratic_kappa"))


def auc_by_class(df: DataFrame, y: str = "y", probability: str = "probability") -> DataFrame:
    """One-vs-rest AUC per class by rank sums; tied scores share their mid-rank."""
    long = df.select(F.col(y).alias("_y"), F.posexplode(probability).alias("cls", "score"))
    return _rank_sum_auc(long, (F.col("_y") == F.col("cls")).cast("long"))


def _rank_sum_auc(long: DataFrame, hit: Column) -> DataFrame:
    counted = long.groupBy("cls", "score").agg(F.sum(hit).alias("pos"),
                                               F.sum(1 - hit).alias("neg"))
    run = running_sums(counted, ["cls"], "score", ["pos", "neg"])
    pairs = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    return run.groupBy("cls").agg(
        F.first("total_pos").alias("n_pos"), F.first("total_neg").alias("n_neg"),
        F.sum(pairs).alias("_pairs")).select(
        "cls", "n_pos", "n_neg",
        ratio(F.col("_pairs"), F.col("n_pos") * F.col("n_neg"), None).alias("auc"))


def macro_auc(per_class: DataFrame) -> DataFrame:
    """Mean AUC; NULL unless every class occurs."""
    return per_class.agg(F.when(F.min("n_pos") > 0, F.avg("auc")).alias("roc_auc_ovr_macro"))


def binary_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """AUC of one score against a 0/1 label; 0.0 when only one class occurs."""
    long = df.select(F.col(y).alias("_y"), F.lit(1).alias("cls"), F.col(score).alias("score"))
    per_class = _rank_sum_auc(long, F.col("_y").cast("long"))
    return per_class.select(F.coalesce("auc", F.lit(0.0)).alias("roc_auc"))


def binary_metrics(df: DataFrame, y: str, score: str, threshold: float = 0.4) -> DataFrame:
    """Recall, precision and F1 for ``score > threshold``."""
    said, is_pos = F.col(score) > threshold, F.col(y) == 1
    counts = df.agg(F.count_if(said & is_pos).alias("tp"), F.count_if(said & ~is_pos).alias("fp"),
                    F.count_if(~said & is_pos).alias("fn"), F.count("*").alias("n"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.select("n", "tp", "fp", "fn", ratio(tp, tp + fn).alias("recall"),
                         ratio(tp, tp + fp).alias("precision"),
                         ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def recall_check(metrics: DataFrame, target: float = 0.90) -> DataFrame:
    """Add ``target_recall`` and ``meets_target``; without positives the latter is NULL."""
    return metrics.withColumns({"target_recall": F.lit(target),
                                "meets_target": F.col("recall") >= target})


def ordinal_error(df: DataFrame, y: str = "y", p: str = "prediction") -> DataFrame:
    """Mean absolute error after rounding half to even and clipping to 0 .. largest class."""
    counts = df.groupBy(F.col(y).alias("y"), F.rint(p).cast("long").alias("p")).agg(
        F.count("*").alias("n"))
    top = df.select(F.max(y)).scalar()
    gap = F.abs(F.col("y") - clip(F.col("p"), 0, top))
    return counts.agg(F.sum("n").alias("n"),
                      ratio(F.sum(gap * F.col("n")), F.sum("n")).alias("mae"))


def calibration(df: DataFrame, y: str = "y", probability: str = "probability",
                bins: int = 10) -> DataFrame:
    """Per class and non-empty bin: mean predicted probability and share of positives.

    A probability on an inner edge belongs to the bin below it.
    """
    long = df.select(F.col(y).alias("_y"), F.posexplode(probability).alias("cls", "prob"))
    step = 1.0 / bins
    index = sum(((F.col("prob") > F.lit(i * step)).cast("int") for i in range(1, bins)), F.lit(0))
    return long.groupBy("cls", index.alias("bin")).agg(
        F.count("*").alias("n"), F.avg("prob").alias("mean_predicted"),
        F.avg((F.col("_y") == F.col("cls")).cast("double")).alias("positive_share"))


def multilabel_metrics(df: DataFrame, labels: list[str], truth: str = "labels",
                       predicted: str = "predicted") -> DataFrame:
    """F1 and recall per label plus micro and macro F1, one row per label and one for all."""
    sums = []
    for i in range(len(labels)):
        t, p = F.col(truth)[i] == 1, F.col(predicted)[i] == 1
        sums += [F.count_if(t & p).alias(f"tp{i}"), F.count_if(~t & p).alias(f"fp{i}"),
                 F.count_if(t & ~p).alias(f"fn{i}")]
    parts = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(name).alias("label"),
                               F.col(f"tp{i}").alias("tp"), F.col(f"fp{i}").alias("fp"),
                               F.col(f"fn{i}").alias("fn")) for i, name in enumerate(labels)])
    per_label = df.agg(*sums).select(F.inline(parts))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    f1, recall = ratio(2 * tp, 2 * tp + fp + fn), ratio(tp, tp + fn)
    each = per_label.select("label", "tp", "fp", "fn", f1.alias("f1"), recall.alias("recall"))
    tps, fps, fns = F.sum("tp"), F.sum("fp"), F.sum("fn")
    micro = ratio(2 * tps, 2 * tps + fps + fns)
    total = each.agg(F.lit("micro").alias("label"), tps.alias("tp"), fps.alias("fp"),
                     fns.alias("fn"), micro.alias("f1"), ratio(tps, tps + fns).alias("recall"))
    macro = each.agg(F.lit("macro").alias("label"), tps.alias("tp"), fps.alias("fp"),
                     fns.alias("fn"), F.avg("f1").alias("f1"), F.avg("recall").alias("recall"))
    return each.unionByName(total).unionByName(macro)


def fairness_slices(df: DataFrame, y: str = "y", p: str = "prediction",
                    slices: dict[str, Column] | None = None, min_rows: int = 0,
                    values: dict[str, list[str]] | None = None) -> DataFrame:
    """Weighted F1 and quadratic kappa per subgroup of at least ``min_rows`` rows.

    Rows are first counted per (all slice values, truth, prediction); the slices are taken from
    those counts, so the table is read once and never multiplied.
    """
    slices = slices or {"gender": F.col("gender"), "age_band": age_band(F.col("age"))}
    counted = df.groupBy(*[c.alias(name) for name, c in slices.items()],
                         F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count("*").alias("n"))
    sides = F.array(*[F.struct(F.lit(name).alias("slice_col"), F.col(name).alias("slice_val"))
                      for name in slices])
    by = ["slice_col", "slice_val"]
    conf = counted.select(F.inline(sides), "y", "p", "n").groupBy(*by, "y", "p").agg(
        F.sum("n").alias("n"))
    if values:
        test = F.lit(False)
        for name, allowed in values.items():
            test = test | ((F.col("slice_col") == name) & F.col("slice_val").isin(*allowed))
        conf = conf.filter(test)
    f1 = report_summary(class_report(conf, by), by).select(*by, "n", "weighted_f1")
    kappa = quadratic_kappa(conf, by).select(
        *by, F.when(F.col("true_classes") > 1, F.col("quadratic_kappa")).alias("quadratic_kappa"))
    return f1.filter(F.col("n") >= min_rows).join(kappa, by)


def fairness_disparity(slices: DataFrame) -> DataFrame:
    """Largest minus smallest weighted F1 per dimension, rounded to 4 digits."""
    return slices.groupBy("slice_col").agg(
        F.round(F.max("weighted_f1") - F.min("weighted_f1"), 4).alias("f1_disparity"))


def positive_weight(df: DataFrame, label: str = "si_label", factor: float = 2.0,
                    cap: float = 20.0) -> DataFrame:
    """Weight of the positive class: twice the class ratio, at most 20; 1.0 without positives."""
    counts = df.agg(F.sum(F.col(label).cast("long")).alias("n_pos"), F.count("*").alias("n"))
    weight = F.least(ratio(F.col("n") - F.col("n_pos"), F.col("n_pos"), None) * factor, F.lit(cap))
    return counts.select("n", "n_pos", F.when(F.col("n_pos") > 0, weight).otherwise(1.0)
                         .alias("positive_weight"))

"""Physical plans: what must not be shuffled, what must be pushed down or trimmed early."""

from pathlib import Path

from pyspark.sql import functions as F

from screenwell.operators.audit import verdict_summary
from screenwell.operators.cohort import allowed_forums, clean_posts
from screenwell.operators.evaluation import confusion
from screenwell.operators.sampling import top_per_group
from screenwell.plans.triage_plan import triage
from screenwell.retrieval.chunks import postings
from screenwell.session import checkpoint_folder, cut_lineage, fits, in_tasks, spread
from tests.test_scoring import records


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def stored(spark, df):
    return cut_lineage(df)


def test_triage_is_row_wise(spark):
    assert "Exchange" not in plan(triage(stored(spark, records(spark, ["a", "b"]))))


def test_postings_are_built_without_a_shuffle(spark):
    chunks = spark.createDataFrame([(1, "a", "x y x")], "chunk_id long, source string, text string")
    out = postings(stored(spark, chunks))
    assert "Exchange" not in plan(out)
    assert sorted((r.term, r.tf, r.dl) for r in out.collect()) == [("x", 2, 3), ("y", 1, 3)]


def test_text_is_cleaned_once_and_forums_reach_the_scan(spark):
    rows = [("ann", "ptsd", "a title of some length", None, "body", "1")]
    posts = stored(spark, spark.createDataFrame(
        rows, "author string, subreddit string, title string, body string, selftext string, "
              "created_utc string"))
    text = plan(clean_posts(allowed_forums(posts)))
    assert text.count("http") == 1
    assert "PushedFilters: [In(subreddit" in text or "In(subreddit" in text.split("PushedFilters")[1]


def test_top_lists_are_trimmed_before_the_shuffle(spark):
    df = stored(spark, spark.range(100).select((F.col("id") % 3).alias("g"), "id"))
    text = plan(top_per_group(df, ["g"], "id", "id", 5))
    assert "Partial" in text.split("Exchange")[1] and "WindowGroupLimit" in text


def test_counts_are_partial_and_columns_pruned(spark):
    wide = stored(spark, spark.range(10).select(
        F.lit(1).alias("y"), F.lit(1).alias("prediction"), F.lit("x").alias("other")))
    text = plan(confusion(wide))
    assert "partial_count" in text and "other" not in text.split("ReadSchema")[1]
    log = stored(spark, spark.createDataFrame([("escalate", True, "z")],
                                              "safety_verdict string, "
                                              "deterministic_escalation boolean, extra string"))
    assert "extra" not in plan(verdict_summary(log)).split("ReadSchema")[1]


def test_size_check_and_spread(spark):
    df = spark.range(100)
    assert fits(df, 100) and not fits(df, 99)
    one = stored(spark, df.coalesce(1))
    assert spread(one, "id").rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = df.repartition(50)
    assert spread(many, "id") is many
    assert spread(one, "id", rows=4).rdd.getNumPartitions() == 25
    assert in_tasks(one, rows=4).rdd.getNumPartitions() == 25 and in_tasks(one, rows=100) is one


def test_generated_rows_come_in_several_tasks(spark, tmp_path):
    from workload.q_learning import ids

    spark.range(90).select(F.col("id").alias("c_custkey")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    rows = ids(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r.row_id for r in rows.collect()) == list(range(90))


def test_stored_tables_lie_in_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_folder(spark) == folder
    assert cut_lineage(spark.range(5)).count() == 5
    assert any(p.name.startswith("cut-") for p in Path(folder).glob("screenwell-*/*"))

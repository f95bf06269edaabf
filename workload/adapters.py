"""Domain tables derived from the driver tables, and the same derivations as SQL text.

Every derived table has one row per row of a driver table, so work grows with the data.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwell.fixed_texts import SAFETY_CASES
from screenwell.fixed_values import (ALL_ITEMS, BAND_SCORES, GAD_BANDS, GAD_ITEMS, PHQ_BANDS,
                                     PHQ_ITEMS, SUBREDDIT_LABELS)
from screenwell.functions.hashing import bucket
from screenwell.operators.triage import score_record
from screenwell.retrieval.chunks import chunk_text, number_chunks
from screenwell.session import cut_lineage, own_folder, spread
from screenwell.sources.index_store import create_index, load_index

# Multipliers that spread the 16 item values (fixed values of the adapter).
PRIMES = [5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61]
GENDERS = ["female", "male", "nonbinary"]
EDUCATIONS = ["primary", "secondary", "undergrad", "postgrad"]
FORUMS = [*SUBREDDIT_LABELS, "offtopic"]
CASE_TEXTS = [c[1] for c in SAFETY_CASES]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared location."""
    return f"{own_folder(spark)}/{name}-{uuid.uuid4().hex}"


def text_sql(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def list_sql(values: list[str]) -> str:
    return "[" + ", ".join(text_sql(v) for v in values) + "]"


def _pick(values: list[str], index) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


# --- screening records from events -------------------------------------------------------------

def add_record_columns(events: DataFrame) -> DataFrame:
    """Record columns for rows of ``events``; works on streams too."""
    e, u = F.col("event_id"), F.col("user_id")
    base = F.floor(F.col("value") / 60)
    items = {}
    for k, (item, p) in enumerate(zip(ALL_ITEMS, PRIMES, strict=True), start=1):
        spread = base + ((e * p + u * k) % 97) % 3 - 1
        items[item] = F.greatest(F.lit(0), F.least(F.lit(3), spread)).cast("int")
    b = bucket(u.cast("string"), 100, "md5")
    return events.select(
        e.alias("record_id"), u.alias("user_id"), F.col("ts").cast("timestamp").alias("ts"),
        "event_type", *[c.alias(n) for n, c in items.items()],
        (18 + u % 63).cast("int").alias("age"), _pick(GENDERS, u % 3).alias("gender"),
        _pick(EDUCATIONS, u % 4).alias("education"), (u % 8 == 0).alias("prior_diagnosis"),
        ((u % 8 == 0) & (e % 2 == 0)).alias("on_medication"),
        _pick(CASE_TEXTS, e % 16).alias("narrative"),
        F.when(b < 80, "train").when(b < 90, "val").otherwise("test").alias("split"))


def records(spark: SparkSession, sf: str) -> DataFrame:
    return add_record_columns(spread(table(spark, sf, "events"), "event_id"))


def scored(spark: SparkSession, sf: str) -> DataFrame:
    return score_record(records(spark, sf))


def bucket_sql(expr: str) -> str:
    return f"(('0x' || substr(md5({expr}), 1, 8))::BIGINT % 100)"


def split_sql(expr: str) -> str:
    b = bucket_sql(expr)
    return f"CASE WHEN {b} < 80 THEN 'train' WHEN {b} < 90 THEN 'val' ELSE 'test' END"


def band_sql(expr: str, bands: list[tuple]) -> str:
    whens = " ".join(f"WHEN {expr} <= {hi} THEN '{name}'" for _, hi, name in bands[:-1])
    return f"CASE {whens} ELSE '{bands[-1][2]}' END"


def case_sql(expr: str, table_: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {text_sql(k)} THEN {v}" for k, v in table_.items())
    return f"CASE {expr} {whens} ELSE {default} END"


_ITEM_SQL = ",\n    ".join(
    f"greatest(0, least(3, floor(value / 60)::BIGINT"
    f" + ((event_id * {p} + user_id * {k}) % 97) % 3 - 1)) AS {item}"
    for k, (item, p) in enumerate(zip(ALL_ITEMS, PRIMES, strict=True), start=1))

REC = f"""rec AS (
  SELECT event_id AS record_id, user_id, ts, event_type,
    {_ITEM_SQL},
    18 + user_id % 63 AS age, {list_sql(GENDERS)}[user_id % 3 + 1] AS gender,
    {list_sql(EDUCATIONS)}[user_id % 4 + 1] AS education,
    user_id % 8 = 0 AS prior_diagnosis, user_id % 8 = 0 AND event_id % 2 = 0 AS on_medication,
    {list_sql(CASE_TEXTS)}[event_id % 16 + 1] AS narrative,
    {split_sql('user_id::VARCHAR')} AS split
  FROM events)"""

PHQ_SUM = " + ".join(PHQ_ITEMS)
GAD_SUM = " + ".join(GAD_ITEMS)
SCO = f"""{REC}, tot AS (
  SELECT *, {PHQ_SUM} AS phq9_total, {GAD_SUM} AS gad7_total FROM rec), bnd AS (
  SELECT *, {band_sql('phq9_total', PHQ_BANDS)} AS phq9_band,
    {band_sql('gad7_total', GAD_BANDS)} AS gad7_band FROM tot), sco AS (
  SELECT *, {case_sql('phq9_band', BAND_SCORES)}::DOUBLE AS severity_score FROM bnd)"""

# --- audit log from events ---------------------------------------------------------------------


def audit_log(spark: SparkSession, sf: str) -> DataFrame:
    """One log record per event; verdict by event type."""
    df = scored(spark, sf)
    return add_log_columns(df)


def add_log_columns(df: DataFrame) -> DataFrame:
    kind = F.col("event_type")
    return df.withColumns({
        "log_id": F.format_string("log-%010d", "record_id"),
        "timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        "model_version": F.lit("rules-1"),
        "safety_verdict": F.when(kind == "error", "escalate").when(kind == "purchase", "monitor")
        .otherwise("routine"),
        "deterministic_escalation": (kind == "error") & (F.col("record_id") % 3 != 0),
        "suicidal_ideation_prob": F.when(F.col("phq9_suicidal_ideation") > 0, 0.9)
        .otherwise(0.05)})


LOG = f"""{SCO}, log AS (
  SELECT *, printf('log-%010d', record_id) AS log_id,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", 'rules-1' AS model_version,
    CASE event_type WHEN 'error' THEN 'escalate' WHEN 'purchase' THEN 'monitor'
      ELSE 'routine' END AS safety_verdict,
    event_type = 'error' AND record_id % 3 <> 0 AS deterministic_escalation,
    CASE WHEN phq9_suicidal_ideation > 0 THEN 0.9 ELSE 0.05 END::DOUBLE
      AS suicidal_ideation_prob
  FROM sco)"""

# --- predictions from records ------------------------------------------------------------------
BAND_CODE = {"none": 0, "mild": 1, "moderate": 2, "moderately_severe": 3, "severe": 4}


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(record_id, y, prediction, probability, gender, age) with some errors by arithmetic.

    Checkpointed, as predictions are a stored table that evaluation reads more than once.
    """
    df = scored(spark, sf)
    r = F.col("record_id")
    y = F.lit(4)
    for name, code in BAND_CODE.items():
        y = F.when(F.col("phq9_band") == name, code).otherwise(y)
    slip = (r * 13 + F.col("user_id")) % 7
    shifted = F.col("y") + F.when(slip == 0, 1).when(slip == 1, -1).otherwise(0)
    df = df.withColumn("y", y).withColumn("prediction", F.greatest(F.lit(0), F.least(
        F.lit(4), shifted)))
    weights = [1 + (r * (c + 3)) % 5 + F.when(F.col("prediction") == c, 8).otherwise(0)
               for c in range(5)]
    total = sum(weights[1:], weights[0])
    shares = F.array(*[w / total.cast("double") for w in weights])
    return cut_lineage(df.select("record_id", "y", "prediction", "gender", "age", "split",
                                 shares.alias("probability")))


_W = [f"(1 + (record_id * {c + 3}) % 5 + CASE WHEN prediction = {c} THEN 8 ELSE 0 END)"
      for c in range(5)]
PRED = f"""{SCO}, cod AS (
  SELECT *, {case_sql('phq9_band', BAND_CODE)} AS y FROM sco), shf AS (
  SELECT *, greatest(0, least(4, y + CASE (record_id * 13 + user_id) % 7 WHEN 0 THEN 1
    WHEN 1 THEN -1 ELSE 0 END)) AS prediction FROM cod), pred AS (
  SELECT record_id, y, prediction, gender, age, split,
    [{', '.join(f"{w} / ({' + '.join(_W)})::DOUBLE" for w in _W)}] AS probability FROM shf)"""

# --- posts from documents ----------------------------------------------------------------------


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """Posts with missing titles and bodies, links, mentions, unknown forums, deleted authors."""
    d = F.col("doc_id")
    text = F.col("text")
    title = F.concat(F.lit("Post "), "lang", F.lit(" see http://x.example.com/"),
                     d.cast("string"), F.lit(" and /r/"), "source")
    return spread(table(spark, sf, "documents"), "doc_id").select(
        F.when(d % 41 == 0, "[deleted]").when(d % 43 != 0, F.concat(
            F.lit("u"), (d % 97).cast("string"))).alias("author"),
        _pick(FORUMS, d % len(FORUMS)).alias("subreddit"),
        F.when(d % 5 != 0, title).alias("title"),
        F.when(d % 11 == 0, "[removed]").when(d % 7 != 0, text).alias("body"),
        F.when((d % 7 == 0) & (d % 11 != 0), text).alias("selftext"),
        (F.lit(1700000000) + d * 60).cast("string").alias("created_utc"))


POSTS = f"""posts AS (
  SELECT CASE WHEN doc_id % 41 = 0 THEN '[deleted]' WHEN doc_id % 43 <> 0
      THEN 'u' || (doc_id % 97) END AS author,
    {list_sql(FORUMS)}[doc_id % {len(FORUMS)} + 1] AS subreddit,
    CASE WHEN doc_id % 5 <> 0 THEN 'Post ' || lang || ' see http://x.example.com/' || doc_id
      || ' and /r/' || source END AS title,
    CASE WHEN doc_id % 11 = 0 THEN '[removed]' WHEN doc_id % 7 <> 0 THEN text END AS body,
    CASE WHEN doc_id % 7 = 0 AND doc_id % 11 <> 0 THEN text END AS selftext,
    (1700000000 + doc_id * 60)::VARCHAR AS created_utc
  FROM documents)"""


def clean_sql(expr: str) -> str:
    blanks = r"[\s\x0b]+"
    return (f"trim(regexp_replace(regexp_replace(regexp_replace({expr}, "
            rf"'http[^\s\x0b]+|www\.[^\s\x0b]+', ' ', 'g'), '/?[ru]/\w+', ' ', 'g'), "
            f"'{blanks}', ' ', 'g'), ' ')")


CLEAN = f"""{POSTS}, clean AS (
  SELECT *, {clean_sql("coalesce(title, '') || ' ' || coalesce(body, selftext, '')")} AS text
  FROM posts WHERE author <> '[deleted]'), kept AS (
  SELECT * FROM clean WHERE length(text) >= 20 AND text NOT IN ('[deleted]', '[removed]'))"""

# --- documents as search corpus ----------------------------------------------------------------


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the language as source."""
    docs = spread(table(spark, sf, "documents"), "doc_id")
    return docs.select("doc_id", F.col("lang").alias("source"), "text")


def search_queries(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"),
                                                F.col("text").alias("query_text"))


STORED: dict[tuple[str, str], str] = {}


def corpus_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks with metadata: the document's first 60 characters as title on two of three."""
    docs = corpus(spark, sf).withColumns({
        "pmid": F.col("doc_id").cast("string"),
        "title": F.when(F.col("doc_id") % 3 != 0, F.substring("text", 1, 60)),
        "disorder": F.when(F.col("doc_id") % 4 != 0, F.concat(F.lit("topic "), F.col("source")))})
    return number_chunks(chunk_text(docs)).drop("chunk_no", "doc_id")


def index_folder(spark: SparkSession, sf: str, anew: bool = False) -> str:
    """The stored index of all documents: built by the first query that asks, or ``anew``, then loaded."""
    key = spark.sparkContext.applicationId, sf
    if anew or key not in STORED:
        folder = fresh_folder(spark, "index")
        create_index(spark, folder, corpus_chunks(spark, sf))
        STORED[key] = folder
    return STORED[key]


def corpus_index(spark: SparkSession, sf: str, sources: list[str] | None = None):
    return load_index(spark, index_folder(spark, sf), sources)


# White space as the tokenizer sees it, for an engine whose \s is ASCII only.
BLANK_SQL = (r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}"
             r"\x{205f}\x{3000}]+")


def words_sql(expr: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({expr}), '{BLANK_SQL}'), lambda x: x <> '')"


CHUNKS = f"""chunks AS (
  SELECT lang AS source, doc_id, g AS chunk_no, doc_id * 1000000 + g AS chunk_id,
    substr(text, g * 448 + 1, 512) AS text
  FROM documents, unnest(range(0, (length(text) + 447) // 448)) AS r(g))"""
BM25 = f"""{CHUNKS}, toks AS (
  SELECT source, chunk_id, {words_sql('text')} AS w FROM chunks), src AS (
  SELECT source, count(*) AS n_chunks, avg(len(w)) AS avg_dl FROM toks GROUP BY 1), post AS (
  SELECT source, chunk_id, term, count(*) AS tf, any_value(dl) AS dl FROM (
    SELECT source, chunk_id, len(w) AS dl, unnest(w) AS term FROM toks)
  GROUP BY 1, 2, 3), dfs AS (
  SELECT source, term, count(*) AS df FROM post GROUP BY 1, 2), raw AS (
  SELECT dfs.*, n_chunks, avg_dl, ln(n_chunks - df + 0.5) - ln(df + 0.5) AS r
  FROM dfs JOIN src USING (source)), stats AS (
  SELECT source, term, df, n_chunks, avg_dl, CASE WHEN r < 0
    THEN 0.25 * avg(r) OVER (PARTITION BY source) ELSE r END AS idf FROM raw), qt AS (
  SELECT query_id, term, count(*) AS times FROM (
    SELECT item_id AS query_id, unnest({words_sql('text')}) AS term FROM benchmark)
  GROUP BY 1, 2), sums AS (
  SELECT query_id, source, chunk_id, round(sum(times * idf * tf * 2.5
    / (tf + 1.5 * (0.25 + 0.75 * dl / avg_dl))), 6) AS score
  FROM qt JOIN stats USING (term) JOIN post USING (source, term) GROUP BY 1, 2, 3), bm AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, source
    ORDER BY score DESC, chunk_id DESC) AS rank
  FROM sums WHERE score > 0 QUALIFY rank <= 20)"""

"""Posts, weak labels, files, chunks and bibliographic records."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenwell import fixed_values as V
from screenwell.fixed_texts import SUMMARIES
from screenwell.functions import text
from screenwell.operators import cohort, labels, sampling
from screenwell.plans import cohort_job
from screenwell.retrieval import chunks
from screenwell.sources import bibliography, files
from workload import adapters as A
from workload.registry import query

LABEL_MAP = {k: A.text_sql(v) for k, v in V.SUBREDDIT_LABELS.items()}
ALLOWED = ", ".join(A.text_sql(k) for k in V.SUBREDDIT_LABELS)


@query("p01_p02_clean_posts", f"""WITH {A.CLEAN}
SELECT author, subreddit, created_utc, md5(text) AS text_md5, length(text) AS n FROM kept""")
def _(spark, sf):
    return cohort.clean_posts(A.posts(spark, sf)).select(
        "author", "subreddit", "created_utc", F.md5("text").alias("text_md5"),
        F.length("text").cast("long").alias("n"))


@query("p02_strict_markers", f"""WITH {A.CLEAN}
SELECT author, created_utc FROM kept
WHERE trim(coalesce(body, selftext, '')) NOT IN ('[deleted]', '[removed]')""")
def _(spark, sf):
    return cohort.clean_posts(A.posts(spark, sf), strict=True).select("author", "created_utc")


@query("p01_clean_pages", f"""SELECT page_id,
  md5({A.clean_sql("url || ' ' || html")}) AS text_md5 FROM pages""")
def _(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", F.md5(text.clean_text(
        F.col("url"), F.col("html"))).alias("text_md5"))


@query("p03_label_posts", f"""WITH {A.POSTS}
SELECT created_utc, {A.case_sql('subreddit', LABEL_MAP)} AS label,
  {A.case_sql('subreddit', LABEL_MAP)} AS table_label FROM posts""")
def _(spark, sf):
    rows = spark.createDataFrame(list(V.SUBREDDIT_LABELS.items()), "subreddit string, label string")
    both = cohort.label_from_table(A.posts(spark, sf), rows).withColumnRenamed(
        "label", "table_label")
    return cohort.label_posts(both).select("created_utc", "label", "table_label")


@query("p07_drop_unlabelled", f"""WITH {A.POSTS}
SELECT created_utc FROM posts WHERE body IS NOT NULL AND subreddit IS NOT NULL""")
def _(spark, sf):
    return cohort.drop_unlabelled(A.posts(spark, sf), ["body", "subreddit"]).select("created_utc")


@query("a06_first_copy_of_documents", """SELECT source, lang, doc_id, n_chars FROM documents
QUALIFY row_number() OVER (PARTITION BY source, lang, text ORDER BY doc_id) = 1""")
def _(spark, sf):
    docs = A.table(spark, sf, "documents")
    return cohort.first_copy(docs, ["source", "lang", "text"], [F.col("doc_id")]).drop("text")


COHORT = f"""{A.CLEAN}, lab AS (
  SELECT author, subreddit, {A.case_sql('subreddit', LABEL_MAP)} AS label, text, created_utc
  FROM kept WHERE subreddit IN ({ALLOWED})
  QUALIFY row_number() OVER (PARTITION BY author, text ORDER BY created_utc, subreddit) = 1)"""


@query("a06_p04_cohort_rows", f"""WITH {COHORT}
SELECT author, subreddit, label, created_utc, md5(text) AS text_md5,
  {A.split_sql('author')} AS split FROM lab""")
def _(spark, sf):
    rows = cohort_job.cohort(A.posts(spark, sf)).drop("split")
    split = cohort.split_by_user(rows, method="md5")
    return cohort.existing_columns(split).withColumn("text_md5", F.md5("text")).drop("text")


@query("s01_s02_cohort_job", f"""WITH {COHORT}
SELECT label, count(*) AS n FROM lab GROUP BY 1""")
def _(spark, sf):
    """CSV files of both headers written, read, cleaned, written by split, summarised."""
    posts = A.posts(spark, sf)
    base = A.fresh_folder(spark, "posts")
    body = posts.filter(F.col("selftext").isNull()).drop("selftext")
    own = posts.filter(F.col("selftext").isNotNull()).drop("body")
    for name, part in (("body", body), ("selftext", own)):
        (part.write.option("header", True).option("escape", '"').option("quoteAll", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{base}/{name}"))
    totals = cohort_job.run(spark, [f"{base}/body/*.csv", f"{base}/selftext/*.csv"],
                            f"{base}/cohort")
    return totals.filter(F.col("label").isNotNull()).groupBy("label").agg(
        F.sum("n").alias("n"))


@query("s07_read_one_split", f"""WITH {A.REC}
SELECT record_id, age FROM rec WHERE split = 'val'""")
def _(spark, sf):
    path = A.fresh_folder(spark, "records")
    files.write_cohort(A.records(spark, sf), path)
    return files.read_split(spark, path, "val").select("record_id", "age")


# --- weak labels -------------------------------------------------------------------------------
# The clinical forum lists with a vocabulary that occurs in the tables.
WORDS = {"suicidal_ideation": ["the", "und"], "insomnia": ["ation", "eau"],
         "substance_use": ["sch"], "anhedonia": ["que ", "ción"],
         "hopelessness": ["heit", "ing "]}


def label_sql(name: str, words: dict) -> str:
    forums = [f for f, listed in V.SUBREDDIT_SYMPTOMS.items() if name in listed]
    tests = [f"subreddit IN ({', '.join(A.text_sql(f) for f in forums)})"] if forums else []
    tests += [f"contains(lower(t), {A.text_sql(w)})" for w in words.get(name, [])]
    return f"coalesce(({' OR '.join(tests) or 'false'}), false)::INT"


LABELLED = f"""{A.POSTS}, txt AS (
  SELECT *, coalesce(body, selftext, '') AS t FROM posts), wk AS (
  SELECT created_utc, [{', '.join(label_sql(s, WORDS) for s in V.SYMPTOMS)}] AS labels FROM txt)"""


def labelled_posts(spark, sf):
    df = A.posts(spark, sf).withColumn("text", F.coalesce("body", "selftext", F.lit("")))
    return labels.weak_labels(df, keywords=WORDS)


@query("t19_f06_f19_weak_labels", f"""WITH {LABELLED}
SELECT created_utc, array_to_string(labels, '') AS labels, labels[3] AS si_label FROM wk""")
def _(spark, sf):
    return labelled_posts(spark, sf).select(
        "created_utc", F.array_join(F.col("labels").cast("array<string>"), "").alias("labels"),
        "si_label")


CLINICAL = f"""{A.REC}, txt AS (
  SELECT record_id, narrative AS t, {A.list_sql(A.FORUMS)}[record_id % {len(A.FORUMS)} + 1]
    AS subreddit FROM rec), wk AS (
  SELECT record_id,
    [{', '.join(label_sql(s, V.SYMPTOM_KEYWORDS) for s in V.SYMPTOMS)}] AS labels FROM txt)"""


def clinical_texts(spark, sf):
    forum = F.element_at(F.array(*[F.lit(f) for f in A.FORUMS]),
                         (F.col("record_id") % len(A.FORUMS) + 1).cast("int"))
    return A.records(spark, sf).select("record_id", F.col("narrative").alias("text"),
                                       forum.alias("subreddit"), "split")


@query("t19_clinical_labels", f"""WITH {CLINICAL}
SELECT array_to_string(labels, '') AS labels, count(*) AS n FROM wk GROUP BY 1""")
def _(spark, sf):
    return labels.weak_labels(clinical_texts(spark, sf)).groupBy(F.array_join(
        F.col("labels").cast("array<string>"), "").alias("labels")).agg(F.count("*").alias("n"))


@query("u05_f18_label_union", f"""WITH {CLINICAL}
SELECT record_id, array_to_string(labels, '') AS labels,
  list_sum(labels)::BIGINT AS set_size FROM wk""")
def _(spark, sf):
    return labels.label_union(clinical_texts(spark, sf)).select(
        "record_id", F.array_join(F.col("labels").cast("array<string>"), "").alias("labels"),
        F.size("symptom_set").cast("long").alias("set_size"))


# --- chunks and words --------------------------------------------------------------------------

@query("r01_chunks", f"""WITH {A.CHUNKS}
SELECT chunk_id, chunk_no, md5(text) AS text_md5, length(text) AS n FROM chunks""")
def _(spark, sf):
    out = chunks.number_chunks(chunks.chunk_text(A.corpus(spark, sf)))
    return out.select("chunk_id", "chunk_no", F.md5("text").alias("text_md5"),
                      F.length("text").alias("n"))


@query("r02_document_text", """SELECT page_id, md5(url || chr(10) || chr(10) || html) AS text_md5
FROM pages""")
def _(spark, sf):
    return A.table(spark, sf, "pages").select("page_id", F.md5(text.document_text(
        F.col("url"), F.col("html"))).alias("text_md5"))


@query("f05_words", f"""SELECT doc_id, len({A.words_sql('text')}) AS n_words,
  {A.words_sql('text')}[1] AS first_word FROM documents""")
def _(spark, sf):
    w = text.words(F.col("text"))
    return A.table(spark, sf, "documents").select(
        "doc_id", F.size(w).alias("n_words"), F.get(w, F.lit(0)).alias("first_word"))


@query("f04_f07_f08_sentences", r"""SELECT doc_id, len(s) AS n_sentences,
  substr(s[1], 1, 80) AS first_sentence, md5(array_to_string(s, '|')) AS joined_md5 FROM (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?])""" + A.BLANK_SQL
       + r"""', '\1' || chr(1), 'g'), chr(1)) AS s FROM documents)""")
def _(spark, sf):
    s = text.sentences(F.col("text"))
    return A.table(spark, sf, "documents").select(
        "doc_id", F.size(s).alias("n_sentences"),
        F.substring(F.get(s, F.lit(0)), 1, 80).alias("first_sentence"),
        F.md5(F.array_join(s, "|")).alias("joined_md5"))


@query("f02_f03_regex_search", r"""SELECT page_id, regexp_matches(html, '(?i)<title>') AS titled,
  regexp_matches(url, '(?i)^https') AS secure, length(trim(url)) AS n FROM pages""")
def _(spark, sf):
    return A.table(spark, sf, "pages").select(
        "page_id", F.col("html").rlike(text.any_of(["<title>"])).alias("titled"),
        F.col("url").rlike(text.any_of(["^https"])).alias("secure"),
        F.length(F.trim("url")).alias("n"))


# --- files -------------------------------------------------------------------------------------

@query("s05_s06_feature_table", f"""WITH {A.SCO}
SELECT record_id, phq9_total, phq9_band, phq3_sleep + phq4_fatigue + phq5_appetite
  AS somatic_cluster FROM sco""")
def _(spark, sf):
    from screenwell.operators.features import add_derived

    path = A.fresh_folder(spark, "features")
    files.write_table(add_derived(A.scored(spark, sf)), path)
    return files.read_table(spark, path).select("record_id", "phq9_total", "phq9_band",
                                                "somatic_cluster")


BUILTIN = ", ".join("(" + ", ".join(A.text_sql(v) for v in row) + ")" for row in SUMMARIES)


@query("s10_u03_custom_summaries", f"""SELECT disorder, icd10, md5(criteria_summary) AS criteria,
  source FROM (VALUES {BUILTIN}) AS t(disorder, icd10, criteria_summary, source)
UNION ALL SELECT 'doc ' || doc_id, NULL, md5(text), source FROM documents""")
def _(spark, sf):
    path = A.fresh_folder(spark, "summaries")
    A.table(spark, sf, "documents").select(
        F.concat(F.lit("doc "), "doc_id").alias("disorder"),
        F.col("text").alias("criteria_summary"), "source").write.json(path)
    return files.read_summaries(spark, path).select(
        "disorder", "icd10", F.md5("criteria_summary").alias("criteria"), "source")


def bibliography_replies(spark, sf):
    """One reply per document in the shapes a literature service answers with."""
    d = F.col("doc_id")
    pmid = F.struct(F.concat(F.lit("pm"), d.cast("string")).alias("#text"))
    plain_title = F.concat(F.lit("Title "), d.cast("string"))

    def article(title, abstract):
        body = F.struct(title.alias("ArticleTitle"),
                        F.struct(abstract.alias("AbstractText")).alias("Abstract"))
        return F.struct(F.struct(pmid.alias("PMID"), body.alias("Article"))
                        .alias("MedlineCitation"))

    def reply(articles):
        return F.to_json(F.struct(F.struct(articles.alias("PubmedArticle"))
                                  .alias("PubmedArticleSet")))

    held = F.struct(F.col("text").alias("#text"))
    parts = F.array(held, F.struct(F.lit("second part").alias("#text")))
    return A.table(spark, sf, "documents").select(
        "doc_id", F.when(d % 4 == 0, reply(F.array(article(plain_title, F.col("text")))))
        .when(d % 4 == 1, reply(article(F.struct(plain_title.alias("#text")), held)))
        .when(d % 4 == 2, reply(F.array(article(plain_title, parts), article(
            plain_title, F.array(F.struct(F.lit("too short").alias("#text")))))))
        .otherwise(reply(F.array(article(plain_title, F.array(F.col("text"), F.lit("b"))))))
        .alias("json"))


@query("s13_p11_bibliography", """SELECT doc_id, 'pm' || doc_id AS pmid, 'Title ' || doc_id
  AS title, md5(abstract) AS abstract_md5 FROM (
  SELECT doc_id, CASE doc_id % 4 WHEN 2 THEN text || ' second part' WHEN 3 THEN text || ' b'
    ELSE text END AS abstract FROM documents) WHERE length(abstract) > 50""")
def _(spark, sf):
    return bibliography.articles(bibliography_replies(spark, sf)).select(
        "doc_id", "pmid", "title", F.md5("abstract").alias("abstract_md5"))


# --- samples and top lists ---------------------------------------------------------------------

@query("l06_l08_fixed_sample", """SELECT doc_id, lang FROM documents
ORDER BY md5('42/' || doc_id), doc_id LIMIT 2000""")
def _(spark, sf):
    return sampling.fixed_sample(A.table(spark, sf, "documents"), "doc_id", 2000,
                                 method="md5").select("doc_id", "lang")


@query("w01_l02_top_per_group", """SELECT l_returnflag, l_shipmode_key, l_extendedprice,
  row_id, rank FROM (SELECT l_returnflag, l_linestatus AS l_shipmode_key, l_extendedprice,
    l_orderkey * 10 + l_linenumber AS row_id, row_number() OVER (
      PARTITION BY l_returnflag, l_linestatus
      ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber DESC) AS rank FROM lineitem)
WHERE rank <= 20""")
def _(spark, sf):
    lines = A.table(spark, sf, "lineitem").select(
        "l_returnflag", F.col("l_linestatus").alias("l_shipmode_key"), "l_extendedprice",
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_id"))
    return sampling.top_per_group(lines, ["l_returnflag", "l_shipmode_key"], "l_extendedprice",
                                  "row_id", 20)


@query("u04_repeat_questions", """SELECT item_id, c * (SELECT count(*) FROM benchmark) + item_id
  AS position FROM benchmark, range(3) AS r(c)""")
def _(spark, sf):
    items = A.table(spark, sf, "benchmark").select("item_id")
    return sampling.repeat_rows(items, "item_id", 3 * items.count())

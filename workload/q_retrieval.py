"""Corpus statistics, keyword and vector search, hybrid retrieval, answers."""

from __future__ import annotations

from pyspark.sql import functions as F

from screenwell import fixed_values as V
from screenwell.plans.retrieval_plan import answer_queries, evaluate, retrieve
from screenwell.retrieval import bm25, chunks, dense, hybrid
from screenwell.retrieval.blocks import block_rows
from screenwell.sources import index_store
from workload import adapters as A
from workload.registry import query

DIM = 64


@query("r03_postings", f"""WITH {A.BM25}
SELECT source, chunk_id, term, tf, dl FROM post""")
def _(spark, sf):
    return chunks.postings(A.corpus_chunks(spark, sf))


@query("a20_corpus_stats", f"""WITH {A.BM25}
SELECT source, term, df, n_chunks, round(avg_dl, 6) AS avg_dl, round(idf, 6) AS idf FROM stats""")
def _(spark, sf):
    return A.corpus_index(spark, sf).term_stats.select(
        "source", "term", "df", "n_chunks", F.round("avg_dl", 6).alias("avg_dl"),
        F.round("idf", 6).alias("idf"))


@query("r04_j04_bm25_top", f"""WITH {A.BM25}
SELECT query_id, source, chunk_id, score, rank FROM bm""")
def _(spark, sf):
    index = A.corpus_index(spark, sf)
    return bm25.bm25_top(index.postings, index.term_stats, bm25.query_terms(A.search_queries(spark, sf)))


def vectors(spark, sf):
    return A.table(spark, sf, "embeddings").select(
        F.lit("all").alias("source"), F.col("vec_id").alias("chunk_id"),
        F.col("embedding").alias("vector"), "label")


PROTOTYPE = """dims AS (
  SELECT vec_id, label, i, embedding[i]::DOUBLE AS x FROM embeddings, range(1, 65) AS r(i)), mean AS (
  SELECT label, i, avg(x) AS m FROM dims GROUP BY 1, 2), proto AS (
  SELECT label AS query_id, i, m / sqrt(sum(m * m) OVER (PARTITION BY label)) AS q FROM mean)"""


@query("r06_j03_l02_dense_top", f"""WITH {PROTOTYPE}, dots AS (
  SELECT query_id, 'all' AS source, vec_id AS chunk_id, round(sum(x * q), 6) AS score
  FROM dims JOIN proto USING (i) GROUP BY 1, 2, 3)
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, chunk_id DESC) AS rank
FROM dots QUALIFY rank <= 20""")
def _(spark, sf):
    """Nearest vectors of every label's mean direction, over all vectors."""
    rows = vectors(spark, sf)
    means = rows.groupBy(F.col("label").alias("query_id")).agg(F.array(*[
        F.avg(F.col("vector")[i].cast("double")) for i in range(DIM)]).alias("vector"))
    queries = means.withColumn("vector", dense.unit(F.col("vector")))
    return dense.dense_top(rows, queries)


SLOT = f"(('0x' || substr(md5(term), 1, 8))::BIGINT % {DIM})"
EMBED = f"""cb AS (
  SELECT source, chunk_id, {SLOT} AS slot, sum(tf) AS c FROM post GROUP BY 1, 2, 3), cn AS (
  SELECT chunk_id, sqrt(sum(c * c)) AS norm FROM cb GROUP BY 1), qb AS (
  SELECT query_id, {SLOT} AS slot, sum(times) AS c FROM qt GROUP BY 1, 2), qn AS (
  SELECT query_id, sqrt(sum(c * c)) AS norm FROM qb GROUP BY 1), dot AS (
  SELECT query_id, chunk_id, sum(cb.c * qb.c) AS d FROM cb JOIN qb USING (slot)
  GROUP BY 1, 2), cos AS (
  SELECT n.query_id, k.source, k.chunk_id,
    round(coalesce(d / (cn.norm * n.norm), 0), 6) AS score
  FROM qn n CROSS JOIN chunks k LEFT JOIN cn USING (chunk_id)
  LEFT JOIN dot ON dot.query_id = n.query_id AND dot.chunk_id = k.chunk_id), dn AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, source
    ORDER BY score DESC, chunk_id DESC) AS rank FROM cos QUALIFY rank <= 20)"""


@query("r05_x04_embed_text", f"""WITH w AS (
  SELECT item_id, unnest({A.words_sql('text')}) AS term FROM benchmark), b AS (
  SELECT item_id, {SLOT} AS slot, count(*) AS c FROM w GROUP BY 1, 2)
SELECT item_id, slot, round(c / sqrt(sum(c * c) OVER (PARTITION BY item_id)), 6) AS weight
FROM b""")
def _(spark, sf):
    embedded = dense.embed(A.table(spark, sf, "benchmark"), "text")
    long = embedded.select("item_id", F.posexplode("vector").alias("slot", "weight"))
    return long.filter("weight > 0").withColumn("weight", F.round("weight", 6))


def hits_sql(copy: str) -> str:
    """Both hit lists merged; of hits with the same ``copy`` the first stays."""
    return f"""{A.BM25}, {EMBED}, cand AS (
  SELECT query_id, source, chunk_id, score, rank, 0 AS origin FROM bm UNION ALL
  SELECT query_id, source, chunk_id, score, rank, 1 FROM dn), merged AS (
  SELECT cand.*, k.text, k.doc_id FROM cand JOIN chunks k USING (source, chunk_id)
  QUALIFY row_number() OVER (PARTITION BY query_id, source, {copy}
    ORDER BY origin, rank) = 1)"""


HITS = hits_sql("k.text")


def merged_hits(spark, sf, prefix):
    index, queries = A.corpus_index(spark, sf), A.search_queries(spark, sf)
    keyword = bm25.bm25_top(index.postings, index.term_stats, bm25.query_terms(queries))
    near = dense.dense_top(index.vectors, dense.embed(queries, "query_text"))
    return hybrid.merge_hits(keyword, near, index.chunks, prefix=prefix).select(
        "query_id", "source", "chunk_id", "origin", "rank", "score")


@query("r07_j01_w02_u01_u02_merge_hits", f"""WITH {hits_sql("substr(k.text, 1, 80)")}
SELECT query_id, source, chunk_id, origin, rank, score FROM merged""")
def _(spark, sf):
    """Copies by their first 80 characters."""
    return merged_hits(spark, sf, 80)


@query("r07_merge_hits_by_text", f"""WITH {HITS}
SELECT query_id, source, chunk_id, origin, rank, score FROM merged""")
def _(spark, sf):
    """Copies by the whole text."""
    return merged_hits(spark, sf, None)


QW = A.words_sql("b.text")
RANKED = f"""{HITS}, pair AS (
  SELECT m.* EXCLUDE (score), coalesce(len(list_intersect(list_distinct({QW}),
    {A.words_sql('m.text')}))::DOUBLE / nullif(len(list_distinct({QW})), 0), 0) AS score
  FROM merged m JOIN benchmark b ON b.item_id = m.query_id), fin AS (
  SELECT *, row_number() OVER (PARTITION BY query_id
    ORDER BY score DESC, source, origin, rank) AS final_rank FROM pair QUALIFY final_rank <= 5)"""


@query("r08_rerank", f"""WITH {RANKED}
SELECT query_id, source, chunk_id, round(score, 6) AS score, final_rank FROM fin""")
def _(spark, sf):
    found = retrieve(A.search_queries(spark, sf), A.corpus_index(spark, sf))
    return found.select("query_id", "source", "chunk_id", F.round("score", 6).alias("score"),
                        "final_rank")


@query("r08_raw_score_order", f"""WITH {HITS}
SELECT query_id, source, chunk_id, score, row_number() OVER (
  PARTITION BY query_id ORDER BY score DESC, source, origin, rank) AS final_rank
FROM merged QUALIFY final_rank <= 5""")
def _(spark, sf):
    found = retrieve(A.search_queries(spark, sf), A.corpus_index(spark, sf), scorer=None)
    return found.select("query_id", "source", "chunk_id", "score", "final_rank")


CITED = f"""{RANKED}, meta AS (
  SELECT f.*, d.doc_id::VARCHAR AS pmid,
    CASE WHEN d.doc_id % 3 <> 0 THEN substr(d.text, 1, 60) END AS title,
    CASE WHEN d.doc_id % 4 <> 0 THEN 'topic ' || f.source END AS disorder
  FROM fin f JOIN documents d USING (doc_id)), cite AS (
  SELECT query_id, string_agg(text, chr(10) || chr(10) || '---' || chr(10) || chr(10)
      ORDER BY final_rank) AS context,
    string_agg(source || ':' || pmid, ' ' ORDER BY final_rank) AS cited,
    list(coalesce(nullif(title, ''), disorder, '') ORDER BY final_rank) AS labels,
    coalesce(string_agg(CASE WHEN source = 'en' THEN disorder END, ' | ' ORDER BY final_rank), '')
      AS differential FROM meta GROUP BY 1)"""


@query("r09_r11_r13_citations", f"""WITH {CITED}
SELECT query_id, md5(context) AS context_md5, cited, array_to_string(labels, ' | ') AS labels,
  differential FROM cite""")
def _(spark, sf):
    out = hybrid.cite(retrieve(A.search_queries(spark, sf), A.corpus_index(spark, sf)))
    named = F.transform("citations", lambda c: F.concat(c["source"], F.lit(":"), c["pmid"]))
    return out.select(
        "query_id", F.md5("context").alias("context_md5"),
        F.array_join(named, " ").alias("cited"), F.array_join("context_chunks", " | ")
        .alias("labels"), F.array_join(hybrid.differential(F.col("citations"), "en"), " | ")
        .alias("differential"))


@query("r10_no_hit_answers", f"""SELECT item_id AS query_id, {A.text_sql(V.NO_HIT_ANSWER)}
  AS answer, 0 AS n_citations FROM benchmark""")
def _(spark, sf):
    """No source is allowed, so every query gets the refusal."""
    out = answer_queries(A.search_queries(spark, sf), A.corpus_index(spark, sf), sources=[])
    return out.select("query_id", "answer", F.size("citations").alias("n_citations"))


@query("p09_source_filter", f"""WITH {A.BM25}
SELECT query_id, source, chunk_id, score, rank FROM bm WHERE source IN ('de', 'fr')""")
def _(spark, sf):
    index = A.corpus_index(spark, sf, ["de", "fr"])
    return bm25.bm25_top(index.postings, index.term_stats, bm25.query_terms(A.search_queries(spark, sf)))


WANT = f"list_distinct({A.words_sql('b.text')})"
SCORED = f"""{CITED}, sc AS (
  SELECT b.item_id, len(list_filter(labels, lambda c: list_has_any({A.words_sql('c')}, {WANT})))
      ::DOUBLE / len(labels) AS cp,
    len(list_intersect({WANT}, {A.words_sql("array_to_string(labels, ' ')")}))::DOUBLE
      / len({WANT}) AS cr,
    len(list_intersect({WANT}, {A.words_sql('context')}))::DOUBLE / len({WANT}) AS ao
  FROM cite JOIN benchmark b ON b.item_id = cite.query_id)"""


@query("r14_a25_evaluation", f"""WITH {SCORED}
SELECT count(*) AS n, round(avg(cp), 6) AS context_precision, round(avg(cr), 6) AS context_recall,
  round(avg(ao), 6) AS answer_overlap FROM sc""")
def _(spark, sf):
    questions = A.search_queries(spark, sf).select(
        F.col("query_text").alias("question"), F.col("query_text").alias("ground_truth"))
    means = hybrid.mean_scores(evaluate(questions, A.corpus_index(spark, sf)))
    return means.select("n", *[F.round(c, 6).alias(c) for c in means.columns[1:]])


def sums_sql(expr: str) -> str:
    return f"sum(('0x' || substr(md5({expr}), 1, 8))::BIGINT)::BIGINT"


def sums_of(*columns):
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long"))


def index_contents(index):
    """Rows and checksums of every table of an index, per source."""
    chunks_ = index.chunks.groupBy("source").agg(F.count("*").alias("chunks"), sums_of("chunk_id", "text", "pmid").alias("chunk_sum"))
    post = block_rows(index.postings).groupBy("source").agg(
        F.count("*").alias("postings"), sums_of("chunk_id", "term", "tf", "dl").alias("posting_sum"))
    stats = index.term_stats.groupBy("source").agg(F.count("*").alias("term_stats"), sums_of("term", "df", "n_chunks").alias("stats_sum"))
    slots = index.vectors.select("source", "chunk_id", F.posexplode("vector").alias("slot", "weight")).where("weight > 0")
    near = slots.groupBy("source").agg(F.count("*").alias("weights"), F.round(F.sum("weight"), 3).alias("weight_sum"))
    return chunks_.join(post, "source").join(stats, "source").join(near, "source")


CONTENTS = f"""WITH {A.BM25}, {EMBED}, ch AS (
  SELECT source, count(*) AS chunks, {sums_sql("concat_ws('|', chunk_id, text, doc_id)")} AS chunk_sum FROM chunks GROUP BY 1), po AS (
  SELECT source, count(*) AS postings, {sums_sql("concat_ws('|', chunk_id, term, tf, dl)")} AS posting_sum FROM post GROUP BY 1), st AS (
  SELECT source, count(*) AS term_stats, {sums_sql("concat_ws('|', term, df, n_chunks)")} AS stats_sum FROM stats GROUP BY 1), ve AS (
  SELECT source, count(*) AS weights, round(sum(c / norm), 3) AS weight_sum FROM cb JOIN cn USING (chunk_id) GROUP BY 1)
SELECT * FROM ch JOIN po USING (source) JOIN st USING (source) JOIN ve USING (source)"""


@query("s14_index_round_trip", CONTENTS)
def _(spark, sf):
    """What the loaded index of all documents holds."""
    return index_contents(A.corpus_index(spark, sf))


@query("s14_index_append_and_merge", CONTENTS)
def _(spark, sf):
    """The same contents from an index of one language to which the others are appended, merged."""
    folder, parts = A.fresh_folder(spark, "index"), A.corpus_chunks(spark, sf)
    index_store.create_index(spark, folder, parts.where("source = 'en'"))
    index_store.append_chunks(spark, folder, parts.where("source <> 'en'"))
    index_store.merge_segments(spark, folder)
    return index_contents(index_store.load_index(spark, folder))


@query("s14_index_build", f"""WITH {A.BM25}
SELECT source, count(*) AS postings, count(DISTINCT term) AS terms FROM post GROUP BY 1""")
def _(spark, sf):
    """Builds the index anew; later queries of the session load it."""
    built = index_store.load_index(spark, A.index_folder(spark, sf, anew=True))
    return built.postings.groupBy("source").agg(F.sum("n").alias("postings"), F.count_distinct("term").alias("terms"))


@query("t16_triage_with_literature")
def _(spark, sf):
    """All records against the document index: every record gets its query's citations."""
    from screenwell.plans.triage_plan import triage

    judged = triage(A.records(spark, sf), index=A.corpus_index(spark, sf))
    return judged.groupBy("query_text", "safety_verdict").agg(
        F.count("*").alias("n"), F.max(F.size("citations")).alias("n_citations"))

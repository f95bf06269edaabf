"""One query per operator: the whole table, production parameters, digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from screenwell.llm import bpe_tree, chat, collocations, decontaminate, embeddings, jaccard, language, privacy, quality, substrings, warc, whitening, wrappers
from screenwell.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from screenwell.llm.store import Scratch


@query("op1_quality_classifier")
def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query("op2_ngram_jaccard_join")
def ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.link(table(spark, folder, "documents").select("doc_id", "text"))


@query("op3_benchmark_decontamination", """
    WITH words AS (
        SELECT 'd' AS side, doc_id AS id, text FROM documents
        UNION ALL SELECT 'b', item_id, text FROM benchmark),
    w AS (SELECT side, id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
              '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM words),
    s AS (SELECT DISTINCT side, id, unnest(CASE WHEN len(w) >= 5
              THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
              WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
    n AS (SELECT id, count(*) AS n FROM s WHERE side = 'b' GROUP BY id)
    SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_shared, n.n AS n_item,
           count(*) / n.n AS containment
    FROM s d JOIN s b ON d.s = b.s AND d.side = 'd' AND b.side = 'b' JOIN n ON n.id = b.id
    GROUP BY d.id, b.id, n.n HAVING count(*) * 10 >= n.n * 8""")
def benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    scratch = Scratch(spark)
    found = decontaminate.contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"),
                                    scratch=scratch)
    return scratch.finish(found.groupBy("doc_id", "item_id").agg(
        F.max("n_shared").alias("n_shared"), F.max_by("n_item", "n_shared").alias("n_item"),
        F.max("containment").alias("containment")))


@query("op4_embedding_near_dedup", """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND list_sum(list_transform(embedding, lambda x: x * x)) > 0),
    l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.label = b.label AND a.vec_id <> b.vec_id
          WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
    r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings
          UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a, min(b) AS b FROM r GROUP BY a),
    n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
    SELECT c.a AS vec_id, coalesce(n.n, 0) AS n_links, c.b AS component_id, c.a = c.b AS kept
    FROM c LEFT JOIN n ON n.a = c.a""")
def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, folder, "embeddings"))


@query("op5_suffix_array_dedup")
def suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(table(spark, folder, "documents").select("doc_id", "text"))


@query("op6_information_theoretic_privacy")
def information_theoretic_privacy(spark: SparkSession, folder: str) -> DataFrame:
    return privacy.report(table(spark, folder, "documents").select("doc_id", "text"))


@query("op7_wrapper_induction")
def wrapper_induction(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.main_texts(table(spark, folder, "pages"))


@query("op8_language_identification")
def language_identification(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = language.learn_and_identify(docs.select("doc_id", "text", "lang"))
    return found.select("doc_id", language.held_out().alias("held_out"), "lang_pred", "score")


@query("op9_warc_round_trip", """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
    d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS n, sha256(html) AS h FROM p),
    f AS (SELECT h, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY h)
    SELECT d.page_id, d.n AS payload_bytes, d.h AS payload_digest,
           CASE WHEN f.first < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN f.first < d.page_id THEN f.first END AS refers_to
    FROM d LEFT JOIN f ON d.h = f.h AND d.n >= 100""")
def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query("op10_bpe_tree_concatenation")
def bpe_tree_concatenation(spark: SparkSession, folder: str) -> DataFrame:
    return bpe_tree.encode_documents(table(spark, folder, "documents"))


@query("op11_chat_template", """
    WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
               UNION ALL SELECT -7, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
    m AS (SELECT *, length(text) + len(regexp_extract_all(text, p)) AS long_text,
                 length(role) + len(regexp_extract_all(role, p)) AS long_role
          FROM c, (SELECT '\\\\|\\[/?INST\\]|</?s>|<</?SYS>>|\\[/?ROLE\\]|\\[/TURN\\]' AS p))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(long_text + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 15 WHEN 'assistant' THEN 7
                                ELSE 20 + long_role END) AS BIGINT) AS formatted_chars
    FROM m GROUP BY conv_id""")
def chat_template(spark: SparkSession, folder: str) -> DataFrame:
    rows = chat.with_control_case(table(spark, folder, "conversations"))
    return chat.read_back(chat.format_conversations(rows), ordered=True)


@query("op12_embedding_whitening")
def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))


@query("op13_phrase_collocations", """
    WITH p AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents),
    w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
    g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
          FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS t(k))),
    f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
    n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
    c AS (SELECT lang, phrase, k, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 30),
    cut AS (SELECT c.lang, c.phrase, c.a, x, array_to_string(w[:x], ' ') AS one, array_to_string(w[x + 1:], ' ') AS two
            FROM c, range(1, 4) AS t(x) WHERE x < k),
    s AS (SELECT cut.lang, cut.phrase, a, o.f AS l, t.f AS r, 2000000::HUGEINT * a // (o.f + t.f) AS score
          FROM cut JOIN f o ON o.lang = cut.lang AND o.phrase = one JOIN f t ON t.lang = cut.lang AND t.phrase = two
          QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, x) = 1),
    part AS (SELECT lang, a AS outer_a, array_to_string(w[i:i + m - 1], ' ') AS phrase
             FROM c, range(2, 4) AS t(m), range(1, 4) AS u(i) WHERE m < k AND i + m - 1 <= k),
    gone AS (SELECT lang, phrase, max(outer_a) AS outer_a FROM part GROUP BY ALL)
    SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank,
           s.phrase, a, l, r, n, CAST(score AS BIGINT) AS score
    FROM s JOIN n ON n.lang = s.lang LEFT JOIN gone ON gone.lang = s.lang AND gone.phrase = s.phrase
    WHERE outer_a IS NULL OR 100::HUGEINT * outer_a < 80::HUGEINT * a QUALIFY rank <= 2000""")
def phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(table(spark, folder, "documents"))

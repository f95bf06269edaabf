import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from screenwell.fixed_values import NO_HIT_ANSWER
from screenwell.plans.retrieval_plan import answer_queries, evaluate, evaluation_questions, retrieve
from screenwell.plans.triage_plan import triage
from screenwell.retrieval.bm25 import bm25_top, query_terms
from screenwell.retrieval import bm25
from screenwell.retrieval.blocks import block_postings, block_rows, in_blocks
from screenwell.retrieval.chunks import chunk_text, number_chunks, postings
from screenwell.retrieval.dense import dense_top, embed
from screenwell.retrieval.hybrid import fuse_ranks, merge_hits
from screenwell.sources.bibliography import summary_documents
from screenwell.sources.files import read_summaries
from screenwell.session import checkpoint_folder, cut_lineage
from screenwell.sources.index_store import (append_chunks, build_index, create_index, latest, load_index,
                                            merge_segments)
from tests.test_scoring import records

WORDS = [f"w{i}" for i in range(60)]


def corpus(spark, n=300, seed=3):
    """Skewed words: the first ones occur in most chunks, which makes their idf negative."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        text = " ".join(WORDS[min(int(rng.expovariate(0.12)), 59)]
                        for _ in range(rng.randint(1, 25)))
        rows.append((i, "a" if i % 3 else "b", text))
    return rows, spark.createDataFrame(rows, "chunk_id long, source string, text string")


def brute_bm25(rows, query, k=5):
    out = {}
    for source in {r[1] for r in rows}:
        docs = [(r[0], r[2].lower().split()) for r in rows if r[1] == source]
        df = Counter(w for _, ws in docs for w in set(ws))
        n, avg = len(docs), sum(len(ws) for _, ws in docs) / len(docs)
        raw = {w: math.log(n - f + 0.5) - math.log(f + 0.5) for w, f in df.items()}
        mean = sum(raw.values()) / len(raw)
        idf = {w: x if x >= 0 else 0.25 * mean for w, x in raw.items()}
        scores = []
        for key, ws in docs:
            tf = Counter(ws)
            s = sum(idf.get(w, 0) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(ws) / avg))
                    for w in query.split())
            if round(s, 6) > 0:
                scores.append((round(s, 6), key))
        out[source] = sorted(scores, reverse=True)[:k]
    return out


def by_query(found):
    got = {}
    for r in found.orderBy("query_id", "source", "rank").collect():
        got.setdefault((r.query_id, r.source), []).append((r.score, r.chunk_id))
    return got


@pytest.mark.parametrize("bits,first", [(0, 1), (2, 1), (2, 4), (7, 4)])
def test_bm25_equals_brute_force(spark, monkeypatch, bits, first):
    """Blocks of 1, 4 and 128 chunks; copies of chunks tie and are ranked by id."""
    monkeypatch.setattr(bm25, "FIRST_BLOCKS", first)
    monkeypatch.setattr(bm25, "MORE", 3)
    rows, chunks = corpus(spark)
    rows = rows + [(i + 1000, s, t) for i, s, t in rows[:60]]
    chunks = spark.createDataFrame(rows, chunks.schema)
    texts = ["w0 w1 w2 w0", "w30 w0 w45", "w50 w51 w52 w53 w1", "w0", "unknown"]
    queries = spark.createDataFrame(list(enumerate(texts)), "query_id long, query_text string")
    blocks = cut_lineage(block_postings(cut_lineage(in_blocks(chunks, bits=bits))))
    stats = build_index(chunks).term_stats
    got = by_query(bm25_top(blocks, stats, query_terms(queries), 5))
    for q, text in enumerate(texts):
        for source, want in brute_bm25(rows, text).items():
            mine = got.get((q, source), [])
            assert [i for _, i in mine] == [i for _, i in want]
            assert np.allclose([s for s, _ in mine], [s for s, _ in want], atol=2e-6)


def test_bm25_scores_few_blocks_of_rare_words(spark, monkeypatch):
    """Pairs of query and block that are scored do not grow faster than the queries, and stay far
    below all pairs that share a word."""
    seen = []
    whole = bm25.scored
    monkeypatch.setattr(bm25, "scored", lambda b, p, pairs, k, ways: seen.append(pairs.count()) or whole(b, p, pairs, k, ways))
    rng = random.Random(5)
    rows = [(i, "a", " ".join([f"rare{i // 8}"] + [WORDS[rng.randrange(20)] for _ in range(12)])) for i in range(2000)]
    blocks = cut_lineage(block_postings(cut_lineage(in_blocks(
        spark.createDataFrame(rows, "chunk_id long, source string, text string"), bits=3))))
    stats = build_index(spark.createDataFrame(rows, "chunk_id long, source string, text string")).term_stats
    for n in (20, 200):
        queries = spark.createDataFrame([(q, f"rare{q} w1 w2 w3") for q in range(n)], "query_id long, query_text string")
        seen.clear()
        assert bm25_top(blocks, stats, query_terms(queries), 3).count() == 3 * n
        assert sum(seen) <= n * 10


def test_blocks_hold_every_posting_once(spark):
    _, chunks = corpus(spark)
    placed = cut_lineage(in_blocks(chunks, 3, 2))
    assert placed.groupBy("source", "block").count().where("count > 4").isEmpty()
    assert placed.where("block < 3 * shiftleft(1L, 47)").isEmpty()
    post = postings(chunks)
    rows = block_rows(block_postings(placed)).select(post.columns)
    assert rows.exceptAll(post).isEmpty() and post.exceptAll(rows).isEmpty()


def test_index_appends_merges_and_prunes(spark):
    rows, chunks = corpus(spark)
    folder = f"{checkpoint_folder(spark)}/index-test"
    create_index(spark, folder, chunks.where("chunk_id < 200"))
    queries = spark.createDataFrame([(0, "w40 w41 w1")], "query_id long, query_text string")
    search = lambda: by_query(bm25_top(load_index(spark, folder).postings, load_index(spark, folder).term_stats, query_terms(queries), 5))
    assert [i for _, i in search()[0, "a"]] == [i for _, i in brute_bm25([r for r in rows if r[0] < 200], "w40 w41 w1")["a"]]
    append_chunks(spark, folder, chunks.where("chunk_id >= 200"))
    want = [i for _, i in brute_bm25(rows, "w40 w41 w1")["a"]]
    assert [i for _, i in search()[0, "a"]] == want and len(latest(spark, folder)["segments"]) == 2
    with pytest.raises(ValueError):
        append_chunks(spark, folder, chunks.where("chunk_id = 7"))
    with pytest.raises(FileExistsError):
        create_index(spark, folder, chunks)
    merge_segments(spark, folder)
    assert [i for _, i in search()[0, "a"]] == want and len(latest(spark, folder)["segments"]) == 1
    one = load_index(spark, folder, ["b"])
    assert {r.source for r in one.vectors.select("source").distinct().collect()} == {"b"}
    assert "PartitionFilters: [isnotnull(source" in one.postings._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")).replace("source#", "source#")
    fewer = load_index(spark, folder).postings.where(F.col("term").isin(["w40"])).select("tops")
    plan = fewer._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(term), EqualTo(term,w40)]" in plan and "ids" not in plan.split("ReadSchema")[-1]


@pytest.mark.parametrize("block", [3, 1000])
def test_dense_equals_brute_force(spark, block):
    rng = np.random.default_rng(1)
    vec, qs = rng.normal(size=(200, 8)), rng.normal(size=(10, 8))
    vec[50:60] = vec[0]
    vectors = spark.createDataFrame([(i, "a" if i % 2 else "b", v.tolist())
                                     for i, v in enumerate(vec)],
                                    "chunk_id long, source string, vector array<double>")
    queries = spark.createDataFrame([(i, q.tolist()) for i, q in enumerate(qs)],
                                    "query_id long, vector array<double>")
    for parts in (1, 5):
        found = dense_top(vectors.repartition(parts), queries, 4, block, 50 * parts)
        got = {(r.query_id, r.source, r["rank"]): r.chunk_id for r in found.collect()}
        for q in range(10):
            scores = np.round(vec @ qs[q], 6)
            for source, odd in (("a", 1), ("b", 0)):
                ids = [i for i in range(200) if i % 2 == odd]
                best = sorted(ids, key=lambda i, s=scores: (-s[i], -i))[:4]
                assert [got[q, source, r] for r in range(1, 5)] == best


def test_dense_without_queries(spark):
    vectors = spark.createDataFrame([(1, "a", [1.0])], "chunk_id long, source string, "
                                                       "vector array<double>")
    none = spark.createDataFrame([], "query_id long, vector array<double>")
    assert dense_top(vectors, none).count() == 0


@pytest.mark.parametrize("size", [0, 1, 448, 449, 512, 513, 960])
def test_chunk_lengths(spark, size):
    text = "".join(chr(97 + i % 26) for i in range(size))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    got = [r.text for r in number_chunks(chunk_text(df)).orderBy("chunk_id").collect()]
    assert got == [text[i:i + 512] for i in range(0, size, 448)]


def test_prefix_copies_keep_the_keyword_hit(spark):
    chunks = spark.createDataFrame([(1, "a", "x" * 90), (2, "a", "x" * 85 + "yy"), (3, "b", "x" * 90)],
                                   "chunk_id long, source string, text string")
    hit = "query_id long, source string, chunk_id long, score double, rank int"
    keyword = spark.createDataFrame([(0, "a", 2, 1.0, 1)], hit)
    dense = spark.createDataFrame([(0, "a", 1, 0.9, 1), (0, "b", 3, 0.8, 1)], hit)
    merged = merge_hits(keyword, dense, chunks, prefix=80)
    assert sorted((r.source, r.chunk_id) for r in merged.collect()) == [("a", 2), ("b", 3)]
    assert fuse_ranks(merged).count() == 2


def summaries_index(spark):
    docs = summary_documents(read_summaries(spark)).withColumn(
        "chunk_id", F.xxhash64("disorder") % 100000)
    return build_index(docs.select("source", "chunk_id", "text", "disorder"))


def test_answers_over_criteria_summaries(spark):
    index = summaries_index(spark)
    queries = spark.createDataFrame([(0, "Generalised Anxiety Disorder"), (1, "panic attacks")],
                                    "query_id long, query_text string")
    out = {r.query_id: r for r in answer_queries(queries, index).collect()}
    assert out[0].context_chunks[0] == "Generalised Anxiety Disorder"
    assert "Panic Disorder" in out[1].context_chunks and len(out[1].citations) == 5
    none = answer_queries(queries, index, sources=[]).collect()
    assert all(r.answer == NO_HIT_ANSWER and r.citations == [] for r in none)
    other = retrieve(queries, index, sources=["pubmed"])
    assert other.count() == 0


def test_evaluation_questions(spark):
    questions = evaluation_questions(spark, 12)
    assert sorted(r.position for r in questions.collect()) == list(range(12))
    scored = evaluate(questions, summaries_index(spark))
    assert scored.count() == 12
    assert scored.filter("context_recall > 0").count() > 0


def test_triage_with_literature(spark):
    out = triage(records(spark, ["calm"], phq1_anhedonia=3, phq2_low_mood=3, phq3_sleep=3,
                         phq4_fatigue=3), index=summaries_index(spark)).first()
    assert out.dsm_differential[0] == "Major Depressive Disorder"
    assert out.safety_verdict == "monitor"


def test_embedding_is_unit(spark):
    df = embed(spark.createDataFrame([("a b a",), ("",)], "text string"), "text")
    norms = [sum(x * x for x in r.vector) for r in df.collect()]
    assert norms[0] == pytest.approx(1.0) and norms[1] == 0.0


def test_blocks_of_a_shelf_come_sorted_and_whole(spark):
    import pyarrow as pa

    from screenwell.retrieval.blocks import some_blocks

    schema = pa.schema([("source", pa.string()), ("term", pa.string()), ("block", pa.int64()), ("n", pa.int32()),
                        ("tops", pa.list_(pa.struct([("tf", pa.int32()), ("dl", pa.int32())]))),
                        ("ids", pa.list_(pa.int64())), ("tfs", pa.list_(pa.int32())), ("dls", pa.list_(pa.int32()))])
    texts = {(2, 7): ["b", "a", "b"], (1, 9): ["ü", "a"], (1, 3): ["a", "a", "c", "ü"], (2, 8): [], (2, 5): None}
    table = pa.table({"source": ["s"] * 5, "block": [k[0] for k in texts], "chunk_id": [k[1] for k in texts],
                      "words": pa.array(list(texts.values()), pa.list_(pa.string()))})
    got = some_blocks(table, schema).to_pylist()
    assert [(r["term"], r["block"]) for r in got] == [("a", 1), ("a", 2), ("b", 2), ("c", 1), ("ü", 1)]
    for r in got:
        held = {i: w for (b, i), w in sorted(texts.items()) if b == r["block"] and w and r["term"] in w}
        assert r["ids"] == list(held) and r["n"] == len(held) and r["dls"] == [len(w) for w in held.values()]
        assert r["tfs"] == [Counter(w)[r["term"]] for w in held.values()]
        best = {}
        for tf, dl in zip(r["tfs"], r["dls"], strict=True):
            best[tf] = min(dl, best.get(tf, dl))
        assert r["tops"] == [{"tf": t, "dl": best[t]} for t in sorted(best)]
    assert some_blocks(table.slice(3, 1), schema).num_rows == 0


def test_a_null_text_has_a_zero_vector(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, None), (3, " ")], "id long, text string")
    got = {r.id: r.vector for r in embed(df, "text").collect()}
    assert sum(x * x for x in got[1]) == pytest.approx(1) and got[2] == got[3] == [0.0] * 64

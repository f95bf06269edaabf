import json

import pytest
from pyspark.sql import functions as F

from screenwell.operators.cohort import clean_posts, first_copy, split_by_user
from screenwell.plans import cohort_job
from screenwell.sources.bibliography import article_documents, articles
from screenwell.sources.files import read_posts, read_split, read_summaries

BODY = '''author,subreddit,title,body,created_utc
ann,depression,"Title, with comma","first line
second ""quoted"" line see http://x.org/a and /r/foo u/bar end",100
ann,depression,"Title, with comma","first line
second ""quoted"" line see http://x.org/a and /r/foo u/bar end",200
bob,depression,"Title, with comma","first line
second ""quoted"" line see http://x.org/a and /r/foo u/bar end",300
[deleted],anxiety,some title here,a long enough body text,1
cat,anxiety,a title long enough here,[removed],2
dan,anxiety,,nineteen chars text,3
eve,anxiety,,twenty characters ok,4
fay,cooking,a title,of an unlisted forum for posts,5
gus,BPD,only a title that is long enough,,6
'''
SELF = '''author,subreddit,title,selftext,created_utc
hal,ptsd,self post,the body is in the other column,7
'''


def cohort_files(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "body.csv").write_text(BODY)
    (tmp_path / "in" / "self.csv").write_text(SELF)
    return [str(tmp_path / "in" / "body.csv"), str(tmp_path / "in" / "self.csv")]


def test_cohort_job(spark, tmp_path):
    globs = cohort_files(tmp_path)
    out = str(tmp_path / "out")
    totals = cohort_job.run(spark, globs, out)
    rows = spark.read.parquet(out).collect()
    by_author = {r.author: r for r in rows}
    assert set(by_author) == {"ann", "bob", "cat", "eve", "gus", "hal"}
    assert by_author["ann"].text == ('Title, with comma first line second "quoted" line see and '
                                     'end')
    assert by_author["ann"].created_utc == 100 or by_author["ann"].created_utc == "100"
    assert by_author["gus"].label == "bpd" and by_author["hal"].label == "ptsd"
    assert sum(r.n for r in totals.collect() if r.label is None) == 6
    for split in {r.split for r in rows}:
        part = read_split(spark, out, split)
        assert "PartitionFilters: [isnotnull(split" in part._jdf.queryExecution().toString()


def test_posts_have_an_explicit_schema(spark, tmp_path):
    own = tmp_path / "posts"
    own.mkdir()
    (own / "a.csv").write_text("author,created_utc\nann,007\n")
    posts = read_posts(spark, f"{own}/*.csv")
    assert posts.dtypes == [("author", "string"), ("created_utc", "string")] and posts.first().created_utc == "007"
    given = read_posts(spark, f"{own}/*.csv", schemas=[posts.schema])
    assert given.collect() == posts.collect()
    (own / "b.csv").write_text("created_utc,author\n1,bob\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_posts(spark, f"{own}/*.csv", schemas=[posts.schema]).collect()


def test_strict_markers_and_length(spark, tmp_path):
    posts = read_posts(spark, *cohort_files(tmp_path))
    assert clean_posts(posts, strict=True).filter("author = 'cat'").count() == 0
    assert clean_posts(posts, min_length=19).filter("author = 'dan'").count() == 1


def test_split_keeps_users_together(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("string").alias("author"))
    split = split_by_user(df)
    assert split.distinct().count() == 100
    want = df.distinct().withColumn("b", F.abs(F.hash("author")) % 100)
    both = want.join(split.distinct(), "author")
    assert both.filter("(b < 80) <> (split = 'train')").count() == 0
    assert split_by_user(df, seed=7).exceptAll(split).count() > 0


def test_first_copy_takes_the_earliest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, t int, v string")
    for parts in (1, 4):
        got = first_copy(df.repartition(parts), ["k"], [F.col("t")]).collect()
        assert sorted((r.k, r.t, r.v) for r in got) == [("a", 1, "y"), ("b", 5, "z")]


def test_bibliography_shapes(spark):
    long_text = "x" * 60
    art = lambda title, abstract, pmid="1": {"MedlineCitation": {
        "PMID": {"#text": pmid}, "Article": {"ArticleTitle": title,
                                             "Abstract": {"AbstractText": abstract}}}}
    wrap = lambda a: json.dumps({"PubmedArticleSet": {"PubmedArticle": a}})
    replies = [wrap([art("t1", long_text), art("t2", "short")]),
               wrap(art({"#text": "t3"}, {"#text": long_text})),
               wrap([art("t4", [{"#text": long_text}, "tail", {"no": 1}])]),
               wrap([]), "{}", "not json"]
    df = spark.createDataFrame([(r,) for r in replies], "json string")
    got = {r.title: r.abstract for r in articles(df).collect()}
    assert got == {"t1": long_text, "t3": long_text, "t4": long_text + " tail "}
    documents = article_documents(articles(df)).filter("title = 't1'").first()
    assert (documents.source, documents.text) == ("pubmed", "t1\n\n" + long_text)


def test_custom_summaries(spark, tmp_path):
    path = tmp_path / "s.jsonl"
    path.write_text('{"disorder": "X", "criteria_summary": "c", "source": "own"}\n\n')
    got = read_summaries(spark, str(path))
    assert got.count() == 9 and got.filter("icd10 IS NULL").count() == 1
    assert read_summaries(spark).count() == 8

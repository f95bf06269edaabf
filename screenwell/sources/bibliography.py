"""Bibliographic JSON replies flattened to one row per article."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.functions.text import document_text
from screenwell.operators.rows import with_kept

ARTICLES = "$.PubmedArticleSet.PubmedArticle"


def _items(json: Column) -> Column:
    """A JSON array as an array of strings; any other value as a single element."""
    is_list = F.ltrim(json).startswith("[")
    return F.when(is_list, F.from_json(json, "array<string>")).when(
        json.isNotNull(), F.array(json))


def _text(value: Column) -> Column:
    """Text of a value given as a string or as an object with ``#text``."""
    is_object = F.ltrim(value).startswith("{")
    return F.when(is_object, F.coalesce(F.get_json_object(value, "$['#text']"), F.lit(""))
                  ).otherwise(value)


def articles(replies: DataFrame, json: str = "json", min_length: int = 50) -> DataFrame:
    """(pmid, title, abstract) for every article of every reply.

    The article list may be an array or a single object, the title a string or an object, the
    abstract a string, an object or a list whose parts are joined by a blank. Abstracts of at
    most ``min_length`` characters are left out.
    """
    keep = [c for c in replies.columns if c != json]
    art = replies.select(*keep, F.explode(_items(F.get_json_object(json, ARTICLES))).alias("art"))
    body = F.get_json_object("art", "$.MedlineCitation.Article.Abstract.AbstractText")
    abstract = F.when(F.ltrim(body).startswith("["), F.array_join(
        F.transform(F.from_json(body, "array<string>"), _text), " ")).otherwise(_text(body))
    pmid = F.get_json_object("art", "$.MedlineCitation.PMID['#text']")
    title = F.get_json_object("art", "$.MedlineCitation.Article.ArticleTitle")
    long = with_kept(art, "abstract", F.coalesce(abstract, F.lit("")),
                     lambda t: F.length(t) > min_length)
    return long.select(*keep, F.coalesce(pmid, F.lit("")).alias("pmid"),
                       F.coalesce(_text(title), F.lit("")).alias("title"), "abstract")


def article_documents(flat: DataFrame) -> DataFrame:
    """Articles as documents of the literature source."""
    return flat.withColumns({"text": document_text(F.col("title"), F.col("abstract")),
                             "source": F.lit("pubmed")})


def summary_documents(summaries: DataFrame) -> DataFrame:
    """Criteria summaries as documents; each is one chunk."""
    text = document_text(F.col("disorder"), F.col("criteria_summary"))
    return summaries.withColumns({"text": text, "source": F.lit("dsm")})

"""Post tables: cleaning, filters, weak labels, de-duplication, user-level split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import (COHORT_COLUMNS, DELETED_AUTHOR, REMOVED_MARKERS,
                                     SUBREDDIT_LABELS)
from screenwell.functions.bands import lookup
from screenwell.functions.hashing import bucket
from screenwell.functions.text import clean_text
from screenwell.operators.rows import with_kept


def with_missing(df: DataFrame, names: list[str]) -> DataFrame:
    """Add absent columns as NULL strings, so that files of either header can be read."""
    return df.withColumns({n: F.lit(None).cast("string") for n in names if n not in df.columns})


def clean_posts(df: DataFrame, min_length: int = 20, strict: bool = False) -> DataFrame:
    """Add ``text`` = cleaned title + body (or selftext) and drop short or removed posts.

    ``strict`` also tests the removal markers on the body alone, where they can be seen.
    """
    df = with_missing(df, ["title", "body", "selftext"])
    body = F.coalesce("body", "selftext")
    kept = df.filter(F.col("author").isNotNull() & (F.col("author") != DELETED_AUTHOR))
    if strict:
        kept = kept.filter(~F.coalesce(F.trim(body), F.lit("")).isin(*REMOVED_MARKERS))
    return with_kept(kept, "text", clean_text(F.col("title"), body),
                     lambda t: (F.length(t) >= min_length) & ~t.isin(*REMOVED_MARKERS))


def allowed_forums(df: DataFrame, labels: dict[str, str] = SUBREDDIT_LABELS) -> DataFrame:
    return df.filter(F.col("subreddit").isin(*labels))


def label_posts(df: DataFrame, labels: dict[str, str] = SUBREDDIT_LABELS) -> DataFrame:
    return df.withColumn("label", lookup(F.col("subreddit"), labels))


def label_from_table(df: DataFrame, labels: DataFrame) -> DataFrame:
    """The same lookup when the map is a table (subreddit, label) with one row per forum."""
    return df.join(labels.select("subreddit", "label"), "subreddit", "left")


def first_copy(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the smallest by ``order``, then by the other columns.

    The minimum is taken before the shuffle too, so a key with many copies reaches its reducer
    as one row per task. Map columns, which have no order, are compared as JSON.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    ranked = [o.alias(f"_o{i}") for i, o in enumerate(order)]
    maps = {f.name for f in df.schema.fields if "map<" in f.dataType.simpleString()}
    if maps:
        by = F.struct(*ranked, *[F.to_json(F.struct(c)) if c in maps else F.col(c) for c in rest])
        first = F.min_by(F.struct(*rest), by)
    else:
        first = F.min(F.struct(*ranked, *rest))
    kept = df.groupBy(*keys).agg(first.alias("_row"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c)
                         for c in df.columns])


def deduplicate_posts(df: DataFrame) -> DataFrame:
    """First post per (author, text), by time, then forum."""
    order = [F.col(c) for c in ("created_utc", "subreddit") if c in df.columns]
    return first_copy(df, ["author", "text"], order or [F.lit(0)])


def split_by_user(df: DataFrame, user: str = "author", seed: int = 42, train: int = 80,
                  val: int = 10, method: str = "murmur3") -> DataFrame:
    """Assign every user to one split by hash, so that no user is in two."""
    b = bucket(F.col(user), 100, method, seed)
    return df.withColumn("split", F.when(b < train, "train").when(b < train + val, "val")
                         .otherwise("test"))


def existing_columns(df: DataFrame, wanted: list[str] = COHORT_COLUMNS) -> DataFrame:
    """Project the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def drop_unlabelled(df: DataFrame, needed: list[str] = ("text", "subreddit")) -> DataFrame:
    return df.dropna(subset=list(needed))

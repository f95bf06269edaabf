"""Cohort job: read, clean, label, de-duplicate, split, write, summarise."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from screenwell.operators.cohort import (allowed_forums, clean_posts, deduplicate_posts,
                                         existing_columns, label_posts, split_by_user)
from screenwell.operators.summary import split_and_label_totals
from screenwell.sources.files import read_posts, read_table, write_cohort


def cohort(posts: DataFrame, min_length: int = 20, seed: int = 42,
           strict: bool = False) -> DataFrame:
    """Posts to cohort rows. The forum filter comes first, so other rows are never cleaned."""
    cleaned = clean_posts(allowed_forums(posts), min_length, strict)
    split = split_by_user(deduplicate_posts(existing_columns(label_posts(cleaned))), seed=seed)
    return existing_columns(split)


def run(spark: SparkSession, globs: list[str], out: str, min_length: int = 20,
        seed: int = 42) -> DataFrame:
    """Write the cohort once; the summary reads the written table."""
    write_cohort(cohort(read_posts(spark, *globs), min_length, seed), out)
    return split_and_label_totals(read_table(spark, out))

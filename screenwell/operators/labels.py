"""Weak symptom labels from forum and keywords."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from screenwell.fixed_values import SUBREDDIT_SYMPTOMS, SYMPTOM_KEYWORDS, SYMPTOMS
from screenwell.functions.text import contains_any


def weak_labels(df: DataFrame, text: str = "text", forum: str = "subreddit",
                symptoms: list[str] = SYMPTOMS, forums: dict = SUBREDDIT_SYMPTOMS,
                keywords: dict = SYMPTOM_KEYWORDS, target: str = "suicidal_ideation",
                fold_keywords: bool = False) -> DataFrame:
    """Add ``labels`` (0/1 in symptom order) and ``si_label``.

    A label is set by the forum's symptom list or by a keyword in the lower-cased text.
    ``fold_keywords`` lower-cases the keywords, which lets those with a capital match.
    """
    lowered = F.lower(F.col(text))
    flags = []
    for name in symptoms:
        named = [f for f, listed in forums.items() if name in listed]
        hit = F.coalesce(F.col(forum).isin(*named), F.lit(False)) if named else F.lit(False)
        words = keywords.get(name, [])
        if words:
            hit = hit | contains_any(lowered, [w.lower() for w in words] if fold_keywords
                                     else words)
        flags.append(hit.cast("int"))
    labelled = df.withColumn("labels", F.array(*flags))
    return labelled.withColumn("si_label", F.col("labels")[symptoms.index(target)])


def forum_labels(forum: str = "subreddit", forums: dict = SUBREDDIT_SYMPTOMS):
    """Symptom list of a forum as an array column; empty for an unknown forum."""
    chain = F.expr("CAST(array() AS array<string>)")
    for name, listed in forums.items():
        chain = F.when(F.col(forum) == name, F.array(*[F.lit(x) for x in listed])).otherwise(chain)
    return chain


def keyword_labels(text: str = "text", keywords: dict = SYMPTOM_KEYWORDS):
    """Symptoms with a keyword in the lower-cased text, as an array column."""
    lowered = F.lower(F.col(text))
    return F.array_compact(F.array(*[F.when(contains_any(lowered, words), F.lit(name))
                                     for name, words in keywords.items()]))


def label_union(df: DataFrame, symptoms: list[str] = SYMPTOMS) -> DataFrame:
    """The same labels as a set: forum symptoms united with keyword symptoms, then 0/1."""
    named = F.array_union(forum_labels(), keyword_labels())
    return df.withColumn("symptom_set", named).withColumn("labels", F.transform(
        F.array(*[F.lit(s) for s in symptoms]),
        lambda s: F.array_contains("symptom_set", s).cast("int")))

"""Totals, bands and literal lookups."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from screenwell.fixed_values import AGE_BANDS, BAND_SCORES, GAD_BANDS, PHQ_BANDS


def item_total(items: list[str]) -> Column:
    """Sum of item columns, a missing answer counting 0."""
    return reduce(add, [F.coalesce(F.col(i), F.lit(0)) for i in items])


def band(total: Column, table: list[tuple]) -> Column:
    """Name of the first band whose upper end covers ``total``; the last band above all."""
    chain = F.when(total <= table[0][1], table[0][2])
    for _, high, name in table[1:-1]:
        chain = chain.when(total <= high, name)
    return chain.otherwise(table[-1][2])


def phq_band(total: Column) -> Column:
    return band(total, PHQ_BANDS)


def gad_band(total: Column) -> Column:
    return band(total, GAD_BANDS)


def age_band(age: Column) -> Column:
    return band(age, AGE_BANDS)


def lookup(key: Column, table: dict, default=None) -> Column:
    """Literal dictionary lookup; ``default`` for a missing key."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.create_map(*pairs)[key]
    return found if default is None else F.coalesce(found, F.lit(default))


def band_score(name: Column) -> Column:
    return lookup(name, BAND_SCORES, 0.0)


def class_code(name: Column, order: list[str]) -> Column:
    """Position of a class name in ``order``."""
    return lookup(name, {c: i for i, c in enumerate(order)})

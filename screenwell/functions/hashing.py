"""Hash buckets, repeatable uniforms and normals, deterministic identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest_int(value: Column) -> Column:
    """First 32 bits of the md5 digest as a non-negative long."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 8), 16, 10).cast("long")


def bucket(value: Column, buckets: int = 100, method: str = "murmur3", seed: int = 42) -> Column:
    """Bucket of a key in ``0 .. buckets-1``.

    ``murmur3`` is Spark's ``hash`` (its fixed seed is 42; other seeds salt the key), ``md5``
    can be repeated by any engine.
    """
    key = value if seed == 42 else F.concat_ws("/", F.lit(str(seed)), value)
    if method == "md5":
        return digest_int(key) % buckets
    # The remainder is taken before abs: abs of the smallest int would overflow.
    return F.abs(F.hash(key) % buckets)


def uniform(seed: int, row: Column, draw: str) -> Column:
    """Repeatable uniform in (0, 1), a function of (seed, row, draw) alone."""
    key = F.concat_ws("/", F.lit(str(seed)), row.cast("string"), F.lit(draw))
    return (digest_int(key) + F.lit(0.5)) / F.lit(4294967296.0)


def normal(seed: int, row: Column, draw: str) -> Column:
    """Repeatable standard normal (Box-Muller on two uniforms)."""
    radius = F.sqrt(F.lit(-2.0) * F.ln(uniform(seed, row, draw + "/r")))
    return radius * F.cos(F.lit(2.0 * math.pi) * uniform(seed, row, draw + "/a"))


def choice(u: Column, table: list[tuple]) -> Column:
    """Pick from (value, probability) pairs by a uniform."""
    edge, chain = 0.0, None
    for value, share in table[:-1]:
        edge += share
        test = u < F.lit(round(edge, 10))
        chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
    last = F.lit(table[-1][0])
    return last if chain is None else chain.otherwise(last)


def digest_uuid(seed: int, row: Column) -> Column:
    """Identifier in uuid form, repeatable from (seed, row)."""
    d = F.md5(F.concat_ws("/", F.lit(str(seed)), row.cast("string"), F.lit("uuid")))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(d, at, size) for at, size in cuts])

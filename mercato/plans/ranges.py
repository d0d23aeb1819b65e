"""Range buckets from a sorted list of split keys, and lookups attached to large tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a lookup that may be broadcast; a larger one is joined over salted keys.
MAX_LOOKUP_ROWS = 10_000
#: Parts that each key is cut into when a lookup is too large to broadcast.
SALTS = 32


def range_bucket(key: Column, splits: list[Column]) -> Column:
    """Number of ``splits`` (ascending, as literals) that are ``<=`` the key.

    The splits are one constant array, searched in two steps (every m-th
    split, then the m behind it), so neither the generated code nor the work
    per row grows with more than the square root of their number.
    """
    if not splits:
        return F.lit(0)
    m = max(1, math.isqrt(len(splits)))
    every, coarse = F.array(*splits), F.array(*splits[::m])

    def at_most(values: Column) -> Column:
        return F.size(F.filter(values, lambda s: s <= key))

    block = F.greatest(at_most(coarse) - 1, F.lit(0)) * m
    return (block + at_most(F.slice(every, block + 1, F.lit(m)))).cast("int")


def attach_lookup(df: DataFrame, lookup: DataFrame, keys: list[str], salt_by: Column, max_rows: int = MAX_LOOKUP_ROWS) -> DataFrame:
    """Left join of a large table with a lookup that has one row per key; null keys match null keys.

    The lookup is broadcast only after a check that it has at most
    ``max_rows`` rows.  Beyond that both sides are joined on the keys and a
    salt, every lookup row being repeated ``SALTS`` times, so a key that
    holds a third of all rows is spread over ``SALTS`` tasks.
    """
    rows = lookup.limit(max_rows + 1).collect()
    right = {k: f"_lookup_{k}" for k in keys}
    if len(rows) <= max_rows:
        small = df.sparkSession.createDataFrame(rows, lookup.schema).withColumnsRenamed(right)
        on = [df[k].eqNullSafe(small[r]) for k, r in right.items()]
        return df.join(F.broadcast(small), on, "left").drop(*right.values())
    salted = lookup.withColumnsRenamed(right).withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = df.withColumn("_salt_l", F.pmod(F.xxhash64(salt_by), F.lit(SALTS)).cast("int"))
    on = [left[k].eqNullSafe(salted[r]) for k, r in right.items()] + [left["_salt_l"] == salted["_salt_r"]]
    return left.join(salted, on, "left").drop("_salt_l", "_salt_r", *right.values())


def salted_join(df: DataFrame, lookup: DataFrame, key: str, salt_by: Column, salts: int = 8) -> DataFrame:
    """Inner join of a large table with a small one that has few rows per key, on the key and a salt.

    The small side is repeated once per salt, so the rows of a hot key go to
    ``salts`` tasks whether or not the planner finds the small side small
    enough to broadcast.  Null keys match nothing.
    """
    left = df.withColumn("_salt", F.pmod(F.xxhash64(salt_by), F.lit(salts)).cast("int"))
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [key, "_salt"]).drop("_salt")

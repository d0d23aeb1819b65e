"""Distributed union-find: connected components of a table of links, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import stored

#: Parts that the links of one node are dealt to.
SALTS = 8


def _least(links: DataFrame) -> DataFrame:
    """For every node with a smaller neighbour the smallest one, repeated once for each salt."""
    return (links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("least"))
            .withColumn("salt_r", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))


def _with_least(links: DataFrame, at: str, other: str, how: str) -> DataFrame:
    """Links with the least neighbour of one end; a node with very many links is spread over salts."""
    left = links.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)).cast("int"))
    least = _least(links)
    return left.join(least, (left[at] == least["node"]) & (left["salt"] == least["salt_r"]), how)


def connected_components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns a, b), the root being the smallest node of its component.

    Alternates two steps until nothing changes: hang the larger neighbours of
    each node on its smallest neighbour, then its smaller neighbours and
    itself.  Both keep the components, and chains shorten by half, so the
    number of rounds follows the logarithm of the longest chain.  Every round
    is written to the shared checkpoint folder.  Rows with a null end and
    links of a node with itself are no links; an empty table has no nodes.
    """
    own = links.select(F.col("a"), F.col("b")).where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    now = stored(own.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    seen = None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if not mark[0] or mark == seen:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
        seen = mark
        large = _with_least(now, "a", "b", "left").select(F.coalesce("least", "a").alias("a"), "b")
        hung = _with_least(large, "b", "a", "inner")
        small = hung.select(F.explode(F.array(
            F.struct(F.col("least").alias("a"), F.col("b").alias("b")),
            F.struct(F.col("least").alias("a"), hung["a"].alias("b")))).alias("x")).select("x.a", "x.b").where(F.col("a") != F.col("b"))
        now = stored(small.distinct())

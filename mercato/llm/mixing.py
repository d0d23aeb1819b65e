"""Mixing sources to target weights by Poisson replication.

A source of weight w and size s (characters) is to be repeated at the mean
rate ``w / sum(w) * target / s``.  Every document draws its number of copies
from a Poisson distribution with that mean by inverting it at a number in
[0, 1) hashed from its id, its text's digest and the seed, so the draw is the
same on every run and in every partition.  Large means are cut into equal
parts of at most ``PART_MEAN``, each with a hash of its own, because the sum
of independent Poisson numbers is one again and the inversion stays exact.
The copies are put in an order hashed from the same key: ranges of that
order are equally full by construction, so no sampling pass is needed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import partitions
from mercato.plans.ranges import attach_lookup

SEED = 20240611
PART_MEAN = 16.0
#: Terms of the distribution function; behind them a part's rest is below 2**-52.
TERMS = 90


def unit(*parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits, hashed from the parts (md5)."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("double") / F.lit(2.0**52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``source, rate`` for every source: its mean number of copies.

    ``weights``: target share of each source (others get none); by default all
    sources weigh alike.  ``epochs``: size of the mixture in sizes of the input.
    """
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.sum(F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0))).cast("long").alias("size"))
    weight = F.lit(1.0)
    if weights is not None:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(w))).otherwise(weight)
    weighted = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    total = weighted.agg(F.sum("weight").alias("w"), F.sum("size").alias("s")).first()
    whole, target = float(total["w"] or 0.0), epochs * float(total["s"] or 0)
    rate = F.when((F.col("weight") > 0) & (F.lit(whole) > 0), F.col("weight") / F.lit(whole or 1.0) * F.lit(target) / F.col("size")).otherwise(0.0)
    return weighted.select("source", rate.alias("rate"))


def cumulative(mean: Column) -> Column:
    """The Poisson distribution function of a mean of at most ``PART_MEAN`` as an array over 0, 1, 2, ..."""
    def step(acc: Column, k: Column) -> Column:
        term = F.when(k == 0, F.exp(-mean)).otherwise(acc["term"] * mean / k)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"), F.concat(acc["all"], F.array(acc["sum"] + term)).alias("all"))

    start = F.struct(F.lit(0.0).alias("term"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("all"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(TERMS)), start, step, lambda acc: acc["all"])


def mix(docs: DataFrame, weights: dict[str, float] | None = None, epochs: float = 1.0, seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mixture: every column of ``docs`` and ``_copies`` (of this document), ``_copy`` (from 0), ``_place``.

    ``_place`` orders the whole mixture at random; partitions are consecutive
    ranges of it, each sorted.  Null sources are one source; a source whose
    texts are all empty or null has no size to weigh and is left out, as are
    sources of weight 0.  Repeated rows (same id and text) draw the same
    number of copies.  An empty table gives an empty mixture.  A column of
    the input whose name is one of the three added ones is replaced.
    """
    own = ["_copies", "_copy", "_place", "_rate", "_source", "_key", "_cdf", "_parts"]
    table = rates(docs, weights, epochs, source_col, text_col)
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    table = table.select(F.col("source").alias("_source"), F.col("rate").alias("_rate"), parts.alias("_parts"), cumulative(F.col("rate") / parts).alias("_cdf"))
    base = docs.drop(*own)
    keyed = base.withColumns({
        "_source": F.col(source_col).cast("string"),
        "_key": F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))})
    rated = attach_lookup(keyed, table, ["_source"], F.col("_key")).where(F.col("_rate") > 0)
    draws = F.transform(F.sequence(F.lit(1), F.col("_parts")), lambda j: unit(F.col("_key"), F.lit("draw"), j.cast("string")))
    copies = F.aggregate(draws, F.lit(0), lambda acc, u: acc + F.size(F.filter(F.col("_cdf"), lambda c: c <= u)))
    drawn = rated.withColumn("_copies", copies).where(F.col("_copies") > 0)
    placed = (drawn.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1)))
              .withColumn("_place", unit(F.col("_key"), F.lit("place"), F.col("_copy").cast("string"))))
    n = partitions(docs.sparkSession)
    return (placed.select(*base.columns, "_copies", "_copy", "_place")
            .repartitionById(n, F.floor(F.col("_place") * n).cast("int"))
            .sortWithinPartitions("_place", id_col, "_copy"))


def oracle_sql(seed: int = SEED) -> str:
    """DuckDB SQL for the mixture of documents with equal weights and one epoch."""
    return f"""
    with recursive sizes as (
      select source, sum(coalesce(length(text), 0)) as size from documents group by 1),
    rate as (
      select source, 1.0::double / (select count(*) from sizes where size > 0)::double
             * (select sum(size) from sizes)::double / size::double as rate from sizes where size > 0),
    parts as (select source, rate, greatest(ceil(rate / {PART_MEAN}), 1)::int as parts from rate),
    cdf as (
      select source, 0 as k, exp(-(rate / parts)) as term, exp(-(rate / parts)) as total, rate / parts as mean from parts
      union all
      select source, k + 1, term * mean / (k + 1), total + term * mean / (k + 1), mean from cdf where k < {TERMS}),
    draw as (
      select doc_id, source, text, '{seed}|' || coalesce(doc_id::varchar, '') || '|' || md5(coalesce(text, '')) as key,
             length(text) as chars, j
      from documents join parts using (source), range(1, 1 + (select max(parts) from parts)) r(j) where j <= parts),
    hit as (
      select doc_id, source, text, key, chars, j, ('0x' || substr(md5(key || '|draw|' || j), 1, 13))::bigint::double / {2.0**52} as u from draw),
    copies as (
      select doc_id, source, text, key, chars, sum((select count(*) from cdf c where c.source = hit.source and c.total <= hit.u))::int as n
      from hit group by all)
    select doc_id, source, chars as n_chars, n as copies, i::int as copy,
           ('0x' || substr(md5(key || '|place|' || i), 1, 13))::bigint::double / {2.0**52} as place, text
    from copies, range(0, (select max(n) from copies)) c(i) where i < n
    """

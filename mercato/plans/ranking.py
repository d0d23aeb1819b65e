"""Global rank and running sums without a single-task window.

``Window.orderBy`` with no partition moves every row into one task.  Here a
two-level range index takes its place.  Spark's own range partitioning deals
the rows to buckets of about ``rows_per_bucket`` (rows with equal keys by a
hash of the row, so a key that holds a third of all rows fills many buckets),
and the rows are written with the number of their bucket, which is so fixed
whatever is recomputed later.  Buckets are grouped into blocks of
``BUCKETS_PER_BLOCK``: a block's offset is a running sum over the blocks, a
bucket's one over the buckets of its block, a row's one over the rows of its
bucket.

Offsets are handed down without a join, a literal or a trip to the driver:
each is a row of its own that stands first in its window, so the running sums
below begin with it.  Neither the plan nor the generated code knows how many
buckets there are.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.plans.lineage import materialize

ROWS_PER_BUCKET = 2_000_000
#: Buckets that share an offset; a block has about two billion rows.
BUCKETS_PER_BLOCK = 1024


@dataclass
class Totals:
    n: int
    sums: dict[str, float | int | None]


def _running(rows: DataFrame, group: str, order: list[Column], adds: list[str], lags: list[str], heads: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_upto_<a>`` and ``_before_<a>``, the running sums of ``adds`` in each group with and without
    the row, and ``_last_<l>``, the value in the row before, for ``lags``.

    ``heads``: one row for each group with what came before it.
    """
    held = rows.withColumn("_head", F.lit(1))
    if heads is not None:
        held = held.unionByName(heads.withColumn("_head", F.lit(0)), allowMissingColumns=True)
    inside = Window.partitionBy(group).orderBy("_head", *order)
    upto, before = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow), inside.rowsBetween(Window.unboundedPreceding, -1)
    summed = held.withColumns(
        {f"_upto_{a}": F.sum(a).over(upto) for a in adds} | {f"_before_{a}": F.sum(a).over(before) for a in adds}
        | {f"_last_{c}": F.lag(c).over(inside) for c in lags})
    return summed.where(F.col("_head") == 1).drop("_head")


def _heads(rows: DataFrame, group: str, adds: list[str], lags: list[str]) -> DataFrame:
    """Each group with what came before its first row, from the running sums."""
    return rows.select(group, *[F.coalesce(f"_before_{a}", F.lit(0).cast(rows.schema[a].dataType)).alias(a) for a in adds], *[F.col(f"_last_{c}").alias(c) for c in lags])


def bucketed(df: DataFrame, order: list[Column], buckets: int) -> DataFrame:
    """``df`` dealt to ranges of the order, with the number of its range (``_bucket``), written once."""
    session = df.sparkSession
    tasks = max(int(session.conf.get("spark.sql.shuffle.partitions")), session.sparkContext.defaultParallelism)
    ranged = df.repartitionByRange(buckets, *order).withColumn("_bucket", F.spark_partition_id())
    # many small buckets are written by few tasks; the number of a row's bucket does not change by that
    return materialize(ranged.coalesce(tasks) if buckets > tasks else ranged)


def ranked_prefix_sums(
    df: DataFrame,
    order_cols: list[str],
    sum_cols: list[str],
    rows_per_bucket: int = ROWS_PER_BUCKET,
    descending: bool = False,
    lag_cols: list[str] | None = None,
    buckets_per_block: int = BUCKETS_PER_BLOCK,
) -> tuple[DataFrame, Totals]:
    """Add ``rank`` (1-based, ascending by ``order_cols``, or descending),
    inclusive running sums ``cum_<c>`` and exclusive ones ``before_<c>`` for
    each of ``sum_cols``, and ``previous_<c>``, the value in the row before,
    for each of ``lag_cols``; also return the totals.

    Ordered as Spark orders: null before all, NaN after all other numbers.
    Null values add nothing to a sum.  Rows with equal keys are ranked by a
    hash of the row, alike each time the result is read.  ``df`` is read twice
    (totals, then sampled and written by ranges).
    """
    lag_cols = lag_cols or []
    sum_types = {c: T.LongType() if isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else T.DoubleType() for c in sum_cols}
    tot_row = df.agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sum_cols]).first()
    totals = Totals(int(tot_row["n"]), {c: tot_row[c] for c in sum_cols})
    buckets = max(1, math.ceil(totals.n / max(1, rows_per_bucket)))

    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    added = {f"_add_{c}": F.coalesce(F.col(c).cast(sum_types[c]), F.lit(0).cast(sum_types[c])) for c in sum_cols}
    adds = ["_n", *added]
    keys = [*order_cols, "_tie"]
    order = [F.col(c).desc() if descending else F.col(c).asc() for c in keys]
    rows = bucketed(df.withColumns({"_tie": F.xxhash64(*hashed)}), order, buckets).withColumns({"_n": F.lit(1).cast("long")} | added)

    key = F.struct(*keys)
    last = F.min_by if descending else F.max_by
    by_bucket = rows.groupBy("_bucket").agg(*[F.sum(a).alias(a) for a in adds], *[last(F.struct(c), key)[c].alias(c) for c in lag_cols])
    by_bucket = by_bucket.withColumn("_block", F.floor(F.col("_bucket") / buckets_per_block).cast("int"))
    by_block = by_bucket.groupBy("_block").agg(*[F.sum(a).alias(a) for a in adds], *[F.max_by(F.struct(c), "_bucket")[c].alias(c) for c in lag_cols])
    # one row for about two billion, so these few are in one window
    blocks = _running(by_block.withColumn("_all", F.lit(0)), "_all", [F.col("_block")], adds, lag_cols)
    starts = _running(by_bucket, "_block", [F.col("_bucket")], adds, lag_cols, _heads(blocks, "_block", adds, lag_cols))
    ranked = _running(rows, "_bucket", order, adds, lag_cols, _heads(starts, "_bucket", adds, lag_cols))
    return ranked.select(
        *df.columns, F.col("_upto__n").alias("rank"),
        *[F.col(f"_upto__add_{c}").alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"_before__add_{c}").alias(f"before_{c}") for c in sum_cols],
        *[F.col(f"_last_{c}").alias(f"previous_{c}") for c in lag_cols],
    ), totals

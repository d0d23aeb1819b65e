"""Exact quantiles without pulling a column into one task.

Spark's exact ``percentile`` keeps every distinct value of the group in
one aggregation buffer, which for a whole-table column ends in a single
task.  Here the values are first counted per distinct value (a partial
aggregate, so a value repeated a billion times is one row early), the
distinct values are ranked with running counts (``ranked_prefix_sums``),
and only the handful of rows that hold the wanted positions come back.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.plans.lineage import materialize
from mercato.plans.ranking import ROWS_PER_BUCKET, ranked_prefix_sums


def _lerp(a: float, b: float, t: float) -> float:
    # numpy's linear interpolation, stable at both ends
    d = b - a
    return b - d * (1.0 - t) if t >= 0.5 else a + d * t


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``v, c``: every value of the column (null and NaN left out) and how often it occurs, written once."""
    c = F.col(col).cast("double")
    return materialize(df.where(c.isNotNull() & ~F.isnan(c)).groupBy(c.alias("v")).agg(F.count(F.lit(1)).alias("c")))


def exact_quantiles(
    df: DataFrame, col: str, probs: list[float], rows_per_bucket: int = ROWS_PER_BUCKET
) -> dict[float, float | None]:
    """Linearly interpolated quantiles at ``probs`` (as ``numpy.percentile``), nulls and NaN ignored."""
    return counted_quantiles(value_counts(df, col), probs, rows_per_bucket)


def counted_quantiles(
    counts: DataFrame, probs: list[float], rows_per_bucket: int = ROWS_PER_BUCKET
) -> dict[float, float | None]:
    """``exact_quantiles`` from the ``value_counts`` of a column."""
    ranked, totals = ranked_prefix_sums(counts, ["v"], ["c"], rows_per_bucket=rows_per_bucket)
    n = int(totals.sums["c"] or 0)
    if n == 0:
        return {q: None for q in probs}
    wanted: dict[float, tuple[int, int, float]] = {}
    for q in probs:
        pos = n * q + (1.0 - q) - 1.0
        lo = min(max(int(math.floor(pos)), 0), n - 1)
        hi = min(lo + 1, n - 1)
        wanted[q] = (lo, hi, pos - math.floor(pos))
    positions = sorted({p for lo, hi, _ in wanted.values() for p in (lo, hi)})
    # 0-based positions held by a value: [cum_c - c, cum_c - 1]
    start = F.col("cum_c") - F.col("c")
    hit = None
    for p in positions:
        cond = (start <= p) & (F.col("cum_c") > p)
        hit = cond if hit is None else hit | cond
    rows = ranked.where(hit).select("v", "c", "cum_c").collect()
    at: dict[int, float] = {}
    for r in rows:
        for p in positions:
            if r["cum_c"] - r["c"] <= p < r["cum_c"]:
                at[p] = r["v"]
    return {q: _lerp(at[lo], at[hi], t) for q, (lo, hi, t) in wanted.items()}

"""Descriptive statistics: summaries, histograms, correlations, z-scores, KDE curves.

All heavy work is a Spark aggregation; where a few statistics have to be
known before the next step (z-scores, histogram range, KDE bandwidth) they
come back as scalars and enter the next plan as literals.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.exprs import bin_edge, bin_index, round_half_even
from mercato.plans.blocks import Moments, block_states
from mercato.plans.lineage import materialize
from mercato.plans.quantiles import counted_quantiles, value_counts
from mercato.plans.ranges import salted_join

# The numeric columns of the order training table (ids excluded).
ORDER_NUMERIC = [
    "wait_time", "expected_wait_time", "delay_vs_expected", "review_score", "dim_is_five_star",
    "dim_is_one_star", "number_of_products", "number_of_sellers", "price", "freight_value",
    "distance_seller_customer",
]
# The regressors standardised for the multivariate model.
ZSCORE_COLUMNS = [
    "wait_time", "delay_vs_expected", "number_of_products", "number_of_sellers", "price",
    "freight_value", "distance_seller_customer",
]


def _num(c: str) -> Column:
    return F.col(c).cast("double")


def describe_column(df: DataFrame, col: str) -> DataFrame:
    """One row: ``variable, count, mean, std, min, p25, p50, p75, max`` (sample std,
    exact linearly interpolated quartiles).  The table is read once, for the count of each value."""
    counts = value_counts(df, col)
    c, v = F.col("c"), F.col("v")
    stats = counts.agg(F.sum(c).alias("count"), (F.sum(c * v) / F.sum(c)).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max")).first()
    n = int(stats["count"] or 0)
    spread = counts.agg(F.sum(c * (v - F.lit(stats["mean"])) * (v - F.lit(stats["mean"])))).first()[0] if n > 1 else None
    q = counted_quantiles(counts, [0.25, 0.5, 0.75])
    schema = T.StructType(
        [T.StructField("variable", T.StringType()), T.StructField("count", T.LongType())]
        + [T.StructField(n, T.DoubleType()) for n in ("mean", "std", "min", "p25", "p50", "p75", "max")]
    )
    std = math.sqrt(spread / (n - 1)) if spread is not None else None
    row = (col, n, stats["mean"], std, stats["min"], q[0.25], q[0.5], q[0.75], stats["max"])
    return df.sparkSession.createDataFrame([row], schema)


def data_range(df: DataFrame, col: str) -> tuple[float, float]:
    """``(min, max)`` of the column without missing values, widened by 0.5 each side when they are equal."""
    x = F.when(~F.isnan(_num(col)), _num(col))
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        return 0.0, 1.0
    if lo == hi:
        return lo - 0.5, hi + 0.5
    return float(lo), float(hi)


def histogram(df: DataFrame, col: str, bins: int = 10, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """``bin, bin_lo, bin_hi, count`` for equal-width bins over ``[lo, hi]`` (the
    data range by default); empty bins appear with count 0, values outside
    the range are not counted."""
    if lo is None or hi is None:
        lo, hi = data_range(df, col)
    counts = (
        df.select(bin_index(col, lo, hi, bins).alias("bin"))
        .where(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # both sides hold at most `bins` rows; the counts side is the one a left join can broadcast
    return (
        grid.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            bin_edge(F.col("bin"), lo, hi, bins).alias("bin_lo"),
            bin_edge(F.col("bin") + 1, lo, hi, bins).alias("bin_hi"),
            F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count"),
        )
    )


def histogram_by(
    df: DataFrame, col: str, by: str, bins: int = 10, lo: float | None = None, hi: float | None = None
) -> DataFrame:
    """The histogram of ``col`` for each non-null value of ``by``: ``by, bin, bin_lo, bin_hi, count``.

    One pass over the data: counts per (category, bin), where values out of
    range form one extra key so every category is seen; then per category
    its at most ``bins + 1`` counts (a proven bound) become a map from which
    all ``bins`` rows are generated, empty bins included.
    """
    if lo is None or hi is None:
        lo, hi = data_range(df, col)
    counts = (
        df.where(F.col(by).isNotNull())
        .groupBy(by, F.coalesce(bin_index(col, lo, hi, bins), F.lit(-1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    per_category = counts.groupBy(by).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "count"))).alias("counts")
    )
    b = F.col("bin")
    return per_category.select(by, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "counts").select(
        by,
        b,
        bin_edge(b, lo, hi, bins).alias("bin_lo"),
        bin_edge(b + 1, lo, hi, bins).alias("bin_hi"),
        F.coalesce(F.col("counts")[b], F.lit(0)).cast("bigint").alias("count"),
    )


def round_column(df: DataFrame, col: str, decimals: int = 0) -> DataFrame:
    """The column rounded half-to-even in place."""
    return df.withColumn(col, round_half_even(col, decimals))


def preview(df: DataFrame, order_by: list[str], n: int = 5) -> DataFrame:
    """The first ``n`` rows in ``order_by`` order (a key makes "first" defined)."""
    return df.orderBy(*order_by).limit(n)


def correlation_matrix(df: DataFrame, cols: list[str] = ORDER_NUMERIC) -> DataFrame:
    """Pearson correlation of every ordered pair of ``cols`` as ``x, y, corr``.

    One pass with one matrix-valued state a task (``blocks.Moments``).  Rows
    where either value is missing drop out of that pair only (pairwise
    complete).  A column that is constant over a pair's rows gives null.
    """
    moments, = block_states(df, cols, [(Moments, list(range(len(cols))))])

    def corr(i: int, j: int) -> float | None:
        a, b = moments.square[i, j], moments.square[j, i]
        return float(moments.product[i, j] / math.sqrt(a * b)) if a > 0 and b > 0 else float("nan") if math.isnan(a * b) else None

    schema = T.StructType([T.StructField("x", T.StringType()), T.StructField("y", T.StringType()), T.StructField("corr", T.DoubleType())])
    k = range(len(cols))
    return df.sparkSession.createDataFrame([(cols[i], cols[j], corr(i, j)) for i in k for j in k], schema)


def zscore(df: DataFrame, cols: list[str] = ZSCORE_COLUMNS, nan_policy: str = "propagate") -> DataFrame:
    """Columns replaced by ``(x - mean) / population std``.

    ``nan_policy="propagate"``: a column with any missing value becomes all
    missing; ``"omit"``: statistics skip missing values, which stay missing.
    A constant column becomes missing.  Statistics come from one aggregation.
    """
    aggs = []
    for c in cols:
        aggs += [F.avg(_num(c)).alias(f"m_{c}"), F.stddev_pop(_num(c)).alias(f"s_{c}"),
                 F.count(F.when(_num(c).isNull() | F.isnan(_num(c)), 1)).alias(f"n_{c}")]
    st = df.agg(*aggs).first()
    out = {}
    for c in cols:
        m, s, nulls = st[f"m_{c}"], st[f"s_{c}"], st[f"n_{c}"]
        if m is None or s is None or s == 0 or (nulls and nan_policy == "propagate"):
            out[c] = F.lit(None).cast("double")
        else:
            out[c] = (_num(c) - F.lit(m)) / F.lit(s)
    return df.withColumns(out)


#: Bins a bandwidth, moments kept of each bin, and bandwidths beyond which a kernel is taken to be zero.
KDE_BINS, KDE_MOMENTS, KDE_REACH = 4, 12, 9.0


def _kernel_sum(moments: Column, t: Column) -> Column:
    """The kernels of a bin's values at a point ``t`` bandwidths from the bin's centre, from the moments of the values.

    exp(-(t - s)^2 / 2) is the sum of s^m / m! He_m(t) exp(-t^2 / 2) over m,
    with the Hermite polynomials He_0 = 1, He_1 = t, He_(m+1) = t He_m - m He_(m-1).
    """
    def step(acc: Column, moment: Column) -> Column:
        return F.struct((acc["m"] + 1).alias("m"), acc["he"].alias("before"), (t * acc["he"] - acc["m"] * acc["before"]).alias("he"),
                        (acc["scale"] / (acc["m"] + 1)).alias("scale"), (acc["sum"] + moment * acc["scale"] * acc["he"]).alias("sum"))

    start = F.struct(F.lit(0.0).alias("m"), F.lit(0.0).alias("before"), F.lit(1.0).alias("he"), F.lit(1.0).alias("scale"), F.lit(0.0).alias("sum"))
    return F.aggregate(moments, start, step, lambda acc: acc["sum"]) * F.exp(F.lit(-0.5) * t * t)


def kde_bins(values: DataFrame, params: DataFrame, by: str) -> DataFrame:
    """``by``, the group's parameters, ``center`` and ``moments`` of every bin that has values: a bounded histogram of each group."""
    held = salted_join(values, params, by, F.col("v"), 32)  # a group's values are spread over tasks
    width = F.col("bw") / KDE_BINS
    held = held.withColumn("bin", F.floor((F.col("v") - F.col("lo")) / width))
    held = held.withColumn("center", F.col("lo") + (F.col("bin") + F.lit(0.5)) * width)
    held = held.withColumn("s", (F.col("v") - F.col("center")) / F.col("bw"))
    powers = [F.sum(F.pow("s", F.lit(float(m))) if m else F.lit(1.0)).alias(f"m{m}") for m in range(KDE_MOMENTS)]
    own = [c for c in params.columns if c != by]
    # the parameters depend on the group alone, the centre on group and bin, so grouping by them adds no split
    return held.groupBy(by, "bin", "center", *own).agg(*powers).select(by, *own, "center", F.array(*[f"m{m}" for m in range(KDE_MOMENTS)]).alias("moments"))


def kde_curve(
    df: DataFrame, col: str, by: str, grid_points: int = 200, cut: float = 3.0
) -> DataFrame:
    """Gaussian kernel density of ``col`` for each value of ``by`` on a grid.

    Bandwidth: Scott's rule, sample std * n^(-1/5).  The grid spans
    ``[min - cut*bw, max + cut*bw]`` in ``grid_points`` points.  Groups with
    fewer than two values or no spread are left out.  Output:
    ``by, point, x, density``.

    The values are written once and aggregated twice, first to each group's
    parameters, then to bins a quarter of a bandwidth wide, of which the count
    and the powers of the distances to the centre are kept (both aggregates
    combine before they are shuffled).  From there on rows and work depend on
    the bins and the grid only: a bin meets the grid points within nine
    bandwidths.  Unlike a plain binned estimate this is exact but for rounding:
    with |s| <= 1/8 what twelve powers leave out of a kernel of height 1 is
    at most 1.1 (1/8)^12 / sqrt(12!) < 1e-15 (Cramer's inequality), and what
    lies beyond nine bandwidths is under 3e-18, so a density is within
    1.1e-15 / (bw sqrt(2 pi)) of the exact one.
    """
    x = _num(col)
    values = materialize(df.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")) & F.col(by).isNotNull()).select(by, x.alias("v")))
    params = (
        values.groupBy(by)
        .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"))
        .where((F.col("n") >= 2) & (F.col("sd") > 0) & (F.col("hi") > F.col("lo")))
        .withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2)))
        .withColumn("g_lo", F.col("lo") - F.col("bw") * cut)
        .withColumn("g_hi", F.col("hi") + F.col("bw") * cut)
        .withColumn("g_step", (F.col("g_hi") - F.col("g_lo")) / (grid_points - 1))
        .select(by, "n", "lo", "bw", "g_lo", "g_hi", "g_step")
    )
    point = F.col("point")
    grid_x = F.when(point == grid_points - 1, F.col("g_hi")).otherwise(
        point.cast("double") * F.col("g_step") + F.col("g_lo")
    )
    bins = kde_bins(values, params, by)
    reach = F.lit(KDE_REACH) * F.col("bw")
    first = F.greatest(F.ceil((F.col("center") - reach - F.col("g_lo")) / F.col("g_step")), F.lit(0))
    last = F.least(F.floor((F.col("center") + reach - F.col("g_lo")) / F.col("g_step")), F.lit(grid_points - 1))
    near = bins.where(first <= last).withColumn("point", F.explode(F.sequence(first, last))).withColumn("x", grid_x)
    added = near.select(by, "point", _kernel_sum(F.col("moments"), (F.col("x") - F.col("center")) / F.col("bw")).alias("s"))
    # every point of every group, also where no kernel reaches
    grid = params.withColumn("point", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(grid_points - 1).cast("long")))).withColumn("x", grid_x)
    grid = grid.select(by, "point", F.lit(0.0).alias("s"), "x", (F.col("n") * F.col("bw") * F.lit(math.sqrt(2.0 * math.pi))).alias("norm"))
    return (
        added.unionByName(grid, allowMissingColumns=True)
        .groupBy(by, "point")
        .agg(F.sum("s").alias("s"), F.max("x").alias("x"), F.max("norm").alias("norm"))
        .select(by, F.col("point").cast("int").alias("point"), "x", (F.col("s") / F.col("norm")).alias("density"))
    )

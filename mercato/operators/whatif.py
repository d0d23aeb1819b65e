"""What-if analysis: global profit after removing the least profitable sellers.

Input is any per-seller table with ``seller_id, profits, quantity`` (the
seller training table).  Removing the ``k`` lowest-profit sellers leaves

    P(k) = sum of the other profits - (alpha * sqrt(n - k) + beta * sqrt(their quantity))

so the whole curve is one ranked running sum (``mercato.plans.ranking``)
from the most profitable seller down, not a loop that rescans the table
per step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.config import DEFAULT, EconomicsConfig
from mercato.functions.exprs import round_half_even
from mercato.plans.ranking import ROWS_PER_BUCKET, ranked_prefix_sums

ORDER = ["profits", "seller_id"]  # seller_id breaks ties so the order is defined


def it_costs_expr(n_sellers: Column, quantity: Column, cfg: EconomicsConfig = DEFAULT) -> Column:
    return F.lit(cfg.it_alpha) * F.sqrt(n_sellers.cast("double")) + F.lit(cfg.it_beta) * F.sqrt(
        quantity.cast("double")
    )


def it_costs(sellers: DataFrame, cfg: EconomicsConfig = DEFAULT) -> DataFrame:
    """``n_sellers, n_products, it_costs``: IT cost of running these sellers."""
    return sellers.agg(
        F.count(F.lit(1)).alias("n_sellers"), F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("n_products")
    ).withColumn("it_costs", it_costs_expr(F.col("n_sellers"), F.col("n_products"), cfg))


def global_profit(sellers: DataFrame, cfg: EconomicsConfig = DEFAULT) -> DataFrame:
    """``n_sellers, n_products, total_profits, it_costs, global_profit``."""
    return (
        sellers.agg(
            F.count(F.lit(1)).alias("n_sellers"),
            F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("n_products"),
            F.coalesce(F.sum("profits"), F.lit(0.0)).alias("total_profits"),
        )
        .withColumn("it_costs", it_costs_expr(F.col("n_sellers"), F.col("n_products"), cfg))
        .withColumn("global_profit", F.col("total_profits") - F.col("it_costs"))
    )


def ranked_sellers(sellers: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET, descending: bool = False):
    """Sellers ranked by profit (ascending unless ``descending``) with running
    ``cum_profits``/``cum_quantity`` in that order, and the totals."""
    base = sellers.select("seller_id", F.col("profits").cast("double"), F.col("quantity").cast("bigint"))
    return ranked_prefix_sums(
        base, ORDER, ["profits", "quantity"], rows_per_bucket=rows_per_bucket, descending=descending
    )


def sellers_by_profit(sellers: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``seller_id, profits, quantity, profit_rank`` (1 = least profitable)."""
    ranked, _ = ranked_sellers(sellers, rows_per_bucket)
    return ranked.select("seller_id", "profits", "quantity", F.col("rank").alias("profit_rank"))


def _curve_points(sellers: DataFrame, cfg: EconomicsConfig, rows_per_bucket: int):
    """``Dropped_sellers, profit, next_profit`` for 0..n dropped sellers.

    Ranked from the most profitable seller down, the running sums at a
    seller are exactly what remains once every less profitable seller is
    gone, and the sums before it what remains once it is gone as well, so
    each row knows its point of the curve and the one that follows.  The last
    point (everyone dropped) is zero and has none after it.
    """
    ranked, t = ranked_sellers(sellers, rows_per_bucket, descending=True)
    remaining = F.col("rank")
    points = ranked.select(
        (F.lit(t.n) - remaining).cast("bigint").alias("Dropped_sellers"),
        (F.col("cum_profits") - it_costs_expr(remaining, F.col("cum_quantity"), cfg)).alias("profit"),
        (F.col("before_profits") - it_costs_expr(remaining - 1, F.col("before_quantity"), cfg)).alias("next_profit"),
    )
    everyone = sellers.sparkSession.range(1).select(
        F.lit(t.n).cast("bigint").alias("Dropped_sellers"),
        (F.lit(0.0) - it_costs_expr(F.lit(0), F.lit(0), cfg)).alias("profit"),
        F.lit(None).cast("double").alias("next_profit"),
    )
    return points.unionByName(everyone), t


def whatif_curve(
    sellers: DataFrame,
    cfg: EconomicsConfig = DEFAULT,
    steps: int | None = None,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """``Dropped_sellers, Profit`` for 0..steps sellers removed (all of them by default).

    ``Profit`` is rounded half-to-even to cents.  Row 0 is the baseline.
    """
    points, t = _curve_points(sellers, cfg, rows_per_bucket)
    if steps is not None:
        points = points.where(F.col("Dropped_sellers") <= min(steps, t.n))
    return points.select("Dropped_sellers", round_half_even("profit", 2).alias("Profit"))


def whatif_greedy_optimum(
    sellers: DataFrame, cfg: EconomicsConfig = DEFAULT, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """Remove the least profitable seller while profit does not fall.

    ``Dropped_sellers`` = the step before the first fall and ``Profit`` its
    profit (cents).  If profit never falls every seller is dropped (profit 0).
    """
    points, t = _curve_points(sellers, cfg, rows_per_bucket)
    k = F.col("Dropped_sellers")
    first_fall = points.where(F.col("next_profit") < F.col("profit")).agg(F.min(k).alias("k"), F.min_by("profit", k).alias("p"))
    return first_fall.select(
        F.coalesce(F.col("k"), F.lit(t.n).cast("bigint")).alias("Dropped_sellers"),
        round_half_even(F.coalesce(F.col("p"), F.lit(0.0)), 2).alias("Profit"),
    )


def whatif_greedy_log(
    sellers: DataFrame, cfg: EconomicsConfig = DEFAULT, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """The steps a greedy removal goes through: the baseline, every step that
    does not lower the profit, and the first one that does (``Dropped_sellers,
    Profit``); all steps if the profit never falls."""
    points, t = _curve_points(sellers, cfg, rows_per_bucket)
    k = F.col("Dropped_sellers")
    stop = points.where(F.col("next_profit") < F.col("profit")).agg(F.min(k).alias("k")).first()["k"]
    shown = points if stop is None else points.where(k <= stop + 1)
    return shown.select("Dropped_sellers", round_half_even("profit", 2).alias("Profit"))


def whatif_global_optimum(
    sellers: DataFrame, cfg: EconomicsConfig = DEFAULT, rows_per_bucket: int = ROWS_PER_BUCKET
) -> DataFrame:
    """The number of removed sellers with the highest profit (fewest on a tie)."""
    points, _ = _curve_points(sellers, cfg, rows_per_bucket)
    best = points.agg(
        F.max(F.struct(F.col("profit"), (-F.col("Dropped_sellers")).alias("neg_k"))).alias("best")
    )
    return best.select(
        (-F.col("best.neg_k")).alias("Dropped_sellers"), round_half_even(F.col("best.profit"), 2).alias("Profit")
    )


def worst_sellers(sellers: DataFrame, n: int = 200) -> DataFrame:
    """The ``n`` least profitable sellers (top-k report; default the recommended 200)."""
    return sellers.orderBy(F.col("profits").asc(), F.col("seller_id").asc()).limit(n)

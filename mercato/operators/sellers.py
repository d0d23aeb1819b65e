"""Seller-level feature tables and unit economics, keyed by ``seller_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.config import DEFAULT, EconomicsConfig
from mercato.functions.exprs import (
    DAY_MICROS,
    avg_months_between,
    days_between,
    micros_between,
    positive_or_zero,
    round_half_even,
    star_flag,
    sum_or_zero,
)
from mercato.operators.orders import order_review_score, order_training

Tables = dict[str, DataFrame]

TRAINING_COLUMNS = [
    "seller_id", "seller_city", "seller_state", "delay_to_carrier", "wait_time",
    "date_first_sale", "date_last_sale", "months_on_olist", "n_orders", "quantity",
    "quantity_per_order", "sales", "revenue", "review_costs", "profits",
    "share_of_one_stars", "share_of_five_stars", "review_score",
]

# Names of the per-star count columns, five stars first.
STAR_COLUMNS = {
    5: "dim_is_five_star",
    4: "dim_is_four_star",
    3: "dim_is_three_star",
    2: "dim_is_two_star",
    1: "dim_is_one_star",
}


def seller_features(tables: Tables) -> DataFrame:
    """``seller_id, seller_city, seller_state`` without duplicate rows."""
    return tables["sellers"].drop("seller_zip_code_prefix").distinct()


def _seller_item_aggregates(tables: Tables) -> DataFrame:
    """Everything the seller table needs from the items, in one aggregation.

    Orders are first reduced to one row per ``order_id`` that keeps what
    the item-level formulas need from all of that order's rows (row counts
    and sums over the delivered rows, first and last approval).  Each item
    then meets at most one such row (a left join), so item counts and sales
    are those of the items alone, while delay and wait are the item-weighted
    means over items joined to delivered order rows, with the multiplicity
    of duplicated order rows kept as weights.  One scan and one shuffle of
    the items (on ``order_id``) serve timing, quantities and sales; the
    distinct order count reuses that partitioning.
    """
    delivered = F.col("order_status") == "delivered"
    epoch = F.make_timestamp_ntz(F.lit(1970), F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0))
    carrier = micros_between(epoch, F.col("order_delivered_carrier_date"))
    per_order = tables["orders"].groupBy("order_id").agg(
        F.count(F.when(delivered, F.lit(1))).alias("n_delivered"),
        F.count(F.when(delivered, carrier)).alias("n_carrier"),
        F.sum(F.when(delivered, carrier)).alias("sum_carrier"),
        F.count(F.when(delivered, days_between("order_purchase_timestamp", "order_delivered_customer_date")))
        .alias("n_wait"),
        F.sum(F.when(delivered, days_between("order_purchase_timestamp", "order_delivered_customer_date")))
        .alias("sum_wait"),
        F.min("order_approved_at").alias("first_approved"),
        F.max("order_approved_at").alias("last_approved"),
    )
    limit = micros_between(epoch, F.col("shipping_limit_date"))
    # sum over this item's delivered order rows of (carrier - limit), and how many such rows
    delay_weight = F.when(limit.isNotNull(), F.col("n_carrier")).otherwise(F.lit(0))
    delay_sum = F.when(
        limit.isNotNull() & (F.col("n_carrier") > 0), F.col("sum_carrier") - F.col("n_carrier") * limit
    ) / F.lit(float(DAY_MICROS))
    return (
        tables["order_items"]
        .select("order_id", "seller_id", "shipping_limit_date", "price")
        .where(F.col("seller_id").isNotNull())
        .join(per_order, "order_id", "left")
        .groupBy("seller_id")
        .agg(
            F.count_distinct("order_id").alias("n_orders"),
            F.count("order_id").alias("quantity"),
            sum_or_zero("price").alias("sales"),
            F.coalesce(F.sum("n_delivered"), F.lit(0)).alias("n_delivered_items"),
            F.sum(delay_sum).alias("delay_sum"),
            F.sum(delay_weight).alias("delay_n"),
            F.sum("sum_wait").alias("wait_sum"),
            F.sum("n_wait").alias("wait_n"),
            F.min("first_approved").alias("date_first_sale"),
            F.max("last_approved").alias("date_last_sale"),
        )
        .withColumns(
            {
                "mean_delay": F.try_divide(F.col("delay_sum"), F.col("delay_n").cast("double")),
                "wait_time": F.try_divide(F.col("wait_sum"), F.col("wait_n").cast("double")),
                "quantity_per_order": F.try_divide(F.col("quantity"), F.col("n_orders")),
            }
        )
    )


def seller_delay_wait(tables: Tables) -> DataFrame:
    """``delay_to_carrier`` (mean days past the shipping limit, 0 when not
    positive or missing) and ``wait_time`` (mean days to the customer), over
    the items of delivered orders; item-weighted."""
    return (
        _seller_item_aggregates(tables)
        .where(F.col("n_delivered_items") > 0)
        .select("seller_id", positive_or_zero("mean_delay").alias("delay_to_carrier"), "wait_time")
    )


def seller_active_dates(tables: Tables) -> DataFrame:
    """First and last approval date of the seller's orders and the rounded
    number of average-length months between them."""
    return (
        _seller_item_aggregates(tables)
        .where(F.col("date_first_sale").isNotNull())
        .select(
            "seller_id",
            "date_first_sale",
            "date_last_sale",
            round_half_even(avg_months_between("date_first_sale", "date_last_sale")).alias("months_on_olist"),
        )
    )


def seller_item_stats(tables: Tables) -> DataFrame:
    """``n_orders`` (distinct), ``quantity`` (item rows), ``quantity_per_order``, ``sales``."""
    return _seller_item_aggregates(tables).select("seller_id", "n_orders", "quantity", "sales", "quantity_per_order")


def seller_quantity(tables: Tables) -> DataFrame:
    return seller_item_stats(tables).select("seller_id", "n_orders", "quantity", "quantity_per_order")


def seller_sales(tables: Tables) -> DataFrame:
    return seller_item_stats(tables).select("seller_id", "sales")


def order_seller_pairs(tables: Tables) -> DataFrame:
    """Distinct ``(order_id, seller_id)``: an order counts once per seller."""
    return tables["order_items"].select("order_id", "seller_id").distinct()


def seller_review_score(tables: Tables) -> DataFrame:
    """Shares of one- and five-star reviews and mean score over the seller's orders."""
    return (
        order_seller_pairs(tables)
        .join(order_review_score(tables), "order_id")
        .where(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(
            F.avg("dim_is_one_star").alias("share_of_one_stars"),
            F.avg("dim_is_five_star").alias("share_of_five_stars"),
            F.avg("review_score").alias("review_score"),
        )
    )


def seller_review_counts(tables: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Number of 5, 4, 3, 2 and 1-star reviews per seller, over the orders of
    the order training table (delivered, complete; one row per review)."""
    if orders is None:
        orders = order_training(tables)
    reviews = orders.select("order_id", "review_score")
    return (
        order_seller_pairs(tables)
        .join(reviews, "order_id")
        .where(F.col("seller_id").isNotNull())
        .groupBy("seller_id")
        .agg(*[F.sum(star_flag("review_score", k)).cast("bigint").alias(c) for k, c in STAR_COLUMNS.items()])
    )


def review_costs_expr(cfg: EconomicsConfig = DEFAULT):
    terms = [F.col(STAR_COLUMNS[k]) * F.lit(cost) for k, cost in sorted(cfg.review_cost.items(), reverse=True) if cost]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return total


def seller_review_costs(
    tables: Tables, cfg: EconomicsConfig = DEFAULT, orders: DataFrame | None = None
) -> DataFrame:
    """``seller_id, review_costs``: reputation cost of the seller's bad reviews."""
    return seller_review_counts(tables, orders).select("seller_id", review_costs_expr(cfg).alias("review_costs"))


def revenue_expr(cfg: EconomicsConfig = DEFAULT):
    return F.col("sales") * F.lit(cfg.sales_fee) + F.col("months_on_olist") * F.lit(cfg.monthly_fee)


def seller_revenue(tables: Tables, cfg: EconomicsConfig = DEFAULT) -> DataFrame:
    """``seller_id, revenue``: sales fee on all items plus the monthly subscription."""
    return (
        seller_item_stats(tables)
        .join(seller_active_dates(tables), "seller_id")
        .select("seller_id", revenue_expr(cfg).alias("revenue"))
    )


def seller_profits(
    tables: Tables, cfg: EconomicsConfig = DEFAULT, orders: DataFrame | None = None
) -> DataFrame:
    """``seller_id, revenue, review_costs, profits``; sellers with no complete
    reviewed order have no review costs and are dropped (inner join)."""
    return (
        seller_revenue(tables, cfg)
        .join(seller_review_costs(tables, cfg, orders), "seller_id")
        .withColumn("profits", F.col("revenue") - F.col("review_costs"))
    )


def seller_training(
    tables: Tables, cfg: EconomicsConfig = DEFAULT, orders: DataFrame | None = None
) -> DataFrame:
    """Features, delay and wait, active dates, quantities, sales, profits and
    review shares per seller (18 columns)."""
    # One aggregate over the items gives timing, active dates, quantities and
    # sales; it feeds both the feature columns and the revenue.
    items = _seller_item_aggregates(tables)
    df = (
        seller_features(tables)
        .join(
            items.where((F.col("n_delivered_items") > 0) & F.col("date_first_sale").isNotNull()).select(
                "seller_id",
                positive_or_zero("mean_delay").alias("delay_to_carrier"),
                "wait_time",
                "date_first_sale",
                "date_last_sale",
                round_half_even(avg_months_between("date_first_sale", "date_last_sale")).alias("months_on_olist"),
                "n_orders",
                "quantity",
                "quantity_per_order",
                "sales",
            ),
            "seller_id",
        )
        .withColumn("revenue", revenue_expr(cfg))
        .join(seller_review_costs(tables, cfg, orders), "seller_id")
        .withColumn("profits", F.col("revenue") - F.col("review_costs"))
        .join(seller_review_score(tables), "seller_id")
    )
    return df.select(*TRAINING_COLUMNS)

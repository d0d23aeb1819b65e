"""Order-level feature tables.

``tables`` is a dict of the eight marketplace DataFrames (see
``mercato.sources``).  Every function is lazy and returns a DataFrame keyed
by ``order_id``; the joins are all on ``order_id`` so Spark shuffles each
input once and the joins themselves need no further exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import (
    clamp_non_positive,
    days_between,
    haversine_km,
    star_flag,
    sum_or_zero,
)
from mercato.plans.ranges import salted_join

Tables = dict[str, DataFrame]

TRAINING_COLUMNS = [
    "order_id", "order_status", "wait_time", "expected_wait_time", "delay_vs_expected",
    "review_score", "dim_is_five_star", "dim_is_one_star", "number_of_products",
    "number_of_sellers", "price", "freight_value", "distance_seller_customer",
]


def order_wait_time(tables: Tables, is_delivered: bool = True) -> DataFrame:
    """``order_id, order_status, wait_time, expected_wait_time, delay_vs_expected`` in days.

    Delivered orders only unless ``is_delivered=False``.  Orders with no
    delivery date keep a null wait and delay.
    """
    orders = tables["orders"]
    if is_delivered:
        orders = orders.where(F.col("order_status") == "delivered")
    wait = days_between("order_purchase_timestamp", "order_delivered_customer_date")
    expected = days_between("order_purchase_timestamp", "order_estimated_delivery_date")
    return orders.select(
        "order_id",
        "order_status",
        wait.alias("wait_time"),
        expected.alias("expected_wait_time"),
        clamp_non_positive(wait - expected).alias("delay_vs_expected"),
    )


def order_review_score(tables: Tables) -> DataFrame:
    """One row per review: ``order_id, review_score, dim_is_five_star, dim_is_one_star``."""
    return tables["order_reviews"].select(
        "order_id",
        "review_score",
        star_flag("review_score", 5).alias("dim_is_five_star"),
        star_flag("review_score", 1).alias("dim_is_one_star"),
    )


def order_item_stats(tables: Tables, distinct_sellers: bool = False) -> DataFrame:
    """Per order, in one aggregation over the items:
    ``number_of_products`` (item rows), ``number_of_sellers`` (non-null seller
    rows, or distinct sellers with ``distinct_sellers=True``), summed
    ``price`` and ``freight_value``.
    """
    sellers = F.count_distinct("seller_id") if distinct_sellers else F.count("seller_id")
    return (
        tables["order_items"]
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.count(F.lit(1)).alias("number_of_products"),
            sellers.alias("number_of_sellers"),
            sum_or_zero("price").alias("price"),
            sum_or_zero("freight_value").alias("freight_value"),
        )
    )


def order_number_products(tables: Tables) -> DataFrame:
    return order_item_stats(tables).select("order_id", "number_of_products")


def order_number_sellers(tables: Tables, distinct_sellers: bool = False) -> DataFrame:
    return order_item_stats(tables, distinct_sellers).select("order_id", "number_of_sellers")


def order_price_freight(tables: Tables) -> DataFrame:
    return order_item_stats(tables).select("order_id", "price", "freight_value")


def first_location_by_zip(tables: Tables) -> DataFrame:
    """One ``(zip, lat, lng)`` per zip prefix: the first row in file order.

    ``min_by`` over the load-time ``ordinal`` is a partial aggregate, so a
    zip prefix holding a large share of the rows is combined map-side.
    """
    geo = tables["geolocation"]
    # ordinals are unique, so both picks come from the same (first) row;
    # with a primitive ordinal this stays a fixed-width hash aggregate
    return (
        geo.where(F.col("geolocation_zip_code_prefix").isNotNull())
        .groupBy(F.col("geolocation_zip_code_prefix").alias("zip"))
        .agg(
            F.min_by("geolocation_lat", "ordinal").alias("lat"),
            F.min_by("geolocation_lng", "ordinal").alias("lng"),
        )
    )


def seller_locations(tables: Tables) -> DataFrame:
    """``seller_id, seller_lat, seller_lng`` (one row per seller row that has a location)."""
    geo = first_location_by_zip(tables)
    sellers = tables["sellers"].select("seller_id", F.col("seller_zip_code_prefix").alias("zip"))
    return (
        salted_join(sellers, geo, "zip", F.col("seller_id"))
        .select("seller_id", F.col("lat").alias("seller_lat"), F.col("lng").alias("seller_lng"))
    )


def order_customer_locations(tables: Tables) -> DataFrame:
    """``order_id, customer_lat, customer_lng`` through the order's customer zip."""
    geo = first_location_by_zip(tables)
    customers = tables["customers"].select("customer_id", F.col("customer_zip_code_prefix").alias("zip"))
    orders = tables["orders"].select("order_id", "customer_id").join(customers, "customer_id")
    return (
        salted_join(orders, geo, "zip", F.col("order_id"))
        .select("order_id", F.col("lat").alias("customer_lat"), F.col("lng").alias("customer_lng"))
    )


def order_item_distance(tables: Tables) -> DataFrame:
    """Per item: km between the seller's and the customer's zip locations (any status)."""
    items = tables["order_items"].select("order_id", "order_item_id", "product_id", "seller_id")
    return (
        salted_join(items, seller_locations(tables), "seller_id", F.col("order_id"))
        .join(order_customer_locations(tables), "order_id")
        .select(
            "order_id",
            "order_item_id",
            "product_id",
            "seller_id",
            haversine_km("customer_lng", "customer_lat", "seller_lng", "seller_lat").alias(
                "distance_seller_customer"
            ),
        )
    )


def order_distance(tables: Tables) -> DataFrame:
    """``order_id, distance_seller_customer``: mean item distance of the order."""
    return (
        order_item_distance(tables)
        .groupBy("order_id")
        .agg(F.avg("distance_seller_customer").alias("distance_seller_customer"))
    )


def order_training(
    tables: Tables,
    is_delivered: bool = True,
    with_distance_seller_customer: bool = True,
    distinct_sellers: bool = False,
) -> DataFrame:
    """The order training table: wait times, reviews (one row per review),
    item counts and sums, and seller-customer distance; rows with any
    missing value dropped.
    """
    df = (
        order_wait_time(tables, is_delivered)
        .join(order_review_score(tables), "order_id")
        .join(order_item_stats(tables, distinct_sellers), "order_id")
    )
    cols = list(TRAINING_COLUMNS)
    if with_distance_seller_customer:
        df = df.join(order_distance(tables), "order_id")
    else:
        cols.remove("distance_seller_customer")
    return df.select(*cols).dropna("any")

"""Product-level feature tables, keyed by ``product_id``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.exprs import sum_or_zero
from mercato.operators.orders import order_review_score, order_wait_time

Tables = dict[str, DataFrame]

TRAINING_COLUMNS = [
    "product_id", "product_name_length", "product_description_length", "product_photos_qty",
    "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm", "category",
    "wait_time", "price", "share_of_one_stars", "share_of_five_stars", "review_score",
    "n_orders", "quantity", "sales",
]

# Source spellings and the names used in the output.
RENAMES = {
    "product_category_name_english": "category",
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}


def product_features(tables: Tables) -> DataFrame:
    """Products with an English category; products without a translated category are dropped."""
    return (
        tables["products"]
        .join(tables["product_category_name_translation"], "product_category_name")
        .drop("product_category_name")
        .withColumnsRenamed(RENAMES)
    )


def product_item_stats(tables: Tables) -> DataFrame:
    """One aggregation over the items: mean ``price``, ``n_orders`` (distinct),
    ``quantity`` (item rows with an order) and ``sales`` (summed price)."""
    return (
        tables["order_items"]
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.avg("price").alias("price"),
            F.count_distinct("order_id").alias("n_orders"),
            F.count("order_id").alias("quantity"),
            sum_or_zero("price").alias("sales"),
        )
    )


def product_price(tables: Tables) -> DataFrame:
    return product_item_stats(tables).select("product_id", "price")


def product_quantity(tables: Tables) -> DataFrame:
    return product_item_stats(tables).select("product_id", "n_orders", "quantity")


def product_sales(tables: Tables) -> DataFrame:
    return product_item_stats(tables).select("product_id", "sales")


def order_product_pairs(tables: Tables) -> DataFrame:
    """Distinct ``(order_id, product_id)``: an order counts once per product."""
    return tables["order_items"].select("order_id", "product_id").distinct()


def product_wait_time(tables: Tables) -> DataFrame:
    """Mean wait of the delivered orders containing the product (each order once)."""
    return (
        order_product_pairs(tables)
        .join(order_wait_time(tables).select("order_id", "wait_time"), "order_id")
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.avg("wait_time").alias("wait_time"))
    )


def product_review_score(tables: Tables) -> DataFrame:
    """Shares of one- and five-star reviews and mean score over the product's orders."""
    return (
        order_product_pairs(tables)
        .join(order_review_score(tables), "order_id")
        .where(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.avg("dim_is_one_star").alias("share_of_one_stars"),
            F.avg("dim_is_five_star").alias("share_of_five_stars"),
            F.avg("review_score").alias("review_score"),
        )
    )


def product_training(tables: Tables) -> DataFrame:
    """Features, wait time, price, review shares, quantities and sales per product."""
    return (
        product_features(tables)
        .join(product_wait_time(tables), "product_id")
        .join(product_item_stats(tables), "product_id")
        .join(product_review_score(tables), "product_id")
        .select(*TRAINING_COLUMNS)
    )

"""Marketplace tables derived from the supplied TPC-H-like Parquet tables.

The test harness ships ``orders lineitem supplier customer part nation``
(and others) as Parquet.  Each mapping below is one SQL statement that
Spark SQL and DuckDB both run unchanged; ``{name}`` placeholders are
filled with DataFrames in Spark and with the table names in DuckDB, so
the Spark queries and the DuckDB oracles read the very same derived data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans.spread import spread

MAPPINGS: dict[str, str] = {
    "orders": """
select o_orderkey as order_id, o_custkey as customer_id,
 case when o_orderstatus = 'P' then 'shipped' else 'delivered' end as order_status,
 o_orderdate + interval '1' minute * (o_orderkey % 1440) as order_purchase_timestamp,
 o_orderdate + interval '1' minute * (o_orderkey % 1440 + 60) as order_approved_at,
 o_orderdate + interval '1' day * ((o_orderkey*7) % 9) + interval '1' hour * (o_orderkey % 24) as order_delivered_carrier_date,
 case when o_orderstatus = 'P' then null
      else o_orderdate + interval '1' day * ((o_orderkey*7) % 9 + 1 + (o_orderkey*11) % 23) end as order_delivered_customer_date,
 o_orderdate + interval '1' day * (15 + o_orderkey % 13) as order_estimated_delivery_date
from {orders}
""",
    "order_items": """
select l_orderkey as order_id, l_linenumber as order_item_id, l_partkey as product_id, l_suppkey as seller_id,
 o_orderdate + interval '1' day * (1 + l_suppkey % 7) as shipping_limit_date,
 l_extendedprice / 800.0 * (1 + l_suppkey % 10) as price, l_quantity * 0.5 as freight_value
from {lineitem} join {orders} on l_orderkey = o_orderkey
""",
    "order_reviews": """
select o_orderkey*10 + k as review_id, o_orderkey as order_id,
 greatest(1, 5 - cast(floor(((o_orderkey*7)%9 + (o_orderkey*11)%23 + o_custkey%5 + k*8)/8.0) as int)) as review_score
from {orders} cross join (select 0 as k union all select 1 as k) z
where k = 0 or o_orderkey % 40 = 1
""",
    "sellers": """
select s_suppkey as seller_id, s_nationkey as seller_zip_code_prefix, s_name as seller_city, n_name as seller_state
from {supplier} join {nation} on s_nationkey = n_nationkey
""",
    "customers": """
select c_custkey as customer_id, c_nationkey as customer_zip_code_prefix from {customer}
""",
    "geolocation": """
select n_nationkey*3 + k as ordinal, n_nationkey as geolocation_zip_code_prefix,
 cast(-30 + n_nationkey*1.5 + k*0.01 as double) as geolocation_lat,
 cast(-70 + n_nationkey*1.1 - k*0.01 as double) as geolocation_lng
from {nation} cross join (select 0 as k union all select 1 as k union all select 2 as k) z
""",
    "products": """
select p_partkey as product_id, lower(p_type) as product_category_name,
 length(p_name) as product_name_lenght, length(p_name) + length(p_brand) as product_description_lenght,
 p_size % 6 as product_photos_qty, p_size * 100 as product_weight_g, p_size as product_length_cm,
 p_size % 10 + 1 as product_height_cm, p_size % 7 + 1 as product_width_cm
from {part}
""",
    "product_category_name_translation": """
select distinct lower(p_type) as product_category_name, concat('cat_', lower(p_type)) as product_category_name_english
from {part}
""",
}

# Spark forms of the two mappings that repeat each source row a fixed number
# of times: a generator (explode) instead of a cross join with a literal
# table.  Same rows as the shared SQL above, which DuckDB runs; the oracle
# comparison checks that they agree.
SPARK_MAPPINGS: dict[str, str] = {
    "order_reviews": """
select o_orderkey*10 + k as review_id, o_orderkey as order_id,
 greatest(1, 5 - cast(floor(((o_orderkey*7)%9 + (o_orderkey*11)%23 + o_custkey%5 + k*8)/8.0) as int)) as review_score
from {orders} lateral view explode(array(0, 1)) z as k
where k = 0 or o_orderkey % 40 = 1
""",
    "geolocation": """
select n_nationkey*3 + k as ordinal, n_nationkey as geolocation_zip_code_prefix,
 cast(-30 + n_nationkey*1.5 + k*0.01 as double) as geolocation_lat,
 cast(-70 + n_nationkey*1.1 - k*0.01 as double) as geolocation_lng
from {nation} lateral view explode(array(0, 1, 2)) z as k
""",
}

# What the sources of order_items are joined by.
ORDER_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}

SOURCE_TABLES = ("orders", "lineitem", "supplier", "customer", "part", "nation")

# Integer widths differ between engines; these columns are pinned so both sides agree.
_INT_COLUMNS = {
    "products": [
        "product_name_lenght", "product_description_lenght", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    ],
    "sellers": ["seller_zip_code_prefix"],
    "customers": ["customer_zip_code_prefix"],
    "geolocation": ["geolocation_zip_code_prefix"],
    "order_items": ["order_item_id"],
    "order_reviews": ["review_score"],
}

# Short names used by the DuckDB oracles (the pre-registered views hold the sources).
CTE_NAMES = {
    "orders": "m_orders",
    "order_items": "m_order_items",
    "order_reviews": "m_order_reviews",
    "sellers": "m_sellers",
    "customers": "m_customers",
    "geolocation": "m_geolocation",
    "products": "m_products",
    "product_category_name_translation": "m_translation",
}


def read_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in SOURCE_TABLES}


_CACHE: dict[tuple[str, str], dict[str, DataFrame]] = {}


def fixture_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The eight marketplace tables, derived lazily from the Parquet sources in ``sf_dir``.

    The lazy DataFrames are kept per session and folder, so several queries
    over the same (read-only) files share one analysed plan instead of
    listing and analysing the sources again; nothing is cached in memory.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _CACHE:
        _CACHE[key] = _build(spark, sf_dir)
    return dict(_CACHE[key])


def _build(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    src = read_sources(spark, sf_dir)
    rows = src["lineitem"].count()  # the files' footers tell
    out: dict[str, DataFrame] = {}
    for name, shared in MAPPINGS.items():
        sql = SPARK_MAPPINGS.get(name, shared)
        used = {t: df for t, df in src.items() if "{" + t + "}" in sql}
        if name == "order_items":  # both sides of its join, which the steps by order after it go on from
            used = {t: spread(used[t], rows, key) for t, key in ORDER_KEYS.items()}
        df = spark.sql(sql, **used)
        casts = {c: F.col(c).cast("int") for c in _INT_COLUMNS.get(name, [])}
        out[name] = df.withColumns(casts) if casts else df
    return out


def oracle_ctes() -> str:
    """``WITH`` clause defining the mapped tables for DuckDB (no trailing comma)."""
    parts = []
    for name, sql in MAPPINGS.items():
        body = sql.format(**{t: t for t in SOURCE_TABLES})
        int_cols = _INT_COLUMNS.get(name)
        if int_cols:
            body = f"select * replace ({', '.join(f'cast({c} as integer) as {c}' for c in int_cols)}) from ({body})"
        parts.append(f"{CTE_NAMES[name]} as ({body})")
    return "with " + ",\n".join(parts)

"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query maps the supplied Parquet tables to the marketplace tables,
runs one operator over the whole tables and snaps doubles with
``mercato.compare.canonical`` so its output can be hashed against the
matching DuckDB oracle in ``mercato.oracles``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.compare import canonical
from mercato.operators import orders as O
from mercato.operators import products as P
from mercato.operators import regression as R
from mercato.operators import resampling as RS
from mercato.operators import sellers as S
from mercato.operators import stats as ST
from mercato.operators import whatif as W
from mercato.plans.lineage import ensure_checkpoint_dir, materialize
from mercato.sources.bucketed import open_bucketed, write_bucketed
from mercato.sources.csv_tables import load_tables, write_tables
from mercato.sources.fixture import fixture_tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Callable[[dict], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return canonical(fn(fixture_tables(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return deco


# ---------------------------------------------------------------- sources
def _checksum(name: str, dtype: T.DataType) -> Column:
    """A sum over a column that shows what type it was read as: of numbers, of seconds, of lengths."""
    c = F.col(name)
    if isinstance(dtype, T.StringType):
        c = F.length(c)
    elif isinstance(dtype, T.TimestampNTZType):
        c = F.unix_timestamp(c.cast("timestamp"))
    return F.coalesce(F.sum(c.cast("double")), F.lit(0.0))


def table_profile(tables: dict) -> DataFrame:
    """``table, column, type, rows, nulls, checksum`` for every column of the tables: one aggregate per table."""
    out = None
    for name in sorted(tables):
        df = tables[name].drop("ordinal")
        types = {f.name: f.dataType for f in df.schema.fields}
        counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_n_{c}") for c in types], *[_checksum(c, t).alias(f"_s_{c}") for c, t in types.items()])
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.lit(t.simpleString()).alias("type"), (F.col("_rows") - F.col(f"_n_{c}")).alias("nulls"), F.col(f"_s_{c}").alias("checksum"))
                          for c, t in types.items()])
        rows = counts.select(F.lit(name).alias("table"), F.col("_rows").alias("rows"), F.explode(cells).alias("x")).select("table", "x.column", "x.type", "rows", "x.nulls", "x.checksum")
        out = rows if out is None else out.unionByName(rows)
    return out


def _loaded_from_csv(tables: dict) -> DataFrame:
    """The mapped tables written as a folder of CSV files in the shared folder, loaded from there and profiled."""
    spark = next(iter(tables.values())).sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    write_tables(tables, folder)
    return table_profile(load_tables(spark, folder))


query("load_tables")(_loaded_from_csv)


# ---------------------------------------------------------------- orders
query("order_wait_time")(O.order_wait_time)
query("order_review_score")(O.order_review_score)
query("order_number_products")(O.order_number_products)
query("order_number_sellers")(O.order_number_sellers)
query("order_price_freight")(O.order_price_freight)
query("haversine_km")(O.order_item_distance)
query("order_distance")(O.order_distance)
query("order_training")(O.order_training)


def _bucketed(tables: dict, *names: str) -> dict:
    """Some of the mapped tables, stored by buckets in the shared folder and opened from the catalog."""
    spark = next(iter(tables.values())).sparkSession
    mark = f"bucketed_{uuid.uuid4().hex}"
    write_bucketed({n: tables[n] for n in names}, f"{ensure_checkpoint_dir(spark).rstrip('/')}/{mark}", mark, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return open_bucketed(spark, mark, list(names))


query("order_training_bucketed")(
    lambda t: O.order_training(_bucketed(t, "orders", "order_items", "order_reviews"), with_distance_seller_customer=False))
query("order_training_any_status")(lambda t: O.order_training(t, is_delivered=False))
query("order_training_without_distance")(lambda t: O.order_training(t, with_distance_seller_customer=False))
query("order_training_distinct_sellers")(lambda t: O.order_training(t, distinct_sellers=True))
query("order_number_sellers_distinct")(lambda t: O.order_number_sellers(t, distinct_sellers=True))

# ---------------------------------------------------------------- products
query("product_features")(P.product_features)
query("product_price")(P.product_price)
query("product_quantity")(P.product_quantity)
query("product_sales")(P.product_sales)
query("product_wait_time")(P.product_wait_time)
query("product_review_score")(P.product_review_score)
query("product_training")(P.product_training)

# ---------------------------------------------------------------- sellers
query("seller_features")(S.seller_features)
query("seller_delay_wait")(S.seller_delay_wait)
query("seller_active_dates")(S.seller_active_dates)
query("seller_quantity")(S.seller_quantity)
query("seller_sales")(S.seller_sales)
query("seller_review_score")(S.seller_review_score)
query("seller_review_counts")(S.seller_review_counts)
query("seller_review_costs")(S.seller_review_costs)
query("seller_revenue")(S.seller_revenue)
query("seller_profits")(S.seller_profits)
query("seller_training")(S.seller_training)


# ---------------------------------------------------------------- what-if
def _sellers(tables: dict) -> DataFrame:
    """The columns of the seller training table the what-if reads, written
    once: the ranking reads them several times."""
    return materialize(S.seller_training(tables).select("seller_id", "profits", "quantity"))


query("it_costs")(lambda t: W.it_costs(S.seller_training(t)))
query("global_profit")(lambda t: W.global_profit(S.seller_training(t)))
query("sellers_by_profit")(lambda t: W.sellers_by_profit(_sellers(t)))
query("whatif_curve")(lambda t: W.whatif_curve(_sellers(t)))
query("whatif_greedy_optimum")(lambda t: W.whatif_greedy_optimum(_sellers(t)))
query("whatif_greedy_log")(lambda t: W.whatif_greedy_log(_sellers(t)))
query("whatif_global_optimum")(lambda t: W.whatif_global_optimum(_sellers(t)))
query("worst_sellers")(lambda t: W.worst_sellers(S.seller_training(t), 200))


# ---------------------------------------------------------------- statistics
def _orders(tables: dict, *columns: str) -> DataFrame:
    """The order training table, or some of its columns, written once; for operators that read it more than once."""
    orders = O.order_training(tables)
    return materialize(orders.select(*columns) if columns else orders)


query("describe_column")(lambda t: ST.describe_column(_orders(t, "wait_time"), "wait_time"))
query("histogram")(lambda t: ST.histogram(O.order_training(t), "freight_value", 20, 0.0, 80.0))
query("histogram_by")(
    lambda t: ST.histogram_by(ST.round_column(O.order_training(t), "wait_time"), "wait_time", "review_score",
                              10, 0.0, 50.0))
query("histogram_by_price")(
    lambda t: ST.histogram_by(O.order_training(t), "price", "review_score", 10, 0.0, 50.0))
query("histogram_by_freight")(
    lambda t: ST.histogram_by(O.order_training(t), "freight_value", "review_score", 10, 0.0, 50.0))
query("round_column")(lambda t: ST.round_column(O.order_training(t), "wait_time"))
query("preview")(lambda t: ST.preview(O.order_training(t), ["order_id", "review_score"], 5))
query("correlation_matrix")(lambda t: ST.correlation_matrix(ST.round_column(O.order_training(t), "wait_time")))
query("histogram_review_score")(lambda t: ST.histogram(_orders(t, "review_score"), "review_score", 10))
query("zscore")(lambda t: ST.zscore(_orders(t)))
query("kde_curve")(lambda t: ST.kde_curve(O.order_training(t), "wait_time", "review_score"))


# ---------------------------------------------------------------- regression
# The models of the order regression analysis.
MODEL_WAIT = ("review_score", ["wait_time"])
MODEL_DELAY = ("review_score", ["delay_vs_expected"])
MODEL_TWO = ("review_score", ["wait_time", "delay_vs_expected"])
MODEL_STANDARDIZED = ("review_score", ST.ZSCORE_COLUMNS)


query("ols_fit")(lambda t: R.ols_fit(O.order_training(t), *MODEL_WAIT))
query("ols_fit_delay")(lambda t: R.ols_fit(O.order_training(t), *MODEL_DELAY))
query("ols_fit_two")(lambda t: R.ols_fit(O.order_training(t), *MODEL_TWO))
query("ols_coefficients")(lambda t: R.ols_coefficients(O.order_training(t), *MODEL_WAIT))
query("ols_coefficients_delay")(lambda t: R.ols_coefficients(O.order_training(t), *MODEL_DELAY))
query("ols_coefficients_two")(lambda t: R.ols_coefficients(O.order_training(t), *MODEL_TWO))


MODEL_COLUMNS = ["order_id", "review_score", *ST.ZSCORE_COLUMNS]


def _std_fit(data: DataFrame) -> R.OlsModel:
    """The 7-regressor model on z-scores, fitted in one pass over the order table."""
    return R.fit(data, *MODEL_STANDARDIZED, standardize=ST.ZSCORE_COLUMNS)


def _fit_standardized(tables: dict, **options) -> DataFrame:
    data = O.order_training(tables, **options)
    return R.coefficient_table(data, _std_fit(data))


def _scored(tables: dict) -> DataFrame:
    """The order table's model columns written once, fitted and scored."""
    data = _orders(tables, *MODEL_COLUMNS)
    return R.ols_score(data, _std_fit(data), keep=["order_id"])


def _summary(tables: dict) -> DataFrame:
    data = _orders(tables, *MODEL_COLUMNS)
    return R.ols_summary(data, _std_fit(data), order_by=["order_id", "review_score"])


def _score_simple(tables: dict) -> DataFrame:
    data = _orders(tables, "order_id", "review_score", "wait_time")
    return R.ols_score(data, R.fit(data, *MODEL_WAIT), keep=["order_id"])


def _error(tables: dict, y: str, xs: list[str], standardize: list[str] | None = None) -> DataFrame:
    data = O.order_training(tables)
    return R.model_error(data, R.fit(data, y, xs, standardize=standardize))


query("ols_fit_standardized")(_fit_standardized)
query("ols_fit_full_rank")(lambda t: _fit_standardized(t, distinct_sellers=True))
query("ols_summary")(_summary)
query("ols_significant")(lambda t: R.ols_significant(_fit_standardized(t)))
query("ols_importance")(lambda t: R.ols_importance(_fit_standardized(t)))
query("ols_score")(_score_simple)
query("ols_error")(lambda t: _error(t, *MODEL_STANDARDIZED, ST.ZSCORE_COLUMNS))
query("ols_error_simple")(lambda t: R.ols_error(_score_simple(t)))
query("histogram_residuals")(lambda t: ST.histogram(_scored(t), "residual", 10, -5.0, 5.0))
query("histogram_predicted")(lambda t: ST.histogram(materialize(_scored(t).select("predicted")), "predicted", 10))
query("regression_line")(
    lambda t: R.regression_line(ST.zscore(_orders(t, "review_score", "delay_vs_expected"), ["delay_vs_expected"]), "review_score", "delay_vs_expected"))
query("regression_line_resampled")(
    lambda t: RS.regression_line_resampled(_orders(t, "order_id", "review_score", "wait_time"), "review_score", "wait_time", ["order_id"], replicates=200))

"""Tables stored by the buckets of their key, so that joins and aggregates on it need no shuffle.

Bucketing pays where the same tables are joined on the same key again and
again: the exchange is done once, when they are written.  The tables are
external ones of the session's catalog, their files lie in a shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: The tables that every order feature joins on the order.
BUCKET_KEYS = {"orders": "order_id", "order_items": "order_id", "order_reviews": "order_id"}


def table_name(prefix: str, name: str) -> str:
    return f"{prefix}_{name}"


def write_bucketed(tables: dict[str, DataFrame], folder: str, prefix: str, buckets: int, keys: dict[str, str] | None = None) -> None:
    """Each table as ``<folder>/<name>`` and in the catalog as ``<prefix>_<name>``; an existing one is an error.

    A table named in ``keys`` (default ``BUCKET_KEYS``) is dealt to ``buckets``
    by its key and sorted by it inside each, one file a bucket: rows are dealt
    before they are written, so that tasks do not write a file for every
    bucket each.  Rows without a key share a bucket.  The others, among them
    all that are looked up by other keys, are written as they are.  Choose so
    many buckets that one of the largest table's fits a task (some 200 MB),
    and the same number for all that are joined.
    """
    keys = BUCKET_KEYS if keys is None else keys
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    for name, df in tables.items():
        key = keys.get(name)
        rows = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key) if key else df.write
        rows.format("parquet").option("path", f"{folder.rstrip('/')}/{name}").saveAsTable(table_name(prefix, name))


def open_bucketed(spark: SparkSession, prefix: str, names: list[str]) -> dict[str, DataFrame]:
    """The tables that ``write_bucketed`` put into the catalog, keyed as the operators expect them."""
    return {name: spark.table(table_name(prefix, name)) for name in names}

"""How many tasks a large table's rows are dealt to before they are joined and grouped."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame

#: Rows that a task sorts and groups at once.
ROWS_PER_TASK = 250_000


def spread(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as its ``rows`` ask for, so that a task's memory does not grow with the table.

    Left to itself Spark merges shuffle partitions to 64 MB; of narrow rows
    that is several million, which every sort and hash table of the step
    then holds.  A table that the cluster's cores can share in parts below
    ``ROWS_PER_TASK`` is left to Spark.  Never fewer parts than
    ``spark.sql.shuffle.partitions``: a join would deal the rows anew.
    """
    spark = df.sparkSession
    if rows <= ROWS_PER_TASK * spark.sparkContext.defaultParallelism:
        return df
    return df.repartition(max(math.ceil(rows / ROWS_PER_TASK), int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)

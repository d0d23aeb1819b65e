"""CSV directory loader: one DataFrame per ``*.csv`` file, keyed by a cleaned name.

A file ``<prefix>orders<suffix>.csv`` becomes the table ``orders``; files that
do not end in ``.csv`` are ignored.  Columns are resolved by header name, every
cell is read as a string, the usual missing-value tokens are mapped to null and
the declared columns are cast to their types.  Timestamps may be dates alone,
carry a fraction, or a ``T`` between date and time.  A cell that does not parse
fails the query that reads it and names the column and the value; nothing
becomes null silently.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import SCHEMAS

# The strings pandas' CSV reader treats as missing by default.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Parts stripped from a file name to get the table key.
NAME_PARTS_TO_STRIP = ["olist_", "_dataset", ".csv"]

# Tables whose free-text cells may hold line breaks; only these are read as
# multi-line CSV, which Spark cannot split, so every other file stays splittable.
MULTILINE_TABLES = {"order_reviews"}


def table_key(file_name: str) -> str:
    key = os.path.basename(file_name)
    for part in NAME_PARTS_TO_STRIP:
        key = key.replace(part, "")
    return key


def _typed(name: str, dtype: T.DataType) -> Column:
    raw = F.col(name)
    cleaned = F.when(raw.isin(MISSING_TOKENS), F.lit(None)).otherwise(raw)
    if isinstance(dtype, T.StringType):
        return cleaned.alias(name)
    parsed = cleaned.try_cast(dtype)
    problem = F.concat(F.lit(f"column {name}: not a {dtype.simpleString()}: "), cleaned)
    return F.when(cleaned.isNotNull() & parsed.isNull(), F.raise_error(problem).cast(dtype)).otherwise(parsed).alias(name)


def read_table(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Read one CSV with header; declared columns typed, others left as strings."""
    key = key or table_key(path)
    raw = (
        spark.read.option("header", True)
        .option("multiLine", key in MULTILINE_TABLES)
        .option("escape", '"')
        .option("inferSchema", False)
        .csv(path)
    )
    declared = SCHEMAS.get(key, {})
    cols = [_typed(c, declared[c]) if c in declared else _typed(c, T.StringType()) for c in raw.columns]
    if key == "geolocation":
        # Position in the file, used to keep the first row per zip prefix.
        # File path and split start order the splits; the id orders rows in a split.
        cols.append(
            F.struct(
                F.col("_metadata.file_path").alias("file"),
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("row"),
            ).alias("ordinal")
        )
    return raw.select(*cols)


def list_csv(spark: SparkSession, csv_dir: str) -> list[str]:
    """Paths matching ``<csv_dir>/*.csv``, listed through the session's Hadoop file systems
    (a path without a scheme is one of the default file system, as for any other read)."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(csv_dir.rstrip("/") + "/*.csv")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().toString() for st in (fs.globStatus(pattern) or []))


def load_tables(spark: SparkSession, csv_dir: str) -> dict[str, DataFrame]:
    """All ``*.csv`` files of ``csv_dir`` as lazily read DataFrames keyed by cleaned name; at least one must be there."""
    paths = list_csv(spark, csv_dir)
    if not paths:
        raise FileNotFoundError(f"no *.csv file in {csv_dir}")
    return {table_key(p): read_table(spark, p) for p in paths}


def write_tables(tables: dict[str, DataFrame], csv_dir: str) -> None:
    """Every table as ``<csv_dir>/<name>.csv``, a folder of part files that ``load_tables`` reads back.

    A null is an empty cell.  Rows with an ``ordinal`` are written in its
    order, as the position in the file stands for it.
    """
    for name, df in tables.items():
        rows = df.orderBy("ordinal").drop("ordinal") if "ordinal" in df.columns else df
        rows.write.option("header", True).option("escape", '"').csv(f"{csv_dir.rstrip('/')}/{name}.csv")


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make every table queryable from SQL under its key (session temp views)."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.plans.lineage import materialize

#: The separators of words: space, and tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"
#: Rows of an Arrow batch that a Python worker turns into objects at once.
PART = 1000
#: Whether Spark removes the shuffle files of an execution when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Seconds after which the driver's JVM knows what Python has dropped; it is told once a second.
TOLD = 1.5


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def words_of(text: Column) -> Column:
    """The words of a text (runs without white space); null or blank: no words."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_CLASS))


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a name inside an expression would be put in its place wherever it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``PART`` rows: what Python makes of a batch is many times larger than the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, PART):
            yield batch.slice(at, PART)


_HELD: list = []


def held(source: Any, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task, made of ``source``.

    It keeps one thing only: Spark gives the same workers to one step after
    another, and what an earlier one has left would lie there meanwhile.
    """
    if not _HELD or _HELD[0] is not source:
        _HELD.clear()
        _HELD.extend([source, make()])
    return _HELD[1]


def stored(df: DataFrame | Callable[[], DataFrame], large: bool = False, settings: dict[str, str] | None = None) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there.

    The shuffle files behind it serve nothing any more, and Spark is set to
    remove them as soon as this one execution ends: otherwise the files of all
    steps would lie on the executors' disks until the driver happens to collect
    their handles as garbage.  (``df`` itself keeps the session's own setting.)
    What earlier steps have stored goes when the driver collects garbage, which
    it is asked to do here.  A large step is given as a function: a caller that
    names or passes the DataFrame itself holds on to what it reads for as long
    as the call lasts.  With ``large`` the driver is asked once it knows what
    Python has dropped; else these files may lie there until the next step is
    stored.  ``settings`` are the session's for this one execution.
    """
    made = df() if callable(df) else df
    conf = made.sparkSession.conf
    wanted = {CLEANUP: "true"} | (settings or {})
    before = {key: conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            conf.set(key, value)
        out = materialize(made.select("*"))
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
    del df, made
    released(out.sparkSession, large)
    return out


def released(spark: SparkSession, wait: bool = True) -> None:
    """The driver is asked to collect garbage, and with it the stored steps and shuffles that nobody holds."""
    gc.collect()
    if wait:
        time.sleep(TOLD)
    spark.sparkContext._jvm.System.gc()

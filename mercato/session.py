"""Spark session with the settings the operators are designed around."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter for correctness or scale; anything else is left to the cluster.
BASE_CONF = {
    # Naive timestamps everywhere; pin the zone so nothing is shifted on display or cast.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast small sides from measured sizes, coalesce
    # tiny shuffle partitions, split skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    app_name: str = "mercato",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; ``master``/``shuffle_partitions`` only when given.

    On a cluster leave ``master`` unset (spark-submit decides) and size
    ``shuffle_partitions`` to the data (roughly input bytes / 128-256 MB).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark

"""Cutting lineage: reliable checkpoints in the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the session names in ``spark.checkpoint.dir``.

    Only when none is configured and Spark runs in local mode (tests, a
    laptop) is a fresh scratch folder created; on a cluster an unset
    folder is an error, since a machine-local folder would not survive the
    loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) for this cluster")
        configured = tempfile.mkdtemp(prefix="mercato-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and read it back with no lineage.

    Used where one result feeds several actions (statistics, then a
    projection that uses them), so the upstream joins and aggregations run
    once and a lost executor re-reads the files instead of recomputing.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

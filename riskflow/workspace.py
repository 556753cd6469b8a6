"""Intermediate tables, in the shared folder the cluster names."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; without it, a local session uses its warehouse.

    On a cluster the default warehouse lies on one machine, so there the setting must be made.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_riskflow"


def run_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder under the scratch root, deleted when the application ends."""
    path = f"{scratch_root(spark)}/riskflow-{label}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    filesystem.mkdirs(hadoop_path)
    filesystem.deleteOnExit(hadoop_path)
    return path


def write_once(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{run_dir(spark, label)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give the tree learners a place to cut their lineage, unless one is set."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_root(spark))

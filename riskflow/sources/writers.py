"""Batch sinks: stored records, gzipped JSON export, CSV, fitted models (K2-K4)."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.functions.records import record_json
from riskflow.operators.review import audit
from riskflow.schema import CSV_NULL, ID, INTAKE_COLUMNS


def save_records(
    df: DataFrame, path: str, columns: tuple[str, ...] = INTAKE_COLUMNS, mode: str = "errorifexists"
) -> None:
    """Records as Parquet, id included."""
    df.select(*columns).write.mode(mode).parquet(path)


def save_training_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).option("nullValue", CSV_NULL).csv(path)


def export_json_gz(
    df: DataFrame,
    path: str,
    columns: tuple[str, ...] = INTAKE_COLUMNS,
    buckets: int | None = None,
    key: str = ID,
) -> dict[str, int]:
    """One JSON object per line, gzipped; returns the number of records and the range of their keys.

    ``buckets`` puts a bulk export into that many folders by key hash, for
    readers that fetch single records: one folder holds all lines of its keys.
    The rebalance keeps the files of a folder few and even, however large or
    hot the folder is.
    """
    df, counters = audit(df, "exported", key)
    lines = df.select(record_json(columns).alias("value"))
    if buckets is not None:
        bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).alias("bucket")
        lines = df.select(bucket, record_json(columns).alias("value"))
        lines = lines.hint("rebalance", "bucket")
        lines.write.partitionBy("bucket").option("compression", "gzip").text(path)
    else:
        lines.write.option("compression", "gzip").text(path)
    return counters.get


def export_folder(root: str, key: int, moment: dt.datetime) -> str:
    """Where the export of one record goes.  File systems refuse ``:``, so it becomes ``-``."""
    stamp = moment.isoformat(sep="_", timespec="microseconds").replace(":", "-")
    return f"{root.rstrip('/')}/{key}_{stamp}.bin.gz"


def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)

"""Record ids: the next free one, and dense numbering at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.schema import ID, UNASSIGNED_ID
from riskflow.workspace import run_dir

_PART, _BEFORE = "__part", "__before"


def next_id(df: DataFrame, key: str = ID) -> DataFrame:
    """One row: highest id + 1, or 0 for an empty table."""
    return df.agg(F.coalesce(F.max(key) + 1, F.lit(0)).cast("bigint").alias("next_id"))


def top_record(df: DataFrame, key: str = ID) -> DataFrame:
    """The record with the highest key (each task keeps one row, nothing is sorted whole)."""
    return df.orderBy(F.col(key).desc()).limit(1)


def is_unassigned(key: str = ID) -> Column:
    return F.coalesce(F.col(key), F.lit(UNASSIGNED_ID)) == UNASSIGNED_ID


def number_in_order(
    df: DataFrame, order: list[str | Column], output: str, partitions: int | None = None
) -> DataFrame:
    """Adds 0, 1, 2, ... in the given order, without sorting everything in one task.

    The rows are written once, dealt out by ranges of the order; each range is
    numbered by itself and moved up by the row counts of the ranges before it.
    The order should have no ties.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = f"{run_dir(spark, 'ranges')}/table"
    ranged = df.repartitionByRange(partitions, *order).withColumn(_PART, F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    # One row per range, so at most ``partitions`` rows pass this single-task window.
    ahead = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy(_PART)
        .agg(F.count("*").alias("n"))
        .select(_PART, F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias(_BEFORE))
    )
    within = F.row_number().over(Window.partitionBy(_PART).orderBy(*order))
    return (
        ranged.withColumn("__within", within)
        .join(F.broadcast(offsets), _PART)
        .withColumn(output, (F.col(_BEFORE) + F.col("__within") - 1).cast("bigint"))
        .drop(_PART, _BEFORE, "__within")
    )


def assign_ids(
    records: DataFrame,
    existing: DataFrame,
    order: str,
    key: str = ID,
    buckets: int | None = None,
    output: str | None = None,
) -> DataFrame:
    """Number the records without id densely, in ``order``, after the highest existing id.

    Records with an id keep it and skip the shuffle.  The others, whose ``order``
    must be unique and never null, are numbered in ``buckets`` ranges.
    ``existing`` must hold all ids in use, explicit ones of this batch included.
    """
    output = output or key
    kept = records.where(~is_unassigned(key)).withColumn(output, F.col(key).cast("bigint"))
    kind = records.schema[order].dataType
    missing = F.raise_error(F.lit(f"a record to be numbered has no {order}")).cast(kind)
    fresh = records.where(is_unassigned(key)).withColumn(order, F.coalesce(F.col(order), missing))
    start = next_id(existing, key).scalar()
    numbered = number_in_order(fresh, [order], "__number", buckets)
    numbered = numbered.withColumn(output, (start + F.col("__number")).cast("bigint")).drop("__number")
    return kept.unionByName(numbered)

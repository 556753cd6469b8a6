"""Sources: CSV, stored records, file streams, fitted models."""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel,
    LinearSVCModel,
    RandomForestClassificationModel,
)
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskflow.functions.sqltext import quoted
from riskflow.schema import CSV_NULL, INTAKE, TRAINING

_CORRUPT = "__corrupt"
_MODEL_CLASSES = {
    "forest": RandomForestClassificationModel,
    "gbt": GBTClassificationModel,
    "svc": LinearSVCModel,
}


def read_training_csv(
    spark: SparkSession, path: str, schema: StructType | None = TRAINING
) -> DataFrame:
    """CSV with a header and ``N/A`` for null, columns taken by name in any order.

    A missing column is an error now, a value that does not fit its type one when
    it is read: no row is lost silently.  Without a schema the types are inferred,
    which reads the data twice.
    """
    reader = spark.read.option("header", True).option("nullValue", CSV_NULL)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    text = reader.csv(path)
    if missing := [name for name in schema.names if name not in text.columns]:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")

    def typed(field: StructField) -> Column:
        value = F.expr(f"try_cast({quoted(field.name)} AS {field.dataType.simpleString()})")
        raw = F.col(quoted(field.name))
        wrong = F.concat(F.lit(f"{field.name} is malformed: "), raw)
        return F.when(raw.isNotNull() & value.isNull(), F.raise_error(wrong)).otherwise(value).alias(field.name)

    return text.select(*[typed(field) for field in schema])


def judge_training_csv(spark: SparkSession, path: str, schema: StructType = TRAINING) -> DataFrame:
    """All lines of a CSV as text, by column, with ``reason`` and ``line``; none is lost and none fails.

    A line with too few or too many fields is ``line:malformed``, a value that does not
    fit its type ``column:type``, the first of several.  ``line`` is the line as it was read, or what was
    read of it as JSON.  :func:`accepted_training` and :func:`rejected_training` part the
    frame, which a caller that uses both should write first.
    """
    reader = spark.read.option("header", True).option("nullValue", CSV_NULL)
    names = reader.csv(path).columns
    if missing := [name for name in schema.names if name not in names]:
        raise ValueError(f"columns missing in {path}: {', '.join(missing)}")
    fields = ", ".join(f"{quoted(name)} STRING" for name in [*names, _CORRUPT])
    # With pruned columns the parser would not see that fields are missing.
    reader = reader.option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", False)
    text = reader.schema(fields).csv(path)
    reason = F.when(F.col(_CORRUPT).isNotNull(), F.lit("line:malformed"))
    for field in schema:
        name = quoted(field.name)
        wrong = F.expr(f"{name} IS NOT NULL AND try_cast({name} AS {field.dataType.simpleString()}) IS NULL")
        reason = reason.when(wrong, F.lit(f"{field.name}:type"))
    line = F.coalesce(_CORRUPT, F.to_json(F.struct(*[quoted(name) for name in names])))
    return text.select(*[quoted(name) for name in schema.names], reason.alias("reason"), line.alias("line"))


def accepted_training(judged: DataFrame, schema: StructType = TRAINING) -> DataFrame:
    typed = [f"try_cast({quoted(f.name)} AS {f.dataType.simpleString()}) AS {quoted(f.name)}" for f in schema]
    return judged.where("reason IS NULL").selectExpr(*typed)


def rejected_training(judged: DataFrame) -> DataFrame:
    return judged.where("reason IS NOT NULL").select("line", "reason")


def scan_records(spark: SparkSession, path: str, schema: StructType = INTAKE) -> DataFrame:
    """Stored records; the schema is given, so no file is opened to plan the scan."""
    return spark.read.schema(schema).parquet(path)


def read_intake_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = INTAKE,
    max_files: int | None = None,
    max_bytes: int | None = None,
) -> DataFrame:
    """Records as they land in ``path`` (a folder, or a glob).

    ``max_files`` or ``max_bytes`` bounds a micro-batch: input waits, none is lost.
    """
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.parquet(path)


def load_model(kind: str, path: str) -> Model:
    """A fitted ``forest``, ``gbt`` or ``svc``."""
    return _MODEL_CLASSES[kind].load(path)

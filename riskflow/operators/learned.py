"""The second, fitted encoder: impute, index, one-hot, assemble."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    Imputer,
    ImputerModel,
    OneHotEncoder,
    SQLTransformer,
    StringIndexer,
    VectorAssembler,
)
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from riskflow.functions.sqltext import literal, quoted
from riskflow.operators.ids import number_in_order
from riskflow.schema import ATTRIBUTES
from riskflow.sources import files

NUMERIC = ("avg_glucose_level", "bmi", "age")
CATEGORICAL = tuple(name for name in ATTRIBUTES if name not in NUMERIC)


def impute_mean(df: DataFrame, columns: Sequence[str]) -> ImputerModel:
    """Fitted filler that puts the mean in place of nulls."""
    return Imputer(strategy="mean", inputCols=list(columns), outputCols=list(columns)).fit(df)


def impute_mode(df: DataFrame, columns: Sequence[str]) -> ImputerModel:
    """Fitted filler that puts the commonest value in place of nulls."""
    return Imputer(strategy="mode", inputCols=list(columns), outputCols=list(columns)).fit(df)


@dataclass(frozen=True)
class CategoryIndex:
    """Fitted index of categories: per column a written table (category, idx) of any length."""

    tables: dict[str, DataFrame]
    handle_invalid: str = "error"

    def look_up(self, df: DataFrame, name: str, output: str, null: Column | None = None) -> DataFrame:
        """Adds the index of one column's categories; ``null`` is the index of a null one."""
        ranks = self.tables[name].select(F.col("category").alias("__category"), F.col("idx").alias(output))
        category = F.col(quoted(name)).cast("string")
        df = df.join(ranks, category == F.col("__category"), "left").drop("__category")
        found = F.coalesce(output, F.when(category.isNull(), null)) if null is not None else F.col(output)
        if self.handle_invalid == "error":
            unknown = F.raise_error(F.concat(F.lit(f"unknown {name}: "), F.coalesce(category, F.lit("null"))))
            found = F.coalesce(found, unknown.cast("double"))
        return df.withColumn(output, found)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``<column>_idx``; a category that was not fitted fails, or is null with ``keep``."""
        for name in self.tables:
            df = self.look_up(df, name, f"{name}_idx")
        return df

    def save(self, spark: SparkSession, path: str) -> None:
        """A folder per column; the list of columns comes last, so it is there only if all is."""
        for i, table in enumerate(self.tables.values()):
            table.write.parquet(f"{path}/{i}")
        about = {"columns": list(self.tables), "handle_invalid": self.handle_invalid}
        files.write_new(spark, f"{path}/columns.json", json.dumps(about))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CategoryIndex:
        about = json.loads(files.read_text(spark, f"{path}/columns.json"))
        read = spark.read.schema("category string, idx double")
        tables = {name: read.parquet(f"{path}/{i}") for i, name in enumerate(about["columns"])}
        return cls(tables, about["handle_invalid"])


def index_categories(
    df: DataFrame, columns: Sequence[str], handle_invalid: str = "error"
) -> CategoryIndex:
    """Fitted index, commonest category first, equal counts by name.

    The values are counted and numbered as a table, so a column may have any
    number of them; nothing is collected.
    """
    tables = {}
    for name in columns:
        column = F.col(quoted(name))
        counts = df.where(column.isNotNull()).groupBy(column.cast("string").alias("category"))
        counted = counts.agg((-F.count("*")).alias("rarity"))
        numbered = number_in_order(counted, ["rarity", "category"], "idx")
        tables[name] = numbered.select("category", F.col("idx").cast("double").alias("idx"))
    return CategoryIndex(tables, handle_invalid)


def learned_encoder(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    handle_invalid: str = "error",
) -> PipelineModel:
    """All stages fitted as one model that is saved and loaded as a whole.

    A null category becomes the commonest one, and equal counts the one that sorts
    first, before it is indexed.  The one-hot width is the number of categories, so
    the columns are meant to have few; :func:`index_categories` has no such bound.
    """
    modes = df.agg(*[F.mode(name, True).alias(name) for name in categorical]).first()
    filled = [
        f"coalesce({quoted(name)}, {literal(modes[name])}) AS {quoted(name)}"
        if name in categorical and modes[name] is not None
        else quoted(name)
        for name in df.columns
    ]
    indexed = [f"{name}_idx" for name in categorical]
    encoded = [f"{name}_enc" for name in categorical]
    stages = [
        SQLTransformer(statement=f"SELECT {', '.join(filled)} FROM __THIS__"),
        Imputer(strategy="mean", inputCols=list(numeric), outputCols=list(numeric)),
        StringIndexer(
            inputCols=list(categorical),
            outputCols=indexed,
            stringOrderType="frequencyDesc",
            handleInvalid=handle_invalid,
        ),
        # A column of one category gets no slot; as a nominal column the encoder would refuse it.
        Imputer(strategy="mode", inputCols=indexed, outputCols=indexed),
        OneHotEncoder(inputCols=indexed, outputCols=encoded),
        VectorAssembler(inputCols=[*numeric, *encoded], outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(df)


@dataclass(frozen=True)
class WideEncoder:
    """Fitted encoder for vocabularies of any size, with the layout of :func:`learned_encoder`.

    First the numbers, then for each category column one slot per category but the
    last of the index.  The vectors are sparse, and put together by built-in
    expressions; the vocabularies stay tables, which are joined.
    """

    means: dict[str, float]
    sizes: dict[str, int]
    index: CategoryIndex

    @property
    def width(self) -> int:
        return len(self.means) + sum(max(n - 1, 0) for n in self.sizes.values())

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        """Adds the vector.

        A number that is null or NaN becomes the mean, a null category the commonest one.
        A category that was not fitted fails, or has no slot with ``keep``.
        """
        kept, entries, offset = df.columns, [], len(self.means)
        for i, (name, mean) in enumerate(self.means.items()):
            entries.append((F.lit(i), _number(name, F.lit(mean))))
        for i, (name, size) in enumerate(self.sizes.items()):
            df = self.index.look_up(df, name, f"__idx{i}", null=F.lit(0.0))
            at = F.col(f"__idx{i}")
            entries.append((F.when(at < size - 1, at.cast("int") + offset), F.lit(1.0)))
            offset += max(size - 1, 0)
        slots = F.array(*[F.struct(at.alias("at"), value.alias("value")) for at, value in entries])
        filled = F.filter(slots, lambda slot: slot["at"].isNotNull() & (slot["value"] != 0))
        vector = F.struct(
            F.lit(0).cast("byte").alias("type"),  # a sparse one
            F.lit(offset).alias("size"),
            filled["at"].alias("indices"),
            filled["value"].alias("values"),
        )
        # Only a reader gives a struct the type of a vector; numbers keep all their digits on the way.
        kind = StructType([StructField("vector", VectorUDT())])
        read = F.from_json(F.to_json(F.struct(vector.alias("vector"))), kind)["vector"]
        return df.select(*map(quoted, kept), read.alias(output))

    def save(self, spark: SparkSession, path: str) -> None:
        """Folder that :meth:`load` reads; ``encoder.json`` is written when all else is there."""
        self.index.save(spark, f"{path}/index")
        files.write_new(spark, f"{path}/encoder.json", json.dumps({"means": self.means, "sizes": self.sizes}))

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> WideEncoder:
        about = json.loads(files.read_text(spark, f"{path}/encoder.json"))
        return cls(about["means"], about["sizes"], CategoryIndex.load(spark, f"{path}/index"))


def _number(name: str, missing: Column | None = None) -> Column:
    number = F.col(quoted(name)).cast("double")
    known = F.when(~F.isnan(number), number)
    return known if missing is None else F.coalesce(known, missing)


def wide_encoder(
    df: DataFrame,
    numeric: Sequence[str] = NUMERIC,
    categorical: Sequence[str] = CATEGORICAL,
    handle_invalid: str = "error",
) -> WideEncoder:
    """Fitted encoder of columns with any number of categories; nothing of them is collected.

    Categories are ranked by count, equal counts by their text.  The commonest
    category is the first of the index, so null ones need no pass of their own.
    Numbers without any value are an error, and so are more than 2**31 - 1 slots.
    """
    index = index_categories(df, categorical, handle_invalid)
    sizes = {name: table.count() for name, table in index.tables.items()}
    means = df.agg(*[F.avg(_number(name)).alias(f"m{i}") for i, name in enumerate(numeric)]).first() if numeric else ()
    empty = [name for name, mean in zip(numeric, means, strict=True) if mean is None]
    if empty:
        raise ValueError(f"no value to fill the gaps of {', '.join(empty)}")
    encoder = WideEncoder(dict(zip(numeric, means, strict=True)), sizes, index)
    if encoder.width > 2**31 - 1:
        raise ValueError(f"{encoder.width} slots are more than a vector can have")
    return encoder

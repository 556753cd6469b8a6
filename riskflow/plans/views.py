"""Intake records derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.schema import INTAKE_COLUMNS, TARGET


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_AGE = "CAST(1 + (o_custkey * 7 + o_orderkey) % 100 AS INT)"
_INTAKE = (
    "o_orderkey AS id",
    "CASE WHEN o_custkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender",
    f"{_AGE} AS age",
    "CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS hypertension",
    "CASE WHEN o_orderpriority = '5-LOW' THEN 1 ELSE 0 END AS heart_disease",
    "CASE WHEN o_orderkey % 3 = 0 THEN 'No' ELSE 'Yes' END AS ever_married",
    """CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'children' WHEN 'BUILDING' THEN 'Govt_job'
       WHEN 'FURNITURE' THEN 'Never_worked' WHEN 'MACHINERY' THEN 'Private'
       ELSE 'Self-employed' END AS work_type""",
    "CASE WHEN c_nationkey % 2 = 0 THEN 'Urban' ELSE 'Rural' END AS Residence_type",
    "o_totalprice / 2500D AS avg_glucose_level",
    "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal / 250D END AS bmi",
    """CASE o_orderstatus WHEN 'F' THEN 'formerly smoked' WHEN 'O' THEN 'smokes'
       ELSE 'never smoked' END AS smoking_status""",
    f"""CASE WHEN {_AGE} > 60 AND (o_orderpriority = '1-URGENT' OR o_totalprice > 450000)
         AND o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS stroke""",
)


def intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One labelled record per order."""
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    return joined.selectExpr(*_INTAKE)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intake without the label, in record column order."""
    return intake(spark, sf_dir).select(*INTAKE_COLUMNS)


def intake_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Submitted text: some ages are not numbers."""
    age = F.expr("CASE WHEN id % 97 = 0 THEN 'abc' ELSE CAST(age AS STRING) END")
    return records(spark, sf_dir).withColumn("age", age)


def intake_unassigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third record has no id yet; ``seq`` is the arrival number."""
    return intake(spark, sf_dir).selectExpr(
        "id AS seq", "CASE WHEN id % 3 = 0 THEN CAST(-1 AS BIGINT) ELSE id END AS id", "gender", "age"
    )


def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stand-in scorers whose confidences tie now and then."""
    return intake(spark, sf_dir).selectExpr(
        "id",
        TARGET,
        "age > 60 AS a_positive",
        "CAST(50 + abs(age - 60) % 50 AS DOUBLE) / 100D AS a_confidence",
        "avg_glucose_level > 100 AS b_positive",
        "CAST(50 + id % 40 AS DOUBLE) / 100D AS b_confidence",
    )

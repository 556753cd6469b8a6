"""Binding of submitted fields to types, and the form's constraints.

A record is tagged in one pass with the first rule it breaks; nothing is
dropped, accepted and rejected records are two filters over the tagged frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.sqltext import case, literal, literals, quoted
from riskflow.schema import FORM_RULES, ID, INTAKE, UNASSIGNED_ID, Rule

REASON = "reason"
_STEP_TOLERANCE = 1e-9


def _bound(name: str, schema: T.StructType) -> str:
    """The field as its type; null where the text does not fit it."""
    wanted = schema[name].dataType
    return f"try_cast({quoted(name)} AS {wanted.simpleString()})"


def _broken(rule: Rule, schema: T.StructType) -> str | None:
    """SQL condition under which a record breaks the rule; None if it never can."""
    raw, value = quoted(rule.field), _bound(rule.field, schema)
    wanted = schema[rule.field].dataType
    if rule.kind == "required":
        empty = f" OR {raw} = ''" if isinstance(wanted, T.StringType) else ""
        return f"{raw} IS NULL{empty}"
    if rule.kind == "type":
        # Any value is a string.
        return None if isinstance(wanted, T.StringType) else f"{raw} IS NOT NULL AND {value} IS NULL"
    if rule.kind == "range":
        return f"{value} NOT BETWEEN {literal(rule.low)} AND {literal(rule.high)}"
    if rule.kind == "domain":
        return f"{value} NOT IN ({literals(rule.values)})"
    if rule.kind == "step":
        if isinstance(wanted, T.IntegralType) and rule.step == 1:
            return None
        steps = f"(({value} - {literal(float(rule.low))}) / {literal(float(rule.step))})"
        return f"abs({steps} - round({steps})) > {literal(_STEP_TOLERANCE)}"
    raise ValueError(f"unknown rule kind {rule.kind!r}")


def first_broken_rule(
    rules: tuple[Rule, ...] = FORM_RULES,
    schema: T.StructType = INTAKE,
    require_id: bool = False,
) -> Column:
    """``field:kind`` of the first broken rule, null for a good record.

    ``require_id`` is for streams, where no id can be handed out.
    """
    tests = [(_broken(rule, schema), literal(rule.reason)) for rule in rules]
    if require_id:
        missing = f"coalesce({_bound(ID, schema)}, {UNASSIGNED_ID}) = {UNASSIGNED_ID}"
        tests.append((missing, literal(f"{ID}:missing")))
    branches = [(condition, reason) for condition, reason in tests if condition is not None]
    return F.expr(case(branches)) if branches else F.lit(None).cast("string")


def tag_records(
    raw: DataFrame,
    rules: tuple[Rule, ...] = FORM_RULES,
    schema: T.StructType = INTAKE,
    require_id: bool = False,
) -> DataFrame:
    """``raw``, untouched, plus the ``reason`` column."""
    return raw.withColumn(REASON, first_broken_rule(rules, schema, require_id))


def accepted_records(tagged: DataFrame, schema: T.StructType = INTAKE) -> DataFrame:
    """Good records with their bound types; a missing id becomes -1.

    Columns outside the schema (an arrival number, say) are carried along.
    """
    bound = []
    for field in schema:
        value = _bound(field.name, schema)
        if field.name == ID:
            value = f"coalesce({value}, CAST({UNASSIGNED_ID} AS {field.dataType.simpleString()}))"
        bound.append(f"{value} AS {quoted(field.name)}")
    known = {*schema.names, REASON}
    extra = [quoted(name) for name in tagged.columns if name not in known]
    return tagged.where(F.col(REASON).isNull()).selectExpr(*bound, *extra)


def rejected_records(tagged: DataFrame) -> DataFrame:
    """Bad records as they were submitted, with the reason."""
    return tagged.where(F.col(REASON).isNotNull())


def validate_records(
    raw: DataFrame,
    rules: tuple[Rule, ...] = FORM_RULES,
    schema: T.StructType = INTAKE,
    require_id: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """``(accepted, rejected)``; together they hold every submitted record once."""
    tagged = tag_records(raw, rules, schema, require_id)
    return accepted_records(tagged, schema), rejected_records(tagged)


def count_reasons(tagged: DataFrame) -> DataFrame:
    """Records per outcome; accepted ones count under ``ok``."""
    return tagged.groupBy(F.coalesce(F.col(REASON), F.lit("ok")).alias(REASON)).agg(
        F.count("*").alias("n")
    )


def drop_incomplete(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows without null or NaN in ``columns`` (all by default); the tests are pushed into the scan."""
    tests = []
    for field in df.schema:
        if columns is not None and field.name not in columns:
            continue
        tests.append(f"{quoted(field.name)} IS NOT NULL")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            tests.append(f"NOT isnan({quoted(field.name)})")
    return df.where(" AND ".join(tests))

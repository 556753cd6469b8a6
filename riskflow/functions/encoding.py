"""Expressions that turn one field into feature values.

Each comes as SQL text (``*_sql``), to be put together into wide expressions,
and as a Column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.functions.sqltext import case, literal, literals, quoted
from riskflow.schema import CATCH_ALL, ERROR, Binary, EncodingSpec, Numeric, OneHot


def _flag(condition: str) -> str:
    return case([(condition, "1.0D")], "0.0D")


def _refuse(field: str, result_type: str) -> str:
    shown = f"coalesce(CAST({quoted(field)} AS STRING), 'null')"
    message = f"concat({literal(f'cannot encode {field}: ')}, {shown})"
    return f"CAST(raise_error({message}) AS {result_type})"


def numeric_sql(field: str) -> str:
    """The number as double.  A null fails: the vector type would read it as 0.0."""
    return f"coalesce(CAST({quoted(field)} AS DOUBLE), {_refuse(field, 'DOUBLE')})"


def binary_sql(field: str, mapping: dict[str, float], unknown: str | float = ERROR) -> str:
    """The mapped value of a category; all others (null too) follow ``unknown``."""
    branches = [
        (f"{quoted(field)} = {literal(category)}", literal(float(value)))
        for category, value in mapping.items()
    ]
    other = _refuse(field, "DOUBLE") if unknown == ERROR else literal(float(unknown))
    return case(branches, other)


def one_hot_sql(field: str, vocabulary: tuple[str, ...], unknown: str = ERROR) -> list[str]:
    """One 0/1 value per vocabulary entry, and a last one for the rest under ``CATCH_ALL``."""
    column = quoted(field)
    known = f"{column} IN ({literals(vocabulary)})"
    if unknown == CATCH_ALL:
        slots = [_flag(f"{column} = {literal(entry)}") for entry in vocabulary]
        return [*slots, case([(known, "0.0D")], "1.0D")]
    # Each slot tests the checked value, so that no slot can be read unchecked;
    # the common subexpression is evaluated once per row.
    checked = case([(known, column)], _refuse(field, "STRING"))
    return [_flag(f"{checked} = {literal(entry)}") for entry in vocabulary]


def encode_numeric(field: str) -> Column:
    return F.expr(numeric_sql(field))


def encode_binary(field: str, mapping: dict[str, float], unknown: str | float = ERROR) -> Column:
    return F.expr(binary_sql(field, mapping, unknown))


def encode_one_hot(field: str, vocabulary: tuple[str, ...], unknown: str = ERROR) -> list[Column]:
    return [F.expr(slot) for slot in one_hot_sql(field, vocabulary, unknown)]


def feature_sql(spec: EncodingSpec) -> list[str]:
    """All feature values of ``spec``, one double expression each, in layout order."""
    values: list[str] = []
    for part in spec.parts:
        if isinstance(part, Numeric):
            values.append(numeric_sql(part.field))
        elif isinstance(part, Binary):
            values.append(binary_sql(part.field, dict(part.mapping), part.unknown))
        elif isinstance(part, OneHot):
            values.extend(one_hot_sql(part.field, part.vocabulary, part.unknown))
        else:
            raise TypeError(f"no encoding for {part!r}")
    return values

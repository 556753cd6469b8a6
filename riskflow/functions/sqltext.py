"""Names and literals for expressions that are generated from data.

A generated expression goes to Spark as one SQL text: built call by call, the
driver would spend longer on a wide one than Spark does on planning it.
"""

from __future__ import annotations


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def literal(value: str | int | float | bool) -> str:
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, int):
        return str(value)
    if isinstance(value, float):
        return f"{value!r}D"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(values) -> str:
    return ", ".join(literal(value) for value in values)


def case(branches, otherwise: str | None = None) -> str:
    """``CASE WHEN ... END`` from ``(condition, result)`` pairs."""
    whens = " ".join(f"WHEN {condition} THEN {result}" for condition, result in branches)
    return f"CASE {whens} END" if otherwise is None else f"CASE {whens} ELSE {otherwise} END"

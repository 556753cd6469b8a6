"""Column functions over whole records: JSON, UTF-8, export names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskflow.schema import INTAKE, INTAKE_COLUMNS


def record_json(columns: tuple[str, ...] = INTAKE_COLUMNS) -> Column:
    """The record as one JSON object, fields in the given order, nulls left out."""
    return F.to_json(F.struct(*columns))


def parse_record(json: Column) -> Column:
    """Back from JSON text to a typed record; the text is parsed once for all fields."""
    return F.from_json(json, INTAKE)


def json_path(json: Column, path: str) -> Column:
    return F.get_json_object(json, path)


def utf8_bytes(text: Column) -> Column:
    return F.encode(text, "UTF-8")


def utf8_text(data: Column) -> Column:
    return F.decode(data, "UTF-8")


def export_name(key: Column, moment: Column) -> Column:
    """``<key>_<date>_<time>.bin.gz``."""
    stamp = F.replace(F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("T"), F.lit("_"))
    return F.concat(key.cast("string"), F.lit("_"), stamp, F.lit(".bin.gz"))

"""Exact deduplication by distributed most-significant-digit radix partitioning.

Two texts are equal when they are identical after each run of ASCII white space
became one space.  Round 0 splits the documents by the first ``DIGIT`` bytes of
the normalised text, round r splits every group that is left by its next
``DIGIT * 8**r`` bytes.  A group of one document is done, and so is one whose
text has ended: its members agree in every byte.  Only the others, with the
bytes not yet looked at, go on to the next round.  No digest takes part; the
SHA-256 in the result is for the reader.

A group never meets in one task: its size and smallest id are counted with
partial aggregation, and the rows are sent to their group by a join that cuts
large groups into parts.  Each round ends in a written table.

Defined cases: a null text counts as empty, all empty texts are one group; of
rows that repeat an id with the same text all are returned and marked as kept if
the id is; a null id counts as larger than any other; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import free_name, salted_join, semi_join_ids, written

DIGIT, WIDEN = 64, 8
_SPACES = frozenset(b" \t\n\x0b\x0c\r")
_ROWS = "doc_id {id}, text_sha256 string, digit binary, rest binary"


def normalise(text: str | None) -> bytes:
    """UTF-8 of the text with each run of ASCII white space as one space."""
    raw = (text or "").encode()
    if not raw:
        return b""
    inner = b" ".join(raw.split())
    if not inner:
        return b" "
    return b" " * (raw[0] in _SPACES) + inner + b" " * (raw[-1] in _SPACES)


def _normalised(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    def split_off(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [normalise(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                    pa.array([t[:DIGIT] for t in texts], pa.binary()),
                    pa.array([t[DIGIT:] for t in texts], pa.binary()),
                ],
                ["doc_id", "text_sha256", "digit", "rest"],
            )

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(split_off, _ROWS.format(id=id_type))


def _groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The groups of two or more, each with a number of its own."""
    counted = (
        rows.groupBy(*keys)
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("first_id"))
        .where("n > 1")
        .withColumn("next_group", F.monotonically_increasing_id())
    )
    return written(counted, "radix-groups")


def _split(rows: DataFrame, groups: DataFrame, keys: list[str], width: int) -> DataFrame:
    """Rows whose group is done, and rows that go on with their new group and rest."""
    alone, ended = F.col("n").isNull(), F.length("digit") < width
    goes_on = ~alone & ~ended
    return salted_join(rows, groups, keys, "n", "doc_id", "left").select(
        "doc_id",
        "text_sha256",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.when(goes_on, F.col("next_group")).alias("group"),
        F.when(goes_on, F.col("rest")).alias("rest"),
        goes_on.alias("open"),
    )


def exact_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows, keys, width, finished = _normalised(docs, id_column, text_column), ["digit"], DIGIT, []
    while True:
        groups = _groups(rows, keys)
        split = written(_split(rows, groups, keys, width), "radix-split", partition_by="open")
        finished.append(split.where("NOT open"))
        if groups.where(F.length("digit") == width).isEmpty():
            break
        width *= WIDEN
        keys = ["group", "digit"]
        rows = split.where("open").select(
            "doc_id",
            "text_sha256",
            "group",
            F.substring("rest", 1, width).alias("digit"),
            F.substring("rest", width + 1, 2**31 - 1).alias("rest"),
        )
    result = finished[0]
    for more in finished[1:]:
        result = result.unionByName(more)
    return result.select(
        F.col("doc_id").alias(id_column),
        F.col("keep_id"),
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def drop_duplicates(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The documents that stay, with all their columns: one row of each group of equal texts.

    It is the row with the smallest id, a null id counting as larger than any
    other; of several rows with that id, the first in a numbering of the rows that
    is written down before the first round.
    """
    number, place = free_name(docs, "row_number"), free_name(docs, "place")
    rows = written(docs.withColumn(number, F.monotonically_increasing_id()), "radix-rows")
    order = F.struct(F.col(id_column).isNull().alias("none"), F.col(id_column).alias("id"), F.col(number).alias("row"))
    judged = exact_duplicates(rows.select(order.alias(place), text_column), place, text_column)
    kept = judged.where("kept").select(F.col(place)["row"])
    return semi_join_ids(rows, kept, number).drop(number)

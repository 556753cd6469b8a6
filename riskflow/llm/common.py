"""Helpers that several operators of this package share."""

from __future__ import annotations

import ctypes
import gc
import re
from collections.abc import Iterator, Sequence
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskflow.sources import files
from riskflow.workspace import run_dir

#: A key with more than 1 / SHARES of all rows is dealt to several tasks; so at most SHARES keys are.
SHARES = 1000

# Blocks of scripts that put no space between words: Thai and Lao, Myanmar, Khmer,
# Kana, CJK ideographs with extension A, compatibility ideographs, the supplementary planes 2 and 3.
UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff"
    "\U00020000-\U0003ffff"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """The frame as a table in the shared scratch folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{run_dir(spark, label)}/table"
    writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
    writer.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_to = path
    return table


def forget(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made and that nothing will read any more."""
    for table in tables:
        files.delete(table.sparkSession, table.written_to)


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that the frame does not have yet."""
    taken = {name.lower() for name in df.columns}
    while stem in taken:
        stem += "_"
    return stem


def semi_join_ids(docs: DataFrame, ids: DataFrame, id_column: str) -> DataFrame:
    """The rows of ``docs`` whose id is in the one column of ``ids``; null counts as an id."""
    wanted = free_name(docs, "wanted")
    return docs.join(ids.toDF(wanted), F.col(id_column).eqNullSafe(F.col(wanted)), "left_semi")


def crc_remainder(column: str, modulus: int) -> Column:
    """crc32 of an id's text, modulo ``modulus``; a null id counts as an empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % modulus


def salted_join(
    rows: DataFrame,
    groups: DataFrame,
    keys: Sequence[str],
    count: str,
    spread_by: str | Column,
    how: str = "inner",
    keep_parts: bool = False,
) -> DataFrame:
    """Join rows with one row per key, where ``groups[count]`` rows have the key.

    A key with more than 1 / SHARES of all counted rows is cut into parts by a
    hash of ``spread_by``, in proportion to its count; its group row is repeated
    for each part.  The hashes of such keys are at most SHARES rows of two numbers,
    whatever the size of the input, and the only thing broadcast.  ``groups`` is
    read four times and should be a written table.  Null keys never match.
    ``keep_parts`` leaves the columns by which the result is dealt out: ``_key``
    (hash of the keys), ``_part`` and the number of parts, ``_parts``.
    """
    total = groups.agg(F.coalesce(F.sum(count), F.lit(0)).alias("n")).scalar()
    share = F.col(count) * SHARES
    heavy = (
        groups.where(share > total)
        .groupBy(F.xxhash64(*keys).alias("_key"))
        .agg(F.max(F.ceil(share / total)).cast("int").alias("_parts"))
    )
    hashed = F.xxhash64(F.col(spread_by) if isinstance(spread_by, str) else spread_by)
    parts = F.coalesce("_parts", F.lit(1))

    def with_parts(df: DataFrame) -> DataFrame:
        return df.withColumn("_key", F.xxhash64(*keys)).join(F.broadcast(heavy), "_key", "left")

    dealt = with_parts(rows).withColumn("_part", F.pmod(hashed, parts).cast("int"))
    repeated = with_parts(groups).withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    on = ["_key", *keys, "_part"]
    # Both sides grow with the corpus: the plan is the same at any size.
    dealt = dealt.withColumn("_parts", parts) if keep_parts else dealt.drop("_parts")
    joined = dealt.hint("merge").join(repeated.drop("_parts"), on, how)
    return joined if keep_parts else joined.drop("_key", "_part")


def give_back() -> None:
    """Return what a Python worker has freed to the system: workers are kept, and idle ones count too."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def text_chunks(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[slice, list[str | None]]]:
    """Texts of a column, about ``limit`` bytes at a time; only these are taken out of it."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    start = 0
    while start < len(ends):
        before = int(ends[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield slice(start, stop), column.slice(start, stop - start).to_pylist()
        start = stop


class WordIds(dict):
    """Numbers words from 0 in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


class HashIndex:
    """Positions of distinct 64-bit keys, looked up for whole arrays at once.

    Open addressing in a table of at least twice as many slots as keys.
    """

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(2 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.mask = np.int64((1 << bits) - 1)
        self.keys = np.ascontiguousarray(keys, dtype=np.int64)
        self.slots = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        slot = self._first(self.keys)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = left[free]
            lost = self.slots[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.FACTOR) >> self.shift).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Position of each key, -1 where it is none of the keys."""
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        keys = np.ascontiguousarray(keys, dtype=np.int64)
        slot = self._first(keys)
        found = self.slots[slot]
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            slot_ = (slot[open_] + 1) & self.mask
            slot[open_] = slot_
            candidate = self.slots[slot_]
            found[open_] = candidate
            open_ = open_[(candidate >= 0) & (self.keys[candidate] != keys[open_])]
        return found


class Best:
    """The k best rows of a query so far, as (-score, id is null, id); equal scores go by id, nulls last."""

    def __init__(self, k: int, least: int = 1):
        self.k, self.start, self.rows = k, least, []

    def least(self) -> int:
        """The score that a further row has to reach."""
        return -self.rows[-1][0] if len(self.rows) == self.k else self.start

    def add(self, scores: np.ndarray, rows: np.ndarray, ids: pa.Array) -> None:
        """Take in rows by their scores; ``rows`` are their places among the ids."""
        if len(scores) > self.k:
            enough = scores >= np.partition(scores, -self.k)[-self.k]
            scores, rows = scores[enough], rows[enough]
        found = ids.take(pa.array(rows)).to_pylist()
        more = [(-s, i is None, i if i is not None else 0) for s, i in zip(scores.tolist(), found, strict=True)]
        self.rows = nsmallest(self.k, [*self.rows, *more])

    def found(self) -> list[tuple[object, int]]:
        """(id, score), best first."""
        return [(None if absent else i, -score) for score, absent, i in self.rows]


class Spacing:
    """Parts runs of scripts without spaces into pieces of ``n`` characters; other texts stay as they are."""

    def __init__(self, n: int):
        self.piece = re.compile(f"[{UNSPACED}]{{1,{n}}}")

    def __call__(self, text: str) -> str:
        return text if text.isascii() else self.piece.sub(r" \g<0> ", text)


def chunks(texts: list[str | None], limit: int = 1 << 22) -> list[slice]:
    """Cut a list of texts where about ``limit`` characters have gathered; a longer text is alone."""
    cuts, start, size = [], 0, 0
    for i, text in enumerate(texts):
        n = len(text or "")
        if i > start and size + n > limit:
            cuts.append(slice(start, i))
            start, size = i, 0
        size += n
    if start < len(texts):
        cuts.append(slice(start, len(texts)))
    return cuts

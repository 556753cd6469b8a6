"""Hard negatives by threshold joins on inner products, after L2AP.

Components are scaled and floored, so scores are whole numbers.  An anchor's positives
are the best rows of its own label; for each of them, its negatives are the best rows
of other labels whose score lies in a window below the positive's.

``build_blocks`` deals the rows out into blocks of at most ``BLOCK`` vectors.  In a
block the dimensions are ordered by how much of the vectors lies in them and cut into
strips of ``STRIP``; for every vector it knows the norm of what is left from each strip
on.  A search for scores of at least t goes, per block and batch of anchors, like this:

* an inverted list of a strip holds the rows that still can give t from there on:
  rows are left out of the lists of all strips whose suffix norm, times the greatest
  norm of an anchor, is below t.
* scores are accumulated strip by strip; a pair is dropped when what it has so far and
  the product of the remaining norms (Cauchy-Schwarz) stay below t.
* what is left is scored in full.

Every window (an anchor's positives, or the negatives of one positive) starts with a
threshold near its upper end.  All windows that did not get the rows they ask for go
on to the next round with a lower one, at last with the window's lower end; so every
row that belongs into a window is found, and most pairs never get near their last
dimension.  Within a task the best rows so far raise the threshold again.  A task gives
at most as many rows a window as the window may keep.

Anchors are taken in slices of about ``ANCHORS``, each against all blocks; a slice and
the state of its windows are all that goes through the driver.

Defined cases: rows with a null id, label, vector or component, or one that is not
finite, take no part; missing components count as zero; rows with the anchor's own id
are not its positives; repeated rows count each, repeated anchors once; equal scores go
by id; scores must fit 64 bits; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import Best, written

BLOCK, STRIP = 8192, 8
#: Anchors of a slice, about, and of a batch.
ANCHORS, BATCH = 2048, 64
#: How far down its window a threshold lies in each round.
STEPS = (1 / 16, 1 / 8, 1 / 4, 1 / 2, 1)
#: Pairs are scored in full when less than this share is left.
FEW = 1 / 8
_EXACT = float(1 << 52)
_FAR = 1 << 62


def scaled(vectors: pa.Array, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """The vectors as rows of whole numbers, padded with zeros, and which of them are usable."""
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten()
    values = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)  # nulls become NaN
    with np.errstate(over="ignore"):
        values = np.floor(values * scale)
    of_row = np.repeat(np.arange(len(sizes)), sizes)
    usable = np.ones(len(sizes), bool)
    usable[of_row[~np.isfinite(values)]] = False
    matrix = np.zeros((len(sizes), int(sizes.max(initial=0))))
    matrix[of_row, np.arange(len(of_row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return matrix[usable], usable


def _widened(matrix: np.ndarray, dims: int) -> np.ndarray:
    """The first ``dims`` columns, missing ones as zeros."""
    return np.pad(matrix[:, :dims], ((0, 0), (0, max(0, dims - matrix.shape[1]))))


def _suffix_norms(matrix: np.ndarray) -> np.ndarray:
    """For each strip and one past the last, the norms of the rows from there on."""
    squares = np.square(matrix)
    strips = range(0, matrix.shape[1], STRIP)
    sums = np.array([squares[:, d : d + STRIP].sum(axis=1) for d in strips]).reshape(len(strips), len(matrix))
    return np.sqrt(np.vstack([np.cumsum(sums[::-1], axis=0)[::-1], np.zeros((1, len(matrix)))]))


def _keys(column: pa.Array) -> np.ndarray:
    """Ids or labels in a form that can be compared for whole arrays."""
    return column.to_numpy(zero_copy_only=False)


def _bytes_of(matrix: np.ndarray) -> tuple[bytes, str]:
    most = np.abs(matrix).max(initial=0)
    kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<f8"
    return matrix.astype(kind).tobytes(), kind


def build_blocks(rows: DataFrame, scale: float) -> DataFrame:
    """A written table with one row per block of the rows (id, label, vector)."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[pa.Array, pa.Array, np.ndarray]] = []

        def block(parts) -> pa.RecordBatch:
            ids, labels = (pa.concat_arrays([p[i] for p in parts]) for i in (0, 1))
            dims = max(p[2].shape[1] for p in parts)
            matrix = np.vstack([_widened(p[2], dims) for p in parts])
            order = np.argsort(-np.square(matrix).sum(axis=0), kind="stable")
            raw, kind = _bytes_of(matrix[:, order])
            whole = pa.array([0, len(ids)], pa.int32())
            arrays = [pa.ListArray.from_arrays(whole, ids), pa.ListArray.from_arrays(whole, labels)]
            most = float(np.linalg.norm(matrix, axis=1).max(initial=0))
            rest = ([raw], [kind], [order.tolist()], [most])
            types = (pa.binary(), pa.string(), pa.list_(pa.int32()), pa.float64())
            arrays += [pa.array(x, t) for x, t in zip(rest, types, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, ["ids", "labels", "matrix", "kind", "dims", "most"])

        for batch in batches:
            matrix, usable = scaled(batch.column(2), scale)
            ids, labels = (batch.column(i).filter(pa.array(usable)) for i in (0, 1))
            at = 0
            while at < len(ids):
                room = BLOCK - sum(len(p[0]) for p in waiting)
                waiting.append((ids[at : at + room], labels[at : at + room], matrix[at : at + room]))
                at += room
                if sum(len(p[0]) for p in waiting) == BLOCK:
                    yield block(waiting)
                    waiting = []
        if waiting:
            yield block(waiting)

    types = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = (
        f"ids array<{types['id']}>, labels array<{types['label']}>, matrix binary, kind string,"
        " dims array<int>, most double"
    )
    # Dealt out by id, so that no block is full of neighbours of one source.
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.select("id", "label", "vector").repartition(partitions, "id")
    return written(dealt.mapInArrow(blocks, schema), "vector-blocks")


class Block:
    """Some vectors, their dimensions in the order of the inverted lists."""

    def __init__(self, ids: pa.Array, labels: pa.Array, matrix: np.ndarray, dims: np.ndarray):
        self.ids, self.labels = ids, _keys(labels)
        self.own = _keys(ids)
        self.matrix, self.dims = matrix, dims
        self.norms = _suffix_norms(matrix)

    @classmethod
    def of(cls, batch: pa.RecordBatch, i: int) -> Block:
        get = {name: batch.column(name)[i] for name in batch.schema.names}
        dims = np.array(get["dims"].as_py(), np.int64)
        raw = np.frombuffer(get["matrix"].as_py(), get["kind"].as_py())
        matrix = raw.reshape(len(get["ids"].values), len(dims)).astype(np.float64)
        return cls(get["ids"].values, get["labels"].values, matrix, dims)

    def lists(self, norm: float, least: float) -> list[np.ndarray]:
        """The rows in each strip's inverted list: those that can still give ``least`` from there on."""
        return [np.flatnonzero(n * norm >= least) for n in self.norms[:-1]]

    def pairs(
        self, asked: np.ndarray, least: np.ndarray, wanted: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row and score of all wanted pairs with at least the query's least score.

        ``asked`` has a row per query, its dimensions in the block's order; ``wanted`` is
        queries by rows.
        """
        none = np.zeros(0, np.int64)
        if not len(asked) or not len(self.matrix):
            return none, none, none
        norms = _suffix_norms(asked)
        most = float(norms[0].max() * self.norms[0].max())
        # Norms are rounded, so bounds get a little room.
        bar = least.astype(np.float64) - 1e-9 * most - 1e-6
        rows = np.arange(len(self.matrix))
        total = np.zeros((len(asked), len(rows)))
        done = np.zeros(len(rows), np.int64)
        left = wanted
        for strip, listed in enumerate(self.lists(float(norms[0].max()), float(bar.min()))):
            listed = np.flatnonzero(np.isin(rows, listed, assume_unique=True))
            d = slice(strip * STRIP, (strip + 1) * STRIP)
            total[:, listed] += asked[:, d] @ self.matrix[rows[listed], d].T
            done[listed] = strip + 1
            left = left & (total + norms[done].T * self.norms[done, rows] >= bar[:, None])
            used = left.any(axis=0)
            if not used.all():
                rows, total, done, left = rows[used], total[:, used], done[used], left[:, used]
            if left.sum() < FEW * left.size or not len(listed):
                break
        query, column = np.nonzero(left)
        row, unfinished = rows[column], done[column] < len(self.norms) - 1
        score = total[query, column]
        for a in range(0, len(query), 1 << 15):
            some = np.flatnonzero(unfinished[a : a + (1 << 15)]) + a
            score[some] = np.einsum("ij,ij->i", asked[query[some]], self.matrix[row[some]])
        if most >= _EXACT:  # sums of floats may be rounded: in whole numbers then
            both = zip(asked[query].tolist(), self.matrix[row].tolist(), strict=True)
            exact = [sum(int(x) * int(y) for x, y in zip(*pair, strict=True)) for pair in both]
            score = np.array(exact, np.int64)
        score = score.astype(np.int64)
        enough = score >= least[query]
        return query[enough], row[enough], score[enough]


@dataclass
class Windows:
    """What is looked for: ``k`` best rows of ``low`` to ``high`` for the anchor ``of``, sorted by ``of``."""

    of: np.ndarray
    low: np.ndarray
    high: np.ndarray
    least: np.ndarray

    def lowered(self, step: float) -> Windows:
        span = (self.high.astype(np.float64) - self.low) * step
        least = self.low if step == 1 else np.maximum(self.low, self.high - span.astype(np.int64))
        return Windows(self.of, self.low, self.high, least)

    def some(self, which: np.ndarray) -> Windows:
        return Windows(self.of[which], self.low[which], self.high[which], self.least[which])


@dataclass
class Anchors:
    """A slice of anchors; ``matrix`` has their scaled vectors."""

    ids: pa.Array
    labels: pa.Array
    matrix: np.ndarray


def _fill(block: Block, anchors: Anchors, windows: Windows, best: list[Best], same: bool) -> None:
    """Bring the best rows of all windows up to date with a block."""
    ids, labels = _keys(anchors.ids), _keys(anchors.labels)
    matrix = _widened(anchors.matrix, len(block.dims))[:, block.dims]
    searched = np.unique(windows.of)
    start = np.searchsorted(windows.of, searched)
    end = np.searchsorted(windows.of, searched, "right")
    for a in range(0, len(searched), BATCH):
        some = searched[a : a + BATCH]
        mine = list(zip(start[a : a + BATCH].tolist(), end[a : a + BATCH].tolist(), strict=True))
        least = np.array([min(best[w].least() for w in range(*w)) for w in mine], np.int64)
        wanted = (labels[some][:, None] == block.labels[None, :]) == same
        if same:
            wanted &= ids[some][:, None] != block.own[None, :]
        query, row, score = block.pairs(matrix[some], least, wanted)
        cut = np.searchsorted(query, np.arange(len(some) + 1))
        for q, (first, last) in enumerate(mine):
            rows, scores = row[cut[q] : cut[q + 1]], score[cut[q] : cut[q + 1]]
            for w in range(first, last) if len(rows) else ():
                fits = (scores >= best[w].least()) & (scores <= windows.high[w])
                if fits.any():
                    best[w].add(scores[fits], rows[fits], block.ids)


def _round(
    blocks: DataFrame, anchors: Anchors, numbers: np.ndarray, windows: Windows, k: int, same: bool, last: bool
) -> DataFrame:
    """(window, id, score, rank, settled) of the rows found for the windows with these numbers, as a written table."""
    shipped = blocks.sparkSession.sparkContext.broadcast((anchors, numbers, windows))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, numbers, windows = shipped.value
        best = [Best(k, low) for low in windows.least.tolist()]
        for batch in batches:
            for i in range(batch.num_rows):
                _fill(Block.of(batch, i), anchors, windows, best, same)
        found = [(number, *row) for number, top in zip(numbers.tolist(), best, strict=True) for row in top.found()]
        if found:
            number, ids, scores = zip(*found, strict=True)
            arrays = [pa.array(number, pa.int64()), pa.array(ids, anchors.ids.type), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["window", "id", "score"])

    id_type = blocks.schema["ids"].dataType.elementType.simpleString()
    found = blocks.drop("most").mapInArrow(fill, f"window bigint, id {id_type}, score bigint")
    same_window = Window.partitionBy("window")
    ranked = found.withColumn("rank", F.row_number().over(same_window.orderBy(F.desc("score"), "id")))
    settled = F.lit(last) | (F.count("*").over(same_window) == k)
    return written(ranked.where(F.col("rank") <= k).withColumn("settled", settled), "negatives-round")


def _filled(blocks: DataFrame, anchors: Anchors, windows: Windows, k: int, same: bool) -> DataFrame:
    """(window, id, score, rank) of every window, thresholds lowered until it is full or at its lower end."""
    open_, result = np.arange(len(windows.of)), None
    for step in STEPS:
        some = windows.some(open_).lowered(step)
        found = _round(blocks, anchors, open_, some, k, same, last=step == 1)
        done = found.where("settled")
        result = done if result is None else result.unionByName(done)
        # At most one row per window of the slice.
        full = [row[0] for row in done.select("window").distinct().collect()]
        open_ = np.setdiff1d(open_, np.array(full, np.int64))
        if not len(open_):
            break
    return result.drop("settled")


def _slices(anchors: DataFrame, scale: float) -> Iterator[Anchors]:
    rows = written(anchors.distinct(), "anchors")
    n = max(1, math.ceil(rows.count() / ANCHORS))
    for i in range(n):
        some = rows.where(F.pmod(F.xxhash64("id", "label", "vector"), F.lit(n)) == i).orderBy("id", "label", "vector")
        found = some.toArrow().combine_chunks()
        ids, labels, vectors = (
            pa.concat_arrays(c.chunks) if c.num_chunks else pa.array([], c.type) for c in found.columns
        )
        matrix, usable = scaled(vectors, scale)
        yield Anchors(ids.filter(pa.array(usable)), labels.filter(pa.array(usable)), matrix)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    *,
    scale: float = 256,
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per anchor, positive and negative, with ranks and scores.

    Negatives score at least ``low`` and at most ``high`` per cent of their positive.
    """
    spark = rows.sparkSession
    named = [F.col(id_column).alias("id"), F.col(label_column).alias("label"), F.col(vector_column).alias("vector")]
    usable = F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull()
    blocks = build_blocks(rows.select(*named).where(usable), scale)
    most = blocks.agg(F.coalesce(F.max("most"), F.lit(0.0))).first()[0]
    id_type = rows.schema[id_column].dataType.simpleString()
    schema = f"window bigint, anchor_id {id_type}, positive_id {id_type}, positive_score bigint"
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    result = None
    for anchors in _slices(rows.where(is_anchor).select(*named).where(usable), scale):
        reach = np.minimum(np.linalg.norm(anchors.matrix, axis=1) * most + 1, _FAR).astype(np.int64)
        every = np.arange(len(anchors.ids))
        found = _filled(blocks, anchors, Windows(every, -reach, reach, -reach), n_positives, same=True)
        positives = found.orderBy("window", "rank").toArrow()  # n_positives rows for each anchor of the slice
        of = positives.column("window").to_numpy()
        scores = positives.column("score").to_pylist()
        lows = [-(-low * s // 100) for s in scores]
        highs = [high * s // 100 for s in scores]
        # A window of a negative score is empty.
        windows = Windows(of, np.array(lows, np.int64), np.array(highs, np.int64), np.array(lows, np.int64))
        held = windows.low <= windows.high
        numbers = np.flatnonzero(held)
        negatives = _filled(blocks, anchors, windows.some(numbers), n_negatives, same=False)
        ids = pa.chunked_array([anchors.ids.take(pa.array(of))]) if len(of) else positives.column("id")
        asked = pa.table(
            {
                "window": np.arange(len(numbers)),
                "anchor_id": ids.take(pa.array(numbers)),
                "positive_id": positives.column("id").take(pa.array(numbers)),
                "positive_score": positives.column("score").take(pa.array(numbers)),
            }
        )
        # As many rows as the slice has windows.
        asked = F.broadcast(spark.createDataFrame(asked, schema))
        joined = negatives.join(asked, "window").select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        result = joined if result is None else result.unionByName(joined)
    return result.select(*names)

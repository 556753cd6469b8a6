"""Ranked lexical search by Block-Max MaxScore over an index in shards.

``build_index`` reads the texts once.  A task cuts its documents into shards of at
most ``SHARD_WORDS`` words (a longer text is a shard of its own) and turns each
into one row of the index: every term of every document, its posting list in blocks
of ``BLOCK`` postings, gaps between documents and term counts packed in as few
bytes as the block needs.  The index holds no statistics of the corpus, so shards
can be added; per block it keeps the largest term count and the shortest document,
from which a search derives the largest score that a posting in it can have.

``search`` adds the statistics of all shards up (documents, words, documents per
term asked for), then lets every task run all queries over its shards:

* lists are ordered by their greatest score.  Those whose greatest scores together
  stay below the k-th best score so far are non-essential: a document in no other
  list cannot get in.
* the essential lists are added up; what they give for a document, with the
  maxima of the non-essential blocks it falls into, is a bound.  Documents under the
  k-th best score are turned down before those blocks are unpacked.
* the non-essential lists are then unpacked block by block, greatest first, and the
  bounds tightened after each.

A task carries the k best of each query from shard to shard; the k best of all tasks
are merged by a window.  So what is shuffled has k rows a query and task.

Queries are shipped in slices of at most ``QUERY_BYTES`` of text, one pass over the
index for each slice.

Terms are runs of ASCII letters and digits and of all characters beyond ASCII; only
A-Z are lower-cased.  Scores are whole numbers, see ``impacts`` and ``weights``.

Defined cases: a document without a term, null texts included, counts for nothing; a
query without a term that some document holds gives no row; rows that repeat an id
are documents, or queries, of their own; equal scores go by id, null ids last; other
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskflow.llm.common import Best, WordIds, chunks, written

BLOCK = 128
#: Words and documents of a shard at most.
SHARD_WORDS, SHARD_DOCS = 1 << 21, 1 << 17
QUERY_BYTES = 8 << 20

_LETTERS = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B))
_TERM_BYTES = bytes(
    b if b >= 0x80 or b in _LETTERS and not 0x41 <= b <= 0x5A else b + 32 if b in _LETTERS else 0x20
    for b in range(256)
)
_WIDTHS = (1, 2, 4)
_STREAMS = [f"{what}{width}" for what in ("gaps", "counts") for width in _WIDTHS]
#: Columns of numbers, with their types; ``sizes`` is by document, ``lists`` by term, the others by block.
_NUMBERS = {"sizes": "<i8", "hashes": "<u8", "lists": "<i4", "last": "<i4", "most": "<i4", "least": "<i8"}


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TERM_BYTES).split()


def impacts(counts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """What a term gives per unit of its weight; ``lengths`` as by ``Query.lengths``."""
    return 1_000_000_000 * counts // (1000 * counts + 8 * lengths)


def weights(found_in: np.ndarray, n_docs: int) -> np.ndarray:
    logs = [math.log((2 * n_docs + 2) / (2 * df + 1)) for df in found_in.tolist()]
    return np.array([math.floor(1000 * x) for x in logs], np.int64)


def _hashes(terms: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, terms), np.uint64, len(terms))


def _packed(values: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The least width that holds each block's largest value, and the values, one stream a width."""
    width = np.digitize(np.maximum.reduceat(values, starts), [1 << 8, 1 << 16])
    of_value = np.repeat(width, np.diff(np.append(starts, len(values))))
    return width, [values[of_value == k].astype(f"<u{w}") for k, w in enumerate(_WIDTHS)]


class ShardBuilder:
    """Gathers documents and turns them into one row of the index."""

    def __init__(self):
        self.words = WordIds()
        self.ids: list[pa.Array] = []
        self.sizes: list[int] = []
        self.keys: list[np.ndarray] = []
        self.n_words = 0

    def add(self, ids: pa.Array, texts: list[str | None]) -> None:
        cut = [terms_of(text) for text in texts]
        sizes = [len(words) for words in cut]
        total = sum(sizes)
        flat = np.fromiter(map(self.words.__getitem__, chain.from_iterable(cut)), np.int64, total)
        docs = np.repeat(np.arange(len(self.sizes), len(self.sizes) + len(sizes)), sizes)
        self.keys.append(flat << 32 | docs)
        self.ids.append(ids)
        self.sizes += sizes
        self.n_words += total

    def row(self) -> dict:
        terms = list(self.words)
        hashes = _hashes(terms)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(terms), np.int64)
        place[order] = np.arange(len(terms))
        keys = np.concatenate(self.keys)
        keys = place[keys >> 32] << 32 | (keys & 0xFFFFFFFF) if len(terms) else keys
        keys, counts = np.unique(keys, return_counts=True)
        of_list, docs = keys >> 32, keys & 0xFFFFFFFF
        sizes = np.array(self.sizes, np.int64)
        row = {
            "n_docs": int((sizes > 0).sum()),
            "n_words": self.n_words,
            "ids": pa.concat_arrays(self.ids),
            "terms": [terms[i] for i in order.tolist()],
        }
        numbers = {"sizes": sizes, "hashes": hashes[order], "lists": np.bincount(of_list, minlength=len(terms))}
        streams, widths = [np.zeros(0, np.uint8)] * len(_STREAMS), np.zeros(0, np.int64)
        numbers |= {name: np.zeros(0, np.int64) for name in ("last", "most", "least")}
        if len(keys):
            first = np.cumsum(numbers["lists"]) - numbers["lists"]
            within = np.arange(len(keys)) - first[of_list]
            starts = np.flatnonzero(within % BLOCK == 0)
            ends = np.append(starts[1:], len(keys)) - 1
            gaps = np.diff(docs, prepend=0)
            gaps[first] = docs[first]
            numbers["last"] = docs[ends]
            numbers["most"] = np.maximum.reduceat(counts, starts)
            numbers["least"] = np.minimum.reduceat(sizes[docs], starts)
            (of_gaps, gap_streams), (of_counts, count_streams) = _packed(gaps, starts), _packed(counts, starts)
            widths, streams = of_gaps << 2 | of_counts, gap_streams + count_streams
        row["widths"] = widths.astype("<u1").tobytes()
        row |= {name: numbers[name].astype(kind).tobytes() for name, kind in _NUMBERS.items()}
        return row | {name: stream.tobytes() for name, stream in zip(_STREAMS, streams, strict=True)}


def _index_schema(id_type: str) -> str:
    raw = ", ".join(f"{name} binary" for name in [*_NUMBERS, "widths", *_STREAMS])
    return f"n_docs bigint, n_words bigint, ids array<{id_type}>, terms array<binary>, {raw}"


def build_index(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """A written table with one row per shard."""

    def as_batch(shard: ShardBuilder) -> pa.RecordBatch:
        row = shard.row()
        numbers = [pa.array([row.pop(name)], pa.int64()) for name in ("n_docs", "n_words")]
        ids = row.pop("ids")
        lists = [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
        lists.append(pa.array([row.pop("terms")], pa.list_(pa.binary())))
        raw = [*_NUMBERS, "widths", *_STREAMS]
        arrays = [*numbers, *lists, *(pa.array([row[name]], pa.binary()) for name in raw)]
        return pa.RecordBatch.from_arrays(arrays, ["n_docs", "n_words", "ids", "terms", *raw])

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = ShardBuilder()
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for some in chunks(texts, SHARD_WORDS // 4):
                # A text has at most one term for every two characters.
                more = sum(len(text or "") for text in texts[some]) // 2
                full = shard.n_words + more > SHARD_WORDS or len(shard.sizes) + some.stop - some.start > SHARD_DOCS
                if shard.sizes and full:
                    yield as_batch(shard)
                    shard = ShardBuilder()
                shard.add(batch.column(0)[some], texts[some])
        if shard.sizes:
            yield as_batch(shard)

    id_type = docs.schema[id_column].dataType.simpleString()
    return written(docs.select(id_column, text_column).mapInArrow(index, _index_schema(id_type)), "search-index")


class Shard:
    """One row of the index, its lists unpacked on demand and kept for the next query."""

    def __init__(self, row: dict, ids: pa.Array, terms: pa.Array):
        self.ids, self.terms = ids, terms
        for name, kind in _NUMBERS.items():
            setattr(self, name, np.frombuffer(row[name], kind))
        blocks = -(-self.lists // BLOCK)
        self.ends = np.cumsum(blocks)
        self.starts = self.ends - blocks
        n = int(self.ends[-1]) if len(self.ends) else 0
        of_block = np.repeat(np.arange(len(self.lists)), blocks)
        self.in_block = np.minimum(BLOCK, self.lists[of_block] - BLOCK * (np.arange(n) - self.starts[of_block]))
        self.base = np.zeros(n, np.int64)
        self.base[1:] = self.last[:-1]
        self.base[self.starts] = 0
        widths = np.frombuffer(row["widths"], "<u1")
        self.packed = {}
        for what, width in (("gaps", widths >> 2), ("counts", widths & 3)):
            sizes = [np.where(width == k, self.in_block, 0) for k in range(len(_WIDTHS))]
            streams = [np.frombuffer(row[f"{what}{w}"], f"<u{w}") for w in _WIDTHS]
            self.packed[what] = width, [np.append(0, np.cumsum(s)) for s in sizes], streams
        self.known: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def find(self, terms: Sequence[bytes], hashes: np.ndarray) -> np.ndarray:
        """The list of each term, -1 where the shard has none."""
        low = np.searchsorted(self.hashes, hashes, "left")
        high = np.searchsorted(self.hashes, hashes, "right")
        found = np.full(len(terms), -1, np.int64)
        for i in np.flatnonzero(low < high).tolist():
            for k in range(low[i], high[i]):
                if self.terms[k].as_py() == terms[i]:
                    found[i] = k
        return found

    def _values(self, what: str, a: int, b: int) -> np.ndarray:
        width, offsets, streams = self.packed[what]
        width = width[a:b]
        parts = [s[o[a] : o[b]] for o, s in zip(offsets, streams, strict=True)]
        if (width == width[0]).all():
            return parts[width[0]].astype(np.int64)
        of_value = np.repeat(width, self.in_block[a:b])
        values = np.empty(len(of_value), np.int64)
        for k, part in enumerate(parts):
            values[of_value == k] = part
        return values

    def unpack(self, a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and impacts of the blocks a to b of one list."""
        key = (a, b)
        if key not in self.known:
            gaps = self._values("gaps", a, b)
            # Gaps count on from the block before, so only the first block's base is missing.
            docs = np.cumsum(gaps) + self.base[a]
            self.known[key] = docs, impacts(self._values("counts", a, b), self.lengths[docs])
        return self.known[key]

    def weigh(self, lengths_of) -> None:
        """Take the lengths of documents, and the greatest impacts of blocks and lists, by the corpus's statistics."""
        self.lengths = lengths_of(self.sizes)
        self.block_most = impacts(self.most.astype(np.int64), lengths_of(self.least))
        some = len(self.starts) > 0
        self.list_most = np.maximum.reduceat(self.block_most, self.starts) if some else self.block_most


@dataclass
class Queries:
    """A slice of queries: their ids, distinct terms, and per query (term, repeats)."""

    ids: list
    terms: list[bytes]
    hashes: np.ndarray
    of_query: list[list[tuple[int, int]]]

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]]) -> Queries:
        known = WordIds()
        counted = [Counter(known[w] for w in terms_of(text)) for _, text in rows]
        terms = list(known)
        return cls([i for i, _ in rows], terms, _hashes(terms), [sorted(c.items()) for c in counted])


@dataclass
class Corpus:
    """What scores need of all documents."""

    n_docs: int
    n_words: int
    term_weights: np.ndarray

    def lengths(self, sizes: np.ndarray) -> np.ndarray:
        return 25 + 75 * sizes.astype(np.int64) * self.n_docs // self.n_words


def run_query(shard: Shard, lists: np.ndarray, factors: np.ndarray, best: Best) -> None:
    """Bring the best documents up to date with a shard; ``factors`` are weights times repeats."""
    most = factors * shard.list_most[lists]
    order = np.argsort(most, kind="stable")
    lists, factors, most = lists[order], factors[order], most[order]
    least = best.least()
    optional = int(np.searchsorted(np.cumsum(most), least, "left"))
    if optional == len(lists):
        return
    total = np.zeros(len(shard.sizes), np.int64)
    for i, factor in zip(lists[optional:].tolist(), factors[optional:].tolist(), strict=True):
        docs, gives = shard.unpack(int(shard.starts[i]), int(shard.ends[i]))
        total[docs] += factor * gives
    docs = np.flatnonzero(total)
    scores = total[docs]
    blocks, bounds = [], []
    for i, factor in zip(lists[:optional].tolist(), factors[:optional].tolist(), strict=True):
        a, b = int(shard.starts[i]), int(shard.ends[i])
        block = a + np.searchsorted(shard.last[a:b], docs)
        blocks.append(block)
        bounds.append(np.where(block < b, factor * shard.block_most[np.minimum(block, b - 1)], 0))
    rest = np.sum(bounds, axis=0) if bounds else np.zeros(len(docs), np.int64)
    left = np.flatnonzero(scores + rest >= least)
    for k in reversed(range(optional)):
        factor, block, bound = int(factors[k]), blocks[k], bounds[k]
        meets = left[bound[left] > 0]
        for one in np.unique(block[meets]).tolist():
            held, gives = shard.unpack(one, one + 1)
            here = meets[block[meets] == one]
            at = np.minimum(np.searchsorted(held, docs[here]), len(held) - 1)
            scores[here] += np.where(held[at] == docs[here], factor * gives[at], 0)
        rest = rest - bound
        left = left[scores[left] + rest[left] >= least]
    if len(left):
        best.add(scores[left], docs[left], shard.ids)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in [*_NUMBERS, "widths", *_STREAMS]}
            yield Shard(row, batch.column("ids")[i].values, batch.column("terms")[i].values)


def _statistics(index: DataFrame, queries: Queries) -> Corpus:
    sums = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    shipped = index.sparkSession.sparkContext.broadcast((queries.terms, queries.hashes))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, hashes = shipped.value
        found = np.zeros(len(terms), np.int64)
        for batch in batches:
            for i in range(batch.num_rows):
                known, sizes = (
                    np.frombuffer(batch.column(name)[i].as_py(), _NUMBERS[name]) for name in ("hashes", "lists")
                )
                shard = Shard.__new__(Shard)
                shard.hashes, shard.terms = known, batch.column("terms")[i].values
                at = shard.find(terms, hashes)
                found[at >= 0] += sizes[at[at >= 0]]
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(found[some])], ["term", "df"])

    counted = index.select("hashes", "lists", "terms").mapInArrow(held, "term bigint, df bigint")
    found_in = np.zeros(len(queries.terms), np.int64)
    # One row per term of the slice.
    for term, df in counted.groupBy("term").agg(F.sum("df")).collect():
        found_in[term] = df
    return Corpus(sums[0] or 0, sums[1] or 0, weights(found_in, sums[0] or 0))


def _slices(queries: DataFrame, id_column: str, text_column: str) -> Iterator[Queries]:
    size = F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0)).alias("n")
    passes = max(1, math.ceil(queries.agg(size).first()["n"] / QUERY_BYTES))
    rows = queries.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    for i in range(passes):
        some = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == i)
        yield Queries.of([(r["id"], r["text"]) for r in some.orderBy("id", "text").collect()])


def search(
    index: DataFrame,
    queries: DataFrame,
    k: int = 10,
    query_column: str = "item_id",
    query_text: str = "text",
    id_column: str = "doc_id",
) -> DataFrame:
    """The k best documents of each query: query id, rank, document id, score."""
    context = index.sparkSession.sparkContext
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    query_type = queries.schema[query_column].dataType.simpleString()
    result = None
    for part, some in enumerate(_slices(queries, query_column, query_text)):
        shipped = context.broadcast((some, _statistics(index, some)))

        def best_of_task(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            some, corpus = shipped.value
            best = [Best(k) for _ in some.ids]
            asked = [np.array(q, np.int64).reshape(-1, 2) for q in some.of_query]
            arrow_id = pa.null()
            for shard in _shards(batches):
                arrow_id = shard.ids.type
                shard.weigh(corpus.lengths)
                found = shard.find(some.terms, some.hashes)
                for query, top in zip(asked, best, strict=True):
                    lists = found[query[:, 0]]
                    has = lists >= 0
                    if has.any():
                        factors = corpus.term_weights[query[has, 0]] * query[has, 1]
                        run_query(shard, lists[has], factors, top)
            rows = [(q, *row) for q, top in enumerate(best) for row in top.found()]
            if rows:
                number, ids, scores = zip(*rows, strict=True)
                arrays = [
                    pa.array(number, pa.int64()),
                    pa.array([some.ids[q] for q in number]),
                    pa.array(ids, arrow_id),
                    pa.array(scores, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, ["query", "query_id", "id", "score"])

        schema = f"query bigint, query_id {query_type}, id {id_type}, score bigint"
        found = index.drop("n_docs", "n_words").mapInArrow(best_of_task, schema)
        found = found.withColumn("slice", F.lit(part))
        result = found if result is None else result.unionByName(found)
    order = Window.partitionBy("slice", "query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return (
        result.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select(
            F.col("query_id").alias(query_column),
            "rank",
            F.col("id").alias(id_column),
            "score",
        )
    )

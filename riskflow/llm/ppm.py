"""Language-model scores by prediction by partial matching, against a word unigram base.

The model is a trie of byte contexts of 0 to ``ORDER`` bytes with the counts of the
byte that followed, over the training documents.  A byte is predicted in its
longest context that has been seen.  A byte that did not follow there escapes to
the next shorter context with probability q / (n + q), for n bytes of q different
kinds seen; the q kinds are then excluded from all shorter contexts.  Behind the
empty context all bytes not excluded are equally likely.  A text is its words in
lower case (A-Z) with one space between and a line feed as the end; it starts in
the context of an end.

The trie is never in one place.  Its longest paths, strings of ``ORDER`` + 1 bytes
with counts, are a table.  All paths whose contexts end in the same two bytes are
one group, of at most 256 ** (ORDER - 1) rows, which holds all that is needed for
their probabilities but the counts of contexts of one and no byte, and those are
65,536 numbers at most.  Documents are gathered in blocks of about ``BLOCK``
characters; a block asks for the strings and words that it has, once each, and is
scored where it meets the answers.  Words are joined by a 64-bit hash.

Defined cases: a null or empty text has the end as its only token; without
training documents every byte has probability 1/256 and the base is that of an
empty vocabulary; rows that repeat an id are scored and counted each; null ids are
carried along; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import HashIndex, WordIds, chunks, written

ORDER = 4
#: Characters of a block.
BLOCK = 16 << 20
#: Added to every count of the base.
PSEUDO = 0.1
_END = b"\n"
_DOCS, _WORDS, _STRINGS = 0, 1, 2


def normalise(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def strings_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ORDER + 1 bytes that end at each byte of each text, as numbers; and where each text starts.

    A text here has its words joined, and its end is put on.
    """
    raw = np.frombuffer(b"".join(_END * ORDER + t + _END for t in texts), np.uint8).astype(np.int64)
    code = np.zeros(len(raw) - ORDER, np.int64)
    for k in range(ORDER + 1):
        code = (code << 8) | raw[k : k + len(code)]
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes + ORDER)
    inside = np.ones(len(raw), bool)
    for k in range(1, ORDER + 1):
        inside[ends - k] = False
    return code[inside[: len(code)]], np.cumsum(sizes) - sizes


def string_scores(
    strings: np.ndarray, counts: np.ndarray, order_1: np.ndarray
) -> np.ndarray:
    """log10 probability of the last byte of each string after the others.

    ``strings`` are distinct, their contexts end in the same two bytes, and all
    that have a count are there.  ``order_1[x, a]`` counts byte a after byte x.
    """
    order_0 = order_1.sum(0)
    byte, before = strings & 255, (strings >> 8) & 255
    score, open_ = np.zeros(len(strings)), np.ones(len(strings), bool)
    # Of the next longer context of each string: kinds seen, and how often those followed the shorter one.
    longer_kinds = np.zeros(len(strings))
    paths, path_counts, seen_paths = None, None, None

    def step(count: np.ndarray, total: np.ndarray, kinds: np.ndarray) -> None:
        """Predict in a context, or escape from it; totals and kinds are those not excluded."""
        here = open_ & (kinds > 0)
        hit = here & (count > 0)
        miss = here & ~hit
        score[hit] += np.log10(count[hit] / (total[hit] + kinds[hit]))
        score[miss] += np.log10(kinds[miss] / (total[miss] + kinds[miss]))
        open_[hit] = False

    for order in range(ORDER, 1, -1):
        # Paths of this order: the last ``order`` bytes of the context and the byte.
        own = strings & ((1 << (8 * (order + 1))) - 1)
        values, path_of = np.unique(own, return_inverse=True)
        count = np.bincount(path_of, counts, len(values))
        contexts, context_of_path = np.unique(values >> 8, return_inverse=True)
        total = np.bincount(context_of_path, count, len(contexts))
        kinds = np.bincount(context_of_path, count > 0, len(contexts))
        excluded = np.zeros(len(strings))
        if paths is not None:
            # Sum over the kinds of the longer context, then look it up for each string.
            lower = np.searchsorted(values, paths & ((1 << (8 * (order + 1))) - 1))
            longer, longer_of = np.unique(paths >> 8, return_inverse=True)
            sums = np.bincount(longer_of, seen_paths * count[lower], len(longer))
            excluded = sums[np.searchsorted(longer, (strings >> 8) & ((1 << (8 * (order + 1))) - 1))]
        context = context_of_path[path_of]
        step(count[path_of], total[context] - excluded, kinds[context] - longer_kinds)
        longer_kinds = kinds[context].astype(float)
        paths, path_counts, seen_paths = values, count, (count > 0).astype(float)

    if not len(strings):
        return score
    row = order_1[before[0]]
    seen_2 = paths[path_counts > 0] & 255
    step(
        row[byte].astype(float),
        np.full(len(strings), float(row.sum() - row[seen_2].sum())),
        (row > 0).sum() - longer_kinds,
    )
    seen_1 = row > 0
    step(
        order_0[byte].astype(float),
        np.full(len(strings), float(order_0.sum() - order_0[seen_1].sum())),
        np.full(len(strings), float((order_0 > 0).sum() - seen_1.sum())),
    )
    score[open_] -= np.log10(256 - (order_0 > 0).sum()) if (order_0 == 0).any() else 0
    return score


def word_key(word: bytes) -> int:
    """64-bit hash as a signed number."""
    return xxhash.xxh3_64_intdigest(word) - (1 << 63)


class _Block:
    """Documents gathered in a task, with the counts of their words and strings."""

    def __init__(self) -> None:
        self.packs: list[tuple[int, bytes]] = []
        self.words, self.word_counts = WordIds(), np.zeros(0, np.int64)
        self.strings: list[np.ndarray] = []
        self.string_counts: list[np.ndarray] = []
        self.size = 0

    def add(self, ids: pa.Array, trains: pa.Array, texts: list[str | None]) -> None:
        cut = [normalise(t) for t in texts]
        joined = [b" ".join(words) for words in cut]
        learns = np.array(trains.to_pylist(), bool)
        numbers = np.fromiter(
            (self.words[w] for words in cut for w in words), np.int64, sum(map(len, cut))
        )
        counts = np.bincount(numbers[np.repeat(learns, [len(w) for w in cut])], minlength=len(self.words))
        counts[: len(self.word_counts)] += self.word_counts
        self.word_counts = counts
        strings, starts = strings_of(joined)
        sizes = np.diff(np.append(starts, len(strings)))
        tagged, n = np.unique(strings << 1 | np.repeat(learns, sizes), return_counts=True)
        self.strings.append(tagged >> 1)
        self.string_counts.append(np.where(tagged & 1, n, 0))
        table = pa.table({"id": ids, "trains": trains, "text": pa.array(joined, pa.binary())})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_table(table)
        self.packs.append((int(learns.sum()), sink.getvalue().to_pybytes()))
        self.size += sum(map(len, joined))

    def rows(self, number: int) -> Iterator[pa.RecordBatch]:
        """(kind, block, key, n, body): packed documents, words, strings."""

        def batch(kind: int, keys: np.ndarray, n: np.ndarray, bodies: pa.Array | None = None) -> pa.RecordBatch:
            size = len(n)
            arrays = [
                pa.array(np.full(size, kind, np.int32)),
                pa.array(np.full(size, number, np.int64)),
                pa.array(keys.astype(np.int64)),
                pa.array(n.astype(np.int64)),
                pa.nulls(size, pa.binary()) if bodies is None else bodies,
            ]
            return pa.RecordBatch.from_arrays(arrays, ["kind", "block", "key", "n", "body"])

        for n, body in self.packs:
            yield batch(_DOCS, np.zeros(1), np.array([n]), pa.array([body], pa.binary()))
        keys = np.fromiter(map(word_key, self.words), np.int64, len(self.words))
        yield batch(_WORDS, keys, self.word_counts)
        strings, place = np.unique(np.concatenate(self.strings), return_inverse=True)
        counts = np.bincount(place, np.concatenate(self.string_counts), len(strings))
        yield batch(_STRINGS, strings, counts)


def gather(docs: DataFrame, id_column: str, text_column: str, trains: Column) -> DataFrame:
    """The blocks of all documents as a table with one folder per kind of row."""

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made, block = TaskContext.get().taskAttemptId() << 24, 0, _Block()
        for batch in batches:
            texts = batch.column(2).to_pylist()
            for some in chunks(texts, 1 << 21):
                block.add(batch.column(0)[some], batch.column(1)[some], texts[some])
                if block.size >= BLOCK:
                    yield from block.rows(first + made)
                    made, block = made + 1, _Block()
        if block.packs:
            yield from block.rows(first + made)

    chosen = docs.select(id_column, trains.alias("trains"), text_column)
    rows = chosen.mapInArrow(gathered, "kind int, block bigint, key bigint, n bigint, body binary")
    return written(rows, "ppm-blocks", partition_by="kind")


def _string_table(strings: DataFrame) -> DataFrame:
    """(key, value): each string and its score."""
    counted = written(strings.groupBy("key").agg(F.sum("n").alias("n")), "ppm-strings")
    pairs = counted.groupBy(F.expr("CAST(key & 65535L AS INT)").alias("pair")).agg(F.sum("n").alias("n"))
    order_1 = np.zeros(1 << 16, np.int64)
    for row in pairs.where("n > 0").collect():  # at most 65,536 rows
        order_1[row["pair"]] = row["n"]
    shipped = strings.sparkSession.sparkContext.broadcast(order_1.reshape(256, 256))

    def scored(group: pa.Table) -> pa.Table:
        keys, n = group.column("key").to_numpy(), group.column("n").to_numpy()
        return pa.table({"key": keys, "value": string_scores(keys, n.astype(float), shipped.value)})

    ending = F.expr("(key >> 8) & 65535L").alias("ending")
    return counted.select(ending, "key", "n").groupBy("ending").applyInArrow(scored, "key bigint, value double")


def _score_block(id_column: str, packs: pa.Table, answers: pa.Table) -> pa.Table:
    kind, key = answers.column("kind").to_numpy(), answers.column("key").to_numpy()
    value = answers.column("value").to_numpy()
    is_word = kind == _WORDS
    words, counts = HashIndex(key[is_word]), value[is_word]
    strings, scores = HashIndex(key[~is_word]), value[~is_word]
    log_counts = np.log10(counts + PSEUDO)
    parts = []
    for body in packs.column("body"):
        table = pa.ipc.open_stream(body.as_py()).read_all()
        texts = table.column("text").to_pylist()
        cut = [t.split() for t in texts]
        sizes = np.array([len(w) for w in cut], np.int64)
        own = WordIds()
        numbers = np.fromiter((own[w] for words in cut for w in words), np.int64, sizes.sum())
        found = words.find(np.fromiter(map(word_key, own), np.int64, len(own)))[numbers]
        of = np.repeat(np.arange(len(texts)), sizes)
        codes, starts = strings_of(texts)
        parts.append(
            pa.table(
                {
                    id_column: table.column("id"),
                    "held_out": pa.array(~np.array(table.column("trains").to_pylist(), bool)),
                    "n_words": pa.array(sizes),
                    "n_seen": pa.array(np.bincount(of, counts[found] > 0, len(texts)).astype(np.int64)),
                    "logs": pa.array(np.bincount(of, log_counts[found], len(texts)).astype(float)),
                    "score": pa.array(np.add.reduceat(scores[strings.find(codes)], starts)),
                }
            )
        )
    return pa.concat_tables(parts)


def score_documents(
    docs: DataFrame, trains: Column, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    rows = gather(docs, id_column, text_column, trains)
    packs = rows.where(F.col("kind") == _DOCS).select("block", "n", "body")
    words = rows.where(F.col("kind") == _WORDS).select("block", "key", "n")
    strings = rows.where(F.col("kind") == _STRINGS).select("block", "key", "n")

    # A word or string has one row per block that has it.  A common one is in all blocks, but
    # meets one row, so a join needs no memory for it and adaptive execution can split it.
    counted = written(words.groupBy("key").agg(F.sum("n").cast("double").alias("value")), "ppm-words")
    word_answers = (
        words.select("block", "key")
        .hint("merge")
        .join(counted, "key")
        .select("block", F.lit(_WORDS).alias("kind"), "key", "value")
    )
    string_answers = (
        strings.select("block", "key")
        .hint("merge")
        .join(_string_table(strings), "key")
        .select("block", F.lit(_STRINGS).alias("kind"), "key", "value")
    )
    answers = word_answers.unionByName(string_answers)

    id_type = docs.schema[id_column].dataType.simpleString()
    scored = written(
        packs.withColumnRenamed("block", "doc_block")
        .groupBy("doc_block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(
            lambda left, right: _score_block(id_column, left, right),
            f"`{id_column}` {id_type}, held_out boolean, n_words bigint, n_seen bigint, logs double, "
            "score double",
        ),
        "ppm-scored",
    )
    zero = F.lit(0).cast("long")
    ends = packs.agg(F.coalesce(F.sum("n"), zero)).first()[0]
    n = words.agg(F.coalesce(F.sum("n"), zero)).first()[0] + ends
    distinct = counted.where("value > 0").count() + (ends > 0)
    scale = float(np.log10(n + PSEUDO * (distinct + 1)))
    end_log = float(np.log10(ends + PSEUDO))
    tokens = F.col("n_words") + 1
    return scored.select(
        F.col(id_column),
        "held_out",
        tokens.alias("n_tokens"),
        (F.col("n_seen") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("logs") + F.lit(end_log) - tokens * F.lit(scale)).alias("base_score"),
        "score",
    )

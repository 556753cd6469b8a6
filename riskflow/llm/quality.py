"""Quality classifier from weak labels.

Overlapping heuristic labellers each call a document good (1), junk (0) or give
no opinion.  Expectation maximisation over the counts of all vote patterns of the
corpus estimates how often each labeller is right, which turns a pattern into the
posterior probability that the document is good.  These posteriors, not gold
labels, train a linear scorer over hashed features on ``SAMPLE`` documents, the
ones with the smallest hash of their id.  The scorer judges every whole document.

The vote patterns are at most 3 ** (number of labellers) rows, whatever the size
of the corpus; the model is ``2 ** BITS`` weights.

Defined cases: a text that is null or has no word scores 0 and is not kept; a
corpus of one kind of document only is judged by the scorer's bias; repeated rows
are judged each; a null id is judged like any other; other columns are ignored.
Scripts without spaces count in pieces of two characters.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Spacing, give_back, text_chunks

#: Documents that train the scorer, at most.
SAMPLE = 8000
BITS = 14
#: Documents of a lower score are rejected.
THRESHOLD = 0.5
GOOD, JUNK, SILENT = 1, 0, 2

# Byte classes that the labellers count.
MARKUP = b"#%&$*|!=<>{}[]~^_`@+/\\"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = b"abcdefghijklmnopqrstuvwxyz"
STOPS = b".?!"
DIGITS = b"0123456789"

#: Words whose distinct share is taken together: the share of a whole text falls with its length.
WINDOW = 64
PIECES = Spacing(2)


def _count(raw: bytes, members: bytes) -> int:
    return len(raw) - len(raw.translate(None, members))


@dataclass(frozen=True)
class Facts:
    """What the labellers and the features look at, from the whole text."""

    words: list[bytes]
    markup: float
    odd: float
    upper: float
    loud: float
    repeats: float
    distinct: float
    lines: float
    length: float

    @classmethod
    def of(cls, text: str | None) -> Facts:
        raw = (text or "").encode()
        words = PIECES(text or "").encode().split()
        size, n = max(1, len(raw)), max(1, len(words))
        upper, lower = _count(raw, UPPER), _count(raw, LOWER)
        lines = [line for line in raw.split(b"\n") if line.strip()]
        windows = [words[i : i + WINDOW] for i in range(0, len(words), WINDOW)]
        return cls(
            words=words,
            markup=_count(raw, MARKUP) / size,
            odd=sum(not w[-1:].translate(None, MARKUP) for w in words) / n,
            upper=upper / max(1, upper + lower),
            loud=raw.count(b"!") / n,
            repeats=sum(map(bytes.__eq__, words, words[1:])) / n,
            distinct=sum(len(set(w)) for w in windows) / n,
            lines=1 - len(set(lines)) / max(1, len(lines)),
            length=len(raw) / n,
        )

    def values(self) -> tuple[float, ...]:
        """All between 0 and 1."""
        length = min(1.0, self.length / 40)
        shares = (self.markup, self.odd, self.upper, min(1.0, self.loud), self.repeats)
        return (*shares, self.distinct, self.lines, length)


def _rising(value: float, good_to: float, junk_from: float) -> int:
    """A fault that shows in a high value."""
    return JUNK if value >= junk_from else GOOD if value <= good_to else SILENT


LABELLERS: tuple[Callable[[Facts], int], ...] = (
    lambda f: _rising(f.markup, 0.01, 0.03),
    lambda f: _rising(f.odd, 0.03, 0.15),
    lambda f: _rising(f.upper, 0.2, 0.5),
    lambda f: _rising(f.loud, 0.1, 0.5),
    lambda f: _rising(f.repeats, 0.05, 0.2),
    lambda f: _rising(1 - f.distinct, 0.35, 0.6),
    lambda f: _rising(f.lines, 0.2, 0.6),
    lambda f: _rising(f.length, 15.0, 40.0),
)


def vote_pattern(facts: Facts) -> int:
    """All votes as the digits of one number to the base 3."""
    return sum(label(facts) * 3**i for i, label in enumerate(LABELLERS))


def _votes(patterns: np.ndarray) -> np.ndarray:
    return patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3


def label_model(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior probability of a good document for each pattern, by expectation maximisation.

    For either class a labeller that speaks has a probability to call it junk,
    independent of the others given the class; silence says nothing.  The start
    takes any call of junk for true, which gives the classes their meaning: the
    faults are rare and of several kinds, so most labellers approve of a junk
    document, too.
    """
    if not len(patterns):
        return np.zeros(0)
    votes = _votes(patterns)
    junk, spoke = (votes == JUNK).astype(float), (votes != SILENT).astype(float)
    posterior = np.where(junk.any(1), 0.1, np.where(spoke.any(1), 0.9, 0.5))
    for _ in range(rounds):
        log_odds = np.zeros((len(patterns), 2))
        for k, weight in enumerate((1 - posterior, posterior)):
            weight = weight * counts
            calls = (weight @ junk + 0.01) / (weight @ spoke + 1)
            prior = (weight.sum() + 1) / (counts.sum() + 2)
            spoken = junk * np.log(calls) + (spoke - junk) * np.log1p(-calls)
            log_odds[:, k] = np.log(prior) + spoken.sum(1)
        new = 1 / (1 + np.exp(np.clip(log_odds[:, 0] - log_odds[:, 1], -50, 50)))
        moved, posterior = np.abs(new - posterior).max(), new
        if moved < 1e-9:
            break
    return posterior


_SHAPE = bytes.maketrans(
    UPPER + LOWER + DIGITS + bytes(range(128, 256)),
    b"A" * len(UPPER) + b"a" * len(LOWER) + b"0" * len(DIGITS) + b"a" * 128,
)


class ShapeIds(dict):
    """Hashed number of a word's shape: its character classes, runs as one."""

    def __missing__(self, word: bytes) -> int:
        shape = word.translate(_SHAPE)
        runs = bytes(c for i, c in enumerate(shape) if not i or c != shape[i - 1])
        number = zlib.crc32(runs) >> (32 - BITS)
        if len(self) < 200_000:
            self[word] = number
        return number


def features(facts: Facts, ids: ShapeIds) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of a text and their values: shares of word shapes, and levels of the facts."""
    shapes = np.fromiter(map(ids.__getitem__, facts.words), np.int64, len(facts.words))
    numbers, counts = np.unique(shapes, return_counts=True)
    levels = [
        zlib.crc32(b"%d:%d" % (i, round(8 * v**0.5))) >> (32 - BITS)
        for i, v in enumerate(facts.values())
    ]
    values = np.sqrt(counts / max(1, len(shapes)))
    return np.concatenate([numbers, levels]), np.concatenate([values, np.full(len(levels), 0.5)])


def train_scorer(
    rows: list[tuple[np.ndarray, np.ndarray]], targets: np.ndarray, rounds: int = 400
) -> np.ndarray:
    """Weights of a logistic scorer for soft targets; the last one is the bias."""
    size = 1 << BITS
    weights = np.zeros(size + 1)
    if not rows:
        return weights
    row = np.repeat(np.arange(len(rows)), [len(n) for n, _ in rows])
    column = np.concatenate([n for n, _ in rows])
    value = np.concatenate([v for _, v in rows])
    # Both classes weigh the same, however rare one is.
    share = np.clip(targets.mean(), 1e-3, 1 - 1e-3)
    importance = targets / share + (1 - targets) / (1 - share)
    momentum = np.zeros_like(weights)
    for _ in range(rounds):
        z = np.bincount(row, value * weights[column], len(rows)) + weights[-1]
        error = (1 / (1 + np.exp(-z)) - targets) * importance / len(rows)
        gradient = np.append(np.bincount(column, value * error[row], size), error.sum())
        gradient[:-1] += 1e-5 * weights[:-1]
        momentum = 0.9 * momentum + gradient
        weights = weights - 2.0 * momentum
    return weights


@dataclass(frozen=True)
class QualityModel:
    posterior: dict[int, float]
    weights: np.ndarray


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> QualityModel:
    """Label model over all documents, scorer on the bounded sample of their posteriors."""

    def patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vote_pattern(Facts.of(t)) for t in batch.column(0).to_pylist()]
            values, counts = np.unique(np.array(found, np.int64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(counts)], ["pattern", "n"])

    # At most 3 ** len(LABELLERS) rows.
    counted = (
        docs.select(text_column)
        .mapInArrow(patterns, "pattern bigint, n bigint")
        .groupBy("pattern")
        .agg(F.sum("n").alias("n"))
        .orderBy("pattern")
        .collect()
    )
    seen = np.array([r["pattern"] for r in counted], np.int64)
    posterior = label_model(seen, np.array([r["n"] for r in counted], float))
    by_pattern = dict(zip(seen.tolist(), posterior.tolist(), strict=True))

    def featurised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = ShapeIds()
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                facts = Facts.of(text)
                numbers, values = features(facts, ids)
                rows.append((by_pattern[vote_pattern(facts)], numbers.tolist(), values.tolist()))
            targets, numbers, values = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(targets, pa.float64()),
                    pa.array(numbers, pa.list_(pa.int64())),
                    pa.array(values, pa.list_(pa.float64())),
                ],
                ["place", "target", "numbers", "values"],
            )

    place = F.xxhash64(id_column)
    # The rows with the smallest hashes: each task keeps SAMPLE of them, and only hashes move.
    bound = docs.select(place.alias("place")).orderBy("place").limit(SAMPLE).agg(F.max("place")).first()[0]
    sample = (
        docs.select(place.alias("place"), text_column)
        .where(F.col("place") <= F.lit(bound))
        .mapInArrow(featurised, "place bigint, target double, numbers array<bigint>, values array<double>")
        .orderBy("place", "target")
        .limit(SAMPLE)
        .collect()
    )
    rows = [(np.array(r["numbers"], np.int64), np.array(r["values"])) for r in sample]
    return QualityModel(by_pattern, train_scorer(rows, np.array([r["target"] for r in sample])))


class Judge:
    """Scores texts in a task."""

    def __init__(self, model: QualityModel):
        self.model, self.ids = model, ShapeIds()

    def __call__(self, text: str | None) -> tuple[float, float]:
        """Score, and posterior of the weak label."""
        facts = Facts.of(text)
        if not facts.words:
            return 0.0, self.model.posterior.get(vote_pattern(facts), 0.5)
        numbers, values = features(facts, self.ids)
        z = float(self.model.weights[numbers] @ values + self.model.weights[-1])
        score = float(1 / (1 + np.exp(-np.clip(z, -50, 50))))
        return score, self.model.posterior.get(vote_pattern(facts), 0.5)


def score(
    docs: DataFrame, model: QualityModel, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: id, score, kept, and the weak label's posterior."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            judged = [judge(text) for text in batch.column(1).to_pylist()]
            scores = pa.array([s for s, _ in judged], pa.float64())
            kept = pa.array([s >= THRESHOLD for s, _ in judged], pa.bool_())
            labels = pa.array([p for _, p in judged], pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), scores, kept, labels], [id_column, "score", "kept", "weak_label"]
            )

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        scored, f"`{id_column}` {id_type}, score double, kept boolean, weak_label double"
    )


def drop_junk(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents that are kept, with all their columns, judged row by row without a shuffle."""
    model = fit(docs, id_column, text_column)

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(model)
        for batch in batches:
            parts = text_chunks(batch.column(text_column))
            keep = [judge(t)[0] >= THRESHOLD for _, texts in parts for t in texts]
            yield batch.filter(pa.array(keep, pa.bool_()))
            del batch
        del judge
        give_back()

    return docs.mapInArrow(filtered, docs.schema)

"""Benchmark passages in documents, also edited ones.

Texts are sequences of words in lower case, parted by ASCII white space.  The CGK walk embeds a sequence:
at step j it puts out the word under its pointer and then moves on or stays, by a
random bit for that step and word.  Two sequences that walk with the same bits
fall into step again after an edit, so a small edit distance becomes a small
Hamming distance.  Sampling a few coordinates of the embedding is therefore a
locality-sensitive hash of edit distance.  Long walks part for good, so the
coordinates of a repetition lie in a short stretch from a random place, the anchor,
of the items, and never past the end of an item: every key is one that a copy has.

Every word of a document starts a walk for each class of items, as if it were the
anchor.  A walk goes on only while its sampled words so far begin the key of some
item; where it completes a key, the text around, shifted back by the anchor, is
compared with that item by exact edit distance.  Repetitions are added, without a
limit, until fresh simulated copies with ``EDITS`` of the words edited are found
with probability ``RECALL``; unedited copies always are.  Items of less than
``MIN_WORDS`` words are looked up whole, without edits.

The items are the query set: slices of at most ``BENCHMARK_BYTES`` are shipped to
the tasks, one pass over the documents for each slice.

Each character of a script without spaces is a word of its own.

Defined cases: a null or empty text contains nothing, and such an item is nowhere; a
single word, though found, is no passage for which a document is dropped; an item that is there
several times gives the place of the smallest distance, the first one of equals;
repeated rows and repeated items are reported each; null ids are carried along;
other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import Spacing, chunks, give_back, text_chunks

#: Share of an item's words that may be edited.
EDITS = 0.15
RECALL = 0.97
#: Shorter items must be there as they are.
MIN_WORDS = 5
#: Words sampled for a key, and steps of the stretch they are sampled from at most.
SAMPLED, STRETCH = 3, 24
#: Simulated copies of a class at least, and of each item.
TRIALS, TRIALS_EACH = 2000, 4
#: Items of a class differ in length by less than this factor.
CLASS_FACTOR = 1.5
BENCHMARK_BYTES = 32 << 20
_OUTSIDE, _BREAK = 0, -1
CHARACTERS = Spacing(1)


def words_of(text: str | None) -> list[bytes]:
    return CHARACTERS(text or "").lower().encode().split()


def allowed_edits(n_words: int) -> int:
    return math.floor(EDITS * n_words)


def _bit(step: tuple[np.uint64, np.uint64], words: np.ndarray) -> np.ndarray:
    """The random bit of a step for each word."""
    mixed = (words.astype(np.uint64) + step[0]) * step[1]
    return ((mixed ^ (mixed >> np.uint64(29))) >> np.uint64(40) & np.uint64(1)).astype(np.int64)


def _mix(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    mixed = (keys.astype(np.uint64) ^ words.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed ^ (mixed >> np.uint64(31))).astype(np.int64)


def _is_in(sorted_values: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return sorted_values[at] == values


@dataclass
class Repeat:
    """One walk from the anchor and the coordinates sampled from it, with the keys of the items of a class."""

    anchor: int
    steps: list[tuple[np.uint64, np.uint64]]
    sampled: list[int]
    keys: np.ndarray | None = None
    begun: list[np.ndarray] = field(default_factory=list)
    items_of: dict[int, list[int]] = field(default_factory=dict)

    def walk(self, words: np.ndarray, starts: np.ndarray, filtered: bool) -> tuple[np.ndarray, np.ndarray]:
        """Starts that are left, and their keys."""
        place, keys, taken = starts.copy(), np.zeros(len(starts), np.int64), 0
        for j, step in enumerate(self.steps):
            seen = words[place]
            if j == self.sampled[taken]:
                keys = _mix(keys, seen)
                if filtered:
                    left = np.flatnonzero((seen > 0) & _is_in(self.begun[taken], keys))
                    starts, place, keys, seen = starts[left], place[left], keys[left], seen[left]
                taken += 1
                if taken == len(self.sampled) or not len(starts):
                    break
            place += _bit(step, seen) * (seen != _BREAK)
        return starts, keys

    def learn(self, words: np.ndarray, starts: np.ndarray, items: list[int]) -> None:
        """Note the keys of the items, whole and begun."""
        sampled = self.sampled
        for n in range(1, len(sampled) + 1):
            self.sampled = sampled[:n]
            _, self.keys = self.walk(words, starts + self.anchor, filtered=False)
            self.begun.append(np.unique(self.keys))
        self.sampled = sampled
        for item, key in zip(items, self.keys.tolist(), strict=True):
            self.items_of.setdefault(key, []).append(item)


def _laid_out(texts: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All words in a row, a break after each text; and where each text starts."""
    flat, starts = [], []
    for text in texts:
        starts.append(len(flat))
        flat.extend(text)
        flat.append(_BREAK)
    return np.array(flat, np.int64), np.array(starts, np.int64)


def _edited(words: list[int], edits: int, rng: np.random.Generator) -> tuple[list[int], list[float]]:
    """A copy with random substitutions, insertions and deletions; and where its words were."""
    words, were = list(words), [float(i) for i in range(len(words))]
    for share, kind in zip(rng.random(edits).tolist(), rng.integers(3, size=edits).tolist(), strict=True):
        at = int(share * len(words))
        if kind == 0:
            words[at] = _OUTSIDE
        elif kind == 1:
            words.insert(at, _OUTSIDE)
            were.insert(at, were[at] - 0.5)
        elif len(words) > 1:
            del words[at], were[at]
    return words, were


@dataclass
class Trials:
    """Edited copies of the items of a class, each ``of`` the member of that position."""

    of: np.ndarray
    words: np.ndarray
    starts: np.ndarray
    were: list[list[float]]

    @classmethod
    def draw(cls, members: list[int], items: list[list[int]], rng: np.random.Generator) -> Trials:
        each = max(TRIALS_EACH, math.ceil(TRIALS / len(members)))
        of = np.repeat(np.arange(len(members)), each)
        drawn = [_edited(items[members[k]], allowed_edits(len(items[members[k]])), rng) for k in of.tolist()]
        return cls(of, *_laid_out([words for words, _ in drawn]), [were for _, were in drawn])

    def met(self, repeat: Repeat) -> np.ndarray:
        """Copies whose walk from the anchor has the key of their item."""
        shifts = np.array([bisect_left(were, repeat.anchor) for were in self.were], np.int64)
        _, keys = repeat.walk(self.words, self.starts + shifts, filtered=False)
        return keys == repeat.keys[self.of]


@dataclass
class SizeClass:
    """Items of about one length, and the repetitions that find them."""

    least: int
    most_edits: int
    items: list[int]
    repeats: list[Repeat]


@dataclass
class Benchmark:
    ids: list
    words: dict[bytes, int]
    items: list[np.ndarray]
    classes: list[SizeClass]
    #: Short items: by length, the items of each sequence of words.
    short: dict[int, dict[tuple[int, ...], list[int]]]

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]], seed: int = 7, least_words: int = 1) -> Benchmark:
        """Items of at least ``least_words`` words."""
        ids, items, words = [], [], {}
        for item_id, text in rows:
            found = words_of(text)
            if len(found) >= least_words:
                ids.append(item_id)
                items.append([words.setdefault(w, len(words) + 1) for w in found])
        by_class: dict[int, list[int]] = {}
        short: dict[int, dict[tuple[int, ...], list[int]]] = {}
        for i, item in enumerate(items):
            if len(item) < MIN_WORDS:
                short.setdefault(len(item), {}).setdefault(tuple(item), []).append(i)
                continue
            by_class.setdefault(int(math.log(len(item), CLASS_FACTOR)), []).append(i)
        rng = np.random.default_rng(seed)
        classes = [_size_class(members, items, rng) for _, members in sorted(by_class.items())]
        return cls(ids, words, [np.array(i, np.int64) for i in items], classes, short)

    def _short_matches(self, words: np.ndarray) -> Iterator[tuple[int, int]]:
        """(item, place) of all short items."""
        for n, items in self.short.items():
            if len(words) < n:
                continue
            places = np.arange(len(words) - n + 1)
            for step, known in enumerate(zip(*items, strict=True)):
                places = places[np.isin(words[places + step], list(set(known)))]
            for place in places.tolist():
                for item in items.get(tuple(words[place : place + n].tolist()), ()):
                    yield item, place

    def matches(self, texts: list[str | None]) -> list[tuple[int, int, int, int]]:
        """(text, item, word at which it starts, edit distance), one for each text and item."""
        cut = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in cut], np.int64)
        if not self.items or not sizes.sum():
            return []
        get = self.words.get
        known = np.fromiter((get(w, _OUTSIDE) for words in cut for w in words), np.int64, sizes.sum())
        # A break after each text; the pointer stays on it.
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        words = np.full(int(sizes.sum() + len(sizes)), _BREAK, np.int64)
        text_of = np.repeat(np.arange(len(sizes)), sizes)
        words[np.arange(len(known)) + text_of] = known
        inside = np.concatenate([[0], np.cumsum(words > 0)])
        found: set[tuple[int, int, int]] = set()
        for group in self.classes:
            # Around an item's anchor are at most the edited words, and as many beyond its ends, that are foreign.
            known_before = np.pad(inside, group.least, mode="edge")
            enough = known_before[group.least :] - known_before[: -group.least] >= group.least - 2 * group.most_edits
            for repeat in group.repeats:
                shift = group.least - repeat.anchor
                starts = np.flatnonzero(enough[shift : shift + len(words)] & (words != _BREAK))
                at, keys = repeat.walk(words, starts, filtered=True)
                source = np.searchsorted(first, at, "right") - 1
                places = np.maximum(at - repeat.anchor, first[source])
                for text, place, key in zip(source.tolist(), places.tolist(), keys.tolist(), strict=True):
                    found.update((item, text, place) for item in repeat.items_of.get(key, ()))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for item, place in self._short_matches(words):
            text = int(np.searchsorted(first, place, "right")) - 1
            best.setdefault((text, item), (0, place - int(first[text])))
        for item, text, low, high in _merged(found, self.items):
            edits = allowed_edits(len(self.items[item]))
            a = max(int(first[text]), low - edits)
            b = min(int(first[text] + sizes[text]), high + len(self.items[item]) + edits)
            near = set(words[a:b].tolist())
            if sum(w in near for w in self.items[item].tolist()) < len(self.items[item]) - edits:
                continue  # more words are missing than may be edited
            distance, end = edit_distance(self.items[item], words[a:b])
            if distance <= edits:
                start = max(a, a + end - len(self.items[item])) - int(first[text])
                best[text, item] = min(best.get((text, item), (distance, start)), (distance, start))
        return sorted((text, item, start, d) for (text, item), (d, start) in best.items())


def _merged(
    found: set[tuple[int, int, int]], items: list[np.ndarray]
) -> Iterator[tuple[int, int, int, int]]:
    """Candidate places of an item in a text, neighbours less than half an item apart as one range."""
    item = text = low = high = None
    for i, t, place in sorted(found):
        if i == item and t == text and place - high <= len(items[i]) // 2:
            high = place
            continue
        if item is not None:
            yield item, text, low, high
        item, text, low, high = i, t, place, place
    if item is not None:
        yield item, text, low, high


def _draw_repeat(least: int, rng: np.random.Generator) -> Repeat:
    """A walk whose last sampled step, counted from the anchor, is inside items of ``least`` words."""
    reach = min(least, STRETCH)
    sampled = [0, *sorted((rng.choice(reach - 1, SAMPLED - 1, replace=False) + 1).tolist())]
    odd = rng.integers(1 << 62, size=(sampled[-1] + 1, 2), dtype=np.uint64)
    return Repeat(int(rng.integers(least - sampled[-1])), [(a, b | np.uint64(1)) for a, b in odd], sampled)


def _size_class(members: list[int], items: list[list[int]], rng: np.random.Generator) -> SizeClass:
    sizes = [len(items[i]) for i in members]
    least, most_edits = min(sizes), allowed_edits(max(sizes))
    words, starts = _laid_out([items[i] for i in members])
    repeats: list[Repeat] = []
    while True:
        # Copies that had no part in choosing the repetitions so far.
        trials = Trials.draw(members, items, rng)
        met = np.zeros(len(trials.of), bool)
        for repeat in repeats:
            met |= trials.met(repeat)
        if repeats and met.mean() >= RECALL:
            return SizeClass(least, most_edits, members, repeats)
        while not repeats or met.mean() < RECALL:
            repeats.append(_draw_repeat(least, rng))
            repeats[-1].learn(words, starts, members)
            met |= trials.met(repeats[-1])


def edit_distance(item: np.ndarray, words: np.ndarray) -> tuple[int, int]:
    """Least edit distance of the item to any stretch of the words, and where that ends."""
    steps = np.arange(len(words) + 1)
    row = np.zeros(len(words) + 1, np.int64)
    for i, word in enumerate(item, start=1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (words != word), row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
    end = int(row.argmin())
    return int(row[end]), end


def _slices(
    benchmark: DataFrame, item_column: str, text_column: str, least_words: int
) -> Iterator[Benchmark]:
    size = F.coalesce(F.sum(F.octet_length(text_column)), F.lit(0)).alias("n")
    passes = max(1, math.ceil(benchmark.agg(size).first()["n"] / BENCHMARK_BYTES))
    items = benchmark.select(F.col(item_column).alias("id"), F.col(text_column).alias("text"))
    for i in range(passes):
        some = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == i)
        rows = [(r["id"], r["text"]) for r in some.orderBy("id", "text").collect()]
        yield Benchmark.of(rows, least_words=least_words)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and item found in it: ids, start (word), distance, n_words."""
    names = [id_column, item_column, "start", "distance", "n_words"]
    item_type = benchmark.schema[item_column].dataType
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = f"`{id_column}` {id_type}, `{item_column}` {item_type.simpleString()}, start bigint, distance int, n_words int"
    result = None
    for part in _slices(benchmark, item_column, item_text, 1):
        shipped = docs.sparkSession.sparkContext.broadcast(part)

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            known = shipped.value
            for batch in batches:
                texts, rows = batch.column(1).to_pylist(), []
                for some in chunks(texts):
                    for text, item, start, distance in known.matches(texts[some]):
                        rows.append((some.start + text, known.ids[item], start, distance, len(known.items[item])))
                source, *columns = zip(*rows, strict=True) if rows else [()] * 5
                types = (None, pa.int64(), pa.int32(), pa.int32())
                found = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                taken = batch.column(0).take(pa.array(source, pa.int64()))
                if rows:
                    yield pa.RecordBatch.from_arrays([taken, *found], names)

        found = docs.select(id_column, text_column).mapInArrow(search, schema)
        result = found if result is None else result.unionByName(found)
    return result


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, text_column: str = "text", least_words: int = 2
) -> DataFrame:
    """The documents without any passage of ``least_words`` words or more, with all their columns, judged row by row without a shuffle."""
    for part in _slices(benchmark, "item_id", "text", least_words):
        shipped = docs.sparkSession.sparkContext.broadcast(part)

        def clean(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            give_back()  # of earlier stages
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for some, texts in text_chunks(batch.column(text_column)):
                    for text, *_ in shipped.value.matches(texts):
                        keep[some.start + text] = False
                yield batch.filter(pa.array(keep))
                del batch
            give_back()

        docs = docs.mapInArrow(clean, docs.schema)
    return docs

"""Language identification with a string kernel.

The kernel of two texts is the number of byte n-grams, n = 1 to ``MAX_N``, that
both contain (presence, not count, all lengths blended), over the n-grams of the
landmarks, normalised by the kernel of each text with itself.  ``LANDMARKS``
training texts per language are the landmarks; the Nyström map sends a text to the
span of them, and a one-versus-rest ridge regression is fitted there.  A batch of
texts is scored by two matrix products: presence with the landmarks' presence,
then the kernel rows with the weights.

The fit sees at most ``SAMPLE`` whole texts per language, those with the smallest
hash of their id; every document is scored.

Defined cases: a null text or one without a letter is ``und`` with score 0; a text
with letters but no known n-gram gets the commonest language of the sample; equal
scores go to the language that sorts first; without any labelled row all texts are
``und``; rows repeated are judged each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_N = 3
#: Training texts and landmarks of a language, at most.
SAMPLE, LANDMARKS = 200, 32
RIDGE = 1e-3
UNKNOWN = "und"
#: Texts in one matrix product.
BATCH = 128

_LETTER = regex.compile(r"\p{L}")
_PLAIN = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def prepared(text: str | None) -> bytes:
    """Lower-case UTF-8 with every ASCII character that is no letter as a space, ends marked."""
    return b" " + (text or "").lower().encode().translate(_PLAIN) + b" "


def _codes(raw: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that starts at each byte, as a number."""
    size = max(0, len(raw) - n + 1)
    code = np.zeros(size, np.int32)
    for k in range(n):
        code = (code << 8) | raw[k : k + size]
    return code


class Grams:
    """Numbers the n-grams of the landmarks; marks which of them texts contain."""

    def __init__(self, codes: list[np.ndarray]):
        self.size = sum(map(len, codes))
        self.tables, first = [], 0
        for n, known in enumerate(codes, start=1):
            table = np.full(1 << (8 * n), -1, np.int32)
            table[known] = np.arange(first, first + len(known))
            self.tables.append(table)
            first += len(known)

    def presence(self, texts: list[bytes]) -> np.ndarray:
        """One row per text, one column per n-gram, 1 where the text has it."""
        found = np.zeros((len(texts), self.size), np.float32)
        # A zero byte between texts keeps n-grams from spanning two of them.
        raw = np.frombuffer(b"\0".join(texts), np.uint8)
        row = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in texts])[: len(raw)]
        for n, table in enumerate(self.tables, start=1):
            number = table[_codes(raw, n)]
            known = np.flatnonzero(number >= 0)
            found[row[known], number[known]] = 1
        return found


def _known_codes(texts: list[bytes]) -> list[np.ndarray]:
    raw = np.frombuffer(b"\0".join(texts), np.uint8)
    known = []
    for n in range(1, MAX_N + 1):
        codes = np.unique(_codes(raw, n))
        spans = np.zeros(len(codes), bool)
        for k in range(n):
            spans |= (codes >> (8 * k)) & 255 == 0
        known.append(codes[~spans])
    return known


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    codes: list[np.ndarray]
    landmarks: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def scores(self, grams: Grams, texts: list[bytes]) -> np.ndarray:
        return _kernel(grams.presence(texts), self.landmarks) @ self.weights + self.offset


def _kernel(presence: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel of each text with each landmark; ``landmarks`` is normalised already."""
    own = np.sqrt(np.maximum(presence.sum(1, keepdims=True), 1))
    return (presence @ landmarks) / own


def fit_rows(rows: list[tuple[str, str]]) -> LanguageModel | None:
    """Fit on (language, text), the rows of a language in order of preference as landmarks."""
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    texts = [prepared(text) for _, text in rows]
    seen: dict[str, int] = {}
    chosen = []
    for i, (lang, _) in enumerate(rows):
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= LANDMARKS:
            chosen.append(i)
    codes = _known_codes([texts[i] for i in chosen])
    grams = Grams(codes)
    presence = grams.presence([texts[i] for i in chosen])
    landmarks = (presence / np.sqrt(np.maximum(presence.sum(1, keepdims=True), 1))).T
    kernel = np.concatenate(
        [_kernel(grams.presence(texts[i : i + BATCH]), landmarks) for i in range(0, len(texts), BATCH)]
    ).astype(float)
    # Nyström: the inverse square root of the landmarks' own kernel.
    values, vectors = np.linalg.eigh((landmarks.T @ landmarks).astype(float))
    good = values > 1e-6 * values.max()
    root = vectors[:, good] / np.sqrt(values[good])
    mapped = kernel @ root
    target = np.array([[1.0 if lang == of else -1.0 for of in languages] for lang, _ in rows])
    offset = target.mean(0)
    normal = mapped.T @ mapped + RIDGE * len(rows) * np.eye(mapped.shape[1])
    weights = root @ np.linalg.solve(normal, mapped.T @ (target - offset))
    return LanguageModel(languages, codes, landmarks.astype(np.float32), weights.astype(np.float32), offset)


def fit(
    docs: DataFrame,
    usable: Column,
    id_column: str = "doc_id",
    text_column: str = "text",
    lang_column: str = "lang",
) -> LanguageModel | None:
    """Fit on the sample of the rows where ``usable`` holds and the language is known."""
    known = docs.where(usable & F.col(lang_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(lang_column).alias("lang"), F.col(text_column).alias("text")
    )
    first = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    # Each task keeps SAMPLE rows of a language before anything is shuffled.
    picked = (
        known.select(F.col("id").alias("picked"), F.col("lang").alias("of"), F.row_number().over(first).alias("rank"))
        .where(F.col("rank") <= SAMPLE)
    )
    same = F.col("id").eqNullSafe(F.col("picked")) & (F.col("lang") == F.col("of"))
    # At most SAMPLE texts of each language.
    rows = (
        known.join(F.broadcast(picked), same)
        .select("lang", "text", "rank")
        .dropDuplicates(["lang", "rank"])
        .orderBy("lang", "rank")
        .collect()
    )
    return fit_rows([(r["lang"], r["text"]) for r in rows if _LETTER.search(r["text"])])


def identify(
    docs: DataFrame,
    model: LanguageModel | None,
    id_column: str = "doc_id",
    text_column: str = "text",
    *more: Column,
) -> DataFrame:
    """One row per document: its id, the columns ``more``, lang_pred, score."""
    chosen = docs.select(F.col(id_column), *more, F.col(text_column).alias("_text"))
    kept = chosen.drop("_text").schema
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        grams = Grams(model.codes) if model else None
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            spoken = [i for i, t in enumerate(texts) if model and t and _LETTER.search(t)]
            for a in range(0, len(spoken), BATCH):
                some = spoken[a : a + BATCH]
                found = model.scores(grams, [prepared(texts[i]) for i in some])
                best = found.argmax(1)
                scores[some] = np.clip((found.max(1) + 1) / 2, 0, 1)
                for i, k in zip(some, best, strict=True):
                    langs[i] = model.languages[k]
            columns = [*batch.columns[:-1], pa.array(langs, pa.string()), pa.array(scores)]
            yield pa.RecordBatch.from_arrays(columns, [*kept.names, "lang_pred", "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return chosen.mapInArrow(judged, f"{schema}, lang_pred string, score double")

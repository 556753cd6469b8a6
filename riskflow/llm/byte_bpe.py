"""Byte-level BPE by a sentencepiece model made from a rank vocabulary.

The model is not trained: its protocol buffer is written field by field.  Each
token of the vocabulary is a piece, its bytes mapped to one character each, its
score the negative rank, so that the best-scored merge is the one of the lowest
rank.  Normalisation is the identity.  A text is cut into pre-tokens by the
vocabulary's pattern; a pre-token that is a token stays whole, any other is
encoded as a sentence of its own.  Decoding joins the bytes of the ids.

Defined cases: a null text counts as empty and has no ids; special tokens are
ordinary text; repeated rows and null ids are encoded each; other columns are
ignored.  A task keeps the ids of ``CACHE`` pre-tokens of up to ``LONGEST`` characters,
then starts afresh; longer ones are encoded each time, so its memory is bounded.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession

from riskflow.llm.common import give_back, text_chunks

#: Pre-tokens whose ids a task remembers.
CACHE = 300_000
#: Characters of the longest pre-token that is remembered.
LONGEST = 64
#: Byte b is the character FIRST_CHARACTER + b of a piece: letters, no white space.
FIRST_CHARACTER = 0x100
_MAP = "".join(chr(FIRST_CHARACTER + b) for b in range(256))

# Field numbers and constants of the sentencepiece model format.
PIECES, TRAINER_SPEC, NORMALIZER_SPEC = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
TYPE_NORMAL, TYPE_UNKNOWN = 1, 2
TRAINER_MODEL_TYPE, TRAINER_VOCAB_SIZE, TRAINER_UNK, TRAINER_BOS, TRAINER_EOS, TRAINER_PAD = 3, 4, 40, 41, 42, 43
MODEL_BPE = 2
NORMALIZER_NAME, NORMALIZER_DUMMY_PREFIX, NORMALIZER_EXTRA_SPACES, NORMALIZER_ESCAPE = 1, 3, 4, 5


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, from lines of base64 and rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks must run from 0 without a gap")
    return [ranks[i] for i in range(len(ranks))]


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, value: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(value)) + value


def _piece(text: str, score: float, kind: int) -> bytes:
    score = _varint(PIECE_SCORE << 3 | 5) + struct.pack("<f", score)
    body = _bytes(PIECE_TEXT, text.encode()) + score + _number(PIECE_TYPE, kind)
    return _bytes(PIECES, body)


def mapped(raw: bytes) -> str:
    """Each byte as one character."""
    return codecs.charmap_decode(raw, "strict", _MAP)[0]


def model_proto(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose ids are the ranks; the unknown piece comes after them."""
    pieces = [_piece(mapped(t), -float(rank), TYPE_NORMAL) for rank, t in enumerate(tokens)]
    unknown = _piece("<unk>", 0.0, TYPE_UNKNOWN)
    trainer = b"".join(
        [
            _number(TRAINER_MODEL_TYPE, MODEL_BPE),
            _number(TRAINER_VOCAB_SIZE, len(tokens) + 1),
            _number(TRAINER_UNK, len(tokens)),
            *(_number(field, -1) for field in (TRAINER_BOS, TRAINER_EOS, TRAINER_PAD)),
        ]
    )
    normalizer = _bytes(NORMALIZER_NAME, b"identity") + b"".join(
        _number(field, 0)
        for field in (NORMALIZER_DUMMY_PREFIX, NORMALIZER_EXTRA_SPACES, NORMALIZER_ESCAPE)
    )
    return b"".join(
        [*pieces, unknown, _bytes(TRAINER_SPEC, trainer), _bytes(NORMALIZER_SPEC, normalizer)]
    )


class Encoder:
    """Encodes texts in a worker."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_proto(tokens))
        self.find = regex.compile(pattern).findall
        self.whole = {}
        for rank, token in enumerate(tokens):
            try:
                self.whole[token.decode()] = struct.pack("<i", rank)
            except UnicodeDecodeError:  # no pre-token of a valid text is like this
                continue
        self.cache = dict(self.whole)

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text as 32-bit integers."""
        if len(self.cache) > len(self.whole) + CACHE:
            self.cache = dict(self.whole)
        cut = [self.find(text or "") for text in texts]
        new = list({t for tokens in cut for t in tokens if t not in self.cache})
        found = self.model.encode([mapped(t.encode()) for t in new], out_type=int, num_threads=1)
        for token, ids in zip(new, found, strict=True):
            self.cache[token] = np.array(ids, "<i4").tobytes()
        get = self.cache.__getitem__
        rows = [np.frombuffer(b"".join(map(get, tokens)), "<i4") for tokens in cut]
        for token in new:
            if len(token) > LONGEST:
                del self.cache[token]
        return rows


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: its id and ``ids``, array of int.  ``vocabulary`` is a path on the driver."""
    tokens = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # of earlier stages
        encoder = Encoder(tokens.value, pattern)
        for batch in batches:
            for some, texts in text_chunks(batch.column(1)):
                found = encoder.encode(texts)
                ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[some], ids], [id_column, "ids"])
            del batch
        del encoder
        give_back()

    id_type = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        encoded, f"`{id_column}` {id_type}, ids array<int>"
    )


def decode(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id") -> DataFrame:
    """One row per document: its id and ``raw``, the bytes that its ids stand for."""
    return _decoded(encoded, vocabulary, id_column, digests=False)


def digests(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id") -> DataFrame:
    """One row per document: its id, n_tokens, ids_sha256, decoded_sha256."""
    return _decoded(encoded, vocabulary, id_column, digests=True)


def _decoded(encoded: DataFrame, vocabulary: str, id_column: str, digests: bool) -> DataFrame:
    tokens = encoded.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["raw"]
    types = [pa.int64(), pa.string(), pa.string()] if digests else [pa.binary()]

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()  # of earlier stages
        token, name = tokens.value.__getitem__, [str(i) for i in range(len(tokens.value))].__getitem__
        for batch in batches:
            column, rows = batch.column(1), []
            flat, ends = column.values.to_numpy(), column.offsets.to_numpy()
            for a, b in zip(ends, ends[1:], strict=False):
                ids = flat[a:b].tolist()
                raw = b"".join(map(token, ids))
                if digests:
                    text = ",".join(map(name, ids)).encode()
                    rows.append((len(ids), hashlib.sha256(text).hexdigest(), hashlib.sha256(raw).hexdigest()))
                else:
                    rows.append((raw,))
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], [id_column, *names])

    id_type = encoded.schema[id_column].dataType.simpleString()
    more = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digests else "raw binary"
    return encoded.select(id_column, "ids").mapInArrow(decoded, f"`{id_column}` {id_type}, {more}")


def round_trip(spark: SparkSession, docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """Encode all documents, then decode the ids; the digests of both."""
    return digests(encode(docs, vocabulary, pattern), vocabulary)

"""Token ids as flat files of unsigned integers with 64-bit document offsets.

The documents are range-partitioned and sorted by id.  Each task writes sets of
files, a new one where ``FILE_BYTES`` or ``FILE_DOCS`` are reached: ``.bin`` with the ids of its documents one after the other (16 bits
wide if the vocabulary allows, else 32), ``.idx`` with an unsigned 64-bit offset
per document and one more for the end, ``.doc`` with the document ids.  The row
a task returns is what commits its files: their names hold the attempt, so those
of a failed or repeated attempt are never read.  The place of a file in the whole
is the prefix sum of the counts before it, over one row per file.

Readers map the files into memory where the folder is local, and read them by the
file system's own client elsewhere, a range of the ids at a time.

Defined cases: a null text counts as empty; each document ends with the end id,
so an empty one has one id; null document ids come first; rows that repeat an id
follow each other, in no stated order; an empty table gives an index without rows; other columns are
ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskflow.llm.common import chunks, written
from riskflow.workspace import run_dir

#: Words whose ids a worker remembers; then it starts afresh.
CACHE = 1_000_000
#: Runs of letters that are encoded as one text.
RUN = 128
#: How a tokenizer parts words, for which letters and marks may be encoded apart.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Letters of Latin-1, then printable ASCII that is neither letter nor digit, without the apostrophe.
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
#: A file of ids is closed when it has so many bytes or documents.
FILE_BYTES, FILE_DOCS = 1 << 30, 1 << 20
#: Ids and documents that are read at a time.
READ_IDS, READ_DOCS = 1 << 20, 4096
_INDEX = "part int, name string, n_docs bigint, n_ids bigint"


def _open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    if folder.startswith("file:/") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return pafs.FileSystem.from_uri(folder)


def _last_tokens(definition: str) -> np.ndarray | None:
    """Whether each id ends a run of letters, if the tokenizer marks ends, ignores case and parts letters
    from marks as ``SPLIT`` does; else None.
    """
    known = json.loads(definition)
    model, steps = known["model"], (known["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    normal = [step["type"] for step in (known["normalizer"] or {}).get("normalizers") or []]
    split = {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
    suffix = model.get("end_of_word_suffix")
    parts = steps[0] == split and normal == ["NFC", "Replace", "Lowercase"] and not model.get("dropout")
    if not (suffix and parts) or any(PLAIN.fullmatch(t["content"]) for t in known["added_tokens"]):
        return None
    last = np.zeros(1 + max(model["vocab"].values()), bool)
    last[[number for token, number in model["vocab"].items() if token.endswith(suffix)]] = True
    return last


class WordEncoder:
    """Encodes texts word by word; the tokenizer never joins what white space parts.

    Where it allows, a new word of Latin letters with marks behind is encoded as its letters in lower
    case and its marks, and ``RUN`` runs of letters are handed over as one text.
    """

    def __init__(self, definition: str, dtype: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark has a task on each core
        self.tokenizer, self.dtype, self.cache = Tokenizer.from_str(definition), dtype, {}
        self.last = _last_tokens(definition)

    def _learn_whole(self, words: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)
        for word, encoding in zip(words, found, strict=True):
            self.cache[word] = np.array(encoding.ids, self.dtype).tobytes()

    def _learn_letters(self, words: list[bytes]) -> None:
        runs = [words[i : i + RUN] for i in range(0, len(words), RUN)]
        texts = [b" ".join(run).decode() for run in runs]
        for run, encoding in zip(runs, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            ids = np.array(encoding.ids, self.dtype)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) != len(run):
                self._learn_whole(run)
                continue
            raw, start = ids.tobytes(), 0
            for word, end in zip(run, (ends * ids.itemsize).tolist(), strict=True):
                self.cache[word], start = raw[start:end], end

    def _learn(self, words: list[bytes]) -> None:
        """Put new words into the cache."""
        if self.last is None:
            return self._learn_whole(words)
        parted, letters, whole = [], set(), set()
        for word in words:
            if plain := PLAIN.fullmatch(word.decode()):
                core, marks = plain[1].lower().encode(), plain[2].encode()
                parted.append((word, core, marks))
                letters.add(core)
                whole.add(marks)
            else:
                whole.add(word)
        self._learn_whole([w for w in whole if w not in self.cache])
        self._learn_letters([w for w in letters if w not in self.cache])
        for word, core, marks in parted:
            self.cache[word] = self.cache[core] + self.cache[marks]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian ids of each text."""
        if len(self.cache) > CACHE:
            self.cache = {}
        cut = [(text or "").encode().split() for text in texts]
        new = list({w for words in cut for w in words if w not in self.cache})
        self._learn(new)
        get = self.cache.__getitem__
        return [b"".join(map(get, words)) for words in cut]


@lru_cache(maxsize=1)
def _worker_encoder(definition: str, dtype: str) -> WordEncoder:
    """One encoder for all tasks of a worker, so that later tasks find the words of earlier ones."""
    return WordEncoder(definition, dtype)


class _FileSet:
    """The files of some documents, while they are written."""

    def __init__(self, folder: str, name: str, dtype: str, end_id: int):
        self.name, self.end = name, np.array([end_id], dtype).tobytes()
        self.files, self.base = _open_folder(folder)
        self.tokens = self.files.open_output_stream(f"{self.base}/{name}.bin")
        self.offsets, self.ids = [0], []

    def add(self, ids: pa.Array, encoded: list[bytes]) -> None:
        for raw in encoded:
            self.tokens.write(raw + self.end)
            self.offsets.append(self.offsets[-1] + len(raw) // len(self.end) + 1)
        self.ids.append(ids)

    def is_full(self) -> bool:
        return self.offsets[-1] * len(self.end) >= FILE_BYTES or len(self.offsets) > FILE_DOCS

    def close(self, part: int) -> pa.RecordBatch:
        """Writes what belongs to the ids; the row for the index."""
        self.tokens.close()
        with self.files.open_output_stream(f"{self.base}/{self.name}.idx") as out:
            out.write(np.array(self.offsets, "<u8").tobytes())
        column = pa.chunked_array(self.ids)
        with (
            self.files.open_output_stream(f"{self.base}/{self.name}.doc") as out,
            pa.ipc.new_file(out, pa.schema([pa.field("id", column.type)])) as writer,
        ):
            writer.write_table(pa.table({"id": column}))
        row = ([part], [self.name], [len(self.offsets) - 1], [self.offsets[-1]])
        types = (pa.int32(), pa.string(), pa.int64(), pa.int64())
        arrays = [pa.array(c, t) for c, t in zip(row, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, ["part", "name", "n_docs", "n_ids"])


def write_token_files(
    docs: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """Write the files, then the index: part, name, n_docs, n_ids and base of each file set.

    ``tokenizer_path`` is a path on the driver.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as source:
        definition = source.read()
    size = Tokenizer.from_str(definition).get_vocab_size(with_added_tokens=True)
    dtype = "<u2" if max(size, end_id + 1) <= 1 << 16 else "<u4"
    shipped = spark.sparkContext.broadcast(definition)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made, current = TaskContext.get(), 0, None
        for batch in batches:
            texts, ids = batch.column(1).to_pylist(), batch.column(0)
            for some in chunks(texts):
                if current is None:
                    encoder = _worker_encoder(shipped.value, dtype)
                    name = f"{task.partitionId():06d}-{task.taskAttemptId()}-{made:06d}"
                    current, made = _FileSet(folder, name, dtype, end_id), made + 1
                current.add(ids[some], encoder.encode(texts[some]))
                if current.is_full():
                    yield current.close(task.partitionId())
                    current = None
        if current is not None:
            yield current.close(task.partitionId())

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # An id that many rows have, or none, need not stay in one range.
    spread = F.xxhash64(text_column)
    parts = written(
        docs.select(id_column, text_column)
        .repartitionByRange(partitions, id_column, spread)
        .sortWithinPartitions(id_column)
        .mapInArrow(write, _INDEX),
        "token-parts",
    )
    # One row per file of up to FILE_BYTES; the names of a part are in the order of its documents.
    before = Window.orderBy("part", "name").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base")
    index = parts.select("*", base, F.lit(folder).alias("folder"), F.lit(dtype).alias("dtype"))
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


def _open_file(files: pafs.FileSystem, path: str) -> pa.NativeFile:
    """The file for reads at any place, mapped into memory where it is local."""
    return pa.memory_map(path) if isinstance(files, pafs.LocalFileSystem) else files.open_input_file(path)


def _runs(offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most READ_IDS ids together; a longer document is alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + READ_IDS, "right")) - 1
        b = min(max(b, a + 1), a + READ_DOCS, n)
        yield a, b
        a = b


def read_token_files(index: DataFrame, id_column: str = "doc_id", id_type: str = "bigint") -> DataFrame:
    """One row per document, from the files: id, start, n_tokens, ids_crc32."""
    names = [id_column, "start", "n_tokens", "ids_crc32"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                files, folder = _open_folder(row["folder"])
                path = f"{folder}/{row['name']}"
                width = np.dtype(row["dtype"]).itemsize
                with _open_file(files, f"{path}.idx") as source:
                    offsets = np.frombuffer(source.read(), "<u8").astype(np.int64)
                with _open_file(files, f"{path}.doc") as source:
                    ids = pa.ipc.open_file(pa.py_buffer(source.read())).read_all().column("id")
                with _open_file(files, f"{path}.bin") as source:
                    for a, b in _runs(offsets):
                        first, last = int(offsets[a]), int(offsets[b])
                        raw = source.read_at((last - first) * width, first * width)
                        tokens = np.frombuffer(raw, row["dtype"]).astype("<u4")
                        ends = offsets[a : b + 1]
                        crc = [
                            zlib.crc32(tokens[s:e].tobytes())
                            for s, e in zip(ends - first, ends[1:] - first, strict=False)
                        ]
                        columns = [
                            ids.slice(a, b - a).combine_chunks(),
                            pa.array(ends[:-1] + row["base"]),
                            pa.array(np.diff(ends)),
                            pa.array(crc, pa.int64()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns, names)

    files = max(1, index.count())
    schema = f"`{id_column}` {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    return index.repartition(files).mapInArrow(read, schema)


def round_trip(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Write all documents as token files and read them back."""
    folder = run_dir(spark, "tokens")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return read_token_files(write_token_files(docs, folder, tokenizer_path, end_id), id_type=id_type)

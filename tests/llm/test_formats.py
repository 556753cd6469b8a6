from __future__ import annotations

import base64
import hashlib
import json
import os
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from riskflow.llm import byte_bpe, chat_format, token_files

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = st.sampled_from(["</s>", "<s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", "\\", "[", "<", "/s>", "a", "\n"])


@given(st.lists(PIECES).map("".join) | st.text(), st.sampled_from(["user", "assistant", "system", "tool", "", "[SYS]"]))
def test_turns_are_reversible(text, role):
    part, start, end = chat_format.write_turn(role, text)
    assert chat_format.read_turn(part) == (role, text)
    assert part.count("</s>") == 1 and part.endswith("</s>")
    assert chat_format.unescape(part[start:end]) == (text if role == "assistant" else "")


def test_layouts(spark):
    records = [
        {"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}], "source": "s"},
        {"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}]},
        {"prompt": "q", "response": "a"},
        {"prompt": "q", "completion": "a", "id": 4},
        {"instruction": "q", "output": "a"},
    ]
    rows = [(i, 0, json.dumps(r)) for i, r in enumerate(records)]
    bad = [(7, 0, None), (8, 0, "no json"), (9, 0, "[1]"), (10, 0, '{"other": 1}')]
    frame = spark.createDataFrame(rows + bad, "conv_id bigint, turn int, record string")
    formatted = chat_format.format_chats(frame)
    assert {r["conv_id"] for r in formatted.where("layout IS NULL").collect()} == {7, 8, 9, 10}
    digest = hashlib.sha256(b"user\nq\nassistant\na\n").hexdigest()
    found = chat_format.read_back(formatted).collect()
    assert {r["conv_id"]: r["turns_sha256"] for r in found if r["n_turns"]} == dict.fromkeys(range(5), digest)
    # No conversation is lost.
    assert sorted(r["conv_id"] for r in found if not r["n_turns"]) == [7, 8, 9, 10]


TURNS = [{"role": "user", "content": "q"}, {"role": "assistant", "content": "a"}]


def turns_in(spark, *records):
    """Layout and turns, by record."""
    frame = spark.createDataFrame([(i, 0, r) for i, r in enumerate(records)], "conv_id int, turn int, record string")
    rows = chat_format.format_chats(frame).orderBy("conv_id", "position").collect()
    found = [(None, [])] * len(records)
    for i in range(len(records)):
        mine = [r for r in rows if r["conv_id"] == i]
        found[i] = mine[0]["layout"], [chat_format.read_turn(r["part"]) for r in mine if r["part"] is not None]
    return found


def test_layouts_with_a_system_text_or_without_an_answer(spark):
    records = [
        {"system": "s", "messages": TURNS},
        {"system": "s", "conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": None}]},
        {"system": "s", "prompt": "q", "response": "a"},
        {"system": "s", "prompt": "q", "completion": "a"},
        {"prompt": "q", "response": None},
        {"messages": [{"role": "user", "content": None}, {"role": "assistant"}]},
    ]
    asked, answer, system = ("user", "q"), ("assistant", "a"), ("system", "s")
    assert turns_in(spark, *map(json.dumps, records)) == [
        ("messages", [system, asked, answer]),
        ("conversations", [system, asked, ("assistant", "")]),
        ("prompt_response", [system, asked, answer]),
        ("prompt_completion", [system, asked, answer]),
        ("prompt_response", [asked]),
        ("messages", [("user", ""), ("assistant", "")]),
    ]


def test_malformed_records_do_not_end_the_job(spark):
    long = "x " * 200_000
    records = [
        json.dumps({"messages": [*TURNS, None]}),
        json.dumps({"messages": [*TURNS, "text"]}),
        '{"prompt": "\\ud800 q", "response": "\\ud83d\\ude42"}',
        '{"prompt": ' + "[" * 100_000 + "]" * 100_000 + ', "response": "a"}',
        json.dumps({"prompt": long, "response": "a"}),
        json.dumps({"messages": []}),
        "",
    ]
    found = turns_in(spark, *records)
    assert [found[i] for i in (0, 1, 3, 5, 6)] == [(None, [])] * 5
    assert found[2] == ("prompt_response", [("user", "\ufffd q"), ("assistant", "\U0001f642")])
    assert found[4][1][0] == ("user", long)


def test_ties_repeated_rows_and_clashing_names(spark):
    rows = [(1, 0, "user", "b", "x"), (1, 0, "user", "a", "y"), (1, 1, "assistant", "c", "z"), (1, 1, "assistant", "c", "z")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, record string")
    found = chat_format.formatted_digests(frame.withColumn("position", frame["turn"])).collect()
    said = b"user\na\nuser\nb\nassistant\nc\nassistant\nc\n"
    assert [(r["n_turns"], r["turns_sha256"]) for r in found] == [(4, hashlib.sha256(said).hexdigest())]


def test_instruction_with_input():
    record = {"instruction": "do", "input": "this", "output": "a"}
    layout = chat_format.BY_FINGERPRINT[chat_format.fingerprint(record)]
    assert chat_format.canonical_turns(record, layout) == [("user", "do\n\nthis"), ("assistant", "a")]


def test_conversation_cases(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "hi"), (None, 0, "user", "x"), (2, 0, "tool", "\\[ANS]")]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    found = {r["conv_id"]: r for r in chat_format.formatted_digests(frame).collect()}
    assert found[1]["turns_sha256"] == hashlib.sha256(b"\nhi\nassistant\n\n").hexdigest()
    assert found[2]["turns_sha256"] == hashlib.sha256(b"tool\n\\[ANS]\n").hexdigest()
    assert (found[1]["loss_chars"], found[None]["n_turns"]) == (0, 1)
    assert chat_format.formatted_digests(frame.where("false")).collect() == []


def test_byte_bpe_equals_the_reference_encoder(docs_of, odd_rows, spark):
    with open(VOCABULARY, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*odd_rows, (20, "ab" * 3000), (21, "\x00\u0301 ſ \u2028\u00a0x" * 9)]
    docs = docs_of(*rows)
    expected = {(i, tuple(encoder.encode_ordinary(t or "")), (t or "").encode()) for i, t in rows}
    encoded = byte_bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN)
    raw = {r["doc_id"]: bytes(r["raw"]) for r in byte_bpe.decode(encoded, VOCABULARY).collect()}
    assert {(r["doc_id"], tuple(r["ids"]), raw[r["doc_id"]]) for r in encoded.collect()} == expected
    digests = byte_bpe.digests(encoded, VOCABULARY)
    one = digests.where("doc_id = 3").first()
    nothing = hashlib.sha256(b"").hexdigest()
    assert (one["n_tokens"], one["ids_sha256"], one["decoded_sha256"]) == (0, nothing, nothing)
    assert byte_bpe.digests(encoded.where("false"), VOCABULARY).collect() == []


def test_long_pre_tokens_are_encoded_but_not_kept():
    tokens = byte_bpe.read_ranks(VOCABULARY)
    encoder = byte_bpe.Encoder(tokens, public_tokenizers.PATTERN)
    word = "ab" * byte_bpe.LONGEST
    first, again = encoder.encode([f"{word} {word}", word]), encoder.encode([word, None])
    assert b"".join(tokens[i] for i in first[0]) == f"{word} {word}".encode()
    assert first[1].tolist() == again[0].tolist() and len(again[1]) == 0
    assert all(len(t) <= byte_bpe.LONGEST for t in encoder.cache.keys() - encoder.whole.keys())


def test_token_files(docs_of, odd_rows, spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = sorted([*odd_rows, (20, "ΑΣ ΑΣ\u00a0Σ x\x1cy")], key=lambda r: -1 if r[0] is None else r[0])
    expected, start = [], 0
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    found = token_files.round_trip(spark, docs_of(*rows), path, 2)
    assert sorted(map(tuple, found.collect()), key=lambda r: r[1]) == expected
    assert token_files.round_trip(spark, docs_of(*rows).where("false"), path, 2).collect() == []


def test_token_files_of_bounded_size(folder, spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_DOCS", 2)
    os.makedirs(folder)
    rows, sizes = [], [3, 0, 1, 70_000, 2]
    files, made = None, 0
    for i, size in enumerate(sizes):
        files = files or token_files._FileSet(f"file:{folder}", f"000000-0-{made:06d}", "<u2", 2)
        files.add(pa.array([i]), [np.arange(size, dtype="<u2").tobytes()])
        if files.is_full() or i == len(sizes) - 1:
            rows += files.close(0).to_pylist()
            files, made = None, made + 1
    assert [r["n_docs"] for r in rows] == [2, 2, 1]
    base = 0
    for row in rows:
        row |= {"base": base, "folder": f"file:{folder}", "dtype": "<u2"}
        base += row["n_ids"]
    index = spark.createDataFrame(rows)
    found = sorted(map(tuple, token_files.read_token_files(index).collect()))
    ids = [np.append(np.arange(size, dtype="<u2"), 2).astype("<u4") for size in sizes]
    starts = np.cumsum([0, *map(len, ids)])
    assert found == [(i, starts[i], len(x), zlib.crc32(x.tobytes())) for i, x in enumerate(ids)]


def test_ranges_of_token_files(monkeypatch):
    monkeypatch.setattr(token_files, "READ_IDS", 10)
    monkeypatch.setattr(token_files, "READ_DOCS", 3)
    offsets = np.array([0, 4, 8, 40, 41, 42, 43, 44, 50])
    assert list(token_files._runs(offsets)) == [(0, 2), (2, 3), (3, 6), (6, 8)]
    assert list(token_files._runs(np.array([0]))) == []


LATIN = st.text("aZéÀßÿ×÷.,'!~19_ \u0301ſΣ\u00a0\x85«»<|>\n", max_size=40)


@settings(deadline=None)  # the first example loads the tokenizer
@given(LATIN | st.text())
def test_words_parted_from_marks_have_the_ids_of_the_whole_text(text):
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as source:
        definition = source.read()
    encoder = token_files._worker_encoder(definition, "<u2")
    whole = token_files.WordEncoder.__new__(token_files.WordEncoder)
    whole.tokenizer, whole.dtype, whole.cache, whole.last = encoder.tokenizer, "<u2", {}, None
    assert encoder.encode([text]) == whole.encode([text])


def test_letters_are_encoded_once_whatever_their_case_and_marks():
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as source:
        encoder = token_files.WordEncoder(source.read(), "<u2")
    given_texts, tokenizer = [], encoder.tokenizer

    class Counting:
        def encode_batch_fast(self, texts, **how):
            given_texts.extend(texts)
            return tokenizer.encode_batch_fast(texts, **how)

    encoder.tokenizer = Counting()
    text = "Été été, ÉTÉ!! other Other. don't"
    (found,) = encoder.encode([text])
    assert np.frombuffer(found, "<u2").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    letters = [t for t in given_texts if "été" in t]
    assert len(letters) == 1 and sorted(letters[0].split()) == ["other", "été"]

"""Ranked search against scoring every document, and its defined cases."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from riskflow.llm import ranked_search as search
from riskflow.llm.common import Best


def ranked_by_hand(docs, queries, k):
    """Rows (query id, rank, doc id, score) from a score for every document."""
    cut = [(i, Counter(search.terms_of(text))) for i, text in docs]
    cut = [(i, c) for i, c in cut if c]
    n_docs, n_words = len(cut), sum(sum(c.values()) for _, c in cut)
    df = Counter(term for _, c in cut for term in c)
    for query, text in queries:
        asked, rows = Counter(search.terms_of(text)), []
        for i, c in cut:
            m = 25 + 75 * sum(c.values()) * n_docs // n_words
            score = 0
            for term, times in asked.items():
                if term in c:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += times * w * (1_000_000_000 * c[term] // (1000 * c[term] + 8 * m))
            if score > 0:
                rows.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(rows)[:k], start=1):
            yield query, rank, None if none else i, -score


def found(spark, docs, queries, k=10, **columns):
    index = search.build_index(docs)
    asked = spark.createDataFrame(queries, "item_id bigint, text string, doc_id string, score string")
    return [tuple(r) for r in search.search(index, asked, k).collect()]


def check(spark, docs_of, rows, queries, k=10):
    full = [(i, text, "x", "y") for i, text in queries]
    result = found(spark, docs_of(*rows), full, k)
    assert sorted(map(repr, result)) == sorted(map(repr, ranked_by_hand(rows, queries, k)))
    return result


@pytest.mark.parametrize("block, shard_words", [(4, 300), (128, 5000)])
def test_equals_scoring_every_document(spark, docs_of, monkeypatch, block, shard_words):
    monkeypatch.setattr(search, "BLOCK", block)
    monkeypatch.setattr(search, "SHARD_WORDS", shard_words)
    rng = random.Random(7)
    words = [f"w{i}" for i in range(60)]
    shares = [1 / (i + 1) for i in range(60)]

    def text(n):
        return " ".join(rng.choices(words, shares, k=n))

    rows = [(i, text(rng.randrange(1, 60))) for i in range(400)]
    rows += [(400 + i, rows[i][1]) for i in range(60)]
    rows += [(460 + i, "w0 " * rng.randrange(1, 500) + "w59") for i in range(20)]
    queries = [(i, text(rng.randrange(1, 25))) for i in range(30)]
    check(spark, docs_of, rows, queries)


def test_bounds_turn_documents_down_before_unpacking(spark, monkeypatch):
    """With a good list of best documents at hand, blocks of common terms stay packed."""
    monkeypatch.setattr(search, "BLOCK", 4)
    import pyarrow as pa

    builder = search.ShardBuilder()
    texts = ["rare common"] * 10 + ["common " + "filler " * (i % 40) for i in range(400)]
    builder.add(pa.array(range(len(texts))), texts)
    row = builder.row()
    shard = search.Shard(row, row["ids"], pa.array(row["terms"], pa.binary()))
    shard.weigh(lambda sizes: 25 + 75 * sizes * len(texts) // builder.n_words)
    lists = shard.find([b"rare", b"common"], search._hashes([b"rare", b"common"]))
    factors = search.weights(shard.lists[lists], len(texts))
    best = Best(10)
    search.run_query(shard, lists, factors, best)
    assert [r[2] for r in best.rows] == list(range(10))
    shard.known.clear()
    search.run_query(shard, lists, factors, best)
    unpacked = sum(b - a for a, b in shard.known)
    assert unpacked < len(shard.last) / 10


def test_odd_documents_and_queries(spark, docs_of, odd_rows):
    queries = [(1, "A b c"), (1, "a B c"), (2, None), (3, ""), (4, "nowhere"), (None, "word id"), (5, "é 中文")]
    result = check(spark, docs_of, odd_rows, queries)
    assert not [r for r in result if r[0] in (2, 3, 4)]
    # The document without an id is found, and the repeated row twice.
    assert sorted(str(r[2]) for r in result if r[0] is None) == ["9", "9", "None"]


def test_many_slices(spark, docs_of, monkeypatch):
    monkeypatch.setattr(search, "QUERY_BYTES", 10)
    rows = [(1, "a b"), (2, "a c"), (3, "b c d")]
    check(spark, docs_of, rows, [(1, "a d"), (2, "b"), (3, "c c a"), (4, "d")])


def test_blocks_of_every_width(spark, docs_of, monkeypatch):
    monkeypatch.setattr(search, "BLOCK", 8)
    rows = [(i, "a" if i % 300 == 0 else "b") for i in range(2000)] + [(2000, "a " * 70_000 + "b " * 300)]
    check(spark, docs_of, rows, [(1, "a"), (2, "a b")])


def test_empty_tables(spark, docs_of):
    none = docs_of((1, "a")).where("false")
    assert found(spark, none, [(1, "a", "", "")]) == []
    assert found(spark, docs_of((1, "a")), []) == []

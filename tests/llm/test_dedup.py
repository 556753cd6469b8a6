from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskflow.llm import exact_dedup, near_dedup
from riskflow.llm.components import components


def exact_by_hand(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    result = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        digest = hashlib.sha256(text.encode()).hexdigest()
        result += [(i, keep, len(ids), i == keep, digest) for i in ids]
    return Counter(result)


def test_exact_groups(docs_of, odd_rows):
    found = exact_dedup.exact_duplicates(docs_of(*odd_rows))
    assert Counter(map(tuple, found.collect())) == exact_by_hand(odd_rows)


def test_exact_of_nothing(docs_of, spark):
    empty = docs_of((1, "a")).where("false")
    assert exact_dedup.exact_duplicates(empty).collect() == []
    assert exact_dedup.drop_duplicates(empty).collect() == []


def test_exact_keeps_columns_and_one_of_repeated_rows(docs_of):
    docs = docs_of((1, "a"), (1, "a"), (2, "a "), (3, "b"), (None, "c"))
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 2, 3, None])


@pytest.mark.parametrize("text", ["", " ", "a", "\ta \x0b b\n", "a\u00a0b c"])
def test_normalise(text):
    assert exact_dedup.normalise(text).decode() == re.sub("[\x20\x09-\x0d]+", " ", text)


def near_by_hand(rows):
    sets = {}
    for doc_id, text in rows:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[doc_id] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    ids = [i for i in sets if i is not None]
    label = {i: i for i in ids}

    def root(i):
        return i if label[i] == i else root(label[i])

    for a in ids:
        for b in ids:
            x, y = sets[a], sets[b]
            if a < b and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((root(a), root(b)))
                label[high] = low
    return {(i, len(s), root(i) if i is not None else None) for i, s in sets.items()}


def test_near_components(docs_of, odd_rows):
    import random

    rng, rows = random.Random(4), list(odd_rows)
    base = odd_rows[11][1].split()
    for i in range(40):  # a chain of copies, each some words further from the first
        base[rng.randrange(len(base))] = f"new{i}"
        rows.append((100 + i, " ".join(base)))
    found = near_dedup.near_duplicates(docs_of(*rows)).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == near_by_hand(rows)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_near_of_nothing(docs_of):
    assert near_dedup.near_duplicates(docs_of((1, "a")).where("false")).collect() == []


def test_half_keys_meet_as_often_as_promised():
    rng, met = np.random.default_rng(0), 0
    for _ in range(200):
        common = rng.integers(1 << 63, size=600, dtype=np.uint64)
        sets = [np.concatenate([common, rng.integers(1 << 63, size=100, dtype=np.uint64)]) for _ in range(2)]
        first, second = near_dedup.half_keys(sets)
        met += (first[0] == first[1]).any() and (second[0] == second[1]).any()
    assert met >= 199


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 30)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 150)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    expected = {i: 0 for i in range(31)} | {100 + i: 100 for i in range(40)} | {150: 150, 200: 150}
    assert {r["id"]: r["component"] for r in found} == expected and len(found) == len(expected)


def test_one_row_of_each_group_of_equal_texts_stays(docs_of):
    rows = [
        (1, "a b"), (None, "a  b"), (None, "new"), (None, "new"), (None, "other"), (None, "other "),
        (2, "a\tb"), (2, "second"), (3, "second"), (3, "third"), (4, "x  y"), (4, "x y"), (None, None), (5, ""),
    ]
    left = exact_dedup.drop_duplicates(docs_of(*rows)).collect()
    found = sorted((str(r["doc_id"]), exact_dedup.normalise(r["text"])) for r in left)
    first = {}
    for i, text in sorted(rows, key=lambda row: (row[0] is None, row[0] or 0)):
        first.setdefault(exact_dedup.normalise(text), str(i))
    assert found == sorted((i, text) for text, i in first.items())

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from riskflow.llm import language_id, ppm, quality
from riskflow.llm.common import crc_remainder
from riskflow.llm.queries import QUERIES


def ppm_by_hand(rows, learned):
    """Scores of all rows: unigram base and PPM, with dictionaries."""
    cut = [(text or "").encode().lower().split() for _, text in rows]
    counts = Counter(w for words, yes in zip(cut, learned, strict=True) if yes for w in [*words, None])
    n, distinct = sum(counts.values()), len(counts)
    after = defaultdict(Counter)

    def stretch(words):
        return b"\n" * ppm.ORDER + b" ".join(words) + b"\n"

    for words, yes in zip(cut, learned, strict=True):
        raw = stretch(words)
        for k in range(ppm.ORDER, len(raw) if yes else 0):
            for order in range(ppm.ORDER + 1):
                after[raw[k - order : k]][raw[k]] += 1
    for (doc_id, _), words in zip(rows, cut, strict=True):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (distinct + 1))) for w in [*words, None])
        raw, score = stretch(words), 0.0
        for k in range(ppm.ORDER, len(raw)):
            excluded = set()
            for order in range(ppm.ORDER, -1, -1):
                here = {b: c for b, c in after.get(raw[k - order : k], {}).items() if b not in excluded}
                if not here:
                    continue
                total = sum(here.values()) + len(here)
                if raw[k] in here:
                    score += math.log10(here[raw[k]] / total)
                    break
                score += math.log10(len(here) / total)
                excluded |= set(here)
            else:
                score -= math.log10(256 - len(excluded))
        known = sum(counts[w] > 0 for w in [*words, None])
        yield doc_id, len(words) + 1, known, n, base, score


def check_ppm(docs, rows, learned, trains):
    found = {r["doc_id"]: r for r in ppm.score_documents(docs, trains).collect()}
    for doc_id, tokens, known, n, base, score in ppm_by_hand(rows, learned):
        row = found[doc_id]
        assert (row["n_tokens"], row["n_known"], row["train_tokens"]) == (tokens, known, n)
        assert math.isclose(row["base_score"], base, rel_tol=1e-9, abs_tol=1e-9)
        assert math.isclose(row["score"], score, rel_tol=1e-9, abs_tol=1e-9)


def test_ppm_scores(docs_of, odd_rows):
    rows = [r for i, r in enumerate(odd_rows) if i != 8 and len(r[1] or "") < 5000]
    learned = [zlib.crc32(str(r[0] if r[0] is not None else "").encode()) % 10 != 0 for r in rows]
    check_ppm(docs_of(*rows), rows, learned, crc_remainder("doc_id", 10) != 0)


def test_ppm_without_training(docs_of):
    rows = [(1, "ab c"), (2, None)]
    check_ppm(docs_of(*rows), rows, [False, False], F.lit(False))
    assert ppm.score_documents(docs_of(*rows).where("false"), F.lit(True)).collect() == []


def test_ppm_probabilities_sum_to_one():
    rng = np.random.default_rng(3)
    raw = bytes(rng.choice(list(b"abcd "), 4000).tolist())
    strings, _ = ppm.strings_of([raw])
    values, counts = np.unique(strings, return_counts=True)
    order_1 = np.zeros((256, 256), np.int64)
    np.add.at(order_1, ((values >> 8) & 255, values & 255), counts)
    ending = (int(values[50]) >> 8) & 65535
    inside = ((values >> 8) & 65535) == ending
    for context in {int(values[50]) >> 8, (ord("z") << 24) | ending}:
        every = (context << 8) | np.arange(256)
        keys = np.union1d(values[inside], every)
        n = np.zeros(len(keys))
        n[np.searchsorted(keys, values[inside])] = counts[inside]
        scores = ppm.string_scores(keys, n, order_1)
        assert math.isclose((10 ** scores[np.isin(keys, every)]).sum(), 1, rel_tol=1e-9)


def test_language_of_held_out_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    judged = QUERIES["op3_language_id"](spark, sf_dir).join(truth, "doc_id").where("held_out").collect()
    assert len(judged) > 200
    assert sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.98 * len(judged)
    assert all(0 <= r["score"] <= 1 for r in judged)


def test_language_cases(docs_of, odd_rows):
    german = [(50 + i, "der die das und nicht mit einer straße über " * 3, "de") for i in range(5)]
    english = [(80 + i, "the and of with this that from which over " * 3, "en") for i in range(5)]
    unknown = [(90, "the of and", None), (91, "123 !?", "en")]
    docs = docs_of(*german, *english, *unknown)
    model = language_id.fit(docs, F.lit(True))
    found = {r["doc_id"]: r for r in language_id.identify(docs_of(*german, *english, *unknown, *odd_rows), model).collect()}
    assert {found[i]["lang_pred"] for i in range(50, 55)} == {"de"}
    assert found[90]["lang_pred"] == "en"
    for doc_id in (3, 4, 13, 91):
        assert (found[doc_id]["lang_pred"], found[doc_id]["score"]) == ("und", 0.0)
    assert language_id.fit(docs.where("false"), F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.identify(docs, None).collect()} == {"und"}


def test_quality_against_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    judged = QUERIES["op10_quality"](spark, sf_dir).join(labels, "doc_id").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in judged)
    assert right >= 0.97 * len(judged)


def test_quality_cases(docs_of, odd_rows):
    docs = docs_of(*odd_rows)
    found = quality.score(docs, quality.fit(docs)).collect()
    assert len(found) == len(odd_rows)
    assert {r["doc_id"]: r["kept"] for r in found if r["doc_id"] in (3, 4, 13)} == {3: False, 4: False, 13: False}
    kept = quality.drop_junk(docs)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)
    empty = docs.where("false")
    assert quality.score(empty, quality.fit(empty)).collect() == []


def test_label_model_learns_from_overlap():
    """Patterns in which two labellers find a fault are surer than those in which none does."""
    n = len(quality.LABELLERS)
    all_good = sum(quality.GOOD * 3**i for i in range(n))
    two_faults = all_good - (quality.GOOD - quality.JUNK) * (3**0 + 3**1)
    posterior = quality.label_model(np.array([all_good, two_faults]), np.array([900.0, 100.0]))
    assert posterior[0] > 0.95 and posterior[1] < 0.05


def test_scripts_without_spaces_are_no_fault():
    text = "今天天气很好，我们一起去公园散步。孩子们在草地上玩耍，老人坐在树下聊天，大家都很开心。" * 3
    votes = [label(quality.Facts.of(text)) for label in quality.LABELLERS]
    assert quality.JUNK not in votes
    assert quality.JUNK in [label(quality.Facts.of("x" * 200)) for label in quality.LABELLERS]

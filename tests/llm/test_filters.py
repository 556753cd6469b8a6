from __future__ import annotations

import random

import numpy as np

from riskflow.llm import decontaminate, url_filter
from riskflow.llm.url_filter import UrlRule

from .conftest import prose


def verdict_by_hand(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best and best.host + best.path, best.action if best else "allow"


def test_urls(spark):
    urls = [
        None,
        "",
        "no scheme.net/",
        "http://a.NET/x?y#z",
        "https://example.net/en/1",
        "https://m.example.net/EN/1",
        "http://example.net",
        "http://notexample.net/en/",
        "http://x.org/fr/2",
        "http://org/fr/",
        "http://example.com/de/#://",
        "http://example.com?/de/",
        "http://a..net/",
        "http://.net/",
        "http:///path",
        "x://É.net/\n",
        "http://b.com/deep/path",
    ]
    rules = [*url_filter.RULES, UrlRule("block", "b.com", "/deep/p"), url_filter.RULES[0]]
    rows = [(i, u, "x", "y") for i, u in enumerate([*urls, *urls[:3]])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, rule string, host string")
    found = url_filter.judge_urls(pages, url_filter.rules_table(spark, rules)).collect()
    assert {tuple(r) for r in found} == {(i, *verdict_by_hand(u, rules)) for i, u, *_ in rows}
    assert url_filter.judge_urls(pages.where("false"), url_filter.rules_table(spark)).collect() == []
    none = url_filter.judge_urls(pages, url_filter.rules_table(spark, ())).collect()
    assert {(r["rule"], r["verdict"]) for r in none} == {(None, "allow")}


def test_a_list_of_several_cascades(spark):
    rules = [
        *url_filter.RULES,
        *[UrlRule(a, f"h{i}.net", "/en/"[: 1 + i % 4]) for i in range(9) for a in ("block", "allow")[: 1 + i % 2]],
    ]
    hosts = ["net", "example.net", "h3.net", "a.h4.net", "org", "example.com", "h8.net", "none.io"]
    urls = [f"http://{host}{path}" for host in hosts for path in ("", "/", "/en/x", "/de/", "/fr/" + "z" * 5000)]
    pages = spark.createDataFrame(list(enumerate([*urls, None])), "page_id bigint, url string")
    table = url_filter.rules_table(spark, rules)
    one = sorted(map(tuple, url_filter.judge_urls(pages, table).collect()))
    assert sorted(map(tuple, url_filter.judge_urls(pages, table, keys_a_cascade=5).collect())) == one
    # Of a rule that is in the list for both actions, the one that allows wins.
    by_hand = [(i, *verdict_by_hand(u, sorted(rules, key=lambda r: r.action))) for i, u in enumerate([*urls, None])]
    assert one == sorted(by_hand)


def test_cascade_is_exact_on_its_universe(spark):
    universe = spark.range(3000).selectExpr("CAST(id AS STRING) AS key")
    listed = universe.where("pmod(xxhash64(key), 10) = 0")
    from pyspark.sql import functions as F

    levels = url_filter.build_cascade(listed, universe)
    assert len(levels) > 2
    found = universe.where(url_filter.is_listed(F.col("key"), levels))
    assert {r.key for r in found.collect()} == {r.key for r in listed.collect()}


def edit_by_hand(item, words):
    row = [0] * (len(words) + 1)
    for i, a in enumerate(item, start=1):
        new = [i]
        for j, b in enumerate(words, start=1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_edit_distance():
    rng = np.random.default_rng(2)
    for _ in range(200):
        item, words = rng.integers(1, 5, rng.integers(1, 9)), rng.integers(0, 5, rng.integers(0, 14))
        assert decontaminate.edit_distance(item, words)[0] == edit_by_hand(item.tolist(), words.tolist())


def test_passages(docs_of, spark):
    rng = random.Random(6)
    items = [(i, prose(500 + i, 12 + 3 * i)) for i in range(20)]
    items += [(20, None), (21, ""), (22, "too short"), (23, items[0][1])]
    rows, planted, edited = [], set(), set()
    for i in range(120):
        words = prose(1000 + i, 80).split()
        if i < 60:
            item, passage = items[i % 20][0], items[i % 20][1].split()
            if i >= 30:
                for _ in range(decontaminate.allowed_edits(len(passage))):
                    passage[rng.randrange(len(passage))] = "changed"
                edited.add((i, item))
            else:
                planted.add((i, item))
            at = rng.randrange(len(words))
            words[at:at] = " ".join(passage).upper().split()
        rows.append((i, "  ".join(words)))
    rows += [(None, items[1][1]), (200, None), (201, ""), (202, "x"), (203, items[2][1]), (203, items[2][1])]
    planted |= {(None, 1), (203, 2)} | {(d, 23) for d, i in planted if i == 0}
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    docs = docs_of(*rows)
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_passages(docs, benchmark).collect()]
    assert planted <= set(found)
    assert len(edited & set(found)) >= 0.9 * len(edited)
    twin = {(d, 23) for d, i in edited if i == 0}
    assert set(found) <= planted | edited | twin
    clean = decontaminate.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    hit = {d for d, _ in found}
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d) for d, _ in rows if d not in hit)
    assert decontaminate.find_passages(docs.where("false"), benchmark).collect() == []
    assert decontaminate.find_passages(docs, benchmark.where("false")).collect() == []


def random_words(rng, n):
    return [f"{rng.randrange(1 << 40):x}" for _ in range(n)]


def edited_copy(rng, words):
    words = list(words)
    for _ in range(decontaminate.allowed_edits(len(words))):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        if kind < 2:
            words[at : at + 1 - kind] = random_words(rng, 1)
        else:
            del words[at]
    return words


def test_edited_copies_of_long_items():
    rng = random.Random(8)
    for n in (300, 700, 1000):
        items = [random_words(rng, n) for _ in range(10)]
        benchmark = decontaminate.Benchmark.of([(i, " ".join(item)) for i, item in enumerate(items)])
        docs = [
            " ".join(random_words(rng, rng.randrange(40)) + edited_copy(rng, items[k % 10]) + random_words(rng, 20))
            for k in range(100)
        ]
        found = {(text, item) for text, item, *_ in benchmark.matches(docs)}
        assert found <= {(k, k % 10) for k in range(100)}
        assert len(found) >= 92  # RECALL, less the spread of 100 draws


def test_candidates_of_neighbouring_texts_are_kept_apart():
    item = random_words(random.Random(9), 40)
    benchmark = decontaminate.Benchmark.of([(0, " ".join(item))])
    texts = [" ".join(item[:n]) for n in range(1, 30)]
    found = benchmark.matches([t for text in texts for t in (text, " ".join(item))])
    assert found == [(2 * k + 1, 0, 0, 0) for k in range(len(texts))]


def test_items_of_less_than_five_words_are_looked_up_whole(spark, docs_of):
    items = [(0, "one Two three four"), (1, "two three"), (2, "word"), (3, None), (4, ""), (5, "two three"), (6, "one two")]
    texts = ["x ONE two  three four y", "two\tthree two three", "three two", "a word", "two", "three", None, ""]
    found = decontaminate.Benchmark.of(items).matches(texts)
    assert found == [  # text, number of the item among those with words, place, distance
        (0, 0, 1, 0), (0, 1, 2, 0), (0, 3, 2, 0), (0, 4, 1, 0), (1, 1, 0, 0), (1, 3, 0, 0), (3, 2, 1, 0),
    ]
    benchmark = spark.createDataFrame(items, "item_id int, text string")
    kept = decontaminate.drop_contaminated(docs_of(*enumerate(texts)), benchmark).collect()
    assert sorted(r["doc_id"] for r in kept) == [2, 3, 4, 5, 6, 7]  # one word is no passage


def test_items_of_scripts_without_spaces():
    items = [(0, "今天天气很好我们去公园散步"), (1, "你好"), (2, "ประเทศไทยมีเมืองหลวง")]
    edited = "今天天气很好你们去公园散步"
    texts = ["他说今天天气很好我们去公园散步吧", f"前{edited}后", "说你好吗", "x ประเทศไทยมีเมืองหลวง y", "公园很好"]
    found = {(text, item): distance for text, item, _, distance in decontaminate.Benchmark.of(items).matches(texts)}
    assert found.pop((1, 0), 1) == 1  # an edited copy is found with RECALL
    assert found == {(0, 0): 0, (2, 1): 0, (3, 2): 0}


def test_edited_passages_against_all_places():
    rng = random.Random(12)
    items = [random_words(rng, rng.randrange(5, 40)) for _ in range(40)]
    texts = []
    for k in range(200):
        passage = edited_copy(rng, items[k % 40]) if k % 3 else random_words(rng, 20)
        texts.append(" ".join(random_words(rng, rng.randrange(30)) + passage + random_words(rng, rng.randrange(30))))
    least = {}
    for t, text in enumerate(texts):
        words = text.split()
        for i, item in enumerate(items):
            row = [0] * (len(words) + 1)
            for a in range(1, len(item) + 1):
                new = [a]
                for b, word in enumerate(words, start=1):
                    new.append(min(row[b - 1] + (word != item[a - 1]), row[b] + 1, new[-1] + 1))
                row = new
            if min(row) <= decontaminate.allowed_edits(len(item)):
                least[t, i] = min(row)
    benchmark = decontaminate.Benchmark.of([(i, " ".join(item)) for i, item in enumerate(items)])
    found = {(t, i): distance for t, i, _, distance in benchmark.matches(texts)}
    assert found.items() <= least.items()
    assert len(found) >= 0.93 * len(least) and len(least) > 100


def test_verbatim_copies_of_short_items_are_found():
    rng = random.Random(10)
    for n in (5, 6, 7):
        texts = [" ".join(random_words(rng, n)) for _ in range(300)]
        for seed in range(5):
            benchmark = decontaminate.Benchmark.of(list(enumerate(texts)), seed)
            assert {(text, item) for text, item, *_ in benchmark.matches(texts)} == {(k, k) for k in range(300)}

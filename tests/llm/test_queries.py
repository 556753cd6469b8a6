"""The registered queries on the tables, against SQL or brute force, and the pipeline."""

from __future__ import annotations

import glob
import os

import duckdb
import public_tokenizers
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from riskflow.llm import byte_bpe, decontaminate, exact_dedup, quality, secret_scan
from riskflow.llm.queries import ORACLE_SQL, QUERIES

from .test_dedup import near_by_hand
from .test_secret_scan import scanned_by_hand


@pytest.fixture(scope="module")
def oracle(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, sf_dir, oracle, name):
    result = oracle.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    expected = sorted(repr(dict(sorted(zip(columns, row, strict=True)))) for row in result.fetchall())
    rows = QUERIES[name](spark, sf_dir).collect()
    assert sorted(repr(dict(sorted(r.asDict().items()))) for r in rows) == expected


def test_contract_has_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE_SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", ["op1_url_filter", "op13_secret_scan"])
def test_native_queries_stay_in_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Join"))


def test_secret_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ratios = secret_scan.train(secret_scan.labelled_samples(docs)).collect()
    model = {r["step"]: r["log_ratio"] for r in ratios}
    expected = sorted(scanned_by_hand(r["doc_id"], r["text"], model) for r in docs.collect())
    assert sorted(map(tuple, QUERIES["op13_secret_scan"](spark, sf_dir).collect())) == expected


def test_near_query(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op7_near_dedup"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in found} == near_by_hand(rows)


def test_passage_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    padded = {r["item_id"]: b" " + b" ".join(decontaminate.words_of(r["text"])) + b" " for r in items}
    whole = {
        (d["doc_id"], i)
        for d in docs
        for i, passage in padded.items()
        if passage in b" " + b" ".join(decontaminate.words_of(d["text"])) + b" "
    }
    found = QUERIES["op4_decontaminate"](spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["distance"] == 0} == whole


def pipeline_by_hand(rows, judge, benchmark):
    """Ids and texts that pass the first four stages."""
    rows = [(i, t) for i, t in rows if judge(t)[0] >= quality.THRESHOLD]
    first = {}
    for i, t in sorted(rows):
        first.setdefault(exact_dedup.normalise(t), (i, t))
    rows = list(first.values())
    heads = {i for i, _, component in near_by_hand(rows) if i == component}
    rows = [(i, t) for i, t in rows if i in heads]
    found = {text for text, *_ in benchmark.matches([t for _, t in rows])}
    return [row for k, row in enumerate(rows) if k not in found]


def test_pipeline(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").collect()
    benchmark = decontaminate.Benchmark.of([(r["item_id"], r["text"]) for r in items])
    left = pipeline_by_hand(rows, quality.Judge(quality.fit(docs)), benchmark)
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    frame = spark.createDataFrame(left, "doc_id bigint, text string")
    expected = byte_bpe.round_trip(spark, frame, vocabulary, public_tokenizers.PATTERN).collect()
    assert sorted(QUERIES["pipeline"](spark, sf_dir).collect()) == sorted(expected)
    assert 0 < len(expected) < len(rows)


def test_stages_take_odd_documents(spark, sf_dir, docs_of, odd_rows):
    docs, columns = docs_of(*odd_rows), None
    for name, stage in corpus_pipeline.STAGES[1:]:
        columns = docs.columns
        docs = stage(spark, docs, sf_dir)
        assert name == "byte_bpe" or docs.columns == columns
    ids = sorted(str(r["doc_id"]) for r in docs.collect())
    # Copies go: 2 and 5 of 1, 4 of 3, 8 and 7 of 6, a second 9, 11 and 12 of 10.
    assert ids == sorted(map(str, [1, 3, 6, 9, None, 10, 13, 14, 15, 16]))


def test_stages_take_no_documents(spark, sf_dir, docs_of):
    docs = docs_of((1, "a")).where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0

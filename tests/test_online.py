"""Submitted text, numbering, compaction, joined scorers and counters as streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from riskflow.operators.store import RecordStore
from riskflow.plans import online
from riskflow.schema import INTAKE
from riskflow.sources import files
from riskflow.sources.readers import read_intake_stream
from riskflow.streaming import audit, flows, intake

from conftest import GOOD

FRESH = "seq bigint, id bigint"


def land(spark, rows, schema, path):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def number(spark, root, first=0, checkpoint="checkpoint"):
    schema = spark.createDataFrame([], FRESH).schema
    landed = read_intake_stream(spark, f"{root}/landing", schema, max_files=1)
    intake.start_numbering(landed, root, f"{root}/{checkpoint}", first, ["seq"]).awaitTermination()


def numbered(spark, root):
    return {r.seq: (r.id, r.arrival) for r in spark.read.parquet(f"{root}/log").collect()}


def test_ids_are_dense_over_batches(spark, folder):
    for rows in ([(1, -1), (2, None)], [(3, 50), (4, -1)], [(5, -1), (6, 7)]):
        land(spark, rows, FRESH, f"{folder}/landing")
    number(spark, folder, first=10)
    found = numbered(spark, folder)
    assert {seq: i for seq, (i, _) in found.items()} == {1: 10, 2: 11, 3: 50, 4: 51, 5: 52, 6: 7}
    assert sorted(arrival for _, arrival in found.values()) == list(range(6))
    ledger = intake.Ledger(spark, f"{folder}/ledger", 10)
    entries = [ledger.entry(b) for b in ledger.batches()]
    assert [(e.first_id, e.n_fresh, e.first_arrival, e.n) for e in entries] == [(10, 2, 0, 2), (51, 1, 2, 2), (52, 1, 4, 2)]


@pytest.mark.parametrize("lost", ["log", "log and ledger"])
def test_a_replayed_batch_gets_the_same_ids(spark, folder, lost):
    for rows in ([(1, -1), (2, -1)], [(4, -1), (3, -1)], [(5, -1)]):
        land(spark, rows, FRESH, f"{folder}/landing")
    number(spark, folder)
    before = numbered(spark, folder)
    # The last batch fails after its ledger entry, or after nothing, and comes again.
    files.delete(spark, f"{folder}/log/batch=2")
    files.delete(spark, f"{folder}/checkpoint/commits/2")
    if lost == "log and ledger":
        files.delete(spark, f"{folder}/ledger/2.json")
    number(spark, folder)
    assert numbered(spark, folder) == before
    # A batch that was finished, but not noted as such, is not written again.
    files.delete(spark, f"{folder}/checkpoint/commits/2")
    number(spark, folder)
    assert numbered(spark, folder) == before and spark.read.parquet(f"{folder}/log").count() == 5


LINES = [
    json.dumps(GOOD),
    json.dumps({**GOOD, "id": None, "extra": 1}),
    json.dumps({k: v for k, v in GOOD.items() if k != "id"}),
    json.dumps({**GOOD, "age": "old"}),
    json.dumps({**GOOD, "age": None}),
    '{"gender": "Male", "age": 3',
    "",
    "no JSON at all",
    "[1, 2]",
    "17",
    "null",
]


def judge(spark, root, lines=LINES):
    spark.createDataFrame([(line,) for line in lines], "value string").write.mode("append").text(f"{root}/landing")
    stream = intake.read_lines_stream(spark, f"{root}/landing", max_files=2)
    intake.start_intake(stream, f"{root}/judged", f"{root}/judged-checkpoint").awaitTermination()
    return spark.read.schema(intake.judged_schema()).parquet(f"{root}/judged")


def test_every_line_is_judged_once_and_kept(spark, folder):
    judged = judge(spark, folder)
    assert sorted(r.line for r in judged.collect()) == sorted(LINES)
    rejected = {r.line: r.reason for r in intake.rejected_from(judged).collect()}
    assert {rejected[line] for line in LINES[5:]} == {"line:malformed"}
    assert rejected[LINES[3]] == "age:type" and rejected[LINES[4]] == "age:required"
    accepted = intake.accepted_from(judged)
    assert [f.dataType for f in accepted.schema][: len(INTAKE)] == [f.dataType for f in INTAKE]
    assert sorted(r.id for r in accepted.collect()) == [-1, -1, GOOD["id"]]
    assert len(judge(spark, folder, LINES[:1]).collect()) == len(LINES) + 1


def test_lines_become_numbered_records(spark, folder):
    judge(spark, folder)
    judged = spark.readStream.schema(intake.judged_schema()).parquet(f"{folder}/judged")
    intake.start_numbering(intake.accepted_from(judged), folder, f"{folder}/checkpoint", 3).awaitTermination()
    log = spark.read.schema(intake.log_schema()).parquet(f"{folder}/log")
    assert sorted(r.id for r in log.collect()) == [GOOD["id"], 8, 9]


def test_second_compaction_reads_new_files_only(spark, folder):
    schema = spark.createDataFrame([], "id bigint, v string, at bigint").schema
    store = RecordStore.create(spark, f"{folder}/store", schema, ["at"], n_buckets=8)
    read = []
    for rows in ([(i, "a", 1) for i in range(100)], [(5, "b", 2), (200, "b", 2)], [(6, "old", 0)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{folder}/landing")
        landed = read_intake_stream(spark, f"{folder}/landing", schema)
        flows.start_change_log(landed, f"{folder}/log", f"{folder}/log-checkpoint").awaitTermination()
        log = read_intake_stream(spark, f"{folder}/log", schema)
        query = flows.start_compaction(log, store, f"{folder}/store-checkpoint")
        query.awaitTermination()
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
    # Each run reads its batch twice at most: to reduce it, never what was there before.
    assert read == [100, 2, 1]
    found = {r.id: (r.v, r.at) for r in RecordStore.open(spark, store.path).read().collect()}
    assert len(found) == 101 and found[5] == ("b", 2) and found[6] == ("a", 1) and found[200] == ("b", 2)


def scores(spark, root, name, rows):
    schema = f"id bigint, {name}_positive boolean, {name}_confidence double, {name}_at timestamp"
    frame = spark.createDataFrame(rows, schema.replace("timestamp", "bigint"))
    frame = frame.withColumn(f"{name}_at", F.timestamp_seconds(F.col(f"{name}_at") + 1_700_000_000))
    frame.coalesce(1).write.mode("append").parquet(f"{root}/{name}")
    return frame.schema


def test_joined_scorers_with_late_and_missing_partners(spark, folder):
    found, state = [], []
    # Record 1 has both scores at once, 2 gets its second one late but in time, 3 never, 4 far too late.
    batches = [
        ([(1, True, 0.9, 0), (2, True, 0.6, 0), (3, True, 0.9, 0), (4, True, 0.9, 0)], [(1, False, 0.8, 0)]),
        ([], [(2, False, 0.6, 300)]),
        ([(9, True, 0.7, 9000)], [(9, False, 0.7, 9000)]),
        ([(10, True, 0.7, 9001)], [(4, False, 0.99, 10), (10, True, 0.5, 9001)]),
    ]
    for a, b in batches:
        schemas = [scores(spark, folder, name, rows) for name, rows in (("a", a), ("b", b))]
        sides = [read_intake_stream(spark, f"{folder}/{n}", s) for n, s in zip("ab", schemas, strict=True)]
        joined = flows.arbitrate_streams(*sides, ["a", "b"], ["a_at", "b_at"])
        query = flows.start_append(joined, f"{folder}/out", f"{folder}/checkpoint")
        query.awaitTermination()
        found = {r.id: r.positive for r in spark.read.parquet(f"{folder}/out").collect()}
        state.append(query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"])
    # A tie goes to the later model.
    assert found == {1: True, 2: False, 9: False, 10: True}
    assert state[-1] < 6  # records 1 to 4 have left the state


def test_counters_of_a_stream(spark, folder):
    schema = spark.createDataFrame([], "id bigint, positive boolean").schema
    for i in range(3):
        land(spark, [(10 * i + k, k == 0) for k in range(5)], schema, f"{folder}/landing")
    listener = audit.listen(spark)
    stream = read_intake_stream(spark, f"{folder}/landing", schema, max_files=1)
    query = flows.start_append(audit.observed(stream, "x", positive="positive"), f"{folder}/out", f"{folder}/c")
    query.awaitTermination()
    listener.wait_for(query)
    spark.streams.removeListener(listener)
    assert [b["n"] for b in listener.batches("x") if b["n"]] == [5, 5, 5]
    assert listener.totals("x") == {"n": 15, "min_id": 0, "max_id": 24, "n_positive": 3}
    assert listener.totals("nothing") == {}


def test_admission_bounds_each_batch(spark, folder):
    schema = spark.createDataFrame([], FRESH).schema
    for i in range(7):
        land(spark, [(10 * i + k, 1) for k in range(i + 1)], FRESH, f"{folder}/landing")
    landed = read_intake_stream(spark, f"{folder}/landing", schema, max_files=2)
    query = flows.start_append(landed, f"{folder}/out", f"{folder}/checkpoint")
    query.awaitTermination()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [3, 7, 11, 7]
    assert spark.read.parquet(f"{folder}/out").count() == 28


def test_queries_run_in_several_batches(spark, sf_dir):
    assert online.stream_batches(spark, sf_dir).count() == online.ARRIVALS


def test_batches_are_built_by_many_tasks(spark, sf_dir, folder, monkeypatch):
    made = spark.range(0, 1000, 1, 8).withColumn("age", F.spark_partition_id())
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in INTAKE if f.name not in ("id", "age")]
    made = made.select("id", "age", *rest).select(*INTAKE.names)
    monkeypatch.setattr(online.views, "records", lambda *_: made)
    monkeypatch.setattr(online, "run_dir", lambda *_: folder)
    sizes = online.stream_batches(spark, sf_dir).collect()
    assert sorted((r.batch, r.n) for r in sizes) == [(i, 250) for i in range(4)]
    landed = spark.read.parquet(f"{folder}/landing")
    assert len(landed.inputFiles()) == 4
    # Each row tells which task built it; one task alone would have called itself 0.
    assert {r.age for r in landed.select("age").distinct().collect()} == set(range(8))

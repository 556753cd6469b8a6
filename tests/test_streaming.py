from __future__ import annotations

import pytest

from riskflow.operators.encode import encode
from riskflow.operators.upsert import latest_by_key
from riskflow.operators.validate import validate_records
from riskflow.operators.verdict import verdicts
from riskflow.plans import jobs, queries, views
from riskflow.schema import INTAKE, without_steps
from riskflow.sources.readers import read_intake_stream
from riskflow.streaming import flows

RULES = without_steps()


@pytest.fixture(scope="module")
def landing(spark, sf_dir, tmp_path_factory):
    """Intake in five files, so that a stream takes it in several micro-batches."""
    path = str(tmp_path_factory.mktemp("landing") / "files")
    views.records(spark, sf_dir).repartition(5, "id").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    return queries.fitted_models(spark, sf_dir)


def stream(spark, landing):
    return read_intake_stream(spark, landing, INTAKE, max_files=2)


def test_stream_scores_equal_batch_scores(spark, landing, models, tmp_path):
    records = flows.accepted_stream(stream(spark, landing), RULES)
    query = flows.start_scoring(records, models, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    query.awaitTermination()
    assert len([p for p in query.recentProgress if p["numInputRows"] > 0]) == 3
    accepted, _ = validate_records(spark.read.parquet(landing), RULES)
    batch = verdicts(accepted, models)
    streamed = spark.read.parquet(f"{tmp_path}/out")
    assert streamed.columns == batch.columns
    assert streamed.exceptAll(batch).count() == batch.exceptAll(streamed).count() == 0


def test_a_micro_batch_is_scored_in_the_stated_number_of_tasks(spark, landing, models, tmp_path):
    accepted = flows.accepted_stream(read_intake_stream(spark, landing, INTAKE), RULES)
    for parts in (None, 7):
        out = f"{tmp_path}/out-{parts}"
        flows.start_scoring(accepted, models, out, f"{out}-checkpoint", partitions=parts).awaitTermination()
    dealt = spark.read.parquet(f"{tmp_path}/out-7")
    assert len(dealt.inputFiles()) == 7
    plain = spark.read.parquet(f"{tmp_path}/out-None")
    assert dealt.exceptAll(plain).count() == plain.exceptAll(dealt).count() == 0


def test_tasks_that_score_a_stream_grow_with_the_records(spark, sf_dir, monkeypatch):
    """They followed the files: one task for a table that came as one file."""
    queries.fitted_models(spark, sf_dir)
    monkeypatch.setattr(jobs, "PARTITION_ROWS", 20)
    n = views.records(spark, sf_dir).count()
    scored = queries.stream_score(spark, sf_dir)
    assert len(scored.inputFiles()) == -(-n // 20) > 32
    one_file = queries.score_ensemble(spark, sf_dir)
    assert one_file.rdd.getNumPartitions() > 32


def test_rejected_rows_are_kept(spark, landing, tmp_path):
    rejected = flows.rejected_stream(stream(spark, landing), RULES)
    flows.start_append(rejected, f"{tmp_path}/out", f"{tmp_path}/checkpoint").awaitTermination()
    _, expected = validate_records(spark.read.parquet(landing), RULES)
    assert spark.read.parquet(f"{tmp_path}/out").count() == expected.count() > 0


def test_restart_appends_nothing_twice(spark, landing, tmp_path):
    counts = []
    for _ in range(2):
        flows.start_change_log(
            stream(spark, landing), f"{tmp_path}/log", f"{tmp_path}/checkpoint"
        ).awaitTermination()
        counts.append(spark.read.parquet(f"{tmp_path}/log").count())
    assert counts[0] == counts[1] == spark.read.parquet(landing).count()


def test_change_log_resolves_to_the_last_version(spark, tmp_path):
    schema = "id bigint, v string, at bigint"
    log, landing = f"{tmp_path}/log", f"{tmp_path}/landing"
    for rows in ([(1, "a", 1), (2, "a", 2)], [(1, "b", 3), (3, "a", 4)]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        source = read_intake_stream(spark, landing, spark.createDataFrame([], schema).schema)
        flows.start_change_log(source, log, f"{tmp_path}/checkpoint").awaitTermination()
    flows.compact(spark.read.parquet(log), f"{tmp_path}/snapshot", ["at"])
    found = sorted(tuple(row) for row in spark.read.parquet(f"{tmp_path}/snapshot").collect())
    assert found == [(1, "b", 3), (2, "a", 2), (3, "a", 4)]
    assert spark.read.parquet(log).count() == 4


def test_stateful_upsert_agrees_with_the_change_log(spark, sf_dir):
    events = read_intake_stream(spark, f"{sf_dir}/events.parque[t]", queries._EVENTS)
    query = (
        latest_by_key(events, "user_id", ["ts", "event_id"])
        .writeStream.format("memory")
        .queryName("latest_events")
        .outputMode("complete")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    columns = list(queries.EVENT_COLUMNS)
    stateful = spark.table("latest_events").select(*columns)
    assert sorted(stateful.collect()) == sorted(queries.upsert_latest(spark, sf_dir).collect())


def test_fanout_runs_each_branch_over_all_records(spark, landing, tmp_path):
    records = flows.accepted_stream(stream(spark, landing), RULES)
    branches = {"stored": lambda df: df, "encoded": lambda df: encode(df).select("id", "features")}
    for query in flows.start_fanout(records, branches, str(tmp_path)).values():
        query.awaitTermination()
    stored, encoded = (spark.read.parquet(f"{tmp_path}/{name}") for name in branches)
    assert stored.count() == encoded.count() == stored.join(encoded, "id").count()


def test_one_file_table_as_stream(spark, sf_dir, tmp_path):
    assert queries.stream_export(spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/events.parquet").count()

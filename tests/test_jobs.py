from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow import workspace
from riskflow.operators.train import train_forest
from riskflow.plans import jobs, online, queries, views
from riskflow.plans.jobs import score_batch, train_job, training_side, write_training_table
from riskflow.schema import INTAKE, without_steps
from riskflow.sources.readers import load_model


def test_train_job(spark, sf_dir, folder):
    options = {
        "forest": {"trees": 5, "depth": 4},
        "gbt": {"iterations": 2, "depth": 3, "weights": "weights"},
        "svc": {"iterations": 5},
    }
    records = views.intake(spark, sf_dir)
    trained = train_job(spark, records, folder, tuple(options), options, raw_areas=True)
    for kind, result in trained.items():
        assert result.hard["auroc"] > 0.7 and result.raw["auroc"] > 0.7
        assert load_model(kind, result.path).numFeatures == 16
    again = train_job(spark, records, folder, ("forest",), options)
    assert again["forest"].hard == trained["forest"].hard


def test_score_batch(spark, sf_dir, submissions, records, folder):
    submitted = submissions(
        {"id": "1", "age": "30"},
        {"id": None, "age": "40"},
        {"id": "-1", "age": "50"},
        {"id": "5", "age": "old"},
    ).withColumn("seq", F.monotonically_increasing_id())
    store = records({"id": 1, "age": 99}, {"id": 2})
    models = queries.fitted_models(spark, sf_dir)
    result = score_batch(spark, submitted, store, models, folder, order="seq", rules=without_steps())

    stored = {row.id: row.age for row in result.stored.collect()}
    assert stored == {1: 30, 2: 61, 3: 40, 4: 50}
    assert result.stored.schema == INTAKE
    assert sorted(row.id for row in result.verdicts.collect()) == [1, 3, 4]
    assert [(row.id, row.reason) for row in result.rejected.collect()] == [("5", "age:type")]
    assert spark.read.parquet(result.paths["numbered"]).count() == 3


def test_scratch_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert workspace.scratch_root(spark) == configured.rstrip("/")
        assert workspace.run_dir(spark, "x").startswith(configured.rstrip("/"))


def test_partitions_grow_with_the_rows(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(jobs, "PARTITION_ROWS", 50)
    path = write_training_table(spark, views.intake(spark, sf_dir))
    side = training_side(spark, path, "train", 8)
    n = side.count()
    assert n > 400 and side.rdd.getNumPartitions() == -(-n // 50)
    assert training_side(spark, path, "train", n).rdd.getNumPartitions() == n
    encoded = online._encoded(spark, sf_dir)
    n = encoded.count()
    assert encoded.rdd.getNumPartitions() == -(-n // 50)


def _part_sizes(side):
    return [r["count"] for r in side.groupBy(F.spark_partition_id()).count().collect()]


@pytest.mark.parametrize("missing", [None, -1])
def test_rows_without_id_do_not_share_a_task(spark, sf_dir, monkeypatch, missing):
    """By id they were all in one part, however many there are."""
    monkeypatch.setattr(jobs, "PARTITION_ROWS", 50)
    records = views.intake(spark, sf_dir).withColumn("id", F.lit(missing).cast("bigint"))
    path = write_training_table(spark, records)
    # The side is drawn by the id, if there is one: all rows with -1 are on one side.
    sizes = [n for side in ("train", "test") for n in _part_sizes(training_side(spark, path, side, 2))]
    assert sum(sizes) == spark.read.parquet(path).count() > 400
    assert max(sizes) < 100


def test_forest_keeps_no_table_of_node_ids(spark, sf_dir):
    side = training_side(spark, write_training_table(spark, views.intake(spark, sf_dir)), "train", 4)
    forest = train_forest(side, trees=5, depth=5)
    assert not forest.getCacheNodeIds()
    cached = train_forest(side, trees=5, depth=5, cacheNodeIds=True)
    assert forest.toDebugString.split("\n", 1)[1] == cached.toDebugString.split("\n", 1)[1]


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)


class _Session:
    def __init__(self, **conf):
        self.conf = _Conf({key.replace("_", "."): value for key, value in conf.items()})


def test_no_local_folder_on_a_cluster():
    assert workspace.scratch_root(_Session(spark_checkpoint_dir="hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        workspace.scratch_root(_Session(spark_master="yarn"))

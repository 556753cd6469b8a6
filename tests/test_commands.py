from __future__ import annotations

import glob
import json

from pyspark.sql import functions as F

from riskflow.__main__ import main
from riskflow.functions.records import record_json
from riskflow.operators.store import RecordStore
from riskflow.operators.validate import drop_incomplete
from riskflow.plans import queries, views
from riskflow.plans.jobs import train_job
from riskflow.schema import TRAINING
from riskflow.sources.readers import load_model
from riskflow.sources.writers import save_training_csv


def test_train_from_csv(spark, sf_dir, tmp_path, capsys):
    intake = views.intake(spark, sf_dir).select(*TRAINING.fieldNames())
    save_training_csv(intake, f"{tmp_path}/csv")
    main(["train", "--csv", f"{tmp_path}/csv", "--out", f"{tmp_path}/models", "--kinds", "svc"])
    areas = json.loads(capsys.readouterr().out)
    assert areas["svc"]["auroc"] > 0.5
    assert load_model("svc", f"{tmp_path}/models/svc").numFeatures == 16
    options = {"svc": {}}
    same = train_job(spark, intake, f"{tmp_path}/again", ("svc",), options)
    assert same["svc"].hard == areas["svc"]


def rounded(spark, sf_dir):
    """Complete records on the form's 0.1 grid."""
    return (
        drop_incomplete(views.records(spark, sf_dir))
        .withColumn("avg_glucose_level", F.round("avg_glucose_level", 1))
        .withColumn("bmi", F.round("bmi", 1))
    )


def test_score_serve_review_export(spark, sf_dir, tmp_path, capsys):
    paths = queries._model_paths(spark, sf_dir, queries.ENSEMBLE)
    models = paths["forest"].rsplit("/", 1)[0]
    records = rounded(spark, sf_dir)

    submitted = records.withColumn("seq", F.col("id")).drop("id")
    lines = submitted.select(record_json(tuple(submitted.columns)).alias("value"))
    broken = spark.createDataFrame([('{"gender": "Ma',), ("x",)], "value string")
    lines.unionByName(broken).write.text(f"{tmp_path}/in")
    main(["score", "--submitted", f"{tmp_path}/in", "--models", models, "--out", f"{tmp_path}/out"])
    written = json.loads(capsys.readouterr().out)
    stored = spark.read.parquet(written["store"])
    n = stored.count()
    assert n == spark.read.parquet(written["verdicts"]).count() == written["counters"]["n"] > 0
    assert stored.agg(F.min("id"), F.max("id") + 1 - F.count("*")).first() == (0, 0)
    assert sorted(r.value for r in spark.read.text(written["malformed"]).collect()) == ["x", '{"gender": "Ma']

    # The same submissions as a form sends them: without an id, and in two instalments.
    live = f"{tmp_path}/live"
    for half in (0, 1):
        part = submitted.where(F.pmod("seq", F.lit(2)) == half).drop("seq")
        part.select(record_json(tuple(part.columns)).alias("value")).write.mode("append").text(f"{tmp_path}/landing")
        broken.write.mode("append").text(f"{tmp_path}/landing")
        main(["serve", "--landing", f"{tmp_path}/landing", "--models", models, "--out", live, "--once"])
        totals = json.loads(capsys.readouterr().out)
        assert totals["accepted"]["n"] == totals["scored"]["n"]
    judged = spark.read.parquet(f"{live}/judged")
    assert judged.count() == records.count() + 4
    assert judged.where("reason = 'line:malformed'").count() == 4
    decided = spark.read.parquet(f"{live}/verdicts")
    kept = RecordStore.open(spark, f"{live}/store").read()
    assert kept.count() == decided.count() == decided.select("id").distinct().count() == n
    assert kept.agg(F.min("id"), F.max("id")).first() == (0, n - 1)

    for store in (written["store"], f"{live}/store"):
        main(["review", "--store", store])
        assert "n_waiting" in capsys.readouterr().out
        main(["export", "--store", store, "--id", "3", "--out", f"{tmp_path}/export"])
        assert json.loads(capsys.readouterr().out.splitlines()[1]) == {"n": 1, "min_id": 3, "max_id": 3}
    assert len(glob.glob(f"{tmp_path}/export/3_*.bin.gz/*.gz")) == 2

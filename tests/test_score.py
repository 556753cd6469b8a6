from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from riskflow.functions.display import risk_message
from riskflow.operators.encode import encode, training_set
from riskflow.operators.metrics import evaluate_hard, evaluate_raw
from riskflow.operators.score import arbitrate, arbitrate_joined, score, score_class
from riskflow.operators.split import hash_split
from riskflow.operators.train import train_svc
from riskflow.operators.validate import drop_incomplete
from riskflow.operators.verdict import verdicts
from riskflow.plans import queries, views


def pairs(spark, rows):
    columns = "id int, a_positive boolean, a_confidence double, b_positive boolean, b_confidence double"
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], columns)


def test_more_confident_model_decides_and_ties_go_to_the_second(spark):
    df = pairs(spark, [(True, 0.9, False, 0.8), (True, 0.7, False, 0.8), (True, 0.8, False, 0.8)])
    decided = {row.id: row.positive for row in arbitrate(df, ["a", "b"]).collect()}
    assert decided == {0: True, 1: False, 2: False}
    first, second = df.select("id", "a_positive", "a_confidence"), df.drop("a_positive", "a_confidence")
    joined = arbitrate_joined(first, second, ["a", "b"], "id")
    assert {row.id: row.positive for row in joined.collect()} == decided


def test_three_models(spark):
    df = pairs(spark, [(True, 0.9, False, 0.8), (True, 0.7, True, 0.8), (True, 0.6, True, 0.6)])
    df = df.withColumns({"c_positive": F.lit(False), "c_confidence": F.lit(0.8)})
    decided = arbitrate(df, ["a", "b", "c"]).orderBy("id").collect()
    assert [row.positive for row in decided] == [True, False, False]


def test_message(spark):
    rows = spark.createDataFrame([(True,), (False,)], "p boolean").select(risk_message("p"))
    high, low = [row[0] for row in rows.collect()]
    assert high.startswith("You have a high chance") and low.endswith("are low.")


@pytest.fixture(scope="module")
def models(spark, sf_dir):
    return queries.fitted_models(spark, sf_dir)


@pytest.fixture(scope="module")
def complete(spark, sf_dir):
    return drop_incomplete(views.records(spark, sf_dir))


def test_each_record_is_scored_once(complete, models):
    scored = verdicts(complete, models)
    counts = scored.agg(
        F.count("*").alias("n"),
        F.countDistinct("id").alias("ids"),
        F.min(F.least("forest_confidence", "gbt_confidence")).alias("low"),
        F.max(F.greatest("forest_confidence", "gbt_confidence")).alias("high"),
        F.count_if("positive").alias("positives"),
    ).first()
    assert counts.n == counts.ids == complete.count()
    assert 0.5 <= counts.low <= counts.high <= 1.0
    assert 0 < counts.positives < counts.n


def test_class_and_confidence_equal_the_models_own_answer(complete, models):
    encoded = encode(complete)
    mine = {row.id: row for row in score(encoded, models).collect()}
    for name, model in models.items():
        for row in encoded.select("id", "features").limit(25).collect():
            prediction = model.predict(row.features)
            probability = model.predictProbability(row.features)
            assert mine[row.id][f"{name}_positive"] == (prediction != 0.0)
            assert mine[row.id][f"{name}_confidence"] == pytest.approx(probability[int(prediction)])


def test_verdict_is_the_more_confident_side(complete, models):
    for row in verdicts(complete, models).collect():
        forest_wins = row.forest_confidence > row.gbt_confidence
        assert row.positive == (row.forest_positive if forest_wins else row.gbt_positive)


def test_models_learn_the_label(spark):
    """At sf0.01; the smallest tables have too few positive records to learn from."""
    larger = "/root/testdata/sf0.01"
    _, test = hash_split(training_set(views.intake(spark, larger)))
    models = queries.fitted_models(spark, larger)
    assert evaluate_hard(models["forest"].transform(test))["auroc"] > 0.8
    # Unweighted, the boosted trees rank well but call few records positive.
    for model in models.values():
        assert evaluate_raw(model.transform(test))["auroc"] > 0.8


def test_svm_gives_classes_but_no_confidence(spark, sf_dir):
    train, test = hash_split(training_set(views.intake(spark, sf_dir)))
    model = train_svc(train.withColumn("weights", F.lit(1.0)), iterations=5)
    assert score_class(test, "svc", model).columns == ["id", "features", "label", "svc_positive"]
    with pytest.raises(ValueError, match="no confidence"):
        score(test, {"svc": model})

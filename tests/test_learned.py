from __future__ import annotations

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from riskflow.operators.learned import (
    CategoryIndex,
    WideEncoder,
    impute_mean,
    impute_mode,
    index_categories,
    learned_encoder,
    wide_encoder,
)
from riskflow.plans import views
from riskflow.plans.queries import QUERIES


def test_impute(spark):
    df = spark.createDataFrame([(1.0, 1), (3.0, 1), (None, None), (5.0, 0)], "x double, k int")
    assert [row.x for row in impute_mean(df, ["x"]).transform(df).collect()] == [1.0, 3.0, 3.0, 5.0]
    assert [row.k for row in impute_mode(df, ["k"]).transform(df).collect()] == [1, 1, 1, 0]


def test_index_by_count_then_name(spark):
    df = spark.createDataFrame([(v,) for v in "cbbaad"], "v string")
    indexed = index_categories(df, ["v"]).transform(df)
    assert {row.v: row.v_idx for row in indexed.collect()} == {"a": 0.0, "b": 1.0, "c": 2.0, "d": 3.0}


def test_a_column_may_have_any_number_of_categories(spark):
    df = spark.range(15000).select(F.format_string("%05d", "id").alias("v"))
    indexed = index_categories(df, ["v"]).transform(df)
    assert indexed.where("v_idx <> CAST(v AS DOUBLE)").count() == 0 and indexed.count() == 15000


def test_unknown_category(spark):
    df = spark.createDataFrame([("a",)], "v string")
    other = spark.createDataFrame([("b",)], "v string")
    assert index_categories(df, ["v"], "keep").transform(other).first().v_idx is None
    with pytest.raises(PySparkException, match="unknown v: b"):
        index_categories(df, ["v"]).transform(other).collect()


def test_null_category_becomes_the_commonest(spark, records):
    df = records({"id": 1}, {"id": 2}, {"id": 3, "gender": "Male"}, {"id": 4, "gender": None})
    rows = {row.id: row.features for row in learned_encoder(df).transform(df).collect()}
    assert rows[4] == rows[1] != rows[3]


def test_encoder_is_saved_as_a_whole(spark, records, folder):
    df = records({"id": 1}, {"id": 2, "work_type": "children"}, {"id": 3, "gender": "Male", "bmi": None})
    model = learned_encoder(df)
    model.write().save(folder)
    loaded = PipelineModel.load(folder)
    expected = {row.id: row.features for row in model.transform(df).collect()}
    assert {row.id: row.features for row in loaded.transform(df).collect()} == expected
    # two numerics as given, bmi imputed; one slot each for the two varying categories
    assert expected[3].size == 5 and expected[3][1] == pytest.approx(28.1)


def features_by_hand(rows):
    """Means and commonest categories in the gaps; one slot for each category but the rarest."""
    numeric = ["avg_glucose_level", "bmi", "age"]
    categorical = ["gender", "hypertension", "heart_disease", "ever_married", "work_type", "Residence_type", "smoking_status"]
    for name in numeric:
        known = [row[name] for row in rows if row[name] is not None]
        mean = sum(known) / len(known)
        rows = [{**row, name: mean if row[name] is None else row[name]} for row in rows]
    slots = {}
    for name in categorical:
        known = Counter(row[name] for row in rows if row[name] is not None)
        mode = min(known, key=lambda value: (-known[value], value))
        rows = [{**row, name: mode if row[name] is None else row[name]} for row in rows]
        filled = Counter(str(row[name]) for row in rows)
        slots[name] = sorted(filled, key=lambda value: (-filled[value], value))[:-1]
    return {
        row["id"]: [row[name] for name in numeric]
        + [float(str(row[name]) == slot) for name in categorical for slot in slots[name]]
        for row in rows
    }


def test_encoder_fills_the_gaps_of_all_records(spark, sf_dir):
    rows = [row.asDict() for row in views.records(spark, sf_dir).collect()]
    for row in rows:
        row["smoking_status"] = row["smoking_status"] if row["id"] % 11 else None
        row["hypertension"] = row["hypertension"] if row["id"] % 13 else None
    assert all(any(row[name] is None for row in rows) for name in ("bmi", "smoking_status", "hypertension"))
    expected = features_by_hand(rows)
    found = QUERIES["learned_encoder_filled"](spark, sf_dir).collect()
    assert len(found) == len(rows) == len(expected)
    for row in found:
        assert row.features == pytest.approx(expected[row.id], abs=2e-6)


def test_wide_encoder_equals_the_pipeline(spark, sf_dir):
    df = views.records(spark, sf_dir).withColumns(
        {
            "smoking_status": F.expr("CASE WHEN id % 11 <> 0 THEN smoking_status END"),
            "hypertension": F.expr("CASE WHEN id % 13 <> 0 THEN hypertension END"),
        }
    )
    encoder = wide_encoder(df)
    wide = encoder.transform(df)
    assert wide.columns == [*df.columns, "features"]
    expected = {row.id: row.features.toArray() for row in learned_encoder(df).transform(df).collect()}
    found = {row.id: row.features.toArray() for row in wide.select("id", "features").collect()}
    assert set(found) == set(expected)
    assert all(len(v) == encoder.width and v == pytest.approx(expected[k]) for k, v in found.items())


def test_wide_encoder_is_saved_and_loaded(spark, folder):
    df = spark.createDataFrame(
        [(1, 2.0, "a"), (2, float("nan"), "b"), (3, 0.0, None), (4, None, "a"), (5, 4.0, "c"), (5, 4.0, "c")],
        "id int, `x.y` double, `k l` string",
    )
    wide_encoder(df, ["x.y"], ["k l"], "keep").save(spark, folder)
    encoder = WideEncoder.load(spark, folder)
    other = df.unionByName(spark.createDataFrame([(6, 1.0, "new")], df.schema))
    rows = {row.id: row.features for row in encoder.transform(other).collect()}
    # a and c come twice, so a is first, and so stands for null; b, the rarest, has no slot
    assert {i: v.toArray().tolist() for i, v in rows.items()} == {
        1: [2.0, 1.0, 0.0], 2: [2.5, 0.0, 0.0], 3: [0.0, 1.0, 0.0], 4: [2.5, 1.0, 0.0], 5: [4.0, 0.0, 1.0], 6: [1.0, 0.0, 0.0],
    }
    assert encoder.transform(df.limit(0)).count() == 0


def test_category_index_is_saved_and_loaded(spark, folder):
    df = spark.createDataFrame([(v, v) for v in "cbbaad"], "v string, w string")
    index_categories(df, ["v", "w"]).save(spark, folder)
    rows = CategoryIndex.load(spark, folder).transform(df).collect()
    assert {row.v: (row.v_idx, row.w_idx) for row in rows} == {c: (float(i),) * 2 for i, c in enumerate("abcd")}
    with pytest.raises(PySparkException, match="unknown w: e"):
        CategoryIndex.load(spark, folder).transform(spark.createDataFrame([("a", "e")], df.schema)).collect()


def test_wide_encoder_needs_a_value_of_each_number(spark):
    df = spark.createDataFrame([(None, "a")], "x double, k string")
    with pytest.raises(ValueError, match="no value to fill the gaps of x"):
        wide_encoder(df, ["x"], ["k"])


def test_wide_encoder_without_python_workers(spark, sf_dir):
    plan = QUERIES["learned_encoder_wide"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan

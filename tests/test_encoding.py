from __future__ import annotations

import pytest
from pyspark.errors import PySparkException

from riskflow.operators.encode import (
    encode,
    encode_wide,
    feature_ranges,
    labelled_set,
    training_set,
    vector_widths,
)
from riskflow.schema import (
    SERVING_SPEC,
    SMOKING_STATES,
    TRAINING_SPEC,
    WORK_TYPES,
    Binary,
    EncodingSpec,
    Numeric,
    OneHot,
)


def vectors(df, spec=SERVING_SPEC):
    return [row.features.toArray().tolist() for row in encode(df, spec).collect()]


def test_layout_is_sixteen_wide():
    assert SERVING_SPEC.width == TRAINING_SPEC.width == 16


def test_one_record(records):
    expected = [0, 61, 0, 1, 1, 0, 0, 0, 1, 0, 1, 95.5, 28.1, 0, 1, 0]
    assert vectors(records({})) == [expected]


def test_each_category(records):
    changes = [{"work_type": value} for value in WORK_TYPES]
    for position, vector in enumerate(vectors(records(*changes))):
        assert vector[5:10] == [1.0 if i == position else 0.0 for i in range(5)]
    slots = {"formerly smoked": 0, "smokes": 1, "never smoked": 2, "Unknown": 2}
    states = [*SMOKING_STATES, "Unknown"]
    for state, vector in zip(states, vectors(records(*[{"smoking_status": s} for s in states]))):
        assert vector[13:] == [1.0 if i == slots[state] else 0.0 for i in range(3)]
    male, single, rural = vectors(
        records({"gender": "Male"}, {"ever_married": "No"}, {"Residence_type": "Rural"})
    )
    assert (male[0], single[4], rural[10]) == (1.0, 0.0, 0.0)


def test_third_gender_counts_as_one_in_training_and_fails_in_serving(records):
    df = records({"gender": "Other"})
    assert vectors(df, TRAINING_SPEC)[0][0] == 1.0
    with pytest.raises(PySparkException, match="cannot encode gender: Other"):
        vectors(df, SERVING_SPEC)


@pytest.mark.parametrize("spec", [SERVING_SPEC, TRAINING_SPEC])
@pytest.mark.parametrize("field", ["work_type", "ever_married"])
def test_unknown_category_fails(records, spec, field):
    with pytest.raises(PySparkException, match=f"cannot encode {field}: other"):
        vectors(records({field: "other"}), spec)


def test_tolerant_fields(records):
    unknown_home, no_home, no_smoking = vectors(
        records({"Residence_type": "Moon"}, {"Residence_type": None}, {"smoking_status": None})
    )
    assert unknown_home[10] == no_home[10] == 0.0
    assert no_smoking[13:] == [0.0, 0.0, 1.0]


def test_null_number_is_not_read_as_zero(records):
    with pytest.raises(PySparkException, match="cannot encode bmi: null"):
        vectors(records({"bmi": None}))


def test_each_one_hot_slot_is_checked_by_itself(records):
    wide = encode_wide(records({"work_type": "other"}), ["id"])
    for name in ("f05", "f07", "f09"):
        with pytest.raises(PySparkException, match="cannot encode work_type"):
            wide.select(name).collect()


def test_wide_form_equals_vector(records):
    df = records({}, {"gender": "Male", "work_type": "children", "id": 8})
    wide = [list(row)[1:] for row in encode_wide(df, ["id"]).orderBy("id").collect()]
    assert wide == vectors(df.orderBy("id"))


def test_ranges_and_widths(records):
    df = records({"age": 20}, {"age": 80})
    row = feature_ranges(df).first()
    assert (row.f01_min, row.f01_max) == (20.0, 80.0)
    assert tuple(vector_widths(encode(df)).first()) == (2, 16, 16)


def test_own_spec(records):
    spec = EncodingSpec(
        (Numeric("age"), Binary("gender", (("Female", 1.0),), unknown=-1.0), OneHot("work_type", ("Private",), unknown="catch_all"))
    )
    assert spec.width == 4
    assert vectors(records({}, {"gender": "x", "work_type": "y"}), spec) == [
        [61.0, 1.0, 1.0, 0.0],
        [61.0, -1.0, 0.0, 1.0],
    ]


def test_label_stays_in_its_row(spark, records):
    df = records({"id": 1}, {"id": 2, "bmi": None}, {"id": 3, "gender": "Other"})
    labelled = df.selectExpr("*", "cast(id % 2 as int) as stroke")
    assert labelled_set(labelled).columns[-1] == "label"
    rows = {row.id: row.label for row in training_set(labelled).collect()}
    assert rows == {1: 1.0, 3: 1.0}

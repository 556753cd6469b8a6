from __future__ import annotations

import math

import pytest

from riskflow.operators.validate import (
    count_reasons,
    drop_incomplete,
    tag_records,
    validate_records,
)
from riskflow.schema import FORM_RULES, INTAKE, Rule, without_steps


CASES = [
    ({}, None),
    ({"age": "abc"}, "age:type"),
    ({"age": "12.5"}, "age:type"),
    ({"age": None}, "age:required"),
    ({"age": "0"}, "age:range"),
    ({"age": "120"}, None),
    ({"age": "121"}, "age:range"),
    ({"age": "99999999999"}, "age:type"),
    ({"gender": ""}, "gender:required"),
    ({"gender": "Other"}, "gender:domain"),
    ({"hypertension": "2"}, "hypertension:domain"),
    ({"heart_disease": "yes"}, "heart_disease:type"),
    ({"ever_married": "yes"}, "ever_married:domain"),
    ({"work_type": None}, "work_type:required"),
    ({"work_type": "Retired"}, "work_type:domain"),
    ({"Residence_type": "Moon"}, "Residence_type:domain"),
    ({"avg_glucose_level": "0.9"}, "avg_glucose_level:range"),
    ({"avg_glucose_level": "200"}, None),
    ({"avg_glucose_level": "100.25"}, "avg_glucose_level:step"),
    ({"avg_glucose_level": "NaN"}, "avg_glucose_level:range"),
    ({"bmi": "40.1"}, "bmi:range"),
    ({"bmi": "0"}, None),
    ({"bmi": "x"}, "bmi:type"),
    ({"smoking_status": "Unknown"}, "smoking_status:domain"),
    ({"id": None}, None),
    ({"id": "seven"}, "id:type"),
    ({"age": "abc", "bmi": None}, "age:type"),
]


def test_first_broken_rule(submissions):
    tagged = tag_records(submissions(*[change for change, _ in CASES]).coalesce(1))
    found = [row.reason for row in tagged.collect()]
    assert list(zip([change for change, _ in CASES], found)) == CASES


def test_every_tenth_is_on_the_step(submissions):
    df = submissions(*[{"avg_glucose_level": tenths / 10} for tenths in range(10, 2001)])
    assert count_reasons(tag_records(df)).collect() == [("ok", 1991)]


def test_nothing_is_lost(submissions):
    raw = submissions({}, {"age": "abc"}, {"bmi": None}, {"id": None})
    accepted, rejected = validate_records(raw)
    assert accepted.schema.simpleString() == INTAKE.simpleString()
    assert sorted(row.id for row in accepted.collect()) == [-1, 7]
    kept = {row.reason: row for row in rejected.collect()}
    assert set(kept) == {"age:type", "bmi:required"}
    assert kept["age:type"].age == "abc"


def test_streams_need_an_id(submissions):
    for value in (None, "-1"):
        assert tag_records(submissions({"id": value}), require_id=True).first().reason == "id:missing"
    assert tag_records(submissions({}), require_id=True).first().reason is None


def test_extra_columns_are_carried(submissions):
    raw = submissions({}).selectExpr("*", "17 as seq")
    accepted, _ = validate_records(raw)
    assert accepted.first().seq == 17


def test_without_steps(submissions):
    rules = without_steps()
    assert len(rules) < len(FORM_RULES)
    assert tag_records(submissions({"bmi": "20.123"}), rules).first().reason is None


def test_no_rules_and_unknown_rules(submissions):
    assert tag_records(submissions({"age": "abc"}), ()).first().reason is None
    with pytest.raises(ValueError, match="unknown rule kind"):
        tag_records(submissions({}), (Rule("age", "prime"),))


def test_count_reasons(submissions):
    raw = submissions({}, {}, {"age": "abc"})
    assert {row.reason: row.n for row in count_reasons(tag_records(raw)).collect()} == {
        "ok": 2,
        "age:type": 1,
    }


def test_drop_incomplete(records):
    df = records({"id": 1}, {"id": 2, "bmi": None}, {"id": 3, "gender": None}, {"id": 4, "bmi": math.nan})
    assert [row.id for row in drop_incomplete(df).collect()] == [1]
    assert drop_incomplete(df).collect() == df.na.drop(how="any").collect()

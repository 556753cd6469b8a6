from __future__ import annotations

import datetime as dt
import glob
import gzip
import json

from pyspark.sql import functions as F

from riskflow.functions.records import (
    export_name,
    json_path,
    parse_record,
    record_json,
    utf8_bytes,
    utf8_text,
)
from riskflow.operators.review import (
    audit,
    decode_for_review,
    lookup,
    lookup_many,
    review_page,
    review_summary,
    sample_one,
)
from riskflow.schema import INTAKE_COLUMNS, TRAINING
from riskflow.plans import views
from riskflow.sources.readers import (
    accepted_training,
    judge_training_csv,
    read_training_csv,
    rejected_training,
    scan_records,
)
from riskflow.sources.writers import export_folder, export_json_gz, save_records


def test_count_and_draw(records):
    df = records(*[{"id": i} for i in range(50)])
    row = review_summary(df, seed=1).first()
    assert row.n == 50
    assert sample_one(df, seed=1).first().id == row.sampled_id
    drawn = {review_summary(df.repartition(5), seed).first().sampled_id for seed in range(12)}
    assert len(drawn) > 4
    assert review_summary(df.repartition(7), seed=1).first() == row


def test_empty_store(records):
    empty = records({}).where("false")
    row = review_summary(empty, seed=1).first()
    assert (row.n, row.sampled_id) == (0, None)
    assert sample_one(empty, seed=1).collect() == []
    assert review_page(empty, seed=1).collect() == []


def test_review_page(records):
    df = records({"id": 1, "hypertension": 1, "work_type": "Govt_job"})
    row = review_page(df, seed=3).first()
    assert (row.hypertension, row.heart_disease, row.work_type, row.n_waiting) == (
        "Yes",
        "Yes",
        "Government job",
        1,
    )


def test_decode_falls_back(records):
    row = decode_for_review(records({"work_type": "anything", "hypertension": 5})).first()
    assert (row.work_type, row.hypertension) == ("Self-employed", "No")


def test_lookup(spark, records):
    df = records({"id": 1}, {"id": 2}, {"id": 3})
    assert sorted(row.id for row in lookup(df, [1, 3, 99]).collect()) == [1, 3]
    wanted = spark.createDataFrame([(2,), (2,), (8,)], "id bigint")
    assert [row.id for row in lookup_many(df, wanted).collect()] == [2]


def test_audit_counts_arrive_with_the_action(records):
    df, counters = audit(records({"id": 4}, {"id": 9}), "audit-test")
    df.write.format("noop").mode("overwrite").save()
    assert counters.get == {"n": 2, "min_id": 4, "max_id": 9}


def test_json_has_all_fields_in_order(records):
    text = records({}).select(record_json()).first()[0]
    assert list(json.loads(text)) == list(INTAKE_COLUMNS)
    assert json.loads(text)["id"] == 7
    back = records({}).select(parse_record(record_json()).alias("r")).select("r.*")
    assert back.collect() == records({}).collect()


def test_json_path_and_utf8(records):
    df = records({"gender": "Żółć", "bmi": None})
    text = record_json()
    row = df.select(
        json_path(text, "$.gender").alias("gender"),
        json_path(text, "$.bmi").alias("bmi"),
        utf8_bytes(F.col("gender")).alias("data"),
        utf8_text(utf8_bytes(F.col("gender"))).alias("text"),
    ).first()
    assert (row.gender, row.bmi, row.text) == ("Żółć", None, "Żółć")
    assert bytes(row.data) == "Żółć".encode()


def test_export_name(spark):
    row = spark.sql("select 12 as id, timestamp_ntz'2024-05-01 06:07:08.000009' as at")
    name = row.select(export_name(F.col("id"), F.col("at"))).first()[0]
    assert name == "12_2024-05-01_06:07:08.000009.bin.gz"
    folder = export_folder("out/", 12, dt.datetime(2024, 5, 1, 6, 7, 8, 9))
    assert folder == "out/12_2024-05-01_06-07-08.000009.bin.gz"


def test_export_is_gzipped_json_lines(spark, records, folder):
    export_json_gz(records({"id": 1}, {"id": 2}), folder)
    lines = []
    for path in glob.glob(f"{folder}/*.gz"):
        with gzip.open(path, "rt") as file:
            lines += [json.loads(line) for line in file]
    assert sorted(line["id"] for line in lines) == [1, 2]


def test_bulk_export_keeps_a_key_in_one_folder(spark, records, folder):
    export_json_gz(records(*[{"id": i} for i in range(40)]), folder, buckets=4)
    back = spark.read.text(folder)
    ids = back.select(json_path(F.col("value"), "$.id").alias("id"), "bucket")
    assert ids.count() == 40
    assert ids.select("bucket").distinct().count() == 4


def test_export_of_one_record(spark, records, tmp_path):
    df = records({"id": 1}, {"id": 2})
    path = export_folder(str(tmp_path), 2, dt.datetime(2024, 5, 1))
    export_json_gz(lookup(df, [2]), path)
    assert spark.read.text(path).select(json_path(F.col("value"), "$.id")).collect() == [("2",)]


def test_stored_records_keep_their_id(spark, records, folder):
    save_records(records({"id": 5}), folder)
    assert scan_records(spark, folder).collect() == records({"id": 5}).collect()


CSV = """id,gender,age,hypertension,heart_disease,ever_married,work_type,Residence_type,avg_glucose_level,bmi,smoking_status,stroke
1,Male,67,0,1,Yes,Private,Urban,228.69,36.6,formerly smoked,1
2,Female,61,0,0,Yes,Self-employed,Rural,202.21,N/A,never smoked,1
3,Other,5,0,0,No,children,Rural,80.1,,Unknown,0
"""


def test_training_csv(spark, tmp_path):
    path = tmp_path / "training.csv"
    path.write_text(CSV)
    df = read_training_csv(spark, str(path))
    assert df.schema == TRAINING
    assert {row.id: row.bmi for row in df.collect()} == {1: 36.6, 2: None, 3: None}
    inferred = read_training_csv(spark, str(path), schema=None)
    assert dict(inferred.dtypes)["bmi"] == "double"
    assert df.na.drop().count() == inferred.na.drop().count() == 1


def test_malformed_csv_rows_are_set_apart(spark, tmp_path):
    path = tmp_path / "bad.csv"
    names = "stroke,id,gender,age,hypertension,heart_disease,ever_married,work_type,Residence_type,avg_glucose_level,bmi,smoking_status,note"
    good = "1,7,Male,67,0,1,Yes,Private,Urban,228.69,N/A,smokes,x"
    bad = [
        good.replace("67", "old"),
        good.replace("228.69", "much").replace("N/A", "-"),
        "1,8,Male",
        good + ",more",
    ]
    path.write_text("\n".join([names, good, *bad]) + "\n")
    judged = judge_training_csv(spark, str(path))
    (accepted,) = accepted_training(judged).collect()
    assert (accepted.id, accepted.age, accepted.bmi, accepted.stroke) == (7, 67.0, None, 1.0)
    assert accepted_training(judged).schema == TRAINING
    rejected = {r.line: r.reason for r in rejected_training(judged).collect()}
    assert sorted(rejected.values()) == ["age:type", "avg_glucose_level:type", "line:malformed", "line:malformed"]
    assert rejected[bad[2]] == rejected[bad[3]] == "line:malformed"


def test_review_page_reads_the_key_once(spark, sf_dir):
    records = views.records(spark, sf_dir)
    page = review_page(records, 42)
    page.collect()
    plan = page._jdf.queryExecution().executedPlan().toString()
    # One aggregate over the key, used twice, and the fetch of the record.
    assert plan.count("min_by(") > 0 and "ReusedSubquery" in plan

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException

from riskflow.operators.ids import assign_ids, next_id, top_record


def frame(spark, rows):
    return spark.createDataFrame(rows, "seq bigint, id bigint")


def test_next_id(spark):
    assert next_id(frame(spark, [])).first().next_id == 0
    assert next_id(frame(spark, [(0, 4), (1, 9)])).first().next_id == 10


def test_top_record(spark):
    assert top_record(frame(spark, [(0, 4), (1, 9), (2, 5)])).collect()[0].seq == 1
    assert top_record(frame(spark, [])).collect() == []


def test_ids_follow_arrival_after_the_highest(spark):
    new = frame(spark, [(30, -1), (10, -1), (20, 50), (40, None)])
    store = frame(spark, [(0, 3)]).unionByName(new)
    rows = {row.seq: row.id for row in assign_ids(new, store, "seq").collect()}
    assert rows == {10: 51, 20: 50, 30: 52, 40: 53}


def test_empty_store_starts_at_zero(spark):
    new = frame(spark, [(5, -1), (6, -1)])
    rows = {row.seq: row.id for row in assign_ids(new, frame(spark, []), "seq").collect()}
    assert rows == {5: 0, 6: 1}


def test_no_record_to_number(spark):
    assert assign_ids(frame(spark, []), frame(spark, []), "seq").collect() == []
    kept = frame(spark, [(1, 8)])
    assert assign_ids(kept, kept, "seq").first().id == 8


def test_missing_order_fails(spark):
    new = frame(spark, [(1, -1), (2, -1), (None, -1)])
    with pytest.raises(PySparkException, match="has no seq"):
        assign_ids(new, frame(spark, []), "seq", buckets=4).collect()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.dictionaries(st.integers(-(10**12), 10**12), st.booleans(), min_size=1, max_size=40),
    partitions=st.integers(1, 6),
    buckets=st.sampled_from([1, 2, 7, 64]),
)
def test_numbering_is_dense_whatever_the_partitioning(spark, rows, partitions, buckets):
    data = [(seq, -1 if missing else 1000 + i) for i, (seq, missing) in enumerate(rows.items())]
    new = frame(spark, data).repartition(partitions)
    taken = [value for _, value in data if value >= 0]
    start = max(taken, default=-1) + 1
    result = {row.seq: row.id for row in assign_ids(new, new.where("id >= 0"), "seq", buckets=buckets).collect()}
    missing = sorted(seq for seq, value in data if value < 0)
    assert {seq: result[seq] for seq in missing} == {
        seq: start + i for i, seq in enumerate(missing)
    }
    assert len(result) == len(data)


def test_uneven_order_values(spark):
    """A third of all arrivals in one narrow band still number densely."""
    dense = spark.range(3000).selectExpr("1000000000 + id as seq", "cast(-1 as bigint) as id")
    sparse = spark.range(6000).selectExpr("id * 1000003 as seq", "cast(-1 as bigint) as id").where(
        "seq not between 1000000000 and 1000002999"
    )
    new = dense.unionByName(sparse)
    n = new.count()
    numbered = assign_ids(new, frame(spark, []), "seq", buckets=16)
    pairs = sorted((row.seq, row.id) for row in numbered.collect())
    assert [value for _, value in pairs] == list(range(n))

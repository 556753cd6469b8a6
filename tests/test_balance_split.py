from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskflow.functions.hashing import in_fraction
from riskflow.operators.balance import class_balance, with_class_weights
from riskflow.operators.split import hash_split


def labels(spark, values):
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "id int, label double")


def test_balance(spark):
    assert tuple(class_balance(labels(spark, [1, 0, 0, 1, 0])).first()) == (5, 2)


def test_weights(spark):
    weighted = with_class_weights(labels(spark, [1, 0, 0, 1, 0]))
    assert [row.weights for row in weighted.orderBy("id").collect()] == [2.5, 1.0, 1.0, 2.5, 1.0]


def test_no_positives(spark):
    weighted = with_class_weights(labels(spark, [0, 0]))
    assert [row.weights for row in weighted.collect()] == [1.0, 1.0]


def test_fraction_bounds(spark):
    ids = spark.range(500)
    assert ids.where(in_fraction("id", 0.0, 1)).count() == 0
    assert ids.where(in_fraction("id", 1.0, 1)).count() == 500


def test_sides_partition_the_rows(spark):
    df = spark.range(20_000)
    train, test = hash_split(df)
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 20_000
    assert abs(n_train / 20_000 - 0.7) < 0.02
    assert train.join(test, "id", "left_semi").count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(seed=st.integers(0, 10**6), partitions=st.integers(1, 9))
def test_side_does_not_depend_on_the_partitioning(spark, seed, partitions):
    df = spark.range(400)
    once = df.where(in_fraction("id", 0.7, seed)).agg(F.sort_array(F.collect_set("id"))).first()
    again = (
        df.repartition(partitions)
        .where(in_fraction("id", 0.7, seed))
        .agg(F.sort_array(F.collect_set("id")))
        .first()
    )
    assert once == again

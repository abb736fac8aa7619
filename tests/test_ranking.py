import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.ranking import magnitude_bucket, with_rank


def _expected(values):
    known = sorted((v for v in values if v is not None), reverse=True)
    return {v: known.index(v) + 1 for v in set(known)} | {None: len(known) + 1}


def _check(spark, values, partitions=5):
    df = spark.createDataFrame(list(enumerate(values)), "id int, value bigint")
    ranked = with_rank(df.repartition(partitions), F.col("value")).collect()
    expected = _expected(values)
    assert len(ranked) == len(values)
    assert all(row["rank"] == expected[row["value"]] for row in ranked)


@pytest.mark.parametrize(
    "values",
    [
        [5],
        [5, 5, 5],
        [3, 1, 2, 2, 9, 9, 9, 0],
        [0, -1, -5, 7, None, None, -5],
        [2**k + d for k in range(0, 62, 3) for d in (-1, 0, 1)],
        [10**15] * 50 + [10**15 - 1] * 50 + [1],
    ],
)
def test_rank_of_small_lists(spark, values):
    _check(spark, values)


def test_rank_of_random_values_with_many_ties(spark):
    draw = random.Random(7)
    values = [draw.randrange(1, 500) for _ in range(2_000)]
    values += [draw.randrange(1, 10**9) for _ in range(2_000)] + [424_242] * 2_000
    _check(spark, values, partitions=8)


def test_plain_rank_agrees(spark):
    df = spark.range(20_000).select("id", (F.hash("id") % 3_000).cast("bigint").alias("value"))
    df.createOrReplaceTempView("plain_rank_input")
    plain = spark.sql(
        "SELECT id, value, CAST(rank() OVER (ORDER BY value DESC) AS bigint) AS rank "
        "FROM plain_rank_input"
    )
    assert with_rank(df, F.col("value")).exceptAll(plain).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(2**62), 2**62), min_size=2, max_size=200))
def test_buckets_never_fall(spark, values):
    ordered = sorted(values)
    df = spark.createDataFrame([(v,) for v in ordered], "value bigint")
    buckets = [
        row[0] for row in df.select(magnitude_bucket(F.col("value")).alias("b")).collect()
    ]
    assert buckets == sorted(buckets)

"""Rank of every row by one number, without a window over the whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Buckets per power of two. 64 powers of two bound the number of buckets at
# 131,072 (both signs), whatever the data.
STEPS_LOG2 = 10


def magnitude_bucket(value: Column) -> Column:
    """Number of a BIGINT's bucket, never falling as the value rises.

    Buckets split each power of two into equal steps, as a floating-point
    format does, so they need no statistics of the data.
    """
    size = F.abs(value)
    power = F.length(F.bin(size)) - 1
    step = F.when(
        power > STEPS_LOG2, F.call_function("shiftright", size, power - STEPS_LOG2)
    ).otherwise(F.call_function("shiftleft", size, F.greatest(STEPS_LOG2 - power, F.lit(0))))
    bucket = (power + 1) * (1 << STEPS_LOG2) + step
    zero = F.lit(0).cast("bigint")
    return F.when(value > 0, bucket).when(value < 0, -bucket).when(value == 0, zero)


def with_rank(df: DataFrame, value: Column, name: str = "rank") -> DataFrame:
    """Add the competition rank (ties share it, gaps follow) by a descending BIGINT.

    Rank = 1 + rows in higher buckets + rows with a higher value in the same
    bucket. Both are counted on distinct values, so a value shared by many rows
    costs one row, and a bucket holds no more distinct values than its width.
    The only window without partitions runs over the bucket counts. NULL ranks
    last. The counts look at whole rows, by a digest of which nothing more is asked: so both uses
    of ``df`` need the same columns, and what is below its last shuffle runs once for both.
    """
    rows = df.withColumn("_value", value)
    digest = F.max(F.xxhash64(*df.columns)).alias("_digest")
    per_value = rows.groupBy("_value").agg(F.count(F.lit(1)).alias("ties"), digest)
    per_value = per_value.where(F.col("_digest").isNotNull()).drop("_digest")
    bucketed = per_value.withColumn(
        "bucket", F.coalesce(magnitude_bucket(F.col("_value")), F.lit(-(1 << 62)))
    )
    per_bucket = bucketed.groupBy("bucket").agg(F.sum("ties").alias("held"))
    downwards = Window.orderBy(F.desc("bucket")).rowsBetween(Window.unboundedPreceding, 0)
    higher = per_bucket.select(
        "bucket", (F.sum("held").over(downwards) - F.col("held")).alias("higher")
    )
    inside = (
        Window.partitionBy("bucket")
        .orderBy(F.desc("_value"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ranks = (
        bucketed.withColumn("before", F.sum("ties").over(inside) - F.col("ties"))
        .join(F.broadcast(higher), "bucket")
        .select(
            F.col("_value").alias("_ranked"),
            (F.col("higher") + F.col("before") + 1).alias(name),
        )
    )
    joined = rows.join(ranks, rows["_value"].eqNullSafe(ranks["_ranked"]))
    return joined.drop("_value", "_ranked")

"""Sums that meet other rows by their key, whatever share of the rows one key holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def per_key(rows: DataFrame, key: str, *sums: Column) -> DataFrame:
    """One row per key with its sums, to be joined to rows that hold a key many times.

    Sums combine on the map side, so here a key costs one row per task. The key is
    grouped inside a struct: a join then takes it for a column that is not partitioned
    yet, and shuffles both of its sides. Only such a join can be split: adaptive
    execution reads the partition of a key with too many partners by several tasks
    and gives each of them the key's one row. No key is looked for, listed or capped.
    """
    grouped = rows.groupBy(F.struct(key).alias("held")).agg(*sums)
    names = [c for c in grouped.columns if c != "held"]
    return grouped.select(F.col(f"held.{key}").alias(key), *names)

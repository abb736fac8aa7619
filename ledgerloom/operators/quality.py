"""Quality metrics, score, duplicate keys and orphan keys."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.rules import UNIQUE_METRIC, rules_for
from ledgerloom.schemas import PRIMARY_KEY, TABLES

TOTAL = "total_records"


def _names(table: str) -> list[str]:
    """The metrics of a table in report order."""
    unique = [UNIQUE_METRIC[table]] if table in UNIQUE_METRIC else []
    return [TOTAL, *[rule.metric for rule in rules_for(table)], *unique]


def table_metrics(
    df: DataFrame, table: str, as_of: dt.date | str | None = None
) -> DataFrame:
    """All metrics of one raw table from a single pass over it, with their report positions.

    With a uniqueness check the counts are taken per key first and then summed,
    so the duplicate count shares the scan of the others.
    """
    counts = [
        F.count(F.lit(1)).alias(TOTAL),
        *[F.count_if(rule.violated).alias(rule.metric) for rule in rules_for(table, as_of)],
    ]
    names = _names(table)
    if table in UNIQUE_METRIC:
        per_key = df.groupBy(PRIMARY_KEY[table]).agg(*counts)
        summed = [F.sum(name).alias(name) for name in names[:-1]]
        totals = per_key.agg(*summed, F.count_if(F.col(TOTAL) > 1).alias(names[-1]))
    else:
        totals = df.agg(*counts)
    entries = [
        F.struct(
            F.lit(_position(table, i)).alias("position"),
            F.lit(table).alias("table"),
            F.lit(m).alias("metric"),
            F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias("value"),
        )
        for i, m in enumerate(names)
    ]
    return totals.select(F.inline(F.array(*entries)))


def _position(table: str, nth: int) -> int:
    return TABLES.index(table) * 100 + nth


def report(spark: SparkSession, counts: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """The metrics of a run, as counted while its raw tables were stored, in report order."""
    rows = [
        (_position(table, i), table, metric, counts[table][metric])
        for table in TABLES
        for i, metric in enumerate(_names(table))
    ]
    return spark.createDataFrame(rows, "position int, table string, metric string, value bigint")


def dq_metrics(raw: Mapping[str, DataFrame], as_of: dt.date | str | None = None) -> DataFrame:
    """The quality report: table, metric, value."""
    parts = [table_metrics(raw[table], table, as_of) for table in TABLES]
    return reduce(DataFrame.unionByName, parts).drop("position")


def dq_score(metrics: DataFrame) -> DataFrame:
    """Rows checked, rule hits and the score in percent with two decimals.

    Hits are counted per rule, so the score may fall below zero. The score is
    rounded half up on integers; without any rows it is 100.
    """
    is_total = F.col("metric") == TOTAL
    sums = metrics.agg(
        F.coalesce(F.sum(F.when(is_total, F.col("value"))), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~is_total, F.col("value"))), F.lit(0)).alias("errors"),
    )
    doubled = (F.col("rows") - F.col("errors")) * 20000 + F.col("rows")
    divisor = F.when(F.col("rows") > 0, F.col("rows") * 2)
    hundredths = F.call_function("div", doubled - F.pmod(doubled, divisor), divisor)
    return sums.select(
        F.col("rows").alias("total_records_processed"),
        F.col("errors").alias("total_errors_found"),
        F.coalesce(hundredths.cast("double") / 100, F.lit(100.0)).alias("data_quality_score"),
    )


def table_volumes(metrics: DataFrame) -> DataFrame:
    """Rows checked per table."""
    return metrics.where(F.col("metric") == TOTAL).select(
        F.col("table").alias("table_name"), F.col("value").alias("total_records_checked")
    )


def anomaly_breakdown(metrics: DataFrame) -> DataFrame:
    """Hits per rule, flagged when there are any."""
    return metrics.where(F.col("metric") != TOTAL).select(
        F.col("table").alias("table_name"),
        "metric",
        F.col("value").alias("anomalies_count"),
        (F.col("value") > 0).alias("is_failing"),
    )


def duplicate_keys(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Per table: keys that occur more than once and the rows beyond the first.

    A missing key counts as a key like any other.
    """

    def one(table: str) -> DataFrame:
        per_key = raw[table].groupBy(PRIMARY_KEY[table]).agg(F.count(F.lit(1)).alias("rows"))
        return per_key.agg(
            F.lit(table).alias("table_name"),
            F.lit(PRIMARY_KEY[table]).alias("key_column"),
            F.count_if(F.col("rows") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("surplus_rows"),
        )

    return reduce(DataFrame.unionByName, [one(table) for table in TABLES])


# Parent table and the (child table, child column) pairs that refer to its key.
REFERENCES = {
    "customers": (("orders", "customer_id"),),
    "products": (("order_items", "product_id"),),
    "orders": (("order_items", "order_id"), ("payments", "order_id")),
}


def orphan_keys(cleaned: Mapping[str, DataFrame]) -> DataFrame:
    """Clean rows, and distinct keys, that refer to no clean row of the parent table.

    A NULL reference is an orphan too. Every table is read once: a row gives its own key
    and those it refers to. They are counted per parent and key, which needs one shuffle of
    partial counts and no join; a hot key is one row per task.
    """
    width = max(map(len, REFERENCES.values()))
    names = [f"rows_{i}" for i in range(width)]

    def mark(parent: str, key: Column, place: str) -> Column:
        marks = [F.lit(int(n == place)).cast("bigint").alias(n) for n in ("known", *names)]
        return F.struct(F.lit(parent).alias("parent"), key.cast("string").alias("key"), *marks)

    given: dict[str, list[Column]] = {}
    for parent, children in REFERENCES.items():
        given.setdefault(parent, []).append(mark(parent, F.col(PRIMARY_KEY[parent]), "known"))
        for i, (table, column) in enumerate(children):
            given.setdefault(table, []).append(mark(parent, F.col(column), names[i]))
    # a row without counts for each parent, so that all are reported even without any rows
    spark = next(iter(cleaned.values())).sparkSession
    none = F.lit(None).cast("string")
    parts = [spark.range(1).select(F.inline(F.array(*[mark(p, none, "") for p in REFERENCES])))]
    parts += [cleaned[table].select(F.inline(F.array(*marks))) for table, marks in given.items()]
    per_key = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("parent", "key")
        .agg(*[F.sum(n).alias(n) for n in ("known", *names)])
    )
    lost = [F.when(F.col("known") == 0, F.col(n)) for n in names]
    totals = per_key.groupBy("parent").agg(
        *[F.count_if(c > 0).alias(f"{n}_keys") for c, n in zip(lost, names, strict=True)],
        *[F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in zip(lost, names, strict=True)],
    )
    reported = [
        F.struct(
            F.lit(table).alias("child_table"),
            F.lit(column).alias("child_column"),
            F.lit(parent).alias("parent_table"),
            F.col(f"{names[i]}_keys").alias("orphan_keys"),
            F.col(names[i]).alias("orphan_rows"),
        )
        for parent, children in REFERENCES.items()
        for i, (table, column) in enumerate(children)
    ]
    every = totals.select("parent", F.inline(F.array(*reported)))
    return every.where("parent = parent_table").drop("parent")

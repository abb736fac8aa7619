"""Monthly revenue kept up to date by daily runs, without recomputing history.

A run gets the raw orders and payments that have arrived since the run before. It stores what
it got summed per order, and per month what changed. An order's part of a month is
``times * paid``: how often the order was placed, times all that was paid for it. With
what earlier runs stored of the same orders, the change is the product after the run less the
product before it, so payments that arrive months after their order, orders that arrive after
their payments, and repeated orders all count as they do in a full run.

Only orders that the run touches are looked up; their keys, a day's worth, meet the narrow
sums of earlier days, and no raw row is read again. Each run owns a directory in each of the three
tables, so a repeated run replaces its own and changes no other file; a month that got nothing
has no file in it. An order that is dated after the day of a run counts from the first run on whose
day it is no longer in the future.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.money import cents, money
from ledgerloom.operators.clean import valid_rows
from ledgerloom.plans.marts import not_cancelled
from ledgerloom.session import materialize

#: as of this day no order is in the future
LAST_DAY = "9999-12-31"

_ORDERS = "order_id string, order_date date, times bigint, run_day date"
_PAYMENTS = "order_id string, paid bigint, payments bigint, run_day date"
_CHANGES = "month date, paid bigint, orders bigint, run_day date"


class DailyRevenue:
    """The stored sums below one folder that every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _table(self, name: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _write(self, name: str, day: dt.date, df: DataFrame, by: str | None = None) -> None:
        """This run's part of a table; a repeated run overwrites it."""
        writer = df.write.mode("overwrite")
        writer = writer.partitionBy(by) if by else writer
        writer.parquet(f"{self.root}/{name}/run_day={day}")

    def days(self) -> list[dt.date]:
        """Days of the runs so far; the last table that a run writes tells."""
        runs = self._table("runs", "done boolean, run_day date").select("run_day").distinct()
        return sorted(row["run_day"] for row in runs.collect())  # one row per run

    def add(self, day: dt.date | str, orders: DataFrame, payments: DataFrame) -> None:
        """One run as of ``day`` over the raw rows that arrived since the run before.

        The last run may be repeated; one between earlier runs would change what later ones
        were computed from, and is refused.
        """
        day = dt.date.fromisoformat(str(day))
        earlier = [d for d in self.days() if d != day]
        if earlier and max(earlier) > day:
            raise ValueError(f"a run of {max(earlier)} is stored already, {day} comes too late")
        before = F.lit(str(max(earlier)) if earlier else "0001-01-01").cast("date")

        placed = not_cancelled(valid_rows(orders, "orders", LAST_DAY))
        self._write(
            "orders", day, placed.groupBy("order_id", "order_date").agg(F.count(F.lit(1)).alias("times"))
        )
        paid = valid_rows(payments, "payments").groupBy("order_id")
        sums = F.sum(cents(F.col("amount"))).alias("paid"), F.count(F.lit(1)).alias("payments")
        self._write("payments", day, paid.agg(*sums))

        today = F.lit(str(day)).cast("date")
        mine = F.col("run_day") == today
        all_orders = self._table("orders", _ORDERS).where((F.col("run_day") <= today) & (F.col("order_date") <= today))
        all_payments = self._table("payments", _PAYMENTS).where(F.col("run_day") <= today)
        old = ~mine & (F.col("order_date") <= before)
        touched = all_orders.where(~old).select("order_id").union(all_payments.where(mine).select("order_id"))
        touched = materialize(touched.distinct(), "touched")

        def split(column: str, was: Column) -> list:
            """A sum before and after this run."""
            part = F.when(was, F.col(column)).otherwise(0)
            return [F.sum(part).alias(f"{column}_before"), F.sum(column).alias(column)]

        orders_then = (
            all_orders.join(touched, "order_id", "left_semi")
            .groupBy("order_id", F.trunc("order_date", "month").alias("month"))
            .agg(*split("times", old))
        )
        payments_then = (
            all_payments.join(touched, "order_id", "left_semi")
            .groupBy("order_id")
            .agg(*split("paid", ~mine), *split("payments", ~mine))
        )
        counts = [
            ((F.col(f"times{x}") > 0) & (F.col(f"payments{x}") > 0)).cast("bigint") for x in ("", "_before")
        ]
        change = (
            orders_then.join(payments_then, "order_id")
            .groupBy("month")
            .agg(
                F.sum(F.col("times") * F.col("paid") - F.col("times_before") * F.col("paid_before")).alias("paid"),
                F.sum(counts[0] - counts[1]).alias("orders"),
            )
            .where("paid <> 0 OR orders <> 0")
        )
        # the few rows of a run, one file per month
        self._write("changes", day, change.coalesce(1), by="month")
        self._write("runs", day, self.spark.range(1).select(F.lit(True).alias("done")))

    def monthly_revenue(self) -> DataFrame:
        """As ``marts.monthly_revenue`` over all that the runs were given, as of the last run's day."""
        done = self.days()
        changes = self._table("changes", _CHANGES).where(F.col("run_day").isin(done) if done else F.lit(False))
        months = changes.groupBy("month").agg(F.sum("paid").alias("paid"), F.sum("orders").alias("orders"))
        return months.where("orders > 0").select(
            F.date_format("month", "yyyy-MM").alias("order_month"),
            money(F.col("paid")).alias("revenue"),
            F.col("orders").alias("orders_count"),
        )

"""Every query of the engine over one set of raw tables, built lazily by name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.segments import Thresholds
from ledgerloom.operators import clean as cleaning
from ledgerloom.operators import quality
from ledgerloom.plans import dashboard, marts, reads, runs
from ledgerloom.schemas import TABLES


class Catalog:
    """Plans over raw tables as of a day; nothing runs until a result is used."""

    def __init__(
        self,
        spark: SparkSession,
        raw: Mapping[str, DataFrame],
        as_of: dt.date | str | None = None,
        limits: Thresholds = Thresholds(),
    ):
        self.spark = spark
        self.raw = raw
        self.as_of = as_of
        self.limits = limits

    def clean(self, table: str, *columns: str) -> DataFrame:
        """A clean table, or only some of its columns, which shuffles less (``clean.clean``)."""
        return cleaning.clean(self.raw[table], table, self.as_of, columns)

    @property
    def profiles(self) -> DataFrame:
        """What the marts show of a customer."""
        return self.clean("customers", "customer_id", "name", "country")

    def quarantine(self, table: str) -> DataFrame:
        """Rejected rows with their reasons as one text."""
        rows = cleaning.quarantine(self.raw[table], table, self.as_of)
        return rows.withColumn("reasons", F.array_join("reasons", ","))

    @cached_property
    def metrics(self) -> DataFrame:
        return quality.dq_metrics(self.raw, self.as_of)

    @cached_property
    def lifetime_value(self) -> DataFrame:
        return marts.customer_lifetime_value(self.clean("orders"), self.clean("payments"))

    @cached_property
    def customers_value(self) -> DataFrame:
        return marts.known_customers_value(self.lifetime_value, self.profiles)

    def top_customers(self) -> DataFrame:
        return marts.top_customers(self.lifetime_value, self.profiles)

    @cached_property
    def monthly_revenue(self) -> DataFrame:
        return marts.monthly_revenue(self.clean("orders"), self.clean("payments"))

    @cached_property
    def product_performance(self) -> DataFrame:
        return marts.product_performance(
            self.clean("order_items"), self.clean("products"), self.clean("orders")
        )

    @cached_property
    def product_portfolio(self) -> DataFrame:
        return dashboard.product_portfolio(self.product_performance, self.clean("products"))

    def run_record(self, run_id: str, run_time: str) -> DataFrame:
        return runs.run_record(self.metrics, run_id, run_time)

    def query(self, name: str) -> DataFrame:
        """A query by its name, in the order in which readers see it (``plans.reads``)."""
        return reads.ordered(name, PLANS[name](self))


PLANS: dict[str, Callable[[Catalog], DataFrame]] = {
    **{f"clean_{t}": (lambda c, t=t: c.clean(t)) for t in TABLES},
    **{f"quarantine_{t}": (lambda c, t=t: c.quarantine(t)) for t in TABLES},
    "dq_metrics": lambda c: c.metrics,
    "dq_score": lambda c: quality.dq_score(c.metrics),
    "table_volumes": lambda c: quality.table_volumes(c.metrics),
    "anomaly_breakdown": lambda c: quality.anomaly_breakdown(c.metrics),
    "duplicate_keys": lambda c: quality.duplicate_keys(c.raw),
    "orphan_keys": lambda c: quality.orphan_keys({t: c.clean(t) for t in TABLES}),
    "order_payments": lambda c: marts.order_payments(c.clean("orders"), c.clean("payments")),
    "customer_lifetime_value": lambda c: c.lifetime_value,
    "top_customers": lambda c: c.top_customers(),
    "clv_leaderboard": lambda c: marts.clv_leaderboard(c.lifetime_value, c.profiles),
    "customer_segments": lambda c: dashboard.customer_segments(c.customers_value, c.limits),
    "customer_value_segments": lambda c: dashboard.customer_value_segments(
        c.top_customers(), c.limits
    ),
    "monthly_revenue": lambda c: c.monthly_revenue,
    "revenue_growth": lambda c: marts.revenue_growth(c.monthly_revenue),
    "product_performance": lambda c: c.product_performance,
    "product_portfolio": lambda c: c.product_portfolio,
    "category_revenue": lambda c: dashboard.category_revenue(
        c.product_performance, c.clean("products")
    ),
    "top_products": lambda c: dashboard.top_products(c.product_portfolio),
    "executive_kpis": lambda c: dashboard.executive_kpis(c.clean("orders"), c.clean("payments")),
    "order_status_breakdown": lambda c: dashboard.order_status_breakdown(c.clean("orders")),
    "customers_by_country": lambda c: dashboard.customers_by_country(
        c.clean("customers", "customer_id", "country")
    ),
}

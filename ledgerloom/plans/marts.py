"""Analytical tables on the clean tables.

The order key is the only one that both facts share, so every mart first sums one side to
one row per key (``joins.per_key``); repeated orders then multiply sums, never row pairs,
and what the other side has of a key, however much, can be joined by several tasks.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.money import average_cents, cents, money
from ledgerloom.functions.text import month_of
from ledgerloom.operators.joins import per_key
from ledgerloom.operators.ranking import with_rank

CANCELLED = "Cancelled"


def not_cancelled(orders: DataFrame) -> DataFrame:
    """Orders that count as sales; a missing status does not."""
    return orders.where(F.col("status") != CANCELLED)


def order_payments(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Each payment with its order. Both sides are plain shuffles, which lets
    adaptive execution split a partition that one order dominates."""
    return not_cancelled(orders).join(payments, "order_id")


def _revenue_by(orders: DataFrame, payments: DataFrame, group: str) -> DataFrame:
    """Paid cents, payments and distinct orders per value of one order column.

    Orders are counted per key and group first, so that equal ones are one row and each
    joined row stands for one order of its group.
    """
    placed = (
        not_cancelled(orders).groupBy("order_id", group).agg(F.count(F.lit(1)).alias("times"))
    )
    paid = per_key(
        payments,
        "order_id",
        F.sum(cents(F.col("amount"))).alias("paid"),
        F.count(F.lit(1)).alias("payments"),
    )
    return (
        placed.join(paid, "order_id")
        .groupBy(group)
        .agg(
            F.sum(F.col("paid") * F.col("times")).alias("paid"),
            F.sum(F.col("payments") * F.col("times")).alias("payments"),
            F.count(F.lit(1)).alias("orders"),
        )
    )


def paid_orders(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """One row per order that is a sale and has payments, for all marts that sum by its columns.

    Orders and payments meet in one aggregate, which combines on the map side: each is shuffled once
    and a key costs one row per task. An order whose rows disagree on the customer or the month is
    ``mixed``; only of those are the columns a sample, and only those keep their key.
    """
    sale = not_cancelled(orders).select(
        "order_id",
        "customer_id",
        F.trunc("order_date", "month").alias("month"),
        F.lit(1).cast("bigint").alias("placed"),
    )
    payment = payments.select(
        "order_id", cents(F.col("amount")).alias("cents"), F.lit(1).cast("bigint").alias("payment")
    )
    groups = ("customer_id", "month")
    per_order = (
        sale.unionByName(payment, allowMissingColumns=True)
        .where(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.sum("placed").alias("times"),
            F.sum("cents").alias("paid"),
            F.sum("payment").alias("payments"),
            *[F.min(g).alias(g) for g in groups],
            *[F.max(g).alias(f"max_{g}") for g in groups],
            *[F.count(g).alias(f"n_{g}") for g in groups],
        )
        .where("times > 0 AND payments > 0")
    )
    agree = [
        F.col(g).eqNullSafe(F.col(f"max_{g}")) & F.col(f"n_{g}").isin(0, F.col("times")) for g in groups
    ]
    mixed = ~reduce(and_, agree)
    return per_order.select(
        F.when(mixed, F.col("order_id")).alias("order_id"),
        *groups,
        "times",
        "paid",
        "payments",
        mixed.alias("mixed"),
    )


def _paid_by(
    plain: DataFrame, mixed: DataFrame | None, orders: DataFrame | None, group: str
) -> DataFrame:
    """``_revenue_by`` from stored ``paid_orders``; mixed ones are taken from the rows of ``orders``."""
    parts = plain.select(
        group,
        (F.col("paid") * F.col("times")).alias("paid"),
        (F.col("payments") * F.col("times")).alias("payments"),
    )
    if mixed is not None:
        paid = mixed.select("order_id", "paid", "payments")
        by_month = not_cancelled(orders).withColumn("month", F.trunc("order_date", "month"))
        rows = by_month.select("order_id", group).join(mixed.select("order_id"), "order_id", "left_semi")
        placed = rows.groupBy("order_id", group).agg(F.count(F.lit(1)).alias("times"))
        again = placed.join(paid, "order_id").select(
            group,
            (F.col("paid") * F.col("times")).alias("paid"),
            (F.col("payments") * F.col("times")).alias("payments"),
        )
        parts = parts.unionByName(again)
    return parts.groupBy(group).agg(
        F.sum("paid").alias("paid"),
        F.sum("payments").alias("payments"),
        F.count(F.lit(1)).alias("orders"),
    )


def stored_lifetime_value(
    plain: DataFrame, mixed: DataFrame | None = None, orders: DataFrame | None = None
) -> DataFrame:
    """``customer_lifetime_value`` from stored ``paid_orders``."""
    return _lifetime_value(_paid_by(plain, mixed, orders, "customer_id"))


def stored_monthly_revenue(
    plain: DataFrame, mixed: DataFrame | None = None, orders: DataFrame | None = None
) -> DataFrame:
    """``monthly_revenue`` from stored ``paid_orders``."""
    return _monthly(_paid_by(plain, mixed, orders, "month"))


def customer_lifetime_value(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Spend, orders and mean payment per paying customer."""
    return _lifetime_value(_revenue_by(orders, payments, "customer_id"))


def _lifetime_value(spent: DataFrame) -> DataFrame:
    return spent.select(
        "customer_id",
        money(F.col("paid")).alias("total_spent"),
        F.col("orders").alias("order_count"),
        money(average_cents(F.col("paid"), F.col("payments"))).alias("avg_order_value"),
    )


def known_customers_value(lifetime_value: DataFrame, customers: DataFrame) -> DataFrame:
    """Lifetime value of the customers whose profile is clean."""
    profile = customers.select("customer_id", "name", "country")
    return lifetime_value.join(profile, "customer_id").select(
        "customer_id", "name", "country", "total_spent", "order_count", "avg_order_value"
    )


def ranked_customers(value: DataFrame) -> DataFrame:
    """Customers with the rank of their spend; ``value`` is read twice."""
    ranked = with_rank(value, cents(F.col("total_spent")))
    return ranked.select("rank", *[c for c in ranked.columns if c != "rank"])


def top_customers(lifetime_value: DataFrame, customers: DataFrame) -> DataFrame:
    """Every known customer with the rank of their spend."""
    return ranked_customers(known_customers_value(lifetime_value, customers))


def clv_leaderboard(lifetime_value: DataFrame, customers: DataFrame, size: int = 15) -> DataFrame:
    """The first customers by rank; ties are broken by customer id.

    Everyone ahead of a leaderboard row is on the leaderboard too, so ranking
    the few rows left after the top-k gives the same rank as ranking all.
    """
    first = (
        known_customers_value(lifetime_value, customers)
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(size)
    )
    place = F.rank().over(Window.orderBy(F.desc("total_spent")))
    return first.select(place.cast("bigint").alias("rank"), *first.columns).orderBy(
        "rank", "customer_id"
    )


def monthly_revenue(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Revenue and paid orders per month; its first day is the key until the end,
    which shuffles and hashes as a number."""
    by_month = orders.withColumn("month", F.trunc("order_date", "month"))
    return _monthly(_revenue_by(by_month, payments, "month"))


def _monthly(sold: DataFrame) -> DataFrame:
    return sold.select(
        month_of(F.col("month")).alias("order_month"),
        money(F.col("paid")).alias("revenue"),
        F.col("orders").alias("orders_count"),
    )


def revenue_growth(monthly: DataFrame) -> DataFrame:
    """Change of each month against the month before it in the table.

    The window has no partitions, but there is one row per calendar month.
    """
    months = Window.orderBy("order_month")
    change = F.col("revenue") - F.col("previous_revenue")
    return (
        monthly.withColumn("previous_month", F.lag("order_month").over(months))
        .withColumn("previous_revenue", F.lag("revenue").over(months))
        .select(
            "order_month",
            "revenue",
            "previous_month",
            "previous_revenue",
            F.try_divide(
                (change * 100).cast("double"), F.col("previous_revenue").cast("double")
            ).alias("growth_pct"),
        )
    )


def product_performance(
    order_items: DataFrame, products: DataFrame, orders: DataFrame
) -> DataFrame:
    """Units and revenue, at the item's own price, per product."""
    sold = per_key(not_cancelled(orders), "order_id", F.count(F.lit(1)).alias("times"))
    lines = order_items.select(
        "order_id",
        "product_id",
        F.col("quantity").cast("bigint").alias("units"),
        (cents(F.col("price")) * F.col("quantity")).alias("value"),
    ).where(F.col("product_id").isNotNull())
    sales = per_key(
        lines.join(sold, "order_id"),
        "product_id",
        F.sum(F.col("units") * F.col("times")).alias("units"),
        F.sum(F.col("value") * F.col("times")).alias("value"),
    )
    listings = products.groupBy("product_id", "product_name", "category").agg(
        F.count(F.lit(1)).alias("times")
    )
    return listings.join(sales, "product_id").select(
        "product_id",
        "product_name",
        "category",
        (F.col("units") * F.col("times")).alias("quantity_sold"),
        money(F.col("value") * F.col("times")).alias("total_revenue"),
    )

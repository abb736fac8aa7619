from decimal import Decimal

import pytest

from ledgerloom.functions.segments import Thresholds, segment_captions
from ledgerloom.plans import dashboard, marts, pipeline
from tests import rows as r

D = Decimal


@pytest.fixture
def tables(spark):
    return {
        "customers": r.cleaned(
            spark,
            "customers",
            r.customer("C1", name="Ann", country="USA"),
            r.customer("C2", name="Bob", country="UK"),
            r.customer("C3", name="Cid", country=""),
            r.customer("C4", name="Dee", country="USA"),
        ),
        "products": r.cleaned(
            spark,
            "products",
            r.product("P1", name="Lamp", category="Home", price="5.00"),
            r.product("P2", name="Ball", category="Sports", price="9.00"),
            r.product("P2", name="Ball", category="Sports", price="8.00"),
        ),
        "orders": r.cleaned(
            spark,
            "orders",
            r.clean_order("O1", "C1", "2025-01-20"),
            r.clean_order("O2", "C1", "2025-02-03", total="30.01"),
            r.clean_order("O3", "C2", "2025-02-04", total=None),
            r.clean_order("O4", "C2", "2025-02-05", status="Cancelled"),
            r.clean_order("O5", "C3", "2025-04-05", status=None),
            r.clean_order("O6", "C9", "2025-04-06", total="1.00"),
            r.clean_order("O7", "C4", "2025-04-07", total="2.00"),
            r.clean_order("O7", "C4", "2025-04-07", total="2.00"),
        ),
        "order_items": r.cleaned(
            spark,
            "order_items",
            r.item("I1", "O1", "P1", 2, "5.50"),
            r.item("I2", "O2", "P2", 1, "7.00"),
            r.item("I3", "O4", "P1", 9, "5.50"),
            r.item("I4", "O7", "P1", 1, "1.00"),
            r.item("I5", "O1", "P9", 1, "1.00"),
            r.item("I6", None, "P1", 1, "1.00"),
            r.item("I7", "O1", None, 1, "1.00"),
        ),
        "payments": r.cleaned(
            spark,
            "payments",
            r.payment("A1", "O1", "10.00"),
            r.payment("A2", "O1", "0.01"),
            r.payment("A3", "O2", "30.00"),
            r.payment("A4", "O3", "40.01"),
            r.payment("A5", "O4", "99.00"),
            r.payment("A6", "O5", "98.00"),
            r.payment("A7", "O6", "5.00"),
            r.payment("A8", "O7", "3.00"),
            r.payment("A9", "O8", "97.00"),
        ),
    }


def _rows(df, *columns):
    return {tuple(row) for row in df.select(*columns or df.columns).collect()}


def test_lifetime_value(tables):
    value = marts.customer_lifetime_value(tables["orders"], tables["payments"])
    assert _rows(value) == {
        # the average is over payments: 40.01 / 3
        ("C1", D("40.01"), 2, D("13.34")),
        ("C2", D("40.01"), 1, D("40.01")),
        ("C9", D("5.00"), 1, D("5.00")),
        # a repeated order counts once but its payments count twice
        ("C4", D("6.00"), 1, D("3.00")),
    }


def test_average_rounds_half_up(spark):
    orders = r.cleaned(spark, "orders", r.clean_order("O1"), r.clean_order("O2"))
    payments = r.cleaned(
        spark, "payments", r.payment("A", "O1", "649.30"), r.payment("B", "O2", "649.31")
    )
    (row,) = marts.customer_lifetime_value(orders, payments).collect()
    assert row["avg_order_value"] == D("649.31")


def test_top_customers(tables):
    value = marts.customer_lifetime_value(tables["orders"], tables["payments"])
    top = marts.top_customers(value, tables["customers"])
    assert top.columns == [
        "rank", "customer_id", "name", "country", "total_spent", "order_count", "avg_order_value",
    ]
    assert _rows(top, "rank", "customer_id", "name") == {
        (1, "C1", "Ann"),
        (1, "C2", "Bob"),
        (3, "C4", "Dee"),
    }
    board = marts.clv_leaderboard(value, tables["customers"], size=2)
    assert [(row["rank"], row["customer_id"]) for row in board.collect()] == [(1, "C1"), (1, "C2")]


def test_monthly_revenue_and_growth(tables):
    monthly = marts.monthly_revenue(tables["orders"], tables["payments"])
    assert _rows(monthly) == {
        ("2025-01", D("10.01"), 1),
        ("2025-02", D("70.01"), 2),
        ("2025-04", D("11.00"), 2),
    }
    growth = {row["order_month"]: row for row in marts.revenue_growth(monthly).collect()}
    assert growth["2025-01"]["growth_pct"] is None
    assert growth["2025-02"]["growth_pct"] == pytest.approx(599.4005994)
    assert growth["2025-04"]["previous_month"] == "2025-02"


def test_months_and_customers_sum_to_the_same_revenue(tables):
    monthly = marts.monthly_revenue(tables["orders"], tables["payments"])
    value = marts.customer_lifetime_value(tables["orders"], tables["payments"])
    assert monthly.agg({"revenue": "sum"}).first() == value.agg({"total_spent": "sum"}).first()


def test_order_payments_keeps_pairs(tables):
    joined = marts.order_payments(tables["orders"], tables["payments"])
    assert joined.count() == 7
    assert joined.where("order_id = 'O7'").count() == 2


def test_products(tables):
    performance = marts.product_performance(
        tables["order_items"], tables["products"], tables["orders"]
    )
    assert _rows(performance) == {
        ("P1", "Lamp", "Home", 4, D("13.00")),
        # the product is listed twice, so its one sale counts twice
        ("P2", "Ball", "Sports", 2, D("14.00")),
    }
    portfolio = dashboard.product_portfolio(performance, tables["products"])
    assert _rows(portfolio, "product_id", "price", "quantity_sold") == {
        ("P1", D("5.00"), 4),
        ("P2", D("9.00"), 2),
        ("P2", D("8.00"), 2),
    }
    categories = dashboard.category_revenue(performance, tables["products"]).collect()
    assert [tuple(row) for row in categories] == [("Sports", D("28.00")), ("Home", D("13.00"))]
    top = dashboard.top_products(portfolio, size=2).collect()
    assert [row["product_id"] for row in top] == ["P2", "P2"]


def test_kpis(tables):
    (row,) = dashboard.executive_kpis(tables["orders"], tables["payments"]).collect()
    # payments of cancelled, unknown and status-less orders are included
    assert row["revenue"] == D("382.02")
    assert (row["order_count"], row["cust_count"]) == (6, 5)
    assert row["aov"] == pytest.approx(45.01 / 5)


def test_kpis_of_empty_tables(spark):
    empty = {t: r.cleaned(spark, t) for t in ("orders", "payments")}
    (row,) = dashboard.executive_kpis(empty["orders"], empty["payments"]).collect()
    assert tuple(row) == (D("0.00"), 0, 0, 0.0)


def test_status_and_country(tables):
    assert _rows(dashboard.order_status_breakdown(tables["orders"])) == {
        ("Delivered", 6),
        ("Cancelled", 1),
        (None, 1),
    }
    assert _rows(dashboard.customers_by_country(tables["customers"])) == {
        ("United States", 2),
        ("United Kingdom", 1),
    }


def test_segments(spark):
    value = spark.createDataFrame(
        [(D(v),) for v in ("2500.00", "2499.99", "1000.00", "300.00", "299.99")] + [(None,)],
        "total_spent decimal(20,2)",
    )
    # Captions at the default limits.
    assert segment_captions(Thresholds()) == (
        "VIP Platinum (Spent > $2,500)",
        "Gold Tier ($1,000 - $2,500)",
        "Silver Tier ($300 - $1,000)",
        "Bronze Member (< $300)",
    )
    assert _rows(dashboard.customer_segments(value)) == {
        ("VIP Platinum (Spent > $2,500)", 1),
        ("Gold Tier ($1,000 - $2,500)", 2),
        ("Silver Tier ($300 - $1,000)", 1),
        ("Bronze Member (< $300)", 2),
    }
    named = dashboard.customer_value_segments(value)
    assert {row["segment"] for row in named.collect()} == {
        "VIP Platinum", "Gold Tier", "Silver Tier", "Bronze Member",
    }


def test_latest_run(spark):
    runs = spark.createDataFrame(
        [("a", "2025-01-01"), ("b", "2025-03-01"), ("c", "2025-02-01")],
        "run_id string, run_time string",
    )
    assert dashboard.latest_run(runs).collect()[0]["run_id"] == "b"


def test_marts_from_stored_paid_orders(spark):
    """Orders that are repeated, also with other customers or months: sums as from the tables themselves."""
    orders = r.cleaned(
        spark,
        "orders",
        r.clean_order("O1", "C1", "2025-01-20"),
        r.clean_order("O2", "C1", "2025-02-03"),
        r.clean_order("O2", "C1", "2025-02-28"),
        r.clean_order("O3", "C1", "2025-02-03"),
        r.clean_order("O3", "C2", "2025-03-03"),
        r.clean_order("O3", "C2", "2025-03-09"),
        r.clean_order("O4", "C2", "2025-01-05"),
        r.clean_order("O4", "C2", "2025-02-05"),
        r.clean_order("O5", "C2", "2025-02-05"),
        r.clean_order("O5", None, "2025-02-05"),
        r.clean_order("O6", None, "2025-02-05"),
        r.clean_order("O7", "C7", "2025-02-05", status="Cancelled"),
        r.clean_order("O7", "C8", "2025-02-05"),
        r.clean_order("O8", "C8", "2025-02-05"),
        r.clean_order(None, "C8", "2025-02-05"),
    )
    paid = [("A1", "O1", "1.00"), ("A2", "O1", "0.25"), ("A3", "O2", "3.00"), ("A4", "O3", "7.01"), ("A5", None, "2.00")]
    paid += [("A6", "O4", "0.50"), ("A7", "O5", "0.07"), ("A8", "O6", "9.00"), ("A9", "O7", "4.00"), ("B1", "O9", "1.00")]
    payments = r.cleaned(spark, "payments", *[r.payment(*p) for p in paid])
    plain, mixed = pipeline.paid_orders(spark, orders, payments)
    assert {row["order_id"] for row in mixed.collect()} == {"O3", "O4", "O5"}
    assert plain.count() == 4  # O1, O2, O6, O7
    for stored, asked in (
        (marts.stored_lifetime_value, marts.customer_lifetime_value),
        (marts.stored_monthly_revenue, marts.monthly_revenue),
    ):
        found, wanted = stored(plain, mixed, orders), asked(orders, payments)
        assert sorted(map(str, found.collect())) == sorted(map(str, wanted.collect()))
        assert found.dtypes == wanted.dtypes
    every, none = pipeline.paid_orders(spark, orders.where("order_id < 'O3'"), payments)
    assert none is None and every.count() == 2
    none, every = pipeline.paid_orders(spark, orders.where("order_id IN ('O3', 'O4')"), payments)
    assert none.count() == 0 and every.count() == 2
    assert {tuple(x) for x in marts.stored_lifetime_value(none, every, orders).collect()} == {
        ("C1", D("7.01"), 1, D("7.01")),
        ("C2", D("15.02"), 2, D("3.76")),
    }


def test_paid_orders_shuffle_orders_and_payments_once(spark, tables):
    plan = marts.paid_orders(tables["orders"], tables["payments"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan

"""Every query on small random tables full of repeated keys, blanks and NULLs.

The SQL is the one registered for the driver, on these raw tables instead of the
derived ones.
"""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import oracle_queries
from ledgerloom.plans import pipeline
from ledgerloom.plans.catalog import Catalog
from ledgerloom.schemas import TABLES
from ledgerloom.sources import star_schema
from ledgerloom.sources.warehouse import Warehouse
from tests import rows as r


def _tables(seed):
    draw = random.Random(seed)

    def key(prefix, size):
        """Few keys, one of them for a third of the rows, some blank or missing."""
        pick = draw.random()
        if pick < 0.05:
            return draw.choice(["", None])
        return f"{prefix}1" if pick < 0.38 else f"{prefix}{draw.randrange(size)}"

    def amount(low, high):
        if draw.random() < 0.05:
            return None
        return f"{draw.randrange(low, high)}.{draw.randrange(100):02d}"

    def date():
        # not 2024-1-1, which the SQL cast takes for a date; test_rules has it
        pool = ["2024-02-30", "2031-01-01", "soon", "", None]
        if draw.random() < 0.1:
            return draw.choice(pool)
        return f"202{draw.randrange(5)}-{draw.randrange(1, 13):02d}-{draw.randrange(1, 29):02d}"

    status = ["Delivered", "Shipped", "Cancelled", "Processing", None]
    return {
        "customers": [
            r.customer(
                key("C", 40),
                name=draw.choice(["Ann", "Bob", "", None, "Cy"]),
                email=draw.choice(["a@x", "b@x", "b@x", "c", None]),
                country=draw.choice(["USA", "UK", "", None, "Japan"]),
                day=draw.randrange(1, 28),
            )
            for _ in range(300)
        ],
        "products": [
            r.product(
                key("P", 30),
                name=draw.choice(["Lamp", "Ball"]),
                category=draw.choice(["Home", "Sports", "", None]),
                price=amount(-2, 20),
                stock=draw.choice([0, 4, -1, None, 9]),
            )
            for _ in range(120)
        ],
        "orders": [
            r.order(key("O", 200), key("C", 40), date(), draw.choice(status), amount(-5, 900))
            for _ in range(500)
        ],
        "order_items": [
            r.item(
                key("I", 900), key("O", 220), key("P", 32),
                draw.choice([0, 1, 2, 3, None]), amount(-2, 90),
            )
            for _ in range(900)
        ],
        "payments": [
            r.payment(key("A", 500), key("O", 220), amount(-20, 9_000)) for _ in range(600)
        ],
    }


@pytest.fixture(scope="module", params=[11, 29])
def both(spark, tmp_path_factory, request):
    """The same tables in both engines."""
    folder = tmp_path_factory.mktemp("random")
    con, raw = duckdb.connect(), {}
    for table, rows in _tables(request.param).items():
        path = f"{folder}/{table}"
        r.raw(spark, table, *rows).repartition(3).write.parquet(path)
        raw[table] = spark.read.parquet(path)
        con.execute(f"CREATE VIEW raw_{table} AS SELECT * FROM '{path}/*.parquet'")
    return Catalog(spark, raw, star_schema.AS_OF, entry_point.LIMITS), con


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_a_third_of_the_rows_share_a_key(both):
    catalog, _ = both
    for table in ("orders", "order_items"):
        rows = catalog.clean(table)
        assert rows.where("order_id = 'O1'").count() > 0.3 * rows.count()
    assert set(catalog.raw) == set(TABLES)


@pytest.fixture(scope="module")
def stored(both, spark, tmp_path_factory):
    """A warehouse after the batch job's runs over the same tables."""
    catalog, _ = both
    warehouse = Warehouse(spark, str(tmp_path_factory.mktemp("warehouse")))
    for day in entry_point.RUN_DAYS:
        pipeline.run_tables(
            warehouse, lambda: catalog.raw, day, run_id=day, run_time=f"{day} 06:00:00", minimum={}
        )
    return warehouse


@pytest.mark.parametrize("name", [*entry_point.PLANS, *entry_point.STORED])
def test_query_equals_sql(both, request, name):
    catalog, con = both
    if name in entry_point.STORED:
        df = entry_point._plain(entry_point.STORED[name](request.getfixturevalue("stored")))
    else:
        df = entry_point._plain(entry_point.PLANS[name](catalog))
    tables = ",".join([oracle_queries.CLEAN, oracle_queries.MARTS])
    _same(df, con.execute(f"WITH {tables} {oracle_queries.QUERIES[name]}"))


@pytest.mark.parametrize("schema", ["raw_clean", "quarantine"])
@pytest.mark.parametrize("table", TABLES)
def test_stored_tables_equal_sql(both, stored, schema, table):
    """What the batch job stores is what the lazy query gives."""
    _, con = both
    df = stored.table(schema, table).drop("unread")
    if schema == "quarantine":
        df = df.withColumn("reasons", F.array_join("reasons", ","))
    name = f"{'clean' if schema == 'raw_clean' else schema}_{table}"
    _same(entry_point._plain(df), con.execute(f"WITH {oracle_queries.CLEAN} {oracle_queries.QUERIES[name]}"))


def _same(df, result):
    columns = [column[0] for column in result.description]
    rows = [tuple(row) for row in df.collect()]
    assert _normal(df.columns, rows) == _normal(columns, result.fetchall())

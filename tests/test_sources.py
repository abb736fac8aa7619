import datetime as dt
from decimal import Decimal
from types import SimpleNamespace

import duckdb
import pytest

from ledgerloom.operators import clean as cleaning
from ledgerloom.operators import quality
from ledgerloom.session import shared_folder
from ledgerloom.sources import files, jdbc
from tests import rows as r


def _write(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")


def test_csv_is_read_with_the_declared_schema(spark, tmp_path):
    _write(
        tmp_path,
        "customers.csv",
        "customer_id,name,email,signup_date,country\n"
        "C1,Ann Lee,ann@example.com,2024-02-16,India\n"
        'C2,"",bob@example.com,2024-13-40,\n',
    )
    rows = files.read_table(spark, str(tmp_path), "customers").collect()
    assert tuple(rows[0])[:5] == ("C1", "Ann Lee", "ann@example.com", dt.date(2024, 2, 16), "India")
    assert (rows[0]["unread"], rows[1]["unread"]) == ({}, {"signup_date": "2024-13-40"})
    assert (rows[1]["name"], rows[1]["signup_date"], rows[1]["country"]) == (None, None, None)


def test_a_malformed_number_ends_in_quarantine(spark, tmp_path):
    _write(
        tmp_path,
        "products.csv",
        "product_id,product_name,category,price,stock\n"
        "P1,Lamp,Home,34.89,140\nP2,Ball,Sports,12.5,many\nP3,Mat,Sports,free,3\n",
    )
    df = files.read_table(spark, str(tmp_path), "products")
    assert [row["price"] for row in cleaning.clean(df, "products").collect()] == [Decimal("34.89")]
    rejected = {
        row["product_id"]: (row["reasons"], row["unread"])
        for row in cleaning.quarantine(df, "products").collect()
    }
    assert rejected == {
        "P2": (["stock_unreadable"], {"stock": "many"}),
        "P3": (["price_unreadable"], {"price": "free"}),
    }


def test_no_amount_is_lost_or_changed(spark, tmp_path):
    values = ["12345678901.00", "19.999", "abc", "", "2.0", "+7", "1.500", "9" * 17, "-3", " 4.25 "]
    body = "".join(f"A{i},O1,PayPal,{v}\n" for i, v in enumerate(values))
    _write(tmp_path, "payments.csv", "payment_id,order_id,payment_method,amount\n" + body)
    df = files.read_table(spark, str(tmp_path), "payments")
    clean = cleaning.clean(df, "payments")
    assert "unread" not in clean.columns
    amounts = {row["payment_id"]: row["amount"] for row in clean.collect()}
    assert amounts == {
        "A0": Decimal("12345678901.00"),
        "A4": Decimal("2.00"),
        "A5": Decimal("7.00"),
        "A6": Decimal("1.50"),
        "A9": Decimal("4.25"),
    }
    rejected = {
        row["payment_id"]: (row["reasons"], row["unread"].get("amount"))
        for row in cleaning.quarantine(df, "payments").collect()
    }
    assert rejected == {
        "A1": (["amount_unreadable"], "19.999"),
        "A2": (["amount_unreadable"], "abc"),
        "A3": (["amount_missing"], None),
        "A7": (["amount_unreadable"], "9" * 17),
        "A8": (["amount_not_positive"], None),
    }
    lost = {(r["column_name"], r["value"]): r["rows"] for r in files.unread_values(df).collect()}
    assert lost == {("amount", v): 1 for v in ("19.999", "abc", "9" * 17)}


def test_whole_numbers_may_have_a_point(spark, tmp_path):
    lines = [f"I{i},O1,P1,{q},5\n" for i, q in enumerate(["2.0", "3", "2.5", "99999999999"])]
    _write(tmp_path, "order_items.csv", "order_item_id,order_id,product_id,quantity,price\n" + "".join(lines))
    df = files.read_table(spark, str(tmp_path), "order_items")
    assert [row["quantity"] for row in df.collect()] == [2, 3, None, None]
    assert cleaning.quarantine(df, "order_items").count() == 2


def test_other_types_in_parquet(spark, tmp_path):
    df = spark.createDataFrame(
        [("A1", "O1", "PayPal", 19.99), ("A2", "O1", "PayPal", 19.999), ("A3", "O1", None, None)],
        "payment_id string, order_id string, payment_method string, amount double",
    )
    df.write.parquet(f"{tmp_path}/payments.parquet")
    rows = files.read_table(spark, str(tmp_path), "payments", "parquet").collect()
    assert {r["payment_id"]: (r["amount"], r["unread"]) for r in rows} == {
        "A1": (Decimal("19.99"), {}),
        "A2": (None, {"amount": "19.999"}),
        "A3": (None, {}),
    }


def test_declared_types_are_read_as_they_are(spark, tmp_path):
    r.raw(spark, "payments", r.payment("A1")).write.parquet(f"{tmp_path}/payments.parquet")
    df = files.read_table(spark, str(tmp_path), "payments", "parquet")
    assert df.columns == ["payment_id", "order_id", "payment_method", "amount"]
    assert files.unread_values(df).count() == 0


def test_a_directory_of_files_is_one_table(spark, tmp_path):
    folder = tmp_path / "payments.csv"
    folder.mkdir()
    for i in range(3):
        _write(folder, f"part-{i}.csv", f"payment_id,order_id,payment_method,amount\nA{i},O1,PayPal,1.5\n")
    assert files.read_table(spark, str(tmp_path), "payments").count() == 3


def test_columns_are_found_by_name(spark, tmp_path):
    _write(
        tmp_path,
        "payments.csv",
        "amount,note,order_id,payment_id,payment_method\n1.5,late,O1,A1,PayPal\n",
    )
    df = files.read_table(spark, str(tmp_path), "payments")
    assert tuple(df.first()) == ("A1", "O1", "PayPal", Decimal("1.50"), {})


def test_a_missing_column_is_an_error(spark, tmp_path):
    _write(tmp_path, "payments.csv", "payment_id,order_id,amount\nA1,O1,1.5\n")
    with pytest.raises(ValueError, match="payment_method"):
        files.read_table(spark, str(tmp_path), "payments")


def test_files_with_different_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "payments.csv"
    folder.mkdir()
    _write(folder, "a.csv", "payment_id,order_id,payment_method,amount\nA1,O1,PayPal,1.5\n")
    _write(folder, "b.csv", "order_id,payment_id,payment_method,amount\nO1,A2,PayPal,1.5\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        files.read_table(spark, str(tmp_path), "payments").collect()


def test_report_is_one_csv_in_order(spark, tmp_path):
    raw = {
        "customers": r.raw(spark, "customers", r.customer("C1")),
        "products": r.raw(spark, "products", r.product("P1")),
        "orders": r.raw(spark, "orders", r.order("O1")),
        "order_items": r.raw(spark, "order_items", r.item("I1", quantity=0)),
        "payments": r.raw(spark, "payments", r.payment("A1")),
    }
    counts = {t: {} for t in raw}
    for m in quality.dq_metrics(raw, "2025-06-01").collect():
        counts[m["table"]][m["metric"]] = m["value"]
    files.write_report(quality.report(spark, counts), str(tmp_path / "report"))
    (part,) = (tmp_path / "report").glob("part-*.csv")
    lines = part.read_text().splitlines()
    assert lines[0] == "table,metric,value"
    assert lines[1] == "customers,total_records,1"
    assert lines[19] == "order_items,negative_or_zero_quantities,1"
    assert len(lines) == 24


class _Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.seen = {}

    def format(self, name):
        self.seen["format"] = name
        return self

    def mode(self, name):
        self.seen["mode"] = name
        return self

    def options(self, **options):
        self.seen.update(options)
        return self

    def load(self):
        return self.seen

    def save(self):
        return None


class _Source:
    """Stands in for ``spark.read``; the bounds come from a table in this process's own DuckDB."""

    def __init__(self, con):
        self.con, self.calls = con, []

    def jdbc(self, url, table, predicates=None, properties=None):
        self.calls.append((table, predicates, properties))
        if table.endswith(") bounds"):
            return SimpleNamespace(collect=lambda: self.con.execute(f"SELECT * FROM {table}").fetchall())
        return predicates


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        ("VARCHAR", "chr(39) || k % 700"),
        ("BIGINT", "k * 3 - 500"),
        ("DATE", "DATE '2024-01-01' + CAST(k % 400 AS INTEGER)"),
        ("TIMESTAMP", "TIMESTAMP '2024-01-01 10:00:00' + to_seconds(k)"),
        ("DECIMAL(12,2)", "k / 7"),
        ("VARCHAR", "CASE WHEN k % 3 = 0 THEN 'hot' ELSE 'x' || k END"),
    ],
)
def test_jdbc_reads_in_parts_that_the_source_names(kind, value):
    """Every row, NULL keys too, satisfies exactly one condition, and parts are about equal."""
    con = duckdb.connect()
    con.execute(
        f"CREATE TABLE orders AS SELECT CASE WHEN k % 50 = 1 THEN NULL ELSE CAST({value} AS {kind}) END AS order_id "
        "FROM (SELECT unnest(range(5000)) AS k)"
    )
    session = SimpleNamespace(read=_Source(con))
    predicates = jdbc.read_table(session, "jdbc:x", "orders", {"user": "u"}, partitions=8)
    (bounds, _, options), (table, _, _) = session.read.calls
    assert "NTILE(8)" in bounds and options["user"] == "u" and table == "orders"
    assert 6 <= len(predicates) <= 8
    sizes = [con.execute(f"SELECT count(*) FROM orders WHERE {p}").fetchone()[0] for p in predicates]
    hits = " + ".join(f"CAST(coalesce({p}, false) AS INTEGER)" for p in predicates)
    assert con.execute(f"SELECT min({hits}), max({hits}) FROM orders").fetchone() == (1, 1)
    assert sum(sizes) == 5000
    if "hot" not in value:
        assert max(sizes) <= 2.5 * min(sizes)


def test_jdbc_parts_of_odd_tables():
    con = duckdb.connect()
    con.execute("CREATE TABLE orders (order_id VARCHAR, other INTEGER)")
    session = SimpleNamespace(read=_Source(con))
    assert jdbc.read_table(session, "jdbc:x", "orders", {}) == ["1 = 1"]
    con.execute("INSERT INTO orders VALUES (NULL, 1), ('a', 2), ('a', 3)")
    assert jdbc.read_table(session, "jdbc:x", "orders", {}) == ["1 = 1"]
    assert jdbc.read_table(session, "jdbc:x", "orders", {}, key="other", partitions=2) == [
        "other < 3 OR other IS NULL",
        "other >= 3",
    ]
    own = jdbc.hash_predicates("hashtext(order_id)", 4)
    assert jdbc.read_table(session, "jdbc:x", "orders", {}, predicates=own) == own
    assert jdbc.read_table(session, "jdbc:x", "sessions", {}, partitions=1) is None
    with pytest.raises(ValueError, match="sessions"):
        jdbc.read_table(session, "jdbc:x", "sessions", {})


def test_malformed_lines_are_quarantined_whole(spark, tmp_path):
    """Too few fields, too many, an unclosed quote: no such line is clean, its text is kept."""
    lines = ["A1,O1,PayPal,5.00", "A2,O1", "A3,O1,PayPal,5.00,extra", 'A4,"O1,PayPal,5.00', "A5,O2,PayPal,6.00"]
    _write(tmp_path, "payments.csv", "payment_id,order_id,payment_method,amount\n" + "\n".join(lines) + "\n")
    df = files.read_table(spark, str(tmp_path), "payments")
    assert {r["payment_id"] for r in cleaning.clean(df, "payments").collect()} == {"A1", "A5"}
    out = {r["unread"]["line"]: r["reasons"] for r in cleaning.quarantine(df, "payments").collect()}
    assert out == {line: ["line_malformed"] for line in lines[1:4]}
    total = {m["metric"]: m["value"] for m in quality.table_metrics(df, "payments").collect()}
    assert total["total_records"] == 5
    assert files.unread_values(df).where("column_name = 'line'").count() == 3


def test_jdbc_write_options():
    frame = SimpleNamespace(write=_Recorder())
    jdbc.write_table(frame, "jdbc:x", "raw_clean.orders", {"user": "u"}, connections=3)
    seen = frame.write.seen
    assert seen["mode"] == "overwrite" and seen["truncate"] == "true"
    assert seen["numPartitions"] == "3"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_stored_results_go_to_a_folder_that_executors_share():
    def session(**settings):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))

    warehouse = {"spark.sql.warehouse.dir": "s3a://shop/warehouse"}
    assert shared_folder(session(**warehouse)) == "s3a://shop/warehouse/_scratch"
    named = {"spark.checkpoint.dir": "hdfs:///scratch/"}
    assert shared_folder(session(**warehouse, **named)) == "hdfs:///scratch"

"""Active entries against plain search, and the registered query against its SQL."""

from __future__ import annotations

import datetime as dt
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import queries, url_filters, url_list

DAY = dt.date(2024, 1, 1)


def parse(url):
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)", url or "")
    if not m:
        return None
    rest = m[1].replace("\\", "/")
    host = re.match(r"^(?:[^/?@]*@)?(\[[0-9A-Fa-f:.]*\]|[^/?:@]*)", rest)[1]
    host = re.sub(r"\.+$", "", host).lower()
    path = re.match(r"^[^/?]*([^?]*)", rest)[1]
    return host, [x for x in path.split("/") if x], host + re.match(r"^[^/?]*(.*)", rest)[1]


def plain(url, day, events):
    """(n_active, lists, verdict, decided_by) by looking at every entry."""
    found = parse(url)
    if not found or not found[0] or day is None:
        return 0, "", "none", None
    host, parts, address = found
    state = {}
    for kind, key, name, allows, action, at in events:
        if None in (kind, key, name, allows, at) or action not in ("add", "remove") or at > day:
            continue
        entry = (kind, key, name, allows)
        state[entry] = max(state.get(entry, (dt.date.min, "")), (at, action))
    best = []
    for (kind, key, name, allows), (_, action) in state.items():
        hit = {
            "url": key == address,
            "host": key == host,
            "domain": key == host or (host.endswith("." + key) and "." in key),
            "prefix": any(key == "/".join([host, *parts[:i]]) for i in range(1, len(parts) + 1)),
        }[kind]
        if hit and action == "add":
            best.append((url_filters.KINDS.index(kind), len(key), allows, key, name))
    if not best:
        return 0, "", "none", None
    top = max(best)
    return len(best), ",".join(sorted({b[4] for b in best})), "allow" if top[2] else "block", top[3]


def test_hosts(spark):
    urls = {
        "http://[2001:DB8::1]:80/a/b": ("[2001:db8::1]", ["a", "b"], []),
        "http://u:p@[::ffff:1.2.3.4]?x": ("[::ffff:1.2.3.4]", [], []),
        "http://ex.com\\a\\b": ("ex.com", ["a", "b"], []),
        "https://u@A.B.Ex.com.:8080/x?y\\z#f": ("a.b.ex.com", ["x"], ["b.ex.com", "ex.com"]),
        "ftp://localhost": ("localhost", [], []),
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    name = url_filters.host(F.col("url"))
    rows = df.select("url", name, url_filters.segments(F.col("url")), url_filters.parents(name)).collect()
    assert {r[0]: tuple(r[1:]) for r in rows} == urls


def world(seed):
    rng = random.Random(seed)
    hosts = ["a.com", "x.a.com", "y.x.a.com", "B.org", "b.org.", "localhost", "c.d.e.f"]
    urls = [
        f"{rng.choice(['http', 'https', 'FTP'])}://{rng.choice(['', 'u:p@', 'www.'])}{rng.choice(hosts)}"
        f"{rng.choice(['', ':80', ''])}{rng.choice(['', '/', '/p', '/p/q', '//p', '/P?x=/z', '?q', '/p#f/g'])}"
        for _ in range(40)
    ] + [
        None, "", "no url", "http://", "mailto:x@y", "http://é.com/ü", "http://[2001:db8::1]:80/a",
        "http://u@[::FFFF:1.2.3.4]/x/y?q", "http://ex.com\\\\a\\\\b", "http://[2001:db8::1",
    ]
    captures = [(i, rng.choice(urls), rng.choice([None] + [DAY + dt.timedelta(d) for d in range(0, 400, 13)])) for i in range(150)]
    captures += [captures[0], captures[1], (None, urls[0], DAY)]
    keys = {
        "url": [p[2] for p in map(parse, urls) if p],
        "host": [p[0] for p in map(parse, urls) if p],
        "domain": ["a.com", "x.a.com", "com", "b.org", "e.f", "localhost"],
        "prefix": ["a.com/p", "x.a.com/p/q", "b.org/P", "b.org/p", "a.com"],
    }
    events = []
    for _ in range(250):
        kind = rng.choice(url_filters.KINDS)
        at = rng.choice([None] + [DAY + dt.timedelta(d) for d in range(-50, 420, 7)])
        events.append((kind, rng.choice([*keys[kind], None]), rng.choice("lmn"), rng.random() < 0.3,
                       rng.choice(["add", "add", "remove", "other"]), at))
    return captures, events


def evaluated(spark, captures, events):
    c = spark.createDataFrame(captures, "page_id long, url string, fetched date").selectExpr(
        "*", "'x' AS host", "1 AS kind", "2 AS key", "3 AS id", "4 AS month"
    )
    e = spark.createDataFrame(
        events, "kind string, key string, list string, allows boolean, action string, day date"
    )
    return url_filters.evaluate(c, e).collect()


@pytest.mark.parametrize("seed", range(3))
def test_equals_plain_search(spark, seed):
    captures, events = world(seed)
    rows = evaluated(spark, captures, events)
    got = [(r["page_id"], r["fetched"], r["n_active"], r["lists"], r["verdict"], r["decided_by"]) for r in rows]
    want = [(i, d, *plain(u, d, events)) for i, u, d in set(captures)]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    captures, events = world(1)
    assert evaluated(spark, [], events) == []
    assert {r["verdict"] for r in evaluated(spark, captures, [])} == {"none"}


def test_query_equals_its_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    want = con.execute(queries.ORACLES["op2_url_filters"]).fetchall()
    names = [d[0] for d in con.description]
    rows = queries.op2_url_filters(spark, folder).select(*names).collect()
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert len({r["verdict"] for r in rows}) == 3


def test_history_matters(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    valid = url_filters.intervals(url_list.events(pages))
    assert valid.where("valid_to IS NOT NULL").count() and valid.where("valid_to IS NULL").count()
    assert valid.where("valid_to <= valid_from").count() == 0

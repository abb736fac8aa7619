"""URL filters as a temporal join: a capture meets the list entries active when it was fetched.

List events (an entry is added or removed on a day) become validity intervals: an entry
is active from an addition to the next event of the same entry. A capture gives the
keys that an entry can name: its URL, its host with every parent domain, and its
path prefixes. Keys are joined with intervals by kind, key and month, then by
the exact days, so an entry with a long history meets a capture with at most a
month of it, and the captures of a hot host are spread over months.

Only DataFrame functions are used. Tables are joined by shuffles unless Spark itself finds
one below ``spark.sql.autoBroadcastJoinThreshold``; adaptive execution splits hot keys.

What decides is the most specific active entry: URL, then longer path prefix, then
host, then longer parent domain; of equals an allowing one. A backslash counts as a slash, as
browsers read it; an IPv6 address in brackets is a host without parent domains. A NULL URL, or one without
``scheme://host``, matches nothing, as does a NULL day. Events with a NULL in any column
are left out; an addition and a removal on one day count as removed. Repeated
captures (same id, URL and day) give one row. Empty tables give empty results or no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: kinds of entries, the least specific first
KINDS = ("domain", "host", "prefix", "url")

_REST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)"
_HOST = r"^(?:[^/?@]*@)?(\[[0-9A-Fa-f:.]*\]|[^/?:@]*)"
_PATH = r"^[^/?]*([^?]*)"


def host(url: Column) -> Column:
    """Host in lower case, without user, port and a final dot; empty where there is none."""
    return F.lower(F.regexp_replace(F.regexp_extract(_rest(url), _HOST, 1), r"\.+$", ""))


def _rest(url: Column) -> Column:
    return F.translate(F.regexp_extract(url, _REST, 1), "\\", "/")


def address(url: Column) -> Column:
    """What a ``url`` entry names: host, path and query without scheme and fragment."""
    return F.concat(host(url), F.regexp_extract(_rest(url), r"^[^/?]*(.*)", 1))


def segments(url: Column) -> Column:
    """The non-empty parts of the path."""
    return F.filter(F.split(F.regexp_extract(_rest(url), _PATH, 1), "/"), lambda x: x != "")


def prefix(url: Column, depth: Column) -> Column:
    """What a ``prefix`` entry names: host and the first ``depth`` parts of the path."""
    return F.concat_ws("/", host(url), F.slice(segments(url), F.lit(1), depth))


def parents(name: Column) -> Column:
    """The domains above a host, down to two labels."""
    labels = F.when(name.startswith("["), F.array(name)).otherwise(F.split(name, r"\."))
    n = F.size(labels)
    starts = F.when(n > 2, F.sequence(F.lit(2), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(labels, i, n), "."))


def intervals(events: DataFrame) -> DataFrame:
    """``kind, key, list, allows, valid_from, valid_to`` from ``kind, key, list, allows, action, day``.

    ``valid_to`` is exclusive, NULL while the entry is still active. Events of one day are one
    first, so what stands in order per entry is at most a row a day.
    """
    entry = ["kind", "key", "list", "allows"]
    known = events.where(F.col("action").isin("add", "remove")).dropna(subset=[*entry, "day"])
    daily = known.groupBy(*entry, "day").agg(F.max("action").alias("action"))
    following = F.lead("day").over(Window.partitionBy(*entry).orderBy("day"))
    return (
        daily.withColumn("valid_to", following)
        .where("action = 'add'")
        .select(*entry, F.col("day").alias("valid_from"), "valid_to")
    )


def _keys(url: Column, depth: int) -> Column:
    """Kinds and keys of a capture; prefixes no deeper than any entry's."""
    name, parts = host(url), F.size(segments(url))
    deep = F.least(parts, F.lit(depth))
    prefixes = F.when(deep > 0, F.sequence(F.lit(1), deep)).otherwise(F.array().cast("array<int>"))

    def of(kind: str, keys: Column) -> Column:
        return F.transform(keys, lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("key")))

    every = F.concat(
        of("url", F.array(address(url))),
        of("prefix", F.transform(prefixes, lambda d: prefix(url, d))),
        of("host", F.array(name)),
        of("domain", F.concat(F.array(name), parents(name))),
    )
    return F.when(name != "", F.array_distinct(every))


def _month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day)


def evaluate(
    captures: DataFrame,
    events: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    day_col: str = "fetched",
) -> DataFrame:
    """Per capture: id, host, day, ``n_active`` entries, their ``lists``, the ``verdict`` and its key.

    ``verdict`` is block, allow or none. ``lists`` are sorted and comma-joined.
    """
    rows = captures.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{day_col}`").cast("date").alias("day"),
    )
    valid = intervals(events)
    # three numbers: how deep entries go, and to which month the last intervals reach
    depth = valid.where("kind = 'prefix'").agg(F.max(F.size(F.split("key", "/")) - 1)).first()[0]
    first, last = rows.agg(F.min(_month(F.col("day"))), F.max(_month(F.col("day")))).first()
    begins = F.greatest(_month(F.col("valid_from")), F.lit(first))
    ends = F.least(_month(F.date_sub(F.coalesce("valid_to", "far"), 1)), F.lit(last))
    by_month = (
        valid.withColumn("far", F.lit("9999-12-31").cast("date"))
        .withColumns({"begins": begins, "ends": ends})
        .where("begins <= ends")
        .withColumn("month", F.explode(F.sequence("begins", "ends")))
        .drop("begins", "ends", "far")
    )
    keyed = rows.select(
        "*",
        host(F.col("url")).alias("host"),
        _month(F.col("day")).alias("month"),
        F.explode_outer(_keys(F.col("url"), depth or 0)).alias("at"),
    ).select("id", "url", "day", "host", "month", "at.kind", "at.key")
    active = (F.col("valid_from") <= F.col("day")) & (
        F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))
    )
    met = keyed.alias("c").join(
        by_month.alias("v"),
        (F.col("c.kind") == F.col("v.kind"))
        & (F.col("c.key") == F.col("v.key"))
        & (F.col("c.month") == F.col("v.month"))
        & active,
        "left",
    )
    place = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("v.kind"))
    entry = F.struct(
        place.alias("place"), F.length("v.key").alias("length"), F.col("v.allows"), F.col("v.key"), F.col("v.list")
    )
    found = met.groupBy("id", "url", "day", "host").agg(
        F.collect_set(F.when(F.col("v.list").isNotNull(), entry)).alias("entries")
    )
    best = F.array_max("entries")
    return found.select(
        F.col("id").alias(id_col),
        F.when(F.col("host") != "", F.col("host")).alias("host"),
        F.col("day").alias(day_col),
        F.size("entries").cast("long").alias("n_active"),
        F.array_join(F.array_sort(F.array_distinct("entries.list")), ",").alias("lists"),
        F.when(best.isNull(), "none").when(best["allows"], "allow").otherwise("block").alias("verdict"),
        best["key"].alias("decided_by"),
    )

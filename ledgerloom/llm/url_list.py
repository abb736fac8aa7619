"""A dated block list and fetch days for the given ``pages``, by arithmetic on digests of keys.

The given tables have neither; any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import url_filters as u

FIRST_DAY = "2024-01-01"

#: list, kind, allows, one in how many keys, days over which additions spread, days to removal
#: (of even digests) and to another addition (of digests that 3 divides); 0: never
LISTS = (
    ("spam", "host", False, 7, 200, 90, 150),
    ("farm", "domain", False, 5, 250, 60, 0),
    ("trusted", "host", True, 11, 100, 0, 0),
    ("section", "prefix", False, 6, 300, 45, 0),
    ("page", "url", False, 13, 300, 30, 60),
)


def _digest(key: Column, name: str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{name}:"), key)), 1, 6), 16, 10).cast("int")


def _day(offset: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), offset.cast("int"))


def captures(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", _day(F.pmod(F.col("page_id") * 53, F.lit(365))).alias("fetched"))


def events(pages: DataFrame) -> DataFrame:
    """Additions and removals of ``LISTS``, over the keys that occur in ``pages``."""
    url = F.col("url")
    key = {
        "url": F.array(u.address(url)),
        "host": F.array(u.host(url)),
        "prefix": F.when(F.size(u.segments(url)) > 0, F.array(u.prefix(url, F.lit(1)))),
        "domain": F.slice(u.parents(u.host(url)), 1, 1),
    }

    def entry(name: str, kind: str, allows: bool) -> Column:
        """The keys of one list, none where a URL gives none."""
        keys = F.coalesce(key[kind], F.array().cast("array<string>"))
        said = [F.lit(name).alias("list"), F.lit(kind).alias("kind"), F.lit(allows).alias("allows")]
        return F.transform(keys, lambda k: F.struct(*said, k.alias("key")))

    rows = [entry(name, kind, allows) for name, kind, allows, *_ in LISTS]
    entries = (
        pages.where(u.host(url) != "")
        .select(F.explode(F.concat(*rows)).alias("entry"))
        .select("entry.*")
        .distinct()
    )
    out = None
    for name, _, _, share, spread, removed, again in LISTS:
        d = _digest(F.col("key"), name)
        start = F.floor(d / share) % spread
        happens = F.array_compact(
            F.array(
                F.struct(F.lit("add").alias("action"), _day(start).alias("day")),
                F.when(
                    F.lit(removed > 0) & (d % 2 == 0),
                    F.struct(F.lit("remove").alias("action"), _day(start + removed).alias("day")),
                ),
                F.when(
                    F.lit(again > 0) & (d % 3 == 0),
                    F.struct(F.lit("add").alias("action"), _day(start + again).alias("day")),
                ),
            )
        )
        mine = (F.col("list") == name) & (d % share == 0)
        out = F.when(mine, happens) if out is None else out.when(mine, happens)
    return entries.select("*", F.explode(out).alias("event")).select(
        "kind", "key", "list", "allows", "event.action", "event.day"
    )


def oracle() -> str:
    """The same query for DuckDB over ``pages``."""
    rest = "translate(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^#]*)', 1), '\\', '/')"
    address = "\\[[0-9A-Fa-f:.]*\\]"
    lists = "\nUNION ALL ".join(
        f"SELECT '{name}' AS list, '{kind}' AS kind, {str(allows).lower()} AS allows, {share} AS share, "
        f"{spread} AS spread, {removed} AS removed, {again} AS again"
        for name, kind, allows, share, spread, removed, again in LISTS
    )
    return f"""
WITH split AS (
  SELECT page_id, url, DATE '{FIRST_DAY}' + CAST((page_id * 53) % 365 AS INTEGER) AS day,
         lower(regexp_replace(regexp_extract({rest}, '^(?:[^/?@]*@)?({address}|[^/?:@]*)', 1), '\\.+$', '')) AS host,
         {rest} AS rest
  FROM pages),
cut AS (
  SELECT DISTINCT page_id, url, day, host, host || regexp_extract(rest, '^[^/?]*(.*)', 1) AS address,
         list_filter(string_split(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/'), lambda x: x <> '') AS parts,
         CASE WHEN host LIKE '[%' THEN [host] ELSE string_split(host, '.') END AS labels
  FROM split),
keyed AS (
  SELECT page_id, day, 'url' AS kind, address AS key, address AS named FROM cut WHERE host <> ''
  UNION ALL
  SELECT page_id, day, 'host', host, address FROM cut WHERE host <> ''
  UNION ALL
  SELECT page_id, day, 'prefix', host || '/' || parts[1], address FROM cut WHERE host <> '' AND len(parts) > 0
  UNION ALL
  SELECT page_id, day, 'domain', array_to_string(labels[i:], '.'), address
  FROM (SELECT *, unnest(range(1, greatest(len(labels), 2))) AS i FROM cut WHERE host <> '')),
lists AS ({lists}),
listable AS (
  SELECT DISTINCT kind, key FROM keyed WHERE kind <> 'domain'
  UNION
  SELECT DISTINCT 'domain', array_to_string(labels[2:], '.') FROM cut WHERE len(labels) > 2),
entries AS (
  SELECT l.*, k.key, CAST('0x' || substr(md5(l.list || ':' || k.key), 1, 6) AS INTEGER) AS d
  FROM listable k JOIN lists l USING (kind)),
events AS (
  SELECT *, d // share % spread AS start FROM entries WHERE d % share = 0),
dated AS (
  SELECT list, kind, key, allows, 'add' AS action, start AS since FROM events
  UNION ALL SELECT list, kind, key, allows, 'remove', start + removed FROM events WHERE removed > 0 AND d % 2 = 0
  UNION ALL SELECT list, kind, key, allows, 'add', start + again FROM events WHERE again > 0 AND d % 3 = 0),
daily AS (
  SELECT list, kind, key, allows, since, max(action) AS action FROM dated GROUP BY ALL),
valid AS (
  SELECT *, DATE '{FIRST_DAY}' + CAST(since AS INTEGER) AS valid_from,
         DATE '{FIRST_DAY}' + CAST(lead(since) OVER (PARTITION BY list, kind, key, allows ORDER BY since) AS INTEGER) AS valid_to
  FROM daily),
met AS (
  SELECT DISTINCT k.page_id, k.day, k.named, v.list, v.kind, v.key, v.allows
  FROM keyed k JOIN valid v ON k.kind = v.kind AND k.key = v.key AND v.action = 'add'
    AND v.valid_from <= k.day AND (v.valid_to IS NULL OR k.day < v.valid_to)),
summed AS (
  SELECT page_id, day, named, count(*) AS n, string_agg(DISTINCT list, ',' ORDER BY list) AS lists,
         max({{'place': list_position(['domain', 'host', 'prefix', 'url'], kind), 'length': length(key),
              'allows': allows, 'key': key, 'list': list}}) AS best
  FROM met GROUP BY ALL)
SELECT c.page_id, nullif(c.host, '') AS host, CAST(c.day AS VARCHAR) AS fetched, coalesce(s.n, 0) AS n_active, coalesce(s.lists, '') AS lists,
       CASE WHEN s.best IS NULL THEN 'none' WHEN s.best.allows THEN 'allow' ELSE 'block' END AS verdict,
       s.best.key AS decided_by
FROM cut c LEFT JOIN summed s ON c.page_id = s.page_id AND c.day = s.day AND c.address = s.named AND c.host <> ''
"""

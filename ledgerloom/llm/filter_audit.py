"""What a chain of document filters removes, in every order of its filters.

Each document fails some of five filters, which makes a mask of five bits. Documents
are counted per part and mask, and each of these few cells is folded across the
constant array of all orders: a document is removed by the first filter of an order
that it fails, and met again, redundantly, by the later ones. A cell gives one weighted
struct per order and step; those of a part's cells, 32 at most, are added element by
element. Nothing but counts is ever held per order.

A NULL text counts as empty, a NULL part is the empty text. A repeated text fails ``E``
unless its id is the least that has the text; rows without an id neither fail ``E`` nor
make others fail. Repeated rows count as often as they occur. Labels that repeat an id
hold if one of its rows holds. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import materialize

FILTERS = "ABCDE"
ORDERS = tuple("".join(p) for p in permutations(FILTERS))
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")

_WHITE = " \t\n\x0b\x0c\r"


def measured(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """Per row: id, part, the mask of the filters that need one text alone, digest of the text."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    part = F.coalesce(F.col(f"`{part_col}`").cast("string"), F.lit(""))
    source = docs.select(F.col(f"`{id_col}`").alias("id"), part.alias("part"), text.alias("text"))
    inner = F.btrim("text", F.lit(_WHITE))
    words = F.when(inner != "", F.split(inner, r"[\x20\x09-\x0D]+"))
    n = F.coalesce(F.array_size("words"), F.lit(0))
    distinct = F.coalesce(F.array_size(F.array_distinct("words")), F.lit(0))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = (
        n < 200,
        100 * distinct.cast("long") < 50 * n.cast("long"),
        100 * capitals.cast("long") > 3 * F.length("text").cast("long"),
        F.col("text").rlike("[#$%&*|]"),
    )
    mask = sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(fails)), F.lit(0))
    digest = F.unhex(F.sha2(F.col("text"), 256))
    return source.withColumn("words", words).select(
        "id", "part", mask.alias("mask"), digest.alias("digest")
    )


def cells(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Documents per part and mask: all, good and toxic ones.

    Equal rows are counted before they meet labels and texts, and a text meets its first id by
    both, so a text or an id that many rows share stays spread.
    """
    rows = measured(docs, id_col, text_col, part_col)
    rows = materialize(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")), "measured")
    first = rows.groupBy("digest").agg(F.min("id").alias("id"))
    first = first.where("id IS NOT NULL").withColumn("first", F.lit(True))
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), "quality", "toxic")
        .groupBy("id")
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    repeats = F.col("first").isNull() & F.col("id").isNotNull()
    mask = F.col("mask") + F.when(repeats, 16).otherwise(0)
    good, toxic = (F.coalesce(F.col(c), F.lit(0)) for c in ("good", "toxic"))
    return (
        rows.join(first, ["digest", "id"], "left")
        .select("id", "part", mask.alias("mask"), "n")
        .join(known, "id", "left")
        .groupBy("part", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * good).alias("good"),
            F.sum(F.col("n") * toxic).alias("toxic"),
        )
    )


def _steps(order: Column, cell: dict[str, Column]) -> Column:
    """The structs of one order for one cell: the fold of its letters over the cell's mask."""
    none = F.lit(0).cast("long")

    def step(state: Column, letter: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), letter) - 1)
        fails = cell["mask"].bitwiseAND(bit) != 0
        lost = state["alive"] & fails
        counts = {
            "kept": F.when(state["alive"] & ~fails, cell["n"]),
            "removed": F.when(lost, cell["n"]),
            "redundant": F.when(~state["alive"] & fails, cell["n"]),
            "unique_fails": F.when(cell["mask"] == bit, cell["n"]),
            "good_lost": F.when(lost, cell["good"]),
            "toxic_lost": F.when(lost, cell["toxic"]),
        }
        row = F.struct(
            order.alias("filter_order"),
            letter.alias("letter"),
            *[F.coalesce(counts[c], none).alias(c) for c in COUNTS],
        )
        return F.struct(
            (state["alive"] & ~fails).alias("alive"), F.concat(state["rows"], F.array(row)).alias("rows")
        )

    fields = ",".join(["filter_order:string", "letter:string", *[f"{c}:bigint" for c in COUNTS]])
    start = F.struct(
        F.lit(True).alias("alive"), F.array().cast(f"array<struct<{fields}>>").alias("rows")
    )
    letters = F.split(order, "")
    return F.aggregate(letters, start, step, lambda state: state["rows"])


def _added(left: Column, right: Column) -> Column:
    """Two arrays of structs, their counts added element by element."""

    def both(x: Column, y: Column) -> Column:
        return F.struct(
            x["filter_order"].alias("filter_order"),
            x["letter"].alias("letter"),
            *[(x[c] + y[c]).alias(c) for c in COUNTS],
        )

    return F.zip_with(left, right, both)


def audit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """Per part, order and step: the COUNTS, and ``shapley``, the filter's removals over all orders."""
    counted = cells(docs, labels, id_col, text_col, part_col)
    cell = {c: F.col(c) for c in ("mask", "n", "good", "toxic")}
    orders = F.array(*[F.lit(o) for o in ORDERS])
    folded = counted.select(
        "part", F.flatten(F.transform(orders, lambda o: _steps(o, cell))).alias("rows")
    )
    # at most 32 cells a part
    lists = folded.groupBy("part").agg(F.collect_list("rows").alias("lists"))
    rest = F.slice("lists", F.lit(2), F.size("lists"))
    merged = lists.select("part", F.aggregate(rest, F.get("lists", F.lit(0)), _added).alias("rows"))

    def removals(letter: str) -> Column:
        own = F.filter("rows", lambda x: x["letter"] == letter)
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, x: total + x["removed"])

    shapley = F.create_map(*[c for f in FILTERS for c in (F.lit(f), removals(f))])
    places = merged.withColumn("shapley", shapley).select(
        "part", "shapley", F.posexplode("rows").alias("place", "row")
    )
    return places.select(
        "part",
        "row.filter_order",
        (F.col("place") % len(FILTERS) + 1).cast("int").alias("step"),
        *[f"row.{c}" for c in COUNTS],
        F.try_element_at("shapley", F.col("row.letter")).alias("shapley"),
    )


def oracle() -> str:
    """The same query for DuckDB, document by document."""
    return """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
marks AS (
  SELECT d.doc_id, part,
         coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
         {'A': len(words) < 200,
          'B': 100 * len(list_distinct(words)) < 50 * len(words),
          'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
          'D': regexp_matches(text, '[#$%&*|]'),
          'E': coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY text), false)} AS fails
  FROM texts d
  LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
             FROM labels GROUP BY doc_id) l ON l.doc_id = d.doc_id),
failing AS (
  SELECT part, good, toxic,
         [fails.A, fails.B, fails.C, fails.D, fails.E] AS fails
  FROM marks),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order, [a.i, b.i, c.i, d.i, e.i] AS places
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (
  SELECT part, filter_order, places, step, good, toxic, fails[places[step]] AS fails_here,
         list_bool_or([false] || list_transform(places[1:step - 1], lambda p: fails[p])) AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AS single
  FROM failing, orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
summed AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter,
         count_if(NOT gone AND NOT fails_here) AS kept,
         count_if(NOT gone AND fails_here) AS removed,
         count_if(gone AND fails_here) AS redundant,
         count_if(fails_here AND single) AS unique_fails,
         count_if(NOT gone AND fails_here AND good) AS good_lost,
         count_if(NOT gone AND fails_here AND toxic) AS toxic_lost
  FROM steps GROUP BY ALL)
SELECT part, filter_order, step,
       CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed"""

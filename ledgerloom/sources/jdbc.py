"""Optional JDBC source and sink for a warehouse outside Spark."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.schemas import PRIMARY_KEY

PARTITIONS = 16


def ranges_query(table: str, key: str, partitions: int = PARTITIONS) -> str:
    """SQL that asks the source where to cut a table: the least key of each of ``partitions`` parts
    with equally many rows. Works for any type that the source can sort."""
    part = f"SELECT {key} AS k, NTILE({partitions}) OVER (ORDER BY {key}) AS part"
    return f"SELECT MIN(k) AS low, part FROM ({part} FROM {table} WHERE {key} IS NOT NULL) cut GROUP BY part"


def _literal(value: object) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value}'"
    if isinstance(value, dt.date):
        return f"DATE '{value}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    text = str(value).replace("'", "''")
    return f"'{text}'"


def range_predicates(key: str, lows: Sequence[object]) -> list[str]:
    """Conditions that split all rows at the given keys; every row fits one of them.

    Parts that begin with the same key, because many rows hold it, are one part. NULL goes with
    the first part; without any key there is one condition that holds for all rows. ``lows`` are
    in the source's own order, which for texts may be another than Python's.
    """
    cuts = list(dict.fromkeys(x for x in lows if x is not None))[1:]
    marks = [_literal(x) for x in cuts]
    if not marks:
        return ["1 = 1"]
    inner = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(marks, marks[1:], strict=False)]
    return [f"{key} < {marks[0]} OR {key} IS NULL", *inner, f"{key} >= {marks[-1]}"]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str | None = None,
    partitions: int = PARTITIONS,
    predicates: Sequence[str] = (),
) -> DataFrame:
    """A table or ``(query) AS alias``, read by several tasks.

    The source is asked once for the keys at which to cut, which are ``partitions`` values, and
    each part is a condition on ``key``: by default the table's primary key, where its name
    is one of the engine's tables. ``predicates`` are conditions of the caller's instead, one for
    each task; ``hash_predicates`` makes some. ``partitions=1`` reads with one task.
    """
    options = {"fetchsize": "10000", **properties}
    if not predicates and partitions > 1:
        key = key or PRIMARY_KEY.get(table.rsplit(".", 1)[-1])
        if key is None:
            raise ValueError(f"name a key by which {table} can be read in parts, or ask for one part")
        query = f"({ranges_query(table, key, partitions)}) bounds"
        found = spark.read.jdbc(url, query, properties=options).collect()  # one row per part
        in_order = sorted(found, key=lambda row: row[1])
        predicates = range_predicates(key, [row[0] for row in in_order])
    if predicates:
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=options)
    return spark.read.jdbc(url, table, properties=options)


def hash_predicates(expression: str, partitions: int) -> list[str]:
    """Conditions for ``partitions`` parts by a whole-number SQL expression of the database.

    For a text key of PostgreSQL that is ``hashtext(key)``. NULL goes with the first part.
    """
    parts = [f"mod(mod({expression}, {partitions}) + {partitions}, {partitions}) = {k}" for k in range(partitions)]
    return [f"{parts[0]} OR ({expression}) IS NULL", *parts[1:]]


def write_table(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    connections: int = 16,
) -> None:
    """Overwrite keeps the table's definition; at most ``connections`` tasks write at once."""
    options = {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": str(connections),
        **properties,
    }
    df.write.format("jdbc").mode(mode).options(**options).save()

"""Spans of a text as a column: building it, counting kinds, and the digests of queries."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SQL = "array<struct<kind:string,start:long,end:long,base:boolean>>"
_ARROW = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
)


def ordered(found: list[tuple], kinds: Sequence[str]) -> list[tuple]:
    """By start, then the kind's place in ``kinds``, then end."""
    return sorted(found, key=lambda x: (x[1], kinds.index(x[0]), x[2]))


def array(rows: Iterable[list[tuple]]) -> pa.Array:
    names = ("kind", "start", "end", "base")
    return pa.array([[dict(zip(names, x, strict=True)) for x in row] for row in rows], _ARROW)


def count(spans: str, kind: str) -> Column:
    """Base spans of one kind."""
    return F.size(F.filter(spans, lambda x: x["base"] & (x["kind"] == kind))).cast("long")


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined in their order."""
    return F.array_join(
        F.transform(
            spans,
            lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def base_digest(spans: str) -> Column:
    return F.sha2(joined(F.filter(spans, lambda x: x["base"])), 256)

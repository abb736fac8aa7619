"""Ranks of all rows by a distributed LSD radix sort.

Rows have places, and a run of places is a block. A pass counts each digit of the key in each
block, adds the counts up over digits and then blocks, and so knows where a block's rows
with a digit go: there they stand in the order that they had. Passes from the lowest
digit to the highest leave all rows in the order of the key. A block bounds what one task
handles, a digit bounds the table of totals; no pass puts rows of one key together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.session import materialize

DIGIT_BITS = 11  # totals: at most 2048 rows
BLOCK_BITS = (10, 16)  # smallest and largest block, as powers of two
BLOCKS = 512  # blocks grow from the smallest when there would be more

_BEFORE = (Window.unboundedPreceding, -1)


def block_bits(rows: int) -> int:
    least, most = BLOCK_BITS
    return min(max(least, (rows // BLOCKS).bit_length()), most)


def _pass(rows: DataFrame, digit: Column, bits: int) -> DataFrame:
    """Rows with their places after a stable counting sort by ``digit``."""
    marked = rows.withColumns({"_digit": digit, "_block": F.shiftright("_place", bits)})
    counts = marked.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_held"))
    totals = counts.groupBy("_digit").agg(F.sum("_held").alias("_all"))
    lower = F.sum("_all").over(Window.orderBy("_digit").rowsBetween(*_BEFORE))
    earlier = F.sum("_held").over(
        Window.partitionBy("_digit").orderBy("_block").rowsBetween(*_BEFORE)
    )
    none = F.lit(0).cast("long")
    offsets = (
        counts.withColumn("_earlier", F.coalesce(earlier, none))
        .join(F.broadcast(totals.select("_digit", F.coalesce(lower, none).alias("_lower"))), "_digit")
        .select("_digit", "_block", (F.col("_lower") + F.col("_earlier")).alias("_start"))
    )
    within = Window.partitionBy("_digit", "_block").orderBy("_place")
    moved = marked.withColumn("_nth", F.row_number().over(within) - 1)
    return moved.join(offsets, ["_digit", "_block"]).select(
        *[c for c in rows.columns if c != "_place"],
        (F.col("_start") + F.col("_nth")).alias("_place"),
    )


def ranked(rows: DataFrame, keys: Sequence[str], place: str = "place") -> DataFrame:
    """``rows`` with the column ``place``: 0, 1, 2... in ascending order of ``keys``, first key first.

    Keys are whole numbers from 0 on, without NULLs. Rows with equal keys stand in any order.
    ``rows`` should be stored, as its rows are numbered where they lie. Each pass is stored,
    so a lost executor costs no more than a part of one pass. No column may be called like the
    working ones (``_place``, ``_digit``, ``_block``...).
    """
    tops = rows.agg(F.count(F.lit(1)), *[F.max(k) for k in keys]).first()
    bits = block_bits(tops[0])
    sizes = [int(t or 0).bit_length() for t in tops[1:]]
    passes = [
        (key, low)
        for key, size in reversed(list(zip(keys, sizes, strict=True)))
        for low in range(0, size, DIGIT_BITS)
    ] or [(keys[0], 0)]
    placed = materialize(rows.withColumn("_place", F.monotonically_increasing_id()), "places")
    for key, low in passes:
        digit = F.shiftright(F.col(key).cast("long"), low).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
        placed = materialize(_pass(placed, digit, bits), "pass")
    return placed.withColumnRenamed("_place", place)

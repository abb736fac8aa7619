"""What the text operators share: bounded slices of Arrow batches, word splits, code shipping.

Every operator takes a DataFrame and the names of its id and text columns, reads
those two only, and so ignores further columns whatever their names. A NULL text
counts as empty. Repeated rows give repeated results; a NULL id stays NULL.
"""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 8 << 20  # text that a task holds as Python strings at once, a single text aside

_LOWER = bytes(range(0x41)) + bytes(range(0x61, 0x7B)) + bytes(range(0x5B, 0x100))

_shipped: dict[str, str] = {}

#: what this Python worker keeps between tasks: one thing at a time, by its kind and key
_kept: dict[tuple, object] = {}


def kept(key: tuple, make: Callable[[], object]):
    """``make()``, kept by this worker for its next tasks until another thing is kept, or ``forget``."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Give back the memory of what the worker kept for an operator that came before.

    Workers outlive stages. A stage that begins with this has the memory that it has alone.
    """
    if not _kept:
        return
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def lower_ascii(text: str) -> str:
    """``text`` with A-Z in lower case; offsets stay as they are."""
    return text.encode().translate(_LOWER).decode()


def lower_words(text: str) -> list[bytes]:
    """Words between white space (x20, x09-x0D), A-Z in lower case, as UTF-8."""
    return text.encode().translate(_LOWER).split()


def ship(spark: SparkSession) -> None:
    """Give the package to the executors' Python once per application, as ``--py-files`` would."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="ledgerloom-code-")  # read by this driver alone
    path = os.path.join(folder, "ledgerloom_code.zip")
    with zipfile.ZipFile(path, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    spark.sparkContext.addPyFile(path)
    _shipped[app] = path


def id_and_text(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns that an operator reads, as ``id`` and ``text``."""
    return docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )


def slices(
    batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of about ``most`` bytes of ``column``, so that memory stays bounded."""
    sizes = pc.fill_null(pc.binary_length(batch[column]), 0).to_pylist()
    start = total = 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield batch.slice(start, i + 1 - start)
            start, total = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def texts(batch: pa.RecordBatch) -> list[str]:
    return [t or "" for t in batch["text"].to_pylist()]


def _rows_through(
    docs: DataFrame, text_col: str, work: Callable[[], Callable[[pa.RecordBatch, str], pa.RecordBatch]]
) -> DataFrame:
    """``docs`` after ``work()`` on slices of whole rows, told the name of the text column there.

    Rows go through Python as Arrow batches, so none waits in the JVM for what becomes of its text.
    """
    ship(docs.sparkSession)
    columns = docs.columns
    rows = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    text = f"_{columns.index(text_col)}"
    named = rows.toDF(*[f"_{i}" for i in range(len(columns))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        change = work()
        for batch in batches:
            for piece in slices(batch, text):
                yield change(piece, text)
        pa.default_memory_pool().release_unused()

    return named.mapInArrow(run, named.schema).toDF(*columns)


def with_texts(docs: DataFrame, text_col: str, change: Callable[[str], str]) -> DataFrame:
    """``docs`` with each text changed in place; NULL texts and all other columns stay."""

    def work():
        def changed(piece: pa.RecordBatch, text: str) -> pa.RecordBatch:
            given = piece[text].to_pylist()
            new = pa.array([t if t is None else change(t) for t in given], pa.string())
            parts = [new if n == text else piece[n] for n in piece.schema.names]
            return pa.RecordBatch.from_arrays(parts, piece.schema.names)

        return changed

    return _rows_through(docs, text_col, work)


def rows_where(
    docs: DataFrame, text_col: str, make: Callable[[], Callable[[list[str]], list[bool]]]
) -> DataFrame:
    """The rows of ``docs`` whose texts ``make()`` says yes to; a NULL text counts as empty."""

    def work():
        wanted = make()

        def kept(piece: pa.RecordBatch, text: str) -> pa.RecordBatch:
            return piece.filter(pa.array(wanted([t or "" for t in piece[text].to_pylist()]), pa.bool_()))

        return kept

    return _rows_through(docs, text_col, work)


def per_text(
    docs: DataFrame,
    columns: dict[str, str],
    make: Callable[[], Callable[[list[str]], list[pa.Array]]],
    id_col: str,
    text_col: str,
    most: int = SLICE_BYTES,
) -> DataFrame:
    """One output row for each input row: the id and what ``make()`` computes from the text.

    ``make`` runs once per task and returns a function from the texts of a slice
    to one Arrow array for each of ``columns`` (name: SQL type).
    """
    ship(docs.sparkSession)
    source = id_and_text(docs, id_col, text_col)
    out = T.StructType(
        [T.StructField(id_col, source.schema["id"].dataType)]
        + [T.StructField(n, T.DataType.fromDDL(t)) for n, t in columns.items()]
    )
    names = [id_col, *columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for piece in slices(batch, most=most):
                yield pa.RecordBatch.from_arrays([piece["id"], *compute(texts(piece))], names)

    return source.mapInArrow(run, out)

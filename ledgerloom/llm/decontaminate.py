"""Benchmark decontamination by winnowing.

Texts become words, A-Z in lower case, split at ASCII characters other than
letters and digits. Of every ``WINDOW`` consecutive k-grams of ``GRAM`` words the
one with the smallest hash (the last among equals) is a fingerprint, so any span
of ``SPAN = GRAM + WINDOW - 1`` words that a document shares with a benchmark
item has a fingerprint in common at the same place. Fingerprints of documents
are joined with those of the benchmark, and every hit is extended to the windows
of ``SPAN`` words around it and compared word by word. An item of fewer words is
one window; it is found by its own length as k and a window of one.

The benchmark is the stated query set: it is cut into blocks of at most
``BLOCK_WORDS`` words, each broadcast, and all documents meet every block. One
block (the usual case) needs no shuffle at all; with several, the few hits per
document are merged. Memory in a task depends on the block and a slice of text,
never on the number of documents that share a passage.

A NULL or empty text has no words and no hits; an item without words has no
window; a NULL item id counts for hits but is not listed; equal item ids are
listed once. An empty benchmark hits nothing. Repeated document rows stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import id_and_text, rows_where, ship, slices, texts

GRAM, WINDOW = 5, 6
SPAN = GRAM + WINDOW - 1
BLOCK_WORDS = 2_000_000

# words: everything but ASCII control characters, punctuation and space, in lower case
_TABLE = bytes(
    (c + 32 if 0x41 <= c <= 0x5A else c) if c >= 0x80 or chr(c).isalnum() else 0x20
    for c in range(256)
)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[bytes]:
    return text.encode().translate(_TABLE).split()


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _hash(ids: np.ndarray, starts: np.ndarray | None, n: int) -> np.ndarray:
    """Of the n-grams of ``ids`` at ``starts``, by default at every place."""
    out = np.zeros(max(len(ids) - n + 1, 0) if starts is None else len(starts), np.uint64)
    for j in range(n):
        part = ids[j : j + len(out)] if starts is None else ids[starts + j]
        out = out * _ODD + part.astype(np.uint64) + np.uint64(1)
    return _mix(out)


def winnow(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the fingerprints of one sequence of word ids."""
    grams = _hash(ids, None, GRAM)
    if len(grams) < WINDOW:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    least, at = grams[: len(grams) - WINDOW + 1].copy(), np.zeros(len(grams) - WINDOW + 1, np.int64)
    for j in range(1, WINDOW):
        part = grams[j : j + len(least)]
        lower = part <= least
        least[lower] = part[lower]
        at[lower] = j
    at += np.arange(len(at))
    chosen = np.zeros(len(grams), bool)
    chosen[at] = True
    places = np.flatnonzero(chosen)
    return places, grams[places]


class _Windows:
    """Distinct windows of one length, and which items have each."""

    def __init__(self, ids: np.ndarray, starts: np.ndarray, items: np.ndarray, n: int):
        hashes = _hash(ids, starts, n)
        self.hashes, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.content = np.stack([ids[starts[first] + j] for j in range(n)], 1)
        pairs = np.unique(np.stack([which, items], 1), axis=0)
        self.items = pairs[:, 1]
        self.offsets = np.searchsorted(pairs[:, 0], np.arange(len(self.hashes) + 1))
        self.n = n

    def find(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of the n-grams at ``starts`` those that are windows: place, number of the window."""
        starts = starts[starts + self.n <= len(ids)]
        at = np.searchsorted(self.hashes, _hash(ids, starts, self.n))
        at[at == len(self.hashes)] = 0
        same = np.ones(len(starts), bool)
        for j in range(self.n):
            same &= ids[starts + j] == self.content[at, j]
        return starts[same], at[same]


class Block:
    """Some benchmark items, ready to be looked for. ``items``: pairs (id as text, words)."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]]):
        self.names = [name for name, _ in items]
        self.vocabulary: dict[bytes, int] = {}
        number = self.vocabulary.setdefault
        stream, long_at, long_item, prints = [], [], [], []
        short: dict[int, list[tuple[int, int]]] = {}
        for k, (_, item) in enumerate(items):
            ids = [number(w, len(self.vocabulary) + 1) for w in item]
            if len(ids) >= SPAN:
                starts = range(len(stream), len(stream) + len(ids) - SPAN + 1)
                long_at += starts
                long_item += [k] * len(starts)
                prints.append(winnow(np.array(ids))[1])
            elif ids:
                short.setdefault(len(ids), []).append((len(stream), k))
            stream += ids
        array = np.array(stream, np.int64)
        self.windows = [
            _Windows(array, *map(np.array, zip(*found, strict=True)), n)
            for n, found in sorted(short.items())
        ]
        self.prints = np.unique(np.concatenate(prints)) if prints else np.empty(0, np.uint64)
        self.long = (
            _Windows(array, np.array(long_at), np.array(long_item), SPAN) if long_at else None
        )

    def hits(self, ids: np.ndarray) -> Iterator[tuple[_Windows, np.ndarray, np.ndarray]]:
        """Occurrences of windows in ``ids`` (0: a word of no item): windows, places, numbers."""
        for short in self.windows:
            first = np.zeros(len(self.vocabulary) + 1, bool)
            first[short.content[:, 0]] = True
            yield short, *short.find(ids, np.flatnonzero(first[ids]))
        if self.long:
            places, hashes = winnow(ids)
            known = (ids[places] > 0) & (ids[places + GRAM - 1] > 0)
            places, hashes = places[known], hashes[known]
            at = np.searchsorted(self.prints, hashes)
            at[at == len(self.prints)] = 0
            places = places[self.prints[at] == hashes]
            around = np.unique((places[:, None] - np.arange(WINDOW)).ravel())
            yield self.long, *self.long.find(ids, around[around >= 0])

    def search(
        self, documents: list[list[bytes]]
    ) -> tuple[list[list[tuple[int, int]]], list[list[str]]]:
        """Per document: intervals of hit words, and the ids of the items with a window in it."""
        get = self.vocabulary.get
        ends = np.cumsum([len(d) + 1 for d in documents])
        begins = ends - [len(d) + 1 for d in documents]
        ids = np.zeros(int(ends[-1]) if documents else 0, np.int64)  # a 0 ends each document
        for d, b in zip(documents, begins, strict=True):
            ids[b : b + len(d)] = [get(w, 0) for w in d]
        change = np.zeros(len(ids) + 1, np.int64)
        pairs = []
        for windows, places, numbers in self.hits(ids):
            np.add.at(change, places, 1)
            np.add.at(change, places + windows.n, -1)
            where = np.searchsorted(ends, places, "right")
            once = np.unique(np.stack([where, numbers], 1), axis=0)
            counts = windows.offsets[once[:, 1] + 1] - windows.offsets[once[:, 1]]
            skip = np.repeat(windows.offsets[once[:, 1]] - np.cumsum(counts) + counts, counts)
            items = windows.items[np.arange(len(skip)) + skip]
            pairs.append(np.stack([np.repeat(once[:, 0], counts), items], 1))
        spans: list[list[tuple[int, int]]] = [[] for _ in documents]
        found: list[list[str]] = [[] for _ in documents]
        edges = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change) > 0, [0]])))
        for s, e in edges.reshape(-1, 2):
            d = int(np.searchsorted(ends, s, "right"))
            spans[d].append((int(s - begins[d]), int(e - begins[d])))
        for d, k in np.unique(np.concatenate(pairs), axis=0) if pairs else ():
            if self.names[k] is not None:
                found[d].append(self.names[k])
        return spans, [sorted(set(x)) for x in found]


def blocks(
    benchmark: DataFrame, item_col: str, text_col: str, block_words: int = BLOCK_WORDS
) -> Iterator[Block]:
    """The benchmark in blocks of at most ``block_words`` words.

    A longer item is cut into parts that overlap by SPAN - 1 words, so no window is lost.
    """
    block_words = max(block_words, 2 * SPAN)
    items, held = [], 0
    source = id_and_text(benchmark, item_col, text_col)
    for name, text in source.select(F.col("id").cast("string"), "text").toLocalIterator():
        item = words(text or "")
        step = block_words - SPAN + 1
        for i in range(0, max(len(item) - SPAN + 1, 1), step):
            part = item[i : i + block_words]
            if items and held + len(part) > block_words:
                yield Block(items)
                items, held = [], 0
            items.append((name, part))
            held += len(part)
    yield Block(items)


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _as_spans(rows: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": s, "end": e} for s, e in row] for row in rows], _SPANS)


def _union(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted((x["start"], x["end"]) for x in spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Per row of ``docs``: the id, ``n_words``, ``hits`` and ``items``.

    ``hits`` are the intervals of hit words (start, end exclusive), apart and in order;
    ``items`` the ids, as sorted text, of the items with a window in the document.
    """
    spark = docs.sparkSession
    ship(spark)
    source = id_and_text(docs, id_col, text_col)
    out = T.StructType(
        [T.StructField(id_col, source.schema["id"].dataType)]
        + [T.StructField("text_hash", T.StringType()), T.StructField("n_words", T.LongType())]
        + [T.StructField("hits", T.DataType.fromDDL("array<struct<start:long,end:long>>"))]
        + [T.StructField("items", T.DataType.fromDDL("array<string>"))]
    )

    def searched(block: Block, whole: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch):
                    split = [words(t) for t in texts(piece)]
                    spans, items = shared.value.search(split)
                    yield pa.RecordBatch.from_arrays(
                        [
                            piece["id"],
                            piece["text_hash"],
                            pa.array([len(x) for x in split], pa.int64()),
                            _as_spans(spans),
                            pa.array(items, pa.list_(pa.string())),
                        ],
                        out.fieldNames(),
                    )

        key = F.lit(None).cast("string") if whole else F.sha2(F.coalesce("text", F.lit("")), 256)
        return source.select("id", "text", key.alias("text_hash")).mapInArrow(run, out)

    # one block ahead: whether it is the only one is known before any is planned
    cut = blocks(benchmark, item_col, item_text_col, block_words)
    first, second = next(cut), next(cut, None)
    found = searched(first, second is None)
    if second is None:
        return found.drop("text_hash")
    parts = 2
    found = found.union(searched(second, False))
    for block in cut:
        found = found.union(searched(block, False))
        parts += 1
    # the same id with the same text has the same hits, so copies are counted and repeated
    merged = found.groupBy(id_col, "text_hash", "n_words").agg(
        F.flatten(F.collect_set("hits")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        (F.count(F.lit(1)) / parts).cast("int").alias("copies"),
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = _as_spans([_union(x) for x in batch["hits"].to_pylist()])
            columns = [batch[c] if c != "hits" else hits for c in batch.schema.names]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    whole = merged.mapInArrow(joined, merged.schema)
    copies = F.explode(F.sequence(F.lit(1), "copies")).alias("copy")
    return whole.select(id_col, "n_words", "hits", "items", copies).drop("copy")


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` without a hit, with all their columns. No row is moved.

    Every block of the benchmark is a filter of its own.
    """
    spark = docs.sparkSession
    ship(spark)
    for block in blocks(benchmark, item_col, item_text_col, block_words):
        shared = spark.sparkContext.broadcast(block)

        def make(shared=shared):
            def free(texts: list[str]) -> list[bool]:
                spans, _ = shared.value.search([words(t) for t in texts])
                return [not x for x in spans]

            return free

        docs = rows_where(docs, text_col, make)
    return docs

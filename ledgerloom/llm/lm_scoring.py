"""Scores of texts by two models learnt from the same corpus: PPM over bytes, and word counts.

PPM (see ``ppm``): nodes of full order are counted per task, summed over the corpus by
a shuffle, and their shorter contexts derived. The trie is broadcast in blocks of at
most ``BLOCK_NODES`` nodes, cut by the two bytes before a symbol; each position of a
text is scored by the one block that has its contexts, so a larger trie means more
blocks and the same scores. The only limit is the order.

Word counts: documents are dealt by a hash of id and text into chunks of about
``CHUNK`` bytes. A chunk's distinct words meet the same words of other chunks once,
to be summed, and come back with their counts, so what is shuffled is the
vocabulary of each chunk and not a row per word or per document and word. Words
are matched by a 64-bit hash. No vocabulary is held beyond that of a chunk.

A NULL or empty text has its end as only token; documents with a NULL id are told by
the caller's ``training`` column like others (NULL: not for training). Without training
texts all counts are 0. An empty table gives no rows; repeated rows are counted and
scored as often as they occur.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import ppm
from ledgerloom.llm.common import ship, slices, texts
from ledgerloom.llm.parts import listed
from ledgerloom.session import materialize

ORDER = 4
CHUNK = 8 << 20
BLOCK_NODES = 2_000_000


def _prepared(docs: DataFrame, training: Column, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.coalesce(training, F.lit(False)).alias("training"),
    )


def count_nodes(source: DataFrame, order: int) -> DataFrame:
    """The trie of the training texts, stored: ``level``, ``node``, ``n``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, times = np.empty(0, np.uint64), np.empty(0, np.int64)

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(nodes.astype(np.int64)), pa.array(times)], ["node", "n"]
            )

        for batch in batches:
            for piece in slices(batch):
                part = ppm.counted([t.encode() for t in texts(piece)], order)
                pair = zip((nodes, times), part, strict=True)
                nodes, times = ppm.merged(*map(np.concatenate, pair))
                if len(nodes) > BLOCK_NODES:
                    yield rows()
                    nodes, times = nodes[:0], times[:0]
        if len(nodes):
            yield rows()

    full = (
        source.where("training")
        .select("text")
        .mapInArrow(run, "node long, n long")
        .groupBy("node")
        .agg(F.sum("n").alias("n"))
    )
    masked = [
        F.struct(
            F.lit(j).alias("level"),
            F.col("node").bitwiseAND(F.lit((1 << (8 * (j + 1))) - 1)).alias("node"),
        )
        for j in range(order + 1)
    ]
    each = full.select(F.explode(F.array(*masked)).alias("at"), "n")
    trie = each.groupBy("at").agg(F.sum("n").alias("n"))
    return materialize(trie.select("at.level", "at.node", "n"), "trie")


def _before() -> Column:
    """The two bytes before a node's symbol."""
    return F.shiftright("node", 8).bitwiseAND(F.lit(0xFFFF))


def blocks(
    trie: DataFrame, order: int, block_nodes: int = BLOCK_NODES
) -> list[tuple[str, Broadcast]]:
    """The trie, broadcast in named parts of at most ``block_nodes`` nodes of order 2 and more.

    At most 65,536 counts reach the driver, then one part after the other. Two bytes
    whose nodes alone are more than that still make one part.
    """
    spark = trie.sparkSession
    per = trie.where(F.col("level") >= 2).groupBy(_before().alias("before")).count()
    cuts, held = [0], 0
    for r in sorted(per.collect()):
        if held and held + r["count"] > block_nodes:
            cuts.append(r["before"])
            held = 0
        held += r["count"]
    cuts.append(1 << 16)
    out = []
    for low, high in zip(cuts, cuts[1:], strict=False):
        part = trie.where((F.col("level") < 2) | ((_before() >= low) & (_before() < high)))
        table = part.toArrow()
        level, node, n = (table[c].to_numpy() for c in ("level", "node", "n"))
        by_level = [(node[level == j].astype(np.uint64), n[level == j]) for j in range(order + 1)]
        out.append((uuid.uuid4().hex, spark.sparkContext.broadcast((by_level, (low, high)))))
    return out


_kept: dict[str, ppm.Trie] = {}


def _trie(name: str, block: Broadcast, alone: bool) -> ppm.Trie:
    """The block as a trie; a Python worker holds one at a time."""
    if name in _kept:
        return _kept[name]
    levels, (low, high) = block.value if alone else block.load_from_path(block._path)
    mine = None
    if not alone:
        mine = np.zeros(1 << 16, bool)
        mine[low:high] = True
    trie = ppm.Trie(levels, mine)
    _kept.clear()
    _kept[name] = trie
    return trie


def _packed(source: DataFrame, n_chunks: int) -> DataFrame:
    """Texts of a task by chunk, compressed: few rows and about a third of the bytes to shuffle."""
    chunk = F.pmod(F.xxhash64("id", "text"), F.lit(n_chunks)).cast("int")
    kind = source.schema["id"].dataType
    out = T.StructType(
        [
            T.StructField("chunk", T.IntegerType()),
            T.StructField("ids", T.ArrayType(kind)),
            T.StructField("training", T.ArrayType(T.BooleanType())),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("data", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        compressor = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            id_type = batch.schema.field("id").type
            for piece in slices(batch):
                place = piece["chunk"].to_numpy()
                order = np.argsort(place, kind="stable")
                raw = [t.encode() for t in texts(piece)]
                ids, training = piece["id"].to_pylist(), piece["training"].to_pylist()
                rows = np.split(order, np.flatnonzero(np.diff(place[order])) + 1)
                columns = [
                    pa.array([place[r[0]] for r in rows], pa.int32()),
                    pa.array([[ids[i] for i in r] for r in rows], pa.list_(id_type)),
                    pa.array([[training[i] for i in r] for r in rows], pa.list_(pa.bool_())),
                    pa.array([[len(raw[i]) for i in r] for r in rows], pa.list_(pa.int64())),
                    pa.array(
                        [compressor.compress(b"".join([raw[i] for i in r])) for r in rows],
                        pa.binary(),
                    ),
                ]
                yield pa.RecordBatch.from_arrays(columns, out.fieldNames())

    return source.select("id", "text", "training", chunk.alias("chunk")).mapInArrow(run, out)


def _unpacked(table: pa.Table) -> Iterator[tuple[list, list[bool], list[str]]]:
    """Ids, training marks and texts of each row."""
    import zstandard

    decompressor = zstandard.ZstdDecompressor()
    for k in range(table.num_rows):
        row = {c: table[c][k].as_py() for c in ("ids", "training", "lengths", "data")}
        data, at, found = decompressor.decompress(row["data"]), 0, []
        for n in row["lengths"]:
            found.append(data[at : at + n].decode())
            at += n
        yield row["ids"], row["training"], found


@dataclass
class _Words:
    """Words of some texts: the different ones by hash, and each word's place and text."""

    hashes: np.ndarray
    place: np.ndarray
    text: np.ndarray

    @classmethod
    def of(cls, found: list[str]) -> _Words:
        from xxhash import xxh3_64_intdigest

        parts = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(found, pa.string())))
        numbered = parts.flatten().dictionary_encode()
        place = numbered.indices.to_numpy()
        words = listed(numbered.dictionary.cast(pa.binary()))
        text = np.repeat(np.arange(len(found)), np.diff(parts.offsets.to_numpy()))
        if b"" in words:  # before white space at a start, after it at an end
            full = place != words.index(b"")
            place, text = place[full], text[full]
        hashes = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
        return cls(hashes.astype(np.int64), place, text)


def _vocabulary(table: pa.Table) -> pa.Table:
    """Distinct words of a chunk, and how often each is in its training texts."""
    training, found = [], []
    for _, marks, some in _unpacked(table):
        training += marks
        found += some
    words = _Words.of(found)
    n = len(words.hashes)
    learnt = np.array(training, bool)[words.text]
    times = np.bincount(words.place[learnt], minlength=n)
    met = np.bincount(words.place, minlength=n) > 0  # not the empty one
    chunk = np.full(int(met.sum()), table["chunk"][0].as_py(), np.int32)
    columns = [pa.array(words.hashes[met]), pa.array(chunk), pa.array(times[met])]
    return pa.table(columns, ["word", "chunk", "n"])


def score(
    docs: DataFrame,
    training: Column,
    order: int = ORDER,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK,
    block_nodes: int = BLOCK_NODES,
) -> DataFrame:
    """Per row: the id, ``training``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``.

    Tokens are the lower-cased words and one end. ``base_score`` is the sum of log10
    of (c + 1/2) / (N + (V + 1) / 2), where c is a token's count in the training texts, N the
    sum and V the number of counted tokens. ``score`` is the PPM log10 probability.
    """
    ship(docs.sparkSession)
    source = _prepared(docs, training, id_col, text_col)
    size = source.agg(
        F.sum(F.octet_length("text")).alias("bytes"),
        F.count_if("training").alias("learnt"),
    ).first()
    n_ends = size["learnt"]
    packed = _packed(source, -(-(size["bytes"] or 1) // chunk_bytes))

    words = packed.groupBy("chunk").applyInArrow(_vocabulary, "word long, chunk int, n long")
    same = Window.partitionBy("word")
    counts = materialize(
        words.select(
            "word",
            "chunk",
            F.sum("n").over(same).alias("c"),
            (F.min("chunk").over(same) == F.col("chunk")).alias("once"),
        ),
        "words",
    )
    sums = counts.where("once AND c > 0").agg(F.sum("c").alias("n"), F.count("c").alias("v")).first()
    n_all, n_distinct = (sums["n"] or 0) + n_ends, sums["v"] + (n_ends > 0)
    per_token = float(np.log10(n_all + 0.5 * (n_distinct + 1)))
    trie = blocks(count_nodes(source, order), order, block_nodes)

    kind = source.schema["id"].dataType
    out = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("training", T.BooleanType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()),
            T.StructField("train_tokens", T.LongType()),
            T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType()),
        ]
    )

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        id_type = left.schema.field("ids").type.value_type
        known, c = right["word"].to_numpy(), right["c"].to_numpy()
        place = np.argsort(known)
        known, c = known[place], c[place].astype(float)
        log = np.log10(c + 0.5)
        end = float(np.log10(n_ends + 0.5))
        ids, marks, every, total = [], [], [], []
        for row_ids, row_marks, found in _unpacked(left):
            ids += row_ids
            marks += row_marks
            every += found
            raw = [t.encode() for t in found]
            part = np.zeros(len(found))
            for name, block in trie:
                part += _trie(name, block, len(trie) == 1).score(raw)
            total.append(part)
        words = _Words.of(every)
        at = np.searchsorted(known, words.hashes)[words.place]
        n_words = np.bincount(words.text, minlength=len(every))
        n_known = np.bincount(words.text, c[at] > 0, len(every)).astype(np.int64) + (n_ends > 0)
        base = np.bincount(words.text, log[at], len(every)) + end - (n_words + 1) * per_token
        n_tokens = n_words + 1
        columns = [
            pa.array(ids, id_type),
            pa.array(marks, pa.bool_()),
            pa.array(n_tokens, pa.int64()),
            pa.array(n_known, pa.int64()),
            pa.array(np.full(len(ids), n_all, np.int64)),
            pa.array(base, pa.float64()),
            pa.array(np.concatenate(total)),
        ]
        return pa.table(columns, out.fieldNames())

    # every chunk with documents has its words, if any; one without words still gives rows
    by_chunk = counts.select("chunk", "word", "c").groupBy("chunk")
    return packed.groupBy("chunk").cogroup(by_chunk).applyInArrow(scored, out)

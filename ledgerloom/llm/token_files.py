"""Token ids of a corpus as files of directly addressable codes.

``write`` encodes every text with a byte-level BPE tokenizer file of the
tokenizers library, appends an end id, and stores the ids in ascending order of
the id column. A file's rows are segments: the codes (see ``dac``) of a slice of texts,
the ids and lengths of their documents, and how many ids of the same partition
come before. Spark commits the files, so a lost task leaves none
behind. ``documents`` reads them back, ``token`` gets one id of the corpus.

Texts are range-partitioned by id, ties by a hash of the text, so equal ids do not
meet in one task. A NULL or empty text has the end id alone; NULL ids come first.
Repeated rows are stored as often as they occur. An empty table gives no segments.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import dac
from ledgerloom.llm.common import id_and_text, ship, slices
from ledgerloom.llm.parts import CACHED, Known, cut, gather

SEGMENT_BYTES = 12 << 20  # of text, a single text aside


class ByteBpe:
    """Encodes whole texts by parts, cut before each space and each line feed.

    The tokenizer's own pattern ends a token between a non-space and a space that a
    non-space follows, and takes a line feed between non-spaces alone, so such
    parts have the same ids alone as in the text. A text with any other part (only a
    space, more white space at an edge, a special token) is encoded as a whole, and so is
    every text if the tokenizer works otherwise. The parts of a slice are numbered,
    each new one is encoded once, and the ids of all texts are gathered by number.

    Most new parts are letters and then punctuation. The pattern would cut them
    between the two; they are cut here, and the letters go to the tokenizer's model.
    """

    def __init__(self, definition: str, limit: int = CACHED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(definition)
        self._special = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        said = json.loads(definition)
        how = said.get("pre_tokenizer") or {}
        self._by_parts = (
            how.get("type") == "ByteLevel"
            and how.get("use_regex", True)
            and not how.get("add_prefix_space")
            and not said.get("normalizer")
        )
        if self._by_parts:
            written = _written_bytes()  # bytes as the model writes them
            self._table = dict(enumerate(written))
            self._line = self._tokenizer.token_to_id(written[10])
            tokenize = self._tokenizer.model.tokenize
            table = self._table

            class Tails(dict):
                def __missing__(self, tail: str) -> list[int]:
                    found = self[tail] = [x.id for x in tokenize(tail.translate(table))]
                    return found

            self._tails = Tails()
        self._known = Known(self._learn, limit)

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _simple(self, parts: list[str], bodies: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of parts, and how many of each: a space, a line feed or neither, letters
        (``bodies``), and what follows them.
        """
        tokenize, tails, line, table = self._tokenizer.model.tokenize, self._tails, self._line, self._table
        space, ids, ends = table[0x20], array("I"), [0]
        for p, x in zip(parts, bodies, strict=True):
            done = len(x)
            # ASCII letters are written as they are
            word = x if x.isascii() else x.encode().decode("latin-1").translate(table)
            if p[0] == " ":
                done += 1
                word = space + word
            elif p[0] == "\n":
                done += 1
                ids.append(line)
            ids.extend([t.id for t in tokenize(word)])
            if done < len(p):
                ids.extend(tails[p[done:]])
            ends.append(len(ids))
        return np.frombuffer(ids, np.uint32), np.diff(ends)

    def _learn(self, parts: list[str]):
        """See ``parts.Learn``; parts whose ids depend on what is around get none."""
        named, bodies, others = [], [], []
        for p in parts:
            body = p[1:] if p[:1] in (" ", "\n") else p
            x = body.rstrip(_PUNCTUATION)
            if x.isalpha() and (x.isascii() or max(x) < "\u0250"):
                named.append(p)
                bodies.append(x)
            elif not p:
                others.append(p)
            elif body and not body[0].isspace() and not body[-1].isspace() and not self._has_special(p):
                others.append(p)
        ids, size = self._simple(named, bodies) if named else (np.empty(0, np.uint32), [])
        rest = self._whole(others)
        named += others
        size = np.concatenate([size, [len(x) for x in rest]])
        return named, np.concatenate([ids, *rest]), size, np.ones(len(named), np.uint8)

    def _has_special(self, text: str) -> bool:
        return any(s in text for s in self._special)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids of ``texts``, each text's followed by ``end_id``, and how many each has."""
        texts = pc.fill_null(texts, "")
        if not len(texts):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        if not self._by_parts:
            rows = [np.append(x, end_id) for x in self._whole(texts.to_pylist())]
            return np.concatenate(rows).astype(np.uint32), np.array([len(x) for x in rows])
        place, different, begins = cut(texts)
        number = self._known.numbers(different)[place]
        n_parts = np.diff(begins, append=len(number))
        ids, size = [self._known.ids], [self._known.size]
        whole = np.logical_or.reduceat(number < 0, begins)
        if whole.any():  # one part, which is the text
            odd = np.flatnonzero(whole)
            own = self._whole(texts.take(pa.array(odd)).to_pylist())
            kept = ~np.repeat(whole, n_parts)
            kept[begins] = True
            number[begins[odd]] = len(self._known.size) + np.arange(len(odd))
            number, n_parts = number[kept], np.where(whole, 1, n_parts)
            ids += own
            size.append(np.array([len(x) for x in own], np.int64))
        ids, size = np.concatenate([*ids, [end_id]]).astype(np.uint32), np.concatenate([*size, [1]])
        number = np.insert(number, np.cumsum(n_parts), len(size) - 1)
        return gather(ids, size, number, n_parts + 1)


#: ASCII punctuation but the apostrophe, which can belong to a contraction
_PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def _written_bytes() -> list[str]:
    """How byte-level models write each byte: printable ones as they are, others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return [chr(b) if b in plain else chr(0x100 + others.index(b)) for b in range(256)]


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Store the ids of ``docs`` under ``path``, which the executors share."""
    spark = docs.sparkSession
    ship(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["id"].dataType
    out = T.StructType(
        [
            T.StructField("part", T.IntegerType()),
            T.StructField("before", T.LongType()),
            T.StructField("n_ids", T.LongType()),
            T.StructField("docs", T.ArrayType(kind)),
            T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("codes", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        tokenizer = _tokenizer(definition.value)
        for batch in batches:
            for piece in slices(batch, most=SEGMENT_BYTES):
                stream, lengths = tokenizer.encode(piece["text"], end_id)
                columns = [
                    pa.array([part], pa.int32()),
                    pa.array([before], pa.int64()),
                    pa.array([len(stream)], pa.int64()),
                    pa.ListArray.from_arrays([0, piece.num_rows], piece["id"]),
                    pa.array([lengths], pa.list_(pa.int64())),
                    pa.array([dac.encode(stream)], pa.binary()),
                ]
                before += len(stream)
                yield pa.RecordBatch.from_arrays(columns, out.fieldNames())

    tie = F.xxhash64("text")
    ordered = source.repartitionByRange("id", tie).sortWithinPartitions("id", tie)
    # the codes are read by place, so the container leaves them as they are
    ordered.mapInArrow(run, out).write.option("compression", "none").parquet(path)


_kept: dict[str, ByteBpe] = {}


def _tokenizer(definition: str) -> ByteBpe:
    if definition not in _kept:
        _kept.clear()
        _kept[definition] = ByteBpe(definition)
    return _kept[definition]


def segments(files: DataFrame) -> DataFrame:
    """Segments with ``start``, the number of ids in all segments before.

    Partitions are in order of the ids; only one row per partition meets the running total.
    """
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("total"))
    in_order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "part", F.coalesce(F.sum("total").over(in_order), F.lit(0)).alias("offset")
    )
    return files.join(F.broadcast(offsets), "part").withColumn(
        "start", F.col("offset") + F.col("before")
    )


def documents(files: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files: the id, ``start``, ``n_tokens`` and ``ids_crc32``."""
    ship(files.sparkSession)
    kind = files.schema["docs"].dataType.elementType
    out = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = dac.Codes(batch["codes"][k].as_py()).decode()
                lengths = np.array(batch["lengths"][k].as_py(), np.int64)
                ends = np.cumsum(lengths)
                data = memoryview(ids.tobytes())
                crc = [zlib.crc32(data[4 * (e - n) : 4 * e]) for n, e in zip(lengths, ends, strict=True)]
                columns = [
                    batch["docs"][k].values,
                    pa.array(batch["start"][k].as_py() + ends - lengths),
                    pa.array(lengths),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, out.fieldNames())

    return segments(files).select("docs", "lengths", "codes", "start").mapInArrow(run, out)


def token(files: DataFrame, place: int) -> int:
    """The id at ``place`` of the whole corpus, from one segment and without decoding it.

    Two small reads: the segments' numbers, without any codes, tell which segment has the place;
    its part and place in the part, as filters that reach the files, find its codes.
    """
    found = (
        segments(files.select("part", "before", "n_ids"))
        .where((F.col("start") <= place) & (place < F.col("start") + F.col("n_ids")))
        .select("part", "before", "start")
        .first()
    )
    if found is None:
        raise IndexError(place)
    codes = codes_at(files, found["part"], found["before"]).first()["codes"]
    return dac.Codes(bytes(codes))[place - found["start"]]


def codes_at(files: DataFrame, part: int, before: int) -> DataFrame:
    """The codes of one segment; an empty one may stand at the same place, so it must have ids."""
    mine = (F.col("part") == part) & (F.col("before") == before) & (F.col("n_ids") > 0)
    return files.where(mine).select("codes")

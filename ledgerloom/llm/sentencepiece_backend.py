"""SentencePiece models run by the tokenizers library.

The model's protobuf is read here; its normaliser, the marker for spaces, the
unigram scores or the BPE merges and the byte fallback are rebuilt as a tokenizer
of the tokenizers library, which encodes in batches, with as many threads as a
task has cores. Parity with the sentencepiece library is verified while encoding.

If the model changes no text, starts each text with the marker and has no piece
with a marker after another character, the ids of a text are those of its parts (a run of
spaces and the word after it) one after the other. Then parts are encoded and
compared with sentencepiece once per task and kept; the store is emptied when it
is full. Any other model encodes and compares whole texts.

A NULL or empty text has no ids and decodes to the empty text. An empty table
gives no rows; repeated rows give repeated results.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm import parts
from ledgerloom.llm.common import kept, per_text, ship

MARK = "▁"

# Fixed values of the model's format: kinds of pieces and of models.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of one protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        number, wire = key >> 3, key & 7
        if wire == 0:
            yield number, varint()
            continue
        if wire not in (1, 2, 5):
            raise ValueError(f"wire type {wire} in a model file")
        size = varint() if wire == 2 else 8 if wire == 1 else 4
        yield number, data[at : at + size]
        at += size


@dataclass
class Model:
    """What a model file says, as far as encoding and decoding need it."""

    pieces: list[str] = field(default_factory=list)
    scores: list[float] = field(default_factory=list)
    kinds: list[int] = field(default_factory=list)
    algorithm: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    dummy_prefix: bool = True
    strip_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in fields(data):
            if number == 1:
                piece = dict(fields(value))
                model.pieces.append(piece[1].decode())
                model.scores.append(struct.unpack("<f", piece.get(2, bytes(4)))[0])
                model.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(fields(value))
                model.algorithm = trainer.get(3, UNIGRAM)
                model.byte_fallback = bool(trainer.get(35, 0))
            elif number == 3:
                normaliser = dict(fields(value))
                model.charsmap = normaliser.get(2, b"")
                model.dummy_prefix = bool(normaliser.get(3, 1))
                model.strip_spaces = bool(normaliser.get(4, 1))
                model.escape_spaces = bool(normaliser.get(5, 1))
        if model.algorithm not in (UNIGRAM, BPE):
            raise ValueError(f"model type {model.algorithm} is neither unigram nor BPE")
        return model

    @property
    def unknown(self) -> int:
        return self.kinds.index(UNKNOWN)

    def merges(self) -> list[tuple[str, str]]:
        """Pairs of pieces that make a piece, the best piece first."""
        usable = {p for p, k in zip(self.pieces, self.kinds, strict=True) if k == NORMAL}
        rank = {p: -s for p, s in zip(self.pieces, self.scores, strict=True)}
        pairs = [
            (rank[p], p[:i], p[i:])
            for p in usable
            for i in range(1, len(p))
            if p[:i] in usable and p[i:] in usable
        ]
        order = {p: i for i, p in enumerate(self.pieces)}
        pairs.sort(key=lambda x: (x[0], order[x[1]], order[x[2]]))
        return [x[1:] for x in pairs]

    @property
    def separable(self) -> bool:
        """Whether parts of a text have the same ids alone as in the text."""
        plain = not self.charsmap and not self.strip_spaces
        inner = any(re.search(f"[^{MARK}]{MARK}", p) for p in self.pieces)
        defined = USER_DEFINED in self.kinds
        return plain and self.dummy_prefix and self.escape_spaces and not inner and not defined

    def tokenizer(self):
        """The model as a tokenizer of the tokenizers library."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        unknown = self.pieces[self.unknown]
        if self.algorithm == BPE:
            vocabulary = {p: i for i, p in enumerate(self.pieces)}
            backend = Tokenizer(
                models.BPE(
                    vocabulary,
                    self.merges(),
                    unk_token=unknown,
                    fuse_unk=True,
                    byte_fallback=self.byte_fallback,
                )
            )
        else:
            # pieces that text may not give are out of reach
            reach = [
                (p, s if k in (NORMAL, UNKNOWN, BYTE, USER_DEFINED) else -1e9)
                for p, s, k in zip(self.pieces, self.scores, self.kinds, strict=True)
            ]
            backend = Tokenizer(models.Unigram(reach, self.unknown, self.byte_fallback))
        steps = []
        if self.charsmap:
            steps.append(normalizers.Precompiled(self.charsmap))
        if self.strip_spaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(MARK if self.escape_spaces else " "))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", MARK))
        backend.normalizer = normalizers.Sequence(steps)
        after = [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            after.append(decoders.Strip(" ", 1, 0))
        backend.decoder = decoders.Sequence(after)
        backend.add_tokens(
            [
                AddedToken(p, normalized=False)
                for p, k in zip(self.pieces, self.kinds, strict=True)
                if k == USER_DEFINED
            ]
        )
        return backend

    @property
    def line(self) -> int | None:
        """The id that stands for a line feed and for nothing else, if there is one."""
        if not self.byte_fallback or any("\n" in p for p in self.pieces):
            return None
        return self.pieces.index("<0x0A>")

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: pieces joined, bytes as UTF-8, markers as spaces, the first one cut."""
        text = b"".join(map(self.table().__getitem__, ids.tolist()))
        out = text.decode("utf-8", "replace").replace(MARK, " ")
        return out[1:] if self.dummy_prefix and out[:1] == " " else out

    def table(self) -> list[bytes]:
        """What each id adds to the text."""
        if "_pieces" not in self.__dict__:
            self._pieces = [
                bytes([int(p[3:-1], 16)]) if k == BYTE else b"" if k == CONTROL else p.encode()
                for p, k in zip(self.pieces, self.kinds, strict=True)
            ]
        return self._pieces


@dataclass
class Encoded:
    """Ids of some texts one after the other, and per text: how many, parity, round trip."""

    ids: np.ndarray
    size: np.ndarray
    parity: np.ndarray
    round_trip: np.ndarray


SLICE = 2 << 20  # bytes of text that are encoded at once; numbers about parts take 15 times as many
KNOWN_PARTS = 200_000  # that a Python worker keeps with their ids


class Encoder:
    """Ids of texts by the rebuilt tokenizer, compared with sentencepiece when asked."""

    def __init__(
        self, data: bytes, threads: int = 1, verify: bool = True, limit: int = KNOWN_PARTS
    ):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        self.model = Model.parse(data)
        self._tokenizer = self.model.tokenizer()
        self._threads = threads
        self._check = None
        if verify:
            import sentencepiece

            self._check = sentencepiece.SentencePieceProcessor(model_proto=data)
        self._line = self.model.line
        if self._line is not None:
            # parts as the normaliser leaves them go to the model, a line feed between them
            self._model = Tokenizer(self._tokenizer.model)
            self._model.pre_tokenizer = pre_tokenizers.Split("\n", "isolated")
        self._known = parts.Known(self._learn, limit)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and how many of each text. An empty text has none."""
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        rows = [np.array(f.ids if t else [], np.uint32) for f, t in zip(found, texts, strict=True)]
        size = np.array([len(x) for x in rows], np.int64)
        return np.concatenate([np.empty(0, np.uint32), *rows]), size

    def _line_ids(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for parts without line feeds."""
        ids = array("I")
        written = parts.lines((MARK + p).replace(" ", MARK) for p in new)
        for x in self._model.encode_batch_fast(written, add_special_tokens=False):
            ids.extend(x.ids)
        return parts.unlined(np.frombuffer(ids, np.uint32), self._line)

    def _same(self, texts: list[str], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether sentencepiece gives each text the same ids."""
        same = np.ones(len(texts), bool)
        if self._check:
            want = self._check.encode(texts, num_threads=self._threads)
            if [len(w) for w in want] == size.tolist():
                flat = np.fromiter(chain.from_iterable(want), np.uint32, len(ids))
                if np.array_equal(flat, ids):
                    return same
            for k, (w, x) in enumerate(zip(want, np.split(ids, np.cumsum(size)[:-1]), strict=True)):
                same[k] = w == x.tolist()
        return same

    def _back(self, texts: list[str], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the ids of each text decode to it."""
        rows = np.split(ids, np.cumsum(size)[:-1])
        return np.array([self.model.decode(x) == t for x, t in zip(rows, texts, strict=True)], bool)

    def _parts_back(self, new: list[str], ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The same for parts; all at once if, as nearly always, all are right."""
        want = [(MARK + p.replace(" ", MARK)).encode() for p in new]
        table = self.model.table()
        if size.all() and b"".join(map(table.__getitem__, ids.tolist())) == b"".join(want):
            length = np.array([len(x) for x in table])[ids]
            if np.add.reduceat(length, np.cumsum(size) - size).tolist() == [len(x) for x in want]:
                return np.ones(len(new), bool)
        return self._back(new, ids, size)

    def _learn(self, new: list[str]):
        """See ``parts.Learn``; the marks are 1 for parity and 2 for the round trip."""
        lined = [p for p in new if p and "\n" not in p and self._line is not None]
        other = [p for p in new if p and ("\n" in p or self._line is None)]
        found = [(np.empty(0, np.uint32), np.empty(0, np.int64))]
        if lined:
            found.append(self._line_ids(lined))
        if other:
            found.append(self._ids(other))
        named = lined + other
        ids, size = (np.concatenate(x) for x in zip(*found, strict=True))
        marks = np.empty(0, np.uint8)
        if named:
            marks = self._same(named, ids, size) + 2 * self._parts_back(named, ids, size)
        if "" in new:  # the marker alone
            mark = [self.model.pieces.index(MARK)] if MARK in self.model.pieces else []
            named, ids = [*named, ""], np.append(ids, mark)
            size, marks = np.append(size, len(mark)), np.append(marks, 3 * len(mark))
        return named, ids, size, marks

    def encode(self, texts: list[str]) -> Encoded:
        if not texts or not self.model.separable:
            ids, size = self._ids(texts)
            return Encoded(ids, size, self._same(texts, ids, size), self._back(texts, ids, size))
        # each part lacks the one space, or the marker of the start, that stands before it
        flat = [t.replace(MARK, " ") if MARK in t else t for t in texts]
        odd = [
            k for k, t in enumerate(flat) if "  " in t or t[:1] == " " or t[-1:] == " " or not t
        ]
        rows = {k: [p[1:] for p in re.findall(" +[^ ]*", " " + flat[k])] if flat[k] else [] for k in odd}
        place, different, begins = parts.split(
            pa.array(["" if k in rows else t for k, t in enumerate(flat)], pa.string())
        )
        extra = list({p for r in rows.values() for p in r} - set(different))
        number = self._known.numbers(different + extra)
        at = {p: n for p, n in zip(different + extra, number.tolist(), strict=True)} if rows else {}
        number = number[place]
        n_parts = np.diff(begins, append=len(number))
        nothing = len(self._known.size)  # a part without ids, which ends each text
        if rows:
            pieces = np.split(number, begins[1:])
            for k, r in rows.items():
                pieces[k] = np.array([at[p] for p in r], np.int64)
            number, n_parts = np.concatenate(pieces), np.array([len(x) for x in pieces])
        number = np.insert(number, np.cumsum(n_parts), nothing)
        n_parts = n_parts + 1
        size = np.append(self._known.size, 0)
        ids, n_ids = parts.gather(self._known.ids, size, number, n_parts)
        opens = np.cumsum(n_parts) - n_parts
        marks = np.bitwise_and.reduceat(np.append(self._known.marks, 3)[number], opens)
        plain = np.array([MARK not in t for t in texts])
        return Encoded(ids, n_ids, marks & 1 > 0, (marks & 2 > 0) & plain)


def _encoder(data: bytes, threads: int, verify: bool) -> Encoder:
    key = ("sentencepiece", zlib.crc32(data), threads, verify)
    return kept(key, lambda: Encoder(data, threads, verify))


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = True,
    verify: bool = True,
) -> DataFrame:
    """Per row: the id, ``n_tokens``, ``ids_crc32``, ``parity``, ``round_trip`` and the ``ids``.

    ``parity``: sentencepiece gives the same ids. ``round_trip``: they decode to the text
    (a model that changes texts gives the changed text back, which counts as a difference).
    Without ``with_ids`` the ids stay in the task.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    threads = int(spark.sparkContext.getConf().get("spark.task.cpus", "1"))
    columns = {"n_tokens": "long", "ids_crc32": "long", "parity": "boolean", "round_trip": "boolean"}
    if with_ids:
        columns["ids"] = "array<int>"

    def make():
        encoder = _encoder(data.value, threads, verify)

        def compute(texts: list[str]) -> list[pa.Array]:
            found = encoder.encode(texts)
            ends = np.cumsum([0, *found.size])
            data = memoryview(found.ids.astype("<u4").tobytes())
            crc = [zlib.crc32(data[4 * s : 4 * e]) for s, e in zip(ends, ends[1:], strict=False)]
            out = [
                pa.array(found.size, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(found.parity),
                pa.array(found.round_trip),
            ]
            if with_ids:
                values = pa.array(found.ids.astype(np.int32))
                out.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values))
            return out

        return compute

    return per_text(docs, columns, make, id_col, text_col, most=SLICE)


def decode(
    tokens: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """Per row: the id and the ``text`` of its ids, by the library's decoder; NULL ids as none."""
    spark = tokens.sparkSession
    ship(spark)
    with open(model_path, "rb") as f:
        data = spark.sparkContext.broadcast(f.read())
    source = tokens.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").cast("array<int>").alias("ids")
    )
    out = T.StructType(
        [T.StructField(id_col, source.schema["id"].dataType), T.StructField("text", T.StringType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Model.parse(data.value).tokenizer()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                piece = batch.slice(at, 256)
                ids = [x or [] for x in piece["ids"].to_pylist()]
                text = tokenizer.decode_batch(ids, skip_special_tokens=False)
                yield pa.RecordBatch.from_arrays(
                    [piece["id"], pa.array(text, pa.string())], out.fieldNames()
                )

    return source.mapInArrow(run, out)

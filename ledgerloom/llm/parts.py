"""Ids of texts put together from the ids of their parts, each different part encoded once."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CACHED = 500_000  # parts whose ids a Python worker keeps

#: learns new parts: gives those that got ids, their ids in one array, how many each has, marks (bits)
Learn = Callable[[list[str]], tuple[list[str], np.ndarray, np.ndarray, np.ndarray]]


class Known:
    """Numbers, ids and marks of parts; when there are more than ``limit``, most are forgotten."""

    def __init__(self, learn: Learn, limit: int = CACHED):
        self._learn, self._limit = learn, limit
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self.ids, self.size = np.empty(0, np.uint32), np.empty(0, np.int64)
        self.marks = np.empty(0, np.uint8)

    def numbers(self, different: list[str]) -> np.ndarray:
        """Of each of ``different`` parts its number, -1 where it can have none."""
        found = list(map(self._number.get, different))
        at = [k for k, n in enumerate(found) if n is None]
        if at and len(self._number) + len(at) > self._limit:
            # what is known and met again is worth keeping
            self._keep([(p, n) for p, n in zip(different, found, strict=True) if n is not None])
            found = list(map(self._number.get, different))
        if at:
            new = [different[k] for k in at]
            named, ids, size, marks = self._learn(new)
            first = len(self.size)
            self._number.update(zip(named, range(first, first + len(named)), strict=True))
            self.ids = np.concatenate([self.ids, ids]).astype(np.uint32, copy=False)
            self.size = np.concatenate([self.size, size]).astype(np.int64, copy=False)
            self.marks = np.concatenate([self.marks, marks]).astype(np.uint8, copy=False)
            for k, n in zip(at, map(self._number.get, new, repeat(-1)), strict=True):
                found[k] = n
        return np.fromiter(found, np.int64, len(different))

    def _keep(self, kept: list[tuple[str, int]]) -> None:
        """Forget all parts but some."""
        old = np.array([n for _, n in kept], np.int64)
        ids, size, marks = self.ids, self.size, self.marks
        self._forget()
        if kept:
            self._number = {p: k for k, (p, _) in enumerate(kept)}
            self.size, self.marks = size[old], marks[old]
            self.ids, _ = gather(ids, size, old, np.array([len(old)]))


def listed(strings: pa.Array) -> list:
    """Strings (none NULL) as a list, without a scalar for each."""
    return strings.to_numpy(zero_copy_only=False).tolist()


def split(texts: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Texts (at least one, none NULL) cut at single spaces.

    Gives the place of each part among the different ones, these, and where each text begins.
    """
    parts = pc.split_pattern(texts, " ")
    begins = parts.offsets.to_numpy().astype(np.int64)
    numbered = parts.flatten().dictionary_encode()
    return numbered.indices.to_numpy(), listed(numbered.dictionary), begins[:-1] - begins[0]


def gather(
    ids: np.ndarray, size: np.ndarray, number: np.ndarray, n_parts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and how many each has; every text has a part.

    ``ids`` holds those of the numbered parts one after the other, ``number`` the parts
    of the texts one after the other.
    """
    start = np.cumsum(size) - size
    each = size[number]
    at = np.repeat(start[number] - (np.cumsum(each) - each), each)
    at += np.arange(len(at))
    return ids[at], np.add.reduceat(each, np.cumsum(n_parts) - n_parts)


def lines(parts: Iterable[str], at_once: int = 100) -> list[str]:
    """``parts`` with a line feed after each, many in one string."""
    parts = list(parts)
    return ["\n".join(parts[k : k + at_once]) + "\n" for k in range(0, len(parts), at_once)]


def unlined(stream: np.ndarray, line: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids without those of line feeds, and how many stand before each of them."""
    ends = np.flatnonzero(stream == line)
    return stream[stream != line], np.diff(ends, prepend=-1) - 1


def cut(texts: pa.Array, marks: bytes = b" \n") -> tuple[np.ndarray, list[str], np.ndarray]:
    """Texts (none NULL) cut before every byte of ``marks``, which begins the next part.

    Gives the same as ``split``; an empty text is one empty part.
    """
    texts = texts.cast(pa.string())
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[low:high] if data else np.empty(0, np.uint8)
    found = np.zeros(len(raw), bool)
    for m in marks:
        found |= raw == m
    starts = offsets[:-1].astype(np.int64) - low
    found[starts[starts < len(raw)]] = False  # a text begins there anyway
    inner = np.flatnonzero(found)
    begins = np.searchsorted(inner, starts) + np.arange(len(starts))
    at = np.insert(inner, np.searchsorted(inner, starts), starts)
    ends = np.append(at, len(raw)).astype(np.int32) + np.int32(low)
    flat = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends.tobytes()), data or pa.py_buffer(b""))
    numbered = flat.dictionary_encode()
    return numbered.indices.to_numpy(), listed(numbered.dictionary), begins

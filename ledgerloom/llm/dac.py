"""Directly addressable codes for token ids.

An id is split into chunks of ``bits`` bits, the lowest first. Level 0 holds the
first chunk of every id, level 1 the second chunk of those that have more, and so
on; a bitmap per level says which go on, and a rank directory holds the number of
set bits before every ``BLOCK`` bits. The chunk of id i on the next level is at
the rank of its bit, so any id is read with one step per level and nothing else
is decoded.

Layout, little endian: ``DAC1``, u8 bits, u8 levels, u16 0, u64 ids; then per level
u64 chunks, the chunks (8, 16 or 32 bits each), and, but for the last level, the
bitmap (bit 0 first) padded to whole blocks and the directory (u32 each).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
BLOCK = 512
_CHUNK = {8: np.dtype("<u1"), 16: np.dtype("<u2"), 32: np.dtype("<u4")}


def encode(ids: np.ndarray, bits: int = 8) -> bytes:
    """The codes of ``ids``, which are at most 32 bits wide."""
    rest = np.ascontiguousarray(ids, "<u4")
    levels = []
    while True:
        more = rest >> np.uint32(bits) if bits < 32 else np.zeros_like(rest)
        goes_on = more > 0
        levels.append((rest.astype(_CHUNK[bits]), goes_on))
        if not goes_on.any():
            break
        rest = more[goes_on]
    out = [MAGIC, struct.pack("<BBHQ", bits, len(levels), 0, len(ids))]
    for k, (chunks, goes_on) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k < len(levels) - 1:
            bitmap = np.packbits(goes_on, bitorder="little")
            bitmap = np.pad(bitmap, (0, -len(bitmap) % (BLOCK // 8)))
            ones = np.bitwise_count(bitmap).reshape(-1, BLOCK // 8).sum(1)
            directory = np.concatenate([[0], np.cumsum(ones)[:-1]])
            out += [bitmap.tobytes(), directory.astype("<u4").tobytes()]
    return b"".join(out)


class Codes:
    """Encoded ids: ``len``, single ids by position, or all of them."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a DAC1 block")
        self.bits, n_levels, _, self._n = struct.unpack_from("<BBHQ", data, 4)
        at, self._levels = 16, []
        for k in range(n_levels):
            (n,) = struct.unpack_from("<Q", data, at)
            chunks = np.frombuffer(data, _CHUNK[self.bits], n, at + 8)
            at += 8 + chunks.nbytes
            bitmap = directory = None
            if k < n_levels - 1:
                blocks = -(-n // BLOCK)
                bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
                directory = np.frombuffer(data, "<u4", blocks, at + bitmap.nbytes)
                at += bitmap.nbytes + directory.nbytes
            self._levels.append((chunks, bitmap, directory))
        self.nbytes = at

    def __len__(self) -> int:
        return self._n

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self._n:
            raise IndexError(i)
        value = 0
        for k, (chunks, bitmap, directory) in enumerate(self._levels):
            value |= int(chunks[i]) << (k * self.bits)
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block, byte = i // BLOCK, i >> 3
            before = bitmap[block * (BLOCK // 8) : byte]
            below = int(bitmap[byte]) & ((1 << (i & 7)) - 1)
            i = int(directory[block]) + int(np.bitwise_count(before).sum()) + below.bit_count()
        return value

    def decode(self) -> np.ndarray:
        """All ids as little-endian unsigned 32-bit integers."""
        out = np.zeros(self._n, "<u4")
        places = None
        for k, (chunks, bitmap, _) in enumerate(self._levels):
            part = chunks.astype("<u4") << np.uint32(k * self.bits)
            if places is None:
                out |= part
            else:
                out[places] |= part
            if bitmap is not None:
                goes_on = np.unpackbits(bitmap, count=len(chunks), bitorder="little").view(bool)
                places = np.flatnonzero(goes_on) if places is None else places[goes_on]
        return out

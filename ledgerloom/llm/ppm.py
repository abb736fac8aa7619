"""Prediction by partial matching over bytes: the trie's numbers and code lengths.

A context is the last ``order`` bytes, a node of the trie a context with the symbol
after it, packed into an integer with the symbol in the lowest byte. Escapes follow
method D: of a context seen n times with q different symbols, a symbol seen k times
has probability (k - 1/2) / n, and q / 2n is left for the next shorter context. There the
symbols of the longer context are excluded, from the counts and from q. Below order
0 all symbols not yet excluded are alike. A context never seen hands down without cost.

The symbols of longer contexts occur in their shorter ones, so what is left after
exclusion is a number per longer context, and the code length of many positions
is found level by level with array operations.
"""

from __future__ import annotations

import numpy as np

START, END = 0xFE, 0xFF  # bytes that UTF-8 does not use
SYMBOLS = 256
WINDOW = 1 << 18  # positions that are looked up at once

_U8 = np.uint64(8)


def stream(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Texts with START bytes before and an END after each; where each one's symbols begin."""
    lead = bytes([START]) * order
    data = b"".join([part for t in texts for part in (lead, t, bytes([END]))])
    lengths = np.array([len(t) + 1 + order for t in texts], np.int64)
    return np.frombuffer(data, np.uint8), np.cumsum(lengths) - lengths + order


def keys(data: np.ndarray, order: int, begin: int, end: int) -> np.ndarray:
    """Nodes of full order at the positions ``begin`` to ``end`` (the first at least ``order``)."""
    out = np.zeros(end - begin, np.uint64)
    for j in range(order, -1, -1):
        out = (out << _U8) | data[begin - j : end - j]
    return out


def counted(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of full order in ``texts``, and how often each occurs."""
    data, begins = stream(texts, order)
    real = np.ones(len(data), bool)
    for j in range(1, order + 1):
        real[begins - j] = False
    found, times = np.empty(0, np.uint64), np.empty(0, np.int64)
    for at in range(order, len(data), WINDOW):
        end = min(at + WINDOW, len(data))
        part, n = np.unique(keys(data, order, at, end)[real[at:end]], return_counts=True)
        found, times = merged(np.concatenate([found, part]), np.concatenate([times, n]))
    return found, times


def merged(nodes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal nodes as one, their counts added."""
    order = np.argsort(nodes, kind="stable")
    nodes, times = nodes[order], times[order]
    first = np.flatnonzero(np.concatenate([[True], nodes[1:] != nodes[:-1]])) if len(nodes) else []
    return nodes[first], np.add.reduceat(times, first) if len(nodes) else times


class Index:
    """Places of known integers, by open addressing; -1 for any other."""

    def __init__(self, known: np.ndarray):
        self.known = known
        bits = max(4, int(4 * len(known)).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._table = np.full(1 << bits, -1, np.int32)
        slot, waiting = self._slots(known), np.arange(len(known), dtype=np.int32)
        while len(waiting):
            free = self._table[slot] < 0
            self._table[slot[free]] = waiting[free]
            lost = self._table[slot] != waiting
            slot, waiting = (slot[lost] + 1) & self._mask, waiting[lost]

    def _slots(self, values: np.ndarray) -> np.ndarray:
        return ((values * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, values: np.ndarray) -> np.ndarray:
        slot = self._slots(values)
        out = self._table[slot]
        if not len(self.known):
            return out
        wrong = np.flatnonzero((out >= 0) & (self.known[out] != values))
        while len(wrong):
            slot[wrong] = (slot[wrong] + 1) & self._mask
            out[wrong] = self._table[slot[wrong]]
            wrong = wrong[(out[wrong] >= 0) & (self.known[out[wrong]] != values[wrong])]
        return out


class _Level:
    """Nodes and contexts of one order, with the counts that code lengths need."""

    def __init__(self, nodes: np.ndarray, times: np.ndarray, shorter: _Level | None):
        order = np.argsort(nodes)
        nodes, self.times = nodes[order], times[order].astype(float)
        self.nodes = Index(nodes)
        contexts, first = np.unique(nodes >> _U8, return_index=True)
        self.contexts = Index(contexts)
        self.n = np.add.reduceat(self.times, first) if len(nodes) else np.empty(0)
        self.q = np.diff(np.append(first, len(nodes))).astype(float)
        self.owner = np.repeat(np.arange(len(contexts)), self.q.astype(int))
        # without exclusion, as nearly every symbol is found
        self.direct = np.log10((self.times - 0.5) / self.n[self.owner])
        # of the shorter context without this one's symbols: what is left of n and of q
        self.left_n = self.left_q = np.empty(0)
        if shorter is not None and len(nodes):
            mask = np.uint64((1 << (8 * shorter.width)) - 1)
            there = shorter.times[shorter.nodes.find(nodes & mask)]
            up = shorter.contexts.find(contexts & (mask >> _U8))
            self.left_n = shorter.n[up] - np.add.reduceat(there, first)
            self.left_q = shorter.q[up] - self.q
        self.width = 1 if shorter is None else shorter.width + 1


class Trie:
    """Code lengths from counted nodes; ``levels[j]`` has (nodes, counts) of order j.

    ``mine`` may limit it to positions by the two bytes before them; the levels then
    need the nodes of order 2 and more of those positions only.
    """

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], mine: np.ndarray | None = None):
        self.order = len(levels) - 1
        self.mine = mine
        self.levels: list[_Level] = []
        for nodes, times in levels:
            self.levels.append(_Level(nodes, times, self.levels[-1] if self.levels else None))

    def log10(self, positions: np.ndarray) -> np.ndarray:
        """log10 probability of the symbol at each position, given as nodes of full order."""
        out = np.zeros(len(positions))
        open_ = np.arange(len(positions))
        if self.mine is not None:
            open_ = open_[self.mine[(positions >> _U8) & np.uint64(0xFFFF)]]
        node = positions[open_]
        above = np.full(len(open_), -1)  # the longer context whose symbols are excluded
        last_q = 0.0 if not len(self.levels[0].q) else self.levels[0].q[0]
        for j in range(self.order, -1, -1):
            level = self.levels[j]
            node = node & np.uint64((1 << (8 * level.width)) - 1)
            at = level.nodes.find(node)
            if j == self.order:
                hit = at >= 0
                out[open_[hit]] = level.direct[at[hit]]
                open_, node, at, above = open_[~hit], node[~hit], at[~hit], above[~hit]
            hit = at >= 0
            context = np.where(hit, level.owner[at] if len(level.owner) else -1, -1)
            context[~hit] = level.contexts.find(node[~hit] >> _U8)
            known = context >= 0
            n, q = np.zeros(len(node)), np.zeros(len(node))
            n[known], q[known] = level.n[context[known]], level.q[context[known]]
            if j < self.order:
                cut, longer = above >= 0, self.levels[j + 1]
                n[cut], q[cut] = longer.left_n[above[cut]], longer.left_q[above[cut]]
            out[open_[hit]] += np.log10((level.times[at[hit]] - 0.5) / n[hit])
            escapes = ~hit & (n > 0)
            out[open_[escapes]] += np.log10(q[escapes] / 2 / n[escapes])
            open_, node, above = open_[~hit], node[~hit], context[~hit]
        if len(open_):
            out[open_] -= np.log10(max(SYMBOLS - last_q, 1))
        return out

    def score(self, texts: list[bytes]) -> np.ndarray:
        """log10 probability of each text with its end."""
        if not texts:
            return np.empty(0)
        data, begins = stream(texts, self.order)
        total = np.zeros(len(data))
        for at in range(self.order, len(data), WINDOW):
            end = min(at + WINDOW, len(data))
            total[at:end] = self.log10(keys(data, self.order, at, end))
        for j in range(1, self.order + 1):
            total[begins - j] = 0
        return np.add.reduceat(total, begins)


def levels(nodes: np.ndarray, times: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Counts of all orders from those of full order."""
    out = []
    for j in range(order + 1):
        mask = np.uint64((1 << (8 * (j + 1))) - 1)
        out.append(merged(nodes & mask, times))
    return out

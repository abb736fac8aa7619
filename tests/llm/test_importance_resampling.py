"""Buckets, weights and draws against plain counting; ranks against sorting."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import importance_resampling as ir
from ledgerloom.llm import radix_sort
from ledgerloom.llm.common import lower_ascii
from tests.llm.helpers import ODD, PROSE, documents

ITEM = "item_id long, text string, weight string"


def features(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower_ascii(text or ""))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def plain(rows, items):
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in items for f in features(x)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    out = []
    for i, text in rows:
        words, found = features(text)
        gains = [
            math.floor(1000 * math.log((t[b] + 1) * (n_s + 10000) / ((s[b] + 1) * (n_t + 10000))))
            for b in map(bucket, found)
        ]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(found), weight, score, None, len(words)])
    drawn = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(drawn[: 25 * len(drawn) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in out), key=str)


def resampled(spark, rows, items):
    target = spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)], ITEM)
    found = ir.resample(documents(spark, rows).repartition(3), target)
    return sorted(
        (tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in found.collect()),
        key=str,
    )


def test_draws_equal_a_plain_version(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["Ärger", "Été", "x1", "don't", "naïve"]
    rows = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(0, 80)))) for k in range(300)]
    items = [PROSE, " ".join(vocabulary[:20]), None, ""]
    assert resampled(spark, rows, items) == plain(rows, items)


def test_odd_and_repeated_rows(spark):
    rows = [*ODD, (None, PROSE), (4, PROSE), (4, PROSE)]
    assert resampled(spark, rows, [PROSE]) == plain(rows, [PROSE])


def test_no_target_and_no_documents(spark):
    rows = [(k, f"{PROSE} {k}") for k in range(8)]
    assert resampled(spark, rows, []) == plain(rows, [])
    assert resampled(spark, [], [PROSE]) == []


def test_features_of_a_slice():
    texts = [b"A b\x00c", b"", b"!!", "Über-alles a b".encode()]
    n, size, found = ir.hashed(texts, 10000)
    assert n.tolist() == [3, 0, 0, 4] and size.tolist() == [5, 0, 0, 7]
    want = [sorted(map(bucket, features(t.decode())[1])) for t in texts]
    ends = np.cumsum(size)
    assert [sorted(found[e - k : e].tolist()) for e, k in zip(ends, size, strict=True)] == want


@pytest.mark.parametrize("ids", [1, 7, 5000])
def test_ranks_are_those_of_a_sort(spark, monkeypatch, ids):
    """Small blocks and digits: several passes, digits that most rows share, repeated keys."""
    monkeypatch.setattr(radix_sort, "BLOCK_BITS", (4, 4))
    monkeypatch.setattr(radix_sort, "DIGIT_BITS", 5)
    rng = random.Random(ids)
    rows = [(rng.choice([0, 0, 3, 40, 900]), rng.randrange(ids), k) for k in range(700)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    got = sorted(map(tuple, radix_sort.ranked(df, ["a", "b"]).collect()), key=lambda r: r[3])
    assert [r[3] for r in got] == list(range(700))
    assert [r[:2] for r in got] == sorted(r[:2] for r in rows)
    assert sorted(r[2] for r in got) == list(range(700))


def test_rank_of_one_row_and_of_none(spark):
    df = spark.createDataFrame([(0, 0)], "a long, b long")
    assert [r["place"] for r in radix_sort.ranked(df, ["a", "b"]).collect()] == [0]
    assert radix_sort.ranked(df.limit(0), ["a", "b"]).collect() == []

"""PPM against symbol-by-symbol exclusion, word counts against plain counting."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerloom.llm import lm_scoring, ppm, queries
from tests.llm.helpers import ODD, PROSE, documents


def learn(texts, order):
    seen = [defaultdict(Counter) for _ in range(order + 1)]
    for t in texts:
        s = [ppm.START] * order + list(t) + [ppm.END]
        for i in range(order, len(s)):
            for j in range(order + 1):
                seen[j][tuple(s[i - j : i])][s[i]] += 1
    return seen


def plain_ppm(text, seen, order):
    s, total = [ppm.START] * order + list(text) + [ppm.END], 0.0
    for i in range(order, len(s)):
        excluded: set = set()
        for j in range(order, -1, -1):
            counts = seen[j].get(tuple(s[i - j : i]), {})
            left = {k: v for k, v in counts.items() if k not in excluded}
            n = sum(left.values())
            if s[i] in left:
                total += math.log10((left[s[i]] - 0.5) / n)
                break
            if n:
                total += math.log10(len(left) / 2 / n)
            excluded |= set(counts)
        else:
            total -= math.log10(256 - len(excluded))
    return total


@pytest.mark.parametrize("order", range(5))
def test_ppm_equals_plain_exclusion(order):
    rng = random.Random(order)
    for _ in range(40):
        known = [bytes(rng.choices(b"abcd e", k=rng.randint(0, 30))) for _ in range(rng.randint(0, 6))]
        asked = [bytes(rng.choices(b"abcdxyz e\xc3\xa9", k=rng.randint(0, 25))) for _ in range(6)]
        trie = ppm.Trie(ppm.levels(*ppm.counted(known, order), order))
        seen = learn(known, order)
        want = [plain_ppm(t, seen, order) for t in asked]
        assert np.allclose(trie.score(asked), want, rtol=1e-9)


def test_probabilities_of_a_context_sum_to_one_over_short_texts():
    """A proper model: the next symbols of any history have probabilities that sum to at most 1."""
    known = [PROSE.encode()]
    trie = ppm.Trie(ppm.levels(*ppm.counted(known, 3), 3))
    for history in (b"the", b"zzz", b"he ", b"\xfe\xfeT"):
        nodes = np.array([int.from_bytes(history + bytes([s]), "big") for s in range(256)], np.uint64)
        total = (10.0 ** trie.log10(nodes)).sum()
        assert 0.5 < total <= 1 + 1e-9


def plain_words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(n=120, seed=4):
    rng = random.Random(seed)
    words = PROSE.split() + ["Öl", "É", "zwölf", "x1"]
    return [(i, " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(n)]


@pytest.mark.parametrize("chunk_bytes, block_nodes", [(lm_scoring.CHUNK, 10**6), (700, 300)])
def test_scores_equal_plain_counting(spark, chunk_bytes, block_nodes):
    docs = corpus() + [(i, t) for i, t in ODD if len(t or "") < 1000] + [(3, "twice"), (3, "twice")]
    table = documents(spark, docs)
    rows = lm_scoring.score(
        table, queries.fold() != 1, order=3, chunk_bytes=chunk_bytes, block_nodes=block_nodes
    ).collect()
    assert len(rows) == len(docs)

    def learnt(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 5 != 1

    training = [t or "" for i, t in docs if learnt(i)]
    count = Counter(w for t in training for w in [*plain_words(t), None])
    n, v = sum(count.values()), len(count)
    seen = learn([t.encode() for t in training], 3)
    want = []
    for i, t in docs:
        tokens = [*plain_words(t), None]
        base = sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in tokens)
        known = sum(count[w] > 0 for w in tokens)
        want.append((i or -1, learnt(i), len(tokens), known, n, base, plain_ppm((t or "").encode(), seen, 3)))
    got = [(r[0] or -1, *r[1:]) for r in rows]
    for a, b in zip(sorted(got), sorted(want), strict=True):
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9)


def test_query_on_held_out_text(spark, tmp_path):
    documents(spark, corpus(400)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op5_lm_scoring(spark, str(tmp_path)).collect()
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 1}
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in rows)


def test_nothing_to_learn_from_and_empty_table(spark):
    from pyspark.sql import functions as F

    rows = lm_scoring.score(documents(spark, [(1, "abc"), (2, None)]), F.lit(False)).collect()
    assert {(r["n_known"], r["train_tokens"]) for r in rows} == {(0, 0)}
    assert {round(r["score"] / math.log10(256)) for r in rows} == {-4, -1}
    assert lm_scoring.score(documents(spark, []), F.lit(True)).count() == 0

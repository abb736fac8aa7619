"""Measures against plain counting, the label model, and the verdicts."""

from __future__ import annotations

import math
import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import quality_rules as q
from tests.llm.helpers import ODD, PROSE, documents


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    hit = {i + j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, dup, len(hit)


def test_measures_equal_plain_counting():
    rng = random.Random(1)
    parts = ["a", "b", "é", "#", " ", " ", "\n", "\t", " ", "|", "a b c", "\x0b"]
    for _ in range(2000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 60)))
        assert q.measure(text)[:5] == plain(text), text


def _rules(*faults):
    return tuple(q.Rule(f"r{k}", f, q._shortness, 0.1, 0.2) for k, f in enumerate(faults))


def plain_em(votes, counts, rules, rounds=60):
    """The same estimate, text by text and rule by rule."""
    faults = list(dict.fromkeys(r.fault for r in rules))
    classes = [None, *faults]
    first = {}
    for c in classes:
        for i, r in enumerate(rules):
            rate = q._ON_GOOD if c is None else q._ON_OWN if r.fault == c else q._ON_OTHER
            first[c, i] = dict(zip((0, -1, 1), rate, strict=True))
    share0 = {c: q.GOOD_SHARE if c is None else (1 - q.GOOD_SHARE) / len(faults) for c in classes}
    rates, share = dict(first), dict(share0)

    def odds(vote):
        p = {c: share[c] * math.prod(rates[c, i][x] for i, x in enumerate(vote)) for c in classes}
        return {c: p[c] / sum(p.values()) for c in classes}

    for _ in range(rounds):
        p = [odds(v) for v in votes]
        held = {c: sum(n * x[c] for n, x in zip(counts, p, strict=True)) for c in classes}
        rates = {
            (c, i): {
                o: (sum(n * x[c] for v, n, x in zip(votes, counts, p, strict=True) if v[i] == o) + q.PRIOR_TEXTS * first[c, i][o])
                / (held[c] + q.PRIOR_TEXTS)
                for o in (0, -1, 1)
            }
            for c in classes
            for i in range(len(rules))
        }
        share = {c: (held[c] + q.PRIOR_TEXTS * share0[c]) / (sum(counts) + q.PRIOR_TEXTS) for c in classes}
    return [odds(v)[None] for v in votes]


def test_the_estimate_equals_a_plain_one():
    rng = random.Random(2)
    rules = _rules("a", "a", "b", "b", "b")
    votes = sorted({tuple(rng.choice((0, 1, 1, -1)) for _ in rules) for _ in range(60)})
    counts = [rng.randint(1, 90) for _ in votes]
    model = q.fit(np.array(votes), np.array(counts), rules)
    assert np.allclose(model.classes(np.array(votes))[:, 0], plain_em(votes, counts, rules))


def test_rare_kinds_of_junk_are_found_without_labels():
    """Two kinds of junk, the rarer one seen by three rules that agree, and a rule that errs."""
    rules = _rules("a", "a", "a", "b", "b")
    votes = np.array([[1, 1, 1, 1, 1], [1, 1, 1, 0, 0], [0, 0, 0, 1, 1], [1, 1, 1, 0, 1], [-1, 1, 1, 1, 1]])
    model = q.fit(votes, np.array([8500, 500, 60, 700, 240]), rules)
    good = model.classes(votes)[:, 0]
    assert good[0] > 0.99 and good[1] < 0.1 and good[2] < 0.1
    # one bad vote of a rule that often errs does not reject
    assert good[3] > 0.5 and good[4] > 0.9
    rates = model.rates[0, :, 0]
    assert 0.05 < rates[3] < 0.1 and rates[4] < 0.01  # where the start says 0.03 for both


def test_no_junk_keeps_everything():
    rules = _rules("a", "b", "b")
    votes = np.array([[1, 1, 1], [1, -1, 1]])
    assert q.fit(votes, np.array([500, 500]), rules).classes(votes)[:, 0].min() > 0.5


def test_the_column_equals_the_model(spark):
    rng = random.Random(4)
    votes = [[rng.choice((0, 1, -1)) for _ in q.RULES] for _ in range(200)]
    model = q.fit(np.array(votes), np.array([rng.randint(1, 50) for _ in votes]))
    names = [f"v{k}" for k in range(len(q.RULES))]
    df = spark.createDataFrame(votes, names).select(*names, model.posterior([F.col(n) for n in names]).alias("p"))
    rows = df.collect()
    want = model.classes(np.array([list(r)[:-1] for r in rows]))[:, 0]
    assert np.allclose([r["p"] for r in rows], want)


def test_the_posterior_decides_not_single_votes(spark):
    """On the given documents: bad votes that are outvoted, texts rejected for abstentions."""
    folder = "/root/testdata/sf0.1"
    if not os.path.isdir(folder):
        pytest.skip("no test tables")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality")
    judged = q.judge(docs)
    bad = sum(((r.vote() == 0).cast("int") for r in q.RULES), F.lit(0))
    rows = judged.withColumn("bad", bad).join(labels, "doc_id", "left").where("NOT base_failed").collect()
    assert sum(r["kept"] and r["bad"] == 1 for r in rows) > 50
    assert sum(not r["kept"] and r["bad"] == 1 for r in rows) > 0
    assert sum(not r["kept"] and r["bad"] == 0 for r in rows) > 0
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert sum(good) / len(good) > 0.99
    assert not any(r["kept"] for r in rows if r["quality"] == 0)


def test_kept_rows_have_all_their_columns(spark):
    rows = [*ODD, *[(50 + k, f"{PROSE} {k} " + " ".join(reversed(PROSE.split()))) for k in range(40)]]
    docs = documents(spark, rows)
    kept = sorted(map(str, q.keep(docs).collect()))
    ids = {(r["doc_id"]) for r in q.judge(docs).where("kept").collect()}
    assert q.keep(docs).columns == docs.columns
    assert kept == sorted(str(r) for r in docs.collect() if r["doc_id"] in ids) and len(kept) >= 40
    assert q.keep(documents(spark, [])).collect() == []


def test_verdicts(spark):
    junk = [(100 + i, " ".join(f"{w}{'#*$%'[i % 4] * 3}" for w in PROSE.split())) for i in range(6)]
    loud = [(200 + i, " ".join(f"{w.upper()}!!" for w in PROSE.split())) for i in range(6)]
    good = [(300 + i, f"{PROSE} {i} " + " ".join(reversed(PROSE.split()))) for i in range(60)]
    rows = q.judge(documents(spark, [*ODD, *junk, *loud, *good])).collect()
    assert len(rows) == len(ODD) + 72
    kept = {r["doc_id"] for r in rows if r["kept"]}
    assert kept >= {i for i, _ in good} and kept.isdisjoint({i for i, _ in [*junk, *loud]})
    for r in rows:
        n = r["n_words"]
        assert r["base_failed"] == (n < 50 or 100 * r["n_repeat_words"] > 50 * n)
        assert 0 <= r["posterior"] <= 1 and not (r["base_failed"] and r["kept"])
    texts = {i: t or "" for i, t in ODD}
    for r in rows:
        if r["doc_id"] in texts:
            five = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            assert tuple(r[c] for c in five) == plain(texts[r["doc_id"]])


def test_empty_table(spark):
    assert q.judge(documents(spark, [])).count() == 0

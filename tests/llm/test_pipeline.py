"""Every stage against a plain version of it, and the whole run."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece

import corpus_pipeline
from ledgerloom.llm import pii, quality_rules
from tests.llm.helpers import PROSE
from tests.llm.test_decontaminate import plain as plain_leaks
from tests.llm.test_jaccard_join import plain as plain_groups

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(8)
    words = sorted(set(PROSE.split())) + [f"word{i}" for i in range(200)]
    items = [(i, " ".join(rng.choices(words, k=14))) for i in range(5)]
    texts = [" ".join(rng.choices(words, k=120)) + "." for _ in range(60)]
    texts += [texts[k] for k in (0, 0, 1, 2)]  # copies
    texts += [texts[k] + " one more word" for k in (3, 4)]  # near copies
    texts += [f"{texts[5]} {items[k][1].upper()} {texts[6]}" for k in range(5)]
    fresh = [" ".join(rng.choices(words, k=120)) for _ in range(5)]
    texts += [f"{t} mail me@example.com or 10.0.0.1 {k}" for k, t in enumerate(fresh)]
    texts += [" ".join(f"{w}###" for w in rng.choices(words, k=100)) for _ in range(8)]
    texts += ["short", "", None, "same same " * 60]
    rows = [(k, t, "en", None, len(t or "")) for k, t in enumerate(texts)] + [(0, texts[0], "en", None, 1)]
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, items


def stages(spark, path):
    """Input and output rows of each stage, written and read as the driver does."""
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.mode("overwrite").parquet(f"{path}/stage-{k}")
        out = spark.read.parquet(f"{path}/stage-{k}")
        yield name, docs.collect(), out.collect(), out.columns
        docs = out


def test_each_stage_does_its_work_on_its_input(spark, folder):
    path, items = folder
    for name, before, after, columns in stages(spark, path):
        ids = sorted(r["doc_id"] for r in after)
        if name != "sentencepiece":
            assert columns == [c.split()[0] for c in COLUMNS.split(", ")]
        if name == "quality_rules":
            junk = {r["doc_id"] for r in before if "###" in (r["text"] or "")}
            failed = set()
            for r in before:
                m = quality_rules.measure(r["text"] or "")
                if m[0] < 50 or 100 * m[4] > 50 * m[0]:
                    failed.add(r["doc_id"])
            assert set(ids) == {r["doc_id"] for r in before} - junk - failed
            assert len(ids) == len(set(ids)) + 1  # the repeated row
        elif name == "ngram_jaccard_join":
            groups = plain_groups([(r["doc_id"], r["text"]) for r in before])
            assert ids == sorted({least for _, _, least in groups})
        elif name == "benchmark_decontamination":
            assert ids == sorted(r["doc_id"] for r in before if not plain_leaks(r["text"], items)[1])
            assert len(ids) < len(before)
        elif name == "pii":
            texts = {r["doc_id"]: pii.redact(r["text"], pii.scan(r["text"])) for r in before}
            assert {r["doc_id"]: r["text"] for r in after} == texts
            assert all(r["n_chars"] == len(r["text"]) for r in after)
            assert sum("<EMAIL>" in t and "<IP>" in t for t in texts.values()) == 5
        else:
            model = sentencepiece.SentencePieceProcessor(
                model_file=public_tokenizers.path(corpus_pipeline.MODEL)
            )
            texts = {r["doc_id"]: r["text"] for r in before}
            assert ids == sorted(texts)
            for r in after:
                assert r["ids"] == model.encode(texts[r["doc_id"]]) and r["parity"] and r["round_trip"]


def test_run_applies_all_stages(spark, folder):
    path, _ = folder
    *_, last = stages(spark, path)
    whole = corpus_pipeline.run(spark, path).collect()
    assert sorted(map(tuple, whole)) == sorted(map(tuple, last[2]))


def test_empty_and_null_rows(spark, tmp_path):
    spark.createDataFrame([(1, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, rows in (("none", []), ("odd", [(None, None, None, None, None), (1, None, "x", "y", 3), (1, "", None, None, 0), (None, PROSE, None, None, None), (None, PROSE, None, None, None)])):
        docs = spark.createDataFrame(rows, COLUMNS)
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            docs.write.parquet(f"{tmp_path}/{name}-{k}")
            docs = spark.read.parquet(f"{tmp_path}/{name}-{k}")
        assert docs.count() == (name == "odd")

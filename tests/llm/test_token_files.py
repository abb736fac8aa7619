"""Codes, parts against whole texts, and files against the library."""

from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerloom.llm import dac, queries, token_files
from tests.llm.helpers import ODD, PROSE, documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("bits", [8, 16, 32])
@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
@pytest.mark.parametrize("top", [1, 256, 70_000, 2**32])
def test_codes_round_trip_and_random_access(bits, n, top):
    rng = np.random.default_rng(n)
    ids = (rng.random(n) ** 4 * top).astype("<u4")
    codes = dac.Codes(data := dac.encode(ids, bits))
    assert codes.nbytes == len(data) and len(codes) == n
    assert np.array_equal(codes.decode(), ids)
    for i in rng.integers(0, n, 50) if n else ():
        assert codes[int(i)] == ids[i]
    with pytest.raises(IndexError):
        codes[n]


PARTS = ["the", "It's", "é", "日本", "12", " ", " ", " ", "\n", "\t", " ", " ", "!?", "'ll", "<|endoftext|>",
         "\x1c", "\r\n", "a\nb", "😀", "x" * 50, "  ", "ʼn", "ẞ", "word.", "W##", "_", "\x01", "Ċ"]


@pytest.mark.parametrize("limit", [token_files.CACHED, 40])
@pytest.mark.parametrize("change", [{}, {"use_regex": False}, {"add_prefix_space": True}])
def test_parts_have_the_ids_of_the_whole_text(limit, change):
    definition = json.load(open(PATH, encoding="utf-8"))
    definition["pre_tokenizer"] |= change
    text = json.dumps(definition)
    library, own = Tokenizer.from_str(text), token_files.ByteBpe(text, limit)
    rng = random.Random(5)
    for _ in range(60):
        texts = ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(50)] + [None]
        stream, lengths = own.encode(pa.array(texts), 2)
        at = 0
        for text, n in zip(texts, lengths, strict=True):
            want = library.encode(text or "", add_special_tokens=False).ids + [2]
            assert stream[at : at + n].tolist() == want, repr(text)
            at += n
        assert at == len(stream)


def expected(docs):
    library, start, out = Tokenizer.from_file(PATH), 0, []
    for i, text in sorted(docs, key=lambda x: (x[0] is not None, x[0] or 0)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 2]
        data = np.array(ids, "<u4").tobytes()
        out.append((i, start, len(ids), zlib.crc32(data), ids))
        start += len(ids)
    return out


def test_query_reads_back_what_the_library_gives(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    docs = [(1000 - k, " ".join(rng.choices(PROSE.split(), k=rng.randint(0, 300)))) for k in range(200)]
    docs += ODD
    documents(spark, docs).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op7_token_files(spark, str(tmp_path)).collect()
    got = sorted((r["start"], r["n_tokens"], r["doc_id"], r["ids_crc32"]) for r in rows)
    assert got == sorted((s, n, i, c) for i, s, n, c, _ in expected(docs))


def test_any_token_of_the_corpus(spark, tmp_path):
    docs = [(k, f"{PROSE} {k}") for k in range(40)]
    token_files.write(documents(spark, docs), f"{tmp_path}/files", PATH)
    files = spark.read.parquet(f"{tmp_path}/files")
    stream = [t for *_, ids in expected(docs) for t in ids]
    for place in (0, 1, 77, 1500, len(stream) - 1):
        assert token_files.token(files, place) == stream[place]
    with pytest.raises(IndexError):
        token_files.token(files, len(stream))
    plan = token_files.codes_at(files, 1, 0)._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [", 1)[1]
    assert "EqualTo(part,1)" in pushed and "EqualTo(before,0)" in pushed


def test_empty_table(spark, tmp_path):
    token_files.write(documents(spark, []), f"{tmp_path}/files", PATH)
    assert token_files.documents(spark.read.parquet(f"{tmp_path}/files")).count() == 0

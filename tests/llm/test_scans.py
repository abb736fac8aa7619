"""PII and secret scans against the plain patterns, and what the methods add."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time

import pytest

from ledgerloom.llm import pii, queries, secret_scan
from tests.llm.helpers import ODD, PROSE, documents

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)


def digits(text):
    return re.sub(r"[^0-9]", "", text)


def plain_luhn(number):
    odd, even = number[-1::-2], number[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def plain_pii(text):
    found = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    for m in re.finditer(IP, text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(CARD, text):
        if 14 <= len(digits(m[0])) <= 19 and plain_luhn(digits(m[0])):
            found.append(("card", *m.span()))
    for m in re.finditer(PHONE, text):
        if 10 <= len(digits(m[0])) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda x: (x[1], pii.BASE.index(x[0])))


def plain_secrets(text):
    found = [("assign", *m.span()) for m in re.finditer(ASSIGN, text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], secret_scan.BASE.index(x[0])))


PII_PARTS = ["a", ".b", "@", "@x.y", "x@y.z", "1", "23", ".", "-", " ", "+", "(", ")", "4111", "1111", "é", "\n",
             "12.34.56.78", "300.1.1.1", "4111111111111111", "+1 (017) 555-7713", "_", "%", "0"]
SECRET_PARTS = ["token", "TOKEN", "secre", "secret", "api", "_", "key", "apikey", "=", ":", " ", "'", '"', "abc123", "x",
                "AKIA", "ABCDEFGHIJ", "0123456789", "deadbeef", "f" * 23, "é", "ſecret", "passwd", "password", "\n"]


@pytest.mark.parametrize("seed", range(10))
def test_base_spans_equal_the_plain_patterns(seed):
    rng = random.Random(seed)
    for _ in range(400):
        text = "".join(rng.choices(PII_PARTS, k=rng.randint(0, 40)))
        assert [x[:3] for x in pii.scan(text) if x[0] in pii.BASE] == plain_pii(text), text
        text = "".join(rng.choices(SECRET_PARTS, k=rng.randint(0, 40)))
        base = [x for x in secret_scan.scan(text) if x[0] in secret_scan.BASE]
        assert base == plain_secrets(text), text


def test_validators():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("DE89370400440532013000") and not pii.mod97("DE89370400440532013001")
    body = "0123456789abcdefghijABCDEFGHIJ"
    good = f"ghp_{body}{secret_scan.checksum62(body)}"
    assert [x[0] for x in secret_scan.scan(f"use {good}.")] == ["github"]
    assert secret_scan.scan(f"use {good[:-1]}{'A' if good[-1] != 'A' else 'B'}.") == []


def test_context_decides_on_added_kinds():
    def kinds(text):
        return [x[0] for x in pii.scan(text)]

    assert kinds("number 123-45-6789 was drawn") == []
    assert kinds("my ssn is 123-45-6789 indeed") == ["ssn"]
    assert kinds("her account DE89 3704 0044 0532 0130 00 AND SO ON") == ["iban"]
    assert kinds("please call (017) 555-7713 today") == ["local_phone"]
    assert kinds("please call +12 (017) 555-7713 today") == ["phone"]


def test_redaction_joins_overlapping_spans():
    text = "see 1.2.3.4, a@b.c and é+1 (017) 555-7713."
    assert pii.redact(text, pii.scan(text)) == "see <IP>, <EMAIL> and é<PHONE>."
    assert pii.redact("0123456789", [("a", 1, 4), ("b", 3, 6), ("c", 6, 7)]) == "0<A><C>789"


def test_deeply_nested_token_headers():
    """What looks like a token whose header is JSON nested 200,000 deep is no token, and no error."""
    deep = base64.urlsafe_b64encode(b'{"a":' * 200_000 + b"1" + b"}" * 200_000).decode().rstrip("=")
    good = base64.urlsafe_b64encode(b'{"alg":"HS256","typ":"JWT"}').decode().rstrip("=")
    assert deep.startswith("eyJ")
    assert [x[0] for x in secret_scan.scan(f"{deep}.abcdefgh.abcdefghij")] in ([], ["jwt"])
    assert [x[0] for x in secret_scan.scan(f"see {good}.eyJzdWIiOiIxIn0.abcdefghijklmnop")] == ["jwt"]


def test_phones_of_both_kinds_in_a_megabyte():
    """Local and international phones in turn: one walk over both, in the time of a plain scan."""
    text = "+1 202 555 0100x (017) 555-7713, " * 32_000
    began = time.perf_counter()
    found = pii.scan(text, threshold=0.5)
    assert time.perf_counter() - began < 20
    assert sum(x[0] == "phone" for x in found) == sum(x[0] == "local_phone" for x in found) == 32_000


@pytest.mark.parametrize("seed", range(5))
def test_walk_over_taken_spans_equals_all_pairs(seed):
    rng = random.Random(seed)
    for _ in range(200):
        marks = "".join(rng.choices("ab.", k=40))
        taken = [m.span() for m in re.finditer("a+", marks)]
        want = [m.span() for m in re.finditer(r"[ab]b|b", marks) if not any(s < m.end() and m.start() < e for s, e in taken)]
        assert list(pii.apart(re.finditer(r"[ab]b|b", marks), taken)) == want


def test_context_moves_a_span_in_the_query(spark, tmp_path):
    texts = [(1, "number 123-45-6789 was drawn"), (2, "my ssn is 123-45-6789 indeed"), (3, "mail a@b.co")]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: (r["n_added"], r["spans"], r["scores"]) for r in queries.op4_pii(spark, str(tmp_path)).collect()}
    assert rows == {1: (0, "", ""), 2: (1, "ssn:10:21", "0.7"), 3: (0, "email:5:11", "1.2")}


def test_changed_texts_keep_their_rows(spark):
    docs = documents(spark, [*ODD, (12, "a@b.co"), (13, "1.2.3.4 x")])
    clean = pii.without_pii(docs)
    assert clean.columns == docs.columns and clean.schema == docs.schema
    want = [r.asDict() | {"text": r["text"] and pii.redact(r["text"], pii.scan(r["text"]))} for r in docs.collect()]
    assert sorted(str(r.asDict()) for r in clean.collect()) == sorted(map(str, want))


def test_long_texts_take_linear_time():
    for text in ("1" * 300_000, "1." * 150_000, "a" * 300_000 + "@", "+1" * 100_000, "a@" * 100_000,
                 "token " * 50_000, "eyJ" * 100_000, "A" * 300_000, "AB12 " * 50_000, "token" + " " * 300_000):
        pii.scan(text)
        secret_scan.scan(text)


def test_queries_give_one_row_per_document(spark, tmp_path):
    texts = [*ODD, (11, "mail a@b.co or TOKEN = 'abcdef12' é 1.2.3.4")]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    for query, plain in ((queries.op4_pii, plain_pii), (queries.op6_secret_scan, plain_secrets)):
        rows = query(spark, str(tmp_path)).collect()
        assert len(rows) == len(texts)
        by_id = {r["doc_id"]: r for r in rows}
        for i, text in texts:
            joined = ",".join(f"{k}:{s}:{e}" for k, s, e in plain(text or ""))
            assert by_id[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
            for kind in [c[2:] for c in by_id[i].asDict() if c.startswith("n_")]:
                assert by_id[i][f"n_{kind}"] == sum(x[0] == kind for x in plain(text or ""))


def test_empty_table(spark):
    empty = documents(spark, [])
    assert pii.find_pii(empty).count() == secret_scan.find_secrets(empty).count() == 0


def test_clean_prose_has_no_spans():
    assert pii.scan(PROSE) == [] and secret_scan.scan(PROSE) == []

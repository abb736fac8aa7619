"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Every proposal comes from one linear pass over the places that can hold it: the
``@`` signs, the ``+`` signs and the runs of digits of a text. Card numbers must
pass Luhn, account numbers (IBAN) mod 97. A span starts with the score of its
kind; a context word of that kind within ``CONTEXT`` code points before it adds
to the score, a word for something else takes away.

Kinds ``email``, ``ip``, ``card`` and ``phone`` are the base and always stay.
``iban``, ``ssn`` (ddd-dd-dddd) and ``local_phone`` ((ddd) ddd-dddd) are added
when their score reaches ``THRESHOLD``. Matches of a kind are leftmost and do not
overlap. Offsets are code points, the end is exclusive. A NULL or empty text has
no spans; an empty table gives no rows; repeated rows give repeated results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm import spans
from ledgerloom.llm.common import per_text, with_texts

KINDS = ("email", "ip", "card", "phone", "iban", "ssn", "local_phone")
BASE = ("email", "ip", "card", "phone")
THRESHOLD = 0.6
CONTEXT = 40

START = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.7}
START |= {"iban": 0.9, "ssn": 0.4, "local_phone": 0.5}
NEAR, AGAINST = 0.3, 0.3

_WORDS = {
    "email": r"mail|contact|write|reach",
    "ip": r"ip|host|server|address|login|from",
    "card": r"card|visa|mastercard|credit|debit|payment|pan",
    "phone": r"phone|tel|call|mobile|fax|whatsapp",
    "iban": r"iban|account|bank|konto|transfer|swift|bic",
    "ssn": r"ssn|social|security|insurance",
    "local_phone": r"phone|tel|call|mobile|fax|dial",
}
_NEAR = {k: re.compile(rf"\b(?:{w})", re.I) for k, w in _WORDS.items()}
_AGAINST = re.compile(r"\b(?:version|isbn|issn|order|invoice|sku|serial|build)\b", re.I)

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_RUN = re.compile(r"[0-9]+")
_PHONE = re.compile(r"[0-9][\x20().0-9-]+")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL_PHONE = re.compile(r"\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?![0-9])")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """An account number without spaces, its first four characters moved to the end, is 1 mod 97."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """The run of local characters before each ``@`` up to the previous match, then a domain."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            past = m.end()
            yield start, past
        else:
            past = at + 1  # no later local part reaches over this sign
        at = text.find("@", past)


def _chains(runs: list[tuple[int, int]], text: str, joint: str) -> Iterator[list[tuple[int, int]]]:
    """Runs of digits that follow each other with exactly one character of ``joint`` between."""
    chain: list[tuple[int, int]] = []
    for run in runs:
        if chain and (run[0] - chain[-1][1] != 1 or text[run[0] - 1] not in joint):
            yield chain
            chain = []
        chain.append(run)
    if chain:
        yield chain


def ips(runs: list[tuple[int, int]], text: str) -> Iterator[tuple[int, int]]:
    for chain in _chains(runs, text, "."):
        for i in range(0, len(chain) - 3, 4):
            parts = chain[i : i + 4]
            if all(_small(text, s, e) for s, e in parts):
                yield parts[0][0], parts[3][1]


def _small(text: str, start: int, end: int) -> bool:
    digits = text[start:end].lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def cards(runs: list[tuple[int, int]], text: str) -> Iterator[tuple[int, int]]:
    for chain in _chains(runs, text, " -"):
        n = sum(e - s for s, e in chain)
        if 14 <= n <= 19 and luhn("".join(text[s:e] for s, e in chain)):
            yield chain[0][0], chain[-1][1]


def phones(text: str) -> Iterator[tuple[int, int]]:
    """From each ``+``: a digit, then phone characters as far as the last digit among them."""
    at = text.find("+")
    while at >= 0:
        past = at + 1
        if m := _PHONE.match(text, past):
            body = m[0].rstrip(" ().-")
            if len(body) >= 3:
                past = at + 1 + len(body)
                if 10 <= sum(c.isdigit() for c in body) <= 15:
                    yield at, past
        at = text.find("+", past)


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """The longest prefix of a proposal that ends with a group and passes mod 97."""
    for m in _IBAN.finditer(text):
        body = m[0]
        for end in range(len(body), 14, -1):
            whole = end == len(body) or body[end] == " "
            if whole and body[end - 1] != " " and mod97(body[:end].replace(" ", "")):
                if not text[m.start() + end : m.start() + end + 1].isalnum():
                    yield m.start(), m.start() + end
                break


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield m.span()


def apart(
    matches: Iterator[re.Match], taken: list[tuple[int, int]]
) -> Iterator[tuple[int, int]]:
    """Matches that overlap none of ``taken``; both ascend, so one walk over both is enough."""
    k = 0
    for m in matches:
        while k < len(taken) and taken[k][1] <= m.start():
            k += 1
        if k == len(taken) or taken[k][0] >= m.end():
            yield m.span()


def score(text: str, kind: str, start: int) -> float:
    before = text[max(0, start - CONTEXT) : start]
    return (
        START[kind]
        + NEAR * bool(_NEAR[kind].search(before))
        - AGAINST * bool(_AGAINST.search(before))
    )


def scan(text: str, threshold: float = THRESHOLD) -> list[tuple[str, int, int, float]]:
    """All spans of one text as (kind, start, end, score), by start, then kind."""
    found = [("email", *x) for x in emails(text)]
    if runs := [m.span() for m in _RUN.finditer(text)]:
        found += [("ip", *x) for x in ips(runs, text)]
        found += [("card", *x) for x in cards(runs, text)]
        found += [("phone", *x) for x in phones(text)]
        found += [("iban", *x) for x in ibans(text)]
        found += [("ssn", *x) for x in ssns(text)]
        taken = [x[1:] for x in found if x[0] == "phone"]  # ascending, apart from each other
        found += [("local_phone", *x) for x in apart(_LOCAL_PHONE.finditer(text), taken)]
    scored = [(k, s, e, score(text, k, s)) for k, s, e in found]
    return spans.ordered([x for x in scored if x[0] in BASE or x[3] >= threshold], KINDS)


def redact(text: str, found: list[tuple]) -> str:
    """``text`` with each span replaced by its kind in angle brackets; overlapping spans as one."""
    out, past, last = [], 0, 0
    for kind, start, end, *_ in sorted(found, key=lambda x: (x[1], -x[2])):
        if start >= last:
            out += [text[past:start], f"<{kind.upper()}>"]
        past = last = max(last, end)
    return "".join(out) + text[past:]


def find_pii(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """Per row: the id, ``spans`` as an array of (kind, start, end, base), ``scores``, ``redacted``.

    ``scores`` follows the order of ``spans``. ``redacted`` is the text with the spans
    replaced, NULL where there are none.
    """

    def make():
        def compute(texts: list[str]) -> list[pa.Array]:
            rows = [scan(t, threshold) for t in texts]
            clean = [redact(t, r) if r else None for t, r in zip(texts, rows, strict=True)]
            return [
                spans.array([[(k, s, e, k in BASE) for k, s, e, _ in r] for r in rows]),
                pa.array([[x[3] for x in r] for r in rows], pa.list_(pa.float64())),
                pa.array(clean, pa.string()),
            ]

        return compute

    columns = {"spans": spans.SQL, "scores": "array<double>", "redacted": "string"}
    return per_text(docs, columns, make, id_col, text_col)


def without_pii(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with the spans of each text replaced by their kinds; a NULL text stays NULL."""
    return with_texts(docs, text_col, lambda text: redact(text, scan(text, threshold)))

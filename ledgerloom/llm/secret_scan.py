"""Secret scan: keyword prefilter, anchored patterns near hits, embedded checksums.

One Aho-Corasick pass over a text finds the keywords that any pattern needs; the
patterns run only at those places, anchored, so a text without keywords costs one
linear pass. Runs of hexadecimal digits have no keyword and are found by one
linear pattern. Tokens that carry a checksum (the last six characters are the
CRC-32 of the others in base 62) are kept only when it is right, and a JSON web
token only when its header decodes.

Kinds ``assign``, ``access`` and ``hex`` are the base; the others are added.
Matches of a kind are leftmost and do not overlap. Offsets are code points, the
end is exclusive. A NULL or empty text has no spans; an empty table gives no
rows; repeated rows give repeated results.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame

from ledgerloom.llm import spans
from ledgerloom.llm.common import lower_ascii, per_text

KINDS = ("assign", "access", "hex", "github", "npm", "jwt", "private_key")
BASE = ("assign", "access", "hex")

_ASSIGN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
    re.ASCII,
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_GITHUB = re.compile(r"gh[pousr]_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_NPM = re.compile(r"npm_([0-9A-Za-z]{30})([0-9A-Za-z]{6})(?![0-9A-Za-z])")
_JWT = re.compile(r"(?<![A-Za-z0-9_.-])eyJ([A-Za-z0-9_-]+)\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+")
_KEY = re.compile(r"-----BEGIN (?:[A-Z]{1,12} ){0,3}PRIVATE KEY-----")

_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum62(body: str) -> str:
    """CRC-32 of ``body`` in base 62, six characters."""
    crc, out = binascii.crc32(body.encode()), ""
    for _ in range(6):
        crc, rest = divmod(crc, 62)
        out = _DIGITS[rest] + out
    return out


def _assigned(m: re.Match) -> bool:
    return len(m[1]) >= 6


def _long(m: re.Match) -> bool:
    return len(m[0]) >= 20


def _checked(m: re.Match) -> bool:
    return checksum62(m[1]) == m[2]


def _json_header(m: re.Match) -> bool:
    head = "eyJ" + m[1]
    try:
        return isinstance(json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4))), dict)
    except (ValueError, RecursionError):  # not JSON, or nested deeper than any header
        return False


def _always(m: re.Match) -> bool:
    return True


#: keyword in lower case: the kind, its pattern, what confirms a match
_RULES: dict[str, tuple[str, re.Pattern, Callable[[re.Match], bool]]] = {
    **{k: ("assign", _ASSIGN, _assigned) for k in ("password", "passwd", "secret", "token")},
    **{k: ("assign", _ASSIGN, _assigned) for k in ("apikey", "api_key")},
    "akia": ("access", _ACCESS, _long),
    **{f"gh{c}_": ("github", _GITHUB, _checked) for c in "pousr"},
    "npm_": ("npm", _NPM, _checked),
    "eyj": ("jwt", _JWT, _json_header),
    "-----begin ": ("private_key", _KEY, _always),
}


@cache
def _keywords():
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for word, rule in _RULES.items():
        automaton.add_word(word, (len(word), *rule))
    automaton.make_automaton()
    return automaton


def scan(text: str) -> list[tuple[str, int, int]]:
    """All spans of one text as (kind, start, end), by start, then kind."""
    found = []
    past = dict.fromkeys(KINDS, 0)
    for last, (length, kind, pattern, confirmed) in _keywords().iter(lower_ascii(text)):
        start = last + 1 - length
        if start < past[kind]:
            continue
        if m := pattern.match(text, start):
            past[kind] = m.end()
            if confirmed(m):
                found.append((kind, start, m.end()))
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return spans.ordered(found, KINDS)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and ``spans``, an array of (kind, start, end, base)."""

    def make():
        def compute(texts: list[str]) -> list[pa.Array]:
            return [spans.array([[(k, s, e, k in BASE) for k, s, e in scan(t)] for t in texts])]

        return compute

    return per_text(docs, {"spans": spans.SQL}, make, id_col, text_col)

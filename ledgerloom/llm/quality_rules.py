"""Quality rules as weak supervision: rules vote or abstain, a label model weighs them.

Each rule looks at one property of a text and votes 1 (looks good), 0 (looks bad)
or abstains. No rule decides alone: several look at the same kind of fault, they overlap,
and each is wrong on some good texts. The label model has a class of good texts and one for each
kind of fault, and in every class each rule has its rates of bad votes, abstentions and good
votes. Rules that depend on each other because they see the same fault are independent
within its class. Expectation-maximisation over the counts of vote patterns estimates all
rates and the classes' shares, free of bounds; a weak prior of the start values names the
classes. The posterior probability of the good class decides: a text is kept when it reaches one
half and the two hard rules of the base hold.

All rows are counted. There are at most 3**rules patterns, whatever the input, so
only this bounded table reaches the driver. A NULL or empty text has no words and
fails the base. An empty table gives no rows. Repeated rows count as often as
they occur. A column is never used beyond the text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import forget, per_text, ship, slices
from ledgerloom.session import materialize

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(0x41, 0x5B))
_LETTERS = _UPPER + bytes(range(0x61, 0x7B))

FEATURES = {
    "n_words": "long",
    "word_chars": "long",
    "n_symbols": "long",
    "n_dup_lines": "long",
    "n_repeat_words": "long",
    "n_lines": "long",
    "n_distinct": "long",
    "n_upper": "long",
    "n_letters": "long",
    "n_bangs": "long",
    "n_bare": "long",
}


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside windows of ``window`` words that occur twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    key = seq[:n].copy()
    for j in range(1, window):
        # renumbered after each word, so that keys stay exact and small
        _, key = np.unique(key * len(ids) + seq[j : n + j], return_inverse=True)
    twice = np.bincount(key)[key] > 1
    hit = np.zeros(len(words), bool)
    for j in range(window):
        hit[j : n + j] |= twice
    return int(hit.sum())


def measure(text: str) -> tuple[int, ...]:
    """The values of FEATURES for one text."""
    raw = text.encode()
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in WHITE),
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        len(raw) - len(raw.translate(None, _UPPER)),
        len(raw) - len(raw.translate(None, _LETTERS)),
        raw.count(b"!"),
        sum(len(w) == 1 and not w.isalnum() for w in words),
    )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: the id and the counts that the rules read."""

    return per_text(docs, FEATURES, lambda: _columns, id_col, text_col)


def _columns(texts: list[str]) -> list[pa.Array]:
    rows = np.array([measure(t) for t in texts], np.int64).reshape(-1, len(FEATURES))
    return [pa.array(c) for c in rows.T]


def base_failed() -> Column:
    n = F.col("n_words")
    return (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)


@dataclass(frozen=True)
class Rule:
    """Votes by a measure: at most ``good`` is good, at least ``bad`` is bad, between abstains.

    ``fault`` is the kind of bad text that the rule is meant to see.
    """

    name: str
    fault: str
    value: Callable[[], Column]
    good: float
    bad: float

    def vote(self) -> Column:
        value = self.value()
        return F.when(value <= self.good, 1).when(value >= self.bad, 0).otherwise(-1)


def _share(part: str, whole: str) -> Callable[[], Column]:
    """``part`` over ``whole``, 0 where ``whole`` is 0."""
    return lambda: F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole)), F.lit(0.0))


_mean_word = _share("word_chars", "n_words")


def _marks() -> Column:
    """Symbols and bare marks per word."""
    return _share("n_symbols", "n_words")() + _share("n_bare", "n_words")()


def _sameness() -> Column:
    """Share of words that the text has used before."""
    return F.when(F.col("n_words") > 0, 1 - _share("n_distinct", "n_words")()).otherwise(0.0)


def _shortness() -> Column:
    return 1 / F.greatest(F.col("n_words"), F.lit(1)).cast("double")


RULES = (
    Rule("symbols", "symbols", _share("n_symbols", "n_words"), 0.05, 0.2),
    Rule("symbol_chars", "symbols", _share("n_symbols", "word_chars"), 0.01, 0.06),
    Rule("long_words", "symbols", _mean_word, 5.8, 6.5),
    Rule("bare", "layout", _share("n_bare", "n_words"), 0.03, 0.15),
    Rule("short_words", "layout", lambda: -_mean_word(), -4.8, -4.55),
    Rule("marks", "layout", _marks, 0.05, 0.2),
    Rule("repeats", "repetition", _share("n_repeat_words", "n_words"), 0.05, 0.2),
    Rule("dup_lines", "repetition", _share("n_dup_lines", "n_lines"), 0.05, 0.25),
    Rule("sameness", "repetition", _sameness, 0.3, 0.42),
    Rule("shortness", "form", _shortness, 1 / 80, 1 / 50),
    Rule("short_lines", "form", _share("n_lines", "n_words"), 0.12, 0.25),
    Rule("upper", "form", _share("n_upper", "n_letters"), 0.03, 0.06),
)

GOOD_SHARE = 0.8  # of the start
PRIOR_TEXTS = 20.0  # as many texts as the start values count for
#: rates of bad votes, abstentions and good votes at the start: of any rule on good texts, of a rule
#: on its own fault, and of a rule on another fault
_ON_GOOD, _ON_OWN, _ON_OTHER = (0.03, 0.12, 0.85), (0.7, 0.15, 0.15), (0.1, 0.2, 0.7)
_OUTCOMES = (0, -1, 1)


@dataclass(frozen=True)
class LabelModel:
    """Latent classes: good texts first, then one per kind of fault.

    ``prior`` has the share of each class, ``rates`` by class and rule the rates of bad votes,
    abstentions and good votes.
    """

    prior: np.ndarray
    rates: np.ndarray

    def classes(self, votes: np.ndarray) -> np.ndarray:
        """P(class | votes) for rows of votes (1, 0, -1)."""
        log = np.log(self.prior) + np.einsum("nro,cro->nc", outcomes(votes), np.log(self.rates))
        share = np.exp(log - log.max(1, keepdims=True))
        return share / share.sum(1, keepdims=True)

    def accuracy(self) -> np.ndarray:
        """Of each rule: the rate of good votes on good texts, and of bad votes on faulty ones."""
        faulty = self.prior[1:] / self.prior[1:].sum()
        return np.stack([self.rates[0, :, 2], faulty @ self.rates[1:, :, 0]])

    def posterior(self, votes: list[Column]) -> Column:
        """P(good | votes) as a column: 1 / (1 + the sum of the other classes' odds)."""
        odds = np.log(self.rates) - np.log(self.rates[0])
        others = F.lit(0.0)
        for k in range(1, len(self.prior)):
            log = F.lit(float(np.log(self.prior[k] / self.prior[0])))
            for rule, vote in zip(odds[k], votes, strict=True):
                bad, abstained, good = (F.lit(float(x)) for x in rule)
                log = log + F.when(vote == 0, bad).when(vote == 1, good).otherwise(abstained)
            others = others + F.exp(log)
        return 1 / (1 + others)


def outcomes(votes: np.ndarray) -> np.ndarray:
    """Votes as indicators by text, rule and outcome."""
    return np.stack([votes == o for o in _OUTCOMES], 2).astype(float)


def start(rules: tuple[Rule, ...] = RULES) -> LabelModel:
    faults = list(dict.fromkeys(r.fault for r in rules))
    rates = [[_ON_GOOD] * len(rules)]
    rates += [[_ON_OWN if r.fault == fault else _ON_OTHER for r in rules] for fault in faults]
    prior = [GOOD_SHARE] + [(1 - GOOD_SHARE) / len(faults)] * len(faults)
    return LabelModel(np.array(prior), np.array(rates))


def fit(
    votes: np.ndarray, counts: np.ndarray, rules: tuple[Rule, ...] = RULES, rounds: int = 60
) -> LabelModel:
    """EM over vote patterns and how many texts have each; without any text the start values stay."""
    first = model = start(rules)
    seen = outcomes(votes)
    for _ in range(rounds if len(counts) else 0):
        share = model.classes(votes) * counts[:, None]
        held = share.sum(0)
        rates = np.einsum("nro,nc->cro", seen, share) + PRIOR_TEXTS * first.rates
        prior = held + PRIOR_TEXTS * first.prior
        model = LabelModel(prior / prior.sum(), rates / (held + PRIOR_TEXTS)[:, None, None])
    return model


def learn(counted: DataFrame, rules: tuple[Rule, ...] = RULES) -> LabelModel:
    """The label model of a table with FEATURES."""
    votes = [f"vote_{r.name}" for r in rules]
    cast = counted.select(*[r.vote().alias(v) for r, v in zip(rules, votes, strict=True)])
    patterns = cast.groupBy(*votes).count().collect()  # at most 3**rules rows
    table = np.array([list(p)[:-1] for p in patterns], int).reshape(-1, len(rules))
    return fit(table, np.array([p["count"] for p in patterns], int), rules)


def _judged(counted: DataFrame, model: LabelModel, rules: tuple[Rule, ...]) -> DataFrame:
    """``counted`` with ``base_failed``, ``posterior`` and ``kept``."""
    names = [f"_vote_{r.name}" for r in rules]
    cast = counted.withColumns({v: r.vote() for r, v in zip(rules, names, strict=True)})
    posterior = model.posterior([F.col(v) for v in names])
    return (
        cast.withColumns({"base_failed": base_failed(), "posterior": posterior})
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
        .drop(*names)
    )


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """Per row: the id, FEATURES, ``base_failed``, ``posterior`` of being good, and ``kept``.

    The texts are read once; their counts are stored in the shared folder, because
    both the estimate and the verdict need them.
    """
    counted = materialize(features(docs, id_col, text_col), "quality")
    return _judged(counted, learn(counted, rules), rules)


def _with_features(rows: DataFrame, text: str, keep: bool) -> DataFrame:
    """FEATURES of each row's text, after all of its columns or alone; rows stay where they are.

    Rows go through Python as Arrow batches and come back in slices of the same memory, so no
    row waits in the JVM for its counts.
    """
    ship(rows.sparkSession)
    kind = T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in FEATURES.items()])
    source = rows if keep else rows.select(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for piece in slices(batch, text):
                counts = _columns([t or "" for t in piece[text].to_pylist()])
                kept = [(n, piece[n]) for n in piece.schema.names] if keep else []
                found = [*kept, *zip(FEATURES, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([c for _, c in found], [n for n, _ in found])
        pa.default_memory_pool().release_unused()

    return source.mapInArrow(run, T.StructType([*(source.schema if keep else []), *kind]))


def keep(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with all their columns.

    Texts are measured twice, once for the estimate and once beside their rows; no row is moved.
    """
    columns = docs.columns
    rows = docs.toDF(*[f"_{i}" for i in range(len(columns))])  # no name clashes with a count
    text = f"_{columns.index(text_col)}"
    model = learn(materialize(_with_features(rows, text, False), "quality"), rules)
    judged = _judged(_with_features(rows, text, True), model, rules)
    return judged.where("kept").select(*rows.columns).toDF(*columns)

"""Documents drawn so that their word statistics come near those of a target corpus.

Features are runs of one and two words, hashed to buckets. A bucket's gain is the log of
how much likelier it is in the target than in the source; a document's weight is the
floored mean of its features' gains. Adding Gumbel noise to weights and taking the highest
is sampling without replacement by importance. The noise comes from a digest of the id, so
the draw is the same wherever it runs. Weights are looked up in the array of gains; ranks come from
``radix_sort``.

Two passes read the texts: one counts buckets, of which each task sends one row per bucket,
and one computes weights. Only the table of buckets reaches the driver. NULL and empty
texts have no features and weight 0. A NULL id makes the digest of the empty text and
comes after all ids. Repeated rows count, and are drawn, as often as they occur; equal
scores go by the smaller id. An empty table gives no rows; without a target all gains
follow from the source alone. Only ids and texts are read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import radix_sort
from ledgerloom.llm.common import id_and_text, ship, slices
from ledgerloom.session import materialize

BUCKETS = 10_000
LEAST_WORDS = 20
PERCENT = 25
SEED = 7

#: A-Z to lower case; all else below x80 but 0-9 and a-z becomes a space
_TO_WORDS = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else 32
    for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


def hashed(texts: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words and features of each text, and the buckets of all features, text by text.

    CRC-32 is computed once per different word and pair of words.
    """
    split = [words(t) for t in texts]
    n = np.array([len(w) for w in split], np.int64)
    features = n + np.maximum(n - 1, 0)
    found = pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()
    known = found.dictionary.to_pylist()
    code = found.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    of_word = np.array([zlib.crc32(w) % buckets for w in known], np.int64)
    spaced = [zlib.crc32(b" ", zlib.crc32(w)) for w in known]
    last = np.zeros(len(code), bool)
    last[np.cumsum(n[n > 0]) - 1] = True
    first = np.flatnonzero(~last)
    pairs, pair = np.unique(
        code[first] * len(known) + code[np.minimum(first + 1, max(len(code) - 1, 0))],
        return_inverse=True,
    )
    of_pair = np.array(
        [zlib.crc32(known[p % len(known)], spaced[p // len(known)]) % buckets for p in pairs.tolist()],
        np.int64,
    )
    # each text's words, then its pairs
    text = np.repeat(np.arange(len(texts)), n)
    both = np.concatenate([of_word[code], of_pair[pair]])
    order = np.argsort(np.concatenate([text, text[first]]), kind="stable")
    return n, features, both[order]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How often each bucket occurs in all texts."""
    ship(docs.sparkSession)
    source = id_and_text(docs, text_col, text_col).select("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch):
                total += np.bincount(hashed(_texts(piece), buckets)[2], minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["bucket", "n"])

    each = source.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    counts = np.zeros(buckets, np.int64)
    for row in each.collect():  # one row per bucket
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Of each bucket: floor(1000 * ln of its share in the target over that in the source)."""
    k = float(len(source))
    whole, wanted = float(source.sum()) + k, float(target.sum()) + k
    return np.array(
        [
            math.floor(1000 * math.log((float(t) + 1) * whole / ((float(s) + 1) * wanted)))
            for s, t in zip(source, target, strict=True)
        ],
        np.int64,
    )


def weighted(
    docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_features`` and ``weight``."""
    ship(docs.sparkSession)
    source = id_and_text(docs, id_col, text_col)
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch):
                n, features, bucket = hashed(_texts(piece), len(gain))
                sums = np.concatenate([[0], np.cumsum(gain[bucket])])
                ends = np.cumsum(features)
                weight = (sums[ends] - sums[ends - features]) // np.maximum(features, 1)
                yield pa.RecordBatch.from_arrays(
                    [piece["id"], pa.array(n), pa.array(features), pa.array(weight)],
                    ["id", "n_words", "n_features", "weight"],
                )

    return source.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """Per row: the id, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank``.

    Ids are whole numbers. ``rank`` is 1, 2, 3... for the ``percent`` of the rows with ``least_words``
    that score highest, NULL for all others.
    """
    gain = gains(
        bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets)
    )
    name = F.coalesce(F.col("id").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), name), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = materialize(
        weighted(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise), "scored"
    )
    eligible = scored.where(F.col("n_words") >= least_words)
    n, high, least, most = eligible.agg(
        F.count(F.lit(1)), F.max("score"), F.min("id"), F.max("id")
    ).first()
    drawn = percent * n // 100
    key = F.col("id").cast("long") - F.lit(least or 0)
    after = (most or 0) - (least or 0) + 1
    keyed = eligible.withColumns(
        {"_down": F.lit(high) - F.col("score"), "_id": F.coalesce(key, F.lit(after).cast("long"))}
    )
    places = radix_sort.ranked(keyed, ["_down", "_id"], "_rank")
    rank = F.when(F.col("_rank") < drawn, F.col("_rank") + 1).cast("long").alias("rank")
    out = [F.col("id").alias(id_col), "n_words", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < least_words)
    return places.select(*out, rank).unionByName(
        rest.select(*out, F.lit(None).cast("long").alias("rank"))
    )


def oracle(percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS) -> str:
    """The same query for DuckDB; CRC-32 byte by byte from its table, which the query computes."""
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    return f"""
WITH crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({lower}, '{word}') AS w FROM documents),
b AS (SELECT regexp_extract_all({lower}, '{word}') AS w FROM benchmark),
df AS (SELECT r, unnest(list_concat(w, {pairs})) AS f FROM d),
bf AS (SELECT unnest(list_concat(w, {pairs})) AS f FROM b),
names AS (SELECT DISTINCT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION ALL SELECT f FROM bf)),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(h), 2),
             lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1)),
             lambda c, x: xor(c // 256, t[xor(c % 256, x) + 1])), 4294967295) % {buckets} AS k
  FROM names, crc),
s AS (SELECT k, count(*) AS n FROM df JOIN hashed USING (f) GROUP BY k),
t AS (SELECT k, count(*) AS n FROM bf JOIN hashed USING (f) GROUP BY k),
gain AS (
  SELECT k, CAST(floor(1000 * ln(CAST(coalesce(t.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM df) + {buckets})
                  / (CAST(coalesce(s.n, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM bf) + {buckets})))) AS BIGINT) AS g
  FROM (SELECT unnest(range({buckets})) AS k) LEFT JOIN s USING (k) LEFT JOIN t USING (k)),
w AS (
  SELECT r, count(*) AS n, CAST(floor(CAST(sum(g) AS DOUBLE) / count(*)) AS BIGINT) AS weight
  FROM df JOIN hashed USING (f) JOIN gain USING (k) GROUP BY r),
scored AS (
  SELECT doc_id, len(d.w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(('0x' || substr(sha256('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT)
            + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (r)),
placed AS (
  SELECT *, CASE WHEN n_words >= {least_words} THEN row_number() OVER (
           PARTITION BY n_words >= {least_words} ORDER BY score DESC, doc_id NULLS LAST) END AS place
  FROM scored)
SELECT doc_id, n_features, weight, score,
       CASE WHEN place <= {percent} * (SELECT count(*) FROM scored WHERE n_words >= {least_words}) // 100
            THEN place END AS rank
FROM placed"""

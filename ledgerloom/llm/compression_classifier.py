"""Quality by compression: which of two dictionaries shortens a text more.

One Zstandard dictionary is made of good, one of bad labelled texts. A text is
compressed with each; the difference of the two sizes, normalised by the length,
and the sizes themselves are calibrated to a probability by logistic regression on
labelled texts that are in neither dictionary.

Fitting uses a bounded sample: of each label at most ``SAMPLE`` ids, those with
the smallest hash, and texts of at most ``LONGEST`` characters. Two dictionaries of
at most ``DICTIONARY`` bytes and at most twice SAMPLE rows of sizes reach the driver.
Scoring reads every whole text.

A NULL text counts as empty; every row gets a score, the empty text that of its
sizes. Ids with both labels are left out of fitting, as are NULL labels and ids;
repeated labels count once. With texts of one label only, or none, the score is
the share of label 1, or one half. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import per_text

DICTIONARY = 512 << 10
SAMPLE = 2500
LONGEST = 32_768
LEVEL = 6
RIDGE = 0.3


@dataclass
class Model:
    """The two dictionaries, and the calibration of the sizes they give."""

    bad: bytes = b""
    good: bytes = b""
    level: int = LEVEL
    centre: np.ndarray = field(default_factory=lambda: np.zeros(5))
    scale: np.ndarray = field(default_factory=lambda: np.ones(5))
    weights: np.ndarray = field(default_factory=lambda: np.zeros(6))

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_compressors"}

    @cached_property
    def _compressors(self):
        import zstandard as z

        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        out = []
        for content in (self.bad, self.good):
            if len(content) < 8:  # too short for a dictionary
                out.append(z.ZstdCompressor(level=self.level, **plain))
                continue
            d = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=self.level)
            out.append(z.ZstdCompressor(level=self.level, dict_data=d, **plain))
        return out

    def sizes(self, text: str) -> tuple[int, int, int]:
        """Bytes of the text, and compressed with the bad and with the good dictionary."""
        raw = text.encode()
        bad, good = self._compressors
        return len(raw), len(bad.compress(raw)), len(good.compress(raw))

    @staticmethod
    def features(sizes: np.ndarray) -> np.ndarray:
        """From rows of sizes: the normalised differences, the compression, the length."""
        n, bad, good = sizes.T.astype(float)
        n = n + 16
        shrunk = np.log((bad + good) / n)
        by_size = (bad - good) / (bad + good)
        return np.stack([(bad - good) / n, by_size, shrunk, shrunk**2, np.log(n)], 1)

    def _design(self, sizes: np.ndarray) -> np.ndarray:
        x = np.clip((self.features(sizes) - self.centre) / self.scale, -6, 6)
        return np.concatenate([np.ones((len(x), 1)), x], 1)

    def score(self, sizes: np.ndarray) -> np.ndarray:
        """P(label 1), 0 to 1."""
        if not len(sizes):
            return np.empty(0)
        return 1 / (1 + np.exp(-np.clip(self._design(sizes) @ self.weights, -30, 30)))

    def calibrate(self, sizes: np.ndarray, labels: np.ndarray) -> None:
        """Ridge logistic regression by Newton's method with bounded steps."""
        ones = (labels.sum() + 0.5) / (len(labels) + 1)
        self.weights = np.zeros(6)
        if not 0 < labels.sum() < len(labels):
            self.weights[0] = np.log(ones / (1 - ones))
            return
        x = self.features(sizes)
        self.centre, self.scale = x.mean(0), x.std(0) + 1e-9
        x = self._design(sizes)
        ridge = RIDGE * np.eye(x.shape[1])
        ridge[0, 0] = 1e-6
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))
            curve = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge
            step = np.linalg.solve(curve, x.T @ (labels - p) - ridge @ self.weights)
            self.weights += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break


def sizes(docs: DataFrame, model: Model, id_col: str, text_col: str) -> DataFrame:
    """Per row: the id, the length in bytes and the two compressed sizes."""

    def make():
        def compute(texts: list[str]) -> list[pa.Array]:
            rows = np.array([model.sizes(t) for t in texts], np.int64).reshape(-1, 3)
            return [*map(pa.array, rows.T), pa.array(model.score(rows))]

        return compute

    columns = {"n_bytes": "long", "bad_bytes": "long", "good_bytes": "long", "score": "double"}
    return per_text(docs, columns, make, id_col, text_col)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
    longest: int = LONGEST,
    dictionary: int = DICTIONARY,
) -> Model:
    """A model from the texts of ``docs`` that ``labels`` (id, 0 or 1) covers.

    A third of the sampled ids, by another hash, makes the dictionaries, the rest the
    calibration. Both hashes are of the id, so the same rows are taken at every run. Bounds of
    the fit, not of the scores: ``sample`` ids per label, texts of up to ``longest`` characters,
    ``dictionary`` bytes for each of the two dictionaries.
    """
    key = F.col("id").cast("string")
    known = (
        labels.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").alias("label"))
        .where("id IS NOT NULL AND label IN (0, 1)")
        .groupBy("id")
        .agg(F.min("label").cast("int").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .select("id", "label", F.xxhash64(key, F.lit("sample")).alias("place"))
    )
    parts = [known.where(F.col("label") == y).orderBy("place", key).limit(sample) for y in (0, 1)]
    chosen = parts[0].union(parts[1]).withColumn("build", F.pmod(F.crc32(key), F.lit(3)) == 0)
    # at most 2 * sample ids
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where(F.length("text") <= longest).join(F.broadcast(chosen), "id")
    built = {0: b"", 1: b""}
    # one text per id; whole texts until a dictionary is full, the most typical place last
    texts = rows.where("build").dropDuplicates(["id"]).orderBy("place").toLocalIterator()
    for r in texts:
        if len(built[r["label"]]) < dictionary:
            built[r["label"]] += r["text"].encode()
    model = Model(bad=built[0][-dictionary:], good=built[1][-dictionary:])
    tested = rows.where("NOT build").dropDuplicates(["id"])
    counted = sizes(tested.withColumnRenamed("id", "doc"), model, "doc", "text")
    seen = [
        (r["n_bytes"], r["bad_bytes"], r["good_bytes"], r["label"])
        for r in counted.join(F.broadcast(chosen), counted["doc"] == chosen["id"])
        .orderBy("place", "id")
        .select("n_bytes", "bad_bytes", "good_bytes", "label")
        .collect()  # at most 2 * sample rows
    ]
    table = np.array(seen, np.int64).reshape(-1, 4)
    model.calibrate(table[:, :3], table[:, 3])
    return model


def classify(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row: the id, the sizes and ``score``, the probability of label 1."""
    return sizes(docs, model, id_col, text_col)

"""Exact top-k search by inner product over an index of pivots and distances.

Vectors become whole numbers, so scores are exact. A vector x gets one more component that
gives all the same length M; a query gets 0 there. Then the highest inner products are the
least distances: d(q, x)^2 = |q|^2 + M^2 - 2 qx. The index keys a vector by its nearest
pivot and its distance d(x, p), cut into rings of about equal size, and stores sorted blocks.

For a query, |d(q, p) - d(x, p)| is a lower bound of d(q, x). Each query expands
its rings in the order of that bound, in rounds that cover eight times as many vectors as the
one before; between rounds it learns its k-th best score so far, which is a radius, and every ring,
then every block, whose bound exceeds the radius is left out. A round's work is tiles: a
block of the index against those queries of a group that need it. Without
structure in the data, bounds exclude nothing and all blocks are compared.

What is bounded: the sample for the pivots, the directory of rings (``PIVOTS * RINGS`` rows, in
the driver and in each task), the tile (``BLOCK_BYTES`` and ``GROUP`` queries). At most k + 1
copies of one vector are kept, those with the least ids, as no query can have more among its
best; so a vector that a third of the rows share costs nothing.

Vectors that are NULL or hold a NULL or non-finite component, and rows without an id, take no
part. Vectors of several lengths are compared as if filled up with zeros, an empty one is all
zeros. Equal rows count once; rows with a query's id are not its candidates. Equal scores go by
the smaller id. An empty table gives no rows. Scores beyond 64 bits are cut to that range
before they are compared.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import ship
from ledgerloom.session import materialize

PIVOTS = 64  # at most
RINGS = 8  # per pivot, at most
SAMPLE = 4096  # vectors to which pivots and rings are fitted
PER_PIVOT = 2048  # vectors for each pivot of a small table
FIRST = 1024  # vectors that the first round covers, for each query
GROWTH = 8
BLOCK_BYTES = 1 << 20
BLOCK = 4096
GROUP = 2048  # queries

LARGEST = 2**63 - 1  # score

_WIDTHS = {1: "<i1", 2: "<i2", 4: "<i4", 8: "<f8"}


def pack(values: np.ndarray) -> bytes:
    """Whole numbers in the narrowest width that holds them, after a byte that names it."""
    top = np.abs(values).max(initial=0)
    width = next((w for w in (1, 2, 4) if top < 1 << (8 * w - 1)), 8)
    return bytes([width]) + values.astype(_WIDTHS[width]).tobytes()


def unpack(blobs: list[bytes], size: int) -> np.ndarray:
    """Packed vectors as rows of ``size`` doubles."""
    out = np.zeros((len(blobs), size))
    alike: dict[tuple[int, int], list[int]] = {}
    for i, blob in enumerate(blobs):
        alike.setdefault((blob[0], len(blob)), []).append(i)
    for (width, length), rows in alike.items():
        if length > 1:
            data = np.frombuffer(b"".join(blobs[i][1:] for i in rows), _WIDTHS[width])
            data = data.reshape(len(rows), -1)
            out[rows, : data.shape[1]] = data
    return out


def whole_vectors(vectors: DataFrame, is_query: Column, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """Rows that take part: ``id``, ``query``, packed ``vec``, its ``size`` and squared ``norm``."""
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    source = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("query"),
        vec.alias("vec"),
    ).where("id IS NOT NULL AND vec IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["vec"]
            flat = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
            values = np.split(np.floor(scale * flat), ends[:-1]) if len(ends) else []
            fine = [bool(np.isfinite(v).all()) for v in values]
            kept = [v for v, f in zip(values, fine, strict=True) if f]
            some = batch.filter(pa.array(fine, pa.bool_()))
            columns = [
                some["id"],
                some["query"],
                pa.array([pack(v) for v in kept], pa.binary()),
                pa.array([len(v) for v in kept], pa.int64()),
                pa.array([float(v @ v) for v in kept], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["id", "query", "vec", "size", "norm"])

    return source.mapInArrow(run, "id long, query boolean, vec binary, size long, norm double")


def first_copies(rows: DataFrame, most: int) -> DataFrame:
    """``id`` and ``vec`` without repeated rows; of each vector those with the ``most`` least ids."""
    place = F.row_number().over(Window.partitionBy("vec").orderBy("id"))
    each = rows.groupBy("vec", "id").agg(F.max("norm").alias("norm"), F.max("size").alias("size"))
    return each.withColumn("place", place).where(F.col("place") <= most).drop("place")


def products(left: np.ndarray, right: np.ndarray, norm: float) -> np.ndarray:
    """Exact inner products of rows of whole numbers whose squared lengths are at most ``norm``.

    No partial sum exceeds ``norm``, so a float type that holds all whole numbers up to there
    is exact; beyond doubles, Python's integers are.
    """
    if norm < 2**24:
        return left.astype(np.float32) @ right.astype(np.float32).T
    if norm < 2**53:
        return left @ right.T
    whole = np.frompyfunc(int, 1, 1)
    exact = whole(left) @ whole(right).T
    return np.clip(exact, -LARGEST, LARGEST).astype(np.int64)


@dataclass(frozen=True)
class Index:
    """What tasks know of the index: pivots, inner ring edges, and the data's extent."""

    pivots: np.ndarray
    edges: list[np.ndarray]
    size: int
    norm: float

    @property
    def slack(self) -> float:
        """More than rounding can do to a distance."""
        return 1e-6 * (1 + np.sqrt(self.norm))

    def distances(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """Vector by pivot; all are taken with their further component."""
        squares = (vectors**2).sum(1)
        more = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.norm - squares, 0))
        all_squares = squares + more**2
        cross = vectors @ self.pivots[:, :-1].T + more[:, None] * self.pivots[:, -1]
        whole = all_squares[:, None] + (self.pivots**2).sum(1) - 2 * cross
        return np.sqrt(np.maximum(whole, 0))

    def place(self, vectors: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Nearest pivot, ring, and distance of each vector."""
        far = self.distances(vectors, query)
        pivot = far.argmin(1) if len(far) else np.zeros(0, int)
        near = far[np.arange(len(far)), pivot]
        ring = np.zeros(len(far), int)
        for p in np.unique(pivot):
            mine = pivot == p
            ring[mine] = np.searchsorted(self.edges[p], near[mine], side="right")
        return pivot, ring, near


def fit(candidates: DataFrame, size: int, norm: float, count: int) -> Index:
    """Pivots by a few rounds of k-means over a sample of ``SAMPLE`` vectors, least by hash."""
    some = candidates.orderBy(F.xxhash64("vec", "id"), "id").limit(SAMPLE).select("vec").collect()
    sample = unpack([bytes(r["vec"]) for r in some], size)
    more = np.sqrt(np.maximum(norm - (sample**2).sum(1), 0))
    sample = np.column_stack([sample, more])
    n = max(1, min(PIVOTS, count // PER_PIVOT, len(sample)))
    pivots = sample[:n].copy() if len(sample) else np.zeros((1, size + 1))
    plain = Index(pivots, [np.zeros(0)] * n, size, norm)
    for _ in range(5 if len(sample) else 0):
        near = plain.distances(sample[:, :-1], False).argmin(1)
        for p in range(n):
            if (near == p).any():
                pivots[p] = sample[near == p].mean(0)
    edges = []
    near = plain.distances(sample[:, :-1], False)
    own = near.argmin(1)
    for p in range(n):
        mine = near[own == p, p]
        rings = max(1, min(RINGS, count // (n * PER_PIVOT)))
        cuts = np.arange(1, rings) / rings
        edges.append(np.unique(np.quantile(mine, cuts)) if len(mine) else np.zeros(0))
    return Index(pivots, edges, size, norm)


def _packed(
    rows: DataFrame, index: Index, query: bool, most: int, number: str
) -> DataFrame:
    """``rows`` (id, vec) as stored blocks: sorted by pivot and distance, at most ``most`` in one.

    Blocks of the index hold one ring of one pivot. Groups of queries may cross rings.
    """

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = unpack(batch["vec"].to_pylist(), index.size)
            columns = [*(pa.array(c) for c in index.place(vectors, query)), batch["id"], batch["vec"]]
            yield pa.RecordBatch.from_arrays(columns, ["pivot", "ring", "distance", "id", "vec"])

    def block(held: list[tuple]) -> pa.RecordBatch:
        pivots, rings, distances, ids, vecs = zip(*held, strict=True)
        row = {
            "pivot": [pivots[0]],
            "ring": [rings[0]],
            "low": [distances[0]],
            "high": [distances[-1]],
            "n": [len(ids)],
            "ids": [np.array(ids, "<i8").tobytes()],
            "vecs": [list(vecs)],
        }
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.binary(), pa.list_(pa.binary())]
        return pa.RecordBatch.from_arrays(
            [pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], list(row)
        )

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch), strict=True):
                if held and (len(held) == most or not query and row[:2] != held[0][:2]):
                    yield block(held)
                    held = []
                held.append(row)
        if held:
            yield block(held)

    keyed = rows.select("id", "vec").mapInArrow(
        key, "pivot long, ring long, distance double, id long, vec binary"
    )
    order = ["pivot", "distance", "id"]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    schema = "pivot long, ring long, low double, high double, n long, ids binary, vecs array<binary>"
    blocks = sorted_rows.mapInArrow(gather, schema)
    return materialize(blocks.withColumn(number, F.monotonically_increasing_id()), number)


_BEST = "group long, nth long, query_id long, vec_id long, score long"


def _needs(index: Index, directory: np.ndarray, k: int, covered: tuple[int, int]) -> Callable:
    """For a group of queries and its best so far: the rings that each query needs in this round."""
    pivot, low, high, n = directory[:, 0].astype(int), *directory[:, 2:].T

    def run(group: pa.Table, best: pa.Table) -> pa.Table:
        row = group.to_pylist()[0]
        queries = unpack(row["vecs"], index.size)
        far = index.distances(queries, True)[:, pivot]
        bound = np.maximum(np.maximum(low - far, far - high), 0)
        # rings in the order of the bound, and how many vectors come before each
        order = np.argsort(bound, axis=1, kind="stable")
        before = np.zeros_like(bound)
        np.put_along_axis(before, order, np.cumsum(n[order], axis=1) - n[order], axis=1)
        least = _least(best, len(queries), k)
        radius = np.sqrt(np.maximum((queries**2).sum(1) + index.norm - 2 * least, 0)) + index.slack
        wanted = (before >= covered[0]) & (before < covered[1]) & (bound <= radius[:, None])
        out = []
        for r in np.flatnonzero(wanted.any(0)):
            nth = np.flatnonzero(wanted[:, r])
            out.append(
                {
                    "group": row["group"],
                    "pivot": int(directory[r, 0]),
                    "ring": int(directory[r, 1]),
                    "nth": nth.astype("<i4").tobytes(),
                    "least": least[nth].astype("<f8").tobytes(),
                }
            )
        return pa.Table.from_pylist(out, _NEEDS_ARROW)

    return run


_NEEDS = "group long, pivot long, ring long, nth binary, least binary"
_NEEDS_ARROW = pa.schema(
    [("group", pa.int64()), ("pivot", pa.int64()), ("ring", pa.int64()), ("nth", pa.binary()), ("least", pa.binary())]
)


def _least(best: pa.Table, n: int, k: int) -> np.ndarray:
    """Each query's k-th score so far, rounded down; minus infinity where it has fewer."""
    least = np.full(n, -np.inf)
    if best.num_rows:
        nth = best["nth"].to_numpy()
        score = best["score"].to_numpy().astype(float)
        full = np.bincount(nth, minlength=n) >= k
        low = np.full(n, np.inf)
        np.minimum.at(low, nth, score)
        least[full] = low[full] - np.abs(low[full]) * 1e-15
    return least


def _tile(index: Index, k: int) -> Callable:
    """The best of one block for those queries of a group that need it."""

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        q, b = queries.to_pylist()[0], block.to_pylist()[0]
        nth = np.frombuffer(q["nth"], "<i4")
        least = np.frombuffer(q["least"], "<f8")
        query_ids = np.frombuffer(q["ids"], "<i8")[nth]
        left = unpack([q["vecs"][i] for i in nth], index.size)
        # the block's own distances may exclude it though its ring was needed
        far = index.distances(left, True)[:, b["pivot"]]
        bound = np.maximum(np.maximum(b["low"] - far, far - b["high"]), 0)
        radius = np.sqrt(np.maximum((left**2).sum(1) + index.norm - 2 * least, 0)) + index.slack
        use = np.flatnonzero(bound <= radius)
        nth, least, query_ids, left = nth[use], least[use], query_ids[use], left[use]
        ids = np.frombuffer(b["ids"], "<i8")
        score = products(left, unpack(b["vecs"], index.size), index.norm)
        rough = score if score.dtype.kind == "f" else score.astype(float)
        rough[query_ids[:, None] == ids] = -np.inf
        if len(ids) > k and len(nth):
            kth = np.partition(rough, len(ids) - k, axis=1)[:, len(ids) - k].astype(float)
            least = np.maximum(least, kth - np.abs(kth) * 1e-15)
        i, j = np.nonzero((rough >= least[:, None]) & (rough > -np.inf))
        score = score[i, j].astype(np.int64)
        order = np.lexsort((ids[j], -score, i))  # by query, falling score, rising id
        i, j, score = i[order], j[order], score[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i, side="left") < k
        i, j, score = i[kept], j[kept], score[kept]
        columns = [
            pa.array(np.full(len(i), q["group"]), pa.int64()),
            pa.array(nth[i].astype(np.int64)),
            pa.array(query_ids[i]),
            pa.array(ids[j]),
            pa.array(score),
        ]
        return pa.Table.from_arrays(columns, ["group", "nth", "query_id", "vec_id", "score"])

    return run


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: float = 64.0,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` best rows of each query row.

    A vector's components are floor(``scale`` * x); the score is their inner product.
    """
    ship(vectors.sparkSession)
    rows = materialize(whole_vectors(vectors, is_query, id_col, vec_col, scale), "vectors")
    candidates = materialize(first_copies(rows, k + 1), "candidates")
    count, norm, size = candidates.agg(F.count(F.lit(1)), F.max("norm"), F.max("size")).first()
    index = fit(candidates, size or 0, norm or 0.0, count)
    block = max(1, min(BLOCK, BLOCK_BYTES // (8 * max(1, index.size))))
    blocks = _packed(candidates, index, False, block, "block")
    queries = rows.where("query").select("id", "vec").distinct()
    groups = _packed(queries, index, True, min(GROUP, 4 * block), "group")
    rings = blocks.groupBy("pivot", "ring").agg(F.min("low"), F.max("high"), F.sum("n")).collect()
    directory = np.array(sorted(map(tuple, rings)), float).reshape(-1, 5)

    best = rows.sparkSession.createDataFrame([], _BEST)
    covered, upto = 0, FIRST
    while covered < count:
        needs = materialize(
            groups.groupBy("group")
            .cogroup(best.groupBy("group"))
            .applyInArrow(_needs(index, directory, k, (covered, upto)), _NEEDS),
            "needs",
        )
        pairs = needs.join(blocks.select("pivot", "ring", "block"), ["pivot", "ring"])
        left = pairs.select("group", "block", "nth", "least").join(
            groups.select("group", "ids", "vecs"), "group"
        )
        tiles = pairs.select(F.col("group").alias("of"), F.col("block").alias("at"))
        right = tiles.join(
            blocks.select(F.col("block").alias("at"), "pivot", "low", "high", "ids", "vecs"), "at"
        )
        found = (
            left.groupBy("group", "block")
            .cogroup(right.groupBy("of", "at"))
            .applyInArrow(_tile(index, k), _BEST)
        )
        best = materialize(_top(best.unionByName(found), k).drop("rank"), "best")
        covered, upto = upto, upto * GROWTH
    return _top(best, k).select("query_id", "rank", "vec_id", "score")


def _top(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each query, with their ``rank``."""
    order = Window.partitionBy("group", "nth").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def oracle(every: int = 20, k: int = 20, scale: int = 64) -> str:
    """The same query for DuckDB: all pairs of a query and another row."""
    return f"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {every} = 0),
placed AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place,
         vec_id, score
  FROM scored)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM placed WHERE place <= {k}"""

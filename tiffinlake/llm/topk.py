"""Exact top-k by inner product, pruned by statistics of vector segments from coarse to fine.

A vector's segments keep their mean and their deviation from it. For two vectors the distance of
these statistics is a lower bound of their own distance, so that with their lengths known it bounds
their inner product from above:

    <q, v>  <=  sum of  size * mean(q) * mean(v)  +  deviation(q) * deviation(v)   over the segments.

Pairs whose bound is below the k-th best score found so far are dropped, first with few long
segments, then with more; survivors are scored exactly, in integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tiffinlake.session import materialize

LEVELS = (4, 16)  # segments, coarse to fine
QUERY_BLOCK = 4096  # queries all tasks hold at once
ROW_BLOCK = 2048  # vectors a task compares with them at once
SCALE = 1024
EXACT_FLOAT = float(1 << 53)
NONE = np.iinfo(np.int64).min  # no row yet


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose inner products bound those of the vectors: scaled segment means, then deviations."""
    edge = np.unique(np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int))
    parts = []
    for a, b in zip(edge, edge[1:]):
        piece = vectors[:, a:b]
        mean = piece.mean(axis=1)
        parts.append((mean * math.sqrt(b - a), np.sqrt(((piece - mean[:, None]) ** 2).sum(axis=1))))
    return np.stack([p[0] for p in parts] + [p[1] for p in parts], axis=1)


def usable(ids: pa.Array, vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, sizes and joined components of the vectors that take part: no null, all components finite."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    ids = ids.to_numpy(zero_copy_only=False)
    sizes = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = vectors.flatten().cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    start = np.cumsum(sizes) - sizes
    bad = np.r_[0, np.cumsum(~np.isfinite(flat))]
    good = vectors.is_valid().to_numpy(zero_copy_only=False) & (bad[start + sizes] == bad[start])
    good &= ~np.array([i is None or i != i for i in ids], dtype=bool)
    use = np.repeat(good, sizes)
    return ids[good].astype(np.int64), sizes[good], flat[use]


def by_size(ids: np.ndarray, sizes: np.ndarray, flat: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Ids and scaled integer vectors of each vector size."""
    start = np.cumsum(sizes) - sizes
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        yield int(size), ids[rows], np.floor(SCALE * flat[start[rows][:, None] + np.arange(size)])


class Block:
    """Queries of one vector size, with the best rows each has met."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, places: np.ndarray, k: int):
        self.ids, self.vectors, self.places, self.k = ids, vectors, places, k
        self.stats = [statistics(vectors, s) for s in LEVELS]
        self.score = np.full((len(ids), k), NONE)
        self.row = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.kept = 0

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(ids), ROW_BLOCK):
            self._meet(ids[at:at + ROW_BLOCK], vectors[at:at + ROW_BLOCK])

    def _meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        least = np.where(self.score[:, -1] == NONE, -np.inf, self.score[:, -1].astype(np.float64))
        coarse = self.stats[0] @ statistics(vectors, LEVELS[0]).T
        # Rounding of the statistics must not cost a pair: the bound is widened a little.
        slack = 1e-9 * (np.linalg.norm(self.vectors, axis=1)[:, None] * np.linalg.norm(vectors, axis=1)) + 1e-6
        q, v = np.nonzero((coarse + slack >= least[:, None]) & (self.ids[:, None] != ids))
        for level, segments in enumerate(LEVELS[1:], 1):
            fine = statistics(vectors, segments)
            keep = np.concatenate([np.einsum("ij,ij->i", self.stats[level][q[i:i + 200_000]], fine[v[i:i + 200_000]])
                                   + slack[q[i:i + 200_000], v[i:i + 200_000]] >= least[q[i:i + 200_000]]
                                   for i in range(0, len(q), 200_000)] or [np.zeros(0, bool)])
            q, v = q[keep], v[keep]
        self.kept += len(q)
        if not len(q):
            return
        exact = self._exact(q, v, vectors)
        # The complement of an integer falls as the integer rises, for the smallest one too.
        order = np.lexsort((ids[v], ~exact, q))
        q, v, exact = q[order], v[order], exact[order]
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(np.r_[True, q[1:] != q[:-1]], np.arange(len(q)), 0))
        best = rank < self.k
        new_score = np.full((len(self.ids), self.k), NONE)
        new_row = np.full((len(self.ids), self.k), np.iinfo(np.int64).max)
        new_score[q[best], rank[best]], new_row[q[best], rank[best]] = exact[best], ids[v[best]]
        score, row = np.hstack([self.score, new_score]), np.hstack([self.row, new_row])
        order = np.lexsort((row, ~score), axis=1)[:, :self.k]
        self.score, self.row = np.take_along_axis(score, order, 1), np.take_along_axis(row, order, 1)

    def _exact(self, q: np.ndarray, v: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Integer inner products of the pairs: in floats where all sums are exact there, else in integers of any size."""
        largest = vectors.shape[1] * np.abs(self.vectors[np.unique(q)]).max(initial=0) * np.abs(vectors[np.unique(v)]).max(initial=0)
        if largest < EXACT_FLOAT:
            if len(q) * 10 > len(self.ids) * len(vectors):
                # With this many survivors one product of all is less work than the pairs one by one.
                return (self.vectors @ vectors.T)[q, v].astype(np.int64)
            parts = [np.einsum("ij,ij->i", self.vectors[q[i:i + 100_000]], vectors[v[i:i + 100_000]]) for i in range(0, len(q), 100_000)]
            return np.concatenate(parts).astype(np.int64)
        mine, theirs = ({i: [int(x) for x in rows[i]] for i in np.unique(at).tolist()} for at, rows in ((q, self.vectors), (v, vectors)))
        found = [sum(a * b for a, b in zip(mine[i], theirs[j])) for i, j in zip(q.tolist(), v.tolist())]
        if found and max(map(abs, found)) >= 1 << 63:
            raise OverflowError("an inner product does not fit into 64 bits: scale the vectors down")
        return np.array(found, dtype=np.int64)

    def found(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        real = self.score != NONE
        q, _ = np.nonzero(real)
        yield self.places[q], self.row[real], self.score[real]


def top_k(queries: DataFrame, rows: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and integer ``score`` of the k best rows of every query.

    Queries are met in blocks: a block is sent to all tasks, each task keeps k rows a query, and
    the k best of these are the result. Vectors that are null, or hold null or non-finite
    components, or have no id take no part; nor do pairs of unlike length. Rows with the query's id are its own. Equal scores go
    to the smaller id; repeated rows stay. Empty tables give an empty result. Scores are exact; one that does
    not fit into 64 bits is an error.
    """
    spark = rows.sparkSession
    asked = queries.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where("id is not null and v is not null")
    asked = materialize(asked.withColumn("place", F.monotonically_increasing_id()), "queries")
    blocks = max(1, math.ceil(asked.count() / query_block))
    narrow = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    out = None
    for at in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("place"), F.lit(blocks)) == at)
        found = _pass(spark, part, narrow, k)
        if blocks > 1:
            found = materialize(found, "found")
        out = found if out is None else out.unionByName(found)
    return out


def _pass(spark: SparkSession, part: DataFrame, rows: DataFrame, k: int) -> DataFrame:
    """The result for one block of queries, about ``QUERY_BLOCK`` of them, whatever the size of the table."""
    block = spark.sparkContext.broadcast(part.toPandas())

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = block.value
        ids, sizes, flat = usable(pa.array(range(len(asked)), pa.int64()), pa.array(asked["v"], pa.list_(pa.float64())))
        names, places = asked["id"].to_numpy(dtype=np.int64), asked["place"].to_numpy(dtype=np.int64)
        mine = {size: Block(names[at], v, places[at], k) for size, at, v in by_size(ids, sizes, flat)}
        for batch in batches:
            for size, got, vectors in by_size(*usable(batch.column(0), batch.column(1))):
                if size in mine:
                    mine[size].meet(got, vectors)
        for some in mine.values():
            for place, row, score in some.found():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(place, pa.int64()), pa.array(row, pa.int64()), pa.array(score, pa.int64())], ["place", "vec_id", "score"])

    near = rows.mapInArrow(compare, "place long, vec_id long, score long")
    best = Window.partitionBy("place").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.join(part.select("place", F.col("id").alias("query_id")), "place").select("query_id", "rank", "vec_id", "score")

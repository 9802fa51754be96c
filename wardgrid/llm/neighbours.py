"""Nearest neighbours by a block matrix join on int8 tiles with error bounds; the result is exact.

Vectors are quantised to int8, each with its own scale, and the length of what is lost is kept. A
tile multiplies a block of queries with a block of candidates (int8 values, in slices that float32 adds exactly), which
gives every distance up to the two vectors' losses: a lower and an upper bound. Pairs whose lower
bound is above the query's tenth best so far are dropped; the others are computed from the original
vectors in double precision and merged into a heap per query. Each task returns its heaps and Spark
merges them by query.

Queries come in groups of about GROUP vectors; one group at a time is broadcast and meets all
candidates, so neither side must fit anywhere whole and candidates are never shuffled by query.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do
null ids; rows that repeat a vec_id count once, with the smallest vector; candidates of another
length than the query are no neighbours of it; ties go to the smaller vec_id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgrid.llm.shared import stored

NEAREST = 10
GROUP = 4096
TILE = 2048
#: Components multiplied at a time: 127 * 127 * SLICE is below 2^24, so float32 sums are exact.
SLICE = 1024


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(int8 values, scale, length of the loss) of each row of x (double)."""
    scale = np.abs(x).max(axis=1) / 127
    scale[scale == 0] = 1
    values = np.rint(x / scale[:, None])
    loss = np.sqrt(((x - values * scale[:, None]) ** 2).sum(axis=1))
    return values.astype(np.int8), scale, loss


class Block:
    """Vectors of one length with their quantised form."""

    def __init__(self, ids: np.ndarray, x: np.ndarray) -> None:
        self.ids, self.x = ids, x
        self.values, self.scale, self.loss = quantise(x)
        self.square = (self.values.astype(np.float64) ** 2).sum(axis=1) * self.scale**2

    def __len__(self) -> int:
        return len(self.ids)


def tile_bounds(queries: Block, candidates: Block) -> tuple[np.ndarray, np.ndarray]:
    """(lower, upper) bounds of all distances of a tile."""
    products = np.zeros((len(queries), len(candidates)))
    for at in range(0, queries.values.shape[1], SLICE):
        part = slice(at, at + SLICE)
        products += queries.values[:, part].astype(np.float32) @ candidates.values[:, part].astype(np.float32).T
    squares = queries.square[:, None] + candidates.square[None, :]
    near = squares - 2 * products * queries.scale[:, None] * candidates.scale[None, :]
    distance = np.sqrt(np.maximum(near, 0))
    # Rounding of the sums above: far below this share of the vectors' lengths.
    slack = queries.loss[:, None] + candidates.loss[None, :] + 1e-7 * np.sqrt(squares)
    return distance - slack, distance + slack


class Heaps:
    """The k nearest candidates of each query so far."""

    def __init__(self, queries: Block, k: int) -> None:
        self.queries, self.k = queries, k
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(queries))]
        self.worst = np.full(len(queries), np.inf)

    def meet(self, candidates: Block) -> None:
        lower, upper = tile_bounds(self.queries, candidates)
        own = self.queries.ids[:, None] == candidates.ids[None, :]
        lower[own], upper[own] = np.inf, np.inf
        limit = self.worst
        if upper.shape[1] >= self.k:
            limit = np.minimum(limit, np.partition(upper, self.k - 1, axis=1)[:, self.k - 1])
        q, c = np.nonzero((lower <= limit[:, None]) & np.isfinite(lower))
        for at in range(0, len(q), 1 << 16):
            rows, columns = q[at : at + (1 << 16)], c[at : at + (1 << 16)]
            exact = np.sqrt(((self.queries.x[rows] - candidates.x[columns]) ** 2).sum(axis=1))
            for i, d, vec_id in zip(rows.tolist(), exact.tolist(), candidates.ids[columns].tolist(), strict=True):
                heap, entry = self.heaps[i], (-d, -vec_id)
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        for i in np.unique(q).tolist():
            if len(self.heaps[i]) == self.k:
                self.worst[i] = -self.heaps[i][0][0]

    def rows(self) -> tuple[list, list, list]:
        found = [(int(q), -i, -d) for q, heap in zip(self.queries.ids, self.heaps, strict=True) for d, i in heap]
        return tuple(map(list, zip(*found, strict=True))) if found else ([], [], [])


def blocks(ids: np.ndarray, vectors: pa.ListArray) -> Iterator[Block]:
    """The vectors by length."""
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        for at in range(0, len(rows), TILE):
            part = rows[at : at + TILE]
            yield Block(ids[part], flat[starts[part][:, None] + np.arange(length)[None, :]])


def _searcher(queries, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length = {x.shape[1]: Heaps(Block(ids, x), k) for ids, x in queries.value}
        for batch in batches:
            for block in blocks(batch.column("vec_id").to_numpy(), batch.column("embedding")):
                if (heaps := by_length.get(block.x.shape[1])) is not None:
                    heaps.meet(block)
        for heaps in by_length.values():
            q, i, d = heaps.rows()
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(d, pa.float64())], names=["query_id", "vec_id", "score"]
            )

    return search


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the vectors that take part, one row per id."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    zero = F.forall("embedding", lambda x: x == 0)
    kept = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~bad & ~zero
    )
    return kept.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = NEAREST, group: int = GROUP) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each query, by Euclidean distance."""
    rows = stored(spark, usable(vectors), "neighbours-vectors")
    asked = rows.filter(is_query)
    groups = max(1, -(-asked.count() // group))
    number = F.pmod(F.xxhash64("vec_id"), F.lit(groups))
    found = None
    for g in range(groups):
        by_length: dict[int, list] = {}
        for r in asked.filter(number == g).orderBy("vec_id").collect():  # about `group` vectors
            by_length.setdefault(len(r["embedding"]), []).append(r)
        packed = [(np.array([r["vec_id"] for r in part]), np.array([r["embedding"] for r in part])) for part in by_length.values()]
        queries = spark.sparkContext.broadcast(packed)
        part = rows.mapInArrow(_searcher(queries, k), "query_id long, vec_id long, score double")
        found = part if found is None else found.unionAll(part)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Nearest neighbours of stated queries among all vectors, by an int8 block matrix join.

Queries are taken in blocks of bounded size, each against every vector. A tile of products of
the int8 forms gives all distances of a block and some vectors at once, each with a bound on
what the rounding can have changed. Only pairs whose least possible distance is within the
best ``k`` known are computed again in double precision and enter the heaps. Every task sends
on its ``k`` best of each query, and those are merged.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adstream.llm.common import prepare, saved, scratch

K = 10
# Queries in a block, and vectors in a tile.
QUERIES = 4096
TILE = 1024
# Components in one float product: 127 * 127 * 1024 < 2 ** 24, so sums of them are exact.
EXACT = 1024
# Components below two to this power have squares that add up in double precision.
SAFE_EXPONENT = 480


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 forms (held as float32 for the product), scales, and norms of what is lost."""
    scale = np.abs(x).max(axis=1) / 127
    small = np.rint(x / scale[:, None])
    lost = np.sqrt(((x - small * scale[:, None]) ** 2).sum(axis=1))
    return small.astype(np.float32), scale, lost


def usable(column: str = "embedding") -> F.Column:
    """Vectors that take part: no NULL, no missing or infinite component, not zero."""
    finite = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    return F.coalesce(
        F.forall(column, finite) & F.exists(column, lambda v: v != 0), F.lit(False)
    )


class Block:
    """A block of queries and their heaps."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.small, self.scale, self.lost = quantised(vectors)
        self.square = (vectors**2).sum(axis=1)
        self.small_norm = self.scale * np.sqrt((self.small.astype(np.float64) ** 2).sum(axis=1))
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.limit = np.full(len(ids), np.inf)

    def meet(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Compare all queries with a tile of vectors."""
        small, scale, lost = quantised(x)
        square = (x**2).sum(axis=1)
        product = np.zeros((len(self.ids), len(ids)))
        for at in range(0, x.shape[1], EXACT):
            product += self.small[:, at : at + EXACT] @ small[:, at : at + EXACT].T
        dot = product * self.scale[:, None] * scale
        # |q.x - dot| <= |q'| |x - x'| + |q - q'| |x|, with ' for the int8 form.
        bound = self.small_norm[:, None] * lost + self.lost[:, None] * np.sqrt(square)
        middle = self.square[:, None] + square - 2 * dot
        slack = 2 * bound + 1e-9 * (self.square[:, None] + square)
        other = self.ids[:, None] != ids
        if len(ids) > self.k:
            highest = np.where(other, middle + slack, np.inf)
            kth = np.partition(highest, self.k - 1, axis=1)[:, self.k - 1]
            limit = np.minimum(self.limit, kth)
        else:
            limit = self.limit
        query, found = np.nonzero((middle - slack <= limit[:, None]) & other)
        for at in range(0, len(query), 4096):
            q, f = query[at : at + 4096], found[at : at + 4096]
            apart = (self.vectors[q] - x[f]) ** 2
            distance = np.sqrt(np.add.accumulate(apart, axis=1)[:, -1])
            for i, score, vec_id in zip(q.tolist(), distance.tolist(), ids[f].tolist(), strict=True):
                entry, heap = (-score, -vec_id), self.heaps[i]
                if len(heap) < self.k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        for i in np.unique(query).tolist():
            if len(self.heaps[i]) == self.k:
                self.limit[i] = self.heaps[i][0][0] ** 2 * (1 + 1e-9)

    def rows(self) -> pa.RecordBatch:
        best = [(int(q), -v, -s) for q, heap in zip(self.ids, self.heaps, strict=True) for s, v in heap]
        return pa.RecordBatch.from_arrays(
            [pa.array([b[i] for b in best], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64()))],
            ["query_id", "vec_id", "score"],
        )


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def nearest(vectors: DataFrame, is_query: F.Column, k: int = K, block: int = QUERIES) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``, the Euclidean distance.

    ``vectors`` has ``vec_id`` and ``embedding``. Rows that :func:`usable` rejects, and those
    with a NULL ``vec_id``, take no part. Only vectors of equal length are compared. A query
    never meets rows of its own ``vec_id``; other repeated rows each count. Of a repeated
    query the least vector asks. Ties go to the smaller ``vec_id``.
    """
    spark = prepare(vectors.sparkSession)
    rows = vectors.where(usable() & F.col("vec_id").isNotNull())
    # Where squares could overflow all components are made smaller by a power of two, and scores larger.
    largest = rows.agg(F.max(F.array_max(F.transform("embedding", lambda v: F.abs(v.cast("double")))))).first()[0]
    shift = max(0, math.frexp(largest or 0.0)[1] - SAFE_EXPONENT)
    if shift:
        smaller = F.transform("embedding", lambda v: v.cast("double") * F.lit(math.ldexp(1.0, -shift)))
        rows = rows.withColumn("embedding", smaller)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = saved(asked.withColumn("dimension", F.size("embedding")), scratch(spark, "queries"))
    sizes = asked.groupBy("dimension").agg(F.count("*").alias("n")).orderBy("dimension").collect()
    found = []
    for dimension, n in sizes:
        blocks = -(-n // block)
        for b in range(blocks):
            own = asked.where(F.col("dimension") == dimension).where(
                F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b
            )
            some = own.select("vec_id", "embedding").toArrow().combine_chunks()
            if some.num_rows:
                ids = some["vec_id"].to_numpy()
                matrix = _matrix(some["embedding"].combine_chunks(), dimension)
                sent = spark.sparkContext.broadcast((ids, matrix))
                candidates = rows.where(F.size("embedding") == dimension).select(
                    F.col("vec_id").cast("long").alias("vec_id"), "embedding"
                )
                found.append(
                    candidates.mapInArrow(_meet(sent, dimension, k), "query_id long, vec_id long, score double")
                )
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # A query has k rows from each task.
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", (F.col("score") * math.ldexp(1.0, shift)).alias("score"))
    )


def _meet(sent, dimension: int, k: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(*sent.value, k)
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                block.meet(part["vec_id"].to_numpy(), _matrix(part["embedding"], dimension))
        yield block.rows()

    return meet

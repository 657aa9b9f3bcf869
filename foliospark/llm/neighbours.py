"""Nearest neighbours by inner product from randomly rotated one-bit codes.

Every vector is indexed as its length, the signs of its rotated unit vector and
one correction scalar (the inner product of that unit vector and its code).
For a query, the packed signs and the scalars give an estimate of the inner
product and a bound of its error; only vectors whose upper bound reaches the
k-th best exact value so far are reranked with the original vectors.  The
rotation is drawn from a seed, so nothing is fitted.

Queries go out in blocks of bounded size; each block passes over the index once.
A vector takes part if it isn't null or zero, has only finite components, and
has the commonest number of components (ties: the larger).  A query's own rows
are those with its id; a repeated id gives repeated rows among the results of
others, and one result as a query.  Rows with a null id take no part.  Equal
scores are ordered by id.  Empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_loop, list_array, slices, stored

INDEX = "vec_id long, code binary, norm double, correction double, vector array<double>"
FOUND = "query_id long, vec_id long, score double"
#: Deviations of the error bound.  Reranking is exact, so a larger bound costs time only.
EPSILON = 3.5
SLICE, QUERIES = 4096, 512


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array of double) of the rows that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", fine) & F.exists("vector", lambda x: x != 0))
    common = rows.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("vector") == (common["d"] if common else 0))


def rotation(d: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def build_index(rows: DataFrame) -> DataFrame:
    """INDEX of every usable row."""

    def make():
        turned: list[np.ndarray] = []

        def step(batch):
            x = matrix(batch.column("vector"))
            turned or turned.append(rotation(x.shape[1]))
            # Scaled by the largest component first, so that squares neither vanish nor overflow.
            top = np.abs(x).max(axis=1)
            unit = x / top[:, None]
            length = np.linalg.norm(unit, axis=1)
            y = (unit / length[:, None]) @ turned[0].T
            codes = np.packbits(y >= 0, axis=1)
            correction = np.abs(y).sum(axis=1) / np.sqrt(x.shape[1])
            columns = [batch.column("vec_id"), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(length * top), pa.array(correction), list_array(x.ravel(), np.full(len(x), x.shape[1]), pa.float64())]
            return pa.RecordBatch.from_arrays(columns, ["vec_id", "code", "norm", "correction", "vector"])

        return step

    return rows.mapInArrow(arrow_loop(make), INDEX)


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products of corresponding rows, always added in the order of the components."""
    out = np.zeros(len(x))
    for i in range(x.shape[1]):
        out += x[:, i] * q[:, i]
    return out


class Search:
    """The k nearest so far of every query of one block, while rows of the index pass by."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, epsilon: float):
        self.ids, self.queries, self.k = ids, queries, k
        d = queries.shape[1]
        self.lengths = np.linalg.norm(queries, axis=1)
        self.turned = ((queries / self.lengths[:, None]) @ rotation(d).T).astype(np.float32)
        self.epsilon = epsilon / np.sqrt(max(1, d - 1))
        self.near = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))] * (-(-len(ids) // QUERIES))
        self.least = np.full(len(ids), -np.inf)

    def merge(self, block: int, q: np.ndarray, ids: np.ndarray, scores: np.ndarray):
        """Keep the best k for each query; scores decide, then the smaller id."""
        q, ids, scores = (np.concatenate(c) for c in zip(self.near[block], (q, ids, scores)))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.flatnonzero(np.diff(q, prepend=-1))
        rank = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
        keep = rank < self.k
        last = rank == self.k - 1
        self.least[q[last]] = scores[last]
        self.near[block] = q[keep], ids[keep], scores[keep]

    def add(self, ids: np.ndarray, codes: np.ndarray, norms: np.ndarray, corrections: np.ndarray, x: np.ndarray):
        d = x.shape[1]
        signs = np.unpackbits(codes, axis=1, count=d).astype(np.float32) * 2 - 1
        for block in range(len(self.near)):
            a = block * QUERIES
            part = slice(a, a + QUERIES)
            # The estimate is relative to both lengths; so is its bound, one value for each row.
            estimate = (self.turned[part] @ signs.T) / np.float32(np.sqrt(d)) / corrections.astype(np.float32)
            bound = (np.sqrt(np.maximum(0, 1 - corrections**2)) / corrections * self.epsilon + 1e-5).astype(np.float32)
            size = norms.astype(np.float32)
            upper = (estimate + bound) * size * self.lengths[part, None].astype(np.float32)
            # Before there are k exact values, the best estimates give some.
            fresh = np.flatnonzero(np.isinf(self.least[part]))
            if len(fresh):
                ranked = np.where(self.ids[a + fresh][:, None] == ids, -np.inf, estimate[fresh] * size)
                take = min(2 * self.k, len(ids))
                best = np.argpartition(-ranked, take - 1, axis=1)[:, :take]
                q, r = np.repeat(fresh, take), best.ravel()
                upper[q, r] = -np.inf
                others = self.ids[a + q] != ids[r]
                q, r = q[others], r[others]
                self.merge(block, a + q, ids[r], products(x[r], self.queries[a + q]))
            least = self.least[part] - 1e-6 * np.abs(self.least[part])
            rerank = upper >= least[:, None]
            rerank &= upper > -np.inf
            found = []
            for i in np.flatnonzero(rerank.any(axis=1)).tolist():
                r = np.flatnonzero(rerank[i])
                # A product by matrices first; only what can enter the list is added up in order.
                r = r[(x[r] @ self.queries[a + i] >= least[i]) & (ids[r] != self.ids[a + i])]
                if len(r):
                    found.append((np.full(len(r), a + i), r))
            if found:
                q, r = (np.concatenate(c) for c in zip(*found))
                self.merge(block, q, ids[r], products(x[r], self.queries[q]))

    def rows(self) -> Iterator[pa.RecordBatch]:
        for q, ids, scores in self.near:
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[q]), pa.array(ids), pa.array(scores)], ["query_id", "vec_id", "score"])


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, epsilon: float = EPSILON, block_bytes: int = 32 << 20) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k nearest rows found for every row where ``is_query`` (a condition on vec_id) holds.

    At most about ``block_bytes`` of queries are held by the driver and a task at
    a time; that, not the number of queries, bounds what is broadcast.
    """
    spark = vectors.sparkSession
    index = stored(build_index(usable(vectors)), "vector-index")
    queries = index.where(is_query).select("vec_id", "vector").dropDuplicates(["vec_id"])
    size = queries.agg(F.sum(8 * F.size("vector") + 8).alias("b")).first()["b"] or 0
    blocks = max(1, -(-int(1.2 * size) // block_bytes))
    found = None
    for b in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).collect()
        if not mine:
            continue
        mine.sort()
        sent = spark.sparkContext.broadcast((np.array([r["vec_id"] for r in mine], np.int64), np.array([r["vector"] for r in mine], float)))

        def scan(batches, sent=sent):
            search = Search(*sent.value, k, epsilon)
            for batch in slices(batches, SLICE):
                codes = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
                scalar = lambda c: batch.column(c).to_numpy()  # noqa: B023, E731
                search.add(scalar("vec_id"), codes, scalar("norm"), scalar("correction"), matrix(batch.column("vector")))
            yield from search.rows()

        block = index.mapInArrow(scan, FOUND)
        found = block if found is None else found.unionByName(block)
    if found is None:
        found = spark.createDataFrame([], FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

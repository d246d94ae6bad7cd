"""Exact top-k search by inner product with pivot-table elimination.

Components become floor(scale * x).  A pivot table holds every vector's distances
to many pivots.  By the triangle inequality the largest difference between the
query's and a candidate's distances bounds their distance from below, hence the
inner product (|q|^2 + |v|^2 - d^2) / 2 from above.  A task walks its part of the
table with a block of queries, evaluates each query's candidates in the order of
their bounds and stops where the bound falls below the k-th best score so far, so
the scores left out are proven lower.  Tasks keep k rows a query; the last step
merges them.

Queries are taken in blocks of ``QUERY_BLOCK``, the proven size of what is
broadcast; the table is stored once and read for each block.

Defined results: vectors that are null or hold a null, NaN or infinite component,
and rows without vec_id, take no part; rows with one vec_id count as one vector
(of different ones the smallest, compared by component); shorter vectors are
filled up with zeros, so an empty one scores 0; ties go to the smaller vec_id;
other columns are not read.  Vectors too long for exact scores as doubles are scored in
integers (a score is a long, so one beyond 63 bits is not defined).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoplens.llm.common import cut
from shoplens.session import ship_by_value

SCALE = 256
PIVOTS = 24
#: Vectors that the pivots are chosen from, the first by a hash.
PIVOT_SAMPLE = 2000
QUERY_BLOCK = 4096
#: Vectors of one step of a task; with the queries of a block it bounds the memory.
STEP = 512
#: Candidates that a query evaluates first; each further round doubles them.
ROUND = 16
#: Scores and squared lengths below it are exact as doubles; from it on they are computed as longs.
EXACT = 1 << 52
#: The score of no candidate.
NONE = {np.dtype(np.float64): -np.inf, np.dtype(np.int64): np.iinfo(np.int64).min}


def whole_vectors(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, v): the integer vector of every row that takes part, one per vec_id."""
    x = F.col("embedding")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("long"))
    return (vectors.where(F.col("vec_id").isNotNull() & x.isNotNull()).where(fine)
            .select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).groupBy("vec_id").agg(F.min("v").alias("v")))


def _matrix(column: pa.Array, width: int, kind: type = np.float64) -> np.ndarray:
    """Rows of integers, filled up with zeros; as doubles they are exact below EXACT."""
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), kind)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy()
    return out


def choose_pivots(sample: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """Pivots far from each other: each next one is the vector farthest from those chosen."""
    if not len(sample):
        return sample
    far = np.linalg.norm(sample - sample.mean(axis=0), axis=1)
    chosen = [int(far.argmax())]
    far = np.linalg.norm(sample - sample[chosen[0]], axis=1)
    while len(chosen) < count and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


def distances(m: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.stack([np.linalg.norm(m - p, axis=1) for p in pivots], axis=1) if len(pivots) else np.zeros((len(m), 0))


def pivot_table(whole: DataFrame, pivots: np.ndarray, width: int) -> DataFrame:
    """(vec_id, v, far): the stored table with each vector's distances to the pivots."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            far = distances(_matrix(b.column(1), width), pivots)
            ends = pa.array(np.arange(len(far) + 1) * far.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(ends, pa.array(far.ravel()))],
                                             names=["vec_id", "v", "far"])

    return cut(whole.mapInArrow(run, "vec_id long, v array<long>, far array<double>"), "pivot-table")


class Best:
    """The k best (score, vec_id) of each query of a block."""

    def __init__(self, queries: int, k: int, kind: type = np.float64):
        self.k = k
        self.none = NONE[np.dtype(kind)]
        self.score = np.full((queries, k), self.none, kind)
        self.id = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        score = np.concatenate((self.score[rows], score), axis=1)
        ids = np.concatenate((self.id[rows], ids), axis=1)
        order = np.lexsort((~ids, score), axis=1)[:, :-self.k - 1:-1]  # a long's least value has no negative
        self.score[rows] = np.take_along_axis(score, order, axis=1)
        self.id[rows] = np.take_along_axis(ids, order, axis=1)


def search_step(best: Best, q_id: np.ndarray, q: np.ndarray, q_far: np.ndarray,
                c_id: np.ndarray, c: np.ndarray, c_far: np.ndarray) -> int:
    """Bring the candidates c into ``best``; returns how many scores were computed.  Bounds are
    doubles, scores of the kind of ``q`` and ``c``."""
    q2, c2 = (np.square(m.astype(np.float64)).sum(axis=1) for m in (q, c))
    low = np.zeros((len(q), len(c)))
    for p in range(q_far.shape[1]):
        np.maximum(low, np.abs(q_far[:, p, None] - c_far[None, :, p]), out=low)
    top = q2[:, None] + c2[None, :]
    slack = 1e-9 * (top + 1)  # rounding of the distances
    bound = (top - low * low) / 2 + slack
    bound[q_id[:, None] == c_id[None, :]] = -np.inf
    order = np.argsort(-bound, axis=1)
    bound = np.take_along_axis(bound, order, axis=1)
    rows, at, step, done = np.arange(len(q)), 0, ROUND, 0
    while at < len(c):
        kth = best.score[rows, -1]
        rows = rows[(bound[rows, at] >= kth) & (bound[rows, at] > -np.inf)]  # the others have stopped
        if not len(rows):
            break
        part = order[rows, at:at + step]
        score = np.einsum("nd,nmd->nm", q[rows], c[part])
        own = bound[rows, at:at + step] == -np.inf
        score[own] = best.none
        ids = np.where(own, np.iinfo(np.int64).max, c_id[part])
        best.add(rows, score, ids)
        done += score.size
        at, step = at + step, step * 2
    return done


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, pivots: int = PIVOTS,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best other vectors."""
    spark = vectors.sparkSession
    whole = cut(whole_vectors(vectors, scale), "whole-vectors")
    size = whole.agg(F.max(F.size("v")).alias("width"), F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, e: s + e.cast("double") * e)).alias("long"), F.sum(is_query.cast("long")).alias("n")).first()
    kind = np.float64 if (size.long or 0) < EXACT else np.int64
    width = size.width or 0
    sample = whole.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("v").toArrow().column(0).combine_chunks()
    chosen = choose_pivots(_matrix(sample, width), pivots)
    known = pivot_table(whole, chosen, width)
    blocks = 1 + int(size.n or 0) // query_block
    found = None
    for b in range(blocks):
        mine = known.where(is_query).where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).select("vec_id", "v").toArrow()
        q_id = mine.column(0).to_numpy().astype(np.int64)
        q = _matrix(mine.column(1).combine_chunks(), width, kind)
        sent = spark.sparkContext.broadcast((q_id, q, distances(q.astype(np.float64), chosen)))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            ids, queries, far = sent.value
            best = Best(len(ids), k, kind)
            for whole_batch in batches:
                for at in range(0, whole_batch.num_rows, STEP):
                    part = whole_batch.slice(at, STEP)
                    c_far = part.column(2).flatten().to_numpy().reshape(part.num_rows, -1)
                    search_step(best, ids, queries, far, part.column(0).to_numpy(), _matrix(part.column(1), width, kind), c_far)
            row, place = np.nonzero(best.score > best.none)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[row]), pa.array(best.id[row, place]), pa.array(best.score[row, place].astype(np.int64))],
                names=["query_id", "vec_id", "score"])

        own = known.mapInArrow(run, "query_id long, vec_id long, score long")
        found = own if found is None else found.unionByName(own)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship_by_value(__name__)

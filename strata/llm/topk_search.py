"""Exact top-k search by inner product, with block-at-a-time pruning.

Vectors are integer term weights.  Rows lie in blocks of a document range; a
block keeps the maximum and minimum of every term and a forward index (the
block's vectors).  A query's bound for a block is the sum, over its terms, of
the larger of weight x maximum and weight x minimum.  Blocks are taken in the
order of their bounds and scored through their forward index until the next
bound is below the k-th score so far.  The stated query set runs against all
rows in query blocks of bounded size, each broadcast to every task.
"""

from __future__ import annotations

from typing import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from strata.llm.common import map_arrow, materialise

EXACT = 2.0 ** 53


def _terms(batch: pa.RecordBatch) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids and integer vectors of the rows."""
    column = batch.column(1)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    cuts = np.cumsum([0, *(len(x) for x in column)])
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64), [flat[a:b] for a, b in zip(cuts, cuts[1:])]


def _score(queries: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Exact inner products as 64-bit integers: through doubles where no sum can pass 2**53."""
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(docs).max(initial=0)) * queries.shape[1]
    if largest < EXACT:
        return np.rint(queries.astype(np.float64) @ docs.T.astype(np.float64)).astype(np.int64)
    return queries @ docs.T


def _better(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The positions of the k best: highest score, then smallest id."""
    return np.lexsort((ids, -scores))[:k]


class _Best:
    """The k best of each query so far."""

    def __init__(self, n: int, k: int) -> None:
        self.k = k
        self.scores = np.zeros((n, k), np.int64)
        self.ids = np.zeros((n, k), np.int64)
        self.filled = np.zeros(n, np.int64)

    def kth(self) -> np.ndarray:
        """The score that a block must be able to reach."""
        return np.where(self.filled == self.k, self.scores[:, -1].astype(np.float64), -np.inf)

    def add(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        n = int(self.filled[q])
        scores, ids = np.concatenate([self.scores[q, :n], scores]), np.concatenate([self.ids[q, :n], ids])
        top = _better(scores, ids, self.k)
        self.filled[q] = len(top)
        self.scores[q, :len(top)], self.ids[q, :len(top)] = scores[top], ids[top]


def search_blocks(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, block_rows: int, best: _Best | None = None) -> _Best:
    """The k best of ``vectors``, and of those already in ``best``, for each query, by pruned block-at-a-time scoring."""
    best = _Best(len(query_ids), k) if best is None else best
    order = np.argsort(ids, kind="stable")  # blocks are ranges of documents
    blocks = [order[i:i + block_rows] for i in range(0, len(order), block_rows)]
    maxima = np.array([vectors[b].max(axis=0) for b in blocks], np.float64)
    minima = np.array([vectors[b].min(axis=0) for b in blocks], np.float64)
    weights = queries.astype(np.float64)
    bounds = np.maximum(weights, 0) @ maxima.T + np.minimum(weights, 0) @ minima.T
    slack = 1e-9 * (np.abs(weights) @ np.maximum(np.abs(maxima), np.abs(minima)).T)  # sums beyond 2**53 are rounded
    bounds += np.where(slack < 1e-9 * EXACT, 0, slack)
    ranked = np.argsort(-bounds, axis=1, kind="stable")
    active = np.arange(len(query_ids))
    for step in range(len(blocks)):
        at = ranked[active, step]
        going = bounds[active, at] >= best.kth()[active]
        active, at = active[going], at[going]
        if not len(active):
            break
        for block in np.unique(at):
            rows, asks = blocks[block], active[at == block]
            scores = _score(queries[asks], vectors[rows])
            own = ids[rows][None, :] == query_ids[asks][:, None]
            floor = best.kth()[asks]
            useful = (scores >= floor[:, None]) & ~own
            for i in np.flatnonzero(useful.any(axis=1)):
                hits = np.flatnonzero(useful[i])
                if len(hits) > k:  # keep every tie of the k-th score
                    kth = -np.partition(-scores[i, hits], k - 1)[k - 1]
                    hits = hits[scores[i, hits] >= kth]
                best.add(asks[i], scores[i, hits], ids[rows][hits])
    return best


def usable_vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """``id, terms``: floor(scale * x) of each component; rows with a null id, a null vector
    or a null or non-finite component take no part, neither do empty vectors."""
    vector = F.col(vector_col).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return (df.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where((F.size(vector) > 0) & finite)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(F.lit(scale).cast(DoubleType()) * x).cast("long")).alias("terms")))


def _scorer(shared: Broadcast, k: int, block_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Score a task's rows against a query block; k rows a query come out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[int, _Best] = {}  # by size of vectors; what a task has found prunes its later batches
        for batch in batches:
            ids, rows = _terms(batch)
            sizes = np.array([len(r) for r in rows])
            for size, (query_ids, queries) in shared.value.items():
                here = np.flatnonzero(sizes == size)
                if not len(here):
                    continue
                tops[size] = search_blocks(query_ids, queries, ids[here], np.array([rows[j] for j in here], np.int64), k, block_rows, tops.get(size))
        for size, best in tops.items():
            filled = np.arange(k)[None, :] < best.filled[:, None]
            columns = np.repeat(shared.value[size][0], best.filled), best.ids[filled], best.scores[filled]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query_id", "id", "score"])

    return run


def top_k(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, every: int = 50, scale: float = 256.0,
          block_rows: int = 256, query_block: int = 8192) -> DataFrame:
    """``query_id, rank, <id_col>, score``: the k best rows for every row whose id is divisible by ``every``.

    Scores are exact integer inner products; ties go to the smaller id.  A
    query's own row, by id, is no candidate.  Rows whose id, vector or any
    component is null or non-finite, and empty vectors, take no part; vectors
    are compared with those of the same length only.  A repeated id gives one
    query (that of the smallest vector) and a candidate for each row.  Fewer
    than k candidates give fewer rows; no rows give no rows.  Queries are
    broadcast in blocks of about ``query_block``, one block at a time: a job's
    tasks score it against their rows and write at most k rows a query each.
    """
    vectors = usable_vectors(df, id_col, vector_col, scale)
    asked = vectors.where(F.col("id") % every == 0).groupBy("id").agg(F.min("terms").alias("terms"))
    n_blocks = max(1, -(-asked.count() // query_block))
    sc, found = df.sparkSession.sparkContext, None
    for i in range(n_blocks):
        chunk = asked.where(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == i).collect()  # about query_block rows
        by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size in {len(r.terms) for r in chunk}:
            same = [r for r in chunk if len(r.terms) == size]
            by_size[size] = np.array([r.id for r in same], np.int64), np.array([r.terms for r in same], np.int64)
        shared = sc.broadcast(by_size)
        part = materialise(map_arrow(vectors, _scorer(shared, k, block_rows), "query_id long, id long, score long"), "topk-block")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")  # k rows a task and query at most
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))

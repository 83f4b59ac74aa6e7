"""Exact top-k inner products by no-random-access aggregation.

Every dimension is a list of the candidates sorted by their value in it; a query reads a
list from its high end where its own component is positive, from its low end where it is
negative. A round reads all lists some levels deeper. What was read is exact; for a value
not yet reached, the list's frontier bounds its product from above and the list's far end
from below, so every candidate has a lower and an upper score bound. A query stops when no
candidate outside its k best lower bounds can still qualify; the scores of those that stay
are then read to the end.

The bounds of a whole block of queries against a whole block of candidates are two matrix
products each: a value not yet reached is replaced by the frontier (or the far end).

Candidates and queries are dealt into blocks of bounded size and every query block meets
every candidate block in a task of its own; the tasks' k best are then ranked per query.
The queries are a stated set of rows (1 in 20). Defined results: vectors that are NULL or
hold NULL or non-finite components take no part; vectors meet those of their own length
only; an empty vector scores 0; ties go to the smaller vec_id; repeated candidate rows are
ranked as rows of their own and repeated queries answered once; a NULL vec_id takes no
part; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from demandlens.llm.tables import table

# Fixed values of the query.
QUERY_EVERY = 20
TOP = 20
SCALE = 64.0

#: Rows of a candidate block and of a query block (a task holds one of each).
CANDIDATE_BLOCK = 16_384
QUERY_BLOCK = 2_048
#: Queries whose bounds are held at once.
SLICE = 256
#: Share of each list that is read after each round.
ROUNDS = (0.5, 0.85, 1.0)


# ------------------------------------------------------------------ one block
class SortedLists:
    """The lists of a block of integer vectors: one per dimension, both reading directions."""

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.ordered = np.sort(vectors, axis=0)

    def frontiers(self, share: float) -> tuple[np.ndarray, np.ndarray]:
        """Lowest value read from the high ends and highest read from the low ends after this
        share of every list. Equal values are read together."""
        n = len(self.ordered)
        depth = min(n, max(1, int(np.ceil(share * n))))
        return self.ordered[n - depth], self.ordered[depth - 1]

    def bounds(self, queries: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) of every query and candidate after reading this share."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        high, low = self.frontiers(share)
        v = self.vectors
        upper = up @ np.maximum(v, high).T + down @ np.minimum(v, low).T
        if share >= 1:
            return upper, upper
        lower = up @ np.where(v >= high, v, self.ordered[0]).T + down @ np.where(v <= low, v, self.ordered[-1]).T
        return lower, upper


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """k-th largest of every row (the smallest if there are fewer)."""
    k = min(k, values.shape[1])
    return np.partition(values, values.shape[1] - k, axis=1)[:, values.shape[1] - k]


def block_top(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int):
    """Arrays (query_id, vec_id, score) of the candidates that can be among a query's k best
    of this block, ties included. ``vectors`` and ``queries`` hold integers."""
    peak = float(np.abs(vectors).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(vectors.shape[1], 1)
    if peak < 2**53:  # products and sums stay exact
        kind = np.float32 if peak < 2**24 else np.float64
        vectors, queries = vectors.astype(kind), queries.astype(kind)
    else:
        vectors, queries = vectors.astype(object), queries.astype(object)
    lists = SortedLists(vectors)
    found = []
    for at in range(0, len(queries), SLICE):
        q, qid = queries[at : at + SLICE], query_ids[at : at + SLICE]
        open_ = np.arange(len(q))
        for share in ROUNDS:
            lower, upper = lists.bounds(q[open_], share)
            own = qid[open_][:, None] == ids[None, :]
            if vectors.dtype == object:
                lower, upper = lower.astype(np.float64), upper.astype(np.float64)
            worst = -np.inf
            lower, upper = np.where(own, worst, lower), np.where(own, worst, upper)
            cut = _kth(lower, k)
            can = (upper >= cut[:, None]) & ~own
            # Stop: hardly more than k candidates can still qualify, or everything is read.
            done = np.flatnonzero((can.sum(1) <= 2 * k) | (share >= 1))
            for r in done:
                c = np.flatnonzero(can[r])
                if len(c):
                    score = q[open_[r]] @ vectors[c].T  # the rest of the lists, for those alone
                    found.append((np.full(len(c), qid[open_[r]], np.int64), ids[c], np.array([int(s) for s in score], np.int64)))
            open_ = np.delete(open_, done)
            if not len(open_):
                break
    if not found:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x) for x in zip(*found))


# ------------------------------------------------------------------ Spark
def quantised(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, v array<bigint>): floor(scale * x) of the vectors that take part."""
    x = F.transform("embedding", lambda e: e.cast("double"))
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    fine = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~bad)
    return fine.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.transform(x, lambda e: F.floor(e * scale).cast("bigint")).alias("v"))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = TOP, candidate_block: int = CANDIDATE_BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of every query, its own row
    aside. Both inputs are (vec_id, v)."""
    queries = queries.dropDuplicates(["vec_id", "v"])
    n, m = candidates.count(), queries.count()
    blocks, query_blocks = max(1, -(-n // candidate_block)), max(1, -(-m // query_block))
    row_hash = F.xxhash64("vec_id", "v")
    left = candidates.select(F.pmod(row_hash, F.lit(blocks)).cast("int").alias("block"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("query_block"), F.lit(False).alias("is_query"), "vec_id", "v")
    right = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.pmod(row_hash, F.lit(query_blocks)).cast("int").alias("query_block"), F.lit(True).alias("is_query"), "vec_id", "v")

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        query, ids = pdf["is_query"].to_numpy(bool), pdf["vec_id"].to_numpy(np.int64)
        out = [np.zeros(0, np.int64)] * 3
        if query.any() and not query.all():
            v = np.stack(list(pdf["v"])) if len(pdf["v"].iloc[0]) else np.zeros((len(pdf), 0), np.int64)
            out = block_top(v[~query], ids[~query], v[query], ids[query], k)
        return pd.DataFrame({"query_id": out[0], "vec_id": out[1], "score": out[2]})

    # A task's rows: one block pair of one vector length.
    met = left.union(right).groupBy("block", "query_block", F.size("v").alias("dims")).applyInPandas(meet, "query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_nra_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best of all vectors of ``embeddings`` for every vector whose id is divisible by 20."""
    v = quantised(table(spark, sf_dir, "embeddings"))
    return top_k(v, v.where(F.col("vec_id") % QUERY_EVERY == 0))


OP5_SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(range(len(q.v)), lambda i: q.v[i + 1] * c.v[i + 1])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % {QUERY_EVERY} = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""

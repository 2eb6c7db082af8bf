"""Exact top-k inner products by columnar branch and bound.

Vectors are stored dimension by dimension.  A task holds one slice of the distinct candidate vectors and one block of queries.
Scores are accumulated block by block of ``STEP`` dimensions, those with the most mass first; after each, the product
of the masses (norms) that query and candidate have left bounds what is still to come from above and below (Cauchy-Schwarz).
Candidates whose upper bound does not reach the k-th best lower bound go, and the rest are compacted.

Equal vectors are one candidate with its smallest ids, of which a query needs ``k + 1`` at most (its own may be
among them), so a vector that very many rows share costs one comparison.  Slices and query blocks are dealt by hash: every
pair of a slice and a block is a task of bounded size, and what leaves it are k rows a query.

Defined cases: vectors that are NULL, or hold NULL, NaN or infinite components, take no part, nor do rows without an id and
vectors with a component beyond ``LARGEST`` (their products may not fit a long); a query meets the vectors of
its own length; rows equal in id and vector count once, rows with a query's id are its own; equal scores
are in the order of ids; fewer than k others give fewer rows; an empty table gives an empty result; only the
two named columns are read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loanmart.llm.common import forget_others, partitions_for, store, table

STEP = 16
SLICE, LEAST_SLICE, QUERIES = 65_536, 2_048, 8_192
LARGEST = 1 << 26
BATCH = 64                                                  # queries whose first block of dimensions is taken at once


def scaled(vector: Column, scale: float) -> Column:
    """Integer components ``floor(scale * x)``; NULL for vectors that take no part."""
    x = vector.cast("array<double>")
    fit = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) <= LARGEST / scale), F.lit(False)))
    return F.when(fit, F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("bigint")))


class Columns:
    """Candidate vectors (rows of ``c``) in vertical layout, dimensions by falling mass, with the mass left from each block on."""

    def __init__(self, c: np.ndarray):
        self.n, d = c.shape
        mass = (c.astype(np.float64) ** 2).sum(0)
        self.order = np.argsort(-mass, kind="stable")
        self.starts = list(range(0, d, STEP))
        self.most = float(np.abs(c).max(initial=0))
        self.cols = np.ascontiguousarray(c[:, self.order].T)
        self.left = self.masses(c)

    def masses(self, x: np.ndarray) -> list[np.ndarray]:
        """Norm of each row of ``x`` over the dimensions after each block."""
        sq = x[:, self.order].astype(np.float64) ** 2
        return [np.sqrt(sq[:, s + STEP:].sum(1)) for s in self.starts]

    def search(self, queries: np.ndarray, k: int):
        """For each query the places and scores of all vectors that may be among the best ``k``."""
        d = len(self.order)
        exact = np.abs(queries).max(initial=0) * self.most * max(1, d) < 2.0 ** 52
        kind = np.float64 if exact else np.int64             # doubles hold these integers exactly
        cols, q = self.cols.astype(kind), queries[:, self.order].astype(kind)
        masses = self.masses(queries)
        for lo in range(0, len(q), BATCH):
            first = q[lo:lo + BATCH, :STEP] @ cols[:STEP]
            for j in range(lo, min(lo + BATCH, len(q))):
                alive, score = None, first[j - lo]
                for b, s in enumerate(self.starts):
                    if b:
                        part = cols[s:s + STEP] if alive is None else cols[s:s + STEP].take(alive, 1)
                        score = score + q[j, s:s + STEP] @ part
                    if len(score) <= k:
                        continue
                    rest = masses[b][j] * (self.left[b] if alive is None else self.left[b][alive])
                    reach = np.partition(score - rest, len(score) - k)[-k]
                    keep = np.flatnonzero(score + rest >= reach - 1 - 1e-9 * abs(reach))
                    if len(keep) < len(score):
                        alive = keep if alive is None else alive[keep]
                        score = score[keep]
                yield np.arange(self.n) if alive is None else alive, score.astype(np.int64)


def _matrix(col: pa.ChunkedArray, d: int) -> np.ndarray:
    flat = col.combine_chunks()
    flat = flat.combine_chunks() if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(col), d)


def _cell(left: pa.Table, right: pa.Table, k: int, out: pa.Schema) -> pa.Table:
    """Best k of a slice (vectors and their ids) for each query of a block."""
    forget_others(__name__)
    if not left.num_rows or not right.num_rows:
        return out.empty_table()
    d = left.column("d")[0].as_py()
    ids, own = left.column("ids").to_pylist(), right.column("query_id").to_pylist()
    rows: dict[str, list] = {n: [] for n in out.names}
    hashes = right.column("query_hash").to_pylist()
    best = Columns(_matrix(left.column("v"), d)).search(_matrix(right.column("v"), d), k + 1)
    for me, qh, (places, scores) in zip(own, hashes, best):
        near = [(-s, i) for p, s in zip(places.tolist(), scores.tolist()) for i in ids[p] if i != me]
        for s, i in heapq.nsmallest(k, near):
            for name, x in zip(out.names, (me, qh, i, -s)):
                rows[name].append(x)
    return pa.table(rows, schema=out)


def top_k(vectors: DataFrame, queries: Column, k: int, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best other rows for each row of ``vectors`` where ``queries`` holds.

    ``queries`` is a condition on a column ``id`` (bigint).
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), scaled(F.col(f"`{vec_col}`"), scale).alias("v"))
    rows = store(rows.filter("id IS NOT NULL AND v IS NOT NULL").dropDuplicates(["id", "v"]), "vectors")
    few = Window.partitionBy("v").orderBy("id")
    distinct = (rows.withColumn("rn", F.row_number().over(few)).filter(F.col("rn") <= k + 1)
                .groupBy("v").agg(F.collect_list("id").alias("ids")))
    distinct = store(distinct.select("v", F.size("v").alias("d"), "ids"), "distinct")
    asked = rows.filter(queries).select(F.col("id").alias("query_id"), F.xxhash64("v").alias("query_hash"), "v", F.size("v").alias("d"))
    n, m = distinct.count(), asked.count()
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    slices = max(partitions_for(n, SLICE), min(width, partitions_for(n, LEAST_SLICE)))
    blocks = partitions_for(m, QUERIES)
    every = lambda count: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(count - 1).cast("bigint")))
    left = distinct.select("*", F.pmod(F.xxhash64("v"), F.lit(slices)).alias("slice"), every(blocks).alias("block"))
    right = asked.select("*", F.pmod(F.xxhash64("query_id", "v"), F.lit(blocks)).alias("block"), every(slices).alias("slice"))
    out = pa.schema([("query_id", pa.int64()), ("query_hash", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    keys = ["d", "slice", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(
        lambda a, b: _cell(a, b, k, out), "query_id bigint, query_hash bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op12_vector_search(spark, sf_dir: str) -> DataFrame:
    """The five best other vectors for every vector whose id 50 divides."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)


OP12_SQL = """
WITH e AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, q.v, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON len(c.v) = len(q.v) AND c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT query_id, vec_id, score, row_number() OVER (PARTITION BY query_id, v ORDER BY score DESC, vec_id) AS rank FROM s) AS r
WHERE rank <= 5
"""

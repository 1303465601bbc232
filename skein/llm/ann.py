"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Every vector is centred, scaled to length 1, turned by a random rotation and kept as one
sign bit per dimension plus two scalars: its distance from the centre and the
correction <code, vector>. The inner product of a query with the code, divided by the
correction, estimates the inner product with the vector without bias; its error is
bounded by EPSILON * sqrt((1 - c^2) / c^2 / (dim - 1)) with high probability. Only vectors whose
lower bound does not exceed the k-th best exact distance found so far are reranked
on the original vectors.

The stated queries meet all rows in blocks: chunks of rows x blocks of queries, each
pair in one bounded task, k results out of each; the k best of those are the result.
Ties, duplicates and very common vectors need no care: no cell depends on a key's size.

Defined results: vectors that are null, zero or hold null or non-finite components take
no part, nor do rows without an id; rows with one id count as one record (the smallest
vector); vectors are compared with those of their own dimension; fewer candidates than k
are all returned; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

EPSILON = 1.9  # width of the error bound; recall on uniformly spread vectors is above 0.99
CHUNK_ROWS = 16_384  # rows of a cell
BLOCK_QUERIES = 1_024  # queries of a cell
STEP_ROWS = 2_048  # rows estimated at once


@lru_cache(maxsize=8)
def rotation(dim: int, seed: int = 17) -> np.ndarray:
    """A random orthogonal matrix (QR of a Gaussian one, signs fixed)."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """(packed sign bits, distance from the centre, correction) per row."""
    x = vectors - centre
    length = np.sqrt((x * x).sum(1))
    unit = (x / np.maximum(length, 1e-300)[:, None]) @ turn
    return np.packbits(unit >= 0, axis=1), length, np.abs(unit).sum(1) / np.sqrt(x.shape[1])


def exact(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed in the order of the components."""
    d = rows - query
    return np.sqrt(np.add.accumulate(d * d, axis=1)[:, -1])


def search_cell(ids: np.ndarray, vectors: np.ndarray, q_ids: np.ndarray, queries: np.ndarray, k: int):
    """The k nearest rows of a cell for each query: (query id, row id, distance) arrays."""
    dim = vectors.shape[1]
    turn, centre = rotation(dim), vectors.mean(0)
    bits, length, corr = encode(vectors, centre, turn)
    q = queries - centre
    q_len = np.sqrt((q * q).sum(1))
    q_unit = ((q / np.maximum(q_len, 1e-300)[:, None]) @ turn).T.astype(np.float32)
    near = [(np.zeros(0, np.int64), np.zeros(0)) for _ in q_ids]
    bound = np.full(len(q_ids), np.inf)
    for a in range(0, len(ids), STEP_ROWS):
        part = slice(a, a + STEP_ROWS)
        signs = np.unpackbits(bits[part], axis=1, count=dim).astype(np.float32) * 2 - 1
        c = np.maximum(corr[part], 1e-9)[:, None]
        cos = (signs @ q_unit) / (np.sqrt(dim) * c)
        off = EPSILON * np.sqrt(np.maximum(1 - c * c, 0) / (c * c) / max(dim - 1, 1)) + 1e-6
        scale = 2 * length[part][:, None] * q_len[None, :]
        base = length[part][:, None] ** 2 + q_len[None, :] ** 2
        low = base - scale * np.minimum(cos + off, 1)
        if len(low) > k:  # k rows are surely within the k-th upper bound
            high = base - scale * np.maximum(cos - off, -1)
            kth = np.sqrt(np.maximum(np.partition(high, k, axis=0)[k], 0)) * (1 + 1e-9) + 1e-6
        else:
            kth = np.full(len(q_ids), np.inf)
        limit = np.minimum(bound, kth)
        take = low <= (limit * limit)[None, :] + 1e-9
        for j in range(len(q_ids)):
            cand = np.flatnonzero(take[:, j]) + a
            cand = cand[ids[cand] != q_ids[j]]
            if not len(cand):
                continue
            d = np.concatenate([near[j][1], exact(vectors[cand], queries[j])])
            i = np.concatenate([near[j][0], ids[cand]])
            best = np.lexsort((i, d))[:k]
            near[j] = (i[best], d[best])
            if len(best) == k:
                bound[j] = d[best[-1]]
    counts = [len(i) for i, _ in near]
    return (np.repeat(q_ids, counts), np.concatenate([i for i, _ in near]) if counts else np.zeros(0, np.int64),
            np.concatenate([d for _, d in near]) if counts else np.zeros(0))


def usable(v: Column) -> Column:
    """Vectors that take part: some component, all finite, not all zero."""
    return (F.coalesce(F.size(v), F.lit(0)) > 0) & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x)
            & (F.abs(x) < F.lit(float("inf")))), F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _matrix(col: pa.ChunkedArray, dim: int) -> np.ndarray:
    return np.asarray(col.combine_chunks().flatten(), dtype=np.float64).reshape(-1, dim)


def nearest(df: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows of each query row."""
    spark = df.sparkSession
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v")).filter(F.col("id").isNotNull())
    rows = rows.filter(usable(F.col("v"))).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))
    flagged = df.select(F.col(vec_id).cast("long").alias("id"), is_query.alias("q"))
    n, n_queries = flagged.agg(F.count(F.lit(1)), F.count_if("q")).first()
    at_least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = max(at_least, -(-n // CHUNK_ROWS))
    blocks = max(1, -(-n_queries // BLOCK_QUERIES))
    part = lambda count: F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    left = rows.withColumn("chunk", part(chunks)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = rows.withColumnRenamed("id", vec_id).filter(is_query).withColumnRenamed(vec_id, "id")
    right = asked.withColumn("block", part(blocks)).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def cell(key, rows_: pa.Table, asked_: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not rows_.num_rows or not asked_.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names=names)
        dim = key[0].as_py()
        got = search_cell(rows_["id"].to_numpy(), _matrix(rows_["v"], dim), asked_["id"].to_numpy(), _matrix(asked_["v"], dim), k)
        return pa.table([pa.array(x) for x in got], names=names)

    keys = ["dim", "chunk", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score double")
    w = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

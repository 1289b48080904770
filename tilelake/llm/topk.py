"""Exact top-k search by tiled matrix products.

Queries and candidates are dealt into blocks and shards of bounded size; a tile is one block against one shard. Each
tile multiplies its two matrices and keeps each query's best ``k``; the lists of a query are then merged in rounds,
``FAN_IN`` shards at a time.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tilelake.runtime import checkpointed

#: Rows of a query block and of a candidate shard, and shards whose lists are merged in one round.
QUERY_BLOCK, SHARD, FAN_IN = 2048, 16384, 16
_EXACT = 2.0**53
_HITS = "qid long, query_id long, cid long, vec_id long, score long, shard int"


def _usable(vector: str) -> Column:
    """False for a null vector and for one with a null or non-finite component."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Rows of lists as a matrix; shorter lists end in zeros."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), int(sizes.max(initial=0))), np.int64)
    out[np.arange(out.shape[1])[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products: floating point where they are exact in it, else 64-bit integers."""
    width = max(q.shape[1], c.shape[1])
    q, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (q, c))
    most = float(np.abs(q).max(initial=0)) * float(np.abs(c).max(initial=0)) * max(1, width)
    return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64) if most < _EXACT else q @ c.T


def _best_of_tile(k: int):
    def best(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found = {n: [] for n in ("qid", "query_id", "cid", "vec_id", "score")}
        if queries.num_rows and candidates.num_rows:
            q_rows, q_ids = queries["row"].to_numpy(), queries["vec_id"].to_numpy()
            c_rows, c_ids = candidates["c_row"].to_numpy(), candidates["c_id"].to_numpy()
            order = np.lexsort((c_rows, c_ids))
            c_rows, c_ids = c_rows[order], c_ids[order]
            q, c = _matrix(queries["vector"]), _matrix(candidates["c_vector"])[order]
            for start in range(0, len(q), 256):
                scores = _products(q[start : start + 256], c)
                for i, row in enumerate(scores, start):
                    able = np.flatnonzero(c_rows != q_rows[i])
                    if len(able) > k:
                        own = row[able]
                        cut = np.partition(own, len(own) - k)[len(own) - k]
                        above = able[own > cut]
                        # equal scores: candidates are in order of id, so the first ones win
                        able = np.concatenate((above, able[own == cut][: k - len(above)]))
                    found["qid"].append(np.full(len(able), q_rows[i]))
                    found["query_id"].append(np.full(len(able), q_ids[i]))
                    found["cid"].append(c_rows[able])
                    found["vec_id"].append(c_ids[able])
                    found["score"].append(row[able])
        columns = {n: pa.array(np.concatenate(v) if v else np.empty(0, np.int64), pa.int64()) for n, v in found.items()}
        n = len(columns["qid"])
        shard = candidates["shard"][0].as_py() if n else 0
        return pa.table(columns | {"shard": pa.array(np.full(n, shard, np.int32), pa.int32())})

    return best


def _merge(lists: DataFrame, k: int, *by: Column) -> DataFrame:
    order = Window.partitionBy("qid", *by).orderBy(F.desc("score"), "vec_id", "cid")
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` best candidates of every row that ``is_query`` marks.

    Components become floor(scale * x); the score is the integer inner product, ties go to the smaller id. Vectors
    that are null or hold null or non-finite components take no part; shorter vectors count as ending in zeros. A query meets every
    row but itself, so repeated rows meet each other and each gets a list of its own. Rows with a null id take no part. Without
    queries or candidates the result is empty; only the two named columns are read.
    """
    quantised = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    rows = vectors.filter(_usable(vector_col) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"),
        quantised.alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = checkpointed(rows)
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asking")).first()
    shards, blocks = max(1, math.ceil(counts["n"] / SHARD)), max(1, math.ceil(counts["asking"] / QUERY_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = rows.filter("asks").select("row", "vec_id", "vector", deal(blocks).alias("block"), every(shards).alias("shard"))
    # names of their own: both sides come from the same table
    candidates = rows.select(F.col("row").alias("c_row"), F.col("vec_id").alias("c_id"), F.col("vector").alias("c_vector"), deal(shards).alias("shard"), every(blocks).alias("block"))
    tiles = queries.groupBy("block", "shard").cogroup(candidates.groupBy("block", "shard"))
    lists = tiles.applyInArrow(_best_of_tile(k), _HITS)
    while shards > FAN_IN:
        lists = _merge(lists, k, F.floor(F.col("shard") / FAN_IN)).withColumn("shard", F.floor(F.col("shard") / FAN_IN).cast("int"))
        shards = math.ceil(shards / FAN_IN)
    return _merge(lists, k).select("query_id", "rank", "vec_id", "score")


def op5(spark, sf_dir) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 50 == 0, 5)


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q, row_number() OVER () AS r
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0),
s AS (
  SELECT a.vec_id AS query_id, a.r, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score, b.r AS br
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
t AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, br) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM t WHERE rank <= 5
"""

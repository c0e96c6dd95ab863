"""A query set against all vectors, in blocks: what the two vector searches share."""

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common

#: Vectors and queries that one task holds at most, about.
ROWS_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 8_192
#: Below that many rows a block is not worth a task of its own.
LEAST_ROWS = 2_048


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector (array<double>) of the rows that take part.

    Null ids, null or empty vectors, and vectors with null or non-finite components take none. Of rows
    of equal vec_id one counts, the one with the smallest vector; other columns are ignored.
    """
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & (F.size("vector") > 0) & finite)
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def search_blocks(queries: DataFrame, vectors: DataFrame, search: Search, k: int, score: str) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest scores of each query, ties to the smaller vec_id.

    `search(query_ids, queries, ids, vectors)` gives (query row, id, score) of the k best of one block, without the query
    itself. Rows are dealt to blocks by a hash of their id, so none is larger for alike vectors. Vectors meet
    queries of their own length only. `queries` and `vectors` have vec_id, vector.
    """
    spark = vectors.sparkSession
    n, q = vectors.count(), queries.count()
    cores = spark.sparkContext.defaultParallelism
    blocks = max(-(-n // ROWS_PER_BLOCK), min(cores, -(-n // LEAST_ROWS)), 1)
    query_blocks = max(-(-q // QUERIES_PER_BLOCK), 1)

    def dealt(df, own, n_own, other, n_other):
        return df.select(
            "vec_id", "vector", F.size("vector").alias("dim"),
            F.pmod(F.xxhash64("vec_id"), F.lit(n_own)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other),
        )

    left = dealt(vectors, "block", blocks, "query_block", query_blocks).groupBy("dim", "block", "query_block")
    right = dealt(queries, "query_block", query_blocks, "block", blocks).groupBy("dim", "block", "query_block")
    schema = f"query_id bigint, vec_id bigint, score {score}"

    def run(mine: pa.Table, asked: pa.Table) -> pa.Table:
        if not mine.num_rows or not asked.num_rows:
            found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
            query_ids = np.zeros(0, np.int64)
        else:
            query_ids = asked.column("vec_id").to_numpy()
            found = search(query_ids, matrix(asked.column("vector")), mine.column("vec_id").to_numpy(), matrix(mine.column("vector")))
        kind = pa.float64() if score == "double" else pa.int64()
        return pa.table({"query_id": pa.array(query_ids[found[0]], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2]).cast(kind)})

    best = left.cogroup(right).applyInArrow(run, schema)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= least)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]

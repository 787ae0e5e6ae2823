"""Approximate nearest neighbours with a permutation index.

Every vector is represented by its ``PREFIX`` nearest pivots in order. The index is dealt over segments; in a segment, the inverted file of a
pivot holds the rows that have it and at which place. A query walks the files of its own nearest pivots and adds up what each posting
takes off the footrule distance, so only postings are read: with pivots that are about equally common ``PREFIX ** 2 / PIVOTS`` for each row
of the segment, 32 where the exact product takes a multiplication for each component. The nearest rows are ranked again by the exact inner product.

How many rows are ranked again grows with the square root of all rows, by the same rule at every size: ``RERANK`` times the root, each segment its part.
The number of pivots is fixed, so the postings that a query reads grow with the rows; with queries a fixed part of all rows, that is the square of
the table, at half of the exact product's operations for 64 components. More pivots with shorter lists read less and lose rows that lie apart
from all others first: their nearest rows share few pivots with them.

Equal vectors are indexed once with their smallest ids (no more than a result can show), so a vector that is repeated
thousands of times is one row. Queries meet segments in blocks; each block keeps no more than the best rows of each query.

For the inner product, vectors get one more component that brings all to the same length (queries get 0 there), so that near in
angle means large in product.

Cases: rows whose vector or id is null, whose vector is zero, has a null or non-finite component or another length than most
take no part; ties go to the smaller id; repeated rows (same id) count as one; with fewer candidates than asked for, all are
returned; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.shared import hot_keys, salted_join, written

PIVOTS, PREFIX = 512, 128
#: Rows ranked again for each query, as a multiple of the square root of all rows.
RERANK = 6.0
#: Rows of a segment and queries of a block at most; every block meets every segment.
SEGMENT, BLOCK = 65_536, 16_384
#: Smaller tables are cut into so many segments, of so many rows or more; what is found depends on the rows alone.
FEW_SEGMENTS, LEAST_SEGMENT = 16, 2048
#: Rows whose distances to all pivots a task holds at once.
SLICE = 1024


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.float64)


def _order(vectors: np.ndarray, extra: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first."""
    lifted = np.concatenate([vectors, extra[:, None]], 1)
    parts = [np.argsort(-(lifted[i : i + SLICE] @ pivots.T), axis=1, kind="stable")[:, :prefix].astype(np.int16) for i in range(0, len(lifted), SLICE)]
    return np.concatenate(parts)


class _Files:
    """The inverted files of a segment, one after the other: postings in the order of pivot and row, and where each pivot's begin."""

    def __init__(self, order: np.ndarray, n_pivots: int):
        self.n, self.m = order.shape
        flat = order.ravel()
        at = np.argsort(flat, kind="stable")
        self.row, self.left = at // self.m, (self.m - at % self.m).astype(np.int16)
        self.ends = np.cumsum(np.bincount(flat, minlength=n_pivots))

    def nearness(self, perm: np.ndarray) -> np.ndarray:
        """What each row lacks of the greatest footrule distance, halved: with absent pivots at place m on both sides, that distance is a
        constant less twice the sum over common pivots of m less the larger place. Rows without a common pivot have 0."""
        out = np.zeros(self.n, np.int32)
        for place, pivot in enumerate(perm):
            posted = slice(self.ends[pivot - 1] if pivot else 0, self.ends[pivot])
            out[self.row[posted]] += np.minimum(self.left[posted], np.int16(self.m - place))  # a file has a row once
        return out.astype(np.int64)


def _search_cell(rows: pd.DataFrame, queries: pd.DataFrame, top: int, n_pivots: int, part: float) -> pd.DataFrame:
    """The best ``top`` of the rows for each query, among the ``part`` of them with the least footrule distance."""
    rows = rows.sort_values("vid", ignore_index=True)
    vid, by_dim, order = rows["vid"].to_numpy(), np.ascontiguousarray(_matrix(rows["v"]).T), np.stack(rows["perm"].to_numpy())
    n, m = order.shape
    take = min(n, int(np.ceil(part * n)))
    files = _Files(order, n_pivots)
    out = []
    for qid, q, perm in zip(queries["vid"], _matrix(queries["v"]), queries["perm"], strict=True):
        found = np.argpartition(np.arange(n) - files.nearness(perm) * n, take - 1)[:take]
        score = np.zeros(take)
        for d in range(len(q)):  # in the order of the components, so that equal vectors score equally everywhere
            score += by_dim[d, found] * q[d]
        best = np.lexsort((vid[found], -score))[:top]
        out.append(pd.DataFrame({"qvid": qid, "vid": vid[found[best]], "score": score[best]}))
    return pd.concat(out)


def search(vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int = PIVOTS, prefix: int = PREFIX, rerank: float = RERANK, segment: int = SEGMENT, block: int = BLOCK) -> DataFrame:
    """For each row of ``vectors`` where ``is_query`` holds: query_id, rank (from 1), vec_id and score of its ``k`` nearest others. Ids must be whole
    numbers or cast to such."""
    spark = vectors.sparkSession
    rows = vectors.withColumn("_query", F.coalesce(is_query, F.lit(False))).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), "_query")
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("v")))
    widths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("v") == widths[0]["d"]).withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 as 0.0

    # equal vectors: no result shows more than k of them, or k + 1 with the query's own
    first = rows.select("id", "v").dropDuplicates().withColumn("n", F.row_number().over(Window.partitionBy("v").orderBy("id"))).where(F.col("n") <= k + 1)
    distinct = first.groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    distinct = written(distinct.select("v", "ids", F.col("ids")[0].alias("vid"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("norm")), "ann-vectors")
    asked = written(rows.where("_query").select("id", "v").dropDuplicates(["id"]), "ann-queries")
    hot = hot_keys(asked.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "v", asked.count())
    asked = salted_join(asked, distinct.select("v", "vid"), "v", hot, "id", "inner").select(F.col("id").alias("query_id"), F.col("vid").alias("qvid"))
    asked = written(asked, "ann-asked")

    n, longest = distinct.agg(F.count(F.lit(1)), F.max("norm")).first()
    picked = distinct.orderBy(F.xxhash64("vid"), "vid").limit(pivots).select("v", "norm").collect()  # a bounded sample
    lift = lambda norm: np.sqrt(np.maximum(longest**2 - np.asarray(norm, np.float64) ** 2, 0))
    table = np.array([r["v"] for r in picked], np.float64)
    held = spark.sparkContext.broadcast(np.concatenate([table, lift([r["norm"] for r in picked])[:, None]], 1))

    def represent(flat: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                x = np.array(b.column("v").flatten().to_numpy(zero_copy_only=False)).reshape(b.num_rows, -1)
                extra = np.zeros(len(x)) if flat else lift(b.column("norm").to_numpy(zero_copy_only=False))
                perm = _order(x, extra, held.value, prefix)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * perm.shape[1], pa.int32()), pa.array(perm.ravel(), pa.int16()))
                yield pa.RecordBatch.from_arrays([b.column("vid"), b.column("v"), lists], names=["vid", "v", "perm"])

        return run

    shape = "vid long, v array<double>, perm array<short>"
    source = distinct.select("vid", "v", "norm")
    segments = max(-(-n // segment), min(FEW_SEGMENTS, -(-n // LEAST_SEGMENT)))
    part = max(rerank * np.sqrt(n), k + 1) / n
    blocks = max(1, -(-asked.select("qvid").distinct().count() // block))
    index = source.mapInArrow(represent(False), shape).withColumn("seg", F.pmod(F.xxhash64("vid"), F.lit(segments)).cast("int"))
    index = index.withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    wanted = source.join(asked.select(F.col("qvid").alias("vid")).distinct(), "vid", "left_semi").mapInArrow(represent(True), shape)
    wanted = wanted.withColumn("blk", F.pmod(F.xxhash64("vid", F.lit(1)), F.lit(blocks)).cast("int")).withColumn("seg", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"qvid": pd.Series(dtype="int64"), "vid": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        return _search_cell(left, right, k + 1, len(held.value), part)

    found = index.groupBy("seg", "blk").cogroup(wanted.groupBy("seg", "blk")).applyInPandas(cell, "qvid long, vid long, score double")
    nearest = Window.partitionBy("qvid").orderBy(F.desc("score"), "vid")
    found = found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1).select("qvid", "vid", "score")
    # for each distinct query vector: its k + 1 nearest rows, the query's own among them, then each query without itself
    spread = found.join(distinct.select("vid", "ids"), "vid").select("qvid", "score", F.explode("ids").alias("id"))
    spread = spread.withColumn("n", F.row_number().over(Window.partitionBy("qvid").orderBy(F.desc("score"), "id"))).where(F.col("n") <= k + 1)
    lists = spread.groupBy("qvid").agg(F.array_sort(F.collect_list(F.struct("n", "id", "score"))).alias("near"))
    hot = hot_keys(asked.groupBy("qvid").agg(F.count(F.lit(1)).alias("n")), "qvid", asked.count())
    joined = salted_join(asked, lists, "qvid", hot, "query_id", "inner")
    near = F.slice(F.filter("near", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = joined.select("query_id", F.posexplode(near).alias("place", "hit"))
    return out.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"), F.col("hit.score").alias("score"))


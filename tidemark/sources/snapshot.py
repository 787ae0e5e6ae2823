"""Snapshot scans, batches and loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.frames import TARGET, source, table, target
from tidemark.shared import numbered
from tidemark.sources.cuts import cut

SEGMENT_DOCS, BATCH_DOCS, BATCH_BYTES = 10_000, 1000, 16 << 20


def segment_plan(rows: DataFrame, key: str, size: int = SEGMENT_DOCS) -> DataFrame:
    """Half-open key ranges (min, max] with ``size + 1`` rows each; the first is open below, the last open above, and the last is
    empty if the rows divide evenly."""
    ranked = numbered(rows.select(key), key)
    whole = F.floor((F.col("rn") - 1) / (size + 1))
    found = ranked.groupBy(whole.alias("segment")).agg(F.count(F.lit(1)).alias("n"), F.max(key).alias("max_key"))
    # from here on there is a row for each segment, not for each document
    empty = found.agg(F.max("segment").alias("s"), F.max_by("n", "segment").alias("n")).where(F.coalesce("n", F.lit(size + 1)) == size + 1)
    trailing = empty.select(F.coalesce(F.col("s") + 1, F.lit(0)).alias("segment"), F.lit(0).cast("long").alias("n"), F.lit(None).alias("max_key"))
    every = found.union(trailing.select("segment", "n", F.col("max_key").cast(dict(found.dtypes)["max_key"])))
    bounds = Window.orderBy("segment")
    last = F.lead("segment").over(bounds).isNull()
    return every.select("segment", F.lag("max_key").over(bounds).alias("min_key"), F.when(~last, F.col("max_key")).alias("max_key"), "n")


def scan_segments(rows: DataFrame, key: str, size: int = SEGMENT_DOCS) -> DataFrame:
    """All rows with the number of their segment of :func:`segment_plan`. Keys are distinct, as ids are."""
    return numbered(rows, key).withColumn("segment", F.floor((F.col("rn") - 1) / (size + 1))).drop("rn")


def pack_by_count(rows: DataFrame, key: str, size: str, n: int = BATCH_DOCS) -> DataFrame:
    """Batches of ``n`` rows in key order: first and last key, rows and bytes."""
    ranked = numbered(rows.select(key, F.expr(size).cast("long").alias("bytes")), key)
    return ranked.groupBy(F.floor((F.col("rn") - 1) / n).alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.sum("bytes").alias("bytes"))


def pack_by_bytes(rows: DataFrame, key: str, size: str, n: int = BATCH_DOCS, most: int = BATCH_BYTES) -> DataFrame:
    """Batches of a sorted scan that end with the row that reaches ``n`` rows or ``most`` bytes; see :mod:`tidemark.sources.cuts`."""
    return cut(rows, [key], F.expr(size), n, most)


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``old`` with every key of ``new`` replaced; all copies of a replaced key go."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def segment_plan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_plan(source(spark, sf_dir), "o_orderkey", 999)


def range_scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every segment of a collection: all its rows with the segment that reads them."""
    return scan_segments(source(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey", 999)


def linear_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key"))


def batch_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_count(table(spark, sf_dir, "documents"), "doc_id", "n_chars", 64)


def batch_pack_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_by_bytes(table(spark, sf_dir, "documents"), "doc_id", "n_chars", 64, 1 << 17)


def snapshot_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = upsert(target(spark, sf_dir), source(spark, sf_dir), "o_orderkey")
    return loaded.select("o_orderkey", "o_totalprice", "o_orderpriority")


def copy_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = source(spark, sf_dir), target(spark, sf_dir)
    counts = s.select(F.lit(1).alias("s"), F.lit(0).alias("t")).union(t.select(F.lit(0), F.lit(1))).agg(F.sum("s").alias("source_docs"), F.sum("t").alias("target_docs"))
    return counts.withColumn("missing", F.col("source_docs") - F.col("target_docs")).withColumn("matches", F.col("source_docs") == F.col("target_docs"))


QUERIES = {
    "segment_plan": segment_plan_query, "range_scan": range_scan_query, "linear_scan": linear_scan, "batch_pack": batch_pack, "batch_pack_bytes": batch_pack_bytes,
    "snapshot_upsert": snapshot_upsert, "copy_reconcile": copy_reconcile,
}
SQL = {
    "segment_plan": """WITH r AS (SELECT o_orderkey AS k, row_number() OVER (ORDER BY o_orderkey) AS rn FROM orders), n AS (SELECT count(*) // 1000 AS whole, count(*) AS n FROM orders)
        SELECT s AS segment, (SELECT k FROM r WHERE rn = s * 1000) AS min_key, (SELECT k FROM r WHERE rn = (s + 1) * 1000 AND s < whole) AS max_key, CASE WHEN s < whole THEN 1000 ELSE n - whole * 1000 END AS n FROM n, unnest(range(0, whole + 1)) AS g(s)""",
    "range_scan": "SELECT o_orderkey, o_custkey, o_totalprice, (row_number() OVER (ORDER BY o_orderkey) - 1) // 1000 AS segment FROM orders",
    "linear_scan": "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity, min(l_orderkey) AS first_key, max(l_orderkey) AS last_key FROM lineitem GROUP BY ALL",
    "batch_pack": "SELECT (row_number - 1) // 64 AS batch, count(*) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key, sum(n_chars)::BIGINT AS bytes FROM (SELECT *, row_number() OVER (ORDER BY doc_id) AS row_number FROM documents) GROUP BY 1",
    "batch_pack_bytes": """WITH RECURSIVE r AS (SELECT doc_id AS k, n_chars AS b, row_number() OVER (ORDER BY doc_id) AS rn FROM documents), w AS (SELECT rn, k, b, 0::BIGINT AS batch, 1 AS c, b AS total FROM r WHERE rn = 1
        UNION ALL SELECT r.rn, r.k, r.b, CASE WHEN c >= 64 OR total >= 131072 THEN batch + 1 ELSE batch END, CASE WHEN c >= 64 OR total >= 131072 THEN 1 ELSE c + 1 END, CASE WHEN c >= 64 OR total >= 131072 THEN r.b ELSE total + r.b END FROM w JOIN r ON r.rn = w.rn + 1)
        SELECT batch, count(*) AS n, min(k) AS first_key, max(k) AS last_key, sum(b)::BIGINT AS bytes FROM w GROUP BY batch""",
    "snapshot_upsert": f"WITH {TARGET} SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders UNION ALL SELECT o_orderkey, o_totalprice, o_orderpriority FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "copy_reconcile": f"WITH {TARGET}, n AS (SELECT (SELECT count(*) FROM orders) AS source_docs, (SELECT count(*) FROM tgt) AS target_docs) SELECT *, source_docs - target_docs AS missing, source_docs = target_docs AS matches FROM n",
}

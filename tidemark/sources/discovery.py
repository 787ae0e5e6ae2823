"""Catalog discovery, scan safety and stream start."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import CHANGES, EXCLUDED_DBS, changes, cte, frame, table
from tidemark.functions.keys import namespace

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
#: Collections with fewer documents than this are safe to scan by range whatever their ids are.
SMALL = 10


def collections(catalog: DataFrame, excluded_ns: DataFrame, excluded_dbs: tuple[str, ...] = EXCLUDED_DBS) -> DataFrame:
    """The rows of ``catalog`` (db, coll, ...) that take part, with ns."""
    rows = catalog.where(~F.col("db").isin(*excluded_dbs) & ~F.col("coll").rlike(r"^system\.") & ~((F.col("db") == "local") & (F.col("coll") == "oplog.rs")))
    return rows.withColumn("ns", namespace(F.col("db"), F.col("coll"))).join(excluded_ns, "ns", "left_anti")


def range_safety(ids: DataFrame) -> DataFrame:
    """From (ns, id_type): whether each collection has ids of one type, or is small. Every row counts, nothing is sampled."""
    rows = ids.groupBy("ns").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id_type").alias("n_types"))
    return rows.withColumn("safe", (F.col("n") < SMALL) | (F.col("n_types") == 1))


def probe(ids: DataFrame, key: str, kind: Column, least: int = 1000) -> DataFrame:
    """A bounded look at a collection's ids of any type: types (``kind``) among the first, the last and a random ``least`` rows by key. The sample is the
    rows of the smallest hashes, so it is the same on every run; each part is a top-k, not a sort. Null ids come first."""
    rows = ids.select(F.col(key).alias("key"), kind.alias("kind"), F.md5(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")).alias("hash"))
    ends = {"head": F.col("key").asc(), "tail": F.col("key").desc(), "sample": F.col("hash").asc()}
    parts = [rows.orderBy(order, "key", "kind").limit(least).select(F.lit(name).alias("part"), "key", "kind") for name, order in ends.items()]
    seen = parts[0].union(parts[1]).union(parts[2])
    out = seen.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("kind").alias("n_types"), F.min_by("kind", "key").alias("first_type"))
    whole = seen.agg(F.countDistinct("kind").alias("types"), F.count_if(F.col("part") == "head").alias("few"))
    return out.crossJoin(F.broadcast(whole.select(((F.col("few") < SMALL) | (F.col("types") == 1)).alias("safe"))))


def from_footers(spark: SparkSession, path: str) -> DataFrame:
    """The table under ``path`` so that its counts and the least and greatest values of number columns come from the files' footers: Spark's second
    Parquet source answers such aggregates without a row, which shows as PushedAggregation."""
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    name = "spark.sql.sources.useV1SourceList"
    held = spark.conf.get(name)
    spark.conf.set(name, ",".join(x for x in held.split(",") if x != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(name, held)


def storage(spark: SparkSession, path: str) -> DataFrame:
    """Files and bytes under ``path``, from the listing alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "length")
    return files.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


def catalog_totals(rows: DataFrame) -> DataFrame:
    """Documents and bytes of all collections that take part."""
    return rows.agg(F.count(F.lit(1)).alias("collections"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("size"))


def scan_strategy(catalog: DataFrame, safety: DataFrame) -> DataFrame:
    """linear without an index on the id or with mixed ids, else range."""
    rows = catalog.join(safety.select("ns", "safe"), "ns", "left")
    return rows.select("ns", F.when(F.col("has_id_index") & F.coalesce("safe", F.lit(True)), "range").otherwise("linear").alias("strategy"))


def cluster_time(log: DataFrame) -> DataFrame:
    """The last (t, i) of a change log; no row for an empty log."""
    return log.agg(F.max(F.struct("t", "i")).alias("m")).where("m IS NOT NULL").select("m.t", "m.i")


def stream_labels(streams: DataFrame) -> DataFrame:
    label = F.when((F.col("db") == "") & (F.col("coll") == ""), "CLUSTER_WIDE").when(F.col("coll") == "", F.concat("db", F.lit(".*"))).otherwise(namespace(F.col("db"), F.col("coll")))
    whole = F.broadcast(streams.agg(F.bool_or((F.col("db") == "") & (F.col("coll") == "")).alias("cluster_wide")))
    return streams.select(label.alias("label")).crossJoin(whole)


def shard_keys(namespaces: DataFrame, rules: DataFrame, sharded: DataFrame) -> DataFrame:
    """The key of each namespace: of its first rule, else of the catalog's entry that is not dropped."""
    first = rules.groupBy("ns").agg(F.min_by("shard_key", "rule_no").alias("rule_key"))
    live = sharded.where(~F.col("dropped")).select("ns", F.col("shard_key").alias("catalog_key"))
    return namespaces.join(first, "ns", "left").join(live, "ns", "left").select("ns", F.coalesce("rule_key", "catalog_key").alias("shard_key"))


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.lit("shop.orders").alias("ns"), F.lit("long").alias("id_type"))
    return orders.union(frame(spark, "mixed_ids", sf_dir))


def discover_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collections(frame(spark, "catalog", sf_dir), frame(spark, "excluded_ns", sf_dir)).select("ns", "db", "coll")


def collection_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, and the least and greatest value of the first column, of every table, from the files' footers."""
    parts = []
    for name in TABLES:
        rows = from_footers(spark, f"{sf_dir}/{name}.parquet")
        key = F.col(rows.columns[0])
        ends = rows.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("least"), F.max(key).alias("greatest"))
        parts.append(ends.select(F.lit(name).alias("coll"), "n", *(F.col(c).cast("long").alias(f"{c}_key") for c in ("least", "greatest"))))
    return reduce(DataFrame.union, parts)


def collection_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files, bytes and bytes a row of every table; no row is read."""
    parts = []
    for name in TABLES:
        n = from_footers(spark, f"{sf_dir}/{name}.parquet").agg(F.count(F.lit(1)).alias("n"))
        parts.append(storage(spark, f"{sf_dir}/{name}.parquet").crossJoin(F.broadcast(n)).select(F.lit(name).alias("coll"), "files", "bytes", "n"))
    return reduce(DataFrame.union, parts).withColumn("bytes_a_row", F.when(F.col("n") > 0, F.floor(F.col("bytes") / F.col("n")).cast("long")))


def range_safety_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return range_safety(_mixed(spark, sf_dir))


def scan_strategy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = collections(frame(spark, "catalog", sf_dir), frame(spark, "excluded_ns", sf_dir))
    return scan_strategy(rows, range_safety(_mixed(spark, sf_dir)))


def range_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders")
    return probe(rows, "o_orderkey", F.when(F.col("o_orderkey") % 701 == 7, "string").otherwise("long"))


def catalog_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_totals(collections(frame(spark, "catalog", sf_dir), frame(spark, "excluded_ns", sf_dir)))


def cluster_time_t0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_time(changes(spark, sf_dir))


def stream_enabled_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stream_labels(frame(spark, "streams", sf_dir))


def shard_key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules, sharded = frame(spark, "rules", sf_dir), frame(spark, "sharded", sf_dir)
    return shard_keys(rules.select("ns").union(sharded.select("ns")).distinct(), rules, sharded)


QUERIES = {
    "discover_tables": discover_tables, "collection_info": collection_info, "collection_storage": collection_storage, "range_probe": range_probe, "catalog_sums": catalog_sums, "range_safety": range_safety_query, "scan_strategy": scan_strategy_query,
    "cluster_time_t0": cluster_time_t0, "stream_enabled_check": stream_enabled_check, "shard_key_lookup": shard_key_lookup,
}
_KEYS = ("r_regionkey", "n_nationkey", "c_custkey", "s_suppkey", "p_partkey", "o_orderkey", "l_orderkey", "event_id", "doc_id", "vec_id", "page_id", "item_id", "doc_id", "conv_id")
_COLLECTIONS = """c AS (SELECT db || '.' || coll AS ns, * FROM catalog WHERE db NOT IN ('admin', 'local', 'config') AND NOT starts_with(coll, 'system.') AND db || '.' || coll NOT IN (SELECT ns FROM excluded_ns))"""
_SAFETY = """s AS (SELECT ns, count(*) AS n, count(DISTINCT id_type) AS n_types, count(*) < 10 OR count(DISTINCT id_type) = 1 AS safe FROM (SELECT 'shop.orders' AS ns, 'long' AS id_type FROM orders UNION ALL SELECT * FROM mixed_ids) GROUP BY ns)"""
SQL = {
    "discover_tables": cte("catalog", "excluded_ns") + f", {_COLLECTIONS} SELECT ns, db, coll FROM c",
    "collection_info": " UNION ALL ".join(f"SELECT '{t}' AS coll, count(*) AS n, min({k})::BIGINT AS least_key, max({k})::BIGINT AS greatest_key FROM {t}" for t, k in zip(TABLES, _KEYS, strict=True)),
    "catalog_sums": cte("catalog", "excluded_ns") + f", {_COLLECTIONS} SELECT count(*) AS collections, sum(n)::BIGINT AS n, sum(size)::BIGINT AS size FROM c",
    "range_probe": """WITH r AS (SELECT o_orderkey AS key, CASE WHEN o_orderkey % 701 = 7 THEN 'string' ELSE 'long' END AS kind FROM orders), s AS ((SELECT 'head' AS part, * FROM r ORDER BY key LIMIT 1000) UNION ALL (SELECT 'tail', * FROM r ORDER BY key DESC LIMIT 1000)
        UNION ALL (SELECT 'sample', * FROM r ORDER BY md5(key::VARCHAR), key LIMIT 1000)) SELECT part, count(*) AS n, count(DISTINCT kind) AS n_types, arg_min(kind, key) AS first_type, (SELECT count(DISTINCT kind) = 1 OR count(*) FILTER (part = 'head') < 10 FROM s) AS safe FROM s GROUP BY part""",
    "range_safety": cte("mixed_ids") + f", {_SAFETY} SELECT * FROM s",
    "scan_strategy": cte("catalog", "excluded_ns", "mixed_ids") + f", {_COLLECTIONS}, {_SAFETY} SELECT c.ns, CASE WHEN has_id_index AND coalesce(safe, true) THEN 'range' ELSE 'linear' END AS strategy FROM c LEFT JOIN s ON c.ns = s.ns",
    "cluster_time_t0": "WITH " + CHANGES + " SELECT t, i FROM changes ORDER BY t DESC, i DESC LIMIT 1",
    "stream_enabled_check": cte("streams") + "SELECT CASE WHEN db = '' AND coll = '' THEN 'CLUSTER_WIDE' WHEN coll = '' THEN db || '.*' ELSE db || '.' || coll END AS label, (SELECT bool_or(db = '' AND coll = '') FROM streams) AS cluster_wide FROM streams",
    "shard_key_lookup": cte("rules", "sharded") + """SELECT n.ns, coalesce((SELECT shard_key FROM rules r WHERE r.ns = n.ns ORDER BY rule_no LIMIT 1), (SELECT shard_key FROM sharded s WHERE s.ns = n.ns AND NOT dropped)) AS shard_key FROM (SELECT ns FROM rules UNION SELECT ns FROM sharded) n""",
}

"""Index metadata and plans on whole databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.frames import EXCLUDED_DBS, cte, frame
from tidemark.functions.keys import key_parts
from tidemark.sources.discovery import shard_keys


def copied_indexes(indexes: DataFrame) -> DataFrame:
    """Indexes that are carried over: not the one on the id, none without keys, none that are partial or on text."""
    text = F.exists(key_parts(F.col("key")), lambda p: p["direction"] == "text") | F.col("key").rlike(r":\s*text\s*(,|$)")
    return indexes.where((F.col("name") != "_id_") & (F.length("key") > 0) & ~F.col("partial") & ~text)


def missing_indexes(src: DataFrame, tgt: DataFrame, finalize: bool) -> DataFrame:
    """Indexes to build: their ordered keys or their expiry are not on the target yet. Those that expire documents only at the end."""
    wanted = copied_indexes(src) if finalize else copied_indexes(src).where("ttl IS NULL")
    there = tgt.select("ns", "key", F.coalesce("ttl", F.lit(-1)).alias("at"))
    return wanted.withColumn("at", F.coalesce("ttl", F.lit(-1))).join(there, ["ns", "key", "at"], "left_anti").drop("at")


def index_phases(indexes: DataFrame, shard_keys: DataFrame, preload: bool) -> DataFrame:
    """When each copied index is built: before the copy with ``preload``, else after it; the index on the fields of the partition key is
    always there first. Indexes that expire documents wait for the end."""
    fields = lambda c: F.array_join(F.transform(key_parts(F.col(c)), lambda p: p["field"]), ",")
    keys = shard_keys.select("ns", fields("shard_key").alias("_key"))
    rows = copied_indexes(indexes).join(keys, "ns", "left").withColumn("_own", fields("key").eqNullSafe(F.col("_key")))
    phase = F.when(F.col("_own"), "before").when(F.col("ttl").isNotNull(), "end").otherwise("before" if preload else "after")
    return rows.select("ns", "name", phase.alias("phase"))


def index_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = shard_keys(frame(spark, "rules", sf_dir).select("ns").distinct(), frame(spark, "rules", sf_dir), frame(spark, "sharded", sf_dir))
    both = [index_phases(frame(spark, "indexes_src", sf_dir), keys, flag).withColumn("preload", F.lit(flag)) for flag in (True, False)]
    return both[0].union(both[1])


def index_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copied_indexes(frame(spark, "indexes_src", sf_dir)).select("ns", "name", "key")


def index_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    src, tgt = frame(spark, "indexes_src", sf_dir), frame(spark, "indexes_tgt", sf_dir)
    both = [missing_indexes(src, tgt, last).select("ns", "name", "key", "is_unique", "ttl", F.lit(last).alias("finalize")) for last in (False, True)]
    return both[0].union(both[1])


def index_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections with an index to build, numbered, with the number of them all."""
    rows = copied_indexes(frame(spark, "indexes_src", sf_dir)).groupBy("ns").agg(F.count(F.lit(1)).alias("n_indexes"))
    total = F.broadcast(rows.agg(F.count(F.lit(1)).alias("total")))
    # a row for each collection, so one window over all is small
    return rows.crossJoin(total).withColumn("place", F.row_number().over(Window.orderBy("ns"))).select("ns", "n_indexes", "place", "total")


def destroy_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target databases that would be dropped: those the source has, without excluded ones, the metadata database last."""
    src = frame(spark, "catalog", sf_dir).select("db").distinct()
    tgt = frame(spark, "target_dbs", sf_dir).where(~F.col("db").isin(*EXCLUDED_DBS))
    return tgt.join(src, "db", "left_semi").select("db", F.lit(1).alias("step")).union(tgt.where("db = 'meta'").select("db", F.lit(2)))


def distinct_dbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, "catalog", sf_dir).select("db").distinct()


QUERIES = {f.__name__: f for f in (index_filter, index_timing, index_diff, index_progress, destroy_plan, distinct_dbs)}
_KEPT = "k AS (SELECT * FROM indexes_src WHERE name <> '_id_' AND length(key) > 0 AND NOT partial AND NOT contains(key, ':text'))"
_LEFT = "NOT EXISTS (SELECT 1 FROM indexes_tgt t WHERE t.ns = k.ns AND t.key = k.key AND coalesce(t.ttl, -1) = coalesce(k.ttl, -1))"
SQL = {
    "index_filter": cte("indexes_src") + f", {_KEPT} SELECT ns, name, key FROM k",
    "index_timing": cte("indexes_src", "rules") + f", {_KEPT}, own AS (SELECT ns FROM rules GROUP BY ns HAVING arg_min(shard_key, rule_no) LIKE 'o_custkey%') SELECT ns, name, CASE WHEN name = 'by_cust' AND ns IN (SELECT ns FROM own) THEN 'before' WHEN ttl IS NOT NULL THEN 'end' WHEN p THEN 'before' ELSE 'after' END AS phase, p AS preload FROM k, (VALUES (true), (false)) AS f(p)",
    "index_diff": cte("indexes_src", "indexes_tgt") + f", {_KEPT} SELECT ns, name, key, is_unique, ttl, false AS finalize FROM k WHERE ttl IS NULL AND {_LEFT} UNION ALL SELECT ns, name, key, is_unique, ttl, true FROM k WHERE {_LEFT}",
    "index_progress": cte("indexes_src") + f", {_KEPT}, g AS (SELECT ns, count(*) AS n_indexes FROM k GROUP BY ns) SELECT ns, n_indexes, row_number() OVER (ORDER BY ns)::INTEGER AS place, (SELECT count(*) FROM g) AS total FROM g",
    "destroy_plan": cte("catalog", "target_dbs") + "SELECT db, 1 AS step FROM target_dbs WHERE db NOT IN ('admin', 'local', 'config') AND db IN (SELECT db FROM catalog) UNION ALL SELECT db, 2 FROM target_dbs WHERE db = 'meta'",
    "distinct_dbs": cte("catalog") + "SELECT DISTINCT db FROM catalog",
}

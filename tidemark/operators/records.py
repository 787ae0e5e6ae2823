"""Decoding, lookups and the bookkeeping tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import cte, frame, source, table, target
from tidemark.operators.validation import COMPARED, MAX_RETRIES, compare, with_status


def decode(rows: DataFrame, text: str, schema: str) -> DataFrame:
    """``rows`` with the fields of a JSON column; rows that do not decode are dropped, as a broken event is skipped."""
    made = F.from_json(text, f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    return rows.withColumn("_event", made).where("_event IS NOT NULL AND _event._broken IS NULL").select(*rows.columns, "_event.*").drop("_broken")


def whole_number(column: str) -> Column:
    """A number of any kind in a text column as a long, cut towards 0; null if it is none."""
    return F.col(column).try_cast("double").try_cast("long")


def lookup(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """The rows whose key is in ``wanted``."""
    return rows.join(wanted.select(F.col(wanted.columns[0]).alias(key)), key, "left_semi")


def defer_hot(keys: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """What happens to keys (dirty, attempt) before a check: those with changes under way wait, and are put off after some attempts."""
    step = F.when(F.col("dirty") & (F.col("attempt") < max_retries), "wait").when(F.col("dirty"), "hot_key_waiting").otherwise("check")
    return keys.withColumn("step", step)


def save_checkpoints(old: DataFrame, new: DataFrame, final: bool) -> DataFrame:
    """Checkpoints (id, t, i) after saving ``new``: ids are replaced; once the global one is final, the anchor goes."""
    kept = old.join(new.select("id"), "id", "left_anti").unionByName(new)
    return kept.where("id <> 'migration_anchor_timestamp'") if final else kept


def audit_rows(outcomes: DataFrame, key: str, ns: str) -> DataFrame:
    """The audit entries of a validation run: a row for each repair."""
    return outcomes.where(F.col("action").isNotNull()).select(F.lit(ns).alias("ns"), F.col(key).cast("string").alias("doc_id"), "action")


def failed_batches(keys: DataFrame, batch: Column, failed: Column) -> DataFrame:
    """The failure rows of batches that could not be read: every key of such a batch."""
    return keys.withColumn("batch", batch).where(failed).withColumn("status", F.lit("batch_failed"))


def event_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 13 == 0, "{broken").otherwise(F.col("props")).alias("raw"))
    return decode(raw, "raw", "k BIGINT").select("event_id", "k")


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, "numbers", sf_dir).select("no", whole_number("txt").alias("n"))


def point_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = table(spark, sf_dir, "events").where("event_type = 'error'").select("user_id").distinct()
    return lookup(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), "c_custkey", wanted)


def hot_key_deferral(spark: SparkSession, sf_dir: str) -> DataFrame:
    return defer_hot(frame(spark, "dirty_checks", sf_dir)).select("no", "step")


def checkpoint_save(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = spark.sql("SELECT * FROM (VALUES ('cdc_resume_timestamp', 510, 1), ('crm.people', 511, 4), ('iot.live', 512, 2)) AS t(id, t, i)")
    return save_checkpoints(frame(spark, "checkpoints", sf_dir), new, True)


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = audit_rows(with_status(compare(source(spark, sf_dir), target(spark, sf_dir), "o_orderkey")), "o_orderkey", "shop.orders")
    every = frame(spark, "audit", sf_dir).select("ns", "action").unionByName(new.select("ns", "action"))
    return every.groupBy("ns", "action").agg(F.count(F.lit(1)).alias("n"))


def batch_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = source(spark, sf_dir).select("o_orderkey")
    return failed_batches(keys, F.floor(F.col("o_orderkey") / 100), F.floor(F.col("o_orderkey") / 100) % 7 == 3).groupBy("batch", "status").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {f.__name__: f for f in (event_decode, numeric_coercion, point_lookup, hot_key_deferral, checkpoint_save, audit_append, batch_failures)}
SQL = {
    "event_decode": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events WHERE event_id % 13 <> 0",
    "numeric_coercion": cte("numbers") + "SELECT no, trunc(try_cast(txt AS DOUBLE))::BIGINT AS n FROM numbers",
    "point_lookup": "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error')",
    "hot_key_deferral": cte("dirty_checks") + "SELECT no, CASE WHEN dirty AND attempt < 3 THEN 'wait' WHEN dirty THEN 'hot_key_waiting' ELSE 'check' END AS step FROM dirty_checks",
    "checkpoint_save": cte("checkpoints") + ", n AS (SELECT * FROM (VALUES ('cdc_resume_timestamp', 510, 1), ('crm.people', 511, 4), ('iot.live', 512, 2)) AS t(id, t, i)) SELECT * FROM checkpoints WHERE id NOT IN (SELECT id FROM n) AND id <> 'migration_anchor_timestamp' UNION ALL SELECT * FROM n",
    "audit_append": cte("audit") + f""", {COMPARED}, a AS (SELECT ns, action FROM audit UNION ALL SELECT 'shop.orders', CASE outcome WHEN 'ghost' THEN 'ghost_fixed' WHEN 'missing' THEN 'missing_target_fixed' WHEN 'mismatch' THEN 'content_mismatch_fixed' ELSE 'orphan_deleted' END FROM v WHERE outcome <> 'valid') SELECT ns, action, count(*) AS n FROM a GROUP BY ALL""",
    "batch_failures": "SELECT o_orderkey // 100 AS batch, 'batch_failed' AS status, count(*) AS n FROM orders WHERE (o_orderkey // 100) % 7 = 3 GROUP BY 1",
}

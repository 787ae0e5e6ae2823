"""Health decisions and progress figures. Clocks are inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.frames import cte, frame

LATENCY_MS, QUEUE, CLIENTS, FAILED_MS = 250, 50, 20, 9999


def flow_decision(samples: DataFrame, latency: int = LATENCY_MS, queue: int = QUEUE, clients: int = CLIENTS, tickets: int = 0) -> DataFrame:
    """Whether to pause, by group of node samples, and the first reason in order: latency, lag, queue, clients, tickets."""
    worst = samples.groupBy("grp").agg(
        F.max(F.when(F.col("failed"), FAILED_MS).otherwise(F.col("latency_ms"))).alias("latency"), F.bool_or("lagged").alias("lagged"), F.max("queue_total").alias("queue"), F.max("active_clients").alias("clients"), F.min("write_tickets").alias("tickets")
    )
    low = F.coalesce(F.col("tickets") <= tickets, F.lit(False)) & F.lit(tickets > 0)
    reason = F.when(F.col("latency") > latency, "latency").when(F.col("lagged"), "lagged").when(F.col("queue") > queue, "queue").when(F.col("clients") > clients, "clients").when(low, "tickets")
    return worst.select("grp", reason.isNotNull().alias("pause"), F.coalesce(reason, F.lit("")).alias("reason"), "latency", "queue", "clients")


def hosts(shards: DataFrame) -> DataFrame:
    """(id, replica_set, host) from ``set/host,host``; entries without a set are dropped."""
    parts = F.split("host", "/")
    return shards.where(F.size(parts) >= 2).select("id", parts[0].alias("replica_set"), F.explode(F.split(parts[1], ",")).alias("host"))


def queue_states(depths: DataFrame, capacity: int = 2000) -> DataFrame:
    """The state of each queue (grp) after each depth: throttled from full on until the queue is less than half full."""
    order = Window.partitionBy("grp").orderBy("step")
    mark = F.when(F.col("depth") >= capacity, "throttled").when(F.col("depth") < capacity / 2, "running")
    return depths.select("grp", "step", "depth", F.coalesce(F.last(mark, True).over(order), F.lit("running")).alias("state"))


def flow_control_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flow_decision(frame(spark, "node_samples", sf_dir), tickets=10)


def shard_hosts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosts(frame(spark, "shards", sf_dir))


def queue_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return queue_states(frame(spark, "queue_log", sf_dir))


def status_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = F.when(F.col("clone_done"), 100.0).when(F.col("total_bytes") > 0, F.col("cloned_bytes") / F.col("total_bytes") * 100).otherwise(0.0)
    sync = F.when(F.col("checked") > 0, (F.col("checked") - F.col("pending")) / F.col("checked") * 100).otherwise(0.0)
    return frame(spark, "status_rows", sf_dir).select("no", F.round(done, 6).alias("progress"), F.round(sync, 6).alias("sync_percent"))


def status_cdc_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seconds since the last change and seconds that applying lags, never below 0; times as text, empty where there is none."""
    known = F.col("source_t") > 0
    idle = F.when(known, F.greatest(F.lit(0), F.col("now_t") - F.col("source_t"))).otherwise(0)
    lag = F.when(known & (F.col("applied_t") > 0), F.greatest(F.lit(0), F.col("source_t") - F.col("applied_t"))).otherwise(0)
    text = lambda c: F.when(F.col(c) > 0, F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise("")
    return frame(spark, "status_rows", sf_dir).select("no", idle.cast("long").alias("idle_s"), lag.cast("long").alias("lag_s"), text("source_t").alias("last_source"), text("applied_t").alias("last_applied"))


def oplog_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, bytes and rates of each kind of write; empty batches do not count."""
    rows = frame(spark, "oplog", sf_dir).where("docs > 0").groupBy("kind").agg(F.count(F.lit(1)).alias("batches"), F.sum("docs").cast("long").alias("docs"), F.sum("byte_size").cast("long").alias("bytes"), F.sum(F.round(F.col("elapsed_s") * 10000).cast("long")).alias("ticks"))
    return rows.select("kind", "batches", "docs", "bytes", F.floor(F.col("docs") * 10000 / F.col("ticks")).cast("long").alias("docs_per_s"))


QUERIES = {f.__name__: f for f in (flow_control_decision, shard_hosts, queue_state, status_progress, status_cdc_lag, oplog_throughput)}
SQL = {
    "flow_control_decision": cte("node_samples") + """, w AS (SELECT grp, max(CASE WHEN failed THEN 9999 ELSE latency_ms END) AS latency, bool_or(lagged) AS lagged, max(queue_total) AS queue, max(active_clients) AS clients, min(write_tickets) AS tickets FROM node_samples GROUP BY grp),
        r AS (SELECT *, CASE WHEN latency > 250 THEN 'latency' WHEN lagged THEN 'lagged' WHEN queue > 50 THEN 'queue' WHEN clients > 20 THEN 'clients' WHEN tickets <= 10 THEN 'tickets' ELSE '' END AS reason FROM w) SELECT grp, reason <> '' AS pause, reason, latency, queue, clients FROM r""",
    "shard_hosts": cte("shards") + "SELECT id, split_part(host, '/', 1) AS replica_set, unnest(string_split(split_part(host, '/', 2), ',')) AS host FROM shards WHERE contains(host, '/')",
    "queue_state": cte("queue_log") + "SELECT grp, step, depth, coalesce(last_value(CASE WHEN depth >= 2000 THEN 'throttled' WHEN depth < 1000 THEN 'running' END IGNORE NULLS) OVER (PARTITION BY grp ORDER BY step), 'running') AS state FROM queue_log",
    "status_progress": cte("status_rows") + "SELECT no, round(CASE WHEN clone_done THEN 100.0 WHEN total_bytes > 0 THEN cloned_bytes / total_bytes::DOUBLE * 100 ELSE 0.0 END, 6) AS progress, round(CASE WHEN checked > 0 THEN (checked - pending) / checked::DOUBLE * 100 ELSE 0.0 END, 6) AS sync_percent FROM status_rows",
    "status_cdc_lag": cte("status_rows") + """SELECT no, CASE WHEN source_t > 0 THEN greatest(0, now_t - source_t) ELSE 0 END::BIGINT AS idle_s, CASE WHEN source_t > 0 AND applied_t > 0 THEN greatest(0, source_t - applied_t) ELSE 0 END::BIGINT AS lag_s,
        CASE WHEN source_t > 0 THEN strftime(make_timestamp(source_t::BIGINT * 1000000), '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS last_source, CASE WHEN applied_t > 0 THEN strftime(make_timestamp(applied_t::BIGINT * 1000000), '%Y-%m-%dT%H:%M:%SZ') ELSE '' END AS last_applied FROM status_rows""",
    "oplog_throughput": cte("oplog") + "SELECT kind, count(*) AS batches, sum(docs)::BIGINT AS docs, sum(byte_size)::BIGINT AS bytes, (sum(docs) * 10000 // sum(round(elapsed_s * 10000)::BIGINT))::BIGINT AS docs_per_s FROM oplog WHERE docs > 0 GROUP BY kind",
}

"""A change log applied as a stream.

The state is the compacted log (see :func:`tidemark.operators.replay.compact`), dealt by document id over the buckets of a table (see
:mod:`tidemark.tables`); a micro-batch rewrites the buckets it touches and commits them with its number, so a job that is started again goes on
where it was. Reading the state is folding the buckets.

Schema events act on what has arrived in their own or earlier batches.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import CHANGES, changes, fields_of
from tidemark.frames import change_log as as_log
from tidemark.operators.cdc import FOLD
from tidemark.operators.replay import SCHEMA_OPS, compact, existing, fold, kind_of
from tidemark.shared import Folder, shared_dir
from tidemark.sources import change_log
from tidemark.tables import Buckets

BUCKETS = 64


def stream_changes(events: DataFrame) -> DataFrame:
    """The change log of a stream of events. Within a second changes follow in the order of their ids, which needs no look at other rows."""
    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "purchase", "replace").when(F.col("event_type") == "error", "delete").otherwise("update")
    ns = F.concat(F.lit("shop.c"), (F.col("user_id") % 5).cast("string"))
    rows = events.select("event_id", F.col("user_id").alias("doc_id"), op.alias("op"), "event_type", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("t"), F.col("event_id").alias("i"), "value", "props", ns.alias("ns"))
    return as_log(rows)


FEED = "ns string, inserted long, matched long, deleted long, inserts long, updates long, deletes long"


def effects(before: DataFrame | None, after: DataFrame | None, batch: DataFrame) -> DataFrame:
    """What a batch did to each namespace between two versions of the state: documents inserted, matched (written, there before and after) and deleted,
    and the batch's events by kind (replacements are updates). A rename deletes documents here and inserts them there; a change that was already
    applied or comes to nothing is an event without an effect."""
    none = F.lit(None).cast("boolean")
    flags = lambda df, **on: df.select("ns", "doc_id", *(on.get(f, none).alias(f) for f in ("was", "now", "met")))
    yes, writes = F.lit(True), batch.where(kind_of().isin("base", "patch", "delete"))
    rows = flags(writes, met=yes)
    for state, name in ((before, "was"), (after, "now")):
        if state is not None:
            rows = rows.unionByName(flags(existing(state), **{name: yes}))
    keys = rows.groupBy("ns", "doc_id").agg(*(F.coalesce(F.max(f), F.lit(False)).alias(f) for f in ("was", "now", "met")))
    done = keys.groupBy("ns").agg(F.count_if(F.expr("now AND NOT was")).alias("inserted"), F.count_if(F.expr("now AND was AND met")).alias("matched"), F.count_if(F.expr("was AND NOT now")).alias("deleted"))
    kinds = batch.groupBy("ns").agg(F.count_if(F.col("op") == "insert").alias("inserts"), F.count_if(F.col("op").isin("update", "replace")).alias("updates"), F.count_if(F.col("op") == "delete").alias("deletes"))
    both = done.withColumnRenamed("ns", "_ns").join(kinds, F.col("_ns").eqNullSafe(F.col("ns")), "full_outer")
    out = both.select(F.coalesce("_ns", "ns").alias("ns"), *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("inserted", "matched", "deleted", "inserts", "updates", "deletes")))
    return out.where("inserted + matched + deleted + inserts + updates + deletes > 0")


class StateTable(Buckets):
    """A compacted log in buckets by document id."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        super().__init__(spark, path, buckets, ("doc_id",))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        if self.version is not None and batch_id <= self.version:
            return  # a batch that was already applied
        everywhere = not batch.where(F.col("op").isin(*SCHEMA_OPS)).isEmpty()
        touched = set(range(self.buckets)) if everywhere else self.touched(batch)
        state = self.read(touched)
        log = batch if state is None else state.unionByName(batch)
        made = self.write(compact(log), batch_id)
        after = self.spark.read.schema(log.schema).parquet(f"{self.path}/v{batch_id}") if made else None
        effects(state, after, batch).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/feed/{batch_id}")
        self.commit(batch_id, touched, made)

    def feed(self) -> DataFrame:
        """What each applied batch did to each namespace; see :func:`effects`. A batch that was lost before its commit is not part of it."""
        done = [int(name) for name in Folder(self.spark, f"{self.path}/feed").names() if name.isdigit() and self.version is not None and int(name) <= self.version]
        if not done:
            return self.spark.createDataFrame([], f"batch long, {FEED}")
        rows = self.spark.read.schema(FEED).parquet(*(f"{self.path}/feed/{n}" for n in sorted(done)))
        return rows.select(F.regexp_extract(F.col("_metadata.file_path"), r"/feed/(\d+)/", 1).cast("long").alias("batch"), "*")


def apply_stream(log: DataFrame, state: StateTable, checkpoint: str, start: tuple[int, int] | None = None) -> None:
    """Applies all that is available of a streaming change log; offsets are kept in ``checkpoint``. With ``start`` (t, i), changes before that
    place are passed over."""
    if start is not None:
        log = log.where((F.col("t") > start[0]) | ((F.col("t") == start[0]) & (F.col("i") >= start[1])))
    query = log.writeStream.foreachBatch(lambda df, n: state.apply(df, n)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def apply_log(path: str, state: StateTable, checkpoint: str, start: tuple[int, int] | None = None, batch_changes: int = 10_000) -> None:
    """Applies the change log under ``path`` up to its end, ``batch_changes`` at a time, from ``start`` on or after what ``checkpoint`` holds."""
    log = change_log.stream(state.spark, path, checkpoint, start, batch_changes)
    query = log.writeStream.foreachBatch(lambda df, n: state.apply(df, n)).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def documents(state: StateTable) -> DataFrame:
    """The documents of a state; none where nothing was applied."""
    log = state.read()
    if log is None:
        return state.spark.createDataFrame([], "ns string, doc_id long, doc map<string,string>")
    return fold(log)


def cdc_stream_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).option("maxFilesPerTrigger", 4).parquet(f"{sf_dir}/events*.parquet")
    top = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    state = StateTable(spark, f"{top}/state", 8)
    apply_stream(stream_changes(events), state, f"{top}/offsets")
    return fields_of(documents(state)).select("doc_id", "value", "props")


def cdc_stream_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of six batches of the whole log, read from the change source, did to each namespace."""
    log = as_log(changes(spark, sf_dir))
    top = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    log.repartitionByRange("t", "i").sortWithinPartitions("t", "i", "event_id").write.parquet(f"{top}/log")
    state = StateTable(spark, f"{top}/state", 8)
    apply_log(f"{top}/log", state, f"{top}/offsets", batch_changes=-(-spark.read.parquet(f"{top}/log").count() // 6))
    return state.feed()


def event_counts_by_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes by ten-minute window and kind; the same expression serves a stream with a watermark."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return windowed_counts(events).select(F.unix_timestamp(F.col("window.start").cast("timestamp")).alias("start_t"), "event_type", "n")


def windowed_counts(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if events.isStreaming else rows
    return rows.groupBy(F.window("ts", "10 minutes"), "event_type").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {"cdc_stream_final_state": cdc_stream_final_state, "cdc_stream_effects": cdc_stream_effects, "event_counts_by_window": event_counts_by_window}
_EFFECTS = f"""WITH {CHANGES}, o AS (SELECT *, row_number() OVER (ORDER BY t, i, event_id) AS rn, count(*) OVER () AS n FROM changes), b AS (SELECT *, (rn - 1) // ((n + 5) // 6) AS batch FROM o),
        k AS (SELECT ns, doc_id, batch, arg_max(op IN ('insert', 'replace'), rn) FILTER (op <> 'update') AS last FROM b GROUP BY ALL),
        s AS (SELECT ns, doc_id, batch, coalesce(last_value(last IGNORE NULLS) OVER (PARTITION BY ns, doc_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS now,
        coalesce(last_value(last IGNORE NULLS) OVER (PARTITION BY ns, doc_id ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS was FROM k),
        d AS (SELECT batch, ns, count(*) FILTER (now AND NOT was) AS inserted, count(*) FILTER (now AND was) AS matched, count(*) FILTER (was AND NOT now) AS deleted FROM s GROUP BY ALL),
        e AS (SELECT batch, ns, count(*) FILTER (op = 'insert') AS inserts, count(*) FILTER (op IN ('update', 'replace')) AS updates, count(*) FILTER (op = 'delete') AS deletes FROM b GROUP BY ALL) SELECT * FROM d JOIN e USING (batch, ns)"""
SQL = {
    "cdc_stream_effects": _EFFECTS,
    "cdc_stream_final_state": FOLD,
    "event_counts_by_window": "SELECT ((floor(epoch(ts))::BIGINT // 600) * 600)::BIGINT AS start_t, event_type, count(*) AS n FROM events GROUP BY ALL",
}

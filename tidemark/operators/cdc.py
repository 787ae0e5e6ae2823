"""What a change log becomes: translation to writes, key rewrites, lookups, batches and progress. The replay itself is in
:mod:`tidemark.operators.replay`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import CHANGES, change_log, changes, cte, fields_of, frame, table
from tidemark.functions.keys import SQL as KEYS_SQL
from tidemark.functions.keys import collection_of, database_of, error_class, worker_of
from tidemark.operators import replay
from tidemark.shared import numbered, value_at
from tidemark.sources.cuts import cut

DDL = ("drop", "rename", "create", "dropDatabase", "createIndexes", "dropIndexes")


def translate(log: DataFrame) -> DataFrame:
    """The write that each change of a log (see :mod:`tidemark.operators.replay`) becomes: action, upsert, the fields it sets and unsets.
    Changes without a write are dropped."""
    kind = replay.kind_of()
    names = lambda c: F.array_join(F.map_keys(F.coalesce(c, F.create_map().cast("map<string,string>"))), ",")
    action = F.when(kind == "base", "replace").when(kind == "delete", "delete").when(kind == "patch", "update")
    sets = F.when(kind == "base", names("full")).when(kind == "patch", names("sets")).otherwise("")
    unsets = F.when(kind == "patch", F.array_join(F.coalesce("unsets", F.array().cast("array<string>")), ",")).otherwise("")
    return log.select("event_id", "doc_id", action.alias("action"), (action == "replace").alias("upsert"), sets.alias("sets"), unsets.alias("unsets")).where("action IS NOT NULL")


def split_key_changes(log: DataFrame, touches: Column, has_document: Column) -> DataFrame:
    """An update that touches the partition key and carries its document becomes a delete under the old key and an insert under the new
    one, counted as one change; other changes stay one write."""
    split = (F.col("op") == "update") & touches & has_document
    old = F.struct(F.lit(1).alias("part"), F.lit("delete").alias("action"), F.col("old_key").alias("part_key"))
    new = F.struct(F.lit(2).alias("part"), F.lit("insert").alias("action"), F.col("new_key").alias("part_key"))
    same = F.struct(F.lit(1).alias("part"), F.col("op").alias("action"), F.col("old_key").alias("part_key"))
    return log.withColumn("w", F.explode(F.when(split, F.array(old, new)).otherwise(F.array(same)))).select("event_id", "w.part", "w.action", "w.part_key", split.alias("split"))


def hydrate(log: DataFrame, target: DataFrame, key: str, part_key: str) -> DataFrame:
    """Updates, replacements and deletions with the partition key of their document in the target, so that each goes to one partition.
    The join is by key; whether a side is small enough to be broadcast is left to the planner."""
    wanted = log.where(F.col("op").isin("update", "replace", "delete"))
    found = target.select(F.col(key).alias("doc_id"), F.col(part_key).alias("part_key"), F.lit(True).alias("found"))
    return wanted.join(found, "doc_id", "left").select("event_id", "doc_id", "op", F.coalesce("found", F.lit(False)).alias("found"), "part_key")


def fallback(hydrated: DataFrame, update_left: Column, upsert: Column) -> DataFrame:
    """What becomes of changes whose document is not in the target: deletions go everywhere, updates too unless nothing is left of them,
    replacements become inserts if they may create the document and are dropped otherwise. Where the lookup itself failed (``found`` is null)
    nothing is known of the document, so the change stays what it is."""
    op = F.col("op")
    action = F.when(F.col("found").isNull(), op).when(F.col("found"), F.concat(op, F.lit("_one"))).when(op == "delete", "delete_many").when((op == "update") & update_left, "update_many").when((op == "replace") & upsert, "insert").otherwise("skip")
    return hydrated.withColumn("action", action)


def when_keys_unknown(models: DataFrame, failed: Column) -> DataFrame:
    """Writes (action, ...) where the partition key of their namespace could not be found: deletions and updates go everywhere, replacements
    stay as they are. Where only the lookup of a document failed (``found`` is null), nothing is concluded and the write is left unchanged."""
    many = F.when(F.col("action") == "delete", "delete_many").when(F.col("action") == "update", "update_many").otherwise(F.col("action"))
    return models.withColumn("action", F.when(failed, many).otherwise(F.col("action")))


def strip_fields(updates: DataFrame, protected: DataFrame) -> DataFrame:
    """Updates (no, op, field) without fields that are a protected one or lie under it: set and unset lists; empty is what has none left."""
    under = (F.col("field") == F.col("p")) | F.startswith("field", F.concat("p", F.lit(".")))
    marked = updates.join(protected.select(F.col("field").alias("p")), under, "left_anti")
    lists = marked.groupBy("no").agg(*(F.array_join(F.array_sort(F.collect_list(F.when(F.col("op") == o, F.col("field")))), ",").alias(f"{o}s") for o in ("set", "unset")))
    return updates.select("no").distinct().join(lists, "no", "left").select("no", F.coalesce("sets", F.lit("")).alias("sets"), F.coalesce("unsets", F.lit("")).alias("unsets"), F.col("sets").isNull().alias("empty"))


def apply_ddl(rows: DataFrame, ddl: DataFrame) -> DataFrame:
    """Rows (seq, ns, ...) after the schema events (seq, op, ns, to_ns) of the same log. Each event is a barrier: it acts on what was
    written before it and on nothing later."""
    order = [F.col("seq").alias("t"), F.lit(0).alias("i"), F.lit(0).alias("event_id")]
    events = ddl.where(F.col("op").isin(*replay.SCHEMA_OPS)).select("op", "ns", "to_ns", *order)  # the others change nothing
    both = rows.withColumn("op", F.lit("insert")).select("*", *order).unionByName(events, allowMissingColumns=True)
    return replay.through_schema(both).select(*rows.columns)


def batches(log: DataFrame, size: int, workers: int = 4) -> DataFrame:
    """Micro-batches of each worker and namespace with the last place in each; a document's changes all go to one worker.

    Changes are numbered within range parts of the log and shifted by what their worker and namespace has in the parts before, so
    no task holds all changes of a worker."""
    routed = log.select(worker_of(F.col("doc_id"), workers).alias("worker"), "ns", "t", "i")
    parts = numbered(routed, "worker", "ns", "t", "i")
    first = parts.groupBy("worker", "ns").agg(F.min("rn").alias("start"))
    cut = parts.join(first, ["worker", "ns"]).withColumn("batch", F.floor((F.col("rn") - F.col("start")) / size))
    out = cut.groupBy("worker", "ns", "batch").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("t", "i")).alias("last"))
    return out.select("worker", "ns", "batch", "n", F.col("last.t").alias("last_t"), F.col("last.i").alias("last_i"))


def ticked_batches(log: DataFrame, size: int, tick_s: int, workers: int = 4) -> DataFrame:
    """Micro-batches of each worker and namespace that end by ``size`` or with the tick of ``tick_s`` seconds, with the last place in each."""
    tick = F.expr(f"t div {tick_s}").alias("tick")
    routed = log.select(worker_of(F.col("doc_id"), workers).alias("worker"), "ns", tick, F.struct("t", "i").alias("place"))
    out = cut(routed, ["place"], F.lit(0), size, by=("worker", "ns", "tick"))
    return out.select("batch", "worker", "ns", "tick", "n", F.col("last_key.t").alias("last_t"), F.col("last_key.i").alias("last_i"))


def quarantine(writes_: DataFrame) -> DataFrame:
    """Splits writes into those to apply and those that no repetition can help (an update with nothing to do)."""
    bad = (F.col("action") == "update") & (F.col("sets") == "") & (F.col("unsets") == "")
    return writes_.withColumn("status", F.when(bad, "cdc_write_failed").otherwise("applied"))


def one_by_one(writes_: DataFrame, max_retries: int = 3) -> DataFrame:
    """What becomes of each write (attempts, lone, message of its error or null) of a batch that is applied one write at a time: structural
    errors are put aside, a lone duplicate key counts as done without a write, what may pass is tried again a few times."""
    kind = error_class(F.col("message"))
    again = kind.isin("retryable", "other") | ((kind == "duplicate") & ~F.col("lone"))
    outcome = F.when(F.col("message").isNull(), "applied").when((kind == "duplicate") & F.col("lone"), "applied_without_write").when(kind == "unrecoverable", "cdc_write_failed")
    return writes_.withColumn("outcome", outcome.when(kind == "fatal", "stop").when(again & (F.col("attempts") < max_retries), "retry").otherwise("stop"))


def safe_place(workers: DataFrame) -> DataFrame:
    """The place up to which everything is applied: with anything pending the least of the workers' last places, else the last received."""
    busy = F.max("pending") > 0
    out = workers.groupBy("grp").agg(F.when(busy, F.min(F.struct(F.col("last_t").alias("t"), F.col("last_i").alias("i")))).otherwise(F.min(F.struct(F.col("received_t").alias("t"), F.col("received_i").alias("i")))).alias("m"))
    return out.select("grp", "m.t", "m.i")


def resume_place(rows: DataFrame) -> DataFrame:
    """Where to start: the safe place, unless it is unset; then the anchor, the collections' checkpoint, or the configured start."""
    unset = F.col("safe_t").isin(0, 4294967295)
    pair = lambda p: F.when(F.col(f"{p}_t").isNotNull(), F.struct(F.col(f"{p}_t").cast("long").alias("t"), F.col(f"{p}_i").cast("long").alias("i")))
    return rows.select("no", F.coalesce(F.when(~unset, pair("safe")), pair("anchor"), pair("coll"), pair("start")).alias("p")).select("no", "p.t", "p.i")


def cdc_apply_final_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fields_of(replay.fold(change_log(changes(spark, sf_dir)), paths=False, schema=False, counted=True), "n_changes").select("doc_id", "value", "props", "n_changes")


def cdc_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole replay: updates without a description, updates of the partition key, renames, drops, by namespace and id."""
    log = changes(spark, sf_dir)
    return fields_of(replay.fold(change_log(log, empty=97, rekeyed=89).unionByName(schema_log(log), allowMissingColumns=True), paths=False, counted=True), "n_changes")


def nested_log(rows: DataFrame) -> DataFrame:
    """Changes of the ``events`` table as a log of documents with the fields value and props, whose updates lead into props: views set props.k; clicks by
    turns set props.tags.seen, remove props.k, write props whole or remove props.tags."""
    kind, k, n = F.col("event_type"), F.get_json_object("props", "$.k"), F.pmod(F.col("event_id"), F.lit(4))
    sets = F.when(kind == "view", F.create_map(F.lit("props.k"), F.floor("value").cast("string"))).when((kind == "click") & (n == 0), F.create_map(F.lit("props.tags.seen"), F.col("event_id").cast("string"))).when((kind == "click") & (n == 2), F.create_map(F.lit("props"), F.col("props")))
    unsets = F.when((kind == "click") & (n == 1), F.array(F.lit("props.k"))).when((kind == "click") & (n == 3), F.array(F.lit("props.tags")))
    full = F.when(F.col("op").isin("insert", "replace"), F.create_map(F.lit("value"), F.col("value").cast("string"), F.lit("props"), F.concat(F.lit('{"k":'), k, F.lit("}"))))
    fields = {"full": full, "sets": sets, "unsets": unsets, "rekeys": F.lit(False), "to_ns": F.lit(None).cast("string")}
    return rows.select("ns", "doc_id", "op", "t", "i", "event_id", *(c.alias(name) for name, c in fields.items()))


def cdc_nested_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay of updates that lead into the documents of a JSON field."""
    docs = replay.fold(nested_log(changes(spark, sf_dir)), schema=False)
    props = F.try_element_at("doc", F.lit("props"))
    value = F.try_element_at("doc", F.lit("value")).try_cast("double")
    return docs.select("ns", "doc_id", value.alias("value"), *(F.get_json_object(props, f"$.{p}").cast("long").alias(name) for p, name in (("k", "k"), ("tags.seen", "seen"))), F.get_json_object(props, "$.tags").isNotNull().alias("has_tags"))


def schema_log(log: DataFrame) -> DataFrame:
    """Schema events at fixed shares of a log's time: a chain of two renames, a drop, and an event that changes nothing."""
    rows = log.sparkSession.sql("SELECT * FROM (VALUES (1, 'rename', 'shop.c1', 'shop.c9', 4), (2, 'drop', 'shop.c2', NULL, 6), (3, 'rename', 'shop.c9', 'shop.c8', 8), (4, 'createIndexes', 'shop.c3', NULL, 9)) AS t(no, op, ns, to_ns, twelfth)")
    bounds = log.agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    t = F.col("lo") + F.expr("(hi - lo) * twelfth div 12")
    return rows.crossJoin(F.broadcast(bounds)).select("ns", "op", "to_ns", t.alias("t"), F.lit(-1).alias("i"), F.col("no").cast("long").alias("event_id"))


def cdc_filter_excluded(spark: SparkSession, sf_dir: str) -> DataFrame:
    excluded = spark.sql("SELECT * FROM (VALUES ('shop.c1'), ('shop.c3')) AS t(ns)")
    return changes(spark, sf_dir).join(excluded, "ns", "left_anti").where(~database_of(F.col("ns")).isin("admin", "local", "config")).select("event_id", "ns")


def cdc_translate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return translate(change_log(changes(spark, sf_dir), empty=97))


def cdc_op_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes(spark, sf_dir).groupBy("ns", "op").agg(F.count(F.lit(1)).alias("n"))


def cdc_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches(changes(spark, sf_dir), 100)


def cdc_batches_ticked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events of this log are minutes apart, so a tick is a day."""
    return ticked_batches(changes(spark, sf_dir), 10, 86_400)


def cdc_shard_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = changes(spark, sf_dir).withColumn("old_key", F.col("doc_id") % 4).withColumn("new_key", F.floor("value").cast("long") % 4)
    return split_key_changes(log, F.col("event_type") == "view", F.col("event_id") % 2 == 0)


def cdc_hydrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hydrate(changes(spark, sf_dir), table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0"), "c_custkey", "c_nationkey")


def cdc_fallback_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = hydrate(changes(spark, sf_dir), table(spark, sf_dir, "customer").where("c_custkey % 3 <> 0"), "c_custkey", "c_nationkey")
    return fallback(rows, F.col("event_id") % 5 != 0, F.col("event_id") % 7 != 0).select("event_id", "op", "found", "action")


def cdc_keys_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes to one namespace whose partition key is not known, and lookups that failed for some documents of the others."""
    log = changes(spark, sf_dir)
    rows = hydrate(log, table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey").join(log.select("event_id", "ns"), "event_id")
    rows = fallback(rows.withColumn("found", F.when(F.col("doc_id") % 10 != 3, F.col("found"))), F.lit(True), F.lit(True))
    plain = rows.withColumn("action", F.when(F.col("ns") == "shop.c4", F.col("op")).otherwise(F.col("action")))
    return when_keys_unknown(plain, F.col("ns") == "shop.c4").select("event_id", "ns", "op", "action")


def cdc_key_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replacements whose new partition key differs from the one in the target become a delete and an insert. Keys compare as text."""
    kept = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("doc_id"), (F.col("c_nationkey") % 4).cast("long").alias("old_key"))
    log = changes(spark, sf_dir).where("op = 'replace'").join(kept, "doc_id").withColumn("new_key", F.floor("value").cast("long") % 4)
    differs = ~F.col("old_key").cast("string").eqNullSafe(F.col("new_key").cast("string"))
    out = split_key_changes(log.withColumn("op", F.lit("update")), differs, F.lit(True))
    return out.withColumn("action", F.when(F.col("split"), F.col("action")).otherwise("replace"))


def strip_shard_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return strip_fields(frame(spark, "updates", sf_dir), frame(spark, "shard_fields", sf_dir))


def cdc_ddl_effect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_ddl(frame(spark, "ddl_rows", sf_dir), frame(spark, "ddl_log", sf_dir)).select("ns", collection_of(F.col("ns")).alias("coll"), "doc_key", "val")


def quarantine_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = translate(change_log(changes(spark, sf_dir), empty=97)).withColumn("sets", F.when((F.col("action") == "update") & (F.col("event_id") % 11 == 0), "").otherwise(F.col("sets")))
    return quarantine(rows).select("event_id", "doc_id", "action", "status")


def serial_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_by_one(frame(spark, "serial", sf_dir)).select("no", "outcome")


def validation_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys to check after a write: those of deletions, or all; the others lose their dirty mark."""
    log = changes(spark, sf_dir)
    return log.groupBy("ns", "doc_id").agg(F.count_if(F.col("op") == "delete").alias("deletes"), F.count(F.lit(1)).alias("n")).select("ns", "doc_id", (F.col("deletes") > 0).alias("checked"), F.col("n").alias("checked_if_full"))


def safe_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return safe_place(frame(spark, "workers", sf_dir))


def resume_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resume_place(frame(spark, "starts", sf_dir))


def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collections without a checkpoint of their own."""
    rows = frame(spark, "catalog", sf_dir).select(F.concat("db", F.lit("."), "coll").alias("ns"), "n", "size")
    return rows.join(frame(spark, "checkpoints", sf_dir).select(F.col("id").alias("ns")), "ns", "left_anti")


def latest_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the collections' checkpoints: the last, and the first, from which nothing is lost."""
    rows = frame(spark, "checkpoints", sf_dir).where(F.col("id").contains("."))
    at = F.struct("t", "i")
    return rows.agg(F.max_by("id", at).alias("latest"), F.max(at).alias("hi"), F.min_by("id", at).alias("earliest"), F.min(at).alias("lo")).select("latest", F.col("hi.t").alias("latest_t"), F.col("hi.i").alias("latest_i"), "earliest", F.col("lo.t").alias("earliest_t"), F.col("lo.i").alias("earliest_i"))


def dirty_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys with changes after the last applied place, the middle of the log: by namespace and id."""
    log = changes(spark, sf_dir)
    applied = F.lit(value_at(log, "t", 0.5)).cast("long")
    return log.where(F.col("t") > applied).groupBy("ns", "doc_id").agg(F.count(F.lit(1)).alias("n_pending"))


QUERIES = {f.__name__: f for f in (cdc_apply_final_state, cdc_replay, cdc_nested_replay, cdc_filter_excluded, cdc_translate, cdc_op_counts, cdc_batches, cdc_batches_ticked, cdc_shard_key_split, cdc_hydrate, cdc_fallback_plan, cdc_keys_unknown, cdc_key_change, strip_shard_keys, cdc_ddl_effect, quarantine_invalid, serial_fallback, validation_scope, safe_checkpoint, resume_position, resume_pending, latest_checkpoint, dirty_keys)}
_C = "WITH " + CHANGES
FOLD = _C + """, o AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY t, i, event_id) AS seq FROM changes), b AS (SELECT *, max(CASE WHEN op IN ('insert', 'replace', 'delete') THEN seq END) OVER (PARTITION BY doc_id) AS base FROM o),
        l AS (SELECT * FROM b WHERE base IS NOT NULL AND seq >= base), k AS (SELECT doc_id, max(CASE WHEN seq = base THEN op END) AS base_op,
        arg_max_null(CASE WHEN event_type = 'click' THEN NULL ELSE value END, CASE WHEN op IN ('insert', 'replace', 'update') THEN seq END) AS value, arg_max_null(props, CASE WHEN op IN ('insert', 'replace') OR event_type = 'click' THEN seq END) AS props FROM l GROUP BY doc_id)
        SELECT doc_id, value, props FROM k WHERE base_op <> 'delete'"""
#: The same with the changes that each document took part in since its last base.
COUNTED = FOLD.replace(" AS base_op,", " AS base_op, count(*) AS n_changes,").replace("SELECT doc_id, value, props FROM k", "SELECT doc_id, value, props, n_changes FROM k")
REPLAY = _C + """, g AS (SELECT min(t) AS lo, max(t) - min(t) AS w FROM changes), m AS (SELECT event_id, doc_id, t, i, value, props, op, event_type, CASE WHEN op IN ('insert', 'replace') OR (op = 'update' AND (event_id % 97 = 0 OR event_id % 89 = 0)) THEN 'base' WHEN op = 'delete' THEN 'delete' ELSE 'patch' END AS kind,
        CASE WHEN ns = 'shop.c1' AND t < lo + w * 4 // 12 THEN 'shop.c9' ELSE ns END AS ns, ns = 'shop.c2' AND t < lo + w * 6 // 12 AS gone FROM changes, g),
        n AS (SELECT m.* EXCLUDE (ns, gone), CASE WHEN ns = 'shop.c9' AND t < lo + w * 8 // 12 THEN 'shop.c8' ELSE ns END AS ns FROM m, g WHERE NOT gone),
        o AS (SELECT *, row_number() OVER (PARTITION BY ns, doc_id ORDER BY t, i, event_id) AS seq FROM n), b AS (SELECT *, max(CASE WHEN kind <> 'patch' THEN seq END) OVER (PARTITION BY ns, doc_id) AS base FROM o),
        k AS (SELECT ns, doc_id, max(CASE WHEN seq = base THEN kind END) AS base_kind, count(*) AS n_changes, arg_max_null(CASE WHEN kind = 'patch' AND event_type = 'click' THEN NULL ELSE value END, CASE WHEN kind <> 'delete' THEN seq END) AS value,
        arg_max_null(props, CASE WHEN kind = 'base' OR (kind = 'patch' AND event_type = 'click') THEN seq END) AS props FROM b WHERE base IS NOT NULL AND seq >= base GROUP BY ns, doc_id)
        SELECT ns, doc_id, value, props, n_changes FROM k WHERE base_kind = 'base'"""
NESTED = _C + """, o AS (SELECT *, event_id % 4 AS r, (props->>'$.k')::BIGINT AS pk, row_number() OVER (PARTITION BY doc_id ORDER BY t, i, event_id) AS seq FROM changes), b AS (SELECT *, max(CASE WHEN op IN ('insert', 'replace', 'delete') THEN seq END) OVER (PARTITION BY doc_id) AS base FROM o),
        l AS (SELECT *, op IN ('insert', 'replace') AS is_base, event_type = 'click' AS click FROM b WHERE base IS NOT NULL AND seq >= base), k AS (SELECT ns, doc_id, max(CASE WHEN seq = base THEN op END) AS base_op, max(CASE WHEN seq = base THEN value END) AS value,
        arg_max_null(CASE WHEN event_type = 'view' THEN floor(value)::BIGINT WHEN click AND r = 1 THEN NULL ELSE pk END, CASE WHEN is_base OR event_type = 'view' OR (click AND r IN (1, 2)) THEN seq END) AS k,
        arg_max_null(CASE WHEN click AND r = 0 THEN event_id END, CASE WHEN is_base OR (click AND r <> 1) THEN seq END) AS seen FROM l GROUP BY ns, doc_id)
        SELECT ns, doc_id, value, k, seen, seen IS NOT NULL AS has_tags FROM k WHERE base_op <> 'delete'"""
_TRANSLATE = """w AS (SELECT event_id, doc_id, CASE WHEN op IN ('insert', 'replace') THEN 'replace' WHEN op = 'delete' THEN 'delete' WHEN event_id % 97 = 0 THEN 'replace' ELSE 'update' END AS action,
        CASE WHEN op = 'delete' THEN '' WHEN op IN ('insert', 'replace') OR event_id % 97 = 0 THEN 'value,props' WHEN event_type = 'view' THEN 'value' ELSE 'props' END AS sets, CASE WHEN event_type = 'click' AND event_id % 97 <> 0 THEN 'value' ELSE '' END AS unsets FROM changes)"""
_HYDRATE = """h AS (SELECT event_id, doc_id, op, c_custkey IS NOT NULL AS found, c_nationkey AS part_key FROM changes LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON doc_id = c_custkey WHERE op IN ('update', 'replace', 'delete'))"""
_FNV = "(list_reduce(list_concat([2166136261::BIGINT], list_transform(range(0, strlen(doc_id::VARCHAR)), lambda x: ('0x' || substr(hex(encode(doc_id::VARCHAR)), (2 * x + 1)::INT, 2))::INT::BIGINT)), lambda h, b: (xor(h, b) * 16777619) & 4294967295) % 4)::INTEGER"
_CLASS = KEYS_SQL["classify_errors"].split("SELECT no, ", 1)[1].rsplit(" AS class", 1)[0]
SQL = {
    "cdc_apply_final_state": COUNTED,
    "cdc_replay": REPLAY,
    "cdc_nested_replay": NESTED,
    "cdc_filter_excluded": _C + " SELECT event_id, ns FROM changes WHERE ns NOT IN ('shop.c1', 'shop.c3')",
    "cdc_translate": _C + f", {_TRANSLATE} SELECT event_id, doc_id, action, action = 'replace' AS upsert, sets, unsets FROM w",
    "cdc_op_counts": _C + " SELECT ns, op, count(*) AS n FROM changes GROUP BY ns, op",
    "cdc_batches": _C + f""", r AS (SELECT *, {_FNV} AS worker FROM changes), c AS (SELECT *, (row_number() OVER (PARTITION BY worker, ns ORDER BY t, i) - 1) // 100 AS batch FROM r)
        SELECT worker, ns, batch, count(*) AS n, arg_max(t, t * 1000000 + i) AS last_t, arg_max(i, t * 1000000 + i) AS last_i FROM c GROUP BY worker, ns, batch""",
    "cdc_batches_ticked": _C + f""", r AS (SELECT *, {_FNV} AS worker, t // 86400 AS tick FROM changes), c AS (SELECT *, (row_number() OVER (PARTITION BY worker, ns, tick ORDER BY t, i) - 1) // 10 AS k FROM r),
        g AS (SELECT worker, ns, tick, k, count(*) AS n, arg_max(t, t * 1000000 + i) AS last_t, arg_max(i, t * 1000000 + i) AS last_i FROM c GROUP BY ALL) SELECT row_number() OVER (ORDER BY worker, ns, tick, k) - 1 AS batch, worker, ns, tick, n, last_t, last_i FROM g""",
    "cdc_shard_key_split": _C + """, s AS (SELECT *, event_type = 'view' AND event_id % 2 = 0 AS split, doc_id % 4 AS old_key, floor(value)::BIGINT % 4 AS new_key FROM changes)
        SELECT event_id, 1::INTEGER AS part, CASE WHEN split THEN 'delete' ELSE op END AS action, old_key AS part_key, split FROM s UNION ALL SELECT event_id, 2::INTEGER, 'insert', new_key, split FROM s WHERE split""",
    "cdc_hydrate": _C + f", {_HYDRATE} SELECT * FROM h",
    "cdc_fallback_plan": _C + f", {_HYDRATE} SELECT event_id, op, found, CASE WHEN found THEN op || '_one' WHEN op = 'delete' THEN 'delete_many' WHEN op = 'update' AND event_id % 5 <> 0 THEN 'update_many' WHEN op = 'replace' AND event_id % 7 <> 0 THEN 'insert' ELSE 'skip' END AS action FROM h",
    "cdc_keys_unknown": _C + """ SELECT event_id, ns, op, CASE WHEN ns = 'shop.c4' THEN CASE WHEN op IN ('delete', 'update') THEN op || '_many' ELSE op END WHEN doc_id % 10 = 3 THEN op WHEN c_custkey IS NOT NULL THEN op || '_one'
        WHEN op = 'delete' THEN 'delete_many' WHEN op = 'update' THEN 'update_many' ELSE 'insert' END AS action FROM changes LEFT JOIN customer ON doc_id = c_custkey WHERE op IN ('update', 'replace', 'delete')""",
    "cdc_key_change": _C + """, s AS (SELECT event_id, (c_nationkey % 4)::BIGINT AS old_key, floor(value)::BIGINT % 4 AS new_key FROM changes JOIN customer ON doc_id = c_custkey WHERE op = 'replace')
        SELECT event_id, 1::INTEGER AS part, CASE WHEN old_key <> new_key THEN 'delete' ELSE 'replace' END AS action, old_key AS part_key, old_key <> new_key AS split FROM s UNION ALL SELECT event_id, 2::INTEGER, 'insert', new_key, true FROM s WHERE old_key <> new_key""",
    "strip_shard_keys": cte("updates", "shard_fields") + """, k AS (SELECT * FROM updates u WHERE NOT EXISTS (SELECT 1 FROM shard_fields s WHERE u.field = s.field OR starts_with(u.field, s.field || '.')))
        SELECT no, coalesce((SELECT string_agg(field, ',' ORDER BY field) FROM k WHERE k.no = u.no AND op = 'set'), '') AS sets, coalesce((SELECT string_agg(field, ',' ORDER BY field) FROM k WHERE k.no = u.no AND op = 'unset'), '') AS unsets, NOT EXISTS (SELECT 1 FROM k WHERE k.no = u.no) AS empty FROM (SELECT DISTINCT no FROM updates) u""",
    "cdc_ddl_effect": cte("ddl_rows") + """, a AS (SELECT *, CASE WHEN seq < 3 AND ns = 'a.x' THEN 'a.y2' ELSE ns END AS n1 FROM ddl_rows), b AS (SELECT * FROM a WHERE NOT (seq < 5 AND n1 = 'a.y')), c AS (SELECT * FROM b WHERE NOT (seq < 9 AND starts_with(n1, 'b.'))),
        d AS (SELECT CASE WHEN seq < 11 AND n1 = 'a.y2' THEN 'd.e' ELSE n1 END AS ns, doc_key, val FROM c) SELECT ns, split_part(ns, '.', 2) AS coll, doc_key, val FROM d""",
    "quarantine_invalid": _C + f", {_TRANSLATE}, q AS (SELECT *, CASE WHEN action = 'update' AND event_id % 11 = 0 THEN '' ELSE sets END AS s2 FROM w) SELECT event_id, doc_id, action, CASE WHEN action = 'update' AND s2 = '' AND unsets = '' THEN 'cdc_write_failed' ELSE 'applied' END AS status FROM q",
    "serial_fallback": cte("serial") + f""", c AS (SELECT *, {_CLASS} AS class FROM serial) SELECT no, CASE WHEN message IS NULL THEN 'applied' WHEN class = 'duplicate' AND lone THEN 'applied_without_write' WHEN class = 'unrecoverable' THEN 'cdc_write_failed'
        WHEN class <> 'fatal' AND attempts < 3 THEN 'retry' ELSE 'stop' END AS outcome FROM c""",
    "validation_scope": _C + " SELECT ns, doc_id, bool_or(op = 'delete') AS checked, count(*) AS checked_if_full FROM changes GROUP BY ns, doc_id",
    "safe_checkpoint": cte("workers") + """, m AS (SELECT grp, CASE WHEN max(pending) OVER (PARTITION BY grp) > 0 THEN last_t ELSE received_t END AS t, CASE WHEN max(pending) OVER (PARTITION BY grp) > 0 THEN last_i ELSE received_i END AS i FROM workers)
        SELECT grp, t, i FROM m QUALIFY row_number() OVER (PARTITION BY grp ORDER BY t, i) = 1""",
    "resume_position": cte("starts") + "SELECT no, CASE WHEN safe_t NOT IN (0, 4294967295) THEN safe_t ELSE coalesce(anchor_t, coll_t, start_t) END::BIGINT AS t, CASE WHEN safe_t NOT IN (0, 4294967295) THEN safe_i WHEN anchor_t IS NOT NULL THEN anchor_i WHEN coll_t IS NOT NULL THEN coll_i ELSE start_i END::BIGINT AS i FROM starts",
    "resume_pending": cte("catalog", "checkpoints") + "SELECT db || '.' || coll AS ns, n, size FROM catalog WHERE db || '.' || coll NOT IN (SELECT id FROM checkpoints)",
    "latest_checkpoint": cte("checkpoints") + """, c AS (SELECT * FROM checkpoints WHERE contains(id, '.')), a AS (SELECT * FROM c ORDER BY t DESC, i DESC LIMIT 1), b AS (SELECT * FROM c ORDER BY t, i LIMIT 1)
        SELECT a.id AS latest, a.t AS latest_t, a.i AS latest_i, b.id AS earliest, b.t AS earliest_t, b.i AS earliest_i FROM a, b""",
    "dirty_keys": _C + ", p AS (SELECT t FROM changes ORDER BY t LIMIT 1 OFFSET (SELECT (ceil(count(*) * 0.5) - 1)::BIGINT FROM changes)) SELECT ns, doc_id, count(*) AS n_pending FROM changes WHERE t > (SELECT t FROM p) GROUP BY ns, doc_id",
}

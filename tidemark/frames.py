"""Views over the given tables that Spark and DuckDB read alike: bookkeeping tables, the change log, a flawed copy."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_DB = "CASE n_regionkey % 5 WHEN 0 THEN 'shop' WHEN 1 THEN 'crm' WHEN 2 THEN 'iot' WHEN 3 THEN 'local' ELSE 'admin' END"
_COLL = "CASE WHEN n_nationkey = 3 THEN 'oplog.rs' WHEN n_nationkey % 7 = 5 THEN 'system.' || lower(n_name) ELSE lower(n_name) END"
_NS = f"{_DB} || '.' || {_COLL}"
_UNIT = "'crm.u' || CAST(c_custkey % 400 AS STRING)"
_EVENT_NS, _EVENT_DOC = "'shop.c' || CAST(user_id % 5 AS STRING)", "'k' || CAST(user_id AS STRING)"


def _pick(number: str, values: list[str]) -> str:
    """One of ``values`` (SQL) by ``number``."""
    return f"CASE {number} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1])) + f" ELSE {values[-1]} END"


_MESSAGES = ["'Authentication failed for user '", "'server said: Too Many Cursors '", "'E11000 duplicate key error '", "'connection reset by peer '", "'the shard key is missing '", "'Failed to target the write '", "'SASL conversation error '", "'i/o timeout '", "'disk full '", "'update document must have at least one element '",
    "'Mechanism mismatch '", "'unauthorized '", "'incomplete read of message '", "'cursor not found '", "'network is unreachable '", "'context canceled '"]
_FIRST24, _UUID = "substr(md5(c_name), 1, 24)", "substr(md5(c_name), 1, 8) || '-' || substr(md5(c_name), 9, 4) || '-' || substr(md5(c_name), 13, 4) || '-' || substr(md5(c_name), 17, 4) || '-' || substr(md5(c_name), 21, 12)"
_REQUESTS = [f"'ObjectId(''' || {_FIRST24} || ''')'", f"'objectid(\"' || upper({_FIRST24}) || '\")'", f"' ' || {_FIRST24} || ' '", f"'UUID(\"' || {_UUID} || '\")'", f"upper({_UUID})", "c_name", "CAST(c_custkey AS STRING) || '.0'", "CAST(c_custkey AS STRING) || '.5'", "'-' || CAST(c_custkey AS STRING)", "' ' || c_name || ' '"]

#: Small and bookkeeping tables as the given tables make them, in words that Spark and DuckDB read alike; a table's name in braces is where it lies.
FRAMES = {
    "catalog": f"SELECT {_DB} AS db, {_COLL} AS coll, count(c_custkey) AS n, CAST(coalesce(sum(c_custkey), 0) * 1000 AS BIGINT) AS size, n_nationkey % 4 <> 1 AS has_id_index FROM {{nation}} LEFT JOIN {{customer}} ON c_nationkey = n_nationkey GROUP BY n_regionkey, n_nationkey, n_name",
    "excluded_ns": f"SELECT {_NS} AS ns FROM {{nation}} WHERE n_nationkey % 11 = 2",
    "mixed_ids": f"SELECT {_NS} AS ns, CASE WHEN n_nationkey % 6 = 0 AND c_custkey % 2 = 0 THEN 'decimal' ELSE 'string' END AS id_type FROM {{customer}} JOIN {{nation}} ON c_nationkey = n_nationkey UNION ALL SELECT 'crm.small', CASE WHEN r_regionkey % 2 = 0 THEN 'decimal' ELSE 'string' END FROM {{region}}",
    "streams": f"SELECT CASE WHEN n_nationkey = 0 THEN '' ELSE {_DB} END AS db, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE {_COLL} END AS coll FROM {{nation}}",
    "rules": f"SELECT CAST(c_custkey AS INT) AS rule_no, {_UNIT} AS ns, {_pick('c_custkey', ["'o_custkey:1, o_orderkey:1'", "' _id : hashed '", "'c_nationkey:hashed'", "'u:1,o:-1,k'", "'region:1,_id:hashed'", "'other:1'"])} AS shard_key, {_pick('c_custkey', ["'range_manual'", "'none'", "'hashed_manual'", "'composite_uuid_oid'", "'hex'"])} AS strategy, CASE WHEN c_nationkey % 3 = 0 THEN 12 ELSE 0 END AS initial_chunks FROM {{customer}}",
    "sharded": f"SELECT {_UNIT} AS ns, 'catalog_' || CAST(min(c_nationkey) AS STRING) || ':1' AS shard_key, min(c_nationkey) % 4 = 0 AS dropped FROM {{customer}} WHERE c_custkey % 3 <> 1 GROUP BY c_custkey % 400",
    "ids": f"SELECT c_custkey AS no, {_pick('c_custkey', ["'objectid'", "'uuid'", "'text'"])} AS kind, CASE c_custkey % 3 WHEN 0 THEN upper({_FIRST24}) WHEN 1 THEN upper(md5(c_name)) END AS hex, CASE WHEN c_custkey % 3 = 2 THEN c_name END AS txt FROM {{customer}}",
    "requests": f"SELECT c_custkey AS no, CASE WHEN c_custkey % 10 BETWEEN 6 AND 8 THEN 'number' ELSE 'string' END AS kind, {_pick('c_custkey', _REQUESTS)} AS txt FROM {{customer}}",
    "request_keys": "SELECT CAST(FLOOR(c_custkey / 4) AS BIGINT) AS req, CAST(FLOOR((c_custkey % 4) / 2) AS BIGINT) AS place, CASE WHEN c_custkey % 2 = 0 THEN '_id' ELSE 'region' END AS field, c_custkey AS no FROM {customer}",
    "touched": f"SELECT DISTINCT {_EVENT_NS} AS ns, {_EVENT_DOC} AS doc_id FROM {{events}} WHERE event_type = 'click' AND user_id % 3 = 0",
    "serial": f"SELECT event_id AS no, event_id % 5 AS attempts, user_id % 2 = 0 AS lone, CASE WHEN event_id % 7 = 0 THEN NULL ELSE {_pick('event_id', _MESSAGES)} || CAST(event_id AS STRING) END AS message FROM {{events}}",
    "errors": f"SELECT event_id AS no, {_pick('event_id', _MESSAGES)} || CAST(event_id AS STRING) AS message FROM {{events}}",
    "updates": f"SELECT DISTINCT user_id AS no, CASE WHEN event_type = 'error' THEN 'unset' ELSE 'set' END AS op, {_pick('event_id', ["'region'", "'name'", "'geo.lat'", "'geo'", "'geography'", "'region.code'", "'regional'", "'old'", "'ge'"])} AS field FROM {{events}}",
    "shard_fields": ("field", "('region'), ('geo')"),
    "ddl_rows": f"SELECT 2 * (event_id % 7) AS seq, {_pick('user_id', ["'a.x'", "'a.y'", "'b.z'", "'b.w'", "'c.q'", "'a.y2'"])} AS ns, event_id AS doc_key, user_id AS val FROM {{events}}",
    "ddl_log": ("seq, op, ns, to_ns", "(3, 'rename', 'a.x', 'a.y2'), (5, 'drop', 'a.y', NULL), (7, 'create', 'a.n', NULL), (9, 'dropDatabase', 'b', NULL), (11, 'rename', 'a.y2', 'd.e'), (13, 'createIndexes', 'c.q', NULL)"),
    "workers": "SELECT 'g' || CAST(user_id % 6 AS STRING) AS grp, event_id % 4 AS worker, max(CASE WHEN event_id % 10 <> 0 THEN event_id ELSE 0 END) AS last_t, max(event_id % 3) AS last_i, sum(CASE WHEN event_id % 10 = 0 AND user_id % 6 < 4 THEN 1 ELSE 0 END) AS pending, max(event_id) + 30 AS received_t, max(user_id % 7) AS received_i FROM {events} GROUP BY user_id % 6, event_id % 4",
    "starts": "SELECT event_id AS no, CASE event_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 4294967295 ELSE event_id + 500 END AS safe_t, event_id % 9 AS safe_i, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_id + 400 END AS anchor_t, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 1 END AS anchor_i, CASE WHEN event_id % 5 < 2 THEN NULL ELSE event_id + 300 END AS coll_t, CASE WHEN event_id % 5 < 2 THEN NULL ELSE 9 END AS coll_i, user_id + 1 AS start_t, 2 AS start_i FROM {events}",
    "checkpoints": f"SELECT {_NS} AS id, CAST(400 + n_nationkey AS BIGINT) AS t, CAST(n_nationkey % 3 AS BIGINT) AS i FROM {{nation}} WHERE n_nationkey % 2 = 0 UNION ALL SELECT CASE r_regionkey WHEN 0 THEN 'cdc_resume_timestamp' ELSE 'migration_anchor_timestamp' END, CAST(500 - r_regionkey AS BIGINT), CAST(3 AS BIGINT) FROM {{region}} WHERE r_regionkey < 2",
    "outcome_ops": f"SELECT event_id AS seq, {_EVENT_NS} AS ns, {_EVENT_DOC} AS doc_id, CASE WHEN event_type = 'signup' AND event_id % 5 = 1 THEN 'delete' ELSE 'upsert' END AS op, CASE WHEN event_type = 'signup' AND event_id % 5 = 1 THEN 'valid' ELSE {_pick('event_id', ["'error'", "'hot_key_waiting'", "'batch_failed'", "'healed_pending_verify'", "'manual_validation_required'", "'error'", "'error'"])} END AS status FROM {{events}}",
    "audit": f"SELECT event_id AS no, {_EVENT_NS} AS ns, CASE event_type WHEN 'signup' THEN 'ghost_fixed' WHEN 'purchase' THEN 'missing_target_fixed' WHEN 'view' THEN 'orphan_deleted' WHEN 'click' THEN 'content_mismatch_fixed' ELSE 'note' END AS action FROM {{events}}",
    "stats": "SELECT 'shop.c' || CAST(o_custkey % 7 AS STRING) AS ns, count(*) AS total_checked, CAST(sum(CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS mismatch_found, CAST(sum(CASE WHEN o_orderkey % 18 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS mismatch_fixed FROM {orders} GROUP BY o_custkey % 7",
    "sizing": "SELECT p_partkey AS no, CAST(p_size % 6 AS BIGINT) AS shards, CAST(CASE WHEN p_partkey % 3 = 0 THEN p_size % 9 ELSE 0 END AS BIGINT) AS explicit_chunks, p_partkey * 50000000 AS size FROM {part}",
    "shards": "SELECT 's' || CAST(s_suppkey AS STRING) AS id, CASE WHEN s_suppkey % 5 = 4 THEN s_name ELSE 'rs' || CAST(s_suppkey AS STRING) || '/h' || CAST(s_nationkey AS STRING) || ':27018,g' || CAST(s_suppkey AS STRING) || ':27018' END AS host FROM {supplier}",
    "chunks": "SELECT 'shop.c' || CAST(o_custkey % 3 AS STRING) AS ns, o_orderkey AS min_key, 's' || CAST(o_custkey % 7 AS STRING) AS shard, o_orderkey % 700 = 0 AS jumbo FROM {orders} WHERE o_orderkey % 10 = 0",
    "indexes_src": f"SELECT 'crm.u' || CAST(CAST(FLOOR(c_custkey / 8) AS BIGINT) % 400 AS STRING) AS ns, {_pick('c_custkey', ["'_id_'", "'by_cust'", "'words'", "'part'", "'expiry'", "'mail'", "'empty'", "'geo'"])} AS name, {_pick('c_custkey', ["'_id:1'", "'o_custkey:1,o_orderkey:-1'", "'note:text'", "'x:1'", "'created:1'", "'mail:1'", "''", "'lat:1,lon:1'"])} AS key, c_custkey % 8 IN (0, 5) AS is_unique, CASE WHEN c_custkey % 8 = 4 THEN 3600 END AS ttl, c_custkey % 8 = 3 AS partial FROM {{customer}}",
    "indexes_tgt": f"SELECT 'crm.u' || CAST(CAST(FLOOR(c_custkey / 8) AS BIGINT) % 400 AS STRING) AS ns, 'other_' || CAST(c_custkey % 8 AS STRING) AS name, {_pick('c_custkey', ["'_id:1'", "'o_custkey:1,o_orderkey:-1'", "'lon:1,lat:1'", "'y:1'", "'created:1'", "'mail:1'", "'z:1'", "'lat:1,lon:1'"])} AS key, false AS is_unique, CAST(NULL AS INT) AS ttl, false AS partial FROM {{customer}} WHERE c_nationkey % 3 <> 0",
    "target_dbs": f"SELECT DISTINCT {_DB} AS db FROM {{nation}} WHERE n_regionkey <> 1 UNION ALL SELECT CASE r_regionkey WHEN 0 THEN 'other' ELSE 'meta' END FROM {{region}} WHERE r_regionkey < 2",
    "node_samples": "SELECT 'g' || CAST(CAST(FLOOR(event_id / 3) AS BIGINT) AS STRING) AS grp, event_id % 3 AS node, CAST(FLOOR(value * 7) AS BIGINT) % 270 AS latency_ms, user_id % 53 AS queue_total, event_id % 23 AS active_clients, CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id % 130 END AS write_tickets, event_id % 50 = 0 AS lagged, event_id % 97 = 0 AS failed FROM {events}",
    "numbers": f"SELECT event_id AS no, {_pick('event_id', ["CAST(event_id AS STRING)", "CAST(event_id AS STRING) || '.7'", "'-' || CAST(user_id AS STRING) || '.9'", "event_type", "NULL", "'1e3'", "''"])} AS txt FROM {{events}}",
    "dirty_checks": "SELECT event_id AS no, user_id % 3 = 0 AS dirty, event_id % 6 AS attempt FROM {events}",
    "queue_log": f"SELECT {_EVENT_NS} AS grp, event_id AS step, CAST(FLOOR(value * 8) AS BIGINT) % 2600 AS depth FROM {{events}}",
    "sweeps": "SELECT event_id AS no, (event_id % 700) * 0.5 AS since_s, (user_id % 20) * 0.5 AS idle_s, (event_id % 4) * 0.5 AS lag_s FROM {events}",
    "status_rows": "SELECT o_orderkey AS no, o_custkey * 1000 AS total_bytes, o_custkey * (o_orderkey % 1000) AS cloned_bytes, o_orderstatus = 'F' AS clone_done, CASE WHEN o_orderkey % 9 = 0 THEN 0 ELSE 1700000000 + o_orderkey END AS source_t, CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE 1700000000 + o_custkey END AS applied_t, 1700000000 + o_orderkey % 400 AS now_t, o_orderkey % 500 AS checked, o_custkey % 300 AS pending FROM {orders}",
    "oplog": "SELECT CAST(event_id AS INT) AS no, CASE WHEN event_type = 'click' THEN 'cdc' ELSE 'bulk' END AS kind, CAST(user_id % 4 AS INT) AS worker, CAST(event_id % 40 AS INT) AS docs, CAST(event_id % 40 * (user_id % 200) AS INT) AS byte_size, (1 + user_id % 30) * 0.0625 AS elapsed_s FROM {events}",
}
_GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "events")
EXCLUDED_DBS = ("admin", "local", "config")


def frame(spark: SparkSession, name: str, sf_dir: str) -> DataFrame:
    made = FRAMES[name]
    if isinstance(made, str):
        return spark.sql(made.format_map({t: f"parquet.`{sf_dir}/{t}.parquet`" for t in _GIVEN}))
    columns, rows = made
    return spark.sql(f"SELECT * FROM (VALUES {rows}) AS t({columns})")


def cte(*names: str) -> str:
    """``WITH`` and the frames of these names."""
    texts = {n: FRAMES[n] for n in names}
    return "WITH " + ", ".join(f"{n} AS ({x.format_map({t: t for t in _GIVEN})})" if isinstance(x, str) else f"{n} AS (SELECT * FROM (VALUES {x[1]}) AS t({x[0]}))" for n, x in texts.items()) + " "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of ``orders`` with missing, changed, orphaned and doubled rows."""
    o = source(spark, sf_dir)
    k = F.col("o_orderkey")
    kept = o.where(k % 17 != 0).withColumn("o_totalprice", F.when(k % 19 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    orphans = o.where(k % 23 == 0).withColumn("o_orderkey", k + 1_000_000_000)
    ghosts = o.where(k % 29 == 0).withColumn("o_orderpriority", F.lit("GHOST"))
    return kept.unionByName(orphans).unionByName(ghosts)


TARGET = """tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 19 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 17 <> 0
  UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 23 = 0
  UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, 'GHOST' FROM orders WHERE o_orderkey % 29 = 0)"""

CHANGES = """changes AS (SELECT event_id, user_id AS doc_id, CASE event_type WHEN 'signup' THEN 'insert' WHEN 'purchase' THEN 'replace' WHEN 'error' THEN 'delete' ELSE 'update' END AS op, event_type,
  floor(epoch(ts))::BIGINT AS t, row_number() OVER (PARTITION BY floor(epoch(ts)) ORDER BY event_id) AS i, value, props, 'shop.c' || (user_id % 5) AS ns FROM events)"""


def as_changes(events: DataFrame) -> DataFrame:
    """The change log of the ``events`` table: event_id, doc_id, op, event_type, t, i, value, props, ns."""
    from pyspark.sql import Window

    op = F.when(F.col("event_type") == "signup", "insert").when(F.col("event_type") == "purchase", "replace").when(F.col("event_type") == "error", "delete").otherwise("update")
    t = F.unix_timestamp(F.col("ts").cast("timestamp"))
    rows = events.withColumn("t", t)
    i = F.row_number().over(Window.partitionBy("t").orderBy("event_id")).cast("long")
    return rows.select("event_id", F.col("user_id").alias("doc_id"), op.alias("op"), "event_type", "t", i.alias("i"), "value", "props", F.concat(F.lit("shop.c"), (F.col("user_id") % 5).cast("string")).alias("ns"))


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_changes(table(spark, sf_dir, "events"))


def change_log(rows: DataFrame, empty: int = 0, rekeyed: int = 0) -> DataFrame:
    """Changes of the ``events`` table as a log of documents with the fields value and props: updates of kind view set value, those of kind
    click set props and unset value. One update of ``empty`` describes nothing and one of ``rekeyed`` touches the partition key; both
    carry their document."""
    never = F.lit(False)
    base, update = F.col("op").isin("insert", "replace"), F.col("op") == "update"
    bare = update & (F.col("event_id") % empty == 0) if empty else never
    moved = update & (F.col("event_id") % rekeyed == 0) if rekeyed else never
    value, props = (F.lit("value"), F.col("value").cast("string")), (F.lit("props"), F.col("props"))
    click, told = F.col("event_type") == "click", update & ~bare
    sets = F.when(told & click, F.create_map(*props)).when(told & (F.col("event_type") == "view"), F.create_map(*value))
    fields = {"full": F.when(base | bare | moved, F.create_map(*value, *props)), "sets": sets, "unsets": F.when(told & click, F.array(F.lit("value"))), "rekeys": moved, "to_ns": F.lit(None).cast("string")}
    return rows.select("ns", "doc_id", "op", "t", "i", "event_id", *(c.alias(n) for n, c in fields.items()))


def fields_of(docs: DataFrame, *more: str) -> DataFrame:
    """Replayed documents with value and props as columns, and ``more`` columns."""
    return docs.select("ns", "doc_id", F.try_element_at("doc", F.lit("value")).try_cast("double").alias("value"), F.try_element_at("doc", F.lit("props")).alias("props"), *more)

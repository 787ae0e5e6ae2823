"""Comparison of source and target by key, repair, and the records it leaves.

Equality is strict: columns have one type on both sides and compare null-safe. Targets may hold several copies of a key (ghosts), which is
found before equality is looked at, so doubled keys are always repaired.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.frames import TARGET, cte, frame, source, table, target
from tidemark.shared import numbered, written

ACTIONS = {"ghost": "ghost_fixed", "missing": "missing_target_fixed", "mismatch": "content_mismatch_fixed", "orphan": "orphan_deleted"}
MANUAL, MAX_RETRIES = "manual_validation_required", 3


def compare(src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """(key, outcome) of every key of either side: valid, missing, orphan, ghost, mismatch; null keys are errors.

    The target is grouped by key first and the join uses the same partitioning, so each side is shuffled once.
    """
    columns = [c for c in src.columns if c != key]
    copies = tgt.groupBy(key).agg(F.count(F.lit(1)).alias("copies"), *(F.first(c).alias(f"t_{c}") for c in columns))
    kept = src.select(F.col(key).alias("s_key"), *(F.col(c).alias(f"s_{c}") for c in columns))
    both = kept.join(copies, F.col("s_key") == F.col(key), "full_outer")
    same = F.lit(True)
    for c in columns:
        same = same & F.col(f"s_{c}").eqNullSafe(F.col(f"t_{c}"))
    found = F.col("copies").isNotNull()
    outcome = (
        F.when(F.col("s_key").isNull() & F.col(key).isNull(), "error").when(F.col("s_key").isNull(), "orphan").when(~found, "missing")
        .when(F.col("copies") > 1, "ghost").when(same, "valid").otherwise("mismatch")
    )
    return both.select(F.coalesce("s_key", F.col(key)).alias(key), outcome.alias("outcome"), F.coalesce("copies", F.lit(0)).alias("copies"))


def compare_keys(keys: DataFrame, src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """(key, outcome) of the keys asked for: as :func:`compare` finds them, valid where neither side has the key; null keys are errors."""
    found = compare(src, tgt, key).select(F.col(key).alias("_key"), "outcome")
    asked = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
    outcome = F.when(F.col(key).isNull(), "error").otherwise(F.coalesce("outcome", F.lit("valid")))
    return asked.join(found, F.col(key) == F.col("_key"), "left").select(key, outcome.alias("outcome"))


def untouched(failures: DataFrame, changed: DataFrame) -> DataFrame:
    """Failures whose document no change has touched since; the others are looked at again by the change itself."""
    return failures.join(changed.select("ns", "doc_id").distinct(), ["ns", "doc_id"], "left_anti")


def erased(*tables: DataFrame) -> tuple[DataFrame, ...]:
    """The validation tables after a reset that erases."""
    return tuple(t.limit(0) for t in tables)


def any_of(rows: DataFrame, most: int = 1) -> DataFrame:
    """Whether there are rows, by a count that stops at ``most``."""
    return rows.limit(most).agg(F.count(F.lit(1)).alias("n"))


def repair(src: DataFrame, tgt: DataFrame, key: str) -> DataFrame:
    """The target after repair: valid rows stay, orphans go, all other keys get the source's row."""
    bad = written(compare(src, tgt, key).where("outcome <> 'valid'").select(key, "outcome"), "repair-verdicts")  # both joins read it
    kept = tgt.join(bad.select(key), key, "left_anti")
    return kept.unionByName(src.join(bad.where("outcome <> 'orphan'").select(key), key, "left_semi"))


def with_status(outcomes: DataFrame, failed: Column | None = None) -> DataFrame:
    """Status and audit action of each outcome; keys whose repair failed need a person."""
    action = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
    done = F.when(F.col("outcome") == "valid", "valid").when(F.col("outcome") == "error", "error").otherwise("healed_pending_verify")
    status = done if failed is None else F.when(failed & (done == "healed_pending_verify"), MANUAL).otherwise(done)
    return outcomes.withColumn("status", status).withColumn("action", F.try_element_at(action, F.col("outcome")))


def fold_failures(ops: DataFrame, max_retries: int = MAX_RETRIES) -> DataFrame:
    """The failure table after outcome operations (seq, ns, doc_id, op, status): per key the last status, and the retries counted since
    the last status that sets them (hot keys to the limit, failed batches and healed keys to 0). A deletion removes the key."""
    key = Window.partitionBy("ns", "doc_id")
    gone = F.max(F.when(F.col("op") == "delete", F.col("seq"))).over(key)
    live = ops.withColumn("gone", F.coalesce(gone, F.lit(-1))).where("op = 'upsert' AND seq > gone")
    sets = F.when(F.col("status") == "hot_key_waiting", max_retries).when(F.col("status").isin("batch_failed", "healed_pending_verify", "safety_deferred_delete"), 0)
    live = live.withColumn("sets", sets).withColumn("set_at", F.coalesce(F.max(F.when(F.col("sets").isNotNull(), F.col("seq"))).over(key), F.lit(-1)))
    return live.groupBy("ns", "doc_id").agg(
        F.max_by("status", "seq").alias("status"), (F.coalesce(F.max(F.when(F.col("seq") == F.col("set_at"), F.col("sets"))), F.lit(0)) + F.count_if(F.col("seq") > F.col("set_at"))).cast("long").alias("retry_count"), F.min("seq").alias("first_seq")
    )


def eligible(failures: DataFrame, most: int | None = None) -> DataFrame:
    """Failures to try again: not left to a person, and tried at most so often."""
    rows = failures.where(F.col("status") != MANUAL)
    return rows if most is None else rows.where(F.coalesce("retry_count", F.lit(0)) <= most)


def reconcile(audit: DataFrame, failures: DataFrame, stats: DataFrame) -> DataFrame:
    """Of every namespace seen anywhere: fixed (repairs in the audit), pending (failures), found (both), checked."""
    fixed = audit.where(F.col("action").isin(*ACTIONS.values())).groupBy("ns").agg(F.count(F.lit(1)).alias("fixed"))
    pending = failures.groupBy("ns").agg(F.count(F.lit(1)).alias("pending"))
    both = fixed.join(pending, "ns", "full_outer").join(stats.select("ns", F.col("total_checked").alias("checked")), "ns", "full_outer")
    out = both.select("ns", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("checked", "fixed", "pending")))
    return out.withColumn("found", F.col("fixed") + F.col("pending"))


def totals(stats: DataFrame, failures: DataFrame) -> DataFrame:
    """Sums over all namespaces, zeros without any, what is pending, and the share in sync (0 with nothing checked; may be negative)."""
    sums = stats.agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("total_checked", "mismatch_found", "mismatch_fixed")))
    waiting = failures.where(~F.col("status").isin("valid", MANUAL)).agg(F.count(F.lit(1)).alias("pending"))
    percent = F.when(F.col("total_checked") > 0, (F.col("total_checked") - F.col("pending")) / F.col("total_checked") * 100).otherwise(0.0)
    return sums.crossJoin(F.broadcast(waiting)).withColumn("sync_percent", F.round(percent, 6))


def sweep(rows: DataFrame, forced_s: float = 300, idle_poll_s: float = 5) -> DataFrame:
    """Whether failures are looked at again: after the longest wait, or when changes pause, nothing lags and the last sweep is a while ago."""
    idle = (F.col("idle_s") > idle_poll_s) & (F.col("lag_s") < 1) & (F.col("since_s") > 3 * idle_poll_s)
    return rows.select("no", F.when(F.col("since_s") >= forced_s, "forced").when(idle, "idle").otherwise("none").alias("sweep"))


def _pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return source(spark, sf_dir), target(spark, sf_dir)


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fold_failures(frame(spark, "outcome_ops", sf_dir))


def validate_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every key and its status; the repair of every 101st key is taken to have failed."""
    return with_status(compare(*_pair(spark, sf_dir), "o_orderkey"), F.col("o_orderkey") % 101 == 0)


def validate_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare(*_pair(spark, sf_dir), "o_orderkey").groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def validate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys from outside: some on one side, some on both, some on none, and a null one."""
    keys = table(spark, sf_dir, "lineitem").select((F.col("l_orderkey") + 3).alias("k")).union(spark.sql("SELECT CAST(NULL AS BIGINT)"))
    return compare_keys(keys, *_pair(spark, sf_dir), "o_orderkey")


def failures_untouched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return untouched(_failures(spark, sf_dir), frame(spark, "touched", sf_dir)).select("ns", "doc_id", "status")


def limited_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether there is any eligible failure, and up to ten orders."""
    return any_of(eligible(_failures(spark, sf_dir))).withColumn("what", F.lit("eligible")).union(any_of(source(spark, sf_dir), 10).withColumn("what", F.lit("orders")))


def missing_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _pair(spark, sf_dir)
    return s.select("o_orderkey").join(t.select("o_orderkey"), "o_orderkey", "left_anti")


def orphan_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, t = _pair(spark, sf_dir)
    return t.select("o_orderkey").join(s.select("o_orderkey"), "o_orderkey", "left_anti")


def ghost_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def field_mismatch_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields that differ, with both values as text, for keys with one copy on each side."""
    s, t = _pair(spark, sf_dir)
    fields = ("o_custkey", "o_orderstatus", "o_orderpriority")
    one = t.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("copies"), F.first("o_totalprice").alias("t_price"), *(F.first(c).cast("string").alias(f"t_{c}") for c in fields)).where("copies = 1")
    both = s.join(one, "o_orderkey")
    pairs = [F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("source"), F.col(f"t_{c}").alias("target")) for c in fields]
    cents = lambda c: F.round(F.col(c) * 100).cast("long").cast("string")
    pairs.append(F.struct(F.lit("o_totalprice").alias("field"), cents("o_totalprice").alias("source"), cents("t_price").alias("target")))
    return both.select("o_orderkey", F.explode(F.array(*pairs)).alias("d")).select("o_orderkey", "d.*").where("NOT (source <=> target)")


def repair_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(*_pair(spark, sf_dir), "o_orderkey").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


def validate_scan_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source's keys in batches of 100 with the outcomes of each batch."""
    s, t = _pair(spark, sf_dir)
    outcome = compare(s, t, "o_orderkey")
    return numbered(outcome.where("outcome <> 'orphan'"), "o_orderkey").groupBy(F.floor((F.col("rn") - 1) / 100).alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("outcome") == "valid").alias("n_valid"))


def validate_scan_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's keys that the source lacks, in batches of 100."""
    return numbered(orphan_docs(spark, sf_dir).distinct(), "o_orderkey").select("o_orderkey", F.floor((F.col("rn") - 1) / 100).alias("batch"))


def failures_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir)


def eligible_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return eligible(_failures(spark, sf_dir), 1).select("ns", "doc_id", "status")


def failures_by_ns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures(spark, sf_dir).groupBy("ns").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("doc_id")), ",").alias("doc_ids"))


def retry_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failed keys in chunks of 100."""
    failed = compare(*_pair(spark, sf_dir), "o_orderkey").where("outcome <> 'valid'")
    return numbered(failed, "o_orderkey").groupBy(F.floor((F.col("rn") - 1) / 100).alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def sweep_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep(frame(spark, "sweeps", sf_dir))


def validation_stats_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics after a validation run, added to those before it."""
    now = compare(*_pair(spark, sf_dir), "o_orderkey").select(F.lit("shop.orders").alias("ns"), (F.col("outcome") != "valid").cast("long").alias("bad"))
    new = now.groupBy("ns").agg(F.count(F.lit(1)).alias("total_checked"), F.sum("bad").alias("mismatch_found"), F.sum("bad").alias("mismatch_fixed"))
    return frame(spark, "stats", sf_dir).unionByName(new).groupBy("ns").agg(*(F.sum(c).cast("long").alias(c) for c in ("total_checked", "mismatch_found", "mismatch_fixed")))


def validation_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile(frame(spark, "audit", sf_dir), _failures(spark, sf_dir), frame(spark, "stats", sf_dir))


def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return totals(frame(spark, "stats", sf_dir), _failures(spark, sf_dir))


QUERIES = {f.__name__: f for f in (validate_diff, validate_outcomes, missing_docs, orphan_docs, ghost_docs, field_mismatch_detail, repair_target, validate_scan_source, validate_scan_orphans, failures_fold, eligible_failures, failures_by_ns, retry_chunks, sweep_decision, validation_stats_rollup, validation_reconcile, validation_totals, validate_keys, failures_untouched, limited_counts)}
COMPARED = f"""{TARGET}, g AS (SELECT o_orderkey, count(*) AS copies, any_value(o_custkey) AS c, any_value(o_orderstatus) AS s, any_value(o_totalprice) AS p, any_value(o_orderdate) AS d, any_value(o_orderpriority) AS r FROM tgt GROUP BY o_orderkey),
        v AS (SELECT coalesce(o.o_orderkey, g.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'orphan' WHEN g.o_orderkey IS NULL THEN 'missing' WHEN copies > 1 THEN 'ghost'
        WHEN (o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority) IS NOT DISTINCT FROM (c, s, p, d, r) THEN 'valid' ELSE 'mismatch' END AS outcome, coalesce(copies, 0) AS copies FROM orders o FULL JOIN g ON o.o_orderkey = g.o_orderkey)"""
_FAILURES = """g AS (SELECT *, coalesce(max(CASE WHEN op = 'delete' THEN seq END) OVER (PARTITION BY ns, doc_id), -1) AS gone FROM outcome_ops), l AS (SELECT *, CASE WHEN status = 'hot_key_waiting' THEN 3 WHEN status IN ('batch_failed', 'healed_pending_verify') THEN 0 END AS sets FROM g WHERE op = 'upsert' AND seq > gone),
        m AS (SELECT *, coalesce(max(CASE WHEN sets IS NOT NULL THEN seq END) OVER (PARTITION BY ns, doc_id), -1) AS set_at FROM l),
        failures AS (SELECT ns, doc_id, arg_max(status, seq) AS status, (coalesce(max(CASE WHEN seq = set_at THEN sets END), 0) + count(*) FILTER (seq > set_at))::BIGINT AS retry_count, min(seq) AS first_seq FROM m GROUP BY ns, doc_id)"""
_V = "WITH " + COMPARED
SQL = {
    "validate_diff": _V + """ SELECT o_orderkey, outcome, copies, CASE WHEN outcome = 'valid' THEN 'valid' WHEN o_orderkey % 101 = 0 THEN 'manual_validation_required' ELSE 'healed_pending_verify' END AS status,
        CASE outcome WHEN 'ghost' THEN 'ghost_fixed' WHEN 'missing' THEN 'missing_target_fixed' WHEN 'mismatch' THEN 'content_mismatch_fixed' WHEN 'orphan' THEN 'orphan_deleted' END AS action FROM v""",
    "validate_outcomes": _V + " SELECT outcome, count(*) AS n FROM v GROUP BY outcome",
    "missing_docs": f"WITH {TARGET} SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM tgt)",
    "orphan_docs": f"WITH {TARGET} SELECT o_orderkey FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)",
    "ghost_docs": "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1",
    "field_mismatch_detail": f"""WITH {TARGET}, one AS (SELECT o_orderkey, any_value(o_custkey) AS c, any_value(o_orderstatus) AS s, any_value(o_totalprice) AS p, any_value(o_orderpriority) AS r FROM tgt GROUP BY o_orderkey HAVING count(*) = 1), b AS (SELECT * FROM orders JOIN one USING (o_orderkey)),
        d AS (SELECT o_orderkey, 'o_custkey' AS field, o_custkey::VARCHAR AS source, c::VARCHAR AS target FROM b UNION ALL SELECT o_orderkey, 'o_orderstatus', o_orderstatus, s FROM b UNION ALL SELECT o_orderkey, 'o_orderpriority', o_orderpriority, r FROM b
        UNION ALL SELECT o_orderkey, 'o_totalprice', round(o_totalprice * 100)::BIGINT::VARCHAR, round(p * 100)::BIGINT::VARCHAR FROM b) SELECT * FROM d WHERE source IS DISTINCT FROM target""",
    "repair_target": "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders",
    "validate_scan_source": _V + ", n AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch FROM v WHERE outcome <> 'orphan') SELECT batch, count(*) AS n, count(*) FILTER (outcome = 'valid') AS n_valid FROM n GROUP BY batch",
    "validate_scan_orphans": f"WITH {TARGET}, o AS (SELECT DISTINCT o_orderkey FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch FROM o",
    "failures_fold": cte("outcome_ops") + f", {_FAILURES} SELECT * FROM failures",
    "eligible_failures": cte("outcome_ops") + f", {_FAILURES} SELECT ns, doc_id, status FROM failures WHERE status <> 'manual_validation_required' AND retry_count <= 1",
    "failures_by_ns": cte("outcome_ops") + f", {_FAILURES} SELECT ns, count(*) AS n, string_agg(doc_id, ',' ORDER BY doc_id) AS doc_ids FROM failures GROUP BY ns",
    "retry_chunks": _V + ", n AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS chunk FROM v WHERE outcome <> 'valid') SELECT chunk, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM n GROUP BY chunk",
    "sweep_decision": cte("sweeps") + "SELECT no, CASE WHEN since_s >= 300 THEN 'forced' WHEN idle_s > 5 AND lag_s < 1 AND since_s > 15 THEN 'idle' ELSE 'none' END AS sweep FROM sweeps",
    "validation_stats_rollup": cte("stats") + f""", {COMPARED}, u AS (SELECT * FROM stats UNION ALL SELECT 'shop.orders', count(*), count(*) FILTER (outcome <> 'valid'), count(*) FILTER (outcome <> 'valid') FROM v)
        SELECT ns, sum(total_checked)::BIGINT AS total_checked, sum(mismatch_found)::BIGINT AS mismatch_found, sum(mismatch_fixed)::BIGINT AS mismatch_fixed FROM u GROUP BY ns""",
    "validation_reconcile": cte("outcome_ops", "audit", "stats") + f""", {_FAILURES}, n AS (SELECT ns FROM audit WHERE action IN ('ghost_fixed', 'missing_target_fixed', 'orphan_deleted', 'content_mismatch_fixed') UNION SELECT ns FROM failures UNION SELECT ns FROM stats),
        r AS (SELECT ns, coalesce((SELECT total_checked FROM stats s WHERE s.ns = n.ns), 0)::BIGINT AS checked, (SELECT count(*) FROM audit a WHERE a.ns = n.ns AND action IN ('ghost_fixed', 'missing_target_fixed', 'orphan_deleted', 'content_mismatch_fixed')) AS fixed, (SELECT count(*) FROM failures f WHERE f.ns = n.ns) AS pending FROM n)
        SELECT *, fixed + pending AS found FROM r""",
    "validation_totals": cte("outcome_ops", "stats") + f""", {_FAILURES}, t AS (SELECT coalesce(sum(total_checked), 0)::BIGINT AS total_checked, coalesce(sum(mismatch_found), 0)::BIGINT AS mismatch_found, coalesce(sum(mismatch_fixed), 0)::BIGINT AS mismatch_fixed FROM stats),
        p AS (SELECT count(*) AS pending FROM failures WHERE status NOT IN ('valid', 'manual_validation_required')) SELECT *, round(CASE WHEN total_checked > 0 THEN (total_checked - pending) / total_checked::DOUBLE * 100 ELSE 0.0 END, 6) AS sync_percent FROM t, p""",
}
SQL |= {
    "validate_keys": _V + " SELECT k AS o_orderkey, CASE WHEN k IS NULL THEN 'error' ELSE coalesce(outcome, 'valid') END AS outcome FROM (SELECT DISTINCT l_orderkey + 3 AS k FROM lineitem UNION ALL SELECT NULL) LEFT JOIN v ON k = o_orderkey",
    "failures_untouched": cte("outcome_ops", "touched") + f", {_FAILURES} SELECT ns, doc_id, status FROM failures f WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.ns = f.ns AND t.doc_id = f.doc_id)",
    "limited_counts": cte("outcome_ops") + f", {_FAILURES} SELECT least(count(*), 1) AS n, 'eligible' AS what FROM failures WHERE status <> 'manual_validation_required' UNION ALL SELECT least(count(*), 10), 'orders' FROM orders",
}

"""Validation as a closed loop over stored tables: compare, repair, look again, until nothing is left to do.

A round compares source and target for the keys it is given and writes the verdicts down; then it repairs. Between both the target may move on, so a repair reads
the target again and goes by what it meets: a row that was to be deleted and is gone means that the repair failed and a person has to look; a row that
was to be inserted and is there already is as good as inserted. What was repaired is not trusted either: it stays in the table of failures until a
later round finds it valid. A change that touches a failed key takes it out of the table, and the key is looked at anew.

Outcomes go to a keyed table of failures: a valid key leaves it; retries are counted from the last status that sets them (0 after a repair).
Every repair is appended to an audit; checks, failures found and failures that went are added up by namespace.

Cases: a null key cannot be repaired and is an error; keys that neither side has are valid; copies of one key in the target are deleted together; an empty side is a side like any
other; a run that is lost between two commits is found again as failures that the next round looks at.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import source, target
from tidemark.operators.validation import ACTIONS, COMPARED, MANUAL, compare
from tidemark.shared import discard, shared_dir, written
from tidemark.tables import KeyedTable

FAILURES = "ns string, key long, status string, retry_count long, since long"
STATS = "ns string, total_checked long, mismatch_found long, mismatch_fixed long"


class Validation:
    """The loop over one collection; all its tables are kept under ``path`` and found there again."""

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str, ns: str, buckets: int = 16):
        self.spark, self.path, self.key, self.ns = spark, path, key, ns
        self.target = KeyedTable(spark, f"{path}/target", schema, (key,), buckets)
        self.failures = KeyedTable(spark, f"{path}/failures", FAILURES, ("ns", "key"), buckets)
        self.stats = KeyedTable(spark, f"{path}/stats", STATS, ("ns",), 1)

    def check(self, src: DataFrame, keys: DataFrame | None = None) -> DataFrame:
        """(key, outcome, copies) of all keys or those asked for, written down."""
        tgt = self.target.rows()
        if keys is None:
            return written(compare(src, tgt, self.key), "verdicts")
        asked = keys.select(F.col(keys.columns[0]).alias(self.key)).distinct()
        found = compare(src.join(asked, self.key, "left_semi"), tgt.join(asked, self.key, "left_semi"), self.key)
        both = asked.join(found.withColumnRenamed(self.key, "_key"), F.col(self.key) == F.col("_key"), "left")
        outcome = F.when(F.col(self.key).isNull(), "error").otherwise(F.coalesce("outcome", F.lit("valid")))
        return written(both.select(self.key, outcome.alias("outcome"), F.coalesce("copies", F.lit(0)).alias("copies")), "verdicts")

    def repair(self, src: DataFrame, verdicts: DataFrame, number: int) -> DataFrame:
        """Repairs by ``verdicts`` and what the target holds now: (key, outcome, status), written down; the tables follow."""
        key = self.key
        bad = verdicts.where("outcome NOT IN ('valid', 'error')")
        now = self.target.rows().join(bad.select(key), key, "left_semi").groupBy(key).agg(F.count(F.lit(1)).alias("met"))
        met = bad.join(now, key, "left").withColumn("met", F.coalesce("met", F.lit(0)))
        lost = F.when(F.col("outcome") == "missing", F.lit(False)).otherwise(F.col("met") < F.col("copies"))
        met = written(met.withColumn("failed", lost), "repairs")
        # what is rewritten: not where there is nothing to delete, or the row is there already
        goes = met.where("(outcome = 'missing' AND met = 0) OR outcome IN ('ghost', 'orphan') OR (outcome = 'mismatch' AND met > 0)")
        self.target.replace(goes.select(key), src.join(goes.where("outcome <> 'orphan'").select(key), key, "left_semi"))
        done = F.when(F.col("failed"), MANUAL).otherwise("healed_pending_verify")
        rest = verdicts.where("outcome IN ('valid', 'error')").select(key, "outcome", F.col("outcome").alias("status"))
        results = written(met.select(key, "outcome", done.alias("status")).union(rest), "outcomes")
        discard(met)
        self._record(results, number)
        return results

    def _record(self, results: DataFrame, number: int) -> None:
        rows = results.select(F.lit(self.ns).alias("ns"), F.col(self.key).cast("long").alias("key"), "outcome", "status")
        known = self.failures.rows().select(F.col("ns").alias("_ns"), F.col("key").alias("_key"), "retry_count", "since")
        both = rows.join(known, (F.col("ns") == F.col("_ns")) & F.col("key").eqNullSafe(F.col("_key")), "left")
        sets = F.when(F.col("status") == "healed_pending_verify", 0).otherwise(F.coalesce("retry_count", F.lit(0)) + 1).cast("long")
        both = written(both.select("ns", "key", "outcome", "status", sets.alias("retry_count"), F.coalesce("since", F.lit(number)).cast("long").alias("since"), F.col("_ns").isNotNull().alias("was")), "failures")
        keeps = F.col("status") != "valid"
        n = both.agg(F.count(F.lit(1)).alias("total_checked"), F.count_if(keeps & ~F.col("was")).alias("mismatch_found"), F.count_if(~keeps & F.col("was")).alias("mismatch_fixed"))
        self.failures.replace(both.where(keeps | F.col("was")).select("ns", "key"), both.where(keeps))
        action = F.create_map(*(F.lit(x) for pair in ACTIONS.items() for x in pair))
        both.where("status = 'healed_pending_verify'").select("ns", "key", F.try_element_at(action, F.col("outcome")).alias("action"), F.lit(number).alias("round")).write.mode("append").parquet(f"{self.path}/audit")
        added = n.select(F.lit(self.ns).alias("ns"), "*").unionByName(self.stats.rows()).groupBy("ns").agg(*(F.sum(c).alias(c) for c in ("total_checked", "mismatch_found", "mismatch_fixed")))
        added = written(added, "stats")
        self.stats.replace(added.select("ns"), added)
        discard(added)
        discard(both)

    def round(self, src: DataFrame, number: int, keys: DataFrame | None = None, meanwhile=None) -> DataFrame:
        """One round: (key, outcome, status). ``meanwhile`` is called between the comparison and the repair."""
        verdicts = self.check(src, keys)
        if meanwhile is not None:
            meanwhile()
        results = self.repair(src, verdicts, number)
        discard(verdicts)
        return results

    def eligible(self) -> DataFrame:
        """The keys that a round can do something for."""
        return self.failures.rows().where(f"status <> '{MANUAL}'").select("key")

    def change(self, keys: DataFrame, rows: DataFrame) -> None:
        """A change of the target from outside: ``rows`` replace all rows of ``keys``, whose failures are void."""
        keys = written(keys, "changed")  # both tables read them
        self.target.replace(keys, rows)
        self.failures.replace(keys.select(F.lit(self.ns).alias("ns"), F.col(keys.columns[0]).cast("long").alias("key")), self.spark.createDataFrame([], FAILURES))
        discard(keys)

    def until_quiet(self, src: DataFrame, first: int, keys: DataFrame | None = None, meanwhile=None, most: int = 20) -> list[tuple[int, DataFrame]]:
        """Rounds from number ``first`` on until no failure is left that a round can do something for, or a round changes nothing."""
        done, number, before = [], first, None
        while True:
            done.append((number, self.round(src, number, keys, meanwhile)))
            left = sorted(((r["ns"], r["status"], r["n"]) for r in self.failures.rows().groupBy("ns", "status").agg(F.count(F.lit(1)).alias("n")).collect()))
            if self.eligible().isEmpty() or left == before or len(done) == most:
                return done
            keys, meanwhile, before, number = self.eligible(), None, left, number + 1


def _loop(spark: SparkSession, sf_dir: str) -> tuple[Validation, list[tuple[int, DataFrame]]]:
    """Orders against their flawed copy. While the first round repairs, a change stream deletes some of the rows that are to go and inserts some that are
    missing; later it deletes some of the keys that failed once more, which are then looked at again."""
    src, tgt = source(spark, sf_dir), target(spark, sf_dir)
    schema = ", ".join(f"{n} {t}" for n, t in src.dtypes)
    loop = Validation(spark, f"{shared_dir(spark)}/validation-{uuid.uuid4().hex}", schema, "o_orderkey", "shop.orders")
    loop.target.replace(tgt.select("o_orderkey"), tgt)
    k = F.col("o_orderkey")

    def meanwhile() -> None:
        copies = tgt.groupBy("o_orderkey").agg(F.count(F.lit(1)).alias("c"))
        gone = copies.where(((k >= 1_000_000_000) & ((k - 1_000_000_000) % 46 == 0)) | ((k < 1_000_000_000) & (F.col("c") == 1) & (k % 38 == 0)) | ((F.col("c") > 1) & (k % 58 == 0))).select("o_orderkey")
        there = src.where((k % 34 == 0) & (k % 29 != 0))
        loop.change(gone.union(there.select("o_orderkey")), there)

    done = loop.until_quiet(src, 0, meanwhile=meanwhile)
    again = loop.failures.rows().where(f"status = '{MANUAL}' AND key % 76 = 0").select(F.col("key").alias("o_orderkey"))
    again = written(again, "touched")
    loop.change(again, src.limit(0))
    return loop, done + loop.until_quiet(src, done[-1][0] + 1, keys=again)


def validation_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each round found and did for each key."""
    rounds = [rows.select(F.lit(n).alias("round"), "o_orderkey", "outcome", "status") for n, rows in _loop(spark, sf_dir)[1]]
    out = rounds[0]
    for r in rounds[1:]:
        out = out.union(r)
    return out


def validation_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left after the rounds: the keys that need a person, and how many rows of the target still differ from the source."""
    loop, _ = _loop(spark, sf_dir)
    differs = compare(source(spark, sf_dir), loop.target.rows(), "o_orderkey").where("outcome <> 'valid'").groupBy(F.col("o_orderkey").alias("key")).agg(F.first("outcome").alias("now"))
    return loop.failures.rows().join(differs, "key", "left").select("ns", "key", "status", "retry_count", "since", F.coalesce("now", F.lit("valid")).alias("now"))


QUERIES = {"validation_rounds": validation_rounds, "validation_left": validation_left}
_ROUNDS = f"""WITH {COMPARED}, a AS (SELECT o_orderkey AS k, outcome, outcome = 'orphan' AND (o_orderkey - 1000000000) % 46 = 0 OR outcome = 'mismatch' AND o_orderkey % 38 = 0 OR outcome = 'ghost' AND o_orderkey % 58 = 0 AS lost FROM v),
        r0 AS (SELECT 0 AS round, k, outcome, CASE WHEN outcome = 'valid' THEN 'valid' WHEN lost THEN 'manual_validation_required' ELSE 'healed_pending_verify' END AS status FROM a), r1 AS (SELECT 1, k, 'valid', 'valid' FROM r0 WHERE status = 'healed_pending_verify'),
        t AS (SELECT * FROM r0 WHERE status LIKE 'manual%' AND k % 76 = 0), r2 AS (SELECT 2, k, CASE WHEN k >= 1000000000 THEN 'valid' ELSE 'missing' END, CASE WHEN k >= 1000000000 THEN 'valid' ELSE 'healed_pending_verify' END FROM t), r3 AS (SELECT 3, k, 'valid', 'valid' FROM t WHERE k < 1000000000)"""
SQL = {
    "validation_rounds": _ROUNDS + ", e AS (SELECT * FROM r0 UNION ALL SELECT * FROM r1 UNION ALL SELECT * FROM r2 UNION ALL SELECT * FROM r3) SELECT round, k AS o_orderkey, outcome, status FROM e",
    "validation_left": _ROUNDS + " SELECT 'shop.orders' AS ns, k AS key, status, 1::BIGINT AS retry_count, 0::BIGINT AS since, CASE outcome WHEN 'mismatch' THEN 'missing' ELSE 'valid' END AS now FROM r0 WHERE status LIKE 'manual%' AND k % 76 <> 0",
}

"""Keys with changes in flight, tracked on a stream by session windows of each key.

A change makes its key (namespace and id) dirty; the key is clean again when no change has come for ``quiet`` milliseconds. Checks of a key fall due every
``retry`` milliseconds from its first change on and are skipped while it is dirty; a key that is still dirty after ``most`` of them waits as a hot key
until it is clean. What is reported is a run of changes with no longer gap: when it began and ended, its changes, the checks that were skipped, and
whether it had to wait.

State holds the runs of a key that are not over, usually one; a change that comes late, within the watermark, may join two of them. A run is reported once, when
the watermark passes the moment when its key is clean. A change so late that its key would be clean by the watermark is dropped; one that is less late begins a run of
its own if the run that it belonged to is reported already.

Cases: null namespaces and ids are keys like any other; changes without a time are passed over; repeated changes count each; an empty stream reports nothing; runs that
are not over when the stream stops are reported by a later start.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import shared_dir

QUIET_MS, RETRY_MS, MOST_RETRIES, LATE = 90_000, 30_000, 3, "10 minutes"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
RUN = "ns string, doc_id long, first_ms long, last_ms long, n long, skipped long, outcome string"


def joined(runs: list[tuple[int, int, int]], quiet: int) -> list[tuple[int, int, int]]:
    """Runs (first, last, n) with those united between which no key would have been clean: the rule that the windows follow."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(runs):
        if out and first - out[-1][1] < quiet:
            out[-1] = (out[-1][0], max(out[-1][1], last), out[-1][2] + n)
        else:
            out.append((first, last, n))
    return out


def dirty_runs(changes: DataFrame, late: str = LATE, quiet: int = QUIET_MS, retry: int = RETRY_MS, most: int = MOST_RETRIES) -> DataFrame:
    """The runs of a stream of changes (ns, doc_id, ts). A run is a session of its key whose gap is the last millisecond before ``quiet``; two more milliseconds of
    lateness make it be reported when the watermark of ``late`` lies behind the moment when the key is clean."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = changes.where("ts IS NOT NULL").select("ns", "doc_id", ms.alias("ms"), F.timestamp_millis(ms).alias("ts")).withWatermark("ts", f"{late} 2 milliseconds")
    runs = rows.groupBy("ns", "doc_id", F.session_window("ts", f"{quiet - 1} milliseconds")).agg(F.min("ms").alias("first_ms"), F.max("ms").alias("last_ms"), F.count(F.lit(1)).alias("n"))
    tried = F.expr(f"(last_ms + {quiet} - first_ms - 1) div {retry}")  # checks at first + retry, first + 2 retry, ... before it is clean
    outcome = F.when(tried >= most, "hot_key_waiting").otherwise("checked")
    return runs.select("ns", "doc_id", "first_ms", "last_ms", "n", F.least(tried, F.lit(most)).cast("long").alias("skipped"), outcome.alias("outcome"))


def track(changes: DataFrame, path: str, **settings) -> DataFrame:
    """Runs all that is available of ``changes`` and gives the runs reported so far; those and the state are kept under ``path``."""
    spark = changes.sparkSession
    name, held = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass", None)
    spark.conf.set(name, ROCKSDB)
    try:
        query = dirty_runs(changes, **settings).writeStream.format("parquet").option("path", f"{path}/runs").option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        spark.conf.set(name, held) if held else spark.conf.unset(name)
    return spark.read.schema(RUN).parquet(f"{path}/runs")


def dirty_key_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which keys of the whole event stream were dirty, from when to when, by session windows."""
    events = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events*.parquet")
    rows = events.select(F.concat(F.lit("shop.c"), (F.col("user_id") % 5).cast("string")).alias("ns"), F.col("user_id").alias("doc_id"), "ts")
    return track(rows, f"{shared_dir(spark)}/dirty-{uuid.uuid4().hex}", quiet=_QUIET, retry=_RETRY)


#: The events of a key are hours apart.
_QUIET, _RETRY = 3 * 3_600_000, 3_600_000
QUERIES = {"dirty_key_runs": dirty_key_runs}
SQL = {
    "dirty_key_runs": f"""WITH e AS (SELECT 'shop.c' || (user_id % 5) AS ns, user_id AS doc_id, floor(epoch_us(ts) / 1000)::BIGINT AS ms FROM events), m AS (SELECT max(ms) - 600000 AS seen FROM e),
        g AS (SELECT *, CASE WHEN ms - lag(ms) OVER (PARTITION BY ns, doc_id ORDER BY ms) < {_QUIET} THEN 0 ELSE 1 END AS new FROM e), r AS (SELECT *, sum(new) OVER (PARTITION BY ns, doc_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS run FROM g),
        s AS (SELECT ns, doc_id, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS n FROM r GROUP BY ns, doc_id, run), k AS (SELECT *, (last_ms + {_QUIET} - first_ms - 1) // {_RETRY} AS tried FROM s, m WHERE last_ms + {_QUIET} < seen)
        SELECT ns, doc_id, first_ms, last_ms, n, least(tried, {MOST_RETRIES})::BIGINT AS skipped, CASE WHEN tried >= {MOST_RETRIES} THEN 'hot_key_waiting' ELSE 'checked' END AS outcome FROM k""",
}

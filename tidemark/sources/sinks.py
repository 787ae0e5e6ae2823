"""What jobs leave behind: appended rows, the status record and the operation log, in any store that Spark writes to."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import cte, frame, source, table
from tidemark.shared import Folder, shared_dir


def append(rows: DataFrame, path: str) -> None:
    """Rows added to a table without a look at what it holds; loads that may meet keys again go through ``upsert``."""
    rows.write.mode("append").parquet(path)


class Status:
    """One record of fields and values, saved whole and merged on load: a field that was saved without a value keeps the one it had."""

    def __init__(self, spark: SparkSession, path: str):
        self.folder = Folder(spark, path)

    def load(self) -> dict:
        return json.loads(self.folder.read("status.json")) if "status.json" in self.folder.names() else {}

    def save(self, fields: dict) -> dict:
        merged = self.load() | {name: value for name, value in fields.items() if value is not None}
        self.folder.write("status.json", json.dumps(merged, sort_keys=True))
        return merged

    def delete(self) -> None:
        self.folder.delete("status.json")


def log_operations(batches: DataFrame, path: str) -> None:
    """Batches (kind, docs, ...) as JSON lines; change batches that wrote nothing leave no line."""
    batches.where(~((F.col("kind") == "cdc") & (F.col("docs") == 0))).write.mode("append").json(path)


def append_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table loaded in two parts, read back."""
    path, rows = f"{shared_dir(spark)}/appended-{uuid.uuid4().hex}", source(spark, sf_dir)
    for part in (0, 1):
        append(rows.where(F.col("o_orderkey") % 2 == part), path)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice")


def status_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status after each of three saves, with the sizes of tables as figures."""
    status, seen = Status(spark, f"{shared_dir(spark)}/status-{uuid.uuid4().hex}"), []
    docs = [table(spark, sf_dir, name).count() for name in ("orders", "lineitem", "events")]
    for n, fields in enumerate(({"state": "copying", "docs": docs[0]}, {"state": None, "docs": docs[1]}, {"state": "streaming", "lag": docs[2]}), 1):
        status.save(fields)
        seen.append((n, *(status.load().get(k) for k in ("state", "docs", "lag"))))
    return spark.createDataFrame(seen, "step int, state string, docs long, lag long")


def oplog_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_dir(spark)}/oplog-{uuid.uuid4().hex}"
    log_operations(frame(spark, "oplog", sf_dir).select("no", "kind", "worker", "docs", "byte_size"), path)
    return spark.read.schema("no int, kind string, worker int, docs int, byte_size int").json(path)


QUERIES = {f.__name__: f for f in (append_insert, status_merge, oplog_lines)}
SQL = {
    "append_insert": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "status_merge": "SELECT 1 AS step, 'copying' AS state, (SELECT count(*) FROM orders) AS docs, NULL::BIGINT AS lag UNION ALL SELECT 2, 'copying', (SELECT count(*) FROM lineitem), NULL UNION ALL SELECT 3, 'streaming', (SELECT count(*) FROM lineitem), (SELECT count(*) FROM events)",
    "oplog_lines": cte("oplog") + "SELECT no, kind, worker, docs, byte_size FROM oplog WHERE NOT (kind = 'cdc' AND docs = 0)",
}

"""The verbs of the library in one place, with their settings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import replay, validation
from tidemark.operators.rounds import Validation
from tidemark.plans import health, splits
from tidemark.sources import discovery, snapshot
from tidemark.sources.segments import SegmentCopy
from tidemark.streaming.apply import StateTable, apply_log, apply_stream, documents


@dataclass(frozen=True)
class Config:
    """Settings; the defaults are the usual ones."""

    excluded_dbs: tuple[str, ...] = ("admin", "local", "config")
    segment_docs: int = 10_000
    batch_docs: int = 1000
    batch_bytes: int = 16 << 20
    cdc_batch: int = 1000
    cdc_workers: int = 4
    max_retries: int = 3
    forced_sweep_s: float = 300
    idle_poll_s: float = 5
    queue_size: int = 2000
    latency_ms: int = 250
    max_queued: int = 50
    max_clients: int = 20
    min_tickets: int = 0


class Engine:
    """Copies, replays, compares and repairs keyed collections that are DataFrames."""

    def __init__(self, spark: SparkSession, config: Config = Config()):  # noqa: B008
        self.spark, self.config = spark, config

    def discover(self, catalog: DataFrame, excluded_ns: DataFrame) -> DataFrame:
        return discovery.collections(catalog, excluded_ns, self.config.excluded_dbs)

    def plan_snapshot(self, rows: DataFrame, key: str) -> DataFrame:
        return snapshot.segment_plan(rows, key, self.config.segment_docs)

    def snapshot(self, rows: DataFrame, target: DataFrame | None, key: str) -> DataFrame:
        """The target after a full copy: loaded rows replace all copies of their keys."""
        return rows if target is None else snapshot.upsert(target, rows, key)

    def apply_changes(self, log: DataFrame) -> DataFrame:
        """The documents after a log of any fields; see :mod:`tidemark.operators.replay` for its columns."""
        return replay.fold(log)

    def apply_stream(self, log: DataFrame, path: str, start: tuple[int, int] | None = None) -> DataFrame:
        """Applies what a streaming log offers and gives the documents; state and offsets are kept under ``path`` and found there again."""
        state = StateTable(self.spark, f"{path}/state")
        apply_stream(log, state, f"{path}/offsets", start)
        return documents(state)

    def apply_log(self, log_path: str, path: str, start: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
        """Applies a change log in files up to its end, from ``start`` or where an earlier call stopped; gives the documents and what each batch did."""
        state = StateTable(self.spark, f"{path}/state")
        apply_log(log_path, state, f"{path}/offsets", start, self.config.cdc_batch * self.config.cdc_workers)
        return documents(state), state.feed()

    def copy(self, rows: DataFrame, path: str, key: str) -> DataFrame:
        """Copies a collection in key ranges under ``path`` and gives the copy; a copy that was lost goes on."""
        made = SegmentCopy(self.spark, path, key, self.config.segment_docs)
        made.run(rows)
        return made.copied()

    def batches(self, rows: DataFrame, key: str, size: str) -> DataFrame:
        """Insert batches by documents and bytes."""
        return snapshot.pack_by_bytes(rows, key, size, self.config.batch_docs, self.config.batch_bytes)

    def validation(self, path: str, schema: str, key: str, ns: str) -> Validation:
        """The loop of rounds over a target that is kept under ``path``."""
        return Validation(self.spark, path, schema, key, ns)

    def validate(self, source: DataFrame, target: DataFrame, key: str) -> DataFrame:
        return validation.with_status(validation.compare(source, target, key))

    def repair(self, source: DataFrame, target: DataFrame, key: str) -> DataFrame:
        return validation.repair(source, target, key)

    def failures(self, outcomes: DataFrame) -> DataFrame:
        return validation.fold_failures(outcomes, self.config.max_retries)

    def reconcile(self, audit: DataFrame, failures: DataFrame, stats: DataFrame) -> DataFrame:
        return validation.reconcile(audit, failures, stats)

    def plan_splits(self, kind: str, low, high, parts: int) -> list:
        """Points of a range of ``kind`` int64, date, bytes, hash or hex."""
        made = {
            "int64": lambda: splits.split_range(int(low), int(high), parts, 1), "date": lambda: splits.split_date(low, high, parts), "bytes": lambda: splits.split_bytes(low, high, parts),
            "hash": lambda: splits.split_ring(parts), "hex": lambda: list(splits.DIGITS),
        }
        return made[kind]()

    def health(self, samples: DataFrame) -> DataFrame:
        c = self.config
        return health.flow_decision(samples, c.latency_ms, c.max_queued, c.max_clients, c.min_tickets)

    def status(self, stats: DataFrame, failures: DataFrame) -> DataFrame:
        return validation.totals(stats, failures)

    def pending(self, failures: DataFrame) -> DataFrame:
        return validation.eligible(failures).select("ns", F.col("doc_id"))

"""Helpers that every subpackage may use: the shared folder, written tables and salted joins."""

from __future__ import annotations

import gc
import math
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A key is hot from this share of all rows on, so that at most 1 / HOT_SHARE keys are hot, however large the input is.
HOT_SHARE = 1 / 500
#: Cells that a range of values is cut into at a time to find the value at a rank.
CELLS = 1 << 16
#: Bytes of an Arrow batch to a Python worker, about; a longer row is a batch of its own.
BATCH_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``. Only a local session, whose executors see the driver's disk, may
    leave it unset."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = os.path.join(tempfile.gettempdir(), f"tidemark-{os.getpid()}")
        spark.conf.set("spark.checkpoint.dir", top)
    return f"{top.rstrip('/')}/tidemark"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches end by ``BATCH_BYTES``, where the session does not say otherwise. Spark's own end after 10,000 rows: with long texts that is a task's
    whole part, which the executor holds outside its heap while the Python worker holds it as a batch, as texts and as arrays."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


class Folder:
    """Small files and subfolders of a folder in any store that Spark can write to."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._spark, self.path = spark, path
        self._fs = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def names(self) -> list[str]:
        """What lies in the folder; nothing where it does not exist."""
        top = self._path(self.path)
        return [f.getPath().getName() for f in self._fs.listStatus(top)] if self._fs.exists(top) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(f"{self.path}/{name}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all: it is written under another name first."""
        spare, final = self._path(f"{self.path}/.{name}-{uuid.uuid4().hex}"), self._path(f"{self.path}/{name}")
        stream = self._fs.create(spare, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._fs.rename(spare, final):
            self._fs.delete(final, False)
            self._fs.rename(spare, final)

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.path}/{name}"), True)


def discard(table: DataFrame) -> None:
    """Delete a table that :func:`written` or :func:`numbered` gave and that nothing reads any more."""
    top, name = table._written_to.rsplit("/", 1)
    Folder(table.sparkSession, top).delete(name)


def hot_keys(counts: DataFrame, key: str, total: int, share: float = HOT_SHARE) -> DataFrame:
    """From ``counts`` (key, n): the keys with more than ``share`` of ``total`` rows, at most ``1 / share`` of them, and
    in ``n_salts`` the number of parts to deal each to, so that a part holds about ``share`` of all rows."""
    limit = max(1.0, share * total)
    return counts.where(F.col("n") > limit).select(key, F.ceil(F.col("n") / limit).cast("int").alias("n_salts"))


def salted_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame, spread: str, how: str = "left") -> DataFrame:
    """``left`` joined with ``right`` (few rows for a key) on ``key`` where some keys are hot in ``left``.

    ``hot`` comes from :func:`hot_keys`, so it is bounded and broadcast. Rows of ``left`` with a hot key are dealt over its
    parts by the hash of ``spread``; the rows of ``right`` are repeated for each part. No row is lost or repeated.
    Null keys match nothing, as in any equi-join.
    """
    hot = F.broadcast(hot)
    part = F.coalesce(F.pmod(F.xxhash64(spread), F.col("n_salts")).cast("int"), F.lit(0))
    dealt = left.join(hot, key, "left").withColumn("_salt", part).drop("n_salts")
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("n_salts"), F.lit(1)) - 1))
    repeated = right.join(hot, key, "left").withColumn("_salt", copies).drop("n_salts")
    return dealt.join(repeated, [key, "_salt"], how).drop("_salt")


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished jobs now; it waits for the driver's garbage collection."""
    gc.collect()
    spark._jvm.System.gc()


def numbered(df: DataFrame, *order: str, name: str = "rn") -> DataFrame:
    """``df`` with the global row number (from 1) in the order of ``order``, without one task that holds all rows: rows are dealt by
    range, numbered within their part, and shifted by the sizes of the parts before (one row for each part, broadcast)."""
    parts = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mono", F.monotonically_increasing_id())
    held = written(parts, "numbered")
    parts = held.withColumn("_part", F.shiftright("_mono", 33)).withColumn("_at", F.col("_mono").bitwiseAND((1 << 33) - 1))
    sizes = parts.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.withColumn("_shift", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    out = parts.join(F.broadcast(shift), "_part").withColumn(name, F.col("_at") + F.col("_shift") + 1).drop("_mono", "_part", "_at", "_shift")
    out._written_to = held._written_to  # for :func:`discard`
    return out


def value_at(df: DataFrame, column: str, share: float) -> int | None:
    """The value of a whole-number column at the nearest rank (``share`` of all rows, rounded up), nulls last; None where there is none. Exact at every
    size: the cell of the values' range that holds the rank is cut again until it is one value, so a pass gathers so many counts at most."""
    value = F.col(column).cast("long")
    n, low, high = df.agg(F.count(F.lit(1)), F.min(value), F.max(value)).first()
    rank = math.ceil(n * share)
    while low is not None:
        width = max(1, -(-(high - low + 1) // CELLS))
        cell = F.expr(f"(CAST(`{column}` AS BIGINT) - {low}) div {width}").alias("_cell")
        cells = df.where(value.between(low, high)).groupBy(cell).agg(F.count(F.lit(1)).alias("_n"))
        upto = cells.withColumn("_upto", F.sum("_n").over(Window.orderBy("_cell")))  # as many rows as cells
        found = upto.where(F.col("_upto") >= rank).orderBy("_cell").first()
        if found is None or width == 1:
            return None if found is None else low + found["_cell"]
        rank -= found["_upto"] - found["_n"]
        low += found["_cell"] * width
        high = min(high, low + width - 1)
    return None

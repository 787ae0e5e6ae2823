"""A snapshot copy in key ranges that goes on where it was lost.

The plan of segments is written once. Neighbouring segments are copied together in waves, at most ``WAVES`` of them however many segments there are: a wave is one
range of keys, whose bounds reach the Parquet scan, and one job that writes a folder of its own. A wave counts as copied from the moment its small
commit file exists; a folder without one is a lost run and is written again. So a run that starts on the same folder reads only the ranges
that are missing.

A range read skips what the files' statistics exclude, so it pays where the source lies in the order of its keys; :func:`overlap` tells how many waves
a row group meets on average, and for a source in no such order a linear copy reads less.

Cases: null keys belong to the first wave; rows that are added after the plan go with their range; keys are copied with all their rows; an empty source has one empty wave;
extra columns are copied as they are.
"""

from __future__ import annotations

import json
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import source
from tidemark.shared import Folder, shared_dir
from tidemark.sources.snapshot import SEGMENT_DOCS, segment_plan

WAVES = 256


def within(key: str, low, high) -> Column:
    """Whether a key lies in (low, high]; an open lower end takes null keys too."""
    above = F.lit(True) if low is None else F.col(key) > F.lit(low)
    if high is None:
        return above
    return F.col(key).isNull() | (F.col(key) <= F.lit(high)) if low is None else above & (F.col(key) <= F.lit(high))


class SegmentCopy:
    """The copy of one collection under ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, size: int = SEGMENT_DOCS, waves: int = WAVES):
        self.spark, self.path, self.key, self.size, self.most = spark, path, key, size, waves
        self.top, self.commits = Folder(spark, path), Folder(spark, f"{path}/commits")

    def plan(self, rows: DataFrame) -> list[tuple[int, object, object]]:
        """(wave, low, high) of all waves, ``waves`` at most; made from ``rows`` at the first call and read from the folder later."""
        if "planned" not in self.top.names():
            segment_plan(rows, self.key, self.size).write.mode("overwrite").parquet(f"{self.path}/plan")
            self.top.write("planned", json.dumps({"size": self.size, "waves": self.most}))
        made = json.loads(self.top.read("planned"))  # by the run that began the copy, whatever this one was told
        segments = self.spark.read.parquet(f"{self.path}/plan")
        per = max(1, -(-segments.count() // made["waves"]))
        wave = F.expr(f"segment div {per}").alias("wave")
        ends = segments.groupBy(wave).agg(F.min_by("min_key", "segment").alias("low"), F.max_by("max_key", "segment").alias("high"))
        return [(r["wave"], r["low"], r["high"]) for r in ends.orderBy("wave").collect()]

    def done(self) -> dict[int, int]:
        """The rows of each wave that is copied."""
        return {int(name): json.loads(self.commits.read(name))["n"] for name in self.commits.names() if name.isdigit()}

    def pending(self, rows: DataFrame) -> list[tuple[int, object, object]]:
        copied = self.done()
        return [w for w in self.plan(rows) if w[0] not in copied]

    def read(self, rows: DataFrame, low, high) -> DataFrame:
        """One range of the source."""
        return rows.where(within(self.key, low, high))

    def run(self, rows: DataFrame, at_once: int = 4, most: int | None = None) -> list[int]:
        """Copies the waves that are missing, ``at_once`` side by side and ``most`` of them in this run; gives those that it copied."""

        def copy(wave: tuple[int, object, object]) -> int:
            folder = f"{self.path}/data/wave={wave[0]}"
            self.read(rows, *wave[1:]).write.mode("overwrite").parquet(folder)
            self.commits.write(str(wave[0]), json.dumps({"n": self.spark.read.parquet(folder).count()}))
            return wave[0]

        with ThreadPoolExecutor(at_once) as pool:
            return sorted(pool.map(copy, self.pending(rows)[:most]))

    def copied(self) -> DataFrame:
        """What is copied so far, with the wave; lost runs are not part of it."""
        folders = [f"{self.path}/data/wave={w}" for w in sorted(self.done())]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*folders)


def overlap(rows: DataFrame, copy: SegmentCopy, key: str) -> float:
    """How many waves a file of ``rows`` meets on average, by its least and greatest key: 1 where files and waves follow one order."""
    ends = rows.groupBy(F.col("_metadata.file_path")).agg(F.min(key).alias("least"), F.max(key).alias("greatest"))
    waves = copy.spark.createDataFrame([(w, lo, hi) for w, lo, hi in copy.plan(rows)], f"wave long, low {dict(rows.dtypes)[key]}, high {dict(rows.dtypes)[key]}")
    met = ends.join(F.broadcast(waves), (F.col("low").isNull() | (F.col("greatest") > F.col("low"))) & (F.col("high").isNull() | (F.col("least") <= F.col("high"))))
    return met.groupBy("file_path").count().agg(F.avg("count")).first()[0] or 0.0


def segment_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy that is lost after three of eight waves and goes on."""
    rows, path = source(spark, sf_dir), f"{shared_dir(spark)}/copy-{uuid.uuid4().hex}"
    SegmentCopy(spark, path, "o_orderkey", 999, 8).run(rows, most=3)
    again = SegmentCopy(spark, path, "o_orderkey", 999, 8)
    again.run(rows)
    return again.copied().select("o_orderkey", "o_custkey", "o_totalprice", F.col("wave").cast("long").alias("wave"))


QUERIES = {"segment_copy": segment_copy}
SQL = {
    "segment_copy": "WITH r AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS rn, count(*) OVER () // 1000 + 1 AS segments FROM orders) SELECT o_orderkey, o_custkey, o_totalprice, (rn // 1000) // ((segments + 7) // 8) AS wave FROM r",
}

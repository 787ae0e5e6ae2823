"""Tables in buckets whose versions are committed by one small file.

A row's bucket is the hash of its key; its rows are written by as many tasks as the cores ask for. A change rewrites the buckets that it touches into a
new version's folder and then commits the version by a small file, which names for each bucket the version that holds it. A start finds the last committed version on disk; a folder without its commit file is a lost
run and is written again. Buckets of versions that the last two commits do not refer to are deleted.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.shared import Folder


class Buckets:
    """``version`` is the last whole one, also after a restart on the same path."""

    def __init__(self, spark: SparkSession, path: str, buckets: int, keys: tuple[str, ...]):
        self.spark, self.path, self.buckets, self.keys = spark, path, buckets, keys
        self.commits = Folder(spark, f"{path}/commits")
        found = sorted(int(name) for name in self.commits.names() if name.isdigit())
        self.version = found[-1] if found else None

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _where(self) -> dict[int, int]:
        """The version that holds each bucket."""
        return {} if self.version is None else {int(b): v for b, v in json.loads(self.commits.read(str(self.version))).items()}

    def read(self, buckets: set[int] | None = None) -> DataFrame | None:
        """The rows in all or some buckets; None where there is nothing yet."""
        paths = [f"{self.path}/v{v}/bucket={b}" for b, v in sorted(self._where().items()) if buckets is None or b in buckets]
        return self.spark.read.parquet(*paths) if paths else None

    def touched(self, rows: DataFrame) -> set[int]:
        """The buckets of ``rows``, which are so many numbers at most."""
        return {r[0] for r in rows.select(self.bucket()).distinct().collect()}

    def write(self, rows: DataFrame, version: int) -> set[int]:
        """``rows`` as the buckets of a version that is not committed yet; gives the buckets that have rows."""
        folder = f"{self.path}/v{version}"
        parts = -(-2 * self.spark.sparkContext.defaultParallelism // self.buckets)
        part = F.col("bucket") * parts + F.pmod(F.xxhash64(F.lit(parts), *self.keys), F.lit(parts)).cast("int")
        rows.withColumn("bucket", self.bucket()).repartitionById(self.buckets * parts, part).write.mode("overwrite").partitionBy("bucket").parquet(folder)
        return {int(name.split("=")[1]) for name in Folder(self.spark, folder).names() if name.startswith("bucket=")}

    def commit(self, version: int, touched: set[int], made: set[int]) -> None:
        """From now on the buckets ``touched`` are those of ``version``; those of them that it did not make are empty."""
        where = {b: v for b, v in self._where().items() if b not in touched} | dict.fromkeys(made, version)
        self.commits.write(str(version), json.dumps(where))
        self.version = version
        self._forget(set(where.values()))

    def _forget(self, used: set[int]) -> None:
        """Deletes versions that the last two commits do not refer to."""
        found = sorted(int(name) for name in self.commits.names() if name.isdigit())
        used = used | {v for n in found[-2:] for v in json.loads(self.commits.read(str(n))).values()}
        for n in found[:-2]:
            self.commits.delete(str(n))
        top = Folder(self.spark, self.path)
        for name in top.names():
            if name.startswith("v") and name[1:].isdigit() and int(name[1:]) < self.version and int(name[1:]) not in used:
                top.delete(name)


class KeyedTable(Buckets):
    """Rows by key, several rows of one key if so put. Null keys are keys like any other."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: tuple[str, ...], buckets: int = 16):
        super().__init__(spark, path, buckets, keys)
        self.schema = schema

    def rows(self, buckets: set[int] | None = None) -> DataFrame:
        found = self.read(buckets)
        return self.spark.createDataFrame([], self.schema) if found is None else found

    def replace(self, keys: DataFrame, rows: DataFrame) -> None:
        """All rows of ``keys`` go and ``rows``, whose keys are among them, come; one new version. ``keys`` are read twice, by the buckets they touch and by
        the rows that go, so they should be read from a written table; a table without rows reads none."""
        version, buckets, left = 0 if self.version is None else self.version + 1, set(), self.rows()
        if self._where():
            buckets = self.touched(keys)
            gone = keys.select(*(F.col(k).alias(f"_{k}") for k in self.keys)).distinct()
            match = F.lit(True)
            for k in self.keys:
                match = match & F.col(k).eqNullSafe(F.col(f"_{k}"))
            left = self.rows(buckets).join(gone, match, "left_anti")
        self.commit(version, buckets, self.write(left.unionByName(rows.select(*left.columns)), version))

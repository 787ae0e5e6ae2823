"""Copies in ranges that go on after a loss, what files tell of themselves, and a look at ids of any type."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sources import discovery
from tidemark.sources.segments import SegmentCopy, overlap

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_lost_copy_goes_on(spark, tmp_path):
    path, top = str(tmp_path / "rows"), str(tmp_path / "copy")
    spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("v")).union(spark.sql("SELECT NULL, 'null'")).repartitionByRange(5, "k").write.parquet(path)
    rows = spark.read.parquet(path)
    first = SegmentCopy(spark, top, "k", 49, 8)
    assert first.run(rows, most=3) == [0, 1, 2] and first.copied().count() == sum(first.done().values())
    spark.range(5).write.parquet(f"{top}/data/wave=3")  # a lost run: a folder without its commit
    spark.createDataFrame([(-5, "late"), (5000, "late")], "k long, v string").coalesce(1).write.mode("append").parquet(path)
    rows, again = spark.read.parquet(path), SegmentCopy(spark, top, "k", 7, 99)  # the plan is that of the first run
    assert again.copied().count() == sum(first.done().values())
    for _, low, high in again.plan(rows):
        pushed = plan_of(again.read(rows, low, high)).split("PushedFilters: ")[1].split("]")[0]
        assert (low is None or f"GreaterThan(k,{low})" in pushed) and (high is None or f"LessThanOrEqual(k,{high})" in pushed)
    assert min(again.run(rows)) == 3 and again.run(rows) == []
    got = sorted(((r["k"], r["v"]) for r in again.copied().collect()), key=repr)
    # the key that was added below came after its wave was copied, and is left to the change log
    assert got == sorted([(k, f"v{k}") for k in range(1000)] + [(None, "null"), (5000, "late")], key=repr)
    assert overlap(spark.read.parquet(path).where("k >= 0 AND k < 1000"), again, "k") < 4


def test_an_empty_collection_has_one_empty_wave(spark, tmp_path):
    rows = spark.range(0).withColumnRenamed("id", "k")
    copy = SegmentCopy(spark, str(tmp_path / "copy"), "k", 9)
    assert copy.run(rows) == [0] and copy.done() == {0: 0} and copy.copied().count() == 0


def test_counts_and_keys_come_from_footers(spark):
    rows = discovery.from_footers(spark, f"{SF}/orders.parquet")
    ends = rows.agg(F.count(F.lit(1)), F.min("o_orderkey"), F.max("o_orderkey"))
    assert "PushedAggregation: [COUNT(*), MIN(o_orderkey), MAX(o_orderkey)]" in plan_of(ends)
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_storage_is_what_the_files_take(spark):
    for r in discovery.collection_storage(spark, SF).collect():
        size = os.path.getsize(f"{SF}/{r['coll']}.parquet")
        assert (r["files"], r["bytes"]) == (1, size) and r["n"] == spark.read.parquet(f"{SF}/{r['coll']}.parquet").count() and r["bytes_a_row"] == size // r["n"]


@pytest.mark.parametrize("kind,value", [("long", "9000000000000000000 - id"), ("string", "concat('k', id)"), ("binary", "cast(concat('k', id) as binary)"), ("double", "id / 3"), ("timestamp", "timestamp_millis(id)")])
def test_ids_of_any_type_can_be_probed(spark, kind, value):
    ids = spark.range(2500).select(F.expr(value).alias("key"), F.lit(kind).alias("kind"))
    mixed = ids.union(spark.sql(f"SELECT CAST(NULL AS {kind}), 'void'"))
    for rows, types in ((ids, 1), (mixed, 2)):
        got = {r["part"]: r for r in discovery.probe(rows, "key", F.col("kind"), 1000).collect()}
        assert {p: r["n"] for p, r in got.items()} == {"head": 1000, "tail": 1000, "sample": 1000} and got["head"]["n_types"] == types and got["head"]["safe"] == (types == 1)
    few = discovery.probe(mixed.orderBy("key").limit(5), "key", F.col("kind")).collect()
    assert all(r["safe"] for r in few)

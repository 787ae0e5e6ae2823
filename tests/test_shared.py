"""Salted joins, row numbers, and the engine's verbs."""

import random
from datetime import UTC, datetime

from helpers import bag
from pyspark.sql import functions as F

from tidemark.engine import Config, Engine
from tidemark.operators.cdc import dirty_keys
from tidemark.shared import discard, hot_keys, numbered, salted_join, value_at, written


def test_salted_join_is_a_join(spark):
    rng = random.Random(2)
    left = spark.createDataFrame([(i, 7 if i % 3 else rng.randrange(40)) for i in range(3000)] + [(9999, None)], "i long, k long")
    right = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 1) if k % 4 != 1] + [(7, "second"), (None, "null")], "k long, v string")
    counts = left.groupBy("k").count().withColumnRenamed("count", "n")
    hot = hot_keys(counts, "k", left.count(), 0.1)
    assert [r["k"] for r in hot.collect()] == [7] and hot.first()["n_salts"] == 7
    for how in ("inner", "left"):
        assert bag(salted_join(left, right, "k", hot, "i", how).select("i", "k", "v")) == bag(left.join(right, "k", how).select("i", "k", "v"))


def test_numbers_follow_the_order(spark):
    keys = list(range(0, 1000, 3))
    random.Random(4).shuffle(keys)
    rows = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    assert [(r["rn"], r["k"]) for r in numbered(rows, "k").orderBy("rn").collect()] == list(enumerate(sorted(keys), 1))
    assert numbered(rows.limit(0), "k").count() == 0


def test_written_tables_can_go(spark):
    table = written(spark.range(5).toDF("x"), "test")
    assert table.count() == 5
    discard(table)


def test_engine(spark):
    engine = Engine(spark, Config(segment_docs=9))
    src = spark.createDataFrame([(k, str(k)) for k in range(30)], "k long, v string")
    tgt = spark.createDataFrame([(k, str(k)) for k in range(5, 40)], "k long, v string")
    assert engine.plan_snapshot(src, "k").count() == 4
    assert engine.snapshot(src, tgt, "k").count() == 40 and engine.snapshot(src, None, "k").count() == 30
    assert engine.validate(src, tgt, "k").where("status = 'healed_pending_verify'").count() == 15
    assert bag(engine.repair(src, tgt, "k")) == bag(src)
    assert engine.plan_splits("int64", 0, 100, 4) == [25, 50, 75] and len(engine.plan_splits("hash", None, None, 8)) == 7


def test_the_value_at_a_rank_is_exact_at_every_size(spark):
    rows = spark.range(3_000_000).select((F.col("id") * 7_919 % 3_000_000 * 1000 - 5).alias("t"))
    assert value_at(rows, "t", 0.5) == 1_499_999 * 1000 - 5
    few = spark.createDataFrame([(5,), (-3,), (None,), (5,), (9,), (None,)], "t long")
    assert [value_at(few, "t", s) for s in (0.1, 0.3, 0.5, 0.6, 0.67, 1)] == [-3, 5, 5, 9, None, None]
    assert value_at(few.limit(0), "t", 0.5) is None and value_at(few.where("t IS NULL"), "t", 0.5) is None


def test_changes_without_a_time_count_for_the_middle_of_the_log(spark, tmp_path):
    rows = [(n, datetime.fromtimestamp(100 + n, UTC) if n < 4 else None, n % 2, "view", 0.5, "{}") for n in range(6)]
    spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    assert bag(dirty_keys(spark, str(tmp_path))) == [(1, 1, "shop.c1")]  # after the third of six changes

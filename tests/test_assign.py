"""Rows to chunks by points of several kinds, by halving and by sorting, against bisection."""

import hashlib
import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from tidemark.plans.assign import chunks_of
from tidemark.plans.splits import bound_texts


@pytest.mark.parametrize("held", [1 << 16, 0])
@pytest.mark.parametrize("kind", ["long", "string", "binary"])
def test_chunks_equal_bisection(spark, kind, held):
    rng = random.Random(len(kind))
    make = {"long": lambda: rng.randrange(-50, 50), "string": lambda: "".join(rng.choice("aéz日") for _ in range(rng.randrange(4))), "binary": lambda: bytes(rng.choice([0, 1, 127, 128, 255]) for _ in range(rng.randrange(4)))}[kind]
    order = (lambda v: v.encode()) if kind == "string" else (lambda v: v)
    keys, points = [None, *(make() for _ in range(200))], [make() for _ in range(60)]
    rows = spark.createDataFrame([(i, k, "mine") for i, k in enumerate(keys)], f"i long, key {kind}, _inside string").repartition(3)
    got = {r["i"]: r["chunk"] for r in chunks_of(rows, ["key"], spark.createDataFrame([(p,) for p in points], f"p {kind}"), held=held).collect()}
    places = sorted({order(p) for p in points})
    assert got == {i: 0 if k is None else bisect_right(places, order(k)) for i, k in enumerate(keys)}


@pytest.mark.parametrize("held", [1 << 16, 0])
def test_the_least_key_of_composite_points(spark, held):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", 5), (3, "b", -9), (4, None, 1), (5, "a", 4), (6, None, None)], "i long, x string, y long")
    points = spark.createDataFrame([("a", None), ("a", 5), ("b", None), ("a", 5)], "p string, q long")
    assert {r["i"]: r["chunk"] for r in chunks_of(rows, ["x", "y"], points, held=held).collect()} == {1: 1, 2: 2, 3: 3, 4: 0, 5: 1, 6: 0}
    assert {r["chunk"] for r in chunks_of(rows, ["x", "y"], points.limit(0), held=held).collect()} == {0}
    assert chunks_of(rows.limit(0), ["x", "y"], points, held=held).agg(F.count("*")).first()[0] == 0


def test_bounds_of_rules_are_dealt_over_the_cores(spark):
    """One file of rules with some that have no key, and two with one key: all get their bounds, by more than one task."""
    rules = spark.createDataFrame([(n, ["a", "b", "c"][n % 3], [None, "x:1, y:1", "u:1,o:1,z:hashed"][n // 3 % 3]) for n in range(90)], "rule_no int, strategy string, shard_key string").coalesce(1)
    points = spark.createDataFrame([("a", 1, "7", None, None), ("a", 2, "8", None, None), ("c", 1, None, None, None)], "strategy string, place int, point string, uuid string, oid string")
    got = bound_texts(rules, points, "u", "o")
    want = {(n, p): None if n // 3 % 3 == 0 else ", ".join(f"{f}: {x if i == 0 else 'MinKey'}" for i, f in enumerate([["x", "y"], ["u", "o", "z"]][n // 3 % 3 - 1])) for n in range(90) for p, x in {0: [(1, "7"), (2, "8")], 1: [], 2: [(1, "MinKey")]}[n % 3]}
    assert {(r["rule_no"], r["place"]): r["bound"] for r in got.collect()} == want and got.count() == len(want)
    assert got.select(F.spark_partition_id()).distinct().count() > 1


def test_rows_are_moved_once_and_without_their_keys(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "i").repartition(3)
    wide = F.concat(F.md5(F.col("i").cast("string")), F.repeat(F.md5(F.col("i").cast("string")), 20))
    got = chunks_of(rows, [wide], rows.where("i % 3 = 0").select(wide.alias("p")), held=10)
    want = sorted(m for m in (hashlib.md5(str(i).encode()).hexdigest() for i in range(0, 20_000, 3)))
    assert got.columns == ["i", "chunk"] and all(r["chunk"] == bisect_right(want, hashlib.md5(str(r["i"]).encode()).hexdigest()) for r in got.collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window [sum" in plan and plan.count("hashpartitioning") <= 2 and "md5" not in plan

"""Batches by count, bytes and group against a loop over all rows, whatever the parts and partitions."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.sources.cuts import cut


def plain(rows, n, most):
    """rows: (group, key, size) in order."""
    out, held = [], None
    for g, k, s in rows:
        s = max(0, s or 0)
        if held is None or held[0] != g:
            held = [g, 0, k, k, 0]
            out.append(held)
        held[1], held[3], held[4] = held[1] + 1, k, held[4] + s
        if held[1] >= n or held[4] >= most:
            held = None
    return [(i, *b) for i, b in enumerate(out)]


@pytest.mark.parametrize("n,most,part,partitions", [(6, 50, 6, 3), (6, 50, 7, 1), (4, 10**9, 9, 5), (50, 40, 64, 4), (1, 5, 3, 2), (7, 30, 1 << 18, 4)])
def test_batches_equal_a_loop(spark, n, most, part, partitions):
    rng = random.Random(n * part)
    rows = [(None if g == 2 else f"g{g}", k, rng.choice([0, 0, 3, 9, 17, 60, None, -4])) for g in range(4) for k in range(rng.randrange(1, 90))]
    shuffled = rows[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "g string, k long, s long").withColumn("part", F.lit("mine")).withColumn("rn", F.lit("mine")).repartition(partitions)
    got = [tuple(r) for r in cut(df, ["k"], F.col("s"), n, most, by=("g",), part=part).orderBy("batch").collect()]
    assert got == plain(sorted(rows, key=lambda r: (r[0] or "", r[1])), n, most)
    flat = sorted(((None, k + 1000 * int(g[1]) if g else k + 2000, s) for g, k, s in rows), key=lambda r: r[1])
    df = spark.createDataFrame([r[1:] for r in flat], "k long, s long")
    got = [tuple(r) for r in cut(df, ["k"], F.col("s"), n, most, part=part).orderBy("batch").collect()]
    assert got == [(b, *rest) for b, _, *rest in plain(flat, n, most)]


def test_few_rows_and_keys_of_other_types(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), (None, 5), ("b", 5)], "k string, s long")
    assert [tuple(r) for r in cut(df, ["k"], F.col("s"), 10, 10).orderBy("batch").collect()] == [(0, 2, None, "a", 10), (1, 2, "b", "b", 10)]
    assert cut(df.limit(0), ["k"], F.col("s"), 10, 10).count() == 0

from functools import reduce

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import ann


def brute(ids, x, k=20):
    out = {}
    for i, q in zip(ids, x):
        if i % 20 == 0:
            s = [(-reduce(lambda s, ab: s + ab[0] * ab[1], zip(q.tolist(), v.tolist()), 0.0), j) for j, v in zip(ids, x) if j != i]
            out[i] = [(j, -d) for d, j in sorted(s)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def frame(spark, ids, x):
    rows = [(int(i), [float(v) for v in r]) for i, r in zip(ids, x)]
    bad = [(20, None), (40, [0.0] * x.shape[1]), (60, [float("nan")] * x.shape[1]), (80, [1.0] * 3), (None, [1.0] * x.shape[1]), (100, [None] * x.shape[1]), (120, [float("inf")] * x.shape[1])]
    return spark.createDataFrame(rows + [(b[0] + 100_000 if b[0] else None, b[1]) for b in bad], "vec_id long, embedding array<float>").withColumn("v", F.lit("mine")).repartition(3)


def test_copies_and_ties_are_exact_where_all_is_ranked_again(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[50:250] = x[0]  # one vector for most rows, queries among them
    ids = np.arange(300)
    rows = frame(spark, ids, x)
    for name in ("id", "n", "ids", "vid", "qvid", "perm", "norm", "seg", "blk", "_query"):
        rows = rows.withColumn(name, F.lit("mine"))
    got = found(ann.search(rows.union(rows.limit(40)), F.col("vec_id") % 20 == 0, rerank=100))
    assert got == brute(ids, x.astype(np.float64))


def test_few_rows(spark):
    x = np.eye(4, dtype=np.float32)
    got = found(ann.search(frame(spark, np.arange(4), x), F.col("vec_id") % 20 == 0))
    assert [i for i, _ in got[0]] == [1, 2, 3]
    assert ann.search(frame(spark, np.arange(4), x).limit(0), F.lit(True)).count() == 0


def test_recall(spark):
    """Vectors without structure, which are the hardest, at two sizes by one rule; the index is cut into segments and blocks."""
    rng = np.random.default_rng(1)
    for n, reranked in ((400, 0.32), (4000, 0.11)):
        x = rng.normal(size=(n, 32)).astype(np.float32) * rng.uniform(0.7, 1.3, (n, 1)).astype(np.float32)
        ids = np.arange(n)
        assert ann.RERANK / np.sqrt(n) < reranked
        got = found(ann.search(frame(spark, ids, x), F.col("vec_id") % 20 == 0, segment=2048, block=150))
        want = brute(ids, x.astype(np.float64))
        assert set(got) == set(want)
        hits = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
        assert np.mean(hits) >= 0.9
        assert all(abs(s - float(x[q].astype(float) @ x[i].astype(float))) < 1e-9 for q in got for i, s in got[q])


def test_the_number_of_cores_changes_nothing(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = frame(spark, np.arange(5000), rng.normal(size=(5000, 8)).astype(np.float32)).cache()
    first = found(ann.search(rows, F.col("vec_id") % 500 == 0))
    monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self: 1))
    assert found(ann.search(rows.repartition(7), F.col("vec_id") % 500 == 0)) == first


def test_files_give_the_footrule_distance():
    """Against the distance written out, absent pivots at the place after the last; rows of a pivot that all have, and of one that none has."""
    rng = np.random.default_rng(3)
    for n, pivots, m in ((1, 3, 3), (40, 12, 5), (300, 50, 8)):
        order = np.array([rng.permutation(pivots - 1)[:m] if pivots > m else rng.permutation(pivots)[:m] for _ in range(n)], np.int16)
        order[:, 0] = np.where((order[:, 1:] == 1).any(1), order[:, 0], 1)  # one pivot is nearly everyone's
        files = ann._Files(order, pivots)
        for _ in range(20):
            perm = rng.permutation(pivots)[:m].astype(np.int16)
            mine = {int(p): i for i, p in enumerate(perm)}
            far = [sum(abs(mine.get(p, m) - (list(row).index(p) if p in row else m)) for p in range(pivots)) for row in order]
            most = m * (m + 1)
            assert [most - 2 * int(x) for x in files.nearness(perm)] == far


def test_files_hold_postings_only(spark):
    """As many postings as rows have pivots; a query reads those of its own pivots, far fewer than a place of every row for each of them."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 64))
    x /= np.sqrt((x * x).sum(1))[:, None]
    order = ann._order(x, np.zeros(len(x)), np.concatenate([x[: ann.PIVOTS], np.zeros((ann.PIVOTS, 1))], 1), ann.PREFIX)
    files = ann._Files(order, ann.PIVOTS)
    assert len(files.row) == len(x) * ann.PREFIX
    sizes = np.diff(np.concatenate([[0], files.ends]))
    read = np.mean([sizes[p].sum() for p in order[:200]])
    assert read < 1.5 * ann.PREFIX**2 / ann.PIVOTS * len(x)
    assert read < x.size  # multiplications of the exact product

"""The fold of a change log against a sequential interpreter, in any batching; repair; split points; batches by bytes."""

import json
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.engine import Engine
from tidemark.operators import replay, validation
from tidemark.plans import splits
from tidemark.shared import written
from tidemark.sources import snapshot
from tidemark.streaming.apply import StateTable, documents

LOG = "ns string, doc_id long, op string, t long, i long, event_id long, full map<string,string>, sets map<string,string>, unsets array<string>, rekeys boolean, to_ns string"
FIELDS = ("a", "b", "c")


def make_log(seed, n=300, keys=8, schema=True):
    rng = random.Random(seed)
    rows = []
    for e in range(n):
        ns, op = f"d{rng.randrange(2)}.x{rng.randrange(3)}", rng.choice(["insert", "replace", "update", "update", "update", "delete", "invalidate"])
        some = lambda: {f: str(rng.randrange(9)) for f in FIELDS if rng.random() < 0.5}  # noqa: B023, E731
        full = some() if rng.random() < 0.8 else None
        sets, unsets = (some(), [f for f in FIELDS if rng.random() < 0.2]) if op == "update" and rng.random() < 0.8 else (None, None)
        to = None
        if schema and rng.random() < 0.05:
            op = rng.choice(["drop", "rename", "rename", "dropDatabase", "create"])
            to = f"d{rng.randrange(2)}.x{rng.randrange(3)}" if op == "rename" else None
            to = None if to == ns else to
            op = "create" if op == "rename" and to is None else op
        rows.append((ns, rng.randrange(keys), op, 100 + e // 3, e % 3, e, full, sets, unsets, rng.random() < 0.2, to))
    return rows


def replay_rows(rows):
    """The sequential interpreter. A rename moves documents and leaves what the new name already has, unless their ids are the same: then
    both histories become one, in the order of their changes."""
    live = [list(r) for r in sorted(rows, key=lambda r: (r[3], r[4], r[5]))]
    kept = []
    for r in live:
        if r[2] == "drop":
            kept = [k for k in kept if k[0] != r[0]]
        elif r[2] == "dropDatabase":
            kept = [k for k in kept if k[0].split(".")[0] != r[0].split(".")[0]]
        elif r[2] == "rename":
            for k in kept:
                k[0] = r[10] if k[0] == r[0] else k[0]
        else:
            kept.append(r)
    docs = {}
    for ns, key, op, _, _, _, full, sets, unsets, rekeys, _ in kept:
        if op in ("insert", "replace"):
            if full is not None:
                docs[ns, key] = dict(full)
        elif op == "delete":
            docs.pop((ns, key), None)
        elif op == "update":
            if full is not None and (rekeys or not (sets or unsets)):
                docs[ns, key] = dict(full)
            elif (ns, key) in docs:
                docs[ns, key].update(sets or {})
                for f in unsets or []:
                    docs[ns, key].pop(f, None)
    return sorted((ns, k, tuple(sorted(d.items()))) for (ns, k), d in docs.items())


def found(df):
    return sorted((r["ns"], r["doc_id"], tuple(sorted(r["doc"].items()))) for r in df.collect())


def test_fold_equals_sequential_replay(spark):
    for seed in range(2):
        rows = make_log(seed)
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        assert found(replay.fold(spark.createDataFrame(shuffled, LOG))) == replay_rows(rows)


def test_fold_does_not_depend_on_batches(spark):
    rows = make_log(7)
    for cuts in ([50, 51, 200],):
        state = spark.createDataFrame([], LOG)
        for a, b in zip([0, *cuts], [*cuts, len(rows)]):
            state = written(replay.compact(state.union(spark.createDataFrame(rows[a:b], LOG))), "test-state")
        assert found(replay.fold(state)) == replay_rows(rows)
        assert state.count() < len(rows)
    plain = make_log(8, schema=False)
    state = written(replay.compact(spark.createDataFrame(plain, LOG)), "test-state")
    log = state.union(spark.createDataFrame(plain[: len(plain) // 2], LOG)).dropDuplicates(["event_id"])
    again = written(replay.compact(log), "test-state")  # a replayed prefix
    assert found(replay.fold(again)) == replay_rows(plain)


def nested_log(seed, n=240, keys=3):
    """Changes whose paths lead into fields, over each other and into values that are no documents."""
    rng = random.Random(seed)
    value = lambda deep=2: rng.choice(["1", "2.5", '"s"', "null", "true", "[1,{}]", "{}", "plain"]) if deep == 0 or rng.random() < 0.6 else "{" + ",".join(f'"{f}":{v}' for f in "xyz" if rng.random() < 0.6 and (v := value(deep - 1)) != "plain") + "}"
    path = lambda: ".".join([rng.choice("ab"), *(rng.choice("xyz") for _ in range(rng.randrange(4)))])
    rows = []
    for e in range(n):
        op = rng.choice(["insert", *["update"] * 12, "delete"]) if e > 2 * keys else "insert"
        full = {f: value() for f in "abc"} if op == "insert" else None
        sets = {}
        for p in (path() for _ in range(rng.randrange(3))):  # no path of an update leads through another one
            if not any(p == q or p.startswith(q + ".") or q.startswith(p + ".") for q in sets):
                sets[p] = value()
        gone = [p for p in (path(),) if rng.random() < 0.4 and not any(p == q or p.startswith(q + ".") or q.startswith(p + ".") for q in sets)]
        rows.append(("d.x", rng.randrange(keys), op, e, 0, e, full, sets if op == "update" else None, gone if op == "update" else None, False, None))
    return rows


def as_value(text):
    try:
        return json.loads(text)
    except ValueError:
        return text


def replay_nested(rows):
    docs = {}
    for _, key, op, _, _, _, full, sets, unsets, _, _ in rows:
        if op == "insert":
            docs[key] = {f: as_value(v) for f, v in full.items()}
        elif op == "delete":
            docs.pop(key, None)
        elif key in docs:
            for p, v in sets.items():
                *way, last = p.split(".")
                at = docs[key]
                for step in way:
                    if not isinstance(at.get(step), dict):
                        at[step] = {}
                    at = at[step]
                at[last] = as_value(v)
            for p in unsets:
                *way, last = p.split(".")
                at = docs[key]
                for step in way:
                    at = at.get(step) if isinstance(at, dict) else None
                if isinstance(at, dict):
                    at.pop(last, None)
    return docs


def test_paths_into_documents_equal_sequential_replay(spark):
    values = lambda df: {r["doc_id"]: {f: as_value(v) for f, v in r["doc"].items()} for r in df.collect()}
    for seed in range(4):
        rows = nested_log(seed)
        shuffled = rows[:]
        random.Random(seed).shuffle(shuffled)
        log = spark.createDataFrame(shuffled, LOG)
        assert values(replay.fold(log)) == replay_nested(rows)
        if seed < 2:  # cut anywhere, compacted in between
            state = written(replay.compact(spark.createDataFrame(rows[:90], LOG)), "test-state")
            state = written(replay.compact(state.union(spark.createDataFrame(rows[90:], LOG))), "test-state")
            assert state.count() < len(rows) and values(replay.fold(state)) == replay_nested(rows)


def test_paths_only_where_asked_for(spark):
    rows = [("d.x", 1, "insert", 1, 0, 1, {"a": '{"b": 1}', "a.b": "0"}, None, None, False, None), ("d.x", 1, "update", 2, 0, 2, None, {"a.b": "7"}, None, False, None)]
    log = spark.createDataFrame(rows, LOG)
    assert replay.fold(log).first()["doc"] == {"a": '{"b":7}', "a.b": "0"}
    assert replay.fold(log, paths=False).first()["doc"] == {"a": '{"b": 1}', "a.b": "7"}


def test_odd_logs(spark):
    assert replay.fold(spark.createDataFrame([], LOG)).count() == 0
    update = ("a.b", 1, "update", 1, 0, 0, None, {"a": "1"}, None, False, None)
    assert replay.fold(spark.createDataFrame([update], LOG)).count() == 0
    odd = [(None, None, "insert", 1, 0, 0, {}, None, None, None, None), ("a.b", 2, None, 1, 0, 0, {"a": "1"}, None, None, None, None)]
    assert found(replay.fold(spark.createDataFrame(odd * 2, LOG).withColumn("_key", F.lit("mine")))) == [(None, None, ())]
    hot = [("a.b", 1, "update", n, 0, n, None, {"a": str(n)}, None, False, None) for n in range(1, 2000)]
    hot.append(("a.b", 1, "insert", 0, 0, 0, {"b": "x"}, None, None, False, None))
    assert found(replay.fold(spark.createDataFrame(hot, LOG))) == [("a.b", 1, (("a", "1999"), ("b", "x")))]


def test_a_restarted_stream_goes_on_where_it_was(spark, tmp_path):
    rows = make_log(11, n=240)
    top, parts = str(tmp_path / "stream"), [rows[:80], rows[80:160], rows[160:]]
    for n, part in enumerate(parts):
        spark.createDataFrame(part, LOG).coalesce(1).write.mode("append").parquet(f"{top}/in")
        got = Engine(spark).apply_stream(spark.readStream.schema(LOG).parquet(f"{top}/in"), f"{top}/out")  # a new state table each time
        assert found(got) == replay_rows(sum(parts[: n + 1], []))
    again = StateTable(spark, f"{top}/out/state")
    assert again.version == 2
    again.apply(spark.createDataFrame(parts[2], LOG), 2)  # a batch that was applied before the loss
    assert found(documents(again)) == replay_rows(rows)
    assert found(Engine(spark).apply_stream(spark.readStream.schema(LOG).parquet(f"{top}/in"), f"{top}/out")) == replay_rows(rows)  # nothing new
    spark.range(3).write.parquet(f"{top}/out/state/v3")  # a lost run left a folder without its commit
    more = [("d0.x0", 1, "insert", 10**6, 0, 10**6, {"a": "z"}, None, None, False, None)]
    lost = StateTable(spark, f"{top}/out/state")
    lost.apply(spark.createDataFrame(more, LOG), 3)
    assert found(documents(lost)) == replay_rows(rows + more)
    late = Engine(spark).apply_stream(spark.readStream.schema(LOG).parquet(f"{top}/in"), f"{top}/late", start=(140, 1))
    assert found(late) == replay_rows([r for r in rows if (r[3], r[4]) >= (140, 1)])
    assert found(documents(StateTable(spark, f"{top}/none"))) == []


def test_repaired_target_is_valid(spark):
    src = spark.createDataFrame([(k, float(k), None if k % 5 else "x") for k in range(60)], "k long, a double, b string")
    tgt = spark.createDataFrame([(k, float(k + (k % 7 == 0)), None if k % 5 else "x") for k in range(80) if k % 11] + [(3, 3.0, "dup")], "k long, a double, b string")
    outcomes = {r["k"]: r["outcome"] for r in validation.compare(src, tgt, "k").collect()}
    assert outcomes[3] == "ghost" and outcomes[70] == "orphan" and outcomes[11] == "missing" and outcomes[7] == "mismatch" and outcomes[5] == "valid"
    after = validation.compare(src, validation.repair(src, tgt, "k"), "k")
    assert {r["outcome"] for r in after.collect()} == {"valid"} and after.count() == 60


@settings(max_examples=200, deadline=None)
@given(st.integers(-(2**62), 2**62), st.integers(1, 2**62), st.integers(2, 50))
def test_range_points_ascend_within_bounds(low, width, parts):
    points = splits.split_range(low, low + width, parts)
    assert len(points) == parts - 1
    assert all(low <= p < low + width for p in points) and points == sorted(points)


@settings(max_examples=200, deadline=None)
@given(st.binary(min_size=1, max_size=16), st.binary(min_size=1, max_size=16), st.integers(2, 20))
def test_byte_points_keep_their_width(a, b, parts):
    low, high = sorted((a, b))
    points = splits.split_bytes(low, high, parts)
    assert all(len(p) == max(len(a), len(b)) for p in points) and points == sorted(points)


def test_ring_points():
    points = splits.split_ring(12)
    assert len(points) == 11 and points == sorted(points) and points[0] == -(2**63) + (2**64 - 1) // 12


def test_segments_when_rows_divide_evenly(spark):
    rows = spark.createDataFrame([(k,) for k in range(20)], "k long")
    got = [(r["segment"], r["min_key"], r["max_key"], r["n"]) for r in snapshot.segment_plan(rows, "k", 9).orderBy("segment").collect()]
    assert got == [(0, None, 9, 10), (1, 9, 19, 10), (2, 19, None, 0)]
    assert [(r["segment"], r["n"]) for r in snapshot.segment_plan(rows.limit(0), "k", 9).collect()] == [(0, 0)]


def test_changes_since_the_last_base_are_counted(spark):
    rows = [("a.b", 1, "insert", 1, 0, 1, {"x": "1"}, None, None, False, None), ("a.b", 1, "update", 2, 0, 2, None, {"x": "2"}, None, False, None), ("a.b", 1, "replace", 3, 0, 3, {"x": "3"}, None, None, False, None),
        ("a.b", 1, "update", 4, 0, 4, None, {"y": "4"}, None, False, None), (None, None, "insert", 5, 0, 5, {}, None, None, False, None), ("a.b", 2, "insert", 6, 0, 6, {}, None, None, False, None), ("a.b", 2, "delete", 7, 0, 7, None, None, None, False, None), ("a.b", 3, "update", 8, 0, 8, None, {"x": "1"}, None, False, None)]
    many = [("a.c", 9, "insert", 9, 0, 100, {}, None, None, False, None), *(("a.c", 9, "update", 10, k, 101 + k, None, {"x": str(k)}, None, False, None) for k in range(3000))]
    got = replay.fold(spark.createDataFrame(rows + many, LOG), counted=True)
    assert {(r["ns"], r["doc_id"]): r["n_changes"] for r in got.collect()} == {("a.b", 1): 2, (None, None): 1, ("a.c", 9): 3001}


def test_the_whole_replay_counts_changes(spark):
    from tidemark.operators.cdc import cdc_replay

    rows = cdc_replay(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["ns", "doc_id", "value", "props", "n_changes"] and rows.where("n_changes < 1").isEmpty() and not rows.where("n_changes > 1").isEmpty()

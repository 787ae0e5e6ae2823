"""The change source: offsets, places to start, batches, restarts; what batches do to the state."""

import os
import random
import tracemalloc
from datetime import UTC, datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq
from test_replay import LOG, found, make_log, replay_rows

from tidemark.sources import change_log
from tidemark.streaming import dirty
from tidemark.streaming.apply import StateTable, apply_log, documents


def write(spark, rows, path, name):
    """One file of changes in several row groups, in no order within the file."""
    df = spark.createDataFrame(rows, LOG).orderBy("doc_id", "op")
    os.makedirs(path, exist_ok=True)
    pq.write_table(df.toArrow(), f"{path}/{name}.parquet", row_group_size=20)


def reader(path, **options):
    return change_log.ChangeLogReader({"path": str(path), **options})


def test_offsets_are_places_in_order(spark, tmp_path):
    rows, path = make_log(3, n=200), str(tmp_path / "log")
    for k in range(0, 200, 50):
        write(spark, rows[k : k + 50], path, f"f{k}")
    places = sorted((r[3], r[4], r[5]) for r in rows)
    r, ends = reader(path, batch_changes="35"), []
    start = r.initialOffset()
    while not ends or ends[-1] != (end := r.latestOffset()):
        ends.append(r.latestOffset() if not ends else end)
    # the first call of the loop moved on once more; every offset is a place of the log, and the last one its end
    assert all(tuple(e.values()) in places for e in ends) and tuple(ends[-1].values()) == places[-1]
    got = []
    for a, b in zip([start, *ends], ends):
        got.append(sum((batch.column("event_id").to_pylist() for p in r.partitions(a, b) for batch in r.read(p)), []))
    assert sorted(sum(got, [])) == sorted(p[2] for p in places) and all(len(g) <= 70 for g in got)
    some = r.partitions({"t": 100, "i": 0, "event_id": 0}, {"t": 101, "i": 9, "event_id": 9})
    assert {os.path.basename(p.file) for p in some} == {"f0.parquet"}  # the other files lie behind
    late = reader(path, start_t="140", start_i="1", batch_changes="1000")
    a, b = late.initialOffset(), late.latestOffset()
    read = sum((batch.column("event_id").to_pylist() for p in late.partitions(a, b) for batch in late.read(p)), [])
    assert sorted(read) == sorted(p[2] for p in places if p[:2] >= (140, 1))


def test_a_restart_from_any_offset_gives_the_same_state(spark, tmp_path):
    rows, path = make_log(5, n=120), str(tmp_path / "log")
    write(spark, rows[:60], path, "a")
    for k, most in enumerate((25, 60)):  # stopped after each batch of the first half, then the log grows
        top = str(tmp_path / f"out{k}")
        state = StateTable(spark, f"{top}/state", 4)
        apply_log(path, state, f"{top}/offsets", batch_changes=most)
        assert found(documents(state)) == replay_rows(rows[:60]) and state.version == -(-60 // most) - 1
        if k == 0:
            first = state.feed().collect()
    write(spark, rows[60:], path, "b")
    for k, most in enumerate((30, 7000)):
        top = str(tmp_path / f"out{k}")
        again = StateTable(spark, f"{top}/state", 4)
        before = again.version
        apply_log(path, again, f"{top}/offsets", batch_changes=most)
        assert found(documents(again)) == replay_rows(rows) and again.version == before + (2 if k == 0 else 1)
    assert sorted(map(str, first)) == sorted(str(r) for r in StateTable(spark, f"{tmp_path}/out0/state").feed().collect() if r["batch"] <= 2)
    late = StateTable(spark, f"{tmp_path}/late/state", 4)
    apply_log(path, late, f"{tmp_path}/late/offsets", start=(120, 2))
    assert found(documents(late)) == replay_rows([r for r in rows if (r[3], r[4]) >= (120, 2)])


def test_effects_are_differences_of_documents(spark, tmp_path):
    rows = make_log(9, n=150)
    state, was = StateTable(spark, str(tmp_path / "state"), 4), {}
    for n, k in enumerate(range(0, 150, 50)):
        part = rows[k : k + 50]
        state.apply(spark.createDataFrame(part, LOG), n)
        now = {(ns, key): doc for ns, key, doc in replay_rows(rows[: k + 50])}
        met = {(r[0], r[1]) for r in part if r[2] in ("insert", "replace") and r[6] is not None or r[2] == "delete" or (r[2] == "update" and (r[7] or r[8] or r[6] is not None))}
        want = {}
        for name, keys in (("inserted", set(now) - set(was)), ("matched", set(now) & set(was) & met), ("deleted", set(was) - set(now))):
            for ns, _ in keys:
                want.setdefault(ns, {}).setdefault(name, 0)
                want[ns][name] += 1
        got = {r["ns"]: {c: r[c] for c in ("inserted", "matched", "deleted") if r[c]} for r in state.feed().where(f"batch = {n}").collect()}
        assert {ns: x for ns, x in got.items() if x} == want
        counts = {r["ns"]: (r["inserts"], r["updates"], r["deletes"]) for r in state.feed().where(f"batch = {n}").collect()}
        for ns, c in counts.items():
            ops = [r[2] for r in part if r[0] == ns]
            assert c == (ops.count("insert"), ops.count("update") + ops.count("replace"), ops.count("delete"))
        was = now
    assert StateTable(spark, str(tmp_path / "none")).feed().count() == 0


def test_dirty_runs_over_batches_and_restarts(spark, tmp_path):
    """Changes in several files, out of order within the watermark, with a restart in between; against runs found by sorting."""
    rng, start = random.Random(2), datetime(2024, 1, 1, tzinfo=UTC)
    rows = sorted((rng.randrange(40_000), rng.choice([None, 1, 2, 3])) for _ in range(300))
    rows = [(f"d.x{(k or 0) % 2}", k, start + timedelta(seconds=s)) for s, k in rows] + [("d.x0", 9, None)]
    schema, top = "ns string, doc_id long, ts timestamp", str(tmp_path)
    for n, at in enumerate((0, 80, 160, 240)):
        part = rows[at : at + 80]
        rng.shuffle(part)
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{top}/in")
        got = dirty.track(spark.readStream.schema(schema).parquet(f"{top}/in"), f"{top}/out", late="1 hour", quiet=200_000, retry=90_000, most=4)
        ms, by = int(start.timestamp() * 1000), {}
        for ns, k, t in rows[: at + 80]:
            if t is not None:
                by.setdefault((ns, k), []).append(int(t.timestamp() * 1000))
        seen, want = max(t for ts in by.values() for t in ts) - 3_600_000, []
        for (ns, k), ts in by.items():
            runs = []
            for t in sorted(ts):
                if runs and t - runs[-1][-1] < 200_000:
                    runs[-1].append(t)
                else:
                    runs.append([t])
            for r in runs:
                tried = sum(1 for c in range(r[0] + 90_000, r[-1] + 200_000, 90_000))
                if r[-1] + 200_000 < seen:
                    want.append((ns, k, r[0], r[-1], len(r), min(tried, 4), "hot_key_waiting" if tried >= 4 else "checked"))
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and (n == 0 or want) and ms


def test_runs_join_when_a_late_change_lies_between():
    assert dirty.joined([(0, 10, 2), (200, 210, 1), (105, 105, 1)], 100) == [(0, 210, 4)]
    assert dirty.joined([(0, 10, 2), (110, 120, 1)], 100) == [(0, 10, 2), (110, 120, 1)] and dirty.joined([], 5) == []


def test_dirty_runs_end_where_the_key_is_clean(spark, tmp_path):
    """Gaps of one millisecond less than the quiet time, and of just it; a run is reported only behind its end; and no Python in the plan."""
    start = datetime(2024, 1, 1, tzinfo=UTC)
    at = lambda ms: start + timedelta(milliseconds=ms)
    rows = [("n", 1, at(0)), ("n", 1, at(999)), ("n", 2, at(0)), ("n", 2, at(1000)), ("n", 3, at(99_000)), ("n", 4, at(98_999)), ("n", 5, at(160_000) - timedelta(microseconds=1)), ("n", 5, at(160_000))]
    schema = "ns string, doc_id long, ts timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).parquet(f"{tmp_path}/in")
    got = dirty.track(stream, f"{tmp_path}/out", late="1 minute", quiet=1000, retry=400, most=3)
    zero = int(start.timestamp() * 1000)
    assert sorted((r["doc_id"], r["first_ms"] - zero, r["last_ms"] - zero, r["n"], r["skipped"], r["outcome"]) for r in got.collect()) == [(1, 0, 999, 2, 3, "hot_key_waiting"), (2, 0, 0, 1, 2, "checked"), (2, 1000, 1000, 1, 2, "checked"), (4, 98_999, 98_999, 1, 2, "checked")]
    plan = dirty.dirty_runs(spark.read.parquet(f"{tmp_path}/in"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "TransformWithState" not in plan


def test_the_end_of_a_large_batch_is_found_without_a_place_at_a_time(tmp_path):
    """Two million places in several row groups: found in seconds, with memory of numbers and not of Python's tuples."""
    n, path = 2_000_000, str(tmp_path / "log.parquet")
    t = pa.array(range(n))
    pq.write_table(pa.table({"t": t, "i": pa.array([0] * n), "event_id": t}), path, row_group_size=250_000)
    r = reader(path, batch_changes="1500000")
    tracemalloc.start()
    ends = [tuple(r.latestOffset().values()) for _ in range(2)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ends == [(1_499_999, 0, 1_499_999), (n - 1, 0, n - 1)] and peak < 150_000_000

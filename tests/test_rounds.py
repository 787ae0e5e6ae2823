"""Validation in rounds, the keyed table below it, and the engine's verbs that keep things on disk."""

from pyspark.sql import functions as F
from test_replay import LOG, found, make_log, replay_rows

from tidemark.engine import Config, Engine
from tidemark.operators.validation import MANUAL
from tidemark.tables import KeyedTable

SCHEMA = "k long, v string"


def rows_of(table):
    return sorted((tuple(r[c] for c in ("k", "v")) for r in table.rows().collect()), key=repr)


def test_a_keyed_table_replaces_rows_by_key(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 4)
    make = lambda rows: spark.createDataFrame(rows, SCHEMA)
    assert rows_of(table) == []
    first = make([(1, "a"), (1, "b"), (2, "c"), (None, "n")])
    table.replace(first.select("k"), first)
    table.replace(make([(1, ""), (7, ""), (None, "")]).select("k"), make([(1, "z"), (None, "m")]))
    again = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 4)
    assert rows_of(again) == sorted([(1, "z"), (2, "c"), (None, "m")], key=repr) and again.version == 1
    spark.range(3).write.parquet(str(tmp_path / "t/v2"))  # a lost version
    again.replace(make([(2, "")]).select("k"), make([]))
    assert rows_of(KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 4)) == sorted([(1, "z"), (None, "m")], key=repr)


def test_a_keyed_table_without_rows_reads_no_keys(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 4)
    first = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "n")], SCHEMA)
    table.replace(first.select(F.raise_error(F.lit("keys are read")).cast("long").alias("k")), first)
    assert rows_of(table) == sorted([(1, "a"), (1, "b"), (2, "c"), (None, "n")], key=repr)
    table.replace(first.select("k"), first.limit(0))
    assert rows_of(table) == []
    table.replace(first.select("k"), first)
    assert len(rows_of(table)) == 4 and table.version == 2


def test_a_bucket_is_written_by_several_tasks(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, ("k",), 1)
    rows = spark.range(1000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("v"))
    table.replace(rows.select("k"), rows)
    assert len(list((tmp_path / "t/v0/bucket=0").glob("part-*.parquet"))) > 1 and table.rows().exceptAll(rows).count() == 0 and table.rows().count() == 1000


def test_the_keys_of_a_change_are_found_once(spark, tmp_path):
    loop = Engine(spark).validation(str(tmp_path / "loop"), SCHEMA, "k", "d.x")
    rows = spark.createDataFrame([(k, f"v{k}") for k in range(10)], SCHEMA)
    loop.target.replace(rows.select("k"), rows)
    loop.failures.replace(rows.select(F.lit("d.x").alias("ns"), F.col("k").alias("key")), rows.select(F.lit("d.x").alias("ns"), F.col("k").alias("key"), F.lit(MANUAL).alias("status"), F.lit(1).cast("long").alias("retry_count"), F.lit(0).cast("long").alias("since")))
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    keys = spark.range(3).select(F.col("id").alias("k")).mapInArrow(count, "k long")
    loop.change(keys, rows.where("k = 1"))
    assert seen.value == 3 and rows_of(loop.target) == [(k, f"v{k}") for k in (1, 3, 4, 5, 6, 7, 8, 9)]
    assert sorted(r["key"] for r in loop.failures.rows().collect()) == list(range(3, 10))


def test_rounds_repair_until_nothing_is_left(spark, tmp_path):
    src = spark.createDataFrame([(k, f"v{k}") for k in range(10)] + [(None, "no key")], SCHEMA)
    tgt = spark.createDataFrame([(k, f"v{k}") for k in (0, 1, 5, 6)] + [(2, "old"), (3, "old"), (4, "v4"), (4, "copy"), (20, "x"), (21, "x"), (21, "y"), (22, "x")], SCHEMA)
    loop = Engine(spark).validation(str(tmp_path / "loop"), SCHEMA, "k", "d.x")
    loop.target.replace(tgt.select("k"), tgt)

    def meanwhile():
        """3 and 20 go, one copy of 21 goes, 7 is inserted, while the first round is between comparison and repair."""
        change = spark.createDataFrame([(21, "y"), (7, "v7")], SCHEMA)
        loop.change(spark.createDataFrame([(3,), (20,), (21,), (7,)], "k long"), change)

    done = loop.until_quiet(src, 0, meanwhile=meanwhile)
    first = {r["k"]: (r["outcome"], r["status"]) for r in done[0][1].collect()}
    healed = "healed_pending_verify"
    assert first == {
        None: ("error", "error"), 0: ("valid", "valid"), 1: ("valid", "valid"), 5: ("valid", "valid"), 6: ("valid", "valid"), 2: ("mismatch", healed), 3: ("mismatch", MANUAL), 4: ("ghost", healed), 7: ("missing", healed), 8: ("missing", healed), 9: ("missing", healed),
        20: ("orphan", MANUAL), 21: ("orphan", MANUAL), 22: ("orphan", healed),
    }
    assert {r["k"]: r["status"] for r in done[1][1].collect()} == {None: "error", **dict.fromkeys((2, 4, 7, 8, 9, 22), "valid")}
    assert rows_of(loop.target) == sorted([(k, f"v{k}") for k in range(10) if k != 3])
    left = {r["key"]: (r["status"], r["retry_count"], r["since"]) for r in loop.failures.rows().collect()}
    assert {k: s for k, (s, _, _) in left.items()} == {None: "error", 3: MANUAL, 20: MANUAL, 21: MANUAL} and left[None][1] == len(done) and left[3][1:] == (1, 0)
    audit = spark.read.parquet(str(tmp_path / "loop/audit"))
    assert {r["key"]: r["action"] for r in audit.collect()} == {2: "content_mismatch_fixed", 4: "ghost_fixed", 7: "missing_target_fixed", 8: "missing_target_fixed", 9: "missing_target_fixed", 22: "orphan_deleted"}
    stats = loop.stats.rows().first()
    assert (stats["total_checked"], stats["mismatch_found"], stats["mismatch_fixed"]) == (14 + 7 * (len(done) - 1) - 6 * (len(done) - 2), 10, 6)
    again = Engine(spark).validation(str(tmp_path / "loop"), SCHEMA, "k", "d.x")  # found on disk; a change voids a failure
    again.change(spark.createDataFrame([(3,)], "k long"), spark.createDataFrame([(3, "v3")], SCHEMA))
    last = again.until_quiet(src, 9, keys=spark.createDataFrame([(3,), (99,)], "k long"))
    assert {r["k"]: r["status"] for r in last[0][1].collect()} == {3: "valid", 99: "valid"}


def test_verbs_that_keep_things_on_disk(spark, tmp_path):
    engine, rows = Engine(spark, Config(segment_docs=9, batch_docs=7, batch_bytes=30, cdc_batch=20)), make_log(21, n=100)
    spark.createDataFrame(rows, LOG).coalesce(1).write.parquet(str(tmp_path / "log"))
    docs, feed = engine.apply_log(str(tmp_path / "log"), str(tmp_path / "out"))
    assert found(docs) == replay_rows(rows) and {r["batch"] for r in feed.collect()} == {0, 1}
    src = spark.createDataFrame([(k, str(k)) for k in range(30)], SCHEMA)
    assert engine.copy(src, str(tmp_path / "copy"), "k").select("k", "v").exceptAll(src).count() == 0
    assert engine.batches(src, "k", "length(v) * 4").agg(F.sum("n"), F.count("*")).first() == (30, 7)


def test_keys_whose_repair_failed_need_a_person(spark):
    from tidemark.operators.validation import MANUAL, validate_diff

    rows = validate_diff(spark, "/root/testdata/sf0.001").where("o_orderkey % 101 = 0").groupBy("outcome", "status").count().collect()
    assert {r["status"] for r in rows if r["outcome"] != "valid"} == {MANUAL} and {r["status"] for r in rows if r["outcome"] == "valid"} == {"valid"}

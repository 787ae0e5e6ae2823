"""Replay of an ordered change log over documents of any fields, nested ones too.

A log has ns, doc_id (of any type), op, its place (t, i, event_id), ``full`` (the whole document as a map of top-level field to text, null where the
change has none), ``sets`` (map of path to text) and ``unsets`` (array of paths) of an update, ``rekeys`` (whether the update touches a field
of the partition key) and ``to_ns`` (of a rename). A path is a field, or fields joined by dots that lead into documents within it; a field that paths
lead into has JSON for text, and so have the values set there (what is no JSON counts as a string).

* An insert or a replacement with its document is a base change; without one it is dropped.
* An update that describes nothing, or touches the partition key, and has its document is a base change as well: what is left
  is that document, under its new key.
* Other updates overlay single paths and do nothing where there is no document; a deletion removes the document.
* Schema events are barriers: a drop removes what was written to the namespace before it, a rename moves it.

A document's state is its last base change and, for each path, the last change since then that writes it: a write to a path cancels what was
written below it before, and a write below a path makes a document of it, which stays when that write is removed again. So for each path two
changes are enough, the last one that writes it and the last one that writes below it; applied in their order to the base they give what all
changes would. That is one aggregation over the log, partial before the shuffle, in which a base change is one row however wide its
document is, and one over its few rows. Only documents that paths lead into are put together in Python, one small function for each.

Cases: a null namespace or id is a key like any other; a repeated change counts once; null maps and arrays are empty, null values are no fields; changes of
unknown kind are ignored; an array is a value, so a path into it, as into any other value, makes a document of it; removing a path below a value or below
nothing does nothing; an empty log gives no documents; extra columns are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import database_of
from tidemark.shared import discard, hot_keys, salted_join, written

SCHEMA_OPS = ("drop", "rename", "dropDatabase")
COLUMNS = ("ns", "doc_id", "op", "t", "i", "event_id", "full", "sets", "unsets", "rekeys", "to_ns")
_MAP = "map<string,string>"


def place() -> Column:
    """The order of changes: cluster time, number within it, arrival."""
    return F.struct(F.col("t").cast("long").alias("t"), F.col("i").cast("long").alias("i"), F.col("event_id").cast("long").alias("n"))


def kind_of() -> Column:
    """base, patch, delete, schema, or null for changes that write nothing."""
    op, full = F.col("op"), F.col("full").isNotNull()
    described = (F.size(F.coalesce("sets", F.create_map().cast(_MAP))) > 0) | (F.size(F.coalesce("unsets", F.array().cast("array<string>"))) > 0)
    update = F.when(full & (~described | F.coalesce("rekeys", F.lit(False))), "base").when(described, "patch")
    return F.when(op.isin("insert", "replace") & full, "base").when(op == "update", update).when(op == "delete", "delete").when(op.isin(*SCHEMA_OPS), "schema")


def _events_by_namespace(log: DataFrame) -> DataFrame:
    """(ns, at, to): drops (to is null) and renames, with those of a database spread over the namespaces that the log names."""
    events = log.where(F.col("op").isin(*SCHEMA_OPS)).select("ns", "op", "to_ns", place().alias("at"))
    single = events.where("op <> 'dropDatabase'").select("ns", "at", F.when(F.col("op") == "rename", F.col("to_ns")).alias("to"))
    names = log.select("ns").union(events.where("op = 'rename'").select("to_ns")).distinct().withColumn("_db", database_of(F.col("ns")))
    whole = events.where("op = 'dropDatabase'").select(database_of(F.col("ns")).alias("_db"), "at")
    return single.union(names.join(whole, "_db").select("ns", "at", F.lit(None).cast("string").alias("to"))).distinct()


def _fates(events: DataFrame) -> DataFrame:
    """(ns, events): for each namespace its schema events in order, each with the namespace where documents end that it finds there (null:
    nowhere). Chains of renames are followed by doubling, so a chain of n events takes log n small joins."""

    def following(rows: DataFrame) -> DataFrame:
        by_ns = events.groupBy(F.col("ns").alias("_to")).agg(F.array_sort(F.collect_list("at")).alias("ats"))
        after = F.try_element_at(F.filter("ats", lambda x: x > F.col("at")), F.lit(1))
        return rows.join(by_ns, rows["to"] == by_ns["_to"], "left").select("ns", "at", "to", after.alias("next"))

    now = written(following(events), "schema-fates")
    while not now.where("next IS NOT NULL").isEmpty():
        there = now.select(F.col("ns").alias("_ns"), F.col("at").alias("_at"), F.col("to").alias("_end"), F.col("next").alias("_next"))
        moved = now.join(there, (F.col("to") == F.col("_ns")) & (F.col("next") == F.col("_at")), "left")
        on = F.col("next").isNotNull()
        after = written(moved.select("ns", "at", F.when(on, F.col("_end")).otherwise(F.col("to")).alias("to"), F.when(on, F.col("_next")).alias("next")), "schema-fates")
        discard(now)
        now = after
    return now.groupBy("ns").agg(F.array_sort(F.collect_list(F.struct("at", "to"))).alias("events"))


def through_schema(log: DataFrame) -> DataFrame:
    """The changes to documents in ``log`` with the namespace where they end; those that a drop removes are gone. Schema events are a small
    part of a log; whether their table is broadcast is left to the planner."""
    rows = log.where(~F.col("op").isin(*SCHEMA_OPS) | F.col("op").isNull())
    if log.where(F.col("op").isin(*SCHEMA_OPS)).isEmpty():
        return rows
    events = written(_events_by_namespace(log), "schema-events")
    fates = _fates(events).select(F.col("ns").alias("_ns"), "events")
    first = F.try_element_at(F.filter("events", lambda e: e["at"] > place()), F.lit(1))
    met = rows.join(fates, rows["ns"] == fates["_ns"], "left").withColumn("_met", first)
    met = met.where(F.col("_met").isNull() | F.col("_met.to").isNotNull())
    return met.withColumn("ns", F.when(F.col("_met").isNull(), F.col("ns")).otherwise(F.col("_met.to"))).select(*log.columns)


_CELL = "array<struct<field:string,path:string,below:boolean,value:string>>"
_ENTRIES = "array<struct<key:string,value:string>>"
_FULL = "full"


def _cells(paths: bool) -> Column:
    """What a change writes, as (field, path, below, value): the field null for a base or a deletion, whose kind is the value; else the top-level field, the
    rest of the path ("" for none) and the value set, null where it is removed. With ``below``, a place that a set path leads through."""

    def cell(path: Column, value: Column) -> Column:
        dot = F.instr(path, ".") if paths else F.lit(0)
        field = F.when(dot > 0, F.substring(path, F.lit(1), dot - 1)).otherwise(path)
        rest = F.when(dot > 0, F.substring(path, dot + 1, F.length(path))).otherwise("")
        return F.struct(field.alias("field"), rest.alias("path"), F.lit(False).alias("below"), value.cast("string").alias("value"))

    def through(path: Column) -> Column:
        """The places on the way to a path: its field, and each document below that."""
        steps = F.split(path, r"\.")
        place = lambda n: F.struct(steps[0].alias("field"), F.array_join(F.slice(steps, F.lit(2), n - 1), ".").alias("path"), F.lit(True).alias("below"), F.lit("{}").alias("value"))
        return F.when(F.size(steps) > 1, F.transform(F.sequence(F.lit(1), F.size(steps) - 1), place)).otherwise(F.array().cast(_CELL)).cast(_CELL)

    entries = F.map_entries(F.coalesce("sets", F.create_map().cast(_MAP)))
    sets = F.transform(entries, lambda e: cell(e["key"], e["value"])).cast(_CELL)
    gone = F.transform(F.coalesce("unsets", F.array().cast("array<string>")), lambda u: cell(u, F.lit(None))).cast(_CELL)
    patch = F.concat(sets, gone, F.flatten(F.transform(entries, lambda e: through(e["key"])))) if paths else F.concat(sets, gone)
    null = F.lit(None).cast("string")
    itself = F.array(F.struct(null.alias("field"), F.lit("").alias("path"), F.lit(False).alias("below"), F.col("_kind").alias("value"))).cast(_CELL)
    return F.when(F.col("_kind") == "patch", patch).otherwise(itself)


def _documents_only(log: DataFrame, schema: bool = True) -> DataFrame:
    rows = through_schema(log) if schema else log
    return rows.withColumn("_kind", kind_of()).where(F.col("_kind").isin("base", "patch", "delete")).withColumn("_at", place())


def _last_writes(rows: DataFrame, paths: bool, *more: str) -> DataFrame:
    """(ns, doc_id, field, path, below, value, at) and ``more`` columns of the change: the last write of each place of each key, aggregated before the
    shuffle and after it, so that a key with many changes is a few rows for each task."""
    cells = rows.select("ns", "doc_id", "_at", *more, F.explode(_cells(paths)).alias("w"))
    last = F.max_by(F.struct(F.col("w.value").alias("value"), *more), "_at")
    return cells.groupBy("ns", "doc_id", "w.field", "w.path", "w.below").agg(last.alias("_w"), F.max("_at").alias("at")).select("*", "_w.*").drop("_w")


class _Plain(str):
    """Text that is no JSON."""


def _parsed(text: str):
    try:
        return json.loads(text)
    except ValueError:
        return _Plain(text)


def overlaid(text: str | None, cells: list[dict]) -> str | None:
    """A field's JSON after the writes (path, below, value) in their order; null where the field is removed."""
    top: dict = {} if text is None else {"": _parsed(text)}
    for c in cells:
        steps = ["", *c["path"].split(".")] if c["path"] else [""]
        at, sets = top, c["value"] is not None
        for step in steps[:-1]:
            if not isinstance(at.get(step), dict):
                if not sets:
                    break
                at[step] = {}
            at = at[step]
        else:
            if not sets:
                at.pop(steps[-1], None)
            elif not c["below"]:
                at[steps[-1]] = _parsed(c["value"])
            elif not isinstance(at.get(steps[-1]), dict):
                at[steps[-1]] = {}
    if "" not in top:
        return None
    return str(top[""]) if isinstance(top[""], _Plain) else json.dumps(top[""], sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def _with_overlaid(docs: DataFrame) -> DataFrame:
    """``docs`` with _built: the fields that paths lead into (_texts, null where there are none) after their writes (_cells)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("_texts").to_pylist(), b.column("_cells").to_pylist(), strict=True)
            built = pa.array([None if c is None else [overlaid(t, f) for t, f in zip(x, c, strict=True)] for x, c in rows], pa.list_(pa.string()))
            kept = b.drop_columns(["_texts", "_cells"])
            yield pa.RecordBatch.from_arrays([*kept.columns, built], names=[*kept.schema.names, "_built"])

    kept = docs.drop("_texts", "_cells")
    return docs.mapInArrow(run, ", ".join([*(f"`{n}` {t}" for n, t in kept.dtypes), "_built array<string>"]))


def _since_base(rows: DataFrame) -> DataFrame:
    """(_key, n_changes): how many changes each key had from its last base or deletion on. This needs a second look at the log, as no part of it knows where the
    last base is; changes of a hot key are dealt over many tasks."""
    key = F.to_json(F.struct("ns", "doc_id"), {"ignoreNullFields": "false"})
    sizes = written(rows.groupBy("ns", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("_kind") != "patch", F.col("_at"))).alias("_base_at")).select(key.alias("_key"), "n", "_base_at"), "replay-sizes")
    hot = hot_keys(sizes, "_key", sizes.agg(F.sum("n")).first()[0] or 0)
    since = salted_join(rows.select(key.alias("_key"), "_at"), sizes.select("_key", "_base_at"), "_key", hot, "_at", "inner").where("_at >= _base_at")
    return since.groupBy("_key").agg(F.count(F.lit(1)).alias("n_changes"))


def fold(log: DataFrame, paths: bool = True, schema: bool = True, counted: bool = False) -> DataFrame:
    """(ns, doc_id, doc): the documents that exist after ``log``. Without ``paths``, names are fields whole, dots or not; without ``schema``, the log
    is known to have no schema events and is not searched for them; with ``counted`` also n_changes, how many changes each document took part in since its
    last base, that one included."""
    rows = _documents_only(log, schema)
    last = _last_writes(rows, paths, _FULL)
    whole = F.col("field").isNull()
    entry = F.struct("at", "field", "path", "below", "value")
    docs = last.groupBy("ns", "doc_id").agg(F.first(F.when(whole, F.struct("value", "at", _FULL)), True).alias("_base"), F.collect_list(F.when(~whole, entry)).alias("_all"))
    docs = docs.where("_base.value = 'base'").withColumn("_live", F.array_sort(F.filter("_all", lambda e: e["at"] > F.col("_base.at"))))
    full = F.filter(F.map_entries(F.col(f"_base.{_FULL}")), lambda e: e["value"].isNotNull())
    touched = F.array_distinct(F.transform("_live", lambda e: e["field"]))
    kept = F.filter(full, lambda e: ~F.array_contains(touched, e["key"])).cast(_ENTRIES)
    added = F.transform(F.filter("_live", lambda e: e["value"].isNotNull()), lambda e: F.struct(e["field"].alias("key"), e["value"].alias("value"))).cast(_ENTRIES)
    if paths:
        fields = F.array_distinct(F.transform(F.filter("_live", lambda e: e["below"] | (e["path"] != "")), lambda e: e["field"]))
        docs = docs.withColumn("_deep", F.when(F.size(fields) > 0, fields))
        texts = F.transform("_deep", lambda f: F.try_element_at(F.col(f"_base.{_FULL}"), f))
        cells = F.transform("_deep", lambda f: F.transform(F.filter("_live", lambda e: e["field"] == f), lambda e: F.struct(e["path"].alias("path"), e["below"].alias("below"), e["value"].alias("value"))))
        flat = F.filter(added, lambda e: ~F.coalesce(F.array_contains("_deep", e["key"]), F.lit(False)))
        docs = _with_overlaid(docs.select("ns", "doc_id", F.concat(kept, flat).alias("_flat"), "_deep", texts.alias("_texts"), cells.alias("_cells")))
        built = F.filter(F.arrays_zip(F.col("_deep").alias("key"), F.col("_built").alias("value")), lambda e: e["value"].isNotNull())
        kept, added = F.col("_flat"), F.coalesce(built.cast(_ENTRIES), F.array().cast(_ENTRIES))
    docs = docs.select("ns", "doc_id", F.map_from_entries(F.array_sort(F.concat(kept, added))).alias("doc"))
    if not counted:
        return docs
    key = F.to_json(F.struct("ns", "doc_id"), {"ignoreNullFields": "false"})
    return docs.withColumn("_key", key).join(_since_base(rows), "_key").select("ns", "doc_id", "doc", "n_changes")


def existing(log: DataFrame) -> DataFrame:
    """(ns, doc_id) of the documents that exist after a log without schema events: those whose last base change or deletion is a base change."""
    rows = _documents_only(log, schema=False).where("_kind <> 'patch'")
    return rows.groupBy("ns", "doc_id").agg(F.max_by("_kind", "_at").alias("_last")).where("_last = 'base'").select("ns", "doc_id")


def compact(log: DataFrame) -> DataFrame:
    """The changes of ``log`` that its fold still depends on, after its schema events: the last base or deletion of each key and, for each
    place, its last writers since. Folding what is kept with any later changes gives what folding the whole log gives."""
    rows = _documents_only(log)
    last = _last_writes(rows, True)
    bases = last.where("field IS NULL").select(F.col("ns").alias("_ns"), F.col("doc_id").alias("_id"), F.col("at").alias("_base"))
    both = last.join(bases, F.col("ns").eqNullSafe(F.col("_ns")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").where("_base IS NULL OR at >= _base")
    needed = both.select(F.col("ns").alias("_ns"), F.col("doc_id").alias("_id"), F.col("at").alias("_needed")).distinct()
    # joined by key and place together, which no two changes share, so a key with many changes is not one task's
    match = F.col("ns").eqNullSafe(F.col("_ns")) & F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_needed"))
    return rows.join(needed, match, "left_semi").select(*log.columns)

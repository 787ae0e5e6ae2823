"""Rows to chunks by split points of any ordered kind of key: numbers, text, bytes, identifiers as hex, and composite keys.

A row's chunk is the number of points that are not above its key. Composite keys compare field by field; a field of a point that is null is the least
key of all, below nulls in rows too, so a point that names the first field alone begins that field's range.

Up to ``POINTS_HELD`` points are held by every task as one sorted array, in which each row searches by halves: as many steps as the number of points has binary
digits, and the rows are not moved. More points meet the rows by sorting: both are dealt by ranges of the key, and a row counts the points before it in its
range and those of the ranges before. Rows move without keys that are expressions of their columns.

Cases: a null key (all of whose fields are null) lies below all points but those that are null themselves; repeated points count once; without points all rows are in
chunk 0; columns whose names clash with those of the points are left alone.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tidemark.frames import table
from tidemark.shared import written

#: Points that a task holds; a point is a key, so this bounds what is sent to each.
POINTS_HELD = 1 << 16


def _key(columns: list[str | Column]) -> Column:
    return F.struct(*((F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(columns)))


def by_search(rows: DataFrame, keys: list[str | Column], points: DataFrame, name: str, n: int) -> DataFrame:
    """``rows`` with their chunk, by halving a sorted array of ``n`` points."""
    held = F.broadcast(points.agg(F.array_sort(F.collect_list("_point")).alias("_points")))  # one row, of bounded size

    def half(at, _):
        mid = ((at["lo"] + at["hi"]) / 2).cast("int")
        inside = at["lo"] < at["hi"]
        below = F.element_at("_points", mid + 1) <= F.col("_key")
        return F.struct(F.when(inside & below, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(inside & ~below, mid).otherwise(at["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(max(1, n.bit_length() + 1)))
    found = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size("_points").alias("hi")), half)["lo"] if n else F.lit(0)
    return rows.withColumn("_key", _key(keys)).crossJoin(held).withColumn(name, found.cast("long")).drop("_key", "_points")


def _counted(batches: Iterator[pa.RecordBatch], is_point: str, inside: str, part: str) -> Iterator[pa.RecordBatch]:
    """The rows of a sorted part with the number of points before them in it, and last the number of all its points in a row without a part."""
    seen, number, schema = 0, TaskContext.get().partitionId(), None
    for b in batches:
        points = b.column(is_point).to_numpy(zero_copy_only=False)
        upto = seen + np.cumsum(points, dtype=np.int64)
        kept, schema = b.drop_columns([is_point]), b.drop_columns([is_point]).schema
        out = pa.RecordBatch.from_arrays([*kept.columns, pa.array(upto), pa.array(np.full(len(b), number, np.int32))], names=[*kept.schema.names, inside, part])
        yield out.filter(pa.array(~points))
        seen = int(upto[-1]) if len(b) else seen
    if seen:
        yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in schema), pa.array([-1 - seen]), pa.array([number], pa.int32())], names=[*schema.names, inside, part])


def by_sort(rows: DataFrame, keys: list[str | Column], points: DataFrame, name: str) -> DataFrame:
    """``rows`` with their chunk, by sorting points among them. Rows are moved once, without their keys, which are computed on both sides of the shuffle; points are
    counted in the order of each part as it is read, and the counts are written with the rows."""
    tag = uuid.uuid4().hex[:12]  # no column of the rows has such a name
    point, at, is_point, inside, part = (f"_{n}_{tag}" for n in ("point", "at", "is_point", "inside", "part"))
    both = rows.withColumn(point, F.lit(None).cast(points.schema["_point"].dataType)).unionByName(points.select(F.col("_point").alias(point)), allowMissingColumns=True)
    key = F.coalesce(F.col(point), _key(keys))
    dealt = both.repartitionByRange(key, F.col(point).isNull()).withColumn(at, key).withColumn(is_point, F.col(point).isNotNull())
    ordered = dealt.sortWithinPartitions(F.col(at), ~F.col(is_point)).select(*(F.col(f"`{c}`") for c in rows.columns), is_point)
    schema = StructType([StructField(f.name, f.dataType) for f in rows.schema] + [StructField(inside, LongType()), StructField(part, IntegerType())])
    held = written(ordered.mapInArrow(lambda batches: _counted(batches, is_point, inside, part), schema), "assign")
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    sums = held.groupBy(part).agg(F.coalesce(F.sum(F.when(F.col(inside) < 0, -1 - F.col(inside))), F.lit(0)).alias("_n"))
    shift = sums.select(part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    out = held.where(F.col(inside) >= 0).join(F.broadcast(shift), part)
    return out.select(*(F.col(f"`{c}`") for c in rows.columns), (F.col(inside) + F.col("_shift")).cast("long").alias(name))


def chunks_of(rows: DataFrame, keys: list[str | Column], points: DataFrame, name: str = "chunk", held: int = POINTS_HELD) -> DataFrame:
    """``rows`` with the number of ``points`` (columns in the order of ``keys`` and of their types) that are not above their key. Keys are columns, or
    expressions of them, which are not kept in the rows."""
    sorted_points = written(points.select(_key(points.columns).alias("_point")).distinct(), "split-points")
    n = sorted_points.count()
    return by_search(rows, keys, sorted_points, name, n) if n <= held else by_sort(rows, keys, sorted_points, name)


def _uuid(text) -> Column:
    m = F.md5(text.cast("binary"))
    return F.concat_ws("-", *(F.substring(m, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))))


def key_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item by keys of four kinds that its numbers give, against points at two thirds of the orders."""
    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders").where("o_orderkey % 3 <> 0")
    name = F.concat(F.lit("k"), F.col("l_orderkey"), F.lit("-"), F.col("l_linenumber"))
    own = F.concat(F.lit("k"), F.col("o_orderkey"))
    oid = lambda text: F.substring(F.md5(text.cast("binary")), 9, 24)
    first = lambda text: F.substring(F.md5(text.cast("binary")), 1, 2)
    rows = items.select("l_orderkey", "l_linenumber")
    rows = chunks_of(rows, [_uuid(name)], orders.select(_uuid(own).alias("p")), "uuid_chunk")
    rows = chunks_of(rows, [oid(name)], orders.select(oid(own).alias("p")), "oid_chunk")
    rows = chunks_of(rows, [name.cast("binary")], orders.select(own.cast("binary").alias("p")), "text_chunk", held=1000)
    pairs = orders.select(first(own).alias("p"), F.when(F.col("o_orderkey") % 2 == 0, oid(own)).alias("q"))
    rows = chunks_of(rows, [first(name), oid(name)], pairs, "pair_chunk")
    return rows.select("l_orderkey", "l_linenumber", "uuid_chunk", "oid_chunk", "text_chunk", "pair_chunk")


QUERIES = {"key_chunks": key_chunks}
_AS_UUID = "substr({0}, 1, 8) || '-' || substr({0}, 9, 4) || '-' || substr({0}, 13, 4) || '-' || substr({0}, 17, 4) || '-' || substr({0}, 21, 12)"
SQL = {
    "key_chunks": f"""WITH i AS (SELECT l_orderkey, l_linenumber, 'k' || l_orderkey || '-' || l_linenumber AS name, md5('k' || l_orderkey || '-' || l_linenumber) AS m FROM lineitem), o AS (SELECT o_orderkey, 'k' || o_orderkey AS name, md5('k' || o_orderkey) AS m FROM orders WHERE o_orderkey % 3 <> 0),
        r AS (SELECT l_orderkey, l_linenumber, {_AS_UUID.format("m")} AS uuid, substr(m, 9, 24) AS oid, name AS text, substr(m, 1, 2) || substr(m, 9, 24) AS pair FROM i),
        pu AS (SELECT p, row_number() OVER (ORDER BY p) AS n FROM (SELECT DISTINCT {_AS_UUID.format("m")} AS p FROM o)), po AS (SELECT p, row_number() OVER (ORDER BY p) AS n FROM (SELECT DISTINCT substr(m, 9, 24) AS p FROM o)),
        pt AS (SELECT p, row_number() OVER (ORDER BY p) AS n FROM (SELECT DISTINCT name AS p FROM o)), pp AS (SELECT p, row_number() OVER (ORDER BY p) AS n FROM (SELECT DISTINCT substr(m, 1, 2) || CASE WHEN o_orderkey % 2 = 0 THEN substr(m, 9, 24) ELSE '' END AS p FROM o))
        SELECT l_orderkey, l_linenumber, coalesce(pu.n, 0) AS uuid_chunk, coalesce(po.n, 0) AS oid_chunk, coalesce(pt.n, 0) AS text_chunk, coalesce(pp.n, 0) AS pair_chunk
        FROM r ASOF LEFT JOIN pu ON r.uuid >= pu.p ASOF LEFT JOIN po ON r.oid >= po.p ASOF LEFT JOIN pt ON r.text >= pt.p ASOF LEFT JOIN pp ON r.pair >= pp.p""",
}

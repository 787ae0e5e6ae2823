"""Split points of partition keys and placement of the parts.

Splitting is arithmetic on bounds: the number of points depends on the number of parts, not on the data. Points beyond 64 bits are
whole numbers of Python on the driver and become rows of a small frame.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.frames import cte, frame, source, table
from tidemark.functions.keys import key_parts
from tidemark.plans.assign import chunks_of
from tidemark.shared import written

CHUNK_BYTES = 128 << 20
DIGITS = "0123456789abcdef"


def chunk_count(shards: Column, explicit: Column, size: Column) -> Column:
    """Parts to aim at: as told, else one for each 128 MiB if that is more than two and more than the shards, else twice those; two at least."""
    least = F.greatest(shards, F.lit(2))
    by_size = F.floor(size / CHUNK_BYTES)
    return F.greatest(F.when(explicit > 0, explicit).when((size > 0) & (by_size > least), by_size).otherwise(least * 2), F.lit(2)).cast("long")


def split_range(low: int, high: int, parts: int, least_step: int = 0) -> list[int]:
    """``parts - 1`` points from ``low`` in equal steps; none for an empty range."""
    if high <= low:
        return []
    step = max(least_step, (high - low) // parts)
    return [low + step * i for i in range(1, parts)]


def split_bytes(low: bytes, high: bytes, parts: int, keep_width: bool = True) -> list[bytes]:
    """Points between byte strings read as big-endian numbers; the shorter is filled with zeros on its right."""
    width = max(len(low), len(high))
    a, b = (int.from_bytes(x.ljust(width, b"\0"), "big") for x in (low, high))
    points = split_range(a, b, parts)
    return [p.to_bytes(width if keep_width else max(1, (p.bit_length() + 7) // 8), "big") for p in points]


def split_ring(parts: int) -> list[int]:
    """Points of the signed 64-bit ring."""
    step = (2**64 - 1) // parts
    return [-(2**63) + step * i for i in range(1, parts)]


def split_date(low: str, high: str, parts: int) -> list[int]:
    """Points between dates (``yyyy-MM-dd`` or RFC 3339) in milliseconds since 1970."""
    ms = lambda s: int(dt.datetime.fromisoformat(s if len(s) > 10 else f"{s}T00:00:00+00:00").timestamp() * 1000)
    return split_range(ms(low), ms(high), parts, 1)


def composite_points(uuid_field: str, oid_field: str) -> list[tuple[str | None, str | None]]:
    """(uuid, object id) points: 16 object ids without a uuid if there are both fields, then 255 uuid prefixes if there is a uuid field."""
    out: list[tuple[str | None, str | None]] = []
    if uuid_field and oid_field:
        out += [(None, d.ljust(24, "0")) for d in DIGITS]
    if uuid_field:
        out += [(f"{n:02x}".ljust(32, "0"), None) for n in range(1, 256)]
    return out


def place_round_robin(chunks: DataFrame, shards: DataFrame) -> DataFrame:
    """Chunks with the shard they should be on: in the order of their keys round the shards in the order of their ids. Chunks that are
    too large to move stay."""
    names = shards.agg(F.array_sort(F.collect_list("id")).alias("names"))
    nth = F.row_number().over(Window.partitionBy("ns").orderBy("min_key")) - 1
    placed = chunks.withColumn("chunk", nth).crossJoin(F.broadcast(names))
    wanted = F.col("names")[F.pmod(F.col("chunk"), F.size("names"))]
    moves = (F.size("names") >= 2) & ~F.col("jumbo") & (F.col("shard") != wanted)
    return placed.select("ns", "chunk", "min_key", "shard", "jumbo", wanted.alias("wanted"), moves.alias("move"))


def chunk_of(key: Column, points: list[int]) -> Column:
    """The number of points at or below a key: its chunk. Points are few and become part of the expression."""
    return F.size(F.filter(F.array(*(F.lit(p).cast("long") for p in points)), lambda p: p <= key))


def initial_chunks(rules: DataFrame, shards: int) -> DataFrame:
    """Chunks that a collection hashed by its first or only key starts with: one if it is split by hand, else as told, else two for each shard."""
    first_hashed = F.col("shard_key").rlike(r"(?i)^[^,]*:\s*hashed\s*(,|$)")
    told = F.when(F.col("initial_chunks") > 0, F.col("initial_chunks")).otherwise(2 * shards if shards else 2)
    return rules.where(first_hashed).select("rule_no", F.when(F.col("strategy") == "hashed_manual", 1).otherwise(told).cast("long").alias("n"))


def dispatch(rules: DataFrame, sharded: DataFrame) -> DataFrame:
    """(rule_no, ns, action): the first rule of each namespace gives its strategy, later ones are passed over, and so are namespaces that are
    partitioned already."""
    first = rules.groupBy("ns").agg(F.min("rule_no").alias("_first"))
    live = sharded.where(~F.col("dropped")).select("ns", F.lit(True).alias("_live")).distinct()
    rows = rules.join(first, "ns").join(live, "ns", "left")
    action = F.when(F.col("rule_no") > F.col("_first"), "skip: later rule").when(F.coalesce("_live", F.lit(False)), "skip: partitioned").otherwise(F.col("strategy"))
    return rows.select("rule_no", "ns", action.alias("action"))


def bound_texts(rules: DataFrame, points: DataFrame, uuid_field: str, oid_field: str) -> DataFrame:
    """(rule_no, place, bound) for ``points`` (strategy, place, point, uuid, oid): the bounds that each rule sets. The first field of its key takes the point (a
    composite's two fields theirs), all others their least value.

    Bounds depend on strategy and key alone, so they are put together once for each two of them that occur and written; rules, which may be many rows in few
    files, are dealt over the cores and joined to them."""
    shapes = rules.select("strategy", "shard_key").distinct()
    both = shapes.join(F.broadcast(points), "strategy")  # as many rows as strategies have points

    def part(field: Column, i: Column) -> Column:
        own = F.when(field == uuid_field, F.col("uuid")).when(field == oid_field, F.col("oid"))
        value = F.when(F.col("strategy") == "composite_uuid_oid", own).otherwise(F.when(i == 0, F.col("point")))
        return F.concat(field, F.lit(": "), F.coalesce(value, F.lit("MinKey")))

    fields = F.transform(key_parts(F.col("shard_key")), lambda p: p["field"])
    bounds = written(both.select(F.col("strategy").alias("_strategy"), F.col("shard_key").alias("_key"), "place", F.array_join(F.transform(fields, part), ", ").alias("bound")), "bounds")
    dealt = rules.select("rule_no", "strategy", "shard_key").repartition(4 * rules.sparkSession.sparkContext.defaultParallelism, "rule_no")
    return dealt.join(bounds, (F.col("strategy") == F.col("_strategy")) & F.col("shard_key").eqNullSafe(F.col("_key"))).select("rule_no", "place", "bound")


def _points(spark: SparkSession, rows: list, schema: str = "place int, point string") -> DataFrame:
    return spark.createDataFrame(rows, schema)


def target_chunk_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, "sizing", sf_dir).select("no", chunk_count(F.col("shards"), F.col("explicit_chunks"), F.col("size")).alias("chunks"))


def split_int64(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = source(spark, sf_dir).agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return _points(spark, list(enumerate(split_range(low, high, 8, 1), 1)), "place int, point long")


def split_date_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = source(spark, sf_dir).agg(F.min(F.to_date("o_orderdate")).cast("string"), F.max(F.to_date("o_orderdate")).cast("string")).first()
    return _points(spark, list(enumerate(split_date(low, high, 12), 1)), "place int, point long")


def _with_rows(points: DataFrame, rows: DataFrame) -> DataFrame:
    """``points`` with n, the rows of the chunk that each begins; keys are the columns of both in their order."""
    chunks = chunks_of(rows, rows.columns, points).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    ranked = points.withColumn("chunk", F.row_number().over(Window.orderBy(F.struct(*points.columns))).cast("long"))  # as many rows as points
    return ranked.join(chunks, "chunk", "left").select(F.col("chunk").cast("int").alias("place"), *points.columns, F.coalesce("n", F.lit(0)).alias("n"))


def _split_hex(spark: SparkSession, rows: DataFrame, parts: int, keep_width: bool = True) -> DataFrame:
    """Points between the least and the greatest of ``rows`` (one column of hex), with the rows of each chunk."""
    low, high = (bytes.fromhex(x) for x in rows.agg(F.min(rows.columns[0]), F.max(rows.columns[0])).first())
    points = [(p.hex(),) for p in split_bytes(low, high, parts, keep_width)]
    return _with_rows(spark.createDataFrame(points, "point string"), rows)


def _ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", F.md5(F.col("c_name").cast("binary")).alias("m"))


def split_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identifiers below 2^127, as the SQL's numbers end there."""
    return _split_hex(spark, _ids(spark, sf_dir).select(F.concat(F.lit("4"), F.substring("m", 2, 31)).alias("m")), 16)


def split_objectid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split_hex(spark, _ids(spark, sf_dir).select(F.substring("m", 1, 24).alias("m")), 10)


def split_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points as hex: they need not be valid UTF-8."""
    text = F.rpad(F.lower(F.hex(F.substring("p_name", 1, 8).cast("binary"))), 16, "0")
    return _split_hex(spark, table(spark, sf_dir, "part").select(text.alias("m")), 5, False)


def split_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two parts for each shard."""
    shards = frame(spark, "shards", sf_dir).where(F.col("host").contains("/")).count()
    return _points(spark, list(enumerate(split_ring(2 * shards), 1)), "place int, point long")


def split_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_rows(spark.createDataFrame([(d,) for d in DIGITS], "point string"), _ids(spark, sf_dir).select("m"))


def split_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of a uuid, which some documents lack, and an object id."""
    rows = _ids(spark, sf_dir).select(F.when(F.col("c_custkey") % 5 != 0, F.col("m")).alias("uuid"), F.substring("m", 5, 24).alias("oid"))
    return _with_rows(spark.createDataFrame(composite_points("u", "o"), "uuid string, oid string"), rows)


def initial_chunks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return initial_chunks(frame(spark, "rules", sf_dir), 3)


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = source(spark, sf_dir)
    low, high = rows.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return rows.select("o_orderkey", chunk_of(F.col("o_orderkey"), split_range(low, high, 8, 1)).alias("chunk"))


def split_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dispatch(frame(spark, "rules", sf_dir), frame(spark, "sharded", sf_dir))


def split_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bounds that each rule would set: four ranges of the orders' keys, six parts of the ring, hex digits, or composite points."""
    low, high = source(spark, sf_dir).agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    made = {"range_manual": split_range(low, high, 4, 1), "hashed_manual": split_ring(6), "hex": DIGITS}
    rows = [(name, i, str(p), None, None) for name, points in made.items() for i, p in enumerate(points, 1)]
    rows += [("composite_uuid_oid", i, None, u, o) for i, (u, o) in enumerate(composite_points("u", "o"), 1)]
    points = spark.createDataFrame(rows, "strategy string, place int, point string, uuid string, oid string")
    return bound_texts(frame(spark, "rules", sf_dir), points, "u", "o")


def chunk_skew(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return place_round_robin(frame(spark, "chunks", sf_dir), frame(spark, "shards", sf_dir).where(F.col("host").contains("/")))


def chunk_moves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _placed(spark, sf_dir).where("move").select("ns", "min_key", F.col("shard").alias("from_shard"), F.col("wanted").alias("to_shard"))


def split_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points still to be made, at every fifth key: each once, and none that is a boundary already."""
    wanted = source(spark, sf_dir).where("o_orderkey % 5 = 0").select(F.col("o_orderkey").alias("point"))
    there = frame(spark, "chunks", sf_dir).where("ns = 'shop.c0'").select(F.col("min_key").alias("point"))
    return wanted.union(wanted).dropDuplicates().join(there, "point", "left_anti")


QUERIES = {
    "target_chunk_count": target_chunk_count, "split_int64": split_int64, "split_date": split_date_query, "split_uuid": split_uuid, "split_objectid": split_objectid, "split_string": split_string, "split_hash_ring": split_hash_ring,
    "split_hex": split_hex, "split_composite": split_composite, "initial_chunks": initial_chunks_query, "chunk_assignment": _assigned, "chunk_skew": chunk_skew, "chunk_distribution": _placed, "chunk_moves": chunk_moves, "split_idempotent": split_idempotent, "split_dispatch": split_dispatch, "split_bounds": split_bounds,
}
_ASSIGN = "b AS (SELECT min(o_orderkey) AS lo, greatest(1, (max(o_orderkey) - min(o_orderkey)) // 8) AS step FROM orders), a AS (SELECT o_orderkey, least(7, greatest(0, (o_orderkey - lo) // step))::INTEGER AS chunk FROM orders, b)"
_PLACE = "s AS (SELECT list(id ORDER BY id) AS names FROM shards WHERE contains(host, '/')), n AS (SELECT *, (row_number() OVER (PARTITION BY ns ORDER BY min_key) - 1)::INTEGER AS chunk FROM chunks), p AS (SELECT ns, chunk, min_key, shard, jumbo, names[chunk % len(names) + 1] AS wanted, NOT jumbo AND shard <> names[chunk % len(names) + 1] AS move FROM n, s)"
#: Points of hex keys of up to 32 digits by 128-bit arithmetic, and the rows from each point on.
_SPLIT = """WITH r AS ({rows}), v AS (SELECT min(m) AS lo, max(m) AS hi FROM r), w AS (SELECT lpad(lo, 32, '0') AS lo, lpad(hi, 32, '0') AS hi FROM v),
        x AS (SELECT ('0x' || substr(lo, 1, 16))::UBIGINT::HUGEINT * 18446744073709551616::HUGEINT + ('0x' || substr(lo, 17))::UBIGINT AS lo, ('0x' || substr(hi, 1, 16))::UBIGINT::HUGEINT * 18446744073709551616::HUGEINT + ('0x' || substr(hi, 17))::UBIGINT AS hi FROM w),
        p AS (SELECT i, lo + ((hi - lo) // {parts}::HUGEINT) * i::HUGEINT AS v FROM x, unnest(range(1, {parts})) AS g(i)),
        q AS (SELECT i, right(lpad(printf('%x', (v // 18446744073709551616::HUGEINT)::UBIGINT), 16, '0') || lpad(printf('%x', (v % 18446744073709551616::HUGEINT)::UBIGINT), 16, '0'), {wide}) AS point FROM p),
        c AS (SELECT point, count(*) AS n FROM r ASOF JOIN q ON r.m >= q.point GROUP BY point) SELECT i::INTEGER AS place, q.point, coalesce(n, 0) AS n FROM q LEFT JOIN c ON q.point = c.point"""
SQL = {
    "target_chunk_count": cte("sizing") + "SELECT no, greatest(2, CASE WHEN explicit_chunks > 0 THEN explicit_chunks WHEN size // 134217728 > greatest(shards, 2) THEN size // 134217728 ELSE 2 * greatest(shards, 2) END)::BIGINT AS chunks FROM sizing",
    "split_int64": "WITH b AS (SELECT min(o_orderkey) AS lo, greatest(1, (max(o_orderkey) - min(o_orderkey)) // 8) AS step FROM orders) SELECT i::INTEGER AS place, lo + step * i AS point FROM b, unnest(range(1, 8)) AS g(i)",
    "split_date": "WITH b AS (SELECT epoch_ms(min(o_orderdate)::DATE::TIMESTAMP) AS lo, epoch_ms(max(o_orderdate)::DATE::TIMESTAMP) AS hi FROM orders) SELECT i::INTEGER AS place, lo + greatest(1, (hi - lo) // 12) * i AS point FROM b, unnest(range(1, 12)) AS g(i)",
    "split_dispatch": cte("rules", "sharded") + """SELECT rule_no, ns, CASE WHEN EXISTS (SELECT 1 FROM rules o WHERE o.ns = r.ns AND o.rule_no < r.rule_no) THEN 'skip: later rule' WHEN EXISTS (SELECT 1 FROM sharded s WHERE s.ns = r.ns AND NOT dropped) THEN 'skip: partitioned' ELSE strategy END AS action FROM rules r""",
    "split_bounds": cte("rules") + """, b AS (SELECT min(o_orderkey) AS lo, greatest(1, (max(o_orderkey) - min(o_orderkey)) // 4) AS step FROM orders),
        p AS (SELECT 'range_manual' AS strategy, i::INTEGER AS place, (lo + step * i)::VARCHAR AS point, NULL::VARCHAR AS u, NULL::VARCHAR AS o FROM b, unnest(range(1, 4)) AS g(i)
        UNION ALL SELECT 'hashed_manual', i::INTEGER, ((-9223372036854775808)::HUGEINT + (18446744073709551615::HUGEINT // 6) * i)::VARCHAR, NULL, NULL FROM unnest(range(1, 6)) AS g(i)
        UNION ALL SELECT 'hex', (i + 1)::INTEGER, substr('0123456789abcdef', i + 1, 1), NULL, NULL FROM unnest(range(0, 16)) AS g(i)
        UNION ALL SELECT 'composite_uuid_oid', (i + 1)::INTEGER, NULL, NULL, rpad(substr('0123456789abcdef', i + 1, 1), 24, '0') FROM unnest(range(0, 16)) AS g(i)
        UNION ALL SELECT 'composite_uuid_oid', (i + 16)::INTEGER, NULL, rpad(printf('%02x', i), 32, '0'), NULL FROM unnest(range(1, 256)) AS g(i)),
        f AS (SELECT rule_no, strategy, trim(split_part(unnest(string_split(shard_key, ',')), ':', 1)) AS field, unnest(range(0, len(string_split(shard_key, ',')))) AS k FROM rules)
        SELECT rule_no, place, string_agg(field || ': ' || coalesce(CASE WHEN strategy = 'composite_uuid_oid' THEN CASE field WHEN 'u' THEN u WHEN 'o' THEN o END WHEN k = 0 THEN point END, 'MinKey'), ', ' ORDER BY k) AS bound FROM f JOIN p USING (strategy) GROUP BY rule_no, place""",
    "split_uuid": _SPLIT.format(rows="SELECT '4' || substr(md5(c_name), 2) AS m FROM customer", wide=32, parts=16),
    "split_objectid": _SPLIT.format(rows="SELECT substr(md5(c_name), 1, 24) AS m FROM customer", wide=24, parts=10),
    "split_string": _SPLIT.format(rows="SELECT rpad(lower(hex(encode(substr(p_name, 1, 8)))), 16, '0') AS m FROM part", wide=16, parts=5),
    "split_hash_ring": cte("shards") + ", n AS (SELECT 2 * count(*) AS n FROM shards WHERE contains(host, '/')) SELECT i::INTEGER AS place, ((-9223372036854775808)::HUGEINT + (18446744073709551615::HUGEINT // n) * i)::BIGINT AS point FROM n, unnest(range(1, n)) AS g(i)",
    "split_hex": "SELECT (i + 1)::INTEGER AS place, substr('0123456789abcdef', i + 1, 1) AS point, (SELECT count(*) FROM customer WHERE substr(md5(c_name), 1, 1) = substr('0123456789abcdef', i + 1, 1)) AS n FROM (SELECT unnest(range(0, 16)) AS i)",
    "split_composite": """WITH p AS (SELECT NULL::VARCHAR AS uuid, rpad(substr('0123456789abcdef', i + 1, 1), 24, '0') AS oid FROM unnest(range(0, 16)) AS g(i) UNION ALL SELECT rpad(printf('%02x', i), 32, '0'), NULL FROM unnest(range(1, 256)) AS h(i)),
        k AS (SELECT *, coalesce(uuid, repeat(' ', 32)) || coalesce(oid, '') AS b FROM p), r AS (SELECT CASE WHEN c_custkey % 5 <> 0 THEN md5(c_name) ELSE repeat(' ', 32) END || substr(md5(c_name), 5, 24) AS key FROM customer),
        c AS (SELECT b, count(*) AS n FROM r ASOF JOIN k ON r.key >= k.b GROUP BY b) SELECT (row_number() OVER (ORDER BY k.b))::INTEGER AS place, uuid, oid, coalesce(n, 0) AS n FROM k LEFT JOIN c ON k.b = c.b""",
    "initial_chunks": cte("rules") + r"SELECT rule_no, CASE WHEN strategy = 'hashed_manual' THEN 1 WHEN initial_chunks > 0 THEN initial_chunks ELSE 6 END::BIGINT AS n FROM rules WHERE lower(trim(split_part(split_part(shard_key, ',', 1), ':', 2))) = 'hashed'",
    "chunk_assignment": f"WITH {_ASSIGN} SELECT * FROM a",
    "chunk_skew": f"WITH {_ASSIGN} SELECT chunk, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM a GROUP BY chunk",
    "chunk_distribution": cte("shards", "chunks") + f", {_PLACE} SELECT * FROM p",
    "chunk_moves": cte("shards", "chunks") + f", {_PLACE} SELECT ns, min_key, shard AS from_shard, wanted AS to_shard FROM p WHERE move",
    "split_idempotent": cte("chunks") + "SELECT o_orderkey AS point FROM orders WHERE o_orderkey % 5 = 0 AND o_orderkey NOT IN (SELECT min_key FROM chunks WHERE ns = 'shop.c0')",
}

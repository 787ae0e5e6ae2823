"""Column functions on keys, namespaces and messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.frames import CHANGES, cte, frame, table

#: Parts of messages, lower case: fixed values.
FATAL = ("authentication failed", "sasl conversation error", "mechanism mismatch", "unauthorized")
RETRYABLE = ("too many cursors", "incomplete read", "connection", "network", "timeout", "cursor not found", "context canceled")
#: Parts of messages that no repetition can help, as they are written.
UNRECOVERABLE = ("update document must have at least one element", "shard key", "Failed to target")


def namespace(db: Column, coll: Column) -> Column:
    return F.concat(db, F.lit("."), coll)


def database_of(ns: Column) -> Column:
    """What stands before the first dot; all without one."""
    return F.substring_index(ns, ".", 1)


def collection_of(ns: Column) -> Column:
    """What stands after the first dot; empty without one."""
    return F.when(F.instr(ns, ".") > 0, F.substring(ns, F.instr(ns, ".") + 1, F.length(ns))).otherwise("")


def uuid_text(hex32: Column) -> Column:
    h = F.lower(hex32)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def canonical_id(kind: Column, hexed: Column, text: Column) -> Column:
    """One text for every kind of id: object ids as 24 hex digits, UUIDs with dashes, all else as it prints."""
    return F.when(kind == "objectid", F.lower(hexed)).when(kind == "uuid", uuid_text(hexed)).otherwise(text)


def fnv1a(text: Column) -> Column:
    """FNV-1a of 32 bits over the UTF-8 bytes."""
    digits = F.hex(F.encode(text, "utf-8"))
    places = F.when(F.length(digits) > 0, F.sequence(F.lit(0), (F.length(digits) / 2 - 1).cast("int"))).otherwise(F.array().cast("array<int>"))
    step = lambda h, b: (h.bitwiseXOR(b) * 16777619).bitwiseAND(4294967295)
    values = F.transform(places, lambda i: F.conv(F.substring(digits, i * 2 + 1, F.lit(2)), 16, 10).cast("long"))
    return F.aggregate(values, F.lit(2166136261).cast("long"), step)


def worker_of(doc_id: Column, workers: int = 4) -> Column:
    """The worker that applies all changes of a document, in order."""
    return (fnv1a(doc_id.cast("string")) % workers).cast("int")


def coerce(kind: Column, text: Column) -> tuple[Column, Column]:
    """(type, value) of a JSON value: wrapped or bare ids, integral numbers as long, anything else as it is."""
    trimmed = F.trim(text)
    oid = F.regexp_extract(trimmed, r"(?i)^(?:ObjectId\(['\"]([0-9a-f]{24})['\"]\)|([0-9a-f]{24}))$", 0)
    uid = F.regexp_extract(trimmed, r"(?i)^(?:UUID\(['\"])?([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})(?:['\"]\))?$", 1)
    number = text.try_cast("double")
    integral = (kind == "number") & (number == F.floor(number))
    made = F.when(integral, "long").when(kind == "number", "double").when(oid != "", "objectid").when(uid != "", "uuid").otherwise("string")
    hexed = F.regexp_extract(trimmed, r"([0-9a-fA-F]{24})", 1)
    value = F.when(integral, number.try_cast("long").cast("string")).when(kind == "number", number.cast("string")).when(oid != "", F.lower(hexed)).when(uid != "", F.lower(uid)).otherwise(text)
    return made, value


def key_parts(spec: Column) -> Column:
    """Array of (field, direction) of a spec as ``a:1, b:hashed``: hashed, -1, or else 1."""
    def part(p: Column) -> Column:
        way = F.lower(F.trim(F.coalesce(F.get(F.split(p, ":"), F.lit(1)), F.lit("1"))))
        return F.struct(F.trim(F.split(p, ":")[0]).alias("field"), F.when(way.isin("hashed", "-1"), way).otherwise("1").alias("direction"))

    return F.transform(F.split(spec, ","), lambda p: part(F.trim(p)))


def error_class(message: Column) -> Column:
    low = F.lower(message)
    has = lambda text, parts: F.greatest(*(text.contains(p) for p in parts), F.lit(False))
    return F.when(has(low, FATAL), "fatal").when(message.contains("E11000"), "duplicate").when(has(message, UNRECOVERABLE), "unrecoverable").when(has(low, RETRYABLE), "retryable").otherwise("other")


def human_bytes(n: Column) -> Column:
    scaled = lambda unit: n.cast("double") / unit
    return (
        F.when(n >= 1 << 30, F.format_string("%.1f GB", scaled(1 << 30))).when(n >= 1 << 20, F.format_string("%.1f MB", scaled(1 << 20)))
        .when(n >= 1 << 10, F.format_string("%.0f KB", scaled(1 << 10))).otherwise(F.format_string("%d B", n))
    )


def nested(json: Column, path: str) -> tuple[Column, Column]:
    """(value, whether it was there) of a dotted path in a JSON document; arrays are not entered."""
    value = F.get_json_object(json, "$." + path)
    return value, value.isNotNull()


def namespace_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, "catalog", sf_dir).select(namespace(F.col("db"), F.col("coll")).alias("ns")).union(spark.sql("SELECT 'bare' AS ns"))
    return rows.select("ns", database_of(F.col("ns")).alias("db"), collection_of(F.col("ns")).alias("coll"))


def canonical_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, "ids", sf_dir).select("no", canonical_id(F.col("kind"), F.col("hex"), F.col("txt")).alias("id"))


def route_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer")
    return rows.select("c_custkey", fnv1a(F.col("c_name")).alias("hash"), worker_of(F.col("c_name")).alias("worker"))


def coerce_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, value = coerce(F.col("kind"), F.col("txt"))
    return frame(spark, "requests", sf_dir).select("no", kind.alias("type"), value.alias("value"))


def request_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The filter of each key of a request: its id alone, or all parts of a composite key, with coerced values, by name."""
    kind, value = coerce(F.col("kind"), F.col("txt"))
    values = frame(spark, "requests", sf_dir).select("no", kind.alias("type"), value.alias("value"))
    parts = frame(spark, "request_keys", sf_dir).join(values, "no").select("req", "place", F.concat_ws("", "field", F.lit("="), "type", F.lit(":"), "value").alias("part"))
    return parts.groupBy("req", "place").agg(F.array_join(F.array_sort(F.collect_list("part")), " and ").alias("filter"))


def parse_shard_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, "rules", sf_dir).select("rule_no", F.posexplode(key_parts(F.col("shard_key"))).alias("place", "part"))
    return rows.select("rule_no", "place", "part.field", "part.direction")


def classify_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame(spark, "errors", sf_dir).select("no", error_class(F.col("message")).alias("class"))


def human_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = (F.col("n_chars") * F.col("n_chars") * 7).cast("long")
    return table(spark, sf_dir, "documents").select("doc_id", human_bytes(n).alias("size"))


def nested_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    value, found = nested(F.col("props"), "k")
    missing = nested(F.col("props"), "k.deep")[1]
    return table(spark, sf_dir, "events").select("event_id", value.cast("long").alias("k"), found.alias("found"), missing.alias("found_deep"))


def write_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key of each write: the shard-key field of the full document where there is one, else that of the document key."""
    from tidemark.frames import changes

    full = F.when(F.col("op").isin("insert", "replace"), F.floor("value").cast("long"))
    return changes(spark, sf_dir).select("event_id", F.coalesce(full, F.col("doc_id") % 4).alias("shard_value"), "doc_id")


QUERIES = {
    "namespace_split": namespace_split, "canonical_id": canonical_ids, "route_hash": route_hash, "coerce_ids": coerce_ids, "request_filters": request_filters, "parse_shard_key": parse_shard_key,
    "classify_errors": classify_errors, "human_bytes": human_sizes, "nested_lookup": nested_lookup, "write_filter": write_filter,
}
_any = lambda text, parts: "(" + " OR ".join(f"contains({text}, '{p}')" for p in parts) + ")"
SQL = {
    "namespace_split": cte("catalog") + """, n AS (SELECT db || '.' || coll AS ns FROM catalog UNION ALL SELECT 'bare')
        SELECT ns, split_part(ns, '.', 1) AS db, CASE WHEN strpos(ns, '.') > 0 THEN substr(ns, strpos(ns, '.') + 1) ELSE '' END AS coll FROM n""",
    "canonical_id": cte("ids") + """SELECT no, CASE kind WHEN 'objectid' THEN lower(hex) WHEN 'uuid' THEN lower(substr(hex, 1, 8) || '-' || substr(hex, 9, 4) || '-' || substr(hex, 13, 4) || '-' || substr(hex, 17, 4) || '-' || substr(hex, 21, 12)) ELSE txt END AS id FROM ids""",
    "route_hash": """WITH h AS (SELECT c_custkey, list_reduce(list_concat([2166136261::BIGINT], list_transform(range(0, strlen(c_name)), lambda i: ('0x' || substr(hex(encode(c_name)), (2 * i + 1)::INT, 2))::INT::BIGINT)), lambda h, b: (xor(h, b) * 16777619) & 4294967295) AS hash FROM customer)
        SELECT c_custkey, hash, (hash % 4)::INTEGER AS worker FROM h""",
    "coerce_ids": cte("requests") + r"""SELECT no, CASE WHEN kind = 'number' AND try_cast(txt AS DOUBLE) = floor(try_cast(txt AS DOUBLE)) THEN 'long' WHEN kind = 'number' THEN 'double' WHEN regexp_matches(trim(txt), '(?i)^(ObjectId\([''"][0-9a-f]{24}[''"]\)|[0-9a-f]{24})$') THEN 'objectid'
        WHEN regexp_matches(trim(txt), '(?i)^(UUID\([''"])?[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}([''"]\))?$') THEN 'uuid' ELSE 'string' END AS type,
        CASE WHEN kind = 'number' AND try_cast(txt AS DOUBLE) = floor(try_cast(txt AS DOUBLE)) THEN (try_cast(txt AS DOUBLE))::BIGINT::VARCHAR WHEN kind = 'number' THEN (try_cast(txt AS DOUBLE))::VARCHAR WHEN regexp_matches(trim(txt), '(?i)^(ObjectId\([''"][0-9a-f]{24}[''"]\)|[0-9a-f]{24})$') THEN lower(regexp_extract(txt, '([0-9a-fA-F]{24})', 1))
        WHEN regexp_matches(trim(txt), '(?i)^(UUID\([''"])?[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}([''"]\))?$') THEN lower(regexp_extract(txt, '([0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12})', 1)) ELSE txt END AS value FROM requests""",
    "parse_shard_key": cte("rules") + """, p AS (SELECT rule_no, unnest(string_split(shard_key, ',')) AS part, unnest(range(0, len(string_split(shard_key, ',')))) AS place FROM rules)
        SELECT rule_no, place::INTEGER AS place, trim(split_part(part, ':', 1)) AS field, CASE WHEN lower(trim(split_part(part, ':', 2))) IN ('hashed', '-1') THEN lower(trim(split_part(part, ':', 2))) ELSE '1' END AS direction FROM p""",
    "classify_errors": cte("errors") + f"""SELECT no, CASE WHEN {_any("lower(message)", FATAL)} THEN 'fatal' WHEN contains(message, 'E11000') THEN 'duplicate' WHEN {_any("message", UNRECOVERABLE)} THEN 'unrecoverable' WHEN {_any("lower(message)", RETRYABLE)} THEN 'retryable' ELSE 'other' END AS class FROM errors""",
    "human_bytes": """WITH n AS (SELECT doc_id, (n_chars * n_chars * 7)::BIGINT AS n FROM documents) SELECT doc_id, CASE WHEN n >= 1073741824 THEN printf('%.1f GB', n / 1073741824.0) WHEN n >= 1048576 THEN printf('%.1f MB', n / 1048576.0) WHEN n >= 1024 THEN printf('%.0f KB', n / 1024.0) ELSE printf('%d B', n) END AS size FROM n""",
    "nested_lookup": "SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, json_extract(props, '$.k') IS NOT NULL AS found, json_extract(props, '$.k.deep') IS NOT NULL AS found_deep FROM events",
    "write_filter": "WITH " + CHANGES + " SELECT event_id, coalesce(CASE WHEN op IN ('insert', 'replace') THEN floor(value)::BIGINT END, doc_id % 4) AS shard_value, doc_id FROM changes",
}
_COERCED = SQL["coerce_ids"].removeprefix(cte("requests"))
SQL["request_filters"] = cte("requests", "request_keys") + f""", c AS ({_COERCED}) SELECT req, place, string_agg(part, ' and ' ORDER BY part) AS filter
        FROM (SELECT req, place, field || '=' || type || ':' || value AS part FROM request_keys JOIN c USING (no)) GROUP BY req, place"""

"""Secret scans with an incremental ledger of blobs.

Every version of a document is content-addressed: its blob is the SHA-256 of its text. The ledger holds the pairs of blob and
rule version that were scanned, with their findings. A scan passes over all rows of a blob but one and over the blobs that the ledger has
under this rule version, scans the other texts, adds them to the ledger, and joins the findings back to every row
that holds the blob, so copies and unchanged versions are never scanned twice. Texts move once, to meet the rows to pass over.

Cases: null text is empty; an empty text has no findings; repeated rows each get their findings; a null id is an id like any
other; empty tables give empty results; extra columns are ignored by :func:`scan` and carried by :func:`redact`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tidemark.shared import hot_keys, salted_join, written

#: Goes up whenever a rule changes; findings of other versions are not used.
RULE_VERSION = 1
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # runs are maximal: the same as [0-9a-f]+ without those under 32
WORDS = ("passw", "secret", "token", "apikey", "api_key")
SPAN = "array<struct<kind:string,start:int,end:int>>"
LEDGER = f"blob binary, rule_version int, spans {SPAN}"


def find_secrets(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points, end exclusive."""
    low = text.lower()
    found = []
    # lower() may change the length of a text, but never hides a word of ASCII letters
    if any(w in low for w in WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(KINDS[k], start, end) for start, k, end in sorted(found)]


def _scan_blobs(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in parts:
        yield pd.DataFrame({"blob": pdf["blob"], "rule_version": RULE_VERSION, "spans": [[{"kind": k, "start": a, "end": b} for k, a, b in find_secrets(t)] for t in pdf["text"]]})


def _read_ledger(spark, path: str | None) -> DataFrame | None:
    if path is None:
        return None
    try:
        # with its schema given, a folder without files (a first job was lost) is an empty ledger
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ledger: str | None = None) -> DataFrame:
    """For each row of ``docs``: its id, blob and spans (array of kind, start, end).

    ``ledger`` is a folder of Parquet files (blob, rule_version, spans) that this call reads and adds to; without one, the
    scan starts with an empty ledger. A job that is run again after a loss adds no blob that it already has.
    """
    spark = docs.sparkSession
    keyed = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("blob", F.unhex(F.sha2("text", 256)))
    paths = written(keyed.select("_id", "blob").withColumn("rid", F.monotonically_increasing_id()), "secret-paths")
    blobs = paths.groupBy("blob").agg(F.min("_id").alias("_rep"), F.count(F.lit(1)).alias("n"))
    hot = hot_keys(blobs, "blob", paths.count())
    copies = salted_join(paths, blobs.where("n > 1").select("blob", "_rep"), "blob", hot, "rid", "inner")
    passed = copies.where(~F.col("_id").eqNullSafe(F.col("_rep"))).select("_id", "blob")
    seen = _read_ledger(spark, ledger)
    if seen is not None:
        known = seen.where(F.col("rule_version") == RULE_VERSION).select("blob").distinct()
        passed = passed.union(salted_join(paths, known, "blob", hot, "rid", "inner").select("_id", "blob"))
    passed = written(passed.distinct().select(F.col("_id").alias("_at"), F.col("blob").alias("_blob")), "secret-passed")
    # as copies grow with the input, they are merged with the texts at every size
    texts = keyed.join(passed.hint("merge"), (F.col("blob") == F.col("_blob")) & F.col("_id").eqNullSafe(F.col("_at")), "left_anti")
    # rows that are repeated whole bring their blob twice; their findings are told apart here, as texts are too large to move again
    fresh = texts.select("blob", "text").mapInPandas(_scan_blobs, LEDGER).dropDuplicates(["blob", "rule_version"])
    if ledger is None:
        held = written(fresh, "secret-ledger")
    else:
        fresh.write.mode("append").parquet(ledger)
        held = spark.read.schema(LEDGER).parquet(ledger)
    # repeated rows and repeated runs may have put a blob into the ledger twice, with the same findings
    held = held.where((F.col("rule_version") == RULE_VERSION) & (F.size("spans") > 0)).groupBy("blob").agg(F.max("spans").alias("spans"))
    out = salted_join(paths, held, "blob", hot, "rid", "left")
    return out.select(F.col("_id").alias(id_col), "blob", F.coalesce("spans", F.array().cast(SPAN)).alias("spans"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every secret span replaced by ``mark``; rows without secrets stay as they are. Overlapping spans become
    one mark. All rows and columns are kept."""
    texts = docs.withColumn("__td_blob", F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)))
    found = scan(docs, id_col, text_col).where(F.size("spans") > 0)
    found = found.select(F.col(id_col).alias("__td_found_id"), F.col("blob").alias("__td_found_blob"), "spans").dropDuplicates(["__td_found_id", "__td_found_blob"])
    both = texts.join(found.withColumnRenamed("spans", "__td_spans").hint("merge"), F.col(id_col).eqNullSafe(F.col("__td_found_id")) & (F.col("__td_blob") == F.col("__td_found_blob")), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = F.col(text_col)
    step = lambda acc, s: F.when(s["start"] < acc["at"], F.struct(acc["out"].alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))).otherwise(
        F.struct(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"), s["end"].alias("at"))
    )
    clean = F.aggregate("__td_spans", start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    return both.withColumn(text_col, F.when(F.col("__td_spans").isNull(), text).otherwise(clean)).select(*docs.columns)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The digest of :func:`scan`'s rows: counts by kind, the hash of the base spans and all spans as text."""
    joined = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return found.select(id_col, *(count(k).alias(f"n_{k}") for k in KINDS), F.sha2(joined, 256).alias("base_sha256"), joined.alias("spans"))

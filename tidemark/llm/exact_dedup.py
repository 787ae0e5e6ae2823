"""Exact duplicates by counting quotient filters.

Each partition puts the 64-bit fingerprints of its normalised texts into counting quotient filters (one for each block of
the fingerprint space). Filters of one block merge losslessly: their remainders are sorted within quotients, so a merge is a
merge of sorted runs that adds counts. Only fingerprints with a count above one go on to byte verification, where rows are
grouped by the normalised text itself; all other rows are proven unique by the filter.

Cases: null text counts as empty, and all empty texts form one group; repeated rows (same id, same text) are one group of
which exactly one row stays; a null id loses ties against any other id; empty tables give empty results; extra columns are
ignored by :func:`exact_duplicates` and carried by :func:`drop_exact_duplicates`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rows import keep_marked
from tidemark.shared import discard, hot_keys, release, salted_join, written

#: Bits of the quotient within a block; the rest of the 64 bits below the block's is the remainder.
QUOTIENT_BITS = 10
#: Fingerprints that one block should hold, about.
BLOCK_ROWS = 1 << 18
#: Fingerprints that a task gathers before it writes filters.
FLUSH_ROWS = 1 << 20


def normalised(text: Column) -> Column:
    """The text without the six white-space characters of ASCII; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]", "")


def pack_filter(low: np.ndarray, counts: np.ndarray, bits: int) -> bytes:
    """A counting quotient filter of sorted distinct values below ``2 ** bits``: the bits of the occupied quotients, the bits
    that end a run, the remainders in 8, 6 or 4 bytes, and the counts (one byte each; 255 refers to the overflow list)."""
    remainder_bits = np.uint64(bits - QUOTIENT_BITS)
    quotient = (low >> remainder_bits).astype(np.int64)
    occupied = np.zeros(1 << QUOTIENT_BITS, bool)
    occupied[quotient] = True
    ends = np.append(quotient[1:] != quotient[:-1], True) if len(low) else np.zeros(0, bool)
    width = 8 if bits - QUOTIENT_BITS > 48 else 6 if bits - QUOTIENT_BITS > 32 else 4
    remainder = (low & ((np.uint64(1) << remainder_bits) - np.uint64(1))).astype("<u8")
    slots = remainder.view(np.uint8).reshape(-1, 8)[:, :width]
    over = counts[counts >= 255].astype("<i8")
    head = np.array([len(low), len(over)], "<i8")
    small = np.minimum(counts, 255).astype(np.uint8)
    return b"".join(x.tobytes() for x in (head, np.packbits(occupied), np.packbits(ends), slots, small, over))


def unpack_filter(data: bytes, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted values and the counts of a filter."""
    n, n_over = (int(x) for x in np.frombuffer(data, "<i8", 2))
    at = 16
    occupied = np.unpackbits(np.frombuffer(data, np.uint8, (1 << QUOTIENT_BITS) // 8, at)).astype(bool)
    at += (1 << QUOTIENT_BITS) // 8
    ends = np.unpackbits(np.frombuffer(data, np.uint8, -(-n // 8), at))[:n].astype(bool)
    at += -(-n // 8)
    width = 8 if bits - QUOTIENT_BITS > 48 else 6 if bits - QUOTIENT_BITS > 32 else 4
    slots = np.zeros((n, 8), np.uint8)
    slots[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", n_over, at + n)
    run = np.concatenate([[0], np.cumsum(ends)[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
    quotient = np.flatnonzero(occupied)[run].astype(np.uint64)
    return (quotient << np.uint64(bits - QUOTIENT_BITS)) | slots.view("<u8")[:, 0], counts


def merge_filters(parts: list[bytes], bits: int) -> bytes:
    """One filter with the sums of the counts; loses nothing, as every bit of the fingerprints is kept."""
    pairs = [unpack_filter(x, bits) for x in parts]
    values, where = np.unique(np.concatenate([v for v, _ in pairs]), return_inverse=True)
    counts = np.zeros(len(values), np.int64)
    np.add.at(counts, where, np.concatenate([c for _, c in pairs]))
    return pack_filter(values, counts, bits)


def fingerprint_filters(fingerprints: DataFrame, block_bits: int) -> DataFrame:
    """From one column of 64-bit fingerprints: (block, filter), one merged counting quotient filter for each block."""
    bits = 64 - block_bits
    names = pa.schema([("block", pa.int32()), ("filter", pa.binary())])

    def emit(values: np.ndarray) -> pa.RecordBatch:
        values, counts = np.unique(values, return_counts=True)
        block = (values >> np.uint64(bits)).astype(np.int64) if block_bits else np.zeros(len(values), np.int64)
        starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        low = values & np.uint64((1 << bits) - 1)
        made = [pack_filter(a, c, bits) for a, c in zip(np.split(low, starts[1:]), np.split(counts, starts[1:]), strict=True)]
        return pa.record_batch([pa.array(block[starts], pa.int32()), pa.array(made, pa.binary())], schema=names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for b in batches:
            held.append(b.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
            if sum(map(len, held)) >= FLUSH_ROWS:
                yield emit(np.concatenate(held))
                held = []
        if sum(map(len, held)):
            yield emit(np.concatenate(held))

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "filter": [merge_filters(list(pdf["filter"]), bits)]})

    return fingerprints.mapInArrow(build, "block int, filter binary").groupBy("block").applyInPandas(merge, "block int, filter binary")


def repeated_fingerprints(filters: DataFrame, block_bits: int) -> DataFrame:
    """(fp, n): the fingerprints whose count in the merged filters is above one."""
    bits = 64 - block_bits

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for block, data in zip(pdf["block"], pdf["filter"], strict=True):
                low, counts = unpack_filter(data, bits)
                fp = (low | np.uint64(block << bits if block_bits else 0)).view(np.int64)
                yield pd.DataFrame({"fp": fp[counts > 1], "n": counts[counts > 1]})

    return filters.mapInPandas(read, "fp long, n long")


def _verdicts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row for each row of ``docs``: _id, raw (hash of the text as it is), keep_id, group_size, kept, sha."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    norm = normalised(F.col(text_col))
    # The number of a row holds only within this table, which is written once and then only read.
    slim = docs.select(F.col(id_col).alias("_id"), F.length(text).alias("chars"), F.xxhash64(text).alias("raw"), norm.alias("norm"))
    slim = slim.select("_id", "chars", "raw", F.xxhash64("norm").alias("fp"), F.unhex(F.sha2("norm", 256)).alias("sha"))
    slim = written(slim.withColumn("rid", F.monotonically_increasing_id()), "exact-rows")
    total = slim.count()
    block_bits = max(0, min(20, (total // BLOCK_ROWS).bit_length()))
    repeated = written(repeated_fingerprints(fingerprint_filters(slim.select("fp"), block_bits), block_bits), "exact-fingerprints")

    # Byte verification: only rows with such a fingerprint move, and equal bytes meet by grouping on the bytes themselves.
    rows = docs.select(F.col(id_col).alias("_id"), norm.alias("norm")).withColumn("fp", F.xxhash64("norm"))
    met = salted_join(rows, repeated.select("fp"), "fp", hot_keys(repeated, "fp", total), "_id", "inner")
    texts = met.groupBy("fp", "norm").agg(F.count(F.lit(1)).alias("n")).withColumn("sha", F.unhex(F.sha2("norm", 256)))
    proven = texts.groupBy("sha").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n"))
    proven = proven.select("sha", "n", F.when(F.col("n_texts") > 1, F.raise_error(F.lit("two different texts share a SHA-256"))).cast("int").alias("clash"))

    best = F.min(F.struct(-F.col("chars"), F.col("_id").isNull().alias("no_id"), "_id", "rid")).alias("best")
    groups = slim.join(repeated.select("fp"), "fp", "left_semi").groupBy("sha").agg(best)
    groups = groups.join(proven.where((F.col("n") > 1) & F.col("clash").isNull()), "sha").select("sha", F.col("n").alias("group_size"), F.col("best._id").alias("keep_id"), F.col("best.rid").alias("keep_rid"))
    groups = written(groups, "exact-groups")
    discard(repeated)
    release(docs.sparkSession)
    hot = hot_keys(groups.select("sha", F.col("group_size").alias("n")), "sha", total)
    out = salted_join(slim, groups, "sha", hot, "rid", "left")
    single = F.col("group_size").isNull()
    return out.select(
        "_id", "raw", F.when(single, F.col("_id")).otherwise(F.col("keep_id")).alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (single | (F.col("rid") == F.col("keep_rid"))).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each row: its id, keep_id (the longest original text of its group, then the smallest id), group_size, kept, text_sha256."""
    out = _verdicts(docs, id_col, text_col)
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", "kept", "text_sha256")


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    rows = _verdicts(docs, id_col, text_col).where("group_size > 1")
    marks = rows.groupBy("_id", "raw").agg(F.sum(F.col("kept").cast("int")).alias("stay"), F.count(F.lit(1)).alias("n")).where("stay < n")
    return keep_marked(docs, marks, id_col, text_col)


ORACLE = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
w AS (SELECT doc_id, t, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS keep_id,
  count(*) OVER (PARTITION BY t) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM w
"""

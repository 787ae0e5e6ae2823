"""Importance resampling towards a target distribution over hashed word n-grams.

A feature is a run of consecutive words joined by one space; its bucket is the CRC-32 of its UTF-8 bytes modulo the number of buckets. The
strings of runs are never made: a CRC is linear over GF(2), so that the CRC of two strings in a row is the first one's, moved past the second's length
by a matrix, plus the second's. The matrices for 1, 2, 4, ... bytes are kept as four tables of 256 values each; a length is moved past by those of its
binary digits. Each distinct word's CRC is computed once in a batch.

Texts are read once: what a document keeps is its buckets, as a written table; counts, gains and weights come from that. The driver gathers one
count for each bucket of the corpus and of the target. Drawn rows are numbered by range parts, so no task holds all of them.

Cases: a null text has no words and no features; an empty table gives an empty result; an empty target or corpus counts zero everywhere; a
null id counts as an empty text in the draw and comes first among ties; repeated rows take part each (ties with equal ids go by the number of
features and the weight); words of any length count whole; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.shared import discard, numbered, written

BUCKETS, LEAST_WORDS, PERCENT, SEED = 10_000, 20, 10, 2024
#: ASCII letters in lower case, digits, and all beyond ASCII.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: The reversed polynomial of CRC-32: a fixed value.
POLYNOMIAL = 0xEDB88320


def _times(columns: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """The product over GF(2) of a matrix (32 columns) with vectors, all as 32-bit integers."""
    out = np.zeros(len(vectors), np.uint32)
    for bit in range(32):
        out ^= np.where((vectors >> np.uint32(bit)) & np.uint32(1), columns[bit], np.uint32(0))
    return out


def _tables(powers: int) -> np.ndarray:
    """(powers, 4, 256): what moving past 2^k zero bytes makes of each value of each byte of a CRC."""
    columns = np.array([POLYNOMIAL, *(1 << i for i in range(31))], np.uint32)  # past one bit
    for _ in range(3):
        columns = _times(columns, columns)
    out = np.zeros((powers, 4, 256), np.uint32)
    for k in range(powers):
        for byte in range(4):
            out[k, byte] = _times(columns, np.arange(256, dtype=np.uint32) << np.uint32(8 * byte))
        columns = _times(columns, columns)
    return out


#: Moves past up to 2^32 - 1 bytes.
TABLES = _tables(32)
SPACE = np.uint32(zlib.crc32(b" "))


def shifted(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The part of ``crc`` in the CRC of a string that has ``length`` more bytes."""
    out = crc.copy()
    for k in range(int(length.max(initial=0)).bit_length()):
        past = np.flatnonzero((length >> k) & 1)
        c, table = out[past], TABLES[k]
        out[past] = table[0][c & np.uint32(255)] ^ table[1][(c >> np.uint32(8)) & np.uint32(255)] ^ table[2][(c >> np.uint32(16)) & np.uint32(255)] ^ table[3][c >> np.uint32(24)]
    return out


def combined(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The CRC of strings in a row, from both CRCs and the second's length in bytes."""
    return shifted(first, length) ^ second


class _Crcs(dict):
    """The CRC of words, each computed when it is met first."""

    def __missing__(self, word: bytes) -> int:
        self[word] = crc = zlib.crc32(word)
        return crc


def features(texts: list[bytes], longest: int = 1, buckets: int = BUCKETS, crcs: dict | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The number of words of each text, the offsets of its features, and the buckets of all features: for each text its runs of one word, then
    of two, and so on."""
    rows = [WORD.findall(t.lower()) for t in texts]
    words = [w for r in rows for w in r]
    size = np.fromiter(map(len, rows), np.int64, len(rows))
    one = np.fromiter(map((_Crcs() if crcs is None else crcs).__getitem__, words), np.uint32, len(words))
    owner = np.repeat(np.arange(len(rows)), size)
    owners, found = [owner], [one]
    if longest > 1:
        length = np.fromiter(map(len, words), np.int64, len(words))
        spaced = combined(np.full(len(words), SPACE), one, length)  # " word"
    run = one
    for n in range(2, longest + 1):
        run = combined(run[:-1], spaced[n - 1 :], length[n - 1 :] + 1)
        inside = owner[: len(run)] == owner[n - 1 :]
        owners.append(owner[: len(run)][inside])
        found.append(run[inside])
    owner, bucket = np.concatenate(owners), (np.concatenate(found) % np.uint32(buckets)).astype(np.int32)
    if longest > 1:
        bucket = bucket[np.argsort(owner, kind="stable")]
    return size, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(rows)))]).astype(np.int64), bucket


def hashed(docs: DataFrame, id_col: str | None = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(doc_id, n_words, n_features, buckets): ``buckets`` are little-endian 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crcs = _Crcs()
        for b in batches:
            for part in slices(b, "text"):
                if len(crcs) > 300_000:
                    crcs.clear()
                size, at, bucket = features([t or b"" for t in part.column("text").to_pylist()], longest, buckets, crcs)
                lists = [bucket[i:j].astype("<i4").tobytes() for i, j in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(size), pa.array(np.diff(at)), pa.array(lists, pa.binary())], names=["doc_id", "n_words", "n_features", "buckets"])

    rows = docs.select((F.col(id_col) if id_col else F.lit(None).cast("long")).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, buckets binary")


def totals(rows: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """How many features each bucket has, counted within tasks first; the driver gathers ``buckets`` numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), "<i4"), minlength=buckets)
        there = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(n[there])], names=["bucket", "n"])

    out = [0] * buckets
    for r in rows.select("buckets").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: list[int], target: list[int]) -> np.ndarray:
    """floor(1000 ln of the ratio of both smoothed shares) of each bucket."""
    k = len(corpus)
    whole, wanted = float(sum(corpus) + k), float(sum(target) + k)
    return np.array([math.floor(1000 * math.log((t + 1.0) * whole / ((s + 1.0) * wanted))) for s, t in zip(corpus, target, strict=True)], np.int64)


def weighed(rows: DataFrame, gain: np.ndarray) -> DataFrame:
    """``rows`` of :func:`hashed` with ``weight``, the sum of their features' gains, in place of the buckets."""
    held = rows.sparkSession.sparkContext.broadcast(gain)  # one number for each bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column("n_features").to_numpy(zero_copy_only=False)
            running = np.concatenate([[0], np.cumsum(held.value[np.frombuffer(b"".join(b.column("buckets").to_pylist()), "<i4")])])
            end = np.cumsum(n)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(running[end] - running[end - n])], names=["doc_id", "n_words", "n_features", "weight"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, n_features long, weight long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", longest: int = 1, buckets: int = BUCKETS, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """For each row of ``docs``: doc_id, n_features, weight, score (weight with Gumbel noise that the id gives) and rank, which counts the drawn
    rows: of those with ``least_words`` words the ``percent`` of a hundred with the highest scores, ties to smaller ids."""
    spark = docs.sparkSession
    wanted = written(hashed(target, None, text_col, longest, buckets), "resample-target")
    rows = written(hashed(docs, id_col, text_col, longest, buckets), "resample-features")
    gain = gains(totals(rows, buckets), totals(wanted, buckets))
    discard(wanted)
    uniform = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((uniform + 0.5) / F.lit(4294967296.0)))).cast("long")
    scored = written(weighed(rows, gain).withColumn("score", F.col("weight") + noise), "resample-scores")
    discard(rows)
    able = F.col("n_words") >= least_words
    draw = scored.where(able).count() * percent // 100
    ranked = numbered(scored.where(able).withColumn("_down", -F.col("score")), "_down", "doc_id", "n_features", "weight")
    columns = ["doc_id", "n_features", "weight", "score"]
    drawn = ranked.select(*columns, F.when(F.col("rn") <= draw, F.col("rn")).alias("rank"))
    return drawn.union(scored.where(~able).select(*columns, F.lit(None).cast("long")))


#: CRC-32 of each distinct word byte by byte, from a table that follows from the polynomial; runs of one word.
ORACLE = r"""WITH tab AS (SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
    texts AS (SELECT doc_id AS id, text, true AS ours FROM documents UNION ALL SELECT item_id, text, false FROM benchmark),
    w AS (SELECT id, ours, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM texts),
    n AS (SELECT id, ours, word, count(*) AS n FROM w GROUP BY ALL), d AS (SELECT DISTINCT word FROM n),
    b AS (SELECT word, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, strlen(word)), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::INT::BIGINT)), lambda c, x: xor(c // 256, t[(xor(c % 256, x) + 1)::INT])), 4294967295) % 10000 AS bucket FROM d, tab),
    f AS (SELECT id, ours, bucket, sum(n) AS n FROM n JOIN b USING (word) GROUP BY ALL), s AS (SELECT bucket, sum(n) FILTER (ours) AS s, sum(n) FILTER (NOT ours) AS t FROM f GROUP BY bucket),
    tot AS (SELECT coalesce(sum(s), 0) AS s, coalesce(sum(t), 0) AS t FROM s), g AS (SELECT bucket, floor(1000 * ln((coalesce(s.t, 0) + 1)::DOUBLE * (tot.s + 10000)::DOUBLE / ((coalesce(s.s, 0) + 1)::DOUBLE * (tot.t + 10000)::DOUBLE)))::BIGINT AS gain FROM s, tot),
    x AS (SELECT id, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM f JOIN g USING (bucket) WHERE ours GROUP BY id),
    r AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score FROM documents LEFT JOIN x ON doc_id = id),
    k AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rn, count(*) OVER () AS n FROM r WHERE n_features >= 20)
    SELECT r.doc_id, n_features, weight, score, CASE WHEN rn <= 10 * n // 100 THEN rn END AS rank FROM r LEFT JOIN k ON r.doc_id = k.doc_id"""

"""Repeated byte strings by suffix order and longest-previous-factor arrays.

A string of ``length`` bytes that starts at two places is a repeat. Places that may repeat are brought together first: of all the
``GRAM``-byte strings in a window of ``length`` bytes the one with the least hash is the window's anchor, so equal windows have equal
anchors at the same distance. Windows that follow each other mostly share their anchor; such a run, with the bytes it covers, is a
context. Contexts whose anchor occurs once cannot repeat. Of the others, equal contexts become one with a count, and those left meet
by anchor: their suffixes are sorted (prefix doubling), the previous and next smaller text positions in suffix order give each
suffix its earlier match, and the longest-previous-factor array says where a window has occurred before.

An anchor with more than ``BUCKET`` different contexts is split: its windows are dealt to blocks by their distance from the anchor, and
contexts meet only if they agree in all bytes that every window of the block holds. Blocks get smaller until a block is one window, so
no bucket is unbounded and no repeat is lost.

The same over words: with ``unit="words"`` a text is the sequence of its words' hashes (32 bits each) and lengths count words, so passages are
found however long their words are. Runs of 50 words that agree in all hashes and differ in a word are out of reach.

With ``keep="first"`` the first place (by id, then position) stays and later ones are repeats; with ``keep="none"`` both are.

Cases: null text is empty; texts shorter than ``length`` have no repeats; repeated rows are copies of each other, ordered as one place
under ``keep="first"``; ids may be of any type that can be ordered, a null id comes last; empty tables give empty results; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.ngram_join import _BYTE_EXACT, _mix, _power, _runs as _batches, word_hashes
from tidemark.shared import discard, hot_keys, numbered, release, salted_join, written

#: Symbols of the strings whose least hash anchors a window, and what a symbol is, by unit.
GRAM = {"bytes": 128, "words": 16}
SYMBOL = {"bytes": np.dtype(np.uint8), "words": np.dtype(np.uint32)}
#: A passage: so many words that occur elsewhere too.
PASSAGE = 50
#: Contexts that a task sorts together at most, and the sizes of the blocks that larger buckets are split into.
BUCKET, BLOCKS = 1024, (32, 4, 1)
#: Bytes that a task sorts at a time: so many that keys and ranks stay in the processor's cache.
BATCH = 1 << 17
#: Texts over this size are read in slices.
SLICE = 1 << 22


def symbols(texts: list[bytes], unit: str) -> list[np.ndarray]:
    """Each text as an array of symbols: its bytes, or the hashes of its words."""
    if unit == "bytes":
        return [np.frombuffer(t, np.uint8) for t in texts]
    out: list[np.ndarray] = []
    for i, j in _batches(texts):
        word, first = word_hashes(texts[i:j], exact=True)
        out += np.split(word.astype(np.uint32), first[1:-1])
    return out


def _coded(raw: np.ndarray) -> np.ndarray:
    return _BYTE_EXACT[raw] if raw.dtype == np.uint8 else _mix(raw.astype(np.uint64))


def _window_anchors(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor, hash) of every run of windows with one anchor; ``ends``: where texts end."""
    none = np.zeros(0, np.int64)
    n = len(raw) - gram + 1
    width = length - gram + 1
    if len(raw) < length:
        return none, none, none, none.view(np.uint64)
    up, down = _power(len(raw))
    total = np.concatenate([[np.uint64(0)], np.cumsum(_coded(raw) * up)])
    code = _mix((total[gram:] - total[:n]) * down[:n])
    key = (code & ~np.uint64(0xFFFFFF)) | np.arange(n, dtype=np.uint64)  # the leftmost of equals
    padded = np.full(-(-n // width) * width, ~np.uint64(0), np.uint64)
    padded[:n] = key
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    m = n - width + 1
    anchor = (np.minimum(behind[:m], ahead[width - 1 : width - 1 + m]) & np.uint64(0xFFFFFF)).astype(np.int64)
    # windows lie within one text
    text_end = ends[np.searchsorted(ends, np.arange(m), side="right")]
    inside = np.arange(m) + length <= text_end
    at = np.flatnonzero(inside)
    if not len(at):
        return none, none, none, none.view(np.uint64)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (np.diff(anchor[at]) != 0)]))
    counts = np.diff(np.append(new, len(at)))
    return at[new], counts, anchor[at[new]], code[anchor[at[new]]]


def text_anchors(texts: list[np.ndarray], length: int, gram: int) -> list[tuple[np.ndarray, ...]]:
    """For each text, as symbols: (first window, number of windows, lead from the first window to the anchor, hash)."""
    out: list = [None] * len(texts)

    def one_by_one(which: list[int]) -> None:
        raw = np.concatenate([texts[i] for i in which])
        ends = np.cumsum([len(texts[i]) for i in which])
        found = _window_anchors(raw, ends, length, gram)
        cut = np.searchsorted(found[0], np.concatenate([[0], ends]))
        for k, i in enumerate(which):
            a, b = cut[k], cut[k + 1]
            start = found[0][a:b]
            out[i] = (start - (ends[k] - len(texts[i])), found[1][a:b], found[2][a:b] - start, found[3][a:b])

    held: list[int] = []
    size = 0
    for i, t in enumerate(texts):
        if len(t) > SLICE:
            parts = []
            for at in range(0, len(t) - length + 1, SLICE):
                piece = t[at : at + SLICE + length - 1]
                start, n, anchor, code = _window_anchors(piece, np.array([len(piece)]), length, gram)
                parts.append((start + at, n, anchor - start, code))
            out[i] = tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            continue
        held.append(i)
        size += len(t)
        if size >= 1 << 19:
            one_by_one(held)
            held, size = [], 0
    if held:
        one_by_one(held)
    return out


def suffix_ranks(raw: np.ndarray, length: int) -> list[tuple[int, np.ndarray]]:
    """(size, ranks) for sizes 8, 24, 72, ... (of words: 2, 6, 18, ...) up to ``length``: equal ranks for equal strings, in their order, of every place.
    Three ranks of 21 bits make the key of the next size, so there are at most 2 ** 21 places."""
    n = len(raw)
    size = 8 // raw.itemsize
    padded = np.concatenate([raw, np.zeros(size, raw.dtype)])
    key = np.zeros(n, np.uint64)
    for i in range(size):
        key = (key << np.uint64(8 * raw.itemsize)) | padded[i : i + n].astype(np.uint64)
    levels = []
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        levels.append((size, rank))
        if size * 3 > length:
            return levels
        ahead = [np.concatenate([rank[i * size :], np.zeros(min(i * size, n), np.int64)])[:n] for i in (1, 2)]
        key = (rank << 42) | (ahead[0] << 21) | ahead[1]
        size *= 3


def longest_previous(raw: np.ndarray, places: np.ndarray, bucket: np.ndarray, length: int, whole: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """For the suffixes at ``places`` (ascending, each with ``length`` bytes ahead): the longest match, up to ``length``, with an
    earlier suffix of the same bucket; and whether a later suffix matches in ``length`` bytes. With ``whole``, matches of less than ``length``
    count as 0: those of ``length`` are neighbours in suffix order, so that nothing is compared byte by byte."""
    m = len(places)
    # three ranks make a key, so whole matches need no strings of more than a ninth of ``length``
    levels = suffix_ranks(raw, length // 3 if whole else length)
    size, top = levels[-1]
    # the suffix array: strings of ``length`` bytes by ranks that cover them, in text order where they are equal
    cover = [*range(0, length - size + 1, size), length - size]
    if whole:
        keys = [bucket]
        for i in range(0, len(cover), 3):
            keys.append(np.zeros(m, np.int64))
            for c in cover[i : i + 3]:
                keys[-1] = (keys[-1] << 21) | top[places + c]
        order = np.lexsort((*reversed(keys[1:]), bucket))
        previous, source = np.zeros(m, np.int64), np.zeros(m, bool)
        same = np.ones(max(0, m - 1), bool)
        for key in keys:
            ordered = key[order]
            same &= ordered[1:] == ordered[:-1]
        previous[order[1:][same]] = length
        source[order[:-1][same]] = True
        return previous, source
    order = np.lexsort((*(top[places + c] for c in reversed(cover)), bucket))
    # previous and next smaller place in suffix order, by jumping from candidate to candidate
    smaller = []
    for way in (-1, 1):
        to = np.arange(m) + way
        while True:
            bad = np.flatnonzero((to >= 0) & (to < m))
            bad = bad[order[to[bad]] > order[bad]]
            if not len(bad):
                break
            to[bad] = to[to[bad]]
        smaller.append(to)
    previous, source = np.zeros(m, np.int64), np.zeros(m, bool)
    for to in smaller:
        at = np.flatnonzero((to >= 0) & (to < m))
        at = at[bucket[order[at]] == bucket[order[to[at]]]]
        a, b = order[at], order[to[at]]
        i, j, same = places[a].copy(), places[b].copy(), np.zeros(len(a), np.int64)
        for step, rank in [x for x in reversed(levels) for _ in range(2 + (x is levels[-1]))]:
            fits = (same + step <= length) & (rank[np.minimum(i, len(raw) - 1)] == rank[np.minimum(j, len(raw) - 1)])
            i, j, same = i + fits * step, j + fits * step, same + fits * step
        for _ in range(8):
            fits = (same < length) & (raw[np.minimum(i, len(raw) - 1)] == raw[np.minimum(j, len(raw) - 1)])
            stopped = ~fits
            i, j, same = i + ~stopped, j + ~stopped, same + ~stopped
        previous[a] = np.maximum(previous[a], same)
        source[b[same >= length]] = True
    return previous, source


def _runs(flags: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, first, end) of the runs of set flags, counted within parts of ``sizes``; none goes over a part's end."""
    first = np.cumsum(sizes) - sizes
    opens, closes = np.zeros(len(flags) + 1, bool), np.zeros(len(flags) + 1, bool)
    opens[first], closes[first + sizes] = True, True
    before, after = np.concatenate([[False], flags]), np.concatenate([flags, [False]])
    start, end = np.flatnonzero(after & (~before | opens)), np.flatnonzero(before & (~after | closes))
    part = np.searchsorted(first, start, side="right") - 1
    return part, start - first[part], end - first[part]


def _sorted_contexts(rows: list[tuple[int, int, int, bytes]], length: int, keep: str, symbol: np.dtype = SYMBOL["bytes"]) -> list[tuple[int, int, int]]:
    """From (bucket, ck, windows, context) with buckets together and in text order: (ck, first, end) of repeated windows."""
    raw = np.frombuffer(b"".join(r[3] for r in rows), symbol)
    at = np.cumsum([0, *(len(r[3]) // symbol.itemsize for r in rows)])
    places = np.concatenate([np.arange(a, a + r[2]) for a, r in zip(at, rows, strict=False)])
    bucket = np.repeat(np.unique([r[0] for r in rows], return_inverse=True)[1], [r[2] for r in rows])
    previous, source = longest_previous(raw, places, bucket, length, whole=True)
    flags = previous >= length if keep == "first" else (previous >= length) | source
    part, first, end = _runs(flags, np.array([r[2] for r in rows], np.int64))
    return [(rows[i][1], a, b) for i, a, b in zip(part.tolist(), first.tolist(), end.tolist(), strict=True)]


RANGE = pa.schema([("ck", pa.int64()), ("a", pa.int32()), ("b", pa.int32())])


def _ranges(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(RANGE)], schema=RANGE)


def _resolve(contexts: DataFrame, length: int, keep: str, unit: str, level: int = 0) -> DataFrame:
    """From distinct contexts (grp, ck, n, lead, ctx, times, place): (ck, a, b), the repeated windows of each one's first place."""
    symbol = SYMBOL[unit]
    sizes = contexts.groupBy("grp").agg(F.count(F.lit(1)).alias("m"), F.sum("times").alias("all")).where(F.col("all") > 1)
    sized = contexts.join(sizes.select("grp", "m"), "grp")
    whole = contexts.where("times > 1").select("ck", F.lit(0).alias("a"), F.col("n").alias("b"))

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if row[0] != last and size >= BATCH:
                    yield _ranges(_sorted_contexts(held, length, keep, symbol))
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
                last = row[0]
        if held:
            yield _ranges(_sorted_contexts(held, length, keep, symbol))

    most = BUCKET if level < len(BLOCKS) else 1 << 40
    small = sized.where(F.col("m").between(2, most)).select("grp", "ck", "n", "ctx", "place").repartition("grp").sortWithinPartitions("grp", "place").drop("place")
    found = small.mapInArrow(sort, "ck long, a int, b int")
    if keep == "none":
        found = found.union(whole)
    found = written(found, "suffix-ranges")
    large = sized.where(F.col("m") > most)
    if level == len(BLOCKS) or large.isEmpty():
        return found

    block = BLOCKS[level]
    fields = pa.schema([("grp", pa.int64()), ("ck", pa.int64()), ("parent", pa.int64()), ("first", pa.int32()), ("n", pa.int32()), ("lead", pa.int32()), ("ctx", pa.binary()), ("times", pa.int64()), ("place", pa.decimal128(38, 0))])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            rows = []
            for grp, ck, n, lead, ctx, times, place in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                w = 0
                while w < n:
                    number = (lead - w) // block
                    after = min(n, lead - number * block + 1)
                    core = ctx[(lead - number * block) * symbol.itemsize : (lead - (number + 1) * block + 1 + length) * symbol.itemsize]
                    part = ctx[w * symbol.itemsize : (after - 1 + length) * symbol.itemsize]
                    new = xxhash.xxh3_64_intdigest(core, seed=(grp ^ (number * 0x9E3779B97F4A7C15)) & (2**64 - 1)) - 2**63
                    own = xxhash.xxh3_64_intdigest(part, seed=(new ^ ((after - w) << 32)) & (2**64 - 1)) - 2**63
                    rows.append((new, own, ck, w, after - w, lead - w, part, times, place + w))
                    w = after
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(fields)], schema=fields)

    # A window's block is where its distance from the anchor falls, so equal windows share block and core.
    cols = "grp long, ck long, parent long, first int, n int, lead int, ctx binary, times long, place decimal(38,0)"
    parts = written(large.select("grp", "ck", "n", "lead", "ctx", "times", "place").mapInArrow(split, cols), "suffix-blocks")
    below = written(parts.groupBy("grp", "ck", "n", "lead", "ctx").agg(F.sum("times").alias("times"), F.min("place").alias("place")), "suffix-contexts")
    deeper = _placed(_resolve(below, length, keep, unit, level + 1), below, parts.select("ck", "parent", "first", "n", "place"), keep)
    return found.union(deeper.select(F.col("parent").alias("ck"), (F.col("first") + F.col("a")).cast("int").alias("a"), (F.col("first") + F.col("b")).cast("int").alias("b")))


def _placed(ranges: DataFrame, contexts: DataFrame, places: DataFrame, keep: str) -> DataFrame:
    """``places`` of contexts with the repeated windows there (a, b): those of the context, or all where an equal one came before."""
    slim = contexts.select("ck", "times", F.col("place").alias("origin"))
    hot = hot_keys(slim.select("ck", F.col("times").alias("n")), "ck", places.count())
    lists = ranges.groupBy("ck").agg(F.collect_list(F.struct("a", "b")).alias("ranges"))
    if keep == "none":
        return salted_join(places, lists, "ck", hot, "place", "inner").select("*", F.inline("ranges"))
    lists = slim.where("times > 1").join(lists, "ck", "full").withColumn("ranges", F.coalesce("ranges", F.array().cast("array<struct<a:int,b:int>>")))
    both = salted_join(places, lists, "ck", hot, "place", "inner")
    later = F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))
    return both.withColumn("ranges", F.when(F.col("place") > F.col("origin"), later).otherwise(F.col("ranges"))).select("*", F.inline("ranges"))


def _united(hits: DataFrame, length: int) -> DataFrame:
    """From (_at, _hash, ranges): spans, the maximal runs of bytes that repeated windows (a, b) cover."""
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ranges")
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            row = np.repeat(np.arange(len(lists), dtype=np.int64), sizes) << 32
            start = row + flat.field("a").to_numpy().astype(np.int64)
            end = row + flat.field("b").to_numpy().astype(np.int64) - 1 + length
            order = np.argsort(start, kind="stable")
            start, end = start[order], np.maximum.accumulate(end[order])
            new = np.concatenate([[True], start[1:] > end[:-1]])[: len(start)]
            last = np.concatenate([np.flatnonzero(new)[1:] - 1, [len(start) - 1]])[: int(new.sum())]
            low = (1 << 32) - 1
            spans = pa.StructArray.from_arrays([pa.array((start[new] & low).astype(np.int32)), pa.array((end[last] & low).astype(np.int32))], names=["start", "end"])
            offsets = np.concatenate([[0], np.cumsum(np.bincount(start[new] >> 32, minlength=len(lists)))])
            made = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans).cast(kind)
            yield pa.RecordBatch.from_arrays([batch.column("_at"), batch.column("_hash"), made], names=["_at", "_hash", "spans"])

    return hits.mapInArrow(run, f"_at {dict(hits.dtypes)['_at']}, _hash long, spans array<struct<start:int,end:int>>")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """rows (_id, raw, text); slim: a row for each row without its text; classes: a row for each distinct text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("text")).withColumn("raw", F.xxhash64("text"))
    sizes = [F.octet_length("text").cast("long").alias("n_bytes"), F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("n_words")]
    slim = written(rows.select("_id", "raw", *sizes, F.unhex(F.sha2("text", 256)).alias("sha")), "suffix-rows")
    best = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "raw")).alias("best")
    classes = written(slim.groupBy("sha").agg(best, F.count(F.lit(1)).alias("copies")).select("sha", "copies", "best._id", "best.raw"), "suffix-classes")
    return rows, slim, classes


def repeated_spans(docs: DataFrame, length: int = 400, keep: str = "first", id_col: str = "doc_id", text_col: str = "text", unit: str = "bytes") -> DataFrame:
    """A row for each row: _id, raw (hash of the text), sha (its SHA-256), n_bytes, n_words and spans (start, end of what is repeated, in
    ``unit``)."""
    return _spans(*_texts(docs, id_col, text_col), length, keep, unit)


def _spans(rows: DataFrame, slim: DataFrame, classes: DataFrame, length: int, keep: str, unit: str) -> DataFrame:
    spark, id_type = rows.sparkSession, dict(rows.dtypes)["_id"]
    a_fields = ["start", "n", "lead", "h"]

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            found = text_anchors(symbols([t.encode() for t in b.column("text").to_pylist()], unit), length, GRAM[unit])
            take = pa.array(np.repeat(np.arange(b.num_rows), [len(f[0]) for f in found]))
            cols = [np.concatenate([f[i] for f in found]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([b.column("_id").take(take), b.column("raw").take(take), *(pa.array(c.astype(np.int32)) for c in cols[:3]), pa.array(cols[3].view(np.int64))], names=["_id", "raw", *a_fields])

    placed = written(rows.select("_id", "raw", "text").mapInArrow(anchors, f"_id {id_type}, raw long, start int, n int, lead int, h long"), "suffix-anchors")
    # copies of one text have the same raw and place, so an anchor that only they have is not shared
    spot = F.xxhash64("raw", F.col("start") + F.col("lead"))
    shared = placed.groupBy("h").agg(F.min(spot).alias("lo"), F.max(spot).alias("hi"), F.count(F.lit(1)).alias("rows")).where("lo <> hi")
    shared = written(shared.select("h", "rows"), "suffix-shared")
    first = classes.select("_id", "raw")
    mine = salted_join(placed, shared.select("h"), "h", hot_keys(shared.select("h", F.col("rows").alias("n")), "h", placed.count()), "raw", "inner")
    lists = mine.groupBy("_id", "raw").agg(F.collect_set(F.struct(*a_fields)).alias("runs"))
    lists = lists.join(first, lists["_id"].eqNullSafe(first["_id"]) & (lists["raw"] == first["raw"]), "left_semi")
    lists = written(lists.select(F.col("_id").alias("_at"), F.col("raw").alias("_hash"), "runs"), "suffix-runs")
    discard(placed)

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        names, item = ["_id", "raw", "start", "n", "lead", "grp", "ck", "ctx", "times"], SYMBOL[unit].itemsize
        for b in batches:
            lists = b.column("runs")
            flat, row = lists.flatten(), np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            start, n, lead, h = (flat.field(c).to_numpy() for c in a_fields)
            order = np.lexsort((start, row))
            row, start, n, lead, h = row[order], start[order], n[order], lead[order], h[order]
            seeds = (h ^ (n.astype(np.int64) << 40) ^ (lead.astype(np.int64) << 20)).view(np.uint64).tolist()
            from_, to = start.astype(np.int64) * item, (start.astype(np.int64) + n - 1 + length) * item
            at = np.searchsorted(row, np.arange(b.num_rows + 1)).tolist()
            cks: list[int] = []
            ctxs: list[bytes | None] = []
            times: list[int] = []
            sent = size = 0

            def flush(end: int) -> pa.RecordBatch:
                some = slice(sent, end)  # noqa: B023
                take = pa.array(row[some])  # noqa: B023
                numbers = [pa.array(c[some]) for c in (start, n, lead, h)]  # noqa: B023
                return pa.RecordBatch.from_arrays([b.column("_id").take(take), b.column("raw").take(take), *numbers, pa.array(cks, pa.int64()), pa.array(ctxs, pa.binary()), pa.array(times, pa.int64())], names=names)  # noqa: B023

            for k, text in enumerate(b.column("text")):
                data, seen = symbols([text.as_py().encode()], unit)[0].tobytes(), {}
                for seed, x, y in zip(seeds[at[k] : at[k + 1]], from_[at[k] : at[k + 1]].tolist(), to[at[k] : at[k + 1]].tolist(), strict=True):
                    ctx = data[x:y]
                    ck = xxhash.xxh3_64_intdigest(ctx, seed=seed) - 2**63
                    if ck in seen:  # the same context again in one text: its bytes are sent once
                        times[seen[ck]] += 1
                        ctx = None
                    else:
                        seen[ck] = len(times)
                        size += y - x
                    cks.append(ck)
                    ctxs.append(ctx)
                    times.append(0 if ctx is None else 1)
                if size >= 8 * BATCH or len(cks) >= 10_000:
                    yield flush(at[k + 1])
                    cks, ctxs, times, sent, size = [], [], [], at[k + 1], 0
            if cks:
                yield flush(at[-1])

    texts = rows.join(lists, rows["_id"].eqNullSafe(lists["_at"]) & (rows["raw"] == lists["_hash"])).dropDuplicates(["_id", "raw"]).select("_id", "raw", "text", "runs")
    made = met = written(texts.mapInArrow(contexts, f"_id {id_type}, raw long, start int, n int, lead int, grp long, ck long, ctx binary, times long"), "suffix-met")
    release(spark)
    if id_type in ("tinyint", "smallint", "int", "bigint"):
        number = F.coalesce(F.col("_id").cast("decimal(38,0)"), F.lit(str(2**63)).cast("decimal(38,0)"))
    else:  # ids of other kinds are numbered in their order, null last
        known = numbered(classes.select("_id", "raw", F.col("_id").isNull().alias("no_id")), "no_id", "_id", "raw", name="number")
        known = known.select(F.col("_id").alias("_at"), F.col("raw").alias("_hash"), "number")
        met = met.join(known, met["_id"].eqNullSafe(known["_at"]) & (met["raw"] == known["_hash"])).drop("_at", "_hash")
        number = F.col("number").cast("decimal(38,0)")
    place = (number * F.lit(2**32).cast("decimal(12,0)") + F.col("start")).cast("decimal(38,0)")
    met_at = met.withColumn("place", place)
    distinct = met_at.where("ctx IS NOT NULL").groupBy("grp", "ck", "n", "lead", "ctx").agg(F.sum("times").alias("times"), F.min("place").alias("place"))
    distinct = written(distinct, "suffix-contexts")
    hits = _placed(_resolve(distinct, length, keep, unit), distinct, met_at.select("ck", "_id", "raw", "start", "n", "place"), keep)
    hits = hits.groupBy("_id", "raw").agg(F.collect_list(F.struct((F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))).alias("ranges"))
    spans = written(_united(hits.select(F.col("_id").alias("_at"), F.col("raw").alias("_hash"), "ranges"), length), "suffix-spans")
    for table in (lists, shared, made, distinct):
        discard(table)

    counted = classes.where("copies > 1").select("sha", "copies", F.col("_id").alias("first_id"), F.col("raw").alias("first_raw"))
    hot = hot_keys(classes.select("sha", F.col("copies").alias("n")), "sha", slim.count())
    both = salted_join(slim, counted, "sha", hot, "_id", "left")
    both = both.join(spans, both["_id"].eqNullSafe(spans["_at"]) & (both["raw"] == spans["_hash"]), "left")
    n = F.col(f"n_{unit}")
    copy = F.col("copies").isNotNull() & (n >= length)
    if keep == "first":
        copy = copy & ~(F.col("_id").eqNullSafe(F.col("first_id")))
    every = F.array(F.struct(F.lit(0).alias("start"), n.cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return both.select("_id", "raw", "sha", "n_bytes", "n_words", F.when(copy, every).otherwise(F.coalesce("spans", none)).alias("spans"))


def without_spans(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, raw, kept): the bytes that are left of each text that loses some but not all; ``spans`` as from :func:`repeated_spans`."""
    cut = spans.where((F.size("spans") > 0) & (F.try_element_at("spans", F.lit(1))["end"] - F.try_element_at("spans", F.lit(1))["start"] < F.col("n_bytes")))
    cut = cut.select(F.col("_id").alias("_at"), F.col("raw").alias("_hash"), "spans").dropDuplicates(["_at", "_hash"])
    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("raw", F.xxhash64("text"))
    both = rows.join(cut, F.col("_id").eqNullSafe(F.col("_at")) & (F.col("raw") == F.col("_hash"))).select("_id", "raw", "text", "spans")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, gone in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                data, at, parts = text.encode(), 0, []
                for s in gone:
                    parts.append(data[at : s["start"]])
                    at = s["end"]
                out.append(b"".join([*parts, data[at:]]))
            yield pa.RecordBatch.from_arrays([b.column("_id"), b.column("raw"), pa.array(out, pa.binary())], names=["_id", "raw", "kept"])

    return both.mapInArrow(keep, f"_id {dict(rows.dtypes)['_id']}, raw long, kept binary")


def report(docs: DataFrame, length: int = 400, id_col: str = "doc_id", text_col: str = "text", passage: int = PASSAGE) -> DataFrame:
    """The digest for ``keep="none"``: n_bytes, n_removed, n_spans, kept_sha256; and n_passages: the maximal runs of words covered by ``passage``
    words that occur elsewhere too, in this document or another. Those may have fewer bytes than ``length`` and are only counted."""
    known = _texts(docs, id_col, text_col)
    spans = written(_spans(*known, length, "none", "bytes"), "suffix-result")
    release(docs.sparkSession)
    passages = _spans(*known, passage, "none", "words")
    passages = written(passages.groupBy(F.col("_id").alias("_at"), F.col("raw").alias("_hash")).agg(F.max(F.size("spans")).cast("long").alias("n_passages")).where("n_passages > 0"), "suffix-passages")
    release(docs.sparkSession)
    kept = without_spans(docs, spans, id_col, text_col).select(F.col("_id").alias("_at"), F.col("raw").alias("_hash"), F.sha2("kept", 256).alias("kept_sha")).dropDuplicates(["_at", "_hash"])
    both = spans
    for part in (kept, passages):
        both = both.join(part, both["_id"].eqNullSafe(part["_at"]) & (both["raw"] == part["_hash"]), "left").drop("_at", "_hash")
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    rest = F.when(F.size("spans") == 0, F.lower(F.hex("sha"))).otherwise(F.coalesce("kept_sha", F.sha2(F.lit(""), 256)))
    return both.select(F.col("_id").alias(id_col), "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), rest.alias("kept_sha256"), F.coalesce("n_passages", F.lit(0)).cast("long").alias("n_passages"))

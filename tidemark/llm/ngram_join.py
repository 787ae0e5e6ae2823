"""Near-duplicate join on word n-grams (Jaccard) with grouped prefixes.

A document is its set of distinct word n-grams. Two documents link when their sets' Jaccard similarity reaches a threshold.
The join is exact; a hash of 64 bits stands for an n-gram. Its steps:

1. Equal sets form a class. An n-gram that only one class has cannot be shared, so a class with more of those than the
   threshold lets it lose has no link. A fixed quarter of the n-grams (by hash) is counted, which can only keep too many classes.
2. The classes left order their n-grams by a table of counts of fixed size, rare ones first. Their first
   ``n - ceil(t * n) + 1`` n-grams are the prefix; linked classes share one of them.
3. Classes with the same prefix and size collapse into one group. Groups are posted under their prefix n-grams, each is paired
   with its neighbour and with the first of its posting list, pairs are expanded to classes and verified, and what links is connected.
4. All remaining group pairs that share a prefix n-gram and lie in different components are filtered by size, by position and by a
   bitmap whose differing bits never exceed the differing n-grams, expanded to classes, and verified. Pairs inside a component need no
   check, as they cannot change it. So thousands of near copies cost a few pairs each, and no pair of components is missed.

Cases: null and empty texts have no n-grams and link with nothing; a text with fewer words than ``words`` is one n-gram; repeated
rows are one class; a null id never names a component unless all ids of it are null; empty tables give empty results;
extra columns are ignored by :func:`similar_documents` and carried by :func:`drop_similar`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.rows import keep_marked
from tidemark.shared import discard, hot_keys, release, salted_join, written

#: One n-gram of so many is counted in step 1.
SAMPLE = 4
#: The table of counts in step 2: 2 ** 18 longs, whatever the input's size.
COUNTERS = 1 << 18
#: Bits of the bitmap in step 4.
BITS = 512
#: Postings of a list that one task walks, or holds on each side of a cell, before the list is dealt; the same at every size.
PART = 1024

_RNG = np.random.Generator(np.random.PCG64(20240229))
_BYTE_EXACT = _RNG.integers(0, 1 << 64, 256, dtype=np.uint64)
_BYTE = _BYTE_EXACT.copy()
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_PLACE = _RNG.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers = [np.zeros(0, np.uint64), np.zeros(0, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _INVERSE)):
            grown = np.full(max(n, 1 << 18), base, np.uint64)
            grown[0] = 1
            _powers[i] = np.cumprod(grown)
    return _powers[0][:n], _powers[1][:n]


def word_hashes(texts: list[bytes], exact: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words in order, and where each text's begin (and the last ones end). A-Z count as a-z unless ``exact``."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    ends = np.cumsum(sizes)
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    space = _SPACE[raw]
    up, down = _power(len(raw))
    total = np.concatenate([[np.uint64(0)], np.cumsum((_BYTE_EXACT if exact else _BYTE)[raw] * up)])
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    word = _mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64) * _PLACE[0])
    owner = np.searchsorted(ends, start, side="right")
    return word, np.searchsorted(owner, np.arange(len(texts) + 1))


def shingles(texts: list[bytes], words: int) -> list[np.ndarray]:
    """The sorted distinct hashes of each text's n-grams of words; A-Z count as a-z."""
    word, first = word_hashes(texts)
    n = max(0, len(word) - words + 1)
    gram = np.full(n, words, np.uint64)
    for i in range(words):
        gram = _mix(gram + word[i : i + n] * _PLACE[i + 1])
    out = []
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= words:
            out.append(np.unique(gram[a : b - words + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for j in range(a, b):
                short = _mix(short + word[j : j + 1] * _PLACE[(j - a) % len(_PLACE)])
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate([*parts, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, parts)]), pa.int32()), pa.array(flat, pa.int64()))


def _runs(texts: list[bytes], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    whole = [_mix(_mix(s).sum(dtype=np.uint64, keepdims=True) + np.array([len(s)], np.uint64))[0] for s in sets]
    return np.array(whole, np.uint64).view(np.int64)


def _with_sets(rows: DataFrame, words: int, sampled: bool) -> DataFrame:
    """From (_id, raw, text): _id, raw, n, cls (the class) and tokens (all hashes or the sampled ones)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = _texts(b.column("text"))
            for i, j in _runs(texts):
                sets = shingles(texts[i:j], words)
                kept = [s[s % np.uint64(SAMPLE) == 0] for s in sets] if sampled else sets
                yield pa.RecordBatch.from_arrays([b.column("_id").slice(i, j - i), b.column("raw").slice(i, j - i), pa.array([len(s) for s in sets], pa.int64()), pa.array(_signatures(sets)), _lists(kept)], names=["_id", "raw", "n", "cls", "tokens"])

    return rows.mapInArrow(run, f"_id {dict(rows.dtypes)['_id']}, raw long, n long, cls long, tokens array<long>")


def _prefixes(sets: DataFrame, counts: np.ndarray, num: int, den: int) -> DataFrame:
    """From (cls, n, tokens): cls, n, gid (prefix and size), prefix, bits."""
    held = sets.sparkSession.sparkContext.broadcast(counts)  # COUNTERS longs

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            prefixes, bits, gid = [], [], []
            for x in b.column("tokens"):
                t = x.values.to_numpy(zero_copy_only=False).view(np.uint64)
                t = t[np.lexsort((t, held.value[t % np.uint64(COUNTERS)]))]
                p = t[: len(t) + (-num * len(t)) // den + 1]
                prefixes.append(p)
                whole = (_mix(p) * _mix(np.arange(1, len(p) + 1, dtype=np.uint64))).sum(dtype=np.uint64, keepdims=True)
                gid.append(_mix(whole + np.array([len(t)], np.uint64) * _PLACE[1])[0])
                odd = np.bincount(((t >> np.uint64(20)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
                bits.append(np.packbits(odd.astype(np.uint8)).view(np.uint64))
            yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("n"), pa.array(np.array(gid, np.uint64).view(np.int64)), _lists(prefixes), _lists(bits)], names=["cls", "n", "gid", "prefix", "bits"])

    return sets.select("cls", "n", "tokens").mapInArrow(run, "cls long, n long, gid long, prefix array<long>, bits array<long>")


def connected(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that each node of ``edges`` (a, b) reaches, by large-star and small-star steps. Every step is
    an aggregation and a join; its edges are written, so a lost executor costs one step at most. A hub, as a component's smallest
    node becomes, meets its own smallest neighbour by a salted join. The result is a written table."""

    def least(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))

    def with_least(pairs: DataFrame, near: DataFrame, n_pairs: int) -> DataFrame:
        return salted_join(pairs, near.select("u", "m"), "u", hot_keys(near, "u", n_pairs), "v", "inner")

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    while state[0]:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both, least(both), 2 * state[0]).select("u", "v", F.least("u", "m").alias("m"))
        large = written(large.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(), "large-star")
        # the larger node's neighbours below it, and the node itself, all go to the smallest of them
        small = with_least(large, least(large), state[0]).select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
        after = written(small.select("e.u", "e.v").where("u <> v").distinct(), "small-star")
        new = after.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(now)
        discard(large)
        now, done, state = after, new == state, new
        if done:
            break
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    labels = written(now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(roots), "labels")
    discard(now)
    return labels


def _fit(na: Column, nb: Column, num: int, den: int) -> Column:
    """The least intersection of linked sets of these sizes."""
    return F.ceil((na + nb) * num / (num + den))


def _sizes_fit(na: Column, nb: Column, num: int, den: int) -> Column:
    return (F.least(na, nb) * den >= F.greatest(na, nb) * num)


def _bits_fit(a: str, b: str, num: int, den: int) -> Column:
    """No more bits differ than n-grams may."""
    differ = F.aggregate(F.zip_with(f"{a}.bits", f"{b}.bits", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return differ <= na + nb - 2 * _fit(na, nb, num, den)


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes that link, by their whole sets."""
    left = sets.select(F.col("cls").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("cls").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return pairs.join(left, "a").join(right, "b").where(both * den >= (F.size("ta") + F.size("tb") - both) * num).select("a", "b")


def _posting_parts(posted: DataFrame) -> DataFrame:
    """``posted`` with n_salts: in how many parts of about PART postings the list of its n-gram ``h`` is dealt (null: in one). They are
    counted by slots of the table of counts, at most COUNTERS rows however many lists are long, so they are broadcast."""
    slot = F.pmod("h", F.lit(COUNTERS)).alias("slot")
    tallies = posted.select(slot).groupBy("slot").agg(F.count(F.lit(1)).alias("n"))
    hot = tallies.where(F.col("n") > PART).select("slot", F.ceil(F.col("n") / PART).cast("int").alias("n_salts"))
    return posted.select("*", slot).join(F.broadcast(hot), "slot", "left").drop("slot")


def _neighbours(posted: DataFrame, keys: list[str]) -> DataFrame:
    """(x, y): each posting with the one before it and with the first of its list, by size."""
    here, order = F.struct("cls", "n"), Window.partitionBy(*keys).orderBy("n", "cls")
    near = posted.select(here.alias("x"), F.lag(here).over(order).alias("p"), F.first(here).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("f"))
    return near.select("x", F.explode(F.array("p", "f")).alias("y")).where("y IS NOT NULL AND y.cls <> x.cls")


def _classes(sets: DataFrame, num: int, den: int) -> DataFrame | None:
    """From (cls, n, tokens): cls, n, gid, prefix, bits; None where there are no classes."""
    tallies = sets.select(F.explode("tokens").alias("h")).groupBy(F.pmod("h", F.lit(COUNTERS)).alias("slot")).count()
    slots = tallies.toPandas()  # COUNTERS rows at most
    if not len(slots):
        return None
    counts = np.zeros(COUNTERS, np.int64)
    counts[slots["slot"].to_numpy(np.int64)] = slots["count"].to_numpy(np.int64)
    return written(_prefixes(sets, counts, num, den), "ngram-prefixes")


def _near_pairs(classes: DataFrame, groups: DataFrame, num: int, den: int) -> DataFrame:
    """Step 3: pairs (a, b) of groups' first classes that are neighbours in a posting list, or one of them its first, and that may link.
    A long list is walked in parts, and the firsts of its parts once more as a list of their own."""
    reps = classes.join(groups.select(F.col("rep").alias("cls")), "cls", "left_semi")
    posted = _posting_parts(reps.select("cls", "n", F.explode("prefix").alias("h")))
    posted = posted.withColumn("part", F.coalesce(F.pmod(F.xxhash64("cls"), F.col("n_salts")).cast("int"), F.lit(0)))
    firsts = posted.where("n_salts IS NOT NULL").groupBy("h", "part").agg(F.min(F.struct("n", "cls")).alias("m")).select("h", "m.n", "m.cls")
    near = _neighbours(posted, ["h", "part"]).union(_neighbours(firsts, ["h"])).where(_sizes_fit(F.col("x.n"), F.col("y.n"), num, den))
    return _with_bits(near.select(F.least("x.cls", "y.cls").alias("a"), F.greatest("x.cls", "y.cls").alias("b")).distinct(), classes, num, den)


def _with_bits(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs (a, b) of classes whose bitmaps let them link. The bitmaps come in here, once for each pair, not with each posting."""
    left = classes.select(F.col("cls").alias("a"), F.struct("n", "bits").alias("x"))
    right = classes.select(F.col("cls").alias("b"), F.struct("n", "bits").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(_bits_fit("x", "y", num, den)).select("a", "b")


def _unit_pairs(units: DataFrame, num: int, den: int) -> DataFrame:
    """Step 4: from postings (unit, n, label, bits or null, at, h): pairs (ux, uy) of units of different labels that may link. The pairs
    of a long list are dealt over a square of cells of about PART postings on a side, so that no task holds the list or makes more pairs than a
    cell has; each pair meets in one cell."""
    mixed = units.groupBy("h").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi").select("h")
    units = _posting_parts(units.join(mixed, "h", "left_semi")).withColumn("side", F.coalesce("n_salts", F.lit(1)))
    own, other = F.pmod(F.xxhash64("unit"), F.col("side")).cast("int"), F.sequence(F.lit(0), F.col("side") - 1)
    x = units.select("*", own.alias("row"), F.explode(other).alias("col")).alias("x")
    y = units.select("*", own.alias("col"), F.explode(other).alias("row")).alias("y")
    na, nb = F.col("x.n"), F.col("y.n")
    ahead = 1 + F.least(na - F.col("x.at"), nb - F.col("y.at")) > _fit(na, nb, num, den)
    single = F.col("x.bits").isNull() | F.col("y.bits").isNull() | _bits_fit("x", "y", num, den)
    same = (F.col("x.h") == F.col("y.h")) & (F.col("x.row") == F.col("y.row")) & (F.col("x.col") == F.col("y.col"))
    pairs = x.join(y, same & (F.col("x.unit") < F.col("y.unit")) & (F.col("x.label") != F.col("y.label")) & _sizes_fit(na, nb, num, den) & ahead & single)
    return pairs.select(F.col("x.unit").alias("ux"), F.col("y.unit").alias("uy")).distinct()


def _other_links(sets: DataFrame, classes: DataFrame, placed: DataFrame, num: int, den: int) -> DataFrame:
    """The links (a, b) of classes whose labels in ``placed`` (cls, gid, rep, n, label) differ. A group whose classes have one label stays
    one unit; others are expanded."""
    pure = placed.groupBy("gid").agg(F.min("label").alias("lo"), F.max("label").alias("hi"), F.count(F.lit(1)).alias("m")).select("gid", (F.col("lo") == F.col("hi")).alias("pure"), "m")
    placed = placed.join(pure, "gid").withColumn("unit", F.when(F.col("pure"), F.col("rep")).otherwise(F.col("cls")))
    placed = written(placed.select("cls", "unit", "label", (~F.col("pure") | (F.col("m") == 1)).alias("one")), "ngram-units")
    heads = placed.where("cls = unit").join(classes, "cls").select("unit", "n", "label", F.when(F.col("one"), F.col("bits")).alias("bits"), "prefix")
    pairs = _unit_pairs(heads.select("unit", "n", "label", "bits", F.posexplode("prefix").alias("at", "h")), num, den)
    left, right = (placed.select(F.col("unit").alias(u), F.col("cls").alias(c)) for u, c in (("ux", "cx"), ("uy", "cy")))
    wide = pairs.join(left, "ux").join(right, "uy").select(F.least("cx", "cy").alias("a"), F.greatest("cx", "cy").alias("b"))
    links = written(_verified(_with_bits(wide, classes, num, den), sets, num, den), "ngram-more")
    discard(placed)
    return links


def _links(sets: DataFrame, num: int, den: int) -> DataFrame | None:
    """(cls, label) for every class with a link; None where there are no classes."""
    classes = _classes(sets, num, den)
    if classes is None:
        return None
    groups = classes.groupBy("gid").agg(F.min("cls").alias("rep"))
    member = classes.select("cls", "gid", "n").join(groups, "gid")
    inside = _with_bits(member.where("cls <> rep").select(F.col("rep").alias("a"), F.col("cls").alias("b")), classes, num, den)
    links = written(_verified(_near_pairs(classes, groups, num, den).union(inside), sets, num, den), "ngram-links")
    labels = connected(links)
    release(sets.sparkSession)
    placed = member.join(labels.withColumnRenamed("node", "cls"), "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    more = _other_links(sets, classes, placed, num, den)
    merged = connected(links.union(more)).select(F.col("node").alias("cls"), "label")
    for table in (classes, links, more, labels):
        discard(table)
    return merged


def _every_link(sets: DataFrame, num: int, den: int) -> DataFrame | None:
    """(a, b) for all pairs of classes that link: every group pair is verified, whatever it is connected with."""
    classes = _classes(sets, num, den)
    if classes is None:
        return None
    groups = classes.groupBy("gid").agg(F.min("cls").alias("rep"))
    placed = classes.select("cls", "gid", "n").join(groups, "gid").withColumn("label", F.col("cls"))
    links = _other_links(sets, classes, placed, num, den)
    discard(classes)
    return links


def _sets_of(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """slim (_id, raw, n, cls) of every row; classes (cls, rows, _rep, _raw) of every set; sets (cls, n, tokens) of those that may link."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).withColumn("raw", F.xxhash64(F.coalesce("text", F.lit(""))))
    first = written(_with_sets(rows, words, True), "ngram-rows")
    seen = first.where("n > 0")
    own = seen.select("cls", F.explode("tokens").alias("h")).groupBy("h").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a = b").groupBy(F.col("a").alias("cls")).agg(F.count(F.lit(1)).alias("own"))
    best = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "raw"))
    classes = seen.groupBy("cls", "n").agg(best.alias("best"), F.count(F.lit(1)).alias("rows"))
    may = classes.join(own, "cls", "left").withColumn("maybe", F.coalesce("own", F.lit(0)) <= F.floor(F.col("n") * (den - num) / den))
    classes = written(may.select("cls", "rows", F.col("best._id").alias("_rep"), F.col("best.raw").alias("_raw"), "maybe"), "ngram-classes")
    slim = written(first.select("_id", "raw", "n", "cls"), "ngram-slim")
    discard(first)
    release(docs.sparkSession)

    wanted = classes.where("maybe").select("_rep", "_raw")
    texts = rows.join(wanted, F.col("_id").eqNullSafe(F.col("_rep")) & (F.col("raw") == F.col("_raw")), "left_semi")
    # rows that are repeated whole bring their set twice
    sets = written(_with_sets(texts, words, False).select("cls", "n", "tokens").dropDuplicates(["cls"]), "ngram-sets")
    release(docs.sparkSession)
    return slim, classes, sets


def _verdicts(docs: DataFrame, id_col: str, text_col: str, words: int, num: int, den: int) -> DataFrame:
    """A row for each row: _id, raw, n, cls, label (of the component; null without n-grams), component_id."""
    slim, classes, sets = _sets_of(docs, id_col, text_col, words, num, den)
    labels = _links(sets, num, den)
    discard(sets)
    named = classes.withColumn("label", F.col("cls")) if labels is None else classes.join(labels, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    named = written(named.select("cls", "rows", "_rep", "label"), "ngram-named")
    discard(classes)
    components = named.groupBy("label").agg(F.min("_rep").alias("component_id"), F.count(F.lit(1)).alias("n_classes"))
    # only components of several classes need the join; the others are named by their own class
    several = components.where("n_classes > 1").select("label", "component_id")
    hot = hot_keys(components.select("label", F.col("n_classes").alias("n")), "label", named.count())
    placed = salted_join(named, several, "label", hot, "cls", "left").select("cls", "rows", "label", F.coalesce("component_id", "_rep").alias("component_id"))
    placed = written(placed, "ngram-components")
    discard(named)
    out = salted_join(slim, placed.select("cls", "label", "component_id"), "cls", hot_keys(placed.select("cls", F.col("rows").alias("n")), "cls", slim.count()), "_id", "left")
    return out.select("_id", "raw", "n", "cls", "label", F.when(F.col("label").isNull(), F.col("_id")).otherwise(F.col("component_id")).alias("component_id"))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """For each row: its id, n_shingles, component_id (the smallest id that links reach). ``num / den`` is the threshold."""
    out = _verdicts(docs, id_col, text_col, words, num, den)
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def similar_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame]:
    """The whole join: (id, class_id) of every row, and (class_a, class_b) for every link between two classes of equal sets. A class is
    named by the smallest id in it; rows without n-grams have none."""
    slim, classes, sets = _sets_of(docs, id_col, text_col, words, num, den)
    links = _every_link(sets, num, den)
    names = classes.select("cls", F.col("_rep").alias("class_id"))
    hot = hot_keys(classes.select("cls", F.col("rows").alias("n")), "cls", slim.count())
    member = salted_join(slim.select("_id", "cls", "raw"), names, "cls", hot, "raw", "left").select(F.col("_id").alias(id_col), "class_id")
    if links is None:
        pairs = names.select(F.col("class_id").alias("class_a"), F.col("class_id").alias("class_b")).limit(0)
    else:
        left, right = (names.select(F.col("cls").alias(c), F.col("class_id").alias(f"class_{c}")) for c in "ab")
        pairs = links.join(left, "a").join(right, "b").select(F.least("class_a", "class_b").alias("class_a"), F.greatest("class_a", "class_b").alias("class_b"))
    return member, pairs


def drop_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with the row of the smallest id of each component; rows without n-grams stay."""
    out = _verdicts(docs, id_col, text_col, words, num, den)
    first = F.min(F.struct(F.col("_id").isNull().alias("no_id"), "_id", "raw")).alias("first")
    out = written(out.select("_id", "raw", "label"), "ngram-verdicts")
    sizes = out.where("label IS NOT NULL").groupBy("label").agg(first, F.count(F.lit(1)).alias("n"))
    several = written(sizes.where("n > 1").select("label", F.col("first._id").alias("_k_id"), F.col("first.raw").alias("_k_raw"), "n"), "ngram-kept")
    met = salted_join(out, several.drop("n"), "label", hot_keys(several, "label", out.count()), "_id", "inner")
    kept = F.col("_id").eqNullSafe(F.col("_k_id")) & (F.col("raw") == F.col("_k_raw"))
    rows = met.groupBy("_id", "raw").agg(F.max(kept.cast("int")).alias("stay"), F.count(F.lit(1)).alias("n")).where("stay < n")
    return keep_marked(docs, rows, id_col, text_col)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Three words and nine tenths, over all documents; meant for small tables, as it joins all documents that share an n-gram.
ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 90 * (nx.n + ny.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, m.y) AS component_id FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) m ON m.x = d.doc_id
"""

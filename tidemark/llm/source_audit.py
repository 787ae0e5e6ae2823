"""How far the sources of each language stand apart in their words, from mergeable radix tries.

A task counts its texts' terms in one byte trie for each language: a leaf holds how many documents have the term and a counter for each source. Tries are
flat, in the order of a walk: for each term the depth at which it leaves the path of the term before, and the label from there on. They leave the task cut
by prefix; pieces of a language and prefix range meet in one task, which merges them in UTF-8 order. A term that enough documents of its language
have is kept with its counters.

From then on there are kept terms alone. Tasks walk them in order, block by block: absolute differences of shares are added up for each pair
of sources (in square cells of source pairs, so that memory does not grow with their number), and for each source the best candidates are held, ties in the order of the walk.
Sums and candidates of tasks are put together by Spark.

The driver gathers the sources of each language with their totals: the result has a row for each pair of them, so that they are few
whenever it can be written at all.

Cases: null text, language and source count as empty texts; a group (language, source) without terms has all its shares from smoothing alone; a
language without kept terms gives pairs with value 0 and no term rows; repeated rows are documents each; terms of any length count whole; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices
from tidemark.shared import discard, written

LEAST_DOCS, TOP, SMOOTHING, SCALE = 30, 50, 5, 10**9
#: ASCII letters and all beyond ASCII; bytes.lower() lowers A-Z alone.
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")
#: Bytes of the prefix by which tries are cut and merged, and about the counters of a piece, so that pieces are of like size and ranges of them too.
PREFIX, PIECE_COUNTERS = 4, 64
#: Counters that a task holds before its tries leave it, and terms that are merged at a time, but for a prefix that has more.
COUNTERS, MERGED = 400_000, 20_000
#: Sources on a side of a cell of pairs; shares (terms by sources) that are held at a time; cells that are added up before they leave the task.
CELL, SHARES, CELLS = 256, 1 << 20, 64


class Trie:
    """A radix trie in the order of its walk: terms ascend, and each has documents[i] documents and the next sizes[i] of the counters (sources, counts)."""

    def __init__(self, terms: list[bytes], documents: np.ndarray, sizes: np.ndarray, sources: pa.Array, counts: np.ndarray):
        self.terms, self.documents, self.sizes, self.sources, self.counts = terms, documents, sizes, sources, counts

    @classmethod
    def of(cls, documents: Counter, counts: dict[str, Counter]) -> Trie:
        """The trie of counted terms (documents of each term, occurrences of each by source)."""
        terms = list(documents)
        parts = [(source, found) for source, found in counts.items() if found]
        named = pa.array([source for source, _ in parts], pa.string())
        who = np.repeat(np.arange(len(parts)), [len(found) for _, found in parts])
        entry = [term for _, found in parts for term in found]
        n = np.array([x for _, found in parts for x in found.values()], np.int64)
        return cls._ordered(terms, np.fromiter(documents.values(), np.int64, len(terms)), entry, who, named, n)

    @classmethod
    def merge(cls, tries: list[Trie]) -> Trie:
        """The trie of all terms of several: counters of one term and source add up."""
        terms = [t for x in tries for t in x.terms]
        entry = [t for x in tries for t, n in zip(x.terms, x.sizes.tolist(), strict=True) for t in (t,) * n]
        coded = pa.chunked_array([x.sources for x in tries]).combine_chunks().dictionary_encode()
        return cls._ordered(terms, np.concatenate([x.documents for x in tries]), entry, coded.indices.to_numpy(), coded.dictionary, np.concatenate([x.counts for x in tries]))

    @classmethod
    def _ordered(cls, terms: list[bytes], documents: np.ndarray, entry: list[bytes], who: np.ndarray, named: pa.Array, n: np.ndarray) -> Trie:
        """From terms with documents and counters (term, source, n), in any order and any number of times."""
        walk = sorted(set(terms))
        place = {term: i for i, term in enumerate(walk)}.__getitem__
        docs = np.bincount(np.fromiter(map(place, terms), np.int64, len(terms)), weights=documents, minlength=len(walk)).astype(np.int64)
        key = np.fromiter(map(place, entry), np.int64, len(entry)) * max(1, len(named)) + who
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(key[order]) != 0)) if len(key) else np.zeros(0, np.int64)
        held = key[order][first]
        counts = np.add.reduceat(n[order], first) if len(key) else n
        sizes = np.bincount(held // max(1, len(named)), minlength=len(walk))
        return cls(walk, docs, sizes, named.take(pa.array(held % max(1, len(named)))), counts)

    def where(self, stays: np.ndarray) -> Trie:
        """The trie of the terms that stay."""
        mask = np.repeat(stays, self.sizes)
        return Trie([t for t, s in zip(self.terms, stays.tolist(), strict=True) if s], self.documents[stays], self.sizes[stays], self.sources.filter(pa.array(mask)), self.counts[mask])

    def depths(self) -> np.ndarray:
        """How many bytes each term shares with the term before, which is where its edge leaves that one's path."""
        out, width = np.zeros(len(self.terms), np.int64), 32
        if len(self.terms) > 1:
            size = np.fromiter(map(len, self.terms), np.int64, len(self.terms))
            head = np.array(self.terms, f"S{width}").view(np.uint8).reshape(-1, width)
            same = (head[1:] == head[:-1]).cumprod(axis=1).sum(1)
            out[1:] = np.minimum(same, np.minimum(size[1:], size[:-1]))
            for i in np.flatnonzero(out == width):  # both go on beyond the head
                out[i] = len(os.path.commonprefix([self.terms[i - 1], self.terms[i]]))
        return out


_COLUMNS = {"lang": "string", "prefix": "binary", "depths": "array<int>", "labels": "array<binary>", "documents": "array<long>", "sizes": "array<int>", "sources": "array<string>", "counts": "array<long>"}
PIECE = ", ".join(f"{name} {kind}" for name, kind in _COLUMNS.items())


def _pieces(lang: str, trie: Trie) -> pa.RecordBatch:
    """The trie cut by prefix into rows of PIECE; the first term of a row leaves the path at the prefix."""
    n = len(trie.terms)
    prefix = [t[:PREFIX] for t in trie.terms]
    new = np.fromiter((i == 0 or prefix[i] != prefix[i - 1] for i in range(n)), bool, n)
    ends = np.append(0, np.cumsum(trie.sizes))
    start = np.flatnonzero(new | np.append(True, np.diff(ends[:-1] // PIECE_COUNTERS) != 0))
    depth = trie.depths()
    depth[start] = [len(prefix[i]) for i in start]
    labels = [t[d:] for t, d in zip(trie.terms, depth.tolist(), strict=True)]
    at = pa.array(np.append(start, n), pa.int32())
    of_terms = lambda values, kind: pa.ListArray.from_arrays(at, pa.array(values, kind))
    counters = pa.array(ends[np.append(start, n)], pa.int32())
    columns = [
        pa.array([lang] * len(start)), pa.array([prefix[i] for i in start], pa.binary()), of_terms(depth, pa.int32()), of_terms(labels, pa.binary()), of_terms(trie.documents, pa.int64()), of_terms(trie.sizes, pa.int32()),
        pa.ListArray.from_arrays(counters, trie.sources), pa.ListArray.from_arrays(counters, pa.array(trie.counts, pa.int64())),
    ]
    return pa.RecordBatch.from_arrays(columns, names=list(_COLUMNS))


def _trie_of(pieces: pa.RecordBatch) -> Trie:
    """The terms of some pieces, row after row, with their counters; not yet one trie, as rows may hold the same terms."""
    flat = {name: pieces.column(name).flatten() for name in list(_COLUMNS)[2:]}
    terms, path = [], b""
    starts = [p for p, n in zip(pieces.column("prefix").to_pylist(), pieces.column("depths").value_lengths().to_pylist(), strict=True) for p in (p, *(None,) * (n - 1))]
    for start, depth, label in zip(starts, flat["depths"].to_pylist(), flat["labels"].to_pylist(), strict=True):
        path = (path if start is None else start)[:depth] + label
        terms.append(path)
    return Trie(terms, flat["documents"].to_numpy(), flat["sizes"].to_numpy(), flat["sources"], flat["counts"].to_numpy())


def tries(docs: DataFrame) -> DataFrame:
    """The tries of all tasks over ``docs`` (lang, source, text as bytes), cut by prefix, as rows of PIECE."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        documents: dict[str, Counter] = defaultdict(Counter)

        def left() -> Iterator[pa.RecordBatch]:
            for lang in list(documents):
                trie = Trie.of(documents.pop(lang), counts.pop(lang))
                if trie.terms:
                    yield _pieces(lang, trie)

        for b in batches:
            for part in slices(b, "text"):
                for lang, source, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    terms = TERM.findall(text.lower())
                    counts[lang][source].update(terms)
                    documents[lang].update(set(terms))
                if sum(len(found) for by_source in counts.values() for found in by_source.values()) > COUNTERS:
                    yield from left()
        yield from left()

    return docs.select("lang", "source", "text").mapInArrow(count, PIECE)


def merged(pieces: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """(lang, term, sources, counts): the terms that ``least`` documents of the language have, in order within each task. Pieces are dealt by
    ranges of language and prefix, and a task merges some prefixes at a time."""

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[Trie] = []
        size, last = 0, None

        def kept() -> Iterator[pa.RecordBatch]:
            trie = Trie.merge(held)
            trie = trie.where(trie.documents >= least)
            if trie.terms:
                at = pa.array(np.append(0, np.cumsum(trie.sizes)), pa.int32())
                columns = [pa.array([last[0]] * len(trie.terms)), pa.array([t.decode() for t in trie.terms]), pa.ListArray.from_arrays(at, trie.sources), pa.ListArray.from_arrays(at, pa.array(trie.counts, pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "term", "sources", "counts"])

        for b in batches:
            keys = list(zip(b.column("lang").to_pylist(), b.column("prefix").to_pylist(), strict=True))
            lengths = b.column("depths").value_lengths().to_pylist()
            start = 0
            for i, key in enumerate(keys):
                if last is not None and key != last and (size >= MERGED or key[0] != last[0]):
                    if i > start:
                        held.append(_trie_of(b.slice(start, i - start)))
                    yield from kept()
                    held, size, start = [], 0, i
                last, size = key, size + lengths[i]
            if start < b.num_rows:
                held.append(_trie_of(b.slice(start)))
        if held:
            yield from kept()

    ranges = pieces.repartitionByRange("lang", "prefix").sortWithinPartitions("lang", "prefix")
    return ranges.mapInArrow(merge, "lang string, term string, sources array<string>, counts array<long>")


def shares(counts: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + SMOOTHING) / whole), exactly, three digits at a time: no product leaves 64 bits."""
    part = counts + SMOOTHING
    out, rest = part // whole, part % whole
    for _ in range(3):
        out, rest = out * 1000 + rest * 1000 // whole, rest * 1000 % whole
    return out + 1


def _best(candidates: list[tuple], top: int) -> list[tuple]:
    """The ``top`` first of (-value, term as bytes)."""
    return sorted(candidates)[:top]


def differences(kept: DataFrame, groups: dict[str, tuple[list[str], list[int], int]], top: int = TOP) -> DataFrame:
    """Partial results over the kept terms: (lang, source, item, value) with item a later source of the language and value the summed difference
    (is_pair), or a candidate term and what the source's share exceeds the language's by. ``groups``: language -> sources in order, their totals, kept terms."""
    held = kept.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place: dict[str, dict[str, int]] = {}
        cells: dict[tuple, np.ndarray] = {}
        best: dict[tuple, list] = {}

        def block(lang: str, terms: list[str], sources: list[list[str]], counts: list[list[int]]) -> None:
            names, n, v = held.value[lang]
            whole = np.array(n, np.int64) + SMOOTHING * v
            at = place.setdefault(lang, {s: i for i, s in enumerate(names)})
            row = np.repeat(np.arange(len(terms)), list(map(len, sources)))
            col = np.array([at[s] for x in sources for s in x], np.int64)
            count = np.array([c for x in counts for c in x], np.int64)
            q = shares(np.array([sum(c) for c in counts], np.int64), np.int64(sum(n) + SMOOTHING * v))
            over = shares(count, whole[col]) - q[row]
            for k in np.flatnonzero((over > 0) & (count > 0)):
                best.setdefault((lang, names[col[k]]), []).append((-int(over[k]), terms[row[k]].encode()))
            for key in {(lang, names[c]) for c in set(col.tolist())}:
                if len(best.get(key, ())) > 8 * top:
                    best[key] = _best(best[key], top)
            sides = range(0, len(names), CELL)
            p = {}
            for s in sides:
                inside = (col >= s) & (col < s + CELL)
                dense = np.zeros((len(terms), len(names[s : s + CELL])), np.int64)
                dense[row[inside], col[inside] - s] = count[inside]
                p[s] = shares(dense, whole[s : s + CELL])
            for s in sides:
                for t in range(s, len(names), CELL):
                    cell = cells.setdefault((lang, s, t), np.zeros((p[s].shape[1], p[t].shape[1]), np.int64))
                    for a in range(len(cell)):
                        cell[a] += np.abs(p[t] - p[s][:, a : a + 1]).sum(0)

        def drained() -> Iterator[pa.RecordBatch]:
            for (lang, s, t), cell in cells.items():
                names = held.value[lang][0]
                a, b = np.nonzero((np.arange(len(cell))[:, None] + s) < (np.arange(cell.shape[1])[None, :] + t))
                yield rows(lang, [names[s + i] for i in a], [names[t + i] for i in b], cell[a, b], True)
            cells.clear()

        def rows(lang: str, source: list[str], item: list[str], value, is_pair: bool) -> pa.RecordBatch:
            columns = [pa.array([lang] * len(source), pa.string()), pa.array(source, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64()), pa.array([is_pair] * len(source), pa.bool_())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "item", "value", "is_pair"])

        for b in batches:
            langs, terms, sources, counts = (c.to_pylist() for c in b.columns)
            i = 0
            while i < len(langs):
                step, j = max(1, SHARES // len(held.value[langs[i]][0])), i
                while j < len(langs) and langs[j] == langs[i] and j - i < step:
                    j += 1
                block(langs[i], terms[i:j], sources[i:j], counts[i:j])
                i = j
                if len(cells) > CELLS:
                    yield from drained()
        yield from drained()
        for (lang, source), found in best.items():
            found = _best(found, top)
            yield rows(lang, [source] * len(found), [t.decode() for _, t in found], [-v for v, _ in found], False)

    return kept.mapInArrow(run, "lang string, source string, item string, value long, is_pair boolean")


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """For each group (language, source): part ``pair`` with every other source of the language and the summed difference of their shares, and part
    ``term`` with the ``top`` kept terms whose share exceeds the language's most; value descending, ties in UTF-8 order, rank from 1."""
    blank = F.lit("")
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), blank).alias("lang"), F.coalesce(F.col(source_col).cast("string"), blank).alias("source"), F.coalesce(F.col(text_col), blank).cast("binary").alias("text"))
    pieces = written(tries(rows), "audit-tries")
    kept = written(merged(pieces, least), "audit-terms")
    discard(pieces)
    terms = {r["lang"]: r["n"] for r in kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", "x.sources").agg(F.sum("x.counts").alias("n"))
    named = written(rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs")), "audit-groups")
    whole = named.join(counted.withColumnRenamed("sources", "source"), ["lang", "source"], "left").select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"))
    groups: dict[str, tuple[list, list, int]] = {}
    for r in sorted(whole.collect(), key=lambda r: (r["lang"], r["source"].encode())):
        names, ns, _ = groups.setdefault(r["lang"], ([], [], terms.get(r["lang"], 0)))
        names.append(r["source"])
        ns.append(r["n"])
    found = written(differences(kept, groups, top), "audit-differences")
    discard(kept)
    one = found.where("is_pair").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    both = one.union(one.select("lang", F.col("item"), F.col("source"), "value"))
    other = named.select("lang", F.col("source").alias("item"))
    pairs = named.select("lang", "source").join(other, "lang").where("source <> item").join(both, ["lang", "source", "item"], "left")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value")).withColumn("rank", F.row_number().over(order))
    best = found.where("NOT is_pair").select("lang", "source", F.lit("term").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.union(best)


ORACLE = r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents), grp AS (SELECT DISTINCT lang, source FROM d),
    w AS (SELECT doc_id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
    k AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT doc_id) >= 30), c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY ALL), v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
    tot AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::BIGINT AS n FROM grp g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL), ltot AS (SELECT lang, sum(n)::BIGINT AS n FROM tot GROUP BY lang), lc AS (SELECT lang, term, sum(n)::BIGINT AS n FROM c GROUP BY ALL),
    p AS (SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.n + 5 * v.v) AS p FROM tot t JOIN v ON t.lang = v.lang JOIN k ON k.lang = t.lang LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term),
    q AS (SELECT lc.lang, lc.term, 1 + (1000000000::HUGEINT * (lc.n + 5)) // (t.n + 5 * v.v) AS q FROM lc JOIN ltot t ON lc.lang = t.lang JOIN v ON v.lang = lc.lang),
    s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
    pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
    te AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p - q)::BIGINT AS value FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p > q),
    r AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)))::INTEGER AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM te)) SELECT * FROM r WHERE part = 'pair' OR rank <= 50"""

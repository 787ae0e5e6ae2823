"""Byte-level BPE over a file of ranks, on length-bucketed matrices.

Words (the matches of the pattern) that are not tokens themselves are dealt by length into padded matrices of token ids. In each round
every row that can still merge does so at its leftmost pair of least rank. Pairs are looked up in a hash table of two numpy
arrays, and a merge is a compaction: one column leaves every row of the matrix, rows without a pair left leave the matrix. A word of over ``LONG`` bytes
is a matrix of its own, whose row merges all pairs of least rank in one round where no merge among them forms a pair of lower rank, which gives the
same ids in fewer rounds.

Ids are remembered by word within a worker, so that each distinct word is merged about once.

The pattern's classes follow the edition of Unicode that the tiktoken library was built with, which is asked once for each character from
U+0250 on that a worker meets; characters that the regex library files elsewhere are replaced by ones of their class before
the text is cut.

Cases: null text is empty; an empty text has no ids and decodes to no bytes; words of any length are merged whole; the strings of special tokens are
ordinary text; repeated rows are encoded each; extra columns are kept, but one that is called like a result is replaced by it.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bpe import OUTSIDE, WORD, slices

#: Cells of a matrix at most, but for a single word that is longer.
CELLS = 1 << 21
#: Words of more bytes are matrices of one row, which merge all pairs of one rank in a round.
LONG = 512
#: Words that a worker remembers between batches, and the longest (bytes) of them.
MEMO_WORDS, MEMO_LENGTH = 300_000, 256
NO_PAIR = np.int32(2**31 - 1)


class Ranks:
    """The tokens of a file of base64 texts and ranks, and the table of pairs that merge."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            lines = [line.split() for line in f.read().splitlines() if line]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.token = [b""] * (1 + max(self.rank.values()))
        for token, i in self.rank.items():
            self.token[i] = token
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int32)
        left, right, merged = [], [], []
        for token, i in self.rank.items():
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        self._fill(np.array(left, np.int64) << 32 | np.array(right, np.int64), np.array(merged, np.int32))

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _fill(self, keys: np.ndarray, merged: np.ndarray) -> None:
        """Open addressing: what does not find its slot free tries the next one."""
        self.bits = max(8, int(np.ceil(np.log2(max(1, len(keys)) * 4))))
        self.mask = (1 << self.bits) - 1
        self.keys, self.merged = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, NO_PAIR, np.int32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[left[free]]  # of several for one slot the last stays
            done = self.keys[slot] == keys[left]
            self.merged[slot[done]] = merged[left[done]]
            left, slot = left[~done], (slot[~done] + 1) & self.mask

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of ids, which is the id it merges to; NO_PAIR where it does not merge or an id is missing (-1)."""
        shape = left.shape
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).ravel()
        out = np.full(len(keys), NO_PAIR, np.int32)
        asked = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        slot = self._slot(keys[asked])
        while len(asked):
            there = self.keys[slot]
            hit = there == keys[asked]
            out[asked[hit]] = self.merged[slot[hit]]
            on = ~hit & (there != -1)
            asked, slot = asked[on], (slot[on] + 1) & self.mask
        return out.reshape(shape)

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """The ids of each word, which are not empty; words of like length share a matrix."""
        out: list = [None] * len(words)
        size = np.array(list(map(len, words)), np.int64)
        bucket = np.ceil(np.log2(np.maximum(size, 2))).astype(int)
        for i in np.flatnonzero(size > LONG):
            out[i] = self._merge_long(words[i])
        for b in np.unique(bucket[size <= LONG]):
            members = np.flatnonzero((bucket == b) & (size <= LONG))
            step = max(1, CELLS >> int(b))
            for i in range(0, len(members), step):
                part = members[i : i + step]
                self._merge_matrix([words[j] for j in part], part, out)
        return out

    def _merge_matrix(self, words: list[bytes], names: np.ndarray, out: list) -> None:
        size = np.array(list(map(len, words)), np.int64)
        ids = np.full((len(words), int(size.max())), -1, np.int32)
        ids[np.arange(ids.shape[1]) < size[:, None]] = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        ranks = self.pairs(ids[:, :-1], ids[:, 1:]) if ids.shape[1] > 1 else np.zeros((len(ids), 0), np.int32)
        while True:
            at = ranks.argmin(1) if ranks.shape[1] else np.zeros(len(ids), np.int64)
            least = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), NO_PAIR)
            live = least != NO_PAIR
            for row, name in zip(ids[~live], names[~live], strict=True):
                out[name] = row[row >= 0]
            if not live.any():
                return
            ids, ranks, names, at, least = ids[live], ranks[live], names[live], at[live], least[live]
            ids, ranks = self._merge_first(ids, ranks, at, least)

    def _merge_first(self, ids: np.ndarray, ranks: np.ndarray, at: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Every row merges one pair, so every row loses one column."""
        n, width = ids.shape
        row = np.arange(n)
        ids[row, at] = least
        stays = np.ones((n, width), bool)
        stays[row, at + 1] = False
        ids = ids[stays].reshape(n, width - 1)
        stays = np.ones((n, width - 1), bool)
        stays[row, at] = False
        ranks = ranks[stays].reshape(n, width - 2)
        for place in (at - 1, at):  # the pairs of the new token with its neighbours
            k = np.flatnonzero((place >= 0) & (place < width - 2))
            ranks[k, place[k]] = self.pairs(ids[k, place[k]], ids[k, place[k] + 1])
        return ids, ranks

    def _merge_long(self, word: bytes) -> np.ndarray:
        """One long word as a matrix of one row, which is compacted only when half of it is gone; until then links lead from token to token. In a
        round all pairs of least rank merge from the left, or the first one alone where a merge among them forms a pair of lower rank."""
        ids = self.byte[np.frombuffer(word, np.uint8)]
        while True:
            n = len(ids)
            ids = np.concatenate([[-1], ids, [-1]]).astype(np.int32)  # nothing stands at either end
            after, before = np.arange(1, n + 3), np.arange(-1, n + 1)
            ranks = np.append(self.pairs(ids[:-1], ids[1:]), NO_PAIR)
            dead = np.zeros(n + 2, bool)
            gone = 0
            while 2 * gone < n and (least := ranks.min()) != NO_PAIR:
                p = np.flatnonzero(ranks == least)
                # of a run of overlapping pairs (as in aaaa) every other one, from the run's start on
                start = np.append(True, after[p[:-1]] != p[1:])
                place = np.arange(len(p))
                p = p[(place - np.maximum.accumulate(np.where(start, place, 0))) % 2 == 0]
                # as they are met from the left: the token before may be merged already, the one behind is not
                left = ids[before[p]]
                left[1:][after[after[p[:-1]]] == p[1:]] = least
                token = np.full(len(p), least, np.int32)
                if ((self.pairs(left, token) < least) | (self.pairs(token, ids[after[after[p]]]) < least)).any():
                    p = p[:1]
                lost = after[p]
                ids[p], ranks[lost], dead[lost] = least, NO_PAIR, True
                after[p] = after[lost]
                before[after[p]] = p
                ranks[p] = self.pairs(ids[p], ids[after[p]])
                q = before[p]
                ranks[q] = self.pairs(ids[q], ids[p])
                gone += len(p)
            ids = ids[~dead][1:-1]
            if least == NO_PAIR:
                return ids


@lru_cache(maxsize=4)
def ranks_of(path: str) -> Ranks:
    return Ranks(path)


class Classes:
    """Characters that the regex library and the tiktoken library file under different classes, as a table for str.translate."""

    #: A character of each class on which all editions agree, by the character before it with which it makes one word: fixed values.
    LIKE = {"a": "Ā", "0": "²", "!": ""}

    def __init__(self, pattern: str):
        import regex

        self.pattern, self.known, self.table, self.words = pattern, set(), {}, regex.compile(pattern)

    def learn(self, text: str) -> None:
        new = [c for c in set(text).difference(self.known) if c > "ɏ" and not "\ud800" <= c <= "\udfff"]
        if not new:
            return
        import tiktoken

        self.known.update(new)
        pairs = {(c, first): (first + c).encode() for c in new for first in self.LIKE}
        ranks = {bytes([b]): b for b in range(256)} | {w: 256 + i for i, w in enumerate(pairs.values())}
        probe = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})
        for (c, first), word in pairs.items():
            if len(probe.encode_ordinary(word.decode())) == 1 and not self.words.fullmatch(first + c):
                self.table[ord(c)] = self.LIKE[first]

    def cut(self, text: str) -> list[str]:
        self.learn(text)
        if not self.table or not any(ord(c) in self.table for c in set(text)):
            return self.words.findall(text)
        return [text[m.start() : m.end()] for m in self.words.finditer(text.translate(self.table))]


@lru_cache(maxsize=4)
def splitter(pattern: str) -> Callable[[str], list[str]]:
    """A function that cuts a text into the matches of ``pattern``. For the public byte-level pattern and texts with code points below 0x250 only,
    a plain pattern does the same, faster."""
    import public_tokenizers

    classes = Classes(pattern)
    if pattern != public_tokenizers.PATTERN:
        return classes.cut
    return lambda text: classes.cut(text) if OUTSIDE.search(text) else WORD.findall(text)


@lru_cache(maxsize=4)
def _memo(path: str) -> dict:
    """The ids of words, kept by a worker from task to task."""
    return {}


def encoder(path: str, pattern: str) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to the ids of each as little-endian unsigned 32-bit integers."""
    ranks, cut, memo = ranks_of(path), splitter(pattern), _memo(path)

    def encode(texts: list[str]) -> list[bytes]:
        if len(memo) > MEMO_WORDS:
            memo.clear()
        rows = [cut(t) for t in texts]
        new = list(set().union(*rows).difference(memo))
        here, merge = {}, []
        for w in new:
            i = ranks.rank.get(w.encode())
            if i is None:
                merge.append(w)
            else:
                here[w] = i.to_bytes(4, "little")
        for w, ids in zip(merge, ranks.merge([w.encode() for w in merge]), strict=True):
            here[w] = ids.astype("<u4").tobytes()
        memo.update((w, ids) for w, ids in here.items() if len(w) <= MEMO_LENGTH)
        long = {w: ids for w, ids in here.items() if len(w) > MEMO_LENGTH}
        if not long:
            return [b"".join(map(memo.__getitem__, r)) for r in rows]
        return [b"".join([long[w] if w in long else memo[w] for w in r]) for r in rows]

    return encode


def _decode(ids: bytes, token: list[bytes]) -> bytes:
    return b"".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _fields(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), *more])


def _map_texts(docs: DataFrame, text_col: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]], *more: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with the columns that ``make()`` gives for the texts of a slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for b in batches:
            for part in slices(b, text_col):
                added = work([t or "" for t in part.column(text_col).to_pylist()])
                kept = part if keep_text else part.drop_columns([text_col])
                yield pa.RecordBatch.from_arrays([*kept.columns, *added], names=[*kept.schema.names, *(m.split()[0] for m in more)])

    return docs.mapInArrow(run, _fields(docs if keep_text else docs.drop(text_col), *more))


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with their token ids in ``token_ids`` (array of int)."""

    def make():
        work = encoder(path, pattern)

        def columns(texts: list[str]) -> list[pa.Array]:
            parts = work(texts)
            return [pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(len(p) // 4 for p in parts)]), pa.int32()), pa.array(np.frombuffer(b"".join(parts), "<i4"), pa.int32()))]

        return columns

    return _map_texts(docs.drop("token_ids"), text_col, make, "token_ids array<int>")


def decode(rows: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the bytes of their ids in ``out_col`` (binary); ``ids_col`` stays. Null ids give no bytes."""
    rows = rows.drop(out_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = ranks_of(path).token
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids_col))
            texts = [b"".join([token[i] for i in (x.values.to_pylist() if x.is_valid else ())]) for x in lists]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.binary())], names=[*b.schema.names, out_col])

    return rows.mapInArrow(run, _fields(rows, f"`{out_col}` binary"))


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` without the text, with ``ids`` (little-endian unsigned 32-bit integers) and ``decoded`` (the bytes of these ids): both
    in one worker, so that the ids cross to Python once."""

    def make():
        work, token = encoder(path, pattern), ranks_of(path).token

        def columns(texts: list[str]) -> list[pa.Array]:
            ids = work(texts)
            return [pa.array(ids, pa.binary()), pa.array([_decode(x, token) for x in ids], pa.binary())]

        return columns

    return _map_texts(docs.drop("ids", "decoded"), text_col, make, "ids binary", "decoded binary", keep_text=False)

"""Packing of token sequences by Karmarkar-Karp multiway differencing.

Texts are tokenized where they are read. Of each document, runs of exactly the window's length become windows of their own; the
rest is cut into parts of at most ``PART`` tokens. The parts of ``GROUP`` documents are dealt over windows by multiway
differencing: partial partitions start as single parts, and the two with the widest spread are merged with opposing
imbalances (the fullest windows of one with the emptiest of the other) until one is left, which gives near-equal windows. The number of
windows starts at the least that could hold all tokens and rises whenever one exceeds its capacity. Groups are packed within
the task that read them, so nothing is shuffled and every group is of bounded size.

Cases: a null text counts as empty; an empty text is the end-of-text id alone; repeated rows are packed each; a null id stays null;
empty tables give empty results; extra columns are ignored. Ids are whole numbers or cast to such, as the pieces carry
them as longs.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.bpe import byte_letters

#: Tokens of a window, of a part, and documents of a group.
WINDOW, PART, GROUP = 2048, 512, 1024
#: Words that a worker remembers at most, and the longest (characters) of them.
MEMO_WORDS, MEMO_LENGTH = 400_000, 128
#: Id after each document.
END = 1

#: The vocabulary's word pattern for code points below 0x180: fixed values.
_L, _N, _S = "a-zA-ZªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
WORD = re.compile(rf"[{_L}]+|'(?:s|t|re|ve|m|ll|d)|[{_N}]|[^{_S}{_L}{_N}]+")
#: Texts with one of these, or with special tokens, go through the library as a whole: other alphabets, a capital whose lower case is two code points (U+0130).
OUTSIDE = re.compile("[^\x00-įı-ſ]")


@lru_cache(maxsize=4)
def _library(path: str):
    from tokenizers import Tokenizer

    out = Tokenizer.from_file(path)
    out.no_truncation()
    out.no_padding()
    return out


class _Words(dict):
    """The ids of words, as bytes of little-endian int32; a word that is not there yet goes through the library's model. When half of the words
    that are remembered are here, they become the older half, from which words that are met again come back: only rare ones are forgotten."""

    def __init__(self, path: str):
        self.model, self.letters, self.older = _library(path).model, byte_letters(), {}

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            plain = word if word.isascii() and word.isprintable() else "".join(self.letters[b] for b in word.encode())
            out = np.array([t.id for t in self.model.tokenize(plain)], "<i4").tobytes()
        if len(word) > MEMO_LENGTH:
            return out
        if 2 * len(self) >= MEMO_WORDS:
            self.older = dict(self)
            self.clear()
        self[word] = out
        return out


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids, as bytes of little-endian int32. A worker remembers words from task to task."""
    library, words = _library(path), _Words(path)

    def tokenize(text: str) -> bytes:
        if "<|" in text or not text.isascii() and OUTSIDE.search(text):
            return np.array(library.encode(text, add_special_tokens=False).ids, "<i4").tobytes()
        return b"".join(map(words.__getitem__, WORD.findall(text.lower())))

    return tokenize


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of each size, by multiway differencing: sums come out near-equal."""
    n = len(sizes)
    if k == 1 or n == 0:
        return np.zeros(n, np.int64)
    # A partial partition: its sums that are not 0 in descending order, and the node that holds each sum's parts.
    heap = [(-int(s), i, np.array([s], np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    first, second, made, order = [], [], n, n
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over > 0:  # the smallest of one meet the largest of the other, all the way round
            b, nb = b[::-1], nb[::-1]
            left, met_a, met_b, right = a[: len(a) - over], a[len(a) - over :], b[:over], b[over:]
            nodes = np.arange(made, made + over)
            first.append(na[len(a) - over :])
            second.append(nb[:over])
            made += over
            sums, ids = np.concatenate([left, met_a + met_b, right]), np.concatenate([na[: len(a) - over], nodes, nb[over:]])
        else:
            sums, ids = np.concatenate([a, b]), np.concatenate([na, nb])
        down = np.argsort(-sums, kind="stable")
        sums, ids = sums[down], ids[down]
        heapq.heappush(heap, (-int(sums[0] - (sums[-1] if len(sums) == k else 0)), order, sums, ids))
        order += 1
    window = np.zeros(made, np.int64)
    window[heap[0][3]] = np.arange(len(heap[0][3]))
    at = made
    for x, y in zip(reversed(first), reversed(second), strict=True):
        at -= len(x)
        window[x] = window[y] = window[at : at + len(x)]
    return window[:n]


def windows_of(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, int]:
    """The window of each size and the number of windows; no window holds more than ``capacity``."""
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, weights=sizes, minlength=k).max(initial=0) <= capacity:
            return window, k
        k += 1


FIELDS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())])


def _packed(docs: list[tuple[int | None, bytes]], first: int, window: int, part: int) -> tuple[pa.RecordBatch, int]:
    """The pieces of a group of documents (id, ids as bytes); their windows are numbered from ``first`` on."""
    rows, parts, sequence = [], [], first
    for doc_id, ids in docs:
        n = len(ids) // 4
        whole = n - n % window
        for start in range(0, whole, window):
            rows.append((doc_id, start, window, ids[4 * start : 4 * (start + window)], n, sequence, 0))
            sequence += 1
        cuts = [*range(whole, n, part), n]  # full parts and a rest: rests of all sizes balance best
        parts += [(doc_id, a, b - a, ids[4 * a : 4 * b], n) for a, b in zip(cuts, cuts[1:], strict=False)]
    if parts:
        to, k = windows_of(np.array([p[2] for p in parts], np.int64), window)
        filled = [0] * k
        for p, w in zip(parts, to.tolist(), strict=True):
            rows.append((*p, sequence + w, filled[w]))
            filled[w] += p[2]
        sequence += k
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), FIELDS, strict=True)], schema=FIELDS), sequence


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, part: int = PART, group: int = GROUP) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids (bytes of little-endian 32-bit ids), doc_tokens, sequence_id,
    offset. ``sequence_id`` is the task's number in the upper bits and a count from 0 in the lower 33."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenize, end = tokenizer(path), np.int32(END).tobytes()
        sequence, held, size = TaskContext.get().partitionId() << 33, [], 0
        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                held.append((doc_id, tokenize(text.as_py() or "") + end))
                size += len(held[-1][1])
                if len(held) >= group or size >= 1 << 26:
                    out, sequence = _packed(held, sequence, window, part)
                    yield out
                    held, size = [], 0
        if held:
            yield _packed(held, sequence, window, part)[0]

    return docs.select(docs[id_col].cast("long"), text_col).mapInArrow(run, "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")

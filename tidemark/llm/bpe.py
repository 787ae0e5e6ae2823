"""Byte-level BPE through a lexicon transducer.

The most frequent words of the corpus are counted over all documents and compiled, with their token ids, into a minimal acyclic
automaton whose equal suffixes are shared. Its transitions carry numbers that add up to a word's place in the table of ids, so
it is a transducer from words to ids. Its arrays are one flat file that every worker memory-maps. Words that the lexicon does not
have are merged exactly by the library's model, lowest rank first.

Texts are cut into words as the vocabulary's own pre-tokenizer does. For texts with code points below 0x250 only, where
letters, digits and white space are fixed since long, a plain pattern does that; other texts go through the tokenizers library's
pre-tokenizer, so that both follow the same edition of Unicode.

Cases: null text is empty; an empty text has no tokens and decodes to an empty text; words of any length are merged whole; special tokens in a text become their ids, as the library does; repeated rows are encoded each; extra columns are kept, but
one that is called like a result is replaced by it.
"""

from __future__ import annotations

import json
import mmap
import os
import re
import tempfile
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.shared import discard, written

#: Words in the lexicon, and the longest word (bytes) that it takes: together the bound of what the driver gathers.
LEXICON_WORDS = 32_768
LONGEST_WORD = 48
#: Words that a worker remembers between batches.
MEMO_WORDS = 300_000
#: Distinct words that a task counts before it passes the counts on.
COUNT_WORDS = 150_000

#: The pattern of the byte-level pre-tokenizer for code points below 0x250: fixed values.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", r"\t-\r \x85\xa0"
WORD = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
OUTSIDE = re.compile("[^\x00-ɏ]")


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the vocabulary: those of Latin-1 that print for themselves, the
    others from code point 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in prints}
    out |= {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in out)}
    return out


class Vocabulary:
    """The tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.path = path
        letters = byte_letters()
        of_letter = {c: b for b, c in letters.items()}
        vocab = spec["model"]["vocab"]
        self.token = [b""] * (1 + max(max(vocab.values()), *(t["id"] for t in spec["added_tokens"])))
        for word, i in vocab.items():
            self.token[i] = bytes(of_letter[c] for c in word)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        for content, i in self.special.items():
            self.token[i] = content.encode()
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None


class Merges:
    """The ids of single words, merged exactly by the library's model (pairs of lowest rank first)."""

    def __init__(self, path: str):
        self.model, self.letters = _library(path).model, byte_letters()

    def __call__(self, word: bytes) -> list[int]:
        plain = word.decode("latin-1")
        if not (plain.isascii() and plain.isprintable() and " " not in plain):
            plain = "".join([self.letters[b] for b in word])
        return [t.id for t in self.model.tokenize(plain)]


def compile_lexicon(words: dict[bytes, list[int]]) -> bytes:
    """The transducer of ``words`` as one flat file.

    Words come in sorted order; as soon as a state gets no more transitions it is replaced by an equal one that exists
    already, so equal suffixes are shared and the automaton is minimal at every step.
    """
    register: dict[tuple, int] = {}
    states: list[tuple[bool, tuple[tuple[int, int], ...]]] = []

    def settle(final: bool, edges: list[tuple[int, int]]) -> int:
        key = (final, tuple(edges))
        if key not in register:
            register[key] = len(states)
            states.append(key)
        return register[key]

    path: list[list] = [[False, []]]  # of each open state: final, settled transitions
    ordered, last = sorted(words), b""
    for word in [*ordered, None]:
        same = len(os.path.commonprefix([last, word])) if word is not None else 0
        while len(path) > same + 1:
            state = settle(*path.pop())
            path[-1][1].append((last[len(path) - 1], state))
        if word is not None:
            path += [[False, []] for _ in word[same:]]
            path[-1][0], last = True, word
    root = settle(*path[0])
    below = np.zeros(len(states), np.int64)  # words from this state on; targets come before their sources
    key, target, skip = [], [], []
    for s, (final, edges) in enumerate(states):
        n = int(final)
        for label, to in edges:
            key.append(s * 256 + label)
            target.append(to)
            skip.append(n)  # the words that stand before those behind this transition
            n += below[to]
        below[s] = n
    ids = [words[w] for w in ordered]
    arrays = [np.array([root], "<i8"), np.array(key, "<i8"), np.array(target, "<i8"), np.array(skip, "<i8"), np.array([f for f, _ in states], "<i8"), np.cumsum([0, *map(len, ids)]).astype("<i8"), np.array([i for x in ids for i in x], "<i8")]
    return np.array([len(a) for a in arrays], "<i8").tobytes() + b"".join(a.tobytes() for a in arrays)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    PARTS = 7

    def __init__(self, data: bytes):
        # The file has no name any more once it is mapped, so nothing is left behind.
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            flat = np.frombuffer(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ), "<i8")
        ends = self.PARTS + np.cumsum(flat[: self.PARTS])
        root, self.key, self.target, self.skip, self.final, self.start, self.ids = np.split(flat[: ends[-1]], [self.PARTS, *ends[:-1]])[1:]
        self.root = int(root[0])

    def places(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon or -1; all words take their next step together."""
        state = np.full(len(words), self.root, np.int64)
        place = np.zeros(len(words), np.int64)
        if not len(self.key):
            return np.full(len(words), -1, np.int64)
        size = np.array(list(map(len, words)), np.int64)
        text = np.frombuffer(b"".join(words) + b"\0", np.uint8).astype(np.int64)
        at = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        live = np.flatnonzero((size > 0) & (size <= LONGEST_WORD))
        state[(size == 0) | (size > LONGEST_WORD)] = -1
        step = 0
        while len(live):
            want = state[live] * 256 + text[at[live] + step]
            k = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
            hit = self.key[k] == want
            state[live] = np.where(hit, self.target[k], -1)
            place[live] += np.where(hit, self.skip[k], 0)
            step += 1
            live = live[hit & (size[live] > step)]
        return np.where((state >= 0) & (self.final[np.maximum(state, 0)] == 1), place, -1)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=4)
def _memo(path: str) -> dict:
    """The ids of words as bytes, kept by a worker from task to task."""
    return {}


def splitter(path: str) -> Callable[[str], list]:
    """A function that cuts a text into words (str) and ids of special tokens (int)."""
    vocab = vocabulary(path)

    def words(text: str) -> list:
        if OUTSIDE.search(text):
            return [text[a:b] for _, (a, b) in _library(path).pre_tokenizer.pre_tokenize_str(text)]
        return WORD.findall(text)

    def cut(text: str) -> list:
        if vocab.split_special is None or not any(s in text for s in vocab.special):
            return words(text)
        out: list = []
        for piece in vocab.split_special.split(text):
            if piece in vocab.special:
                out.append(vocab.special[piece])
            elif piece:
                out += words(piece)
        return out

    return cut


def count_words(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """(word, n) over all texts; counts are added up within each task first."""
    fields = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, seen = splitter(path), Counter()
        for b in batches:
            for text in b.column(0):
                seen.update(cut(text.as_py() or ""))
                if len(seen) > COUNT_WORDS:
                    yield flush(seen)
                    seen = Counter()
        yield flush(seen)

    def flush(seen: Counter) -> pa.RecordBatch:
        rows = [(x, n) for w, n in seen.items() if isinstance(w, str) and len(x := w.encode()) <= LONGEST_WORD]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()), pa.array([n for _, n in rows], pa.int64())], schema=fields)

    return docs.select(text_col).mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, path: str, text_col: str = "text", words: int = LEXICON_WORDS) -> bytes:
    """The compiled lexicon of the most frequent words, ``words`` at most; the driver gathers no more than those."""
    counts = written(count_words(docs, path, text_col), "word-counts")
    # the least count that the lexicon takes, from a histogram of fixed size; sorting all words would bring them into one task
    steps = counts.groupBy(F.floor(F.log2("n") * 16).alias("step")).agg(F.count(F.lit(1)).alias("words"), F.min("n").alias("least")).orderBy(F.desc("step")).collect()
    held, least = 0, None
    for r in steps:
        held += r["words"]
        if held > words:
            break
        least = r["least"]
    if least is not None:
        top = counts.where(F.col("n") >= least).select("word").collect()
    elif steps:  # more words than that share the highest counts: some of them, by hash
        share = int((1 << 30) * words / steps[0]["words"])
        top = counts.where((F.col("n") >= steps[0]["least"]) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < share)).select("word").limit(words).collect()
    else:
        top = []
    discard(counts)
    merges = Merges(path)
    return compile_lexicon({bytes(r["word"]): merges(bytes(r["word"])) for r in top})


def encoder(path: str, lexicon: bytes) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """A function from texts to the offsets and the flat list of their ids."""
    lexi, cut, merges, memo = Lexicon(lexicon), splitter(path), Merges(path), _memo(path)
    special = {i: np.int32(i).tobytes() for i in vocabulary(path).special.values()}

    def encode(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(memo) > MEMO_WORDS:
            memo.clear()
        memo.update(special)
        rows = [cut(t) for t in texts]
        new = list(set().union(*rows).difference(memo))
        coded = [w.encode() for w in new]
        for w, x, place in zip(new, coded, lexi.places(coded).tolist() if new else [], strict=True):
            ids = lexi.ids[lexi.start[place] : lexi.start[place + 1]] if place >= 0 else merges(x)
            memo[w] = np.asarray(ids, "<i4").tobytes()
        parts = [b"".join(map(memo.__getitem__, r)) for r in rows]
        return np.cumsum([0, *(len(p) // 4 for p in parts)]), np.frombuffer(b"".join(parts), "<i4")

    return encode


def _append(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, values], names=[*batch.schema.names, name])


def slices(batch: pa.RecordBatch, text_col: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, one row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).cumsum()
    start = 0
    while start < batch.num_rows:
        done = size[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(size, done + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _encoded(path: str, held, text_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = encoder(path, held.value)
        for b in batches:
            for part in slices(b, text_col):
                offsets, ids = work([t or "" for t in part.column(text_col).to_pylist()])
                yield _append(part, "token_ids", pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32())))

    return run


def _decoded(path: str, ids_col: str, out_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(path).token
        for b in batches:
            lists = b.column(b.schema.get_field_index(ids_col))
            texts = (b"".join([token[i] for i in (x.values.to_numpy(zero_copy_only=False).tolist() if x.is_valid else ())]).decode("utf-8", "replace") for x in lists)
            yield _append(b, out_col, pa.array(texts, pa.string()))

    return run


def _fields(df: DataFrame, *more: str) -> str:
    return ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), *more])


def encode(docs: DataFrame, path: str, text_col: str = "text", lexicon: bytes | None = None) -> DataFrame:
    """``docs`` with their token ids in ``token_ids`` (array of int)."""
    lexicon = build_lexicon(docs, path, text_col) if lexicon is None else lexicon
    held = docs.sparkSession.sparkContext.broadcast(lexicon)  # of bounded size: LEXICON_WORDS * LONGEST_WORD and their ids
    docs = docs.drop("token_ids")
    return docs.mapInArrow(_encoded(path, held, text_col), _fields(docs, "token_ids array<int>"))


def decode(rows: DataFrame, path: str, ids_col: str = "token_ids", out_col: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids in ``out_col``; ``ids_col`` stays. Null ids give an empty text."""
    rows = rows.drop(out_col)
    return rows.mapInArrow(_decoded(path, ids_col, out_col), _fields(rows, f"`{out_col}` string"))


def round_trip(docs: DataFrame, path: str, text_col: str = "text", lexicon: bytes | None = None) -> DataFrame:
    """``docs`` without the text, with ``token_ids`` and ``decoded``: :func:`encode` and :func:`decode` in one worker, so that the
    ids cross to Python once."""
    lexicon = build_lexicon(docs, path, text_col) if lexicon is None else lexicon
    held = docs.sparkSession.sparkContext.broadcast(lexicon)
    docs = docs.drop("token_ids", "decoded")
    one, two = _encoded(path, held, text_col), _decoded(path, "token_ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in two(one(batches)):
            yield b.drop_columns([text_col])

    return docs.mapInArrow(run, _fields(docs.drop(text_col), "token_ids array<int>", "decoded string"))

"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from its code point). A letter n-gram is the product of its letters' vectors, each
rotated by its distance from the end; a text is the sum of its n-grams' vectors, and a language's prototype the sum over all texts
labelled with it. A text gets the language whose prototype has the largest cosine with it.

Learning is one pass over all labelled texts: tasks add up vectors by language, Spark sums them by language and dimension.
What the driver gathers is one vector for each language.

Cases: a text that is null or has no letter is ``und`` with score 0, as is any text where nothing was learned; rows without a
label are not learned from; languages tied in cosine go to the first in order; repeated rows are predicted each; extra columns are kept,
but one that is called like a result is replaced by it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import slices

DIMENSIONS, ORDER = 1024, 3
#: Characters that are turned into vectors at a time, about.
CHUNK_CHARS = 1 << 19
#: N-grams whose vectors are held at a time.
GRAMS = 2048


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.array([chr(c).isalpha() for c in range(sys.maxunicode + 1)])


@lru_cache(maxsize=1 << 15)
def _letter_vector(code: int, turn: int, dimensions: int) -> np.ndarray:
    draw = np.random.Generator(np.random.PCG64(code)).integers(0, 2, dimensions, dtype=np.int8) * 2 - 1
    return np.roll(draw.astype(np.int8), turn)


def _codes(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The code points of all texts in lower case, anything but letters as one blank, a blank at either end; their text's number. A single long
    text comes in parts, each of which begins with what the n-grams across the cut need."""
    if len(texts) == 1 and len(texts[0]) > CHUNK_CHARS:
        whole, rest = f" {texts[0].lower()} ", np.zeros(0, np.int64)
        for i in range(0, len(whole), CHUNK_CHARS):
            code = np.frombuffer(whole[i : i + CHUNK_CHARS].encode("utf-32-le", "surrogatepass"), "<u4")
            code = np.concatenate([rest, np.where(_letters()[code], code, 32)])
            code = code[np.append(True, (code[1:] != 32) | (code[:-1] != 32))]
            yield code, np.zeros(len(code), np.int64)
            rest = code[-(ORDER - 1) :]
        return
    parts = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), "<u4") for t in texts]
    code = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    owner = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
    code = np.where(_letters()[code], code, 32).astype(np.int64)
    blank = code == 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))
    yield code[keep], owner[keep]


def _grams(code: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct n-grams as code points (U, ORDER), and for each place that has one its number and its text's."""
    used, code = np.unique(code, return_inverse=True)
    n = max(0, len(code) - ORDER + 1)
    inside = owner[:n] == owner[len(owner) - n :]
    gram = np.zeros(n, np.int64)
    for i in range(ORDER):
        gram = gram * len(used) + code[i : i + n]
    gram, owner = gram[inside], owner[:n][inside]
    if len(used) ** ORDER <= 1 << 22:
        there = np.flatnonzero(np.bincount(gram, minlength=1))
        place = np.zeros(len(used) ** ORDER, np.int64)
        place[there] = np.arange(len(there))
        at = place[gram]
    else:
        there, at = np.unique(gram, return_inverse=True)
    letters = np.stack([used[there // len(used) ** (ORDER - 1 - i) % len(used)] for i in range(ORDER)], 1)
    return letters, at, owner


def _gram_vectors(letters: np.ndarray, dimensions: int) -> np.ndarray:
    out = np.ones((len(letters), dimensions), np.int8)
    for i in range(letters.shape[1]):
        used, at = np.unique(letters[:, i], return_inverse=True)
        out *= np.stack([_letter_vector(int(c), letters.shape[1] - 1 - i, dimensions) for c in used])[at]
    return out


def _bundled(texts: list[str], rows: np.ndarray, n_rows: int, dimensions: int, kind: type) -> np.ndarray:
    """(n_rows, dimensions): in each row the sum of the vectors of all n-grams of its texts (``rows`` gives each text's), some n-grams at a time."""
    out = np.zeros((n_rows, dimensions), kind)
    for code, owner in _codes(texts):
        letters, at, owner = _grams(code, owner)
        row = rows[owner]
        for i in range(0, len(letters), GRAMS):
            some = letters[i : i + GRAMS]
            here = (at >= i) & (at < i + GRAMS) if len(letters) > GRAMS else slice(None)
            counts = np.bincount(row[here] * len(some) + at[here] - i, minlength=n_rows * len(some)).reshape(n_rows, len(some))
            out += counts.astype(kind) @ _gram_vectors(some, dimensions).astype(kind)
    return out


def text_vectors(texts: list[str], dimensions: int = DIMENSIONS) -> np.ndarray:
    """A row for each text: the sum of the vectors of its n-grams."""
    return _bundled(texts, np.arange(len(texts)), len(texts), dimensions, np.float32)


def _chunks(texts: list[str], most: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most or i - start >= 255:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """The prototype of each language, from all rows with a label and a text."""
    fields = pa.schema([("lang", pa.string()), ("dimension", pa.int32()), ("value", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in (part for whole in batches for part in slices(whole, text_col, CHUNK_CHARS)):
            texts, langs = b.column(0).to_pylist(), np.array(b.column(1).to_pylist(), object)
            for i, j in _chunks(texts):
                names, row = np.unique(langs[i:j], return_inverse=True)
                for name, v in zip(names, _bundled(texts[i:j], row, len(names), dimensions, np.float64), strict=True):
                    sums[name] = sums.get(name, 0) + np.rint(v).astype(np.int64)
        for name, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dimensions), pa.array(np.arange(dimensions), pa.int32()), pa.array(v, pa.int64())], schema=fields)

    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, F.col(lang_col).cast("string"))
    summed = rows.mapInArrow(add, "lang string, dimension int, value long").groupBy("lang", "dimension").agg(F.sum("value").cast("double").alias("value"))
    out: dict[str, np.ndarray] = {}
    for r in summed.collect():
        out.setdefault(r["lang"], np.zeros(dimensions))[r["dimension"]] = r["value"]
    return {name: out[name] for name in sorted(out)}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score (the cosine, 0 where it is negative)."""
    names = list(prototypes)
    dimensions = len(prototypes[names[0]]) if names else DIMENSIONS
    table = np.stack([v / max(np.linalg.norm(v), 1e-9) for v in prototypes.values()]) if names else np.zeros((0, dimensions))
    held = docs.sparkSession.sparkContext.broadcast(table.astype(np.float32))  # one vector for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for whole in batches for part in slices(whole, text_col, CHUNK_CHARS)):
            texts = [t or "" for t in b.column(text_col).to_pylist()]
            lang, score = [], []
            for i, j in _chunks(texts):
                vectors = text_vectors(texts[i:j], dimensions)
                size = np.linalg.norm(vectors, axis=1)
                cosine = vectors @ held.value.T / np.maximum(size, 1e-9)[:, None] if names else np.zeros((j - i, 1))
                best = cosine.argmax(1)
                # a text without letters has blanks alone, which is no n-gram of this order
                known = [names and any(map(str.isalpha, t)) for t in texts[i:j]]
                lang += [names[k] if ok else "und" for k, ok in zip(best, known, strict=True)]
                score += [min(1.0, max(0.0, float(cosine[r, k]))) if ok else 0.0 for r, (k, ok) in enumerate(zip(best, known, strict=True))]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, "lang_pred", "score"])

    docs = docs.drop("lang_pred", "score")
    fields = ", ".join(f"`{n}` {t}" for n, t in docs.dtypes)
    return docs.mapInArrow(run, f"{fields}, lang_pred string, score double")


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 1 by 3. A null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3 == 1

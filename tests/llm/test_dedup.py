import random
from collections import Counter

import numpy as np
import pytest
from brute import WORD, components, exact, repeats, sha, shingles, spans

from tidemark.llm import exact_dedup, ngram_join, suffix_dedup

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def corpus(seed, n=80):
    """Texts with copies, near copies and shared passages; empty, null and short ones, and a hot group."""
    rng = random.Random(seed)
    text = lambda k: " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(k))
    passage, out = text(60), [None, "", " \t\n", "one", "one two", "ONE two", "é" * 500, "a" * 900, "ab" * 450]
    base = [text(rng.randrange(5, 120)) for _ in range(n)]
    out += base
    out += [base[0]] * 25 + [base[1] + "  "] * 3
    for b in base[:20]:
        w = b.split(" ")
        w[rng.randrange(len(w))] = "changed"
        out += [" ".join(w), b + " " + text(2), b + " " + passage, passage + " " + text(30)]
    w = base[2].split(" ") * 3
    for _ in range(30):
        v = w[:]
        v[rng.randrange(len(v))] = text(1)
        out.append(" ".join(v))
    rng.shuffle(out)
    return list(enumerate(out))


def test_quotient_filters_merge_losslessly():
    rng = np.random.default_rng(1)
    for bits in (64, 60, 46):
        parts = [np.unique(rng.integers(0, 1 << bits, 500, dtype=np.uint64) & np.uint64((1 << bits) - 1)) for _ in range(3)]
        parts.append(parts[0][:300])
        counts = [rng.integers(1, 400, len(p)) for p in parts]
        merged = exact_dedup.merge_filters([exact_dedup.pack_filter(p, c, bits) for p, c in zip(parts, counts)], bits)
        values, n = exact_dedup.unpack_filter(merged, bits)
        want = {}
        for p, c in zip(parts, counts):
            for v, k in zip(p.tolist(), c.tolist()):
                want[v] = want.get(v, 0) + k
        assert dict(zip(values.tolist(), n.tolist())) == want and values.tolist() == sorted(want)


def test_exact_duplicates(make):
    rows = corpus(1)
    assert sorted(map(tuple, exact_dedup.exact_duplicates(make(rows)).collect())) == exact(rows)


def test_exact_duplicates_of_odd_rows(make):
    rows = [(1, "a b"), (1, "a b"), (None, "ab"), (2, None), (3, ""), (None, None)]
    out = exact_dedup.exact_duplicates(make(rows)).collect()
    assert len(out) == 6 and sum(r["kept"] for r in out) == 2
    assert {r["keep_id"] for r in out if r["text_sha256"] == sha(b"ab")} == {1} and {r["group_size"] for r in out} == {3}
    left = exact_dedup.drop_exact_duplicates(make(rows))
    assert left.columns == make(rows).columns and sorted(r["doc_id"] for r in left.collect()) == [1, 2]


@pytest.mark.parametrize(("words", "num"), [(3, 90), (5, 80), (2, 70)])
def test_similar_documents(make, words, num):
    rows = corpus(words)
    got = sorted(map(tuple, ngram_join.similar_documents(make(rows), words=words, num=num).collect()))
    assert got == components(rows, words, num, 100)


def test_hot_lists_are_walked_in_parts(make, monkeypatch):
    monkeypatch.setattr(ngram_join, "PART", 2)
    rows = corpus(4, 25)
    assert sorted(map(tuple, ngram_join.similar_documents(make(rows)).collect())) == components(rows, 5, 80, 100)


def test_every_link_between_classes(make):
    rows = corpus(6, 50)
    sets = {i: shingles(t, 5) for i, t in rows}
    name = {}
    for i, s in sorted(sets.items()):
        name.setdefault(s, i)
    classes = sorted((i, s) for s, i in name.items() if s)
    want = {(a, b) for a, x in classes for b, y in classes if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    member, pairs = ngram_join.similar_classes(make(rows))
    assert dict(map(tuple, member.collect())) == {i: name[s] if s else None for i, s in sets.items()}
    got = [tuple(r) for r in pairs.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 20
    member, pairs = ngram_join.similar_classes(make([(1, None)]))
    assert member.count() == 1 and pairs.count() == 0


def test_similar_of_odd_rows(make):
    t = " ".join(WORDS)
    rows = [(4, t), (4, t), (None, t), (9, t + " more"), (5, None), (6, ""), (7, "x" * 300_000)]
    got = {(r["doc_id"], r["component_id"]) for r in ngram_join.similar_documents(make(rows)).collect()}
    assert got == {(4, 4), (None, 4), (9, 4), (5, 5), (6, 6), (7, 7)}
    left = ngram_join.drop_similar(make(rows))
    assert left.columns == make(rows).columns and sorted(r["doc_id"] for r in left.collect()) == [4, 5, 6, 7]


def test_connected_components(spark):
    rng = random.Random(3)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["label"] for r in ngram_join.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for e in edges if e[0] != e[1] for x in e}


def lpf(data):
    return [max((next((k for k in range(len(data) - i) if data[i + k] != data[j + k]), len(data) - i) for j in range(i)), default=0) for i in range(len(data))]


def test_longest_previous_factors():
    rng = random.Random(5)
    data = bytes(rng.choice(b"ab") for _ in range(300)) + b"abba" * 20
    length = 16
    places = np.arange(len(data) - length + 1)
    got, source = suffix_dedup.longest_previous(np.frombuffer(data, np.uint8), places, np.zeros(len(places), int), length)
    assert got.tolist() == [min(length, x) for x in lpf(data)[: len(places)]]
    for i in places:
        if any(data[i : i + length] == data[j : j + length] for j in places[i + 1 :]) and not any(data[i : i + length] == data[j : j + length] for j in places[:i]):
            assert source[i]


@pytest.mark.parametrize(("unit", "length"), [("bytes", 400), ("bytes", 30), ("words", 50), ("words", 7)])
def test_whole_matches_come_from_neighbours(unit, length, monkeypatch):
    """What is asked of contexts is only whether all of a window matches: that takes the sorting of strings of a ninth of it, and no comparison."""
    rng = np.random.default_rng(3)
    symbol = suffix_dedup.SYMBOL[unit]
    rows, ck = [], 0
    for group in range(6):
        base = rng.integers(0, 3, 3 * length).astype(symbol)
        for k in range(5):
            own = base.copy()
            own[rng.integers(0, len(own), k)] = 9
            cut = int(rng.integers(0, length))
            rows.append((group, ck, 2 * length - cut + 1, own[cut:].tobytes()))
            ck += 1
    windows = {}
    for group, ck, n, ctx in rows:
        for w in range(n):
            windows.setdefault((group, ctx[w * symbol.itemsize : (w + length) * symbol.itemsize]), []).append((ck, w))
    sorted_sizes = []
    ranks = suffix_dedup.suffix_ranks

    def noted(raw, most):
        out = ranks(raw, most)
        sorted_sizes.append([size for size, _ in out])
        return out

    monkeypatch.setattr(suffix_dedup, "suffix_ranks", noted)
    for keep in ("first", "none"):
        covered = {place for places in windows.values() for place in (places[1:] if keep == "first" else places if len(places) > 1 else [])}
        got = suffix_dedup._sorted_contexts(rows, length, keep, symbol)
        assert {(ck, w) for ck, a, b in got for w in range(a, b)} == covered
        assert len({(ck, a) for ck, a, _ in got} & {(ck, b) for ck, _, b in got}) == 0  # runs are maximal
    assert all(len(sizes) == 1 or sizes[-1] * 3 <= length for sizes in sorted_sizes) and len(sorted_sizes) == 2


@pytest.mark.parametrize("bucket", [1024, 2])
def test_repeated_bytes(make, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)  # small buckets are split into blocks
    rows = corpus(11) + [(5000 + i, "é" * i + "shared passage of some length " * 15 + str(i)) for i in range(12)]
    data, masks = repeats(rows, 400)
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.report(make(rows)).collect()}
    want = {i: (len(b), sum(masks[i]), len(spans(masks[i])), sha(bytes(x for x, m in zip(b, masks[i]) if not m))) for i, b in data.items()}
    assert got == want


@pytest.mark.parametrize("bucket", [1024, 2])
def test_first_copies_stay(make, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = [(i, t) for i, t in corpus(12, 30)]
    length, seen, want = 400, set(), {}
    for i, t in rows:
        b = (t or "").encode()
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                mask[p : p + length] = b"\1" * length
            seen.add(b[p : p + length])
        want[i] = spans(mask)
    got = {r["_id"]: [tuple(s) for s in r["spans"]] for r in suffix_dedup.repeated_spans(make(rows)).collect()}
    assert got == want


@pytest.mark.parametrize("bucket", [1024, 2])
def test_repeated_words(make, monkeypatch, bucket):
    monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
    rows = [(i, t) for i, t in corpus(13, 30)] + [(900 + i, ("un de la ou " * 13 + " \n").strip() + f" {i}" * i) for i in range(5)]
    words = {i: WORD.findall(t or "") for i, t in rows}
    seen = Counter(tuple(w[p : p + 50]) for w in words.values() for p in range(len(w) - 49))
    want = {}
    for i, w in words.items():
        mask = bytearray(len(w))
        for p in range(len(w) - 49):
            if seen[tuple(w[p : p + 50])] > 1:
                mask[p : p + 50] = b"\1" * 50
        want[i] = spans(mask)
    got = {r["_id"]: [tuple(s) for s in r["spans"]] for r in suffix_dedup.repeated_spans(make(rows), 50, "none", unit="words").collect()}
    assert got == want
    if bucket > 2:
        counted = {r["doc_id"]: r["n_passages"] for r in suffix_dedup.report(make(rows)).collect()}
        assert counted == {i: len(s) for i, s in want.items()}


def test_ids_of_text(make):
    p = "a passage that is long enough to be found again " * 12
    rows = [("b", "x" + p), ("a", "one two " + p), (None, p + "z"), ("c", p)]
    docs = make(rows, "doc_id string, text string")
    first = {r["_id"]: len(r["spans"]) for r in suffix_dedup.repeated_spans(docs).collect()}
    assert first["a"] <= 1 and first["b"] == first["c"] == first[None] == 1
    removed = {r["doc_id"]: r["n_removed"] > 0 for r in suffix_dedup.report(docs).collect()}
    assert all(removed.values())


def test_texts_over_a_slice(make, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SLICE", 1000)
    rng = random.Random(8)
    long = " ".join(rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(900))
    rows = [(1, long), (2, long[700:3300]), (3, "x" * 2500), (4, long[:990] + "!" + long[3000:])]
    data, masks = repeats(rows, 400)
    got = {r["doc_id"]: r["n_removed"] for r in suffix_dedup.report(make(rows)).collect()}
    assert got == {i: sum(m) for i, m in masks.items()}


def test_empty_tables(make):
    empty = make([])
    assert exact_dedup.exact_duplicates(empty).count() == 0
    assert ngram_join.similar_documents(empty).count() == 0
    assert suffix_dedup.report(empty).count() == 0

"""The source audit, importance resampling and byte-level BPE on matrices against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import LOWER, sha

from tidemark.llm import byte_bpe, queries, resample, source_audit

TERM, WORD = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"), re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_audit(rows, least, top):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source, terms = lang or "", source or "", TERM.findall((text or "").translate(LOWER))
        groups[lang].add(source)
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        whole = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        share = lambda n, of: 1 + 1000000000 * (n + 5) // (of + 5 * len(kept))  # noqa: B023, E731
        p = {s: {t: share(counts[lang, s][t], whole[s]) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(whole.values())) for t in kept}
        for s in sources:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                for rank, (v, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most], 1):
                    out.append((lang, s, part, item, v, rank))
    return sorted(out)


def audit_rows(seed=1):
    rng = random.Random(seed)
    words = ["a", "A", "ab", "abc", "abd", "b", "zeta", "é", "éa", "日本", "日", "x" * 70, "ÀB", "tie", "tied"]
    rows = [(i, " ".join(rng.choice(words) + rng.choice(["", ",", "1", "-"]) for _ in range(rng.randrange(12))), rng.choice(["en", "fr", None, ""]), rng.choice(["s1", "s2", "s3", None, "ü"])) for i in range(150)]
    rows += [(200, None, "en", "silent"), (201, "", "xx", "alone"), (202, "rare", "xx", "other"), (203, "word " * 30_000, "en", "s1"), (1, rows[1][1], "en", "s1"), (1, rows[1][1], "en", "s1")]
    return rows + [(300 + i, "even odd", "tt", f"t{i % 2}") for i in range(8)]


@pytest.mark.parametrize("least,top,small", [(1, 3, False), (4, 50, True)])
def test_audit(spark, make, monkeypatch, least, top, small):
    if small:  # cells of pairs, blocks of terms and counts that leave early
        for name, n in (("CELL", 2), ("SHARES", 4), ("CELLS", 1), ("COUNTERS", 7), ("PREFIX", 1), ("PIECE_COUNTERS", 2), ("MERGED", 3)):
            monkeypatch.setattr(source_audit, name, n)
    rows = audit_rows()
    docs = make(rows, "doc_id long, text string, lang string, source string").withColumnRenamed("n", "value").withColumnRenamed("h", "terms")
    got = sorted(tuple(r) for r in source_audit.audit(docs, least=least, top=top).collect())
    assert got == plain_audit(rows, least, top)
    assert source_audit.audit(docs.limit(0)).count() == 0


def test_shares_are_exact_where_products_leave_64_bits():
    counts, whole = np.array([0, 7, 10**15, 123456789012345678]), np.array([11, 10**15 + 3, 3 * 10**15, 9 * 10**17 // 7])
    assert source_audit.shares(counts, whole % (9 * 10**15)).tolist() == [1 + 10**9 * (int(c) + 5) // int(w) for c, w in zip(counts, whole % (9 * 10**15))]


def test_tries_share_prefixes_and_merge_in_order():
    rng = random.Random(4)
    words = [w.encode() for w in ("team", "tea", "te", "toast", "été", "teams", "a", "日本", "日", "x" * 90, "x" * 90 + "y", "x" * 95)]
    parts, want, docs = [], defaultdict(Counter), Counter()
    for _ in range(5):
        documents, counts = Counter(rng.choices(words, k=9)), defaultdict(Counter)
        for w in documents:
            for s in rng.sample("stu", rng.randrange(1, 4)):
                counts[s][w] += rng.randrange(1, 9)
                want[w][s] += counts[s][w]
        docs.update(documents)
        trie = source_audit.Trie.of(documents, counts)
        assert trie.terms == sorted(documents)
        piece = source_audit._pieces("en", trie)
        assert source_audit._trie_of(piece).terms == trie.terms  # cut by prefix and read back
        parts.append(source_audit._trie_of(piece))
    trie = source_audit.Trie.merge(parts)
    assert trie.terms == sorted(want) and trie.documents.tolist() == [docs[w] for w in trie.terms]
    ends = np.cumsum(trie.sizes).tolist()
    for w, a, b in zip(trie.terms, [0, *ends], ends):
        assert dict(zip(trie.sources[a:b].to_pylist(), trie.counts[a:b].tolist())) == want[w]
    depths = source_audit.Trie.of(Counter(words), {"s": Counter(words)}).depths().tolist()
    ordered = sorted(words)
    assert depths == [0, *(len(os.path.commonprefix([a, b])) for a, b in zip(ordered, ordered[1:]))]


@pytest.mark.parametrize("longest", [1, 2, 4])
def test_crcs_of_runs_are_those_of_their_strings(longest):
    rng = random.Random(longest)
    texts = ["".join(rng.choice("abZ9é日 ,\n") for _ in range(rng.randrange(90))) for _ in range(60)] + ["", "w" * 70_000 + " b " + "c" * 300]
    size, at, bucket = resample.features([t.encode() for t in texts], longest, 9973)
    for i, t in enumerate(texts):
        w = WORD.findall(t.translate(LOWER))
        want = [zlib.crc32(" ".join(w[j : j + n]).encode()) % 9973 for n in range(1, longest + 1) for j in range(len(w) - n + 1)]
        assert size[i] == len(w) and bucket[at[i] : at[i + 1]].tolist() == want


def plain_resample(rows, target, longest, buckets, percent):
    def found(text):
        w = WORD.findall((text or "").translate(LOWER))
        return len(w), [zlib.crc32(" ".join(w[j : j + n]).encode()) % buckets for n in range(1, longest + 1) for j in range(len(w) - n + 1)]

    own, s, t = [(i, *found(x)) for i, x in rows], Counter(), Counter()
    for _, _, f in own:
        s.update(f)
    for x in target:
        t.update(found(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in own:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n >= 20])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], -1 if r[0] is None else r[0], r[1], r[2]))
    ranks = {id(r): k for k, r in enumerate(able[: percent * len(able) // 100], 1)}
    return sorted(((*r[:4], ranks.get(id(r))) for r in out), key=repr)


@pytest.mark.parametrize("longest,percent", [(1, 10), (3, 60)])
def test_resample(spark, make, longest, percent):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "日本"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(60)))) for i in range(120)] + [(500, None), (501, ""), (None, "lost id " * 9), (502, "long " * 40_000)] + [(7, "same words " * 15)] * 3
    target = [None, "", "w1 w2 w3", "W59 É 日本 w1"]
    bench = spark.createDataFrame(list(enumerate(target)), "item_id long, text string")
    got = resample.resample(make(rows), bench, longest=longest, buckets=101, percent=percent).collect()
    assert sorted(map(tuple, got), key=repr) == plain_resample(rows, target, longest, 101, percent)
    assert resample.resample(make(rows).limit(0), bench).count() == 0
    assert {r["weight"] for r in resample.resample(make(rows[:3]), bench.limit(0)).collect()} != {None}


def bpe_texts():
    rng = random.Random(3)
    texts = [None, "", " ", "Hello world's   \n\n x", "日本語テキスト" * 50, "x" * 5000, "ab" * 3000, "=-" * 400, "<|endoftext|> as text", "\x85  y", "ÀÉ straße ½ ²³", "\U0001f468‍\U0001f469 ok"]
    texts += ["".join(rng.choice("abcdefghij") for _ in range(20_000)), "".join(rng.choice("ab") for _ in range(3000)), "".join(rng.choice("éèà") for _ in range(700)), "tab\tand  spaces   " * 3]
    texts += ["౜՘ \U0001246f9 ՘a꟎b"]  # characters that editions of Unicode file apart
    return texts + ["".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(128, 0x3000), rng.randrange(0x3000, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(rng.randrange(60))) for _ in range(200)] + ["the same text"] * 3


def test_byte_bpe_is_what_the_library_does(spark, make):
    import public_tokenizers as public
    import tiktoken

    path = queries.vocabulary_path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.ranks_of(path).rank, special_tokens={})
    texts = bpe_texts()
    docs = make(list(enumerate(texts))).withColumnRenamed("n", "ids")
    rows = byte_bpe.decode(byte_bpe.encode(docs, path, public.PATTERN), path).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        assert r["token_ids"] == library.encode_ordinary(text) and bytes(r["decoded"]) == text.encode()
    for r in byte_bpe.round_trip(docs, path, public.PATTERN).collect():
        want = np.array(library.encode_ordinary(texts[r["doc_id"]] or ""), "<u4").tobytes()
        assert bytes(r["ids"]) == want and sha(bytes(r["decoded"])) == sha((texts[r["doc_id"]] or "").encode())
    assert byte_bpe.round_trip(docs.limit(0), path, public.PATTERN).count() == 0


def test_matrices_merge_as_one_pair_after_the_other():
    """Also for ranks where a merge forms a pair of lower rank than its own."""
    rng = random.Random(8)
    ranks = byte_bpe.Ranks.__new__(byte_bpe.Ranks)
    tokens = [bytes([b]) for b in range(256)] + list({bytes(rng.choice(b"abc") for _ in range(rng.randrange(2, 6))) for _ in range(150)})
    rng.shuffle(tokens)
    ranks.rank = {t: i for i, t in enumerate(tokens)}
    ranks.byte = np.array([ranks.rank[bytes([b])] for b in range(256)], np.int32)
    pairs = [(ranks.rank[t[:k]], ranks.rank[t[k:]], i) for t, i in ranks.rank.items() for k in range(1, len(t)) if t[:k] in ranks.rank and t[k:] in ranks.rank]
    ranks._fill(np.array([a << 32 | b for a, b, _ in pairs]), np.array([i for _, _, i in pairs], np.int32))

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            found = [(ranks.rank[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks.rank]
            if not found:
                return [ranks.rank[p] for p in parts]
            i = min(found)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    words = [bytes(rng.choice(b"abcd") for _ in range(n)) for n in [1, 2, 3, 5, 8, 13, 40, 90, 300] * 5 + [600, 1100, 1500]] + [b"a" * 700, b"ab" * 400]
    assert [x.tolist() for x in ranks.merge(words)] == [plain(w) for w in words]

"""Plain versions of the operators for small inputs."""

import hashlib
import re
from collections import Counter, defaultdict

SPACE = re.compile(r"[\x20\x09-\x0D]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def exact(rows):
    """From (id, text): the rows (id, keep_id, size, kept, sha), sorted; ids are distinct."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i))
    return sorted((i, min(g)[1], len(g), i == min(g)[1], sha(n.encode())) for n, g in groups.items() for _, i in g)


def shingles(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def components(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            where[x].add(i)
    for i, s in sets.items():
        shared = Counter()
        for x in s:
            shared.update(where[x])
        for j, n in shared.items():
            if j != i and den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i)) for i in sets)


def repeats(rows, length):
    """From (id, text): the bytes of each text that a repeated string covers, as a mask."""
    data = {i: (t or "").encode() for i, t in rows}
    seen = Counter(b[p : p + length] for b in data.values() for p in range(len(b) - length + 1))
    out = {}
    for i, b in data.items():
        mask = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        out[i] = mask
    return data, out


def spans(mask):
    out, start = [], None
    for i, m in enumerate([*mask, 0]):
        if m and start is None:
            start = i
        if not m and start is not None:
            out.append((start, i))
            start = None
    return out


def secrets(text):
    base = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in base.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[k], a, b) for a, k, b in sorted(found)]

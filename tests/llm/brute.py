"""Plain-Python versions of the operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    w = WORD.findall((text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def jaccard_components(rows, n=3, num=90, den=100):
    """{index: (n_shingles, component id)} for ``rows`` of (doc_id, text)."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    index = defaultdict(list)
    for i, s in enumerate(sets):
        near = {j for x in s for j in index[x]}
        for j in near:
            both = len(s & sets[j])
            if den * both >= num * (len(s) + len(sets[j]) - both):
                root[find(i)] = find(j)
        for x in s:
            index[x].append(i)
    least = {}
    for i in range(len(rows)):
        if rows[i][0] is not None:
            r = find(i)
            least[r] = min(least.get(r, rows[i][0]), rows[i][0])
    return [(rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows))]


ASSIGN = re.compile(r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd])|(?:[Pp][Aa][Ss][Ss][Ww][Dd])|(?:[Ss][Ee][Cc][Rr][Ee][Tt])|(?:[Tt][Oo][Kk][Ee][Nn])|(?:[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def secrets(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    out.sort()
    names = ("assign", "access", "hex")
    spans = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in out)
    return (*[sum(k == i for _, k, _ in out) for i in range(3)], hashlib.sha256(spans.encode()).hexdigest(), spans)


def suffix_dedup(texts, length):
    """(n_bytes, n_removed, n_spans, kept SHA-256) of every text."""
    data = [(t or "").encode() for t in texts]
    seen = defaultdict(int)
    for t in data:
        for i in range(len(t) - length + 1):
            seen[t[i:i + length]] += 1
    out = []
    for t in data:
        cover = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cover[i:i + length] = b"\x01" * length
        kept = bytes(x for x, c in zip(t, cover) if not c)
        runs = sum(1 for i, c in enumerate(cover) if c and (i == 0 or not cover[i - 1]))
        out.append((len(t), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out

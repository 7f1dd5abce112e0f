"""Plain Python versions of the query contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

BLANK = " \t\n\x0b\x0c\r"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def lower(text):
    return text.translate(A_TO_Z)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data):
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def op1(docs, min_chars=20, min_docs=3):
    holders = defaultdict(list)
    split = [(i, (t or "").split("\n")) for i, t in docs]
    key = lambda line: lower(line.strip(BLANK))
    for i, lines in split:
        for k in {key(x) for x in lines if len(key(x)) >= min_chars}:
            holders[k].append(i)
    out = []
    for i, lines in split:
        gone = [
            len(key(x)) >= min_chars
            and len(set(holders[key(x)])) >= min_docs
            and i != max((h for h in holders[key(x)] if h is not None), default=None)
            for x in lines
        ]
        out.append((i, len(lines), sum(gone), sha("\n".join(x for x, g in zip(lines, gone) if not g))))
    return out


def op3(docs, width=3, percent=85):
    sets = []
    for i, t in docs:
        w = words(lower(t or ""))
        shingles = {tuple(w[n : n + width]) for n in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} - {()}
        sets.append((i, shingles))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                ra, rb = root(a), root(b)
                if ra != rb:
                    if sets[ra][0] < sets[rb][0]:
                        ra, rb = rb, ra
                    parent[ra] = rb
    return [(i, len(s), sets[root(n)][0], sets[root(n)][0] == i) for n, (i, s) in enumerate(sets)]


def op4(docs, width=50):
    first = {}
    data = [(i, (t or "").encode()) for i, t in docs]
    for i, b in data:
        for n in range(len(b) - width + 1):
            w = b[n : n + width]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, b in data:
        hit = bytearray(len(b))
        for n in range(len(b) - width + 1):
            if first[b[n : n + width]] < i:
                hit[n : n + width] = b"\x01" * width
        spans = len(re.findall(rb"\x01+", bytes(hit)))
        out.append((i, len(b), sum(hit), spans, sha(bytes(x for x, h in zip(b, hit) if not h))))
    return out


def op6(docs, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    grams = defaultdict(set)
    for item, t in items:
        w = split(t)
        size = min(window, len(w))
        for n in range(len(w) - size + 1 if w else 0):
            grams[tuple(w[n : n + size])].add("" if item is None else str(item))
    sizes = {len(g) for g in grams}
    out = []
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for size in sizes:
            for n in range(len(w) - size + 1):
                if (g := tuple(w[n : n + size])) in grams:
                    hit.update(range(n, n + size))
                    found |= grams[g]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def op7_base(docs):
    out = []
    for i, t in docs:
        t = t or ""
        w = words(t)
        grams = [tuple(w[n : n + 8]) for n in range(len(w) - 7)]
        count, hit = Counter(grams), set()
        for n, g in enumerate(grams):
            if count[g] > 1:
                hit.update(range(n, n + 8))
        lines = [x for x in t.split("\n") if words(x)]
        n_words = len(w)
        failed = n_words < 20 or 100 * len(hit) > 30 * n_words
        symbols = len(re.findall(r"[#*$%&|<>]", t))
        out.append((i, n_words, sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(hit), failed))
    return out


def op10_sizes(docs):
    return [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs]

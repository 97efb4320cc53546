"""Plain versions of the contracts, one document or pair at a time."""

import hashlib
import re
import zlib
from collections import Counter

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def quality(docs):
    out = []
    for i, text in docs:
        text = text or ""
        w = SPACE.findall(text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if SPACE.search(line):
                dup += line in seen
                seen.add(line)
        count = Counter(zip(w, w[1:], w[2:]))
        repeated = set()
        for k in range(len(w) - 2):
            if count[tuple(w[k:k + 3])] > 1:
                repeated |= {k, k + 1, k + 2}
        n = len(w)
        out.append((i, n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated),
                    n < 50 or 100 * len(repeated) > 50 * n))
    return out


def windows(w):
    n = min(13, len(w))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set()


def contaminated(docs, items):
    of = {}
    for i, text in items:
        for x in windows(ALNUM.findall(low(text))):
            of.setdefault(x, set()).add(None if i is None else str(i))
    lengths = sorted({len(x) for x in of})
    out = []
    for i, text in docs:
        w = ALNUM.findall(low(text))
        hit, found = set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                got = of.get(tuple(w[k:k + n]))
                if got:
                    hit |= set(range(k, k + n))
                    found |= got
        found = sorted(found - {None})
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def shingles(text, n=3):
    w = SPACE.findall(low(text))
    return {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} - {()}


def components(docs, n=3, percent=90):
    rows = [(i, shingles(t, n)) for i, t in docs]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = {}
    for k, (_, s) in enumerate(rows):
        for x in s:
            by.setdefault(x, []).append(k)
    common = Counter()
    for ks in by.values():
        for a in range(len(ks)):
            for b in range(a):
                common[ks[b], ks[a]] += 1
    for (a, b), both in common.items():
        if 100 * both >= percent * (len(rows[a][1]) + len(rows[b][1]) - both):
            parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = min(least.get(r, i), i)
    return [(i, len(s), least[find(k)]) for k, (i, s) in enumerate(rows)]


def repeated_windows(docs, size=50):
    first = {}
    split = [(i, SPACE.findall(t or "")) for i, t in docs]
    for i, w in split:
        for k in range(len(w) - size + 1):
            x = tuple(w[k:k + size])
            first[x] = min(first.get(x, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k:k + size])] < i:
                gone |= set(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def licenses(docs):
    out = []
    for i, text in docs:
        w = ALNUM.findall(low(text))
        at = sorted((k, label) for p, label in PHRASES.items() for k in range(len(w) - len(p) + 1) if tuple(w[k:k + len(p)]) == p)
        out.append((i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
    return out


def repeated_lines(docs, run=2):
    """Kept lines by document: a line goes if a window of ``run`` lines that
    covers it also starts earlier, by (document, line)."""
    seen, out = set(), []
    for i, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        lines = (text or "").split("\n")
        gone = set()
        for k in range(len(lines) - run + 1):
            x = tuple(lines[k:k + run])
            if x in seen:
                gone |= set(range(k, k + run))
            seen.add(x)
        out.append((i, len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


def crc_ids(ids):
    return zlib.crc32(b"".join(x.to_bytes(4, "little") for x in ids))

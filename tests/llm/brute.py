"""Brute-force versions of the operators, in plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, k):
    words = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    if len(words) < k:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def near_duplicates(docs, k, percent):
    """Component of each id of (id, text) pairs."""
    sets = {i: shingles(t, k) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    links = []
    for i, s in sets.items():
        common = Counter(j for x in s for j in where[x] if j < i)
        links += [(i, j) for j, n in common.items() if 100 * n >= percent * (len(s) + len(sets[j]) - n)]
    return roots(sets, links), {i: len(s) for i, s in sets.items()}


def contamination(docs, items, window=13, share=20):
    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    windows = defaultdict(set)
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if n else ():
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for at in range(len(w) - n + 1):
                own = windows.get(tuple(w[at : at + n]))
                if own:
                    found |= own
                    hit |= set(range(at, at + n))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out[i] = (len(w), len(hit), len(found), digest, bool(hit) and share * len(hit) >= len(w))
    return out


def base_findings(text):
    """(start, end, kind) in order, by patterns written out for both cases."""
    text = text or ""
    either = lambda word: "".join(f"[{c}{c.upper()}]" for c in word)
    names = "|".join([*map(either, ["password", "passwd", "secret", "token"]), f"{either('api')}_?{either('key')}"])
    assign = re.compile(rf"""({names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    spans = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(a, b, k) for a, _, b, k in sorted(spans)]


def repeated(docs, length=50):
    """Per id: number of bytes, spans removed and what is kept, of (id, text) pairs."""
    first = {}
    for i, text in docs:
        raw = (text or "").encode()
        for at in range(len(raw) - length + 1):
            s = raw[at : at + length]
            first[s] = min(first.get(s, i), i)
    out = {}
    for i, text in docs:
        raw = (text or "").encode()
        gone = [False] * (len(raw) + 1)
        for at in range(len(raw) - length + 1):
            if first[raw[at : at + length]] < i:
                gone[at : at + length] = [True] * length
        spans = [at for at in range(len(raw)) if gone[at] and (at == 0 or not gone[at - 1])]
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[i] = (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
    return out

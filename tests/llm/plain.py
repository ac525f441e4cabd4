"""Plain Python versions of the operators, to compare results with."""

import hashlib
import re
from collections import defaultdict

import numpy as np

SPACE = " \t\n\x0b\x0c\r"
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.I | re.A)


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return (text or "").encode().split()


def base_secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text)
              if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def top(rows, k=10, every=100):
    """rows: (vec_id, vector) -> {(query_id, rank): (vec_id, score)}"""
    ok = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = {}
    for q, v in {i: v for i, v in ok if i % every == 0}.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i)
                        for i, w in ok if i != q and len(w) == len(v))
        for rank, (score, i) in enumerate(scores[:k], 1):
            out[q, rank] = (i, -score)
    return out


class Groups:
    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def vector_links(rows):
    """rows: (vec_id, label, vector) -> {vec_id: (n_links, component_id)}"""
    def unit(v):
        if not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / max(abs(x) for x in v)
        return v / np.linalg.norm(v)

    units = [(i, label, unit(v)) for i, label, v in rows]
    groups, links = Groups(), defaultdict(int)
    for a, (i, label, u) in enumerate(units):
        groups.root(i)
        for j, other, v in units[:a]:
            if u is not None and v is not None and label is not None and label == other \
                    and len(u) == len(v) and u @ v >= 0.93:
                groups.join(i, j)
                links[i] += 1
                links[j] += 1
    return {i: (links[i], groups.root(i)) for i, _, _ in rows}


def without_repeats(docs, window=50):
    """docs: (doc_id, text) -> {doc_id: (words, removed, kept)}"""
    least = {}
    listed = {i: words(t) for i, t in docs}
    for i, w in listed.items():
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            least[key] = min(least.get(key, i), i)
    out = {}
    for i, w in listed.items():
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if least[tuple(w[s:s + window])] < i:
                gone[s:s + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g).decode()
        out[i] = (len(w), sum(gone), kept)
    return out


def shingles(text):
    w = [x.lower() for x in words(text)]
    return {tuple(w[s:s + 5]) for s in range(max(1, len(w) - 4))} if w else set()


def near_duplicates(docs):
    """docs: (doc_id, text) -> {doc_id: (shingles, component_id)}"""
    sets, holders, groups = {i: shingles(t) for i, t in docs}, defaultdict(list), Groups()
    for i, found in sets.items():
        groups.root(i)
        for s in found:
            holders[s].append(i)
    pairs = {(i, j) for h in holders.values() for i in h for j in h if i < j}
    for i, j in pairs:
        both = len(sets[i] & sets[j])
        if 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
            groups.join(i, j)
    return {i: (len(s), groups.root(i)) for i, s in sets.items()}


def without_lines(docs):
    """docs: (doc_id, text) -> {doc_id: (lines, dropped, kept)}"""
    def key(line):
        stripped = line.strip(SPACE)
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in stripped)

    holders = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 40:
                holders[key(line)].add(i)
    out = {}
    for i, t in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines
                if len(holders[key(x)]) < 5 or max(holders[key(x)]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out

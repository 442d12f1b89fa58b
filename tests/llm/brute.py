"""Plain versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def words(text):
    return WORD.findall(text or "")


def measures(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    count, hit = Counter(windows), set()
    for i, x in enumerate(windows):
        if count[x] > 1:
            hit.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    failed = len(w) < 10 or 100 * len(hit) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed


def byte_dedup(texts, length):
    """For each text: n_bytes, n_removed, n_spans, kept."""
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        hit = [False] * len(d)
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                hit[i : i + length] = [True] * length
        spans = sum(h and (i == 0 or not hit[i - 1]) for i, h in enumerate(hit))
        out.append((len(d), sum(hit), spans, bytes(b for b, h in zip(d, hit) if not h)))
    return out


def word_dedup(rows, length):
    """``rows`` (id, text) to (id, n_words, n_removed, kept)."""
    low = {}
    for doc, text in rows:
        w = words(text)
        for i in range(len(w) - length + 1):
            if doc is not None:
                key = tuple(w[i : i + length])
                low[key] = min(low.get(key, doc), doc)
    out = []
    for doc, text in rows:
        w = words(text)
        hit = [False] * len(w)
        for i in range(len(w) - length + 1):
            if doc is not None and low[tuple(w[i : i + length])] < doc:
                hit[i : i + length] = [True] * length
        out.append((doc, len(w), sum(hit), " ".join(x for x, h in zip(w, hit) if not h)))
    return out


def simhash(text, width=4):
    w = [x for x in words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))]
    if not w:
        return 0
    shingles = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(pairs_of):
    """Union-find over {node: neighbours}."""
    root = {n: n for n in pairs_of}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for n, others in pairs_of.items():
        for o in others:
            a, b = find(n), find(o)
            root[max(a, b)] = min(a, b)
    return {n: find(n) for n in pairs_of}


def near_duplicates(rows, width=4, bits=4):
    """``rows`` (id, text) to {row number: (fingerprint, smallest id)}."""
    prints = [simhash(t, width) for _, t in rows]
    fps = np.array(sorted(set(prints)), np.uint64)
    near = {int(f): [int(x) for x in fps[np.bitwise_count(fps ^ f) <= bits]] for f in fps}
    group = components(near)
    low = defaultdict(list)
    for (doc, _), f in zip(rows, prints):
        if doc is not None:
            low[group[f]].append(doc)
    return [(doc, f"{f:016x}", min(low[group[f]], default=None)) for (doc, _), f in zip(rows, prints)]


def shingle_set(text, width=5):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    return {" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def similar_groups(rows, least=0.8):
    """Smallest id of each group of ``rows`` linked by the Jaccard similarity of their shingle sets, all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    near = {i: [j for j in range(i) if jaccard(sets[i], sets[j]) >= least] for i in range(len(rows))}
    low = defaultdict(list)
    for i, g in components(near).items():
        low[g] += [rows[i][0]] * (rows[i][0] is not None)
    return [min(ids, default=None) for ids in low.values()]

"""Plain restatements of the contracts, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall((text or "").encode().lower())


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard(rows, n=5, percent=75):
    sets = {}
    for i, text in rows:
        w = words(text)
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    posting = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            posting[x].append(i)
    shared = Counter()
    for own in posting.values():
        for k, a in enumerate(own):
            for b in own[k + 1 :]:
                shared[a, b] += 1
    links = [(a, b) for (a, b), c in shared.items() if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c)]
    root = components(sets, links)
    return {i: (len(sets[i]), root[i]) for i in sets}


def repeats(rows, length=100):
    first, out = {}, {}
    data = sorted((i, (t or "").encode()) for i, t in rows)
    for i, b in data:
        for s in range(len(b) - length + 1):
            first.setdefault(b[s : s + length], (i, s))
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < (i, s):
                gone[s : s + length] = True
        spans = int((gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes() if len(b) else b""
        out[i] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def base_scores(rows, folds=10):
    held = {i: zlib.crc32(str(i).encode()) % folds == 0 for i, _ in rows}
    tokens = {i: [*words(t), None] for i, t in rows}
    c = Counter(x for i, own in tokens.items() if not held[i] for x in own)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(own), sum(c[x] > 0 for x in own), n, sum(math.log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in own)) for i, own in tokens.items()}


def top_k(rows, k=10, every=100):
    ids = [i for i, _ in rows]
    x = np.array([[math.floor(1024 * float(c)) for c in v] for _, v in rows], np.int64)
    out = set()
    for n, i in enumerate(ids):
        if i % every == 0:
            best = sorted((-int(s), j) for j, s in zip(ids, x @ x[n]) if j != i)[:k]
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(best)}
    return out


def cosine(rows, limit=0.95):
    ids = [i for i, _ in rows]
    x = np.array([v for _, v in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = x @ x.T >= limit
    np.fill_diagonal(hit, False)
    root = components(ids, [(ids[a], ids[b]) for a, b in zip(*np.nonzero(hit))])
    return {i: (int(h.sum()), root[i]) for i, h in zip(ids, hit)}


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        left = budget - sum(fixed.values())
        t = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if t[s] > most * sizes[s]]
        if not over:
            return fixed | t
        fixed |= {s: most * sizes[s] for s in over}


def suffix_tree_scores(rows, folds=10, depth=2, least=6, bound=10.0, prior=100.0, back_off=4.0):
    """Every text's log10 probability in the tree, from counters of all contexts."""
    held = {i: zlib.crc32(str(i).encode()) % folds == 0 for i, _ in rows}
    tokens = {i: [*words(t), None] for i, t in rows}
    count = [Counter() for _ in range(depth + 1)]  # of grams by the length of their context
    for i, own in tokens.items():
        for at in range(len(own) if not held[i] else 0):
            for k in range(min(depth, at) + 1):
                count[k][tuple(own[at - k : at + 1])] += 1
    n, v = sum(count[0].values()), len(count[0])
    follow = [defaultdict(int) for _ in range(depth + 1)]
    for k in range(1, depth + 1):
        for gram in count[k]:
            follow[k][gram[:-1]] += 1
    grown = [set() for _ in range(depth + 1)]

    def probability(own, at, most):
        p = (count[0][(own[at],)] + 0.1) / (n + 0.1 * (v + 1))
        for k in range(1, min(most, at) + 1):
            context = tuple(own[at - k : at])
            if context in grown[k]:
                c, seen, weight = count[k][(*context, own[at])], count[k - 1][context], back_off * follow[k][context]
                p = (c + weight * p) / (seen + weight)
        return p

    for k in range(1, depth + 1):
        gain = defaultdict(float)
        for i, own in tokens.items():
            for at in range(k, len(own) if not held[i] else 0):
                context = tuple(own[at - k : at])
                seen = count[k - 1][context]
                if seen >= least:
                    c, p = count[k][(*context, own[at])] - 1, probability(own, at, k - 1)
                    gain[context] += math.log((c + prior * p) / ((seen - 1 + prior) * p))
        grown[k] = {x for x, g in gain.items() if g > bound}
    return {i: sum(math.log10(probability(own, at, depth)) for at in range(len(own))) for i, own in tokens.items()}, [len(g) for g in grown]


def gapped(word, decay=0.6, span=6):
    """A word's four-letter subsequences, its ends letters too, by weight; at length 1."""
    w = "\1" + word + "\2"
    found = [((w[i], w[i + j], w[i + k], w[i + m]), decay ** (m - 3)) for i in range(len(w)) for j in range(1, span) for k in range(j + 1, span) for m in range(k + 1, span) if i + m < len(w)]
    size, out = math.sqrt(sum(x * x for _, x in found)), defaultdict(float)
    for key, x in found:
        out[key] += x / size
    return out


def host_and_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def rule(host, path, rules):
    hits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(hits)[1:] if hits else (None, None)

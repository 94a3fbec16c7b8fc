"""Plain versions of operators, for small tables."""

import math
import re
import zlib
from collections import Counter

import numpy as np



def near_keep(docs):
    """One document, with the smallest id, of each group that links make."""
    sets = {}
    for i, t in docs.items():
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), t))
        sets[i] = set() if not w else {tuple(w)} if len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for a in ids:
        for b in ids:
            if b < a and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    root[max(x, y)] = min(x, y)
    return {i: t for i, t in docs.items() if find(i) == i}


def best_fit(docs, capacity):
    """{(doc_id, piece): (first token, tokens, bin, offset, tokens of the bin)} of docs {doc_id: (text, source)}: every open bin is looked at."""
    pieces = []
    for i, (t, source) in docs.items():
        tokens = len(re.findall("[^\x20\x09-\x0d]+", t or "")) + 1
        copies = re.sub("[\x20\x09-\x0d]", "", t or "")
        pieces += [(min(capacity, tokens - k), i, k // capacity, k, source, copies) for k in range(0, tokens, capacity)]
    bins, placed = [], {}
    for size, i, piece, first, source, copies in sorted(pieces, key=lambda p: (-p[0], p[1], p[2])):
        tags = {("source", source)} if source is not None else set()
        tags |= {("copies", copies)} if copies else set()
        fits = [(b[0], k) for k, b in enumerate(bins) if b[0] >= size and not b[1] & tags]
        if not fits:
            bins.append([capacity, set()])
        k = min(fits)[1] if fits else len(bins) - 1
        placed[i, piece] = (first, size, k, capacity - bins[k][0])
        bins[k][0] -= size
        bins[k][1] |= tags
    return {key: (*v, capacity - bins[v[2]][0]) for key, v in placed.items()}


# ---------------------------------------------------------------- toxicity

LETTERS = re.compile("[a-z\x80-\U0010ffff]+")


def best_runs(x):
    """The best run (first, last, sum), then the best on either side of it, and so on; of equal ones the shortest, then the first."""
    out, open_ranges = [], [(0, len(x))]
    while open_ranges:
        lo, hi = open_ranges.pop()
        best, total, low, low_at = (0.0, 0, 0, 0), 0.0, 0.0, lo
        for i in range(lo, hi):
            total += x[i]
            if total - low > best[0] + 1e-9 or (abs(total - low - best[0]) <= 1e-9 and best[0] > 0 and i + 1 - low_at < best[2] - best[1]):
                best = (total - low, low_at, i + 1)
            if total <= low + 1e-12:
                low, low_at = total, i + 1
        if best[0] > 1e-9:
            s, a, b = best[:3]
            out.append((a, b - 1, s))
            open_ranges += [(lo, a), (b, hi)]
    return sorted(out)


def toxicity_scores(texts, labels, params):
    """{doc_id: score} of texts {doc_id: text} with labels {doc_id: 0 or 1}; weights, calibration and curve are learned the long way."""
    low = {i: LETTERS.findall("".join(c.lower() if len(c.lower()) == 1 else c for c in t or "")) for i, t in texts.items()}
    fold = {i: zlib.crc32(str(i).encode()) % params.folds for i in texts}
    known = [i for i in texts if i in labels and fold[i] != 0]
    n = Counter(), Counter()
    for i in known:
        if fold[i] in params.learn:
            n[labels[i] == 1].update(set(low[i]))
    vocabulary = {*n[0], *n[1]}
    owns = {}
    for w in vocabulary:
        for f in {w + "$", *(w[:k] for k in range(4, min(8, len(w)) + 1))}:
            owns.setdefault(f, []).append(w)
    scored = {}
    whole = [sum(c.values()) + params.prior * len(vocabulary) for c in n]
    for f, ws in owns.items():
        k0, k1 = (sum(c[w] for w in ws) for c in n)
        if k0 + k1 >= params.min_support and (f.endswith("$") or len(ws) < len(vocabulary)):
            a, b = k1 + params.prior * len(ws), k0 + params.prior * len(ws)
            delta = math.log(a / (whole[1] - a)) - math.log(b / (whole[0] - b))
            scored[f] = delta, delta / math.sqrt(1 / a + 1 / b)
    model = {f: w for f, (w, z) in scored.items() if abs(z) >= params.z_min and (f.endswith("$") or abs(w) >= params.prefix_min)}
    heads = tuple(f for f in model if not f.endswith("$"))
    model |= {f: 0.0 for f, (w, _) in scored.items() if f.endswith("$") and f not in model and w <= 1 and f[:-1].startswith(heads)}

    def weights(words):
        out, last = [], {}
        for i, w in enumerate(words):
            x = next((model[f] for f in [w + "$", *(w[:k] for k in range(8, 3, -1) if len(w) >= k)] if f in model), 0.0)
            if x > 0:
                near = [j for j in last.get(w, []) if i - j < params.window]
                x /= 1 + len(near)
                last[w] = [*near, i]
            out.append(x - params.cost)
        return out

    found = {i: weights(w) for i, w in low.items()}
    quiet = [found[i] for i in known if fold[i] not in params.learn and labels[i] != 1]
    tokens = sum(map(len, quiet))
    k = (sum(len(best_runs(x)) for x in quiet) + 1) / (tokens + 1000)
    seen = Counter(round(x, 1) for q in quiet for x in q) + Counter([-params.cost, 5.0])
    total = lambda lam: sum(c * math.exp(x * lam) for x, c in seen.items()) / (tokens + 2)
    lo, hi = 1e-3, 2.0
    for _ in range(100):
        lo, hi = ((lo + hi) / 2, hi) if total((lo + hi) / 2) <= 1 else (lo, (lo + hi) / 2)
    evidence = {}
    for i, x in found.items():
        e = [k * len(x) * math.exp(-min(700.0, lo * s)) for *_, s in best_runs(x)]
        e = [v for v in e if v <= params.e_max]
        evidence[i] = math.log1p(sum(-math.log(max(v, 1e-300)) for v in e)), math.log1p(len(e))
    check = [i for i in known if fold[i] not in params.learn]
    a = np.array([(1.0, *(round(v, 2) for v in evidence[i])) for i in check])
    y = np.array([float(labels[i] == 1) for i in check])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -50, 50)))
        w = w + np.linalg.solve((a.T * (p * (1 - p))) @ a + 1e-2 * np.eye(3), a.T @ (y - p) - 1e-2 * w)
    return {i: 1 / (1 + math.exp(-float(np.dot(w, (1.0, *v))))) for i, v in evidence.items()}

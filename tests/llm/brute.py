"""Plain Python versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text):
    return WORD.findall(text or "")


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def exact_dedup(rows):
    """rows: (id, text) -> sorted (id, keep_id, group_size, kept, sha)."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append((-len(t or ""), i is not None, i or 0))
    out = []
    for n, g in groups.items():
        g.sort()
        keep = g[0][2] if g[0][1] else None
        sha = hashlib.sha256(n.encode()).hexdigest()
        out += [(x[2] if x[1] else None, keep, len(g), k == 0, sha) for k, x in enumerate(g)]
    return sorted(out, key=str)


def shingles(text):
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def near_classes(rows, percent=75):
    """rows: (id, text) -> sorted (id, n_shingles, component_id)."""
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            n = len(a & b)
            if 100 * n >= percent * (len(a) + len(b) - n):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return sorted(((i, len(s), None if i is None else find(i)) for i, s in sets), key=str)


def targets(sizes):
    """source -> target, by repeated resharing of what exceeds the caps."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    total, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(out.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * weight[s] for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return out


def text_counts(text):
    w = words(text)
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    tri = Counter(zip(w, w[1:], w[2:]))
    inside = {k + j for k in range(len(w) - 2) if tri[w[k], w[k + 1], w[k + 2]] > 1 for j in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), symbols, dup, len(inside), failed


def _low(x, p):
    return np.sort(x)[max(0, math.ceil(p * len(x)) - 1)]


def mcd(x, floors, h, steps, chi2_median, shrink, above=None):
    """Mean, covariance without floors, and scale of the rows of x, drawn
    towards ``above`` (the same of the level above)."""
    floors = np.diag(np.array(floors) ** 2)
    med = np.array([_low(c, 0.5) for c in x.T])
    mad = np.array([_low(abs(c - m), 0.5) for c, m in zip(x.T, med)])
    starts = [(med, np.diag((1.4826 * mad) ** 2)), above[:2] if above else (x.mean(0), np.cov(x.T, bias=True))]
    found = []
    for k, (mean, cov) in enumerate(starts):
        for _ in range(steps):
            d = np.round(mcd_distances(x, mean, cov + floors), 9)
            part = x[d <= _low(d, h)]
            mean, cov = part.mean(0), np.cov(part.T, bias=True).reshape(x.shape[1], -1)
            if above:
                w = len(part) / (len(part) + shrink)
                mean, cov = w * mean + (1 - w) * above[0], w * cov + (1 - w) * above[1]
        found.append((round(np.linalg.slogdet(cov + floors)[1] / 2, 9), k, mean, cov))
    _, _, mean, cov = min(found, key=lambda f: f[:2])
    scale = _low(np.round(mcd_distances(x, mean, cov + floors), 9), 0.5) / chi2_median
    if above:
        w = len(x) / (len(x) + shrink)
        scale = w * scale + (1 - w) * above[2]
    return mean, cov, scale


def mcd_distances(x, mean, cov):
    z = np.linalg.solve(np.linalg.cholesky(cov), (x - mean).T)
    return (z ** 2).sum(0)


def features(c, n_lines):
    n, chars, symbols, dup, rep, _ = c
    share = lambda a, b: math.asin(math.sqrt(min(1.0, a / b)))
    n, chars = max(n, 1), max(chars, 1)
    return [math.log(n), math.log(chars / n), share(symbols, chars), share(dup, max(n_lines, 1)), share(rep, n)]


def removed(texts, length=200):
    """Per text: (bytes, removed, spans, sha256 of the rest)."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[u:u + length] for b in raw for u in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for u in range(len(b) - length + 1):
            if count[b[u:u + length]] > 1:
                gone[u:u + length] = b"\1" * length
        rest = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(rest).hexdigest()))
    return out


ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_secrets(text):
    t = text or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out)

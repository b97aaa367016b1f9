"""Plain Python restatements of the operators' contracts, for small tables."""

import collections
import hashlib
import math
import re

import numpy as np
import xxhash


def substring(rows, window):
    words = [(t or "").encode().split() for _, t in rows]
    seen = collections.Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                keep[i : i + window] = [False] * window
        kept = b" ".join(x for x, k in zip(w, keep) if k)
        out.append((doc, len(w), len(w) - sum(keep), hashlib.sha256(kept).hexdigest()))
    return out


def suffix(rows, window):
    seen, out = set(), []
    for doc, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (t or "").encode()
        keep = np.ones(len(b), bool)
        for i in range(len(b) - window + 1):
            s = b[i : i + window]
            if s in seen:
                keep[i : i + window] = False
            seen.add(s)
        runs = int((np.diff(np.concatenate(([1], keep.astype(int)))) == -1).sum())
        rest = np.frombuffer(b, np.uint8)[keep].tobytes()
        out.append((doc, len(b), int((~keep).sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def fingerprint(text, size=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    marks = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(m >> b & 1 for m in marks) > len(marks))


def components(values, distance):
    """Smallest id reachable for every (id, value)."""
    root = {d: d for d, _ in values}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(values):
        for b, y in values[:i]:
            if (x ^ y).bit_count() <= distance:
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {d: find(d) for d, _ in values}


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def entropy(s):
    return -sum(n / len(s) * math.log2(n / len(s)) for n in collections.Counter(s).values())


def secrets(text, classes, allow):
    t, spans = text or "", []
    spans += [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m.group(2)) >= 12]
    spans += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 18]
    spans += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 16]
    base = list(spans)
    for order, kind in enumerate(classes, 3):
        for m in re.finditer(kind.candidate, t):
            s, w = m.group(), kind.window
            if any(re.fullmatch(p, s) for p in allow):
                continue
            high = [i for i in range(len(s) - w + 1) if entropy(s[i : i + w]) >= kind.threshold - 1e-9]
            if high:
                spans.append((m.start() + high[0], order, m.start() + high[-1] + w, kind.kind))

    def said(found):
        return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(found))

    n = collections.Counter(s[3] for s in base)
    digest = hashlib.sha256(said(base).encode()).hexdigest()
    return n["assign"], n["access"], n["hex"], digest, said(spans), len(spans) - len(base)


def edits(pattern, text):
    """Least edits of the pattern against any part of the text."""
    last = [0] * (len(text) + 1)
    for i, a in enumerate(pattern, 1):
        row = [i]
        for j, b in enumerate(text, 1):
            row.append(min(last[j - 1] + (a != b), last[j] + 1, row[-1] + 1))
        last = row
    return min(last)

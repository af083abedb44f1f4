"""Plain models of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text, k):
    w = WORD.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def near_components(rows, k, percent):
    """{doc_id: (set size, smallest id reachable)}"""
    sets = {d: shingle_set(t, k) for d, t in rows}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def cut_repeats(texts, length):
    """Per text (n_bytes, n_removed, n_spans, sha256 of what is left)."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def cut_repeats_by_hash(texts, length):
    """cut_repeats for larger tables: windows by a 64-bit rolling hash of all of them, sorted."""
    data = [(t or "").encode() for t in texts]
    all_bytes = np.frombuffer(b"".join(data), np.uint8)
    ends = np.cumsum([len(x) for x in data])
    table = np.random.default_rng(1).integers(1, 2**63, 256, dtype=np.uint64)
    base, n = 0x9E3779B97F4A7C15, len(all_bytes) - length + 1
    mixed = np.empty(n, np.uint64)
    step = 1 << 22
    with np.errstate(over="ignore"):
        power, inverse = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(step + length, np.uint64(b))])) for b in (base, pow(base, -1, 1 << 64)))
        for at in range(0, n, step):
            m = min(step, n - at)
            value = table[all_bytes[at : at + m + length - 1]]
            upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value * power[: len(value)], dtype=np.uint64)])
            h = (upto[length : length + m] - upto[:m]) * inverse[:m]
            h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
            mixed[at : at + m] = h ^ (h >> np.uint64(29))
    inside = np.zeros(n, bool)
    for x, z in zip([0, *ends[:-1]], ends, strict=True):
        inside[x : max(x, z - length + 1)] = True
    place = np.flatnonzero(inside)
    order = np.argsort(mixed[place])
    same = np.diff(mixed[place][order]) == 0
    again = place[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]]
    edge = np.zeros(len(all_bytes) + 1, np.int64)
    np.add.at(edge, again, 1), np.add.at(edge, again + length, -1)
    gone = np.cumsum(edge)[:-1] > 0
    out = []
    for x, z, b in zip([0, *ends[:-1]], ends, data, strict=True):
        g = gone[x:z]
        kept = np.frombuffer(b, np.uint8)[~g].tobytes()
        out.append((len(b), int(g.sum()), int(np.count_nonzero(np.diff(np.concatenate([[0], g.astype(np.int8)])) == 1)), hashlib.sha256(kept).hexdigest()))
    return out


def edit_at_most_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def dedup_lines(rows, least, exact_short=False):
    """{doc_id: text left}; ids are distinct."""
    lines = sorted((d, k, " ".join(WORD.findall(x)), x) for d, t in rows if t is not None for k, x in enumerate(t.split("\n")))
    earlier, short, drop = [], set(), defaultdict(set)
    for d, k, norm, _ in lines:
        if exact_short and 0 < len(norm) < least:
            if norm in short:
                drop[d].add(k)
            short.add(norm)
        if len(norm) >= least:
            if any(edit_at_most_one(norm, o) for o in earlier):
                drop[d].add(k)
            earlier.append(norm)
    return {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in drop[d]) for d, t in rows}


def contaminated(rows, items, k=5, percent=80):
    """{doc_id: set of item ids}"""
    toks = lambda t: WORD.findall((t or "").lower())
    out = defaultdict(set)
    for d, t in rows:
        w = toks(t)
        for i, it in items:
            q = toks(it)
            n = min(k, len(q))
            if not q:
                continue
            want = Counter(tuple(q[j : j + n]) for j in range(len(q) - n + 1))
            for s in range(len(w) - len(q) + 1):
                part = w[s : s + len(q)]
                have = Counter(tuple(part[j : j + n]) for j in range(len(part) - n + 1))
                both = sum((want & have).values())
                if 100 * both >= percent * (2 * sum(want.values()) - both):
                    out[d].add(i)
                    break
    return dict(out)


def contaminated_whole(rows, items, k=5, percent=80):
    """{doc_id: set of item ids}, of the items that are longer than the text"""
    toks = lambda t: WORD.findall((t or "").lower())
    out = defaultdict(set)
    for d, t in rows:
        w = toks(t)
        for i, it in items:
            q = toks(it)
            n = min(k, len(q))
            if len(w) < len(q):
                want, have = (Counter(tuple(x[j : j + n]) for j in range(len(x) - n + 1)) for x in (q, w))
                if 100 * (want & have).total() >= percent * (want | have).total():
                    out[d].add(i)
    return dict(out)


def targets(sizes, cap=3, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    total, free, out = sum(sizes.values()), set(names), {}
    while free:
        left = total - sum(out.values())
        share = {n: left * w[n] / sum(w[m] for m in free) for n in free}
        over = [n for n in free if share[n] > cap * sizes[n]]
        if not over:
            return out | share
        for n in over:
            out[n] = float(cap * sizes[n])
            free.remove(n)
    return out

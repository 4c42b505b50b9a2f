"""Plain Python versions of the contracts, on whole small tables."""

from __future__ import annotations

import collections
import hashlib
import re
import zlib

import xxhash

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def targets(sizes: dict) -> dict:
    """source -> target: resharing the excess until no target is above three times its source."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(3 * sizes[s] for s in capped)
        free = sum(w[s] for s in order if s not in capped)
        got = {s: 3.0 * sizes[s] if s in capped else left * w[s] / free for s in order}
        over = {s for s in order if s not in capped and got[s] >= 3 * sizes[s]}
        if not over or total == 0:
            return got
        capped |= over


def fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(rows, bits=2):
    """[(doc_id, fp)] -> {fp: smallest doc_id reachable}, comparing all pairs of fingerprints."""
    import numpy as np
    fps = sorted({f for _, f in rows})
    a = np.array(fps, np.uint64)
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[i + 1:] ^ a[i]) <= bits).tolist():
            x, y = find(i), find(i + 1 + j)
            root[max(x, y)] = min(x, y)
    low = {}
    for d, f in rows:
        r = find(fps.index(f)) if len(fps) < 200 else find(int(np.searchsorted(a, np.uint64(f))))
        if d is not None:
            low[r] = min(low.get(r, d), d)
    return {f: low.get(find(i)) for i, f in enumerate(fps)}


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else True,
                  "card": 13 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def repeats(texts, n=200):
    """[(n_bytes, n_removed, n_spans, sha256)] per text."""
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(hash(r[i:i + n]) for r in raw for i in range(len(r) - n + 1))
    exact = collections.Counter(r[i:i + n] for r in raw for i in range(len(r) - n + 1) if seen[hash(r[i:i + n])] > 1)
    out = []
    for r in raw:
        gone = bytearray(len(r))
        for i in range(len(r) - n + 1):
            if exact.get(r[i:i + n], 0) > 1:
                gone[i:i + n] = b"\1" * n
        spans = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(r), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(r, gone) if not g)).hexdigest()))
    return out

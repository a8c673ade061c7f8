"""Plain versions of the contracts, for small inputs."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import xxhash


def fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def components(ids, prints, radius=3):
    """Index of each row's component as the set of rows reachable."""
    top = list(range(len(prints)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                top[find(i)] = find(j)
    groups = defaultdict(list)
    for i in range(len(prints)):
        groups[find(i)].append(i)
    out = [None] * len(prints)
    for g in groups.values():
        own = [ids[i] for i in g if ids[i] is not None]
        for i in g:
            out[i] = min(own) if own else None
    return out


def cut_words(docs, window=13):
    """docs: list of (id, text); rows (id, n_words, n_removed, sha, kept words)."""
    low = {}
    split = [(d, (t or "").encode().split()) for d, t in docs]
    for d, w in split:
        for i in range(len(w) - window + 1) if d is not None else ():
            s = tuple(w[i:i + window])
            low[s] = min(low.get(s, d), d)
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - window + 1) if d is not None else ():
            if low[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), kept))
    return out


def cut_bytes(docs, length=200):
    raw = [(d, (t or "").encode()) for d, t in docs]
    seen = Counter(x[i:i + length] for _, x in raw for i in range(len(x) - length + 1))
    out = []
    for d, x in raw:
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(x, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def held_out(d, modulus):
    return d is not None and zlib.crc32(str(d).encode()) % modulus == 2


def katz(docs, cut=5):
    """Rows (id, held_out, tokens, known, N, base, score)."""
    def tokens(t):
        return (t or "").encode().lower().split() + [None]

    train = [tokens(t) for d, t in docs if not held_out(d, 7)]
    uni = Counter(x for w in train for x in w)
    bi = Counter(p for w in train for p in zip([0, *w[:-1]], w))
    total, types = sum(uni.values()), len(uni)

    def turing(counts):
        n = Counter(counts)
        rest = (cut + 1) * n[cut + 1] / n[1] if n[1] else 1
        d = {}
        for r in range(1, cut + 1):
            v = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if n[r] and rest < 1 else 1
            d[r] = v if 0 < v <= 1 else 1.0
        return lambda c: d.get(c, 1.0)

    du, db = turing(uni.values()), turing(bi.values())
    left = sum(c * (1 - du(c)) for c in uni.values())
    scale = 1 / (total if left > 0 else total + 1)
    unknown = (left if left > 0 else 1) * scale

    def p(w):
        return du(uni[w]) * uni[w] * scale if w in uni else unknown

    after = defaultdict(dict)
    for (h, w), c in bi.items():
        after[h][w] = c
    context = {}
    for h, own in after.items():
        size, rest = sum(own.values()), sum(c * (1 - db(c)) for c in own.values())
        if rest <= 1e-12 * size:
            size, rest = size + 1, 1
        context[h] = size, rest / size / (1 - sum(map(p, own)))
        seen = sum(db(c) * c / size for c in own.values())
        assert abs(seen + context[h][1] * (1 - sum(map(p, own))) - 1) < 1e-9  # exactly normalised
    out = []
    for d, t in docs:
        base = score = known = 0
        w = tokens(t)
        for h, x in zip([0, *w[:-1]], w):
            c = bi.get((h, x), 0)
            known += x in uni
            base += math.log10((uni[x] + 1) / (total + types + 1))
            score += math.log10(db(c) * c / context[h][0] if c else (context[h][1] if h in context else 1) * p(x))
        out.append((d, held_out(d, 7), len(w), known, total, base, score))
    return out

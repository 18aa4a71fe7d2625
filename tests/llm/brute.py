"""The operators' contracts, computed the plain way over lists of (id, text)."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha(data) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def substring(docs, window=13):
    split = [(i, SPACED.findall(t or "")) for i, t in docs]
    least = {}
    for i, words in split:
        for k in range(len(words) - window + 1) if i is not None else ():
            passage = tuple(words[k:k + window])
            least[passage] = min(i, least.get(passage, i))
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - window + 1) if i is not None else ():
            if least[tuple(words[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(words), sum(gone), sha(" ".join(w for w, g in zip(words, gone) if not g))))
    return out


def contamination(docs, items, window=13):
    passages = defaultdict(set)
    for item, text in items:
        words = PLAIN.findall(lower(text or ""))
        size = min(window, len(words))
        for k in range(len(words) - size + 1) if size and item is not None else ():
            passages[tuple(words[k:k + size])].add(str(item))
    sizes = {len(p) for p in passages}
    out = []
    for i, text in docs:
        words = PLAIN.findall(lower(text or ""))
        hit, found = [False] * len(words), set()
        for size in sizes:
            for k in range(len(words) - size + 1):
                if owners := passages.get(tuple(words[k:k + size])):
                    hit[k:k + size] = [True] * size
                    found |= owners
        n = sum(hit)
        out.append((i, len(words), n, len(found), sha(",".join(sorted(found))), n > 0 and 20 * n >= len(words)))
    return out


def suffix(docs, length=400, keep="none"):
    texts = [(t or "").encode() for _, t in docs]
    order = sorted(range(len(docs)), key=lambda k: (docs[k][0] is None, docs[k][0]))
    times, first = Counter(), {}
    for k in order:
        for a in range(len(texts[k]) - length + 1):
            times[texts[k][a:a + length]] += 1
            first.setdefault(texts[k][a:a + length], (k, a))
    out = []
    for k, (i, _) in enumerate(docs):
        steps = np.zeros(len(texts[k]) + 1, int)
        for a in range(len(texts[k]) - length + 1):
            string = texts[k][a:a + length]
            if times[string] > 1 and (keep == "none" or first[string] != (k, a)):
                steps[a] += 1
                steps[a + length] -= 1
        gone = np.cumsum(steps)[:-1] > 0
        n_spans = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        out.append((i, len(texts[k]), int(gone.sum()), n_spans, sha(np.frombuffer(texts[k], np.uint8)[~gone].tobytes())))
    return out


def rules(docs):
    out = []
    for i, text in docs:
        text = text or ""
        words = SPACED.findall(text)
        lines = [x for x in text.split("\n") if SPACED.search(x)]
        triples = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        times, again = Counter(triples), [False] * len(words)
        for k, triple in enumerate(triples):
            if times[triple] > 1:
                again[k:k + 3] = [True] * 3
        n = sum(again)
        out.append((i, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
                    len(lines) - len(set(lines)), n, len(words) < 50 or 100 * n > 50 * len(words)))
    return out


def fingerprint(text) -> int:
    words = [w.encode() for w in SPACED.findall(lower(text or ""))]
    shingles = [b" ".join(words[k:k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else \
        [b" ".join(words)] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def linked(prints: list[int], distance=3) -> list[int]:
    """For each place the smallest place of its component."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= distance:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(x) for x in range(len(prints))]


def near_copies(docs):
    docs = sorted(docs, key=lambda d: (d[0] is None, d[0]))
    prints = [fingerprint(t) for _, t in docs]
    roots = linked(prints)
    return [(docs[k][0], f"{prints[k]:016x}", docs[roots[k]][0]) for k in range(len(docs))]

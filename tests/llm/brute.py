"""Plain Python answers for small inputs."""

import collections
import hashlib
import re

import numpy as np


def repeats(texts, length):
    """Per text: bytes, removed bytes, spans and the SHA-256 of the rest."""
    data = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        cover = np.zeros(len(b) + 1, dtype=int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        hit = np.cumsum(cover)[: len(b)] > 0
        rest = np.frombuffer(b, np.uint8)[~hit].tobytes()
        runs = int((np.diff(np.concatenate([[0], hit.astype(int)])) == 1).sum())
        out.append((len(b), int(hit.sum()), runs, hashlib.sha256(rest).hexdigest()))
    return out


def top_k(vectors, k=5, every=50, scale=256):
    """vectors: (vec_id, list). Rows (query_id, rank, vec_id, score), sorted."""
    rows = []
    for i, (vec_id, x) in enumerate(vectors):
        if x is not None and all(v is not None and np.isfinite(v) for v in x):
            rows.append((i, vec_id, [int(np.floor(np.float64(v) * scale)) for v in x]))
    out = []
    for i, q_id, q in rows:
        if q_id is None or q_id % every:
            continue
        scores = [
            (-sum(a * b for a, b in zip(q, x)), v_id is None, v_id or 0, v_id)
            for j, v_id, x in rows
            if j != i and len(x) == len(q)
        ]
        out += [(q_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores, key=lambda s: s[:3])[:k], 1)]
    return sorted(out, key=str)


def shingles(text, k=5):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    k = min(k, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def components(docs, percent):
    """docs: (doc_id, text). Row number -> (shingles, smallest id, members)."""
    sets = [shingles(t) for _, t in docs]
    label = list(range(len(docs)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    groups = collections.defaultdict(list)
    for i in range(len(docs)):
        groups[find(i)].append(i)
    out = []
    for i, (doc_id, _) in enumerate(docs):
        ids = [docs[j][0] for j in groups[find(i)] if docs[j][0] is not None]
        out.append((len(sets[i]), min(ids) if sets[i] and ids else doc_id))
    return out


_WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def contamination(texts, items, size=10):
    """items: (item_id, text). Per text: words, hit words, items, hash, flag."""
    windows = collections.defaultdict(set)
    for item_id, text in items:
        w = words(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i : i + size])].add(item_id)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i : i + n])]
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out.append((len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return out


def luhn(number):
    digits = [int(c) for c in reversed(number) if c.isdigit()]
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(digits)) % 10 == 0

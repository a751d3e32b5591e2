"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


def tokens(docs, path):
    from tokenizers import Tokenizer

    tok, start, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(docs):
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def repeats(docs, length=100):
    seen, out = set(), []
    for doc_id, text in sorted(docs):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            s = data[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def simhash(text):
    import xxhash

    words = SPACE.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints, radius=3):
    """doc_id to smallest reachable doc_id; prints: [(doc_id, fingerprint)]."""
    root = {d: d for d, _ in prints}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, (a, p) in enumerate(prints):
        for b, q in prints[:i]:
            if (p ^ q).bit_count() <= radius:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {d: find(d) for d, _ in prints}


def contamination(docs, items, size=10):
    windows = []
    for item, text in items:
        w = WORD.findall((text or "").translate(LOWER))
        if w:
            n = min(size, len(w))
            windows += [(item, tuple(w[i : i + n])) for i in range(len(w) - n + 1)]
    by_first = {}
    for item, w in windows:
        by_first.setdefault(w[0], []).append((item, w))
    out = []
    for doc_id, text in sorted(docs):
        words = WORD.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for i, word in enumerate(words):
            for item, w in by_first.get(word, ()):
                if tuple(words[i : i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item))
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(found), digest, bool(hit)))
    return out


def top_k(vectors, k=5, every=50):
    rows = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in vectors if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, v in rows:
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))
            out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Dealt again until no source is above; sizes: {source: words}."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, free, budget = {}, set(order), share * sum(sizes.values())
    while free:
        left = budget - sum(target.values())
        total = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / total > most * sizes[s]]
        if not full:
            target |= {s: left * weight[s] / total for s in free}
            break
        target |= {s: most * sizes[s] for s in full}
        free -= set(full)
    return target


def dedup_lines(docs, size=8, similarity=0.8):
    first, sets = {}, {}
    for doc_id, text in sorted(docs):
        for i, line in enumerate(text.split("\n")):
            if line.strip():
                first.setdefault(line, (doc_id, i))
                sets[line] = {line[j : j + size] for j in range(max(1, len(line) - size + 1))}
    order = sorted(first, key=first.get)
    root = {x: x for x in order}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, a in enumerate(order):
        for b in order[:n]:
            s, t = sets[a], sets[b]
            if min(len(s), len(t)) < similarity * max(len(s), len(t)):
                continue
            shared = len(s & t)
            if shared >= similarity * (len(s) + len(t) - shared):
                x, y = sorted((find(a), find(b)), key=first.get)
                root[y] = x
    keep = {first[x] for x in order if find(x) == x}
    out = []
    for doc_id, text in sorted(docs):
        lines = text.split("\n")
        stay = [x for i, x in enumerate(lines) if not x.strip() or (doc_id, i) in keep]
        out.append((doc_id, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def periodic(words, shortest=12):
    """All runs (start, length, period), from the matches at every distance."""
    w = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.zeros(0, int)
    smallest = {}
    for q in range(1, len(w) // 2 + 1):
        same = np.concatenate(([0], (w[:-q] == w[q:]).astype(int), [0]))
        edge = np.diff(same)
        for s, e in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()):
            if e + q - s >= max(shortest, 2 * q):
                smallest.setdefault((s, e + q), q)
    return sorted((s, e - s, q) for (s, e), q in smallest.items())


def planted(doc_id, words):
    """The words that ``op13`` is asked about."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [x if i < a else words[a + (i - a) % p] for i, x in enumerate(words)]


def periodic_runs(docs):
    out = []
    for doc_id, text in sorted(docs):
        words = planted(doc_id, SPACE.findall(text or ""))
        runs = periodic(words)
        gone = set()
        for s, n, q in runs:
            gone.update(range(s + q, s + n))
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2])) if runs else None
        top = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = " ".join(x for i, x in enumerate(words) if i not in gone)
        out.append((doc_id, len(runs), *top, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(), len(words)))
    return out


TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def divergence(rows, min_docs=30, top=50):
    """rows: [(text, lang, source)]."""
    docs_of, own, groups = {}, {}, {}
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        words = TERM.findall((text or "").translate(LOWER))
        groups.setdefault(lang, set()).add(source)
        for w in set(words):
            docs_of[lang, w] = docs_of.get((lang, w), 0) + 1
        for w in words:
            own[lang, source, w] = own.get((lang, source, w), 0) + 1
    out = []
    for lang, sources in groups.items():
        kept = [w for (x, w), n in docs_of.items() if x == lang and n >= min_docs]

        def shares(counts):
            total = sum(counts)
            return [1 + 10**9 * (c + 5) // (total + 5 * len(kept)) for c in counts]

        count = {s: [own.get((lang, s, w), 0) for w in kept] for s in sources}
        p = {s: shares(c) for s, c in count.items()}
        whole = shares([sum(c) for c in zip(*count.values())])
        for s in sources:
            far = [(-sum(abs(a - b) for a, b in zip(p[s], p[t])), t.encode(), t) for t in sources if t != s]
            out += [(lang, s, "pair", t, -v, i) for i, (v, _, t) in enumerate(sorted(far), 1)]
            over = [(b - a, w.encode(), w) for a, b, c, w in zip(p[s], whole, count[s], kept) if c and a > b]
            out += [(lang, s, "term", w, -v, i) for i, (v, _, w) in enumerate(sorted(over)[:top], 1)]
    return sorted(out)

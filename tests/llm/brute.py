"""Plain Python versions of the text operators' results."""

import collections
import hashlib
import re
import zlib

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def contamination(docs, items):
    """[(id, text)], [(item, text)] -> [(id, n_words, n_hit, items)]"""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = collections.defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").translate(UPPER))
        for i in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[i : i + 10])].add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w = word.findall((text or "").translate(UPPER))
        hit, found = set(), set()
        for m in {len(x) for x in windows}:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit.update(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        out.append((doc, len(w), len(hit), sorted(found)))
    return out


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
    return frozenset(tuple(w[i : i + 4]) for i in range(len(w) - 3)) if len(w) >= 4 else frozenset([tuple(w)] if w else [])


def components(docs, threshold=85):
    """[(id, text)] -> [(id, n_shingles, component)], ids may repeat or be None."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if sets[i] and 100 * k >= threshold * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(docs):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [(doc, len(sets[i]), least.get(find(i)) if sets[i] else doc) for i, (doc, _) in enumerate(docs)]


def exact(docs, best=max):
    groups = collections.defaultdict(list)
    for doc, text in docs:
        groups[text or ""].append(doc)
    out = []
    for doc, text in docs:
        ids = groups[text or ""]
        known = [i for i in ids if i is not None]
        keep = best(known) if known and (best is max or len(known) == len(ids)) else None
        out.append((doc, keep, len(ids), doc == keep, hashlib.sha256((text or "").encode()).hexdigest()))
    return out


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def personal(text):
    def valid(kind, match):
        digits = re.sub("[^0-9]", "", match)
        if kind == "ip":
            return all(int(x) <= 255 for x in match.split("."))
        if kind == "card":
            luhn = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits)))
            return 16 <= len(digits) <= 19 and luhn % 10 == 0
        return kind == "email" or 8 <= len(digits) <= 15

    text = text or ""
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text) if valid(k, m[0])]


def repeats(docs, length=100):
    """[(id, text)] in order -> [(id, n_bytes, spans, kept)]"""
    seen, out = set(), []
    for doc, text in docs:
        raw = (text or "").encode()
        mark = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            window = raw[i : i + length]
            if window in seen:
                mark[i : i + length] = b"\1" * length
            seen.add(window)
        spans = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(mark))]
        out.append((doc, len(raw), spans, bytes(b for b, m in zip(raw, mark) if not m)))
    return out


def tokens(docs, tokenizer, end=2):
    """[(id, text)] in order -> [(id, start, n, crc32)]"""
    import numpy as np

    at, out = 0, []
    for doc, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def importance(docs, items, buckets=10_000, seed=7, min_words=20, percent=25):
    """[(id, text)], [(item, text)] -> {id: (n_features, weight, score, rank)} for distinct ids."""
    import math

    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def words(text):
        return word.findall((text or "").translate(UPPER))

    def features(text):
        w = words(text)
        return [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s = collections.Counter(f for _, text in docs for f in features(text))
    t = collections.Counter(f for _, text in items for f in features(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)
    ]
    out, eligible = [], []
    for at, (doc, text) in enumerate(docs):
        f = features(text)
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(f), weight, score, None])
        if len(words(text)) >= min_words:
            eligible.append((-score, doc is None, doc or 0, at))
    for rank, (*_, at) in enumerate(sorted(eligible)[: percent * len(eligible) // 100], 1):
        out[at][4] = rank
    return [tuple(r) for r in out]


def whitening(vectors, components=8):
    """[vector] -> (n, exact deviations, whitened up to sign, eigenvalues, trace)."""
    import math
    from fractions import Fraction

    import numpy as np

    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(r, sums)) for r in x]
    centred = [[n * a - s for a, s in zip(r, sums)] for r in x]
    cov = np.array([[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(d)] for i in range(d)])
    values, directions = np.linalg.eigh(cov)
    order = np.argsort(values)[::-1][:components]
    z = np.array([[a / n for a in r] for r in centred]) @ directions[:, order] / np.sqrt(values[order])
    return n, deviation, z, values[order], cov.trace()

"""Plain versions of the operators, for comparison on small tables."""

import hashlib
import math
import re
from collections import Counter, defaultdict

SPACED = "[^\x20\x09-\x0D]+"
ALNUM = "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def spaced(text):
    return re.findall(SPACED, text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def groups(ids, links):
    root = {i: i for i in ids}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        root[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def licence_places(text, phrases):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(ALNUM, lowered)
    found = []
    for phrase, label in phrases.items():
        p = phrase.split()
        found += [(i, label) for i in range(len(words) - len(p) + 1) if words[i : i + len(p)] == p]
    return len(words), sorted(found)


def without_repeats(rows, size):
    """rows: (id, text); None counts as the largest id."""
    words = [(math.inf if i is None else i, spaced(t)) for i, t in rows]
    least = {}
    for i, w in words:
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < i:
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((None if i is math.inf else i, len(w), sum(gone), kept))
    return out


def shingles(text, size=5):
    w = spaced(text)
    if not w:
        return Counter()
    return Counter(tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1)))


def jaccard(a, b):
    both = sum((a & b).values())
    return both / (sum(a.values()) + sum(b.values()) - both)


def near_duplicates(rows, threshold=0.8):
    sets = {i: shingles(t) for i, t in rows}
    held = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            held[x].append(i)
    pairs = {(a, b) for ids in held.values() for a in ids for b in ids if a < b}
    return groups(list(sets), [p for p in pairs if jaccard(sets[p[0]], sets[p[1]]) >= threshold])


def viterbi(vocabulary, text):
    raw = (" " + text).encode() if text else b""
    score = {vocabulary.pieces[i]: (vocabulary.scores[i], i) for i in vocabulary.of_key.tolist()}
    longest = max(map(len, score))
    best, back = [0.0] + [-math.inf] * len(raw), [None] * (len(raw) + 1)
    for p in range(len(raw)):
        if best[p] == -math.inf or raw[p] & 0xC0 == 0x80:
            continue
        wide = 1 + (raw[p] >= 0xC0) + (raw[p] >= 0xE0) + (raw[p] >= 0xF0)
        spelled = False
        for q in range(p + 1, min(len(raw), p + longest) + 1):
            if raw[p:q] in score:
                s, i = score[raw[p:q]]
                spelled |= q - p == wide
                if best[p] + s > best[q]:
                    best[q], back[q] = best[p] + s, (p, i)
        if not spelled and best[p] + vocabulary.unknown > best[p + wide]:
            best[p + wide], back[p + wide] = best[p] + vocabulary.unknown, (p, -1)
    ids, q = [], len(raw)
    while q:
        p, i = back[q]
        ids = ([i] if i >= 0 else [int(vocabulary.byte_ids[c]) for c in raw[p:q]]) + ids
        q = p
    return ids


def bayes(train, texts, buckets, orders=(1, 2, 3), smoothing=0.5):
    """Most probable label and its posterior by multinomial naive Bayes over hashed n-grams, in whole Python numbers."""
    wide, top = (1 << 64) - 1, 64 - (buckets.bit_length() - 1)

    def scramble(x):
        x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & wide
        x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & wide
        return x ^ (x >> 31)

    factors = [scramble(((i + 1) * 0x9E3779B97F4A7C15 + 61) & wide) | 1 for i in range(max(orders) + 1)]

    def grams(text):
        folded = [c.lower() if c.isascii() and c.isalpha() else " " if c.isascii() else c for c in text]
        numbers = [int.from_bytes(c.encode(), "little") for c in folded]
        for n in orders:
            for i in range(len(numbers) - n + 1):
                total = sum(numbers[i + k] * factors[k] for k in range(n)) & wide
                yield (((total ^ (total >> 29)) * factors[-1]) & wide) >> top

    counts, seen = defaultdict(Counter), Counter()
    for text, label in train:
        counts[label].update(grams(text))
        seen[label] += 1
    out = []
    for text in texts:
        if not any(map(str.isalpha, text or "")):
            out.append(("und", 0.0))
            continue
        held, score = Counter(grams(text)), {}
        for label in sorted(seen):
            total = sum(counts[label].values()) + smoothing * buckets
            score[label] = math.log(seen[label] / sum(seen.values())) + sum(
                n * math.log((counts[label][b] + smoothing) / total) for b, n in held.items()
            )
        best = max(score, key=lambda x: (score[x], x))
        out.append((best, 1 / sum(math.exp(v - score[best]) for v in score.values())))
    return out

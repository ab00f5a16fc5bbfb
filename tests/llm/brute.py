"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SPACE = r"[^\x20\x09-\x0D]+"
MARKS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text, pattern=SPACE, lower=False):
    return re.findall(pattern, (text or "").translate(LOWER) if lower else text or "")


def repeats(rows, size=20):
    """doc_id, n_words, n_removed, text left."""
    seen, out = set(), []
    for doc, text in sorted(rows, key=lambda r: r[0]):
        ws = words(text)
        gone = [False] * len(ws)
        for i in range(len(ws) - size + 1):
            key = tuple(ws[i:i + size])
            if key in seen:
                gone[i:i + size] = [True] * size
            seen.add(key)
        out.append((doc, len(ws), sum(gone), " ".join(w for w, g in zip(ws, gone) if not g)))
    return out


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def simhash(text):
    import xxhash

    ws = words(text, lower=True)
    shingles = [" ".join(ws[i:i + 3]) for i in range(len(ws) - 2)] if len(ws) >= 3 else ([" ".join(ws)] if ws else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, near):
    """Smallest index reachable of each value."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_duplicates(rows):
    prints = [simhash(t) for _, t in rows]
    root = classes(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[root[i]] = min(least.get(root[i], doc), doc)
    return [(doc, f"{prints[i]:016x}", least[root[i]]) for i, (doc, _) in enumerate(rows)]


def shingles(ws, size=5):
    return Counter(tuple(ws[i:i + size]) for i in range(max(1, len(ws) - size + 1))) if ws else Counter()


def likeness(a, b):
    top = sum((a & b).values())
    return top / (sum(a.values()) + sum(b.values()) - top)


def leaks(rows, items, threshold=0.8):
    """(doc, item) to start, words and similarity of the best window."""
    out = {}
    for item, text in items:
        own = words(text, MARKS, True)
        for doc, other in rows:
            ws = words(other, MARKS, True)
            n = min(len(own), len(ws))
            for s in range(len(ws) - n + 1 if n else 0):
                sim = likeness(shingles(ws[s:s + n]), shingles(own))
                if sim >= threshold - 1e-12 and sim > out.get((doc, item), (0, 0, -1))[2]:
                    out[doc, item] = (s, n, sim)
    return out


def edited(rows):
    rows = sorted(rows, key=lambda r: -r[0])
    out = []
    for i, (doc, text) in enumerate(rows):
        text, follow = text or "", rows[(i + 1) % len(rows)][1] or ""
        cut = len(text) // 3
        out.append((doc, text, text[:len(text) - cut] + follow[:cut], follow))
    return out


def jaccard(a, b):
    a, b = (set(shingles([w.lower() for w in words(t)])) for t in (a, b))
    return len(a & b) / len(a | b) if a | b else 1.0


def base_scores(rows):
    train = Counter()
    for doc, text in rows:
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            train.update(words(text, lower=True) + ["\n"])
    total, distinct = sum(train.values()), len(train)
    out = {}
    for doc, text in rows:
        ws = words(text, lower=True) + ["\n"]
        out[doc] = (len(ws), sum(w in train for w in ws), total, sum(math.log10((train[w] + 1) / (total + distinct + 1)) for w in ws))
    return out

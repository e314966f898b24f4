"""Plain Python versions of what the operators compute, for small inputs."""

import hashlib
import re
import zlib

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def shingle_set(text, size=5):
    words = WORD.findall(lowered(text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def components(rows, percent=75):
    """Smallest id reachable by links, per id; ids may hold None, which is the least."""
    sets = {d: shingle_set(t) for d, t in rows}
    ids = sorted(sets, key=lambda d: (d is not None, d))
    root = {d: d for d in ids}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y, key=ids.index)] = min(x, y, key=ids.index)
    return {d: (len(sets[d]), find(d)) for d in ids}


def repeated_bytes(rows, window=100):
    """doc_id -> (bytes, removed, spans, digest of the rest)."""
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        data = (text or "").encode()
        covered = np.zeros(len(data), dtype=bool)
        for at in range(len(data) - window + 1):
            piece = data[at : at + window]
            if piece in seen:
                covered[at : at + window] = True
            else:
                seen.add(piece)
        rest = np.frombuffer(data, np.uint8)[~covered].tobytes()
        spans = int(np.diff(covered.view(np.int8), prepend=0).clip(0).sum())
        out[doc] = (len(data), int(covered.sum()), spans, hashlib.sha256(rest).hexdigest())
    return out


def one_word_apart(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    short, long_ = sorted((a, b), key=len)
    return any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def kept_lines(rows, min_words=10):
    """doc_id -> text without the lines that an earlier line repeats."""
    earlier, out = [], {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        kept = []
        for line in (text or "").split("\n"):
            words = WORD.findall(lowered(line))
            gone = any(
                words == w or (min(len(words), len(w)) >= min_words and one_word_apart(words, w)) for w in earlier
            )
            if not words or not gone:
                kept.append(line)
            if words:
                earlier.append(words)
        out[doc] = "\n".join(kept)
    return out


def looped(doc, words):
    """The words of a text as the periodic-run query plants them."""
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def runs(words):
    """(start, length, period) of every periodic run, by start, then period."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(6, 4 * q):
                stretch = words[i : i + length]
                if not any(stretch[r:] == stretch[: length - r] for r in range(1, q)):
                    found.append((i, length, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def near(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long_ = sorted((a, b), key=len)
    return len(long_) - len(short) == 1 and any(long_[:i] + long_[i + 1 :] == short for i in range(len(long_)))


def variants(counts):
    """word -> (n, n_near, form, form_n, root)."""
    found = {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        form = min(others, key=lambda w: (-counts[w], w), default=None)
        form = form if form is not None and counts[form] >= 5 * n else None
        found[word] = (n, len(others), form)

    def root(word):
        return word if found[word][2] is None else root(found[word][2])

    return {w: (n, k, f, f and counts[f], root(w)) for w, (n, k, f) in found.items()}

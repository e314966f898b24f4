"""Vectorised hashing of many texts at once.

Texts are laid side by side in one byte buffer, so that words and shingles of a whole block of documents are found and
hashed by a few numpy passes.  Functions run inside Spark tasks on blocks of bounded size (see `blocks`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 2 << 20
BLOCK_ROWS = 4_096
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(n: int, seed: int = 0) -> np.ndarray:
    """`n` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed) * np.uint64(1_000_003)) * GOLDEN)


BYTE_VALUES = stream(256, 11)
POWER = np.uint64(0xD6E8FEB86659FD93)
SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[ord("A") : ord("Z") + 1] += 32


def powers(n: int) -> np.ndarray:
    """POWER ** 0 .. POWER ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, POWER, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts, at most `rows` and about `limit` bytes; a longer text is a block of its own."""
    start = size = 0
    for i, text in enumerate(texts):
        if i > start and (size + len(text) > limit or i - start >= rows):
            yield start, i
            start, size = i, 0
        size += len(text) + 1
    if start < len(texts):
        yield start, len(texts)


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every word of the texts in order, the words' number per text, and the words' byte lengths.

    Words are runs without the ASCII white space `[\\x20\\x09-\\x0D]`; with `lower`, A-Z count as a-z.
    """
    buffer = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        buffer = LOWERED[buffer]
    inside = ~SEPARATOR[buffer]
    edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0)))
    starts, ends = edges[::2], edges[1::2]
    lengths = ends - starts
    ends_of_texts = np.cumsum(np.array([len(t) + 1 for t in texts], dtype=np.int64))
    counts = np.diff(np.searchsorted(starts, ends_of_texts), prepend=0)
    if not len(starts):
        return np.empty(0, np.uint64), counts, lengths
    content = buffer[inside]
    first = np.cumsum(lengths) - lengths
    offsets = np.arange(len(content), dtype=np.int64) - np.repeat(first, lengths)
    with np.errstate(over="ignore"):
        sums = np.add.reduceat(BYTE_VALUES[content] * powers(int(lengths.max()))[offsets], first)
        return mix(sums + lengths.astype(np.uint64)), counts, lengths


def shingles(texts: list[bytes], size: int = 5, distinct: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text: (text index, 64-bit hash), sorted by both; all in order, if not `distinct`.

    A text with fewer words than `size` has its whole word sequence as one shingle; without words it has none.
    """
    words, counts, _ = word_hashes(texts)
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    first = np.cumsum(counts) - counts
    made = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    owner = np.repeat(np.arange(len(texts)), made)
    begin = np.repeat(first, made) + np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    width = np.minimum(counts, size)[owner]
    factors = stream(size, 23) | np.uint64(1)
    with np.errstate(over="ignore"):
        sums = width.astype(np.uint64)
        for k in range(size):
            at = np.minimum(begin + k, len(words) - 1)
            sums += np.where(k < width, mix(words[at] * factors[k]), np.uint64(0))
        hashes = mix(sums)
    if not distinct:
        return owner, hashes
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    keep = np.ones(len(owner), dtype=bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[keep], hashes[keep]

"""Periodic runs of words, found by minimizers on several scales.

A run is a stretch of consecutive words with smallest period q, at least four periods and six words long, that no
neighbouring word extends keeping the period.  For a scale w (a power of two) take the hashes of all w-word grams.  In a
run with w/2 < q <= w the grams at places that differ modulo q differ, and a gram stands again q words later; so the
least hash of a window of w/2 grams is found again exactly q words later, with no equal gram between.  Neighbouring
minimizers with equal hashes at such a distance are the seeds of a scale.  A seed is extended word by word to both
sides, so hashes never decide.  Periods up to SHORT are too short for this and are found by scans at that lag.

Texts of a block of documents lie side by side, each followed by a word that occurs nowhere else.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.llm.documents import sliced
from flowkit.llm.hashing import blocks, mix

LEAST_WORDS = 6
LEAST_PERIODS = 4
SHORT = 4
STEP = 64
RUNS = T.ArrayType(
    T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")]), False
)


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts as numbers, one barrier after each text, and where each text begins."""
    index: defaultdict[bytes, int] = defaultdict()
    index.default_factory = index.__len__
    sizes = np.array([len(words) + 1 for words in texts], dtype=np.int64)
    starts = np.cumsum(sizes) - sizes
    codes = np.empty(int(sizes.sum()), dtype=np.int64)
    for i, words in enumerate(texts):
        codes[starts[i] : starts[i] + len(words)] = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
        codes[starts[i] + len(words)] = -1 - i
    return codes, starts


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where stretches of true flags begin and end."""
    edges = np.flatnonzero(np.diff(flags.view(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _lag_runs(codes: np.ndarray, lag: int) -> np.ndarray:
    """(start, length, lag) of the stretches with this period, long enough for a run."""
    begin, end = _stretches(codes[lag:] == codes[:-lag])
    length = end - begin + lag
    long_enough = length >= max(LEAST_WORDS, LEAST_PERIODS * lag)
    begin, length = begin[long_enough], length[long_enough]
    return np.stack([begin, length, np.full(len(begin), lag)], axis=1)


def _over_window(values: np.ndarray, size: int, pick: np.ufunc) -> np.ndarray:
    """The least or largest of each window of `size` values, a power of two."""
    step = 1
    while step < size:
        values = pick(values[:-step], values[step:])
        step *= 2
    return values


def _seeds(grams: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of neighbouring equal minimizers of windows of `scale` / 2 grams, scale / 2 < distance <= scale."""
    window = scale // 2
    if len(grams) < 2 * window:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    least = _over_window(grams, window, np.minimum)
    padded = np.concatenate([np.zeros(window - 1, grams.dtype), least, np.zeros(window - 1, grams.dtype)])
    at = np.flatnonzero(_over_window(padded, window, np.maximum) == grams)
    order = np.argsort(grams[at], kind="stable")
    at = at[order]
    distance = np.diff(at)
    near = (np.diff(grams[at].view(np.int64)) == 0) & (distance > scale // 2) & (distance <= scale)
    return at[:-1][near], distance[near]


def _reach(codes: np.ndarray, at: int, lag: int, way: int) -> int:
    """How many places from `at` on, in one direction, hold the same word as the place `lag` words later."""
    reached, step = 0, STEP
    while True:
        if way > 0:
            a = at + reached
            n = min(step, len(codes) - lag - a)
            same = codes[a : a + n] == codes[a + lag : a + lag + n]
        else:
            b = at - reached + 1
            n = min(step, b)
            same = (codes[b - n : b] == codes[b - n + lag : b + lag])[::-1]
        if n <= 0:
            return reached
        first = int(np.argmin(same)) if not same.all() else n
        reached += first
        if first < n:
            return reached
        step *= 2


def _extended(codes: np.ndarray, places: np.ndarray, lags: np.ndarray) -> list[tuple[int, int, int]]:
    """The long enough stretches that hold a seed: a seed inside a stretch of its lag that was seen before is passed."""
    found = []
    last_lag = upto = -1
    for i in np.lexsort((places, lags)).tolist():
        at, lag = int(places[i]), int(lags[i])
        if lag == last_lag and at < upto:
            continue
        ahead = _reach(codes, at, lag, 1)
        last_lag, upto = lag, at + max(ahead, 1)
        if ahead == 0:
            continue
        begin = at - _reach(codes, at - 1, lag, -1) if at > 0 else at
        length = at + ahead - begin + lag
        if length >= max(LEAST_WORDS, LEAST_PERIODS * lag):
            found.append((begin, length, lag))
    return found


def _primes_of(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return [*found, n] if n > 1 else found


def _smallest(codes: np.ndarray, start: int, length: int, lag: int) -> bool:
    """No smaller period: with four periods or more a smaller one would divide `lag`."""
    stretch = codes[start : start + length]
    return not any((stretch[lag // p :] == stretch[: length - lag // p]).all() for p in _primes_of(lag))


def find_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text, a list of words: rows (start, length, period) by start, then period."""
    codes, starts = _numbered(texts)
    sizes = np.diff(starts, append=len(codes)) - 1
    found = [_lag_runs(codes, lag) for lag in range(1, SHORT + 1) if len(codes) > lag]
    with np.errstate(over="ignore"):
        grams, size, scale = mix(codes.view(np.uint64)), 1, 2 * SHORT
        places, owner = np.arange(len(codes)), np.repeat(np.arange(len(texts)), sizes + 1)
        while len(grams):
            # A run at this scale is longer than twice the scale; shorter texts are left out from here on.
            kept = (sizes > 2 * scale)[owner]
            if not kept.any():
                break
            if not kept.all():
                # The codes of the texts that stay lie side by side again; their grams are hashed anew.
                places, owner = places[kept], owner[kept]
                grams, size = mix(codes[places].view(np.uint64)), 1
            while size < scale:
                grams = mix(grams[:-size] * np.uint64(3) + mix(grams[size:] ^ np.uint64(size)))
                size *= 2
            at, lag = _seeds(grams, scale)
            if len(at):
                found.append(np.array(_extended(codes, places[at], lag), dtype=np.int64).reshape(-1, 3))
            owner, scale = owner[: len(places)], scale * 2
    runs = np.concatenate(found) if found else np.empty((0, 3), np.int64)
    runs = runs[[_smallest(codes, *r) for r in runs.tolist()]] if len(runs) else runs
    text = np.searchsorted(starts, runs[:, 0], side="right") - 1
    runs[:, 0] -= starts[text]
    order = np.lexsort((runs[:, 2], runs[:, 0], text))
    cuts = np.searchsorted(text[order], np.arange(len(texts) + 1))
    return [runs[order[a:b]] for a, b in zip(cuts, cuts[1:], strict=False)]


def kept_words(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words without what stands in a run after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [w for w, d in zip(words, np.cumsum(depth).tolist(), strict=False) if d == 0]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The columns of `docs` but `text`; `runs`, an array of (start, length, period) by start, then period; `text`, the
    words that are left when a run keeps its first period only, joined by one space.

    Words are separated by the ASCII white space characters and numbered from 0; a null text has none, and a text
    without words gets no runs and an empty text.  Rows are judged one by one, so repeated rows and shared or null ids
    do no harm; columns named `runs` or `text` are replaced; an empty table gives an empty one.  Memory grows with the
    longest single text, not with the table.
    """
    keep = [c for c in docs.columns if c not in ("text", "runs")]
    struct = pa.struct([pa.field(c, pa.int64(), False) for c in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            for a, b in blocks(texts):
                words = [t.split() for t in texts[a:b]]  # bytes split at ASCII white space only
                runs = find_runs(words)
                rows = np.concatenate(runs)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(r) for r in runs])]), pa.int32())
                structs = pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(rows[:, j])) for j in range(3)], fields=list(struct)
                )
                left = [b" ".join(kept_words(w, r)).decode() for w, r in zip(words, runs, strict=True)]
                columns = [batch.column(c).slice(a, b - a) for c in keep]
                columns += [pa.ListArray.from_arrays(offsets, structs), pa.array(left, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "runs", "text"])

    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("runs", RUNS), T.StructField("text", T.StringType())])
    return docs.select(*keep, "text").mapInArrow(run, schema)


def looped(docs: DataFrame) -> DataFrame:
    """`docs` with every tenth text turned periodic from some word on, as a check of the operator needs it.

    With h the crc32 of the decimal `doc_id`, g = floor(h / 10), n words and h % 10 = 0, a word i >= a = g % n becomes
    the word a + (i - a) % p of the text, where p = 1 + floor((n - a) / (3 + g % 8)).  Rows without an id, and texts
    without words, stay.
    """
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = docs.withColumn("__h", h).withColumn("__words", F.when(F.col("__h") % 10 == 0, words))
    rows = rows.withColumn("__n", F.size("__words").cast("long")).withColumn("__g", F.floor(F.col("__h") / 10))
    rows = rows.withColumn("__a", F.when(F.col("__n") > 0, F.col("__g") % F.col("__n")))
    rows = rows.withColumn("__p", 1 + F.floor((F.col("__n") - F.col("__a")) / (3 + F.col("__g") % 8)))
    times = F.ceil((F.col("__n") - F.col("__a")) / F.col("__p")).cast("int")
    head = F.slice("__words", F.lit(1), F.col("__a").cast("int"))
    unit = F.slice("__words", (F.col("__a") + 1).cast("int"), F.col("__p").cast("int"))
    made = F.slice(F.concat(head, F.flatten(F.array_repeat(unit, times))), F.lit(1), F.col("__n").cast("int"))
    text = F.when(F.col("__n") > 0, F.array_join(made, " ")).otherwise(F.col("text"))
    return rows.withColumn("text", text).select(*docs.columns)

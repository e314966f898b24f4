"""Substring deduplication over a sorted array of suffixes.

Every byte in a string of `WINDOW` bytes that also starts earlier is removed.  Sorting each suffix of a corpus would move
many times its size, so suffixes are first told apart by anchors.  A window's anchor is its least hashed gram; a run of
consecutive windows with one anchor is an extent, and equal windows lie at the same place of extents with the same gram.
So an extent whose gram is found nowhere else holds no repeat, one that equals an earlier extent is repeated as a whole,
and only the suffixes of the rest are sorted: as sequences of hashed tokens, range-partitioned by sampled splitters on
the leading tokens, sorted by multikey quicksort in their bucket, and compared with the suffix before them, which may
stand at the end of an earlier bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowkit.llm.documents import LEAST_ID, by_document, packed_texts, settled, sliced
from flowkit.llm.hashing import BYTE_VALUES, POWER, mix, powers

WINDOW = 100
GRAM = 48
TOKEN = 50
SEGMENT = 1 << 19
CHUNK_BYTES = 8 << 20
BLOCK_ROWS = 200_000
BUCKETS_PER_PARTITION = 4
SAMPLE_PER_BUCKET = 64
_FIELDS = (np.uint64, np.uint64, np.int64, np.uint32, np.uint32)
_FOUND = "doc long, start int, n int, whole boolean"


@cache
def _inverse_powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(pow(int(POWER), -1, 1 << 64)), dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


@cache
def _powers(n: int) -> np.ndarray:
    return powers(n)


class Hashed:
    """Prefix sums over a buffer that give the hash of any of its substrings."""

    def __init__(self, buffer: np.ndarray) -> None:
        size = 1 << max(20, (len(buffer) + 1).bit_length())
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(buffer) + 1, dtype=np.uint64)
            np.cumsum(BYTE_VALUES[buffer] * _powers(size)[: len(buffer)], out=self.sums[1:])
        self.inverse = _inverse_powers(size)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def all(self, width: int) -> np.ndarray:
        """Hashes of the substrings of `width` bytes at every place."""
        n = max(0, len(self.sums) - width)
        with np.errstate(over="ignore"):
            return mix((self.sums[width : width + n] - self.sums[:n]) * self.inverse[:n])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each `width` consecutive values."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    filled = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    filled[: len(values)] = values
    rows = filled.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(docs: list[int], texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts side by side in buffers of bounded size: buffer, and start, document and offset of each piece in it.

    A longer text is cut into pieces that overlap by `WINDOW` - 1 bytes, so that each window lies in one piece.
    """
    pieces: list[tuple[int, int, bytes]] = []
    size = 0
    for doc, text in zip(docs, texts, strict=True):
        for at in range(0, max(1, len(text) - WINDOW + 1), SEGMENT):
            piece = text[at : at + SEGMENT + WINDOW - 1]
            if len(piece) < WINDOW:
                continue
            if pieces and size + len(piece) > SEGMENT:
                yield _laid(pieces)
                pieces, size = [], 0
            pieces.append((doc, at, piece))
            size += len(piece)
    if pieces:
        yield _laid(pieces)


def _laid(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(p) for _, _, p in pieces])
    buffer = np.frombuffer(b"".join(p for _, _, p in pieces), dtype=np.uint8)
    return buffer, np.append(np.cumsum(sizes) - sizes, len(buffer)), np.array([d for d, _, _ in pieces]), np.array([o for _, o, _ in pieces])


def extents(docs: list[int], texts: list[bytes]) -> list[np.ndarray]:
    """The extents of the texts: gram hash, content hash, document, first window and number of windows."""
    found = []
    for buffer, starts, owners, offsets in segments(docs, texts):
        hashed = Hashed(buffer)
        grams = hashed.all(GRAM)
        key = (grams & ~np.uint64(0xFFFFFF)) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_least(key, WINDOW - GRAM + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
        piece = np.searchsorted(starts, np.arange(len(anchor)), side="right") - 1
        valid = np.arange(len(anchor)) + WINDOW <= starts[piece + 1]
        fresh = np.ones(len(anchor), dtype=bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
        begin = np.flatnonzero(fresh & valid)
        count = np.add.reduceat(valid.astype(np.int64), np.flatnonzero(fresh))[np.searchsorted(np.flatnonzero(fresh), begin)]
        content = hashed.of(begin, begin + count + WINDOW - 1)
        own = piece[begin]
        found.append((grams[anchor[begin]], content, owners[own], begin - starts[own] + offsets[own], count))
    if not found:
        return [np.empty(0, t) for t in _FIELDS]
    return [np.concatenate(x).astype(t) for x, t in zip(zip(*found, strict=True), _FIELDS, strict=True)]


def settle(gram: np.ndarray, content: np.ndarray, doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of extents by (gram, content, place), and for each in it: repeats an earlier one, shares its gram with
    another content.  Entries without windows (n = 0) stand for two contents."""
    order = np.lexsort((start, doc, content, gram))
    gram, content, doc, start, n = (x[order] for x in (gram, content, doc, start, n))
    new_gram = np.append(True, gram[1:] != gram[:-1])[: len(gram)]
    new_content = new_gram | np.append(True, content[1:] != content[:-1])[: len(gram)]
    same_place = np.append(False, (doc[1:] == doc[:-1]) & (start[1:] == start[:-1]))[: len(gram)]
    group = np.cumsum(new_gram) - 1
    contents = np.bincount(group, new_content + (n == 0) * 2.0)
    return order, ~new_content & ~same_place, contents[group] > 1


def merged(doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows, with those that adjoin in a document made one."""
    order = np.lexsort((start, doc))
    doc, start, n = doc[order], start[order].astype(np.int64), n[order].astype(np.int64)
    if not len(doc):
        return doc, start, n
    first = np.append(True, (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + n[:-1]))
    at = np.flatnonzero(first)
    return doc[at], start[at], np.add.reduceat(n, at)


def _pack(columns: list[np.ndarray]) -> bytes:
    planes = [np.ascontiguousarray(c.view(np.uint8).reshape(len(c), c.itemsize).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(planes))


def _unpack(packed: bytes, n: int, kinds: tuple[type, ...] = _FIELDS) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    out, at = [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        plane = np.frombuffer(raw, dtype=np.uint8, count=n * size, offset=at).reshape(size, n)
        out.append(np.ascontiguousarray(plane.T).view(kind).ravel())
        at += n * size
    return out


def _entries(docs: DataFrame, buckets: int) -> DataFrame:
    """Extents by gram range, packed, one entry per gram and chunk; what a chunk settles by itself goes along."""

    def rows(found: list[list[np.ndarray]]) -> pa.RecordBatch:
        gram, content, doc, start, n = (np.concatenate(x) for x in zip(*found, strict=True))
        order, repeated, shared = settle(gram, content, doc, start, n)
        gram, content, doc, start, n = (x[order] for x in (gram, content, doc, start, n))
        whole, open_ = merged(doc[repeated], start[repeated], n[repeated]), ~repeated & shared
        lone = ~repeated & ~shared
        marks = np.unique(gram[open_])
        none = np.zeros(len(marks))
        sent = [np.concatenate([a[lone], b.astype(a.dtype)]) for a, b in zip((gram, content, doc, start, n), (marks, none, none, none, none), strict=True)]
        by_gram = np.argsort(sent[0], kind="stable")
        sent = [x[by_gram] for x in sent]
        bucket = ((sent[0] >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        ends = np.append(cuts[1:], len(bucket))[: len(cuts)]
        out = [{"bucket": int(bucket[a]), "n": int(b - a), "whole": None, "packed": _pack([x[a:b] for x in sent])} for a, b in zip(cuts, ends, strict=True)]
        for flag, (d, s, k) in ((True, whole), (False, (doc[open_], start[open_], n[open_]))):
            zero = np.zeros(len(d), np.uint64)
            if len(d):
                columns = [zero, zero, d, s.astype(np.uint32), k.astype(np.uint32)]
                out.append({"bucket": int(d[0] + s[0]) % buckets, "n": len(d), "whole": flag, "packed": _pack(columns)})
        schema = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("whole", pa.bool_()), ("packed", pa.binary())])
        return pa.RecordBatch.from_pylist(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in sliced(batches):
            ids, texts = batch.column("doc_id").fill_null(LEAST_ID).to_pylist(), [t.encode() for t in batch.column("text").to_pylist()]
            found.append(extents(ids, texts))
            size += sum(map(len, texts))
            if size >= CHUNK_BYTES:
                yield rows(found)
                found, size = [], 0
        if found:
            yield rows(found)

    return docs.mapInArrow(run, "bucket int, n int, whole boolean, packed binary")


def _settled(entries: DataFrame) -> DataFrame:
    """Runs of windows that repeat as a whole, and those left open: doc, start, n, whole."""

    def run(table: pa.Table) -> pa.Table:
        parts, done = [], []
        for n, whole, packed in zip(*(table.column(c).to_pylist() for c in ("n", "whole", "packed")), strict=True):
            columns = _unpack(packed, n)
            if whole is None:
                parts.append(columns)
            else:
                done.append((columns[2], columns[3], columns[4], np.full(n, whole)))
        if parts:
            gram, content, doc, start, n = (np.concatenate(x) for x in zip(*parts, strict=True))
            order, repeated, shared = settle(gram, content, doc, start, n)
            doc, start, n = doc[order], start[order], n[order]
            chosen = (repeated | shared) & (n > 0)
            done.append((doc[chosen], start[chosen], n[chosen], repeated[chosen]))
        doc, start, n, whole = (np.concatenate(x) for x in zip(*done, strict=True))
        pa.default_memory_pool().release_unused()
        return pa.table({"doc": doc, "start": start.astype(np.int32), "n": n.astype(np.int32), "whole": whole})

    return entries.groupBy("bucket").applyInArrow(run, _FOUND)


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Blocks of open suffixes of packed texts: first and second token, doc, place."""
    unpress = zstandard.ZstdDecompressor()
    ready: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        ids, packed, runs = (batch.column(c) for c in ("doc", "packed", "runs"))
        for i in range(batch.num_rows):
            text = np.frombuffer(unpress.decompress(packed[i].as_py()), dtype=np.uint8)
            start, n = (runs[i].values.field(c).to_numpy().astype(np.int64) for c in (0, 1))
            for at in range(0, len(text), SEGMENT):
                inside = (start < at + SEGMENT) & (start + n > at)
                if not inside.any():
                    continue
                low, high = np.maximum(start[inside], at), np.minimum((start + n)[inside], at + SEGMENT)
                made = high - low
                places = np.unique(np.repeat(low - np.cumsum(made) + made, made) + np.arange(made.sum()))
                hashed = Hashed(text[at : at + SEGMENT + WINDOW])
                first, second = (hashed.of(places - at + t, places - at + t + TOKEN) for t in (0, TOKEN))
                ready.append((first.view(np.int64), second.view(np.int64), np.full(len(places), ids[i].as_py()), places))
                size += len(places)
                if size > BLOCK_ROWS:
                    yield [np.concatenate(x) for x in zip(*ready, strict=True)]
                    ready, size = [], 0
    if ready:
        yield [np.concatenate(x) for x in zip(*ready, strict=True)]


def _with_runs(texts: DataFrame, open_: DataFrame) -> DataFrame:
    runs = open_.groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    return texts.join(runs, "doc").select("doc", "packed", "runs")


def multikey_quicksort(keys: list[np.ndarray]) -> np.ndarray:
    """Order of the rows by the keys in turn: three-way partition on one key, equal rows by the next one."""
    order = np.arange(len(keys[0]))
    waiting = [(0, len(order), 0)]
    while waiting:
        low, high, depth = waiting.pop()
        if high - low < 2 or depth == len(keys):
            continue
        rows = order[low:high]
        values = keys[depth][rows]
        if high - low <= 4_096:
            order[low:high] = rows[np.lexsort([k[rows] for k in keys[:depth:-1]] + [values])]
            continue
        pivot = np.sort(values[:: max(1, len(values) // 63)])[len(values[:: max(1, len(values) // 63)]) // 2]
        less, more = values < pivot, values > pivot
        order[low:high] = np.concatenate([rows[less], rows[~less & ~more], rows[more]])
        a, b = low + int(less.sum()), high - int(more.sum())
        waiting += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


def _splitters(sample: np.ndarray, buckets: int) -> np.ndarray:
    """Rows of the sorted sample that cut it into `buckets` parts of the same size."""
    sample = sample[multikey_quicksort([sample[:, j] for j in range(sample.shape[1])])]
    return sample[[len(sample) * i // buckets for i in range(1, buckets)]] if len(sample) else sample


def bucket_of(keys: list[np.ndarray], splitters: np.ndarray) -> np.ndarray:
    """Number of splitters that are not above each row, compared key by key."""
    low, high = np.zeros(len(keys[0]), np.int64), np.full(len(keys[0]), len(splitters))
    tied = np.arange(len(keys[0]))
    for j, key in enumerate(keys):
        if not len(tied):
            break
        groups = low[tied] * (len(splitters) + 1) + high[tied]
        for g in np.unique(groups):
            rows = tied[groups == g]
            a, b = divmod(int(g), len(splitters) + 1)
            part = splitters[a:b, j]
            low[rows] = a + np.searchsorted(part, key[rows], side="left")
            high[rows] = a + np.searchsorted(part, key[rows], side="right")
        tied = tied[low[tied] < high[tied]]
    return high


def _repeated(texts: DataFrame, open_: DataFrame, share: int, buckets: int) -> DataFrame:
    """Runs of the open suffixes whose window is that of the suffix before them in the sorted array: doc, start, n.

    The splitters come from a sample of the open runs, `share` of 2 ** 20 of them by hash.
    """

    def list_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, second, doc, at in _tokens(batches):
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (first, second, doc, at)], names=["first", "second", "doc", "at"])

    few = open_.where(F.pmod(F.xxhash64("doc", "start"), F.lit(1 << 20)) < share)
    drawn = _with_runs(texts, few).mapInArrow(list_, "first long, second long, doc long, at long").toArrow()
    splitters = _splitters(np.stack([c.to_numpy() for c in drawn.columns], axis=1), buckets)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys in _tokens(batches):
            bucket = bucket_of(keys, splitters)
            order = np.lexsort((keys[0], bucket))
            bucket, keys = bucket[order], [k[order] for k in keys]
            cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            ends = np.append(cuts[1:], len(bucket))
            packed = [_pack([keys[0][a:b].view(np.uint64), keys[1][a:b].view(np.uint64), keys[2][a:b], keys[3][a:b].astype(np.uint32), np.empty(0, np.uint32)]) for a, b in zip(cuts, ends, strict=True)]
            columns = [pa.array(bucket[cuts].astype(np.int32)), pa.array((ends - cuts).astype(np.int32)), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n", "packed"])

    def compare(table: pa.Table) -> pa.Table:
        parts = [_unpack(p, n, _FIELDS[:4]) for p, n in zip(table.column("packed").to_pylist(), table.column("n").to_pylist(), strict=True)]
        first, second, doc, at = (np.concatenate(x) for x in zip(*parts, strict=True))
        keys = [first.view(np.int64), second.view(np.int64), doc, at.astype(np.int64)]
        order = multikey_quicksort(keys)
        first, second, doc, at = (k[order] for k in keys)
        equal = np.append(False, (first[1:] == first[:-1]) & (second[1:] == second[:-1]))
        d, s, n = merged(doc[equal], at[equal], np.ones(int(equal.sum()), dtype=np.int64))
        edge = [(first[0], second[0], doc[0], at[0]), (first[-1], second[-1], doc[-1], at[-1])]
        bucket = table.column("bucket")[0].as_py()
        return pa.table(
            {
                "bucket": pa.array([bucket] * (len(d) + 2), pa.int32()),
                "edge": pa.array([1, 2] + [0] * len(d), pa.int32()),
                "first": pa.array([e[0] for e in edge] + [None] * len(d), pa.int64()),
                "second": pa.array([e[1] for e in edge] + [None] * len(d), pa.int64()),
                "doc": pa.array(np.append([e[2] for e in edge], d).astype(np.int64)),
                "start": pa.array(np.append([e[3] for e in edge], s).astype(np.int32)),
                "n": pa.array(np.append([1, 1], n).astype(np.int32)),
            }
        )

    dealt = _with_runs(texts, open_).mapInArrow(deal, "bucket int, n int, packed binary")
    kinds = "bucket int, edge int, first long, second long, doc long, start int, n int"
    sorted_ = settled(dealt.groupBy("bucket").applyInArrow(compare, kinds), "suffixes")
    by_place = Window.orderBy("bucket", "edge")  # two rows per bucket
    edges = sorted_.where("edge > 0").withColumns({f"__{c}": F.lag(c).over(by_place) for c in ("first", "second")})
    crossing = edges.where("edge = 1 AND first = __first AND second = __second")
    return sorted_.where("edge = 0").select("doc", "start", "n").unionByName(crossing.select("doc", "start", "n"))


def repeated_runs(docs: DataFrame) -> DataFrame:
    """Runs of consecutive windows that also start earlier, in any order: doc, start (byte) and n (windows).

    `docs` has unique `doc_id` and `text` (see `documents.by_document`); a null id stands before all others.
    """
    buckets = BUCKETS_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = settled(_settled(_entries(docs, buckets)), "extents")
    open_ = found.where("NOT whole")
    rows = open_.agg(F.sum("n")).first()[0] or 0
    done = found.where("whole").select("doc", "start", "n")
    if not rows:
        return done
    share = int(min(1.0, SAMPLE_PER_BUCKET * buckets / rows * 4) * (1 << 20)) + 1
    return done.unionByName(_repeated(packed_texts(docs), open_, share, buckets))


def deduplicate(docs: DataFrame) -> DataFrame:
    """Each document without the bytes that a string of `WINDOW` bytes covers which also starts earlier.

    Earlier is a smaller `doc_id`, or the same one and an earlier byte; matches never cross documents, overlaps count
    and strings are judged on the input.  Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and `kept`
    (binary), one row per id and text; a null text is empty, a null id stands before all others, and different texts
    that share an id (or have none) follow each other by a hash of the text.
    """
    return by_document(docs, _deduplicate)


def _deduplicate(docs: DataFrame) -> DataFrame:
    runs = repeated_runs(docs).groupBy("doc").agg(F.collect_list(F.struct("start", "n")).alias("runs"))
    joined = packed_texts(docs).join(runs, "doc", "left").select("doc_id", "packed", "runs")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in batches:
            packed, runs = batch.column("packed"), batch.column("runs")
            out: dict[str, list] = {"n_bytes": [], "n_removed": [], "n_spans": [], "kept": []}
            begun = 0
            for i in range(batch.num_rows):
                text = unpress.decompress(packed[i].as_py())
                removed, spans, kept = 0, 0, text
                if runs[i].is_valid:
                    own = runs[i].values
                    start, n = (own.field(c).to_numpy().astype(np.int64) for c in (0, 1))
                    depth = np.zeros(len(text) + 1, dtype=np.int32)
                    np.add.at(depth, start, 1)
                    np.add.at(depth, start + n + WINDOW - 1, -1)
                    covered = np.cumsum(depth[:-1]) > 0
                    removed, spans = int(covered.sum()), int(np.diff(covered.view(np.int8), prepend=0).clip(0).sum())
                    kept = np.frombuffer(text, dtype=np.uint8)[~covered].tobytes()
                for name, value in zip(out, (len(text), removed, spans, kept), strict=True):
                    out[name].append(value)
                if i + 1 == batch.num_rows or sum(map(len, out["kept"])) > (8 << 20):
                    columns = [batch.column("doc_id").slice(begun, i + 1 - begun)]
                    columns += [pa.array(out[c], pa.int64()) for c in ("n_bytes", "n_removed", "n_spans")] + [pa.array(out["kept"], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *out])
                    begun, out = i + 1, {c: [] for c in out}

    return joined.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


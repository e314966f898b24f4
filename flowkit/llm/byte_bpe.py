"""Byte-level byte-pair encoding: all merges are replayed in rank order over a table of distinct words.

Tasks split texts into words and keep each chunk of documents as positions in the chunk's own word list.  The lists are
dealt to buckets by a hash of the word, so that every distinct word of the corpus is in one bucket.  In a bucket the
words lie side by side as byte tokens; an inverted index leads from the rank of a token pair to the positions where the
pair stands.  Ranks are taken in order, each merge is applied at all its positions, and only the pairs beside a merged
one are looked up anew.  The ids go back to the chunks and are laid out by the positions.

The vocabulary, bounded by its file, is broadcast; words and texts never are.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.llm.documents import bucket_count, sliced

CHUNK_BYTES = 24 << 20
REPLAY_BYTES = 1 << 20


@dataclass
class Ranks:
    """Tokens by id, and the rank (which is the id) of every pair of ids whose bytes together are a token."""

    pieces: list[bytes]
    whole: dict[bytes, int]
    single: np.ndarray
    merges: dict[int, int]
    keys: np.ndarray
    merged: np.ndarray


def load(path: str) -> Ranks:
    """The vocabulary of a rank file: a line holds a token in base64 and its rank."""
    with open(path, "rb") as f:
        whole = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}
    pieces = [b""] * (max(whole.values()) + 1)
    for piece, i in whole.items():
        pieces[i] = piece
    merges = {}
    for piece, i in whole.items():
        for cut in range(1, len(piece)):
            left, right = whole.get(piece[:cut]), whole.get(piece[cut:])
            if left is not None and right is not None:
                merges[left << 32 | right] = i
    keys = np.array(sorted(merges), dtype=np.int64)
    merged = np.array([merges[k] for k in keys.tolist()], dtype=np.int64)
    single = np.array([whole[bytes([b])] for b in range(256)], dtype=np.int64)
    return Ranks(pieces, whole, single, merges, keys, merged)


def _first_index(tokens: np.ndarray, last: np.ndarray, ranks: Ranks) -> dict[int, list[int]]:
    """Rank -> positions of the pairs of neighbouring tokens; a pair that begins at the end of a word is none."""
    if len(tokens) < 2 or not len(ranks.keys):
        return {}
    keys = tokens[:-1] << 32 | tokens[1:]
    place = np.minimum(np.searchsorted(ranks.keys, keys), len(ranks.keys) - 1)
    found = np.flatnonzero((ranks.keys[place] == keys) & ~last[:-1])
    rank = ranks.merged[place[found]]
    order = np.argsort(rank, kind="stable")
    rank, found = rank[order], found[order]
    cuts = [*np.flatnonzero(np.diff(rank, prepend=-1)).tolist(), len(rank)]
    return {int(rank[a]): found[a:b].tolist() for a, b in pairwise(cuts)}


def replay(words: Sequence[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words one after another, and how many each word has.

    A word that is a token is that token.  In any other word the pair of the least rank is merged, leftmost first, until
    no pair has a rank.  Words do not touch each other, so all are merged together, rank by rank.  A merge may make a
    pair of a lower rank than its own; the rest of its word then waits until that pair is merged.
    """
    whole = [ranks.whole.get(w) for w in words]
    rest = [w for w, i in zip(words, whole, strict=True) if i is None]
    sizes = np.fromiter(map(len, rest), dtype=np.int64, count=len(rest))
    ends = np.cumsum(sizes)
    tokens = ranks.single[np.frombuffer(b"".join(rest), dtype=np.uint8)]
    last = np.zeros(len(tokens), dtype=bool)
    last[ends[sizes > 0] - 1] = True
    merges, starts = ranks.merges, None
    index = _first_index(tokens, last, ranks)
    after = np.where(last, -1, np.arange(1, len(tokens) + 1)).tolist()
    before = np.where(np.concatenate([[True], last[:-1]]), -1, np.arange(-1, len(tokens) - 1)).tolist() if len(tokens) else []
    tok = tokens.tolist()
    heap = list(index)
    heapq.heapify(heap)
    while heap:
        rank = heapq.heappop(heap)
        found, waiting, free = sorted(index.pop(rank)), [], 0
        for at in found:
            if at < free:
                waiting.append(at)
                continue
            right = after[at]
            if right < 0 or tok[at] < 0 or merges.get(tok[at] << 32 | tok[right]) != rank:
                continue
            tok[at], tok[right] = rank, -1
            beyond = after[at] = after[right]
            made = []
            if beyond >= 0:
                before[beyond] = at
                if (new := merges.get(rank << 32 | tok[beyond])) is not None:
                    made.append((new, at))
            if (left := before[at]) >= 0 and (new := merges.get(tok[left] << 32 | rank)) is not None:
                made.append((new, left))
            for new, place in made:
                if new in index:
                    index[new].append(place)
                else:
                    index[new] = [place]
                    heapq.heappush(heap, new)
                if new < rank:
                    starts = ends.tolist() if starts is None else starts
                    free = starts[bisect_right(starts, at)]
        if waiting:
            index[rank] = waiting
            heapq.heappush(heap, rank)
    ids = np.array(tok, dtype=np.int64)
    alive = np.concatenate([[0], np.cumsum(ids >= 0)])
    counts = np.diff(alive[np.concatenate([[0], ends]).astype(np.int64)])
    return _with_whole(whole, ids[ids >= 0], counts)


def _with_whole(whole: list[int | None], ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in their order, those of words that are tokens put in."""
    known = np.array([-1 if i is None else i for i in whole], dtype=np.int64)
    sizes = np.ones(len(known), dtype=np.int64)
    sizes[known < 0] = counts
    token = np.repeat(known, sizes)
    token[token < 0] = ids
    return token.astype(np.uint32), sizes.astype(np.uint32)


def spelled(words: list[bytes], ranks: Ranks) -> tuple[np.ndarray, np.ndarray]:
    """`replay` over blocks of words, which bounds its lists; a longer word is a block of its own."""
    ids, sizes, start, held = [], [], 0, 0
    for i, word in enumerate([*words, b""]):
        if i == len(words) or (held and held + len(word) > REPLAY_BYTES):
            some = replay(words[start:i], ranks)
            ids.append(some[0])
            sizes.append(some[1])
            start, held = i, 0
        held += len(word)
    return np.concatenate(ids), np.concatenate(sizes)


def gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The stretches of `values` that begin at `starts`, one after another."""
    sizes = sizes.astype(np.int64)
    shift = starts - (np.cumsum(sizes) - sizes)
    return values[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(len(words).to_bytes(4, "little") + sizes + b"".join(words))


def _unpack_words(packed: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    ends = (np.cumsum(np.frombuffer(raw, dtype="<u4", count=n, offset=4), dtype=np.int64) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends, strict=False)]


def _sum(packed: bytes) -> bytes:
    return zlib.crc32(packed).to_bytes(4, "little")


def _chunks(docs: DataFrame, keep: list[str], pattern: str, buckets: int) -> DataFrame:
    """One row per chunk: the kept columns of its documents, their words as positions, and its word list by bucket.

    Words are numbered by how often they stand in the chunk, so that most positions are small.
    """
    kept = T.StructType([docs.schema[c] for c in keep])
    part = T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("packed", T.BinaryType())])
    fields = {"chunk": T.LongType(), "rows": T.ArrayType(kept), "counts": T.BinaryType(), "positions": T.BinaryType()}
    fields |= {"places": T.BinaryType(), "sum": T.LongType(), "words": T.ArrayType(part)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = regex.compile(pattern).findall
        number = TaskContext.get().partitionId() << 32
        rows: list[pa.RecordBatch] = []
        positions: list[np.ndarray] = []
        index: defaultdict[str, int] = defaultdict()
        index.default_factory = index.__len__
        size = 0

        def flush() -> pa.RecordBatch:
            values = np.concatenate(positions)
            order = np.argsort(-np.bincount(values, minlength=len(index)), kind="stable")
            place = np.empty(len(order), dtype=np.uint32)
            place[order] = np.arange(len(order), dtype=np.uint32)
            listed = list(index)
            words = [listed[i].encode() for i in order.tolist()]
            bucket = np.array([zlib.crc32(w) % buckets for w in words], dtype=np.int64)
            places = np.argsort(bucket, kind="stable")
            firsts = np.flatnonzero(np.diff(bucket[places], prepend=-1))
            cuts = [*firsts.tolist(), len(words)]
            packed = [_pack_words([words[i] for i in places[a:b].tolist()]) for a, b in pairwise(cuts)]
            table = pa.Table.from_batches(rows).combine_chunks()
            structs = pa.StructArray.from_arrays([c.combine_chunks() for c in table.columns], fields=list(table.schema))
            parts = pa.StructArray.from_arrays(
                [pa.array(bucket[places[firsts]], pa.int32()), pa.array(packed, pa.binary())], names=["bucket", "packed"]
            )
            columns = {
                "chunk": pa.array([number], pa.int64()),
                "rows": pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs),
                "counts": pa.array([_pack(np.array([len(p) for p in positions]))], pa.binary()),
                "positions": pa.array([_pack(place[values])], pa.binary()),
                "places": pa.array([_pack(places)], pa.binary()),
                "sum": pa.array([zlib.crc32(b"".join(map(_sum, packed)))], pa.int64()),
                "words": pa.ListArray.from_arrays(pa.array([0, len(parts)], pa.int32()), parts),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in sliced(batches):
            rows.append(batch.select(keep) if keep else batch.select(["text"]).slice(0, 0))
            held = []
            for text in batch.column("text").to_pylist():
                found = split(text or "")
                held.append(np.fromiter(map(index.__getitem__, found), dtype=np.uint32, count=len(found)))
                size += len(text or "") + 64
            positions.extend(held)
            if size >= CHUNK_BYTES:
                yield flush()
                number += 1
                rows.clear()
                positions.clear()
                index.clear()
                size = 0
        if positions:
            yield flush()

    schema = T.StructType([T.StructField(c, t) for c, t in fields.items()])
    return docs.select(*keep, "text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The columns of `docs` but `text`, and `ids`: its tokens as little-endian unsigned 32-bit integers (binary).

    `path` names a rank file, `pattern` how texts are split into words.  No special tokens are added or looked for.  A
    null or empty text has no ids; what the pattern leaves out has none either.  A column named `ids` is replaced, other
    columns and repeated rows stay, an empty table gives an empty one.

    Chunks of documents are shuffled once and read by the words and by the join.  They hold the rows of `docs` in the
    order they are read, which has to be the same if a lost task runs again, as in any table; stage frames that a
    shuffle made.  An id list that does not fit its chunk ends the job.  A bucket gets its share of every chunk's words
    and there are as many buckets as the input has parts of fixed size, so none grows with the corpus.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(load(path))
    keep = [c for c in docs.columns if c not in ("text", "ids")] or ["__none"]
    docs = docs.withColumn("__none", F.lit(0)) if keep == ["__none"] else docs
    buckets = bucket_count(docs)
    chunks = _chunks(docs, keep, pattern, buckets).repartition(buckets, "chunk")

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, own in zip(batch.column("chunk").to_pylist(), batch.column("words"), strict=True):
                parts = own.values
                columns = [pa.array([chunk] * len(parts), pa.int64()), parts.field("bucket"), parts.field("packed")]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "packed"])

    def spell(table: pa.Table) -> pa.Table:
        index: defaultdict[bytes, int] = defaultdict()
        index.default_factory = index.__len__
        packed = table.column("packed").to_pylist()
        places = [np.array([index[w] for w in _unpack_words(p)], dtype=np.int64) for p in packed]
        ids, sizes = spelled(list(index), ranks.value)
        starts = np.cumsum(sizes, dtype=np.int64) - sizes
        made = {
            "sizes": [_pack(sizes[p]) for p in places],
            "ids": [_pack(gathered(ids, starts[p], sizes[p])) for p in places],
            "sum": [_sum(p) for p in packed],
        }
        own = {c: table.column(c) for c in ("chunk", "bucket")}
        return pa.table(own | {c: pa.array(v, pa.binary()) for c, v in made.items()})

    dealt = chunks.mapInArrow(lists, "chunk long, bucket int, packed binary")
    found = dealt.groupBy("bucket").applyInArrow(spell, "chunk long, bucket int, sizes binary, ids binary, sum binary")
    found = found.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "sizes", "ids", "sum")).alias("spelled"))
    joined = chunks.join(found, "chunk", "left")  # all columns, so that both sides read one exchange

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                yield from _laid_out(row, keep)

    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("ids", T.BinaryType())])
    return joined.mapInArrow(assemble, schema).drop("__none")


def _laid_out(row: dict[str, pa.Scalar], keep: list[str]) -> Iterator[pa.RecordBatch]:
    """The documents of a chunk with their ids, a few at a time."""
    lists = sorted(row["spelled"].as_py() or [], key=lambda s: s["bucket"])
    places = _unpack(row["places"].as_py()).astype(np.int64)
    listed = np.concatenate([_unpack(s["sizes"]) for s in lists] or [np.empty(0, np.uint32)]).astype(np.int64)
    ids = np.concatenate([_unpack(s["ids"]) for s in lists] or [np.empty(0, np.uint32)])
    if len(listed) != len(places) or zlib.crc32(b"".join(s["sum"] for s in lists)) != row["sum"].as_py():
        raise ValueError("the ids of a chunk do not fit its words")
    sizes, starts = np.empty_like(listed), np.empty_like(listed)
    sizes[places], starts[places] = listed, np.cumsum(listed) - listed
    positions = _unpack(row["positions"].as_py())
    ends = np.concatenate([[0], np.cumsum(_unpack(row["counts"].as_py()), dtype=np.int64)])
    others = row["rows"].values
    for a in range(0, len(ends) - 1, 256):
        b = min(a + 256, len(ends) - 1)
        words = positions[ends[a] : ends[b]]
        own = gathered(ids, starts[words], sizes[words])
        upto = np.concatenate([[0], np.cumsum(sizes[words])])[ends[a : b + 1] - ends[a]]
        offsets = pa.py_buffer((upto * 4).astype(np.int32).tobytes())
        binary = pa.Array.from_buffers(pa.binary(), b - a, [None, offsets, pa.py_buffer(own.astype("<u4").tobytes())])
        columns = [others.field(j).slice(a, b - a) for j in range(len(keep))]
        yield pa.RecordBatch.from_arrays([*columns, binary], names=[*keep, "ids"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of `encoded` but `ids`, and `content`: the bytes of the tokens joined (binary, may be no UTF-8).

    NULL ids give no bytes; a column named `content` is replaced.  An id that is no token ends the job.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(load(path).pieces)
    keep = [c for c in encoded.columns if c not in ("content", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = np.array([len(p) for p in shared.value], dtype=np.int64)
        starts, content = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(shared.value), dtype=np.uint8)
        for batch in sliced(batches, 64):
            made = []
            for ids in batch.column("ids").to_pylist():
                tokens = np.frombuffer(ids or b"", dtype="<u4")
                made.append(gathered(content, starts[tokens], sizes[tokens]).tobytes())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(made, pa.binary())], names=[*keep, "content"])

    schema = T.StructType([*[encoded.schema[c] for c in keep], T.StructField("content", T.BinaryType())])
    return encoded.select(*keep, "ids").mapInArrow(run, schema)

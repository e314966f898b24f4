"""Byte-pair encoding and decoding with a table of distinct words.

Texts are split into words in Spark tasks.  A task numbers the distinct words of each chunk of documents and keeps the
documents as word positions.  Words are dealt to buckets by hash, each distinct word of a bucket is encoded once, and its
ids go back to the chunks that hold it, where they are joined to the positions.  Decoding joins ids with the pieces of
the vocabulary.  The vocabulary, bounded by its file, is broadcast; words and texts never are.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.llm.documents import bucket_count, sliced


# Fixed by the file format: how byte-level BPE splits a text into words.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
CHUNK_BYTES = 32 << 20
LONG_WORD = 48


@dataclass
class Vocabulary:
    """Ids of the 256 single bytes, merges as (left, right) -> (rank, merged), bytes of each id, and added tokens."""

    single: list[int]
    merges: dict[tuple[int, int], tuple[int, int]]
    pieces: list[bytes]
    added: dict[str, int]


@cache
def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte: itself if printable in Latin-1, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def load(path: str) -> Vocabulary:
    """The vocabulary of a byte-level BPE file in the JSON format of the tokenizers library."""
    with open(path, encoding="utf-8") as f:
        data = json.load(f)
    ids, letters = data["model"]["vocab"], byte_letters()
    added = {t["content"]: t["id"] for t in data["added_tokens"]}
    pieces = [b""] * (max([*ids.values(), *added.values()]) + 1)
    for piece, i in ids.items():
        pieces[i] = bytes(letters[c] for c in piece)
    for content, i in added.items():
        pieces[i] = content.encode()
    single = [0] * 256
    for letter, b in letters.items():
        single[b] = ids[letter]
    merges = {}
    for rank, pair in enumerate(data["model"]["merges"]):
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merges.setdefault((ids[left], ids[right]), (rank, ids[left + right]))
    return Vocabulary(single, merges, pieces, added)


def words_of(text: str, added: regex.Pattern | None) -> list[str]:
    """The words of a text in order; an added token is a word of its own."""
    if added is None or not added.search(text):
        return WORD.findall(text)
    return [w for i, part in enumerate(added.split(text)) for w in ([part] if i % 2 else WORD.findall(part))]


def encode_word(word: bytes, vocabulary: Vocabulary) -> list[int]:
    """Ids of one word: the pair of the least rank is merged, leftmost first, until none is left."""
    merges = vocabulary.merges
    ids = [vocabulary.single[b] for b in word]
    if len(ids) > LONG_WORD:
        return _encode_long(ids, merges)
    while len(ids) > 1:
        found = [merges[p] for p in zip(ids, ids[1:], strict=False) if p in merges]
        if not found:
            break
        rank, merged = min(found)
        out, i, last = [], 0, len(ids) - 1
        while i <= last:
            if i < last and merges.get((ids[i], ids[i + 1])) == (rank, merged):
                out.append(merged)
                i += 2
            else:
                out.append(ids[i])
                i += 1
        ids = out
    return ids


def _encode_long(ids: list[int], merges: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """The same by a heap of pairs over linked ids, for words of any length."""
    n = len(ids)
    after, before = [*range(1, n), -1], [-1, *range(n - 1)]
    heap = [(*merges[p], i) for i, p in enumerate(zip(ids, ids[1:], strict=False)) if p in merges]
    heapq.heapify(heap)
    while heap:
        rank, merged, i = heapq.heappop(heap)
        j = after[i]
        if ids[i] < 0 or j < 0 or merges.get((ids[i], ids[j])) != (rank, merged):
            continue
        ids[i], ids[j], after[i] = merged, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left >= 0 and right >= 0 and (found := merges.get((ids[left], ids[right]))):
                heapq.heappush(heap, (*found, left))
    return [i for i in ids if i >= 0]


def _pack(numbers: np.ndarray) -> bytes:
    """Compressed 32-bit numbers, byte plane by byte plane."""
    planes = np.ascontiguousarray(numbers.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=9).compress(np.ascontiguousarray(planes).tobytes())


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), dtype=np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _pack_words(words: list[bytes]) -> bytes:
    sizes = np.array([len(w) for w in words], dtype="<u4").tobytes()
    return zstandard.ZstdCompressor(level=9).compress(len(words).to_bytes(4, "little") + sizes + b"".join(words))


def _sum(packed: bytes) -> bytes:
    return zlib.crc32(packed).to_bytes(4, "little")


def _unpack_words(packed: bytes) -> list[bytes]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    n = int.from_bytes(raw[:4], "little")
    ends = (np.cumsum(np.frombuffer(raw, dtype="<u4", count=n, offset=4)) + 4 + 4 * n).tolist()
    return [raw[a:b] for a, b in zip([4 + 4 * n, *ends], ends, strict=False)]


def _chunks(docs: DataFrame, keep: list[str], added: list[str], buckets: int) -> DataFrame:
    """One row per chunk: kept columns and word positions of its documents, and its distinct words by bucket."""
    kept = T.StructType([docs.schema[c] for c in keep])
    schema = T.StructType(
        [T.StructField("chunk", T.LongType()), T.StructField("rows", T.ArrayType(kept)), T.StructField("counts", T.BinaryType())]
        + [T.StructField(c, T.BinaryType()) for c in ("positions", "places")]
        + [T.StructField("sum", T.LongType())]
        + [T.StructField("words", T.ArrayType(T.StructType([T.StructField("bucket", T.IntegerType()), T.StructField("packed", T.BinaryType())])))]
    )
    packed_fields = [("counts", pa.binary()), ("positions", pa.binary()), ("places", pa.binary()), ("sum", pa.int64())]
    packed_fields.append(("words", pa.list_(pa.struct([("bucket", pa.int32()), ("packed", pa.binary())]))))
    pattern = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        index: dict[str, int] = {}
        rows, counts, positions, size = [], [], [], 0
        arrow: list[pa.Schema | None] = [None]

        def flush() -> pa.RecordBatch:
            words = [w.encode() for w in index]
            dealt: dict[int, list[int]] = {}
            for i in sorted(range(len(words)), key=words.__getitem__):
                dealt.setdefault(zlib.crc32(words[i]) % buckets, []).append(i)
            lists = [(b, dealt[b]) for b in sorted(dealt)]
            places = np.array([i for _, own in lists for i in own], dtype=np.uint32)
            packed = [{"bucket": b, "packed": _pack_words([words[i] for i in own])} for b, own in lists]
            sums = zlib.crc32(b"".join(_sum(p["packed"]) for p in packed))
            values = np.concatenate(positions) if positions else np.empty(0, np.uint32)
            row = [{"chunk": number, "rows": rows, "counts": _pack(np.array(counts, dtype=np.uint32)), "positions": _pack(values), "places": _pack(places), "sum": sums, "words": packed}]
            return pa.RecordBatch.from_pylist(row, schema=arrow[0])

        for batch in sliced(batches):
            arrow[0] = arrow[0] or pa.schema([("chunk", pa.int64()), ("rows", pa.list_(pa.struct([batch.schema.field(c) for c in keep]))), *packed_fields])
            for other, text in zip(batch.select(keep).to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = words_of(text or "", pattern)
                positions.append(np.array([index.setdefault(w, len(index)) for w in found], dtype=np.uint32))
                counts.append(len(found))
                rows.append(other)
                size += len(text or "") + 64
                if size >= CHUNK_BYTES:
                    yield flush()
                    number += 1
                    index, rows, counts, positions, size = {}, [], [], [], 0
        if rows:
            yield flush()

    return docs.select(*keep, "text").mapInArrow(run, schema)


def encode(docs: DataFrame, path: str) -> DataFrame:
    """The columns of `docs` but `text`, and `ids`: its tokens as little-endian unsigned 32-bit integers (binary).

    A null or empty text has no ids; an added token in a text is encoded as such, and nothing is added.  A column named
    `ids` is replaced; repeated rows stay.  A bucket holds the distinct words of all chunks with one remainder of their
    hash; there are as many as the input has parts of fixed size, so none grows with the corpus.  Chunks are shuffled
    once and read by the words and by the join.  They hold the rows of `docs` in the order they are read, which has to be
    the same if a lost task runs again, as in any table; stage frames that a shuffle made.  An id list that does not fit
    its chunk ends the job.
    """
    spark = docs.sparkSession
    vocabulary = load(path)
    shared = spark.sparkContext.broadcast(vocabulary)
    keep = [c for c in docs.columns if c not in ("text", "ids")]
    buckets = bucket_count(docs)
    chunks = _chunks(docs, keep, list(vocabulary.added), buckets).repartition(buckets, "chunk")

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, lists in zip(batch.column("chunk").to_pylist(), batch.column("words"), strict=True):
                own = lists.values
                columns = [pa.array([chunk] * len(own), pa.int64()), own.field("bucket"), own.field("packed")]
                yield pa.RecordBatch.from_arrays(columns, names=["chunk", "bucket", "packed"])

    def spell(table: pa.Table) -> pa.Table:
        vocabulary = shared.value
        known: dict[bytes, list[int]] = {w.encode(): [i] for w, i in vocabulary.added.items()}
        out = []
        for packed in table.column("packed").to_pylist():
            words = _unpack_words(packed)
            spelled = []
            for word in words:
                if (ids := known.get(word)) is None:
                    ids = known[word] = encode_word(word, vocabulary)
                spelled.append(ids)
            sizes = np.fromiter(map(len, spelled), dtype=np.uint32, count=len(spelled))
            flat = np.fromiter((i for ids in spelled for i in ids), dtype=np.uint32, count=int(sizes.sum()))
            out.append({"sizes": _pack(sizes), "ids": _pack(flat), "sum": _sum(packed)})
        spelt = pa.Table.from_pylist(out, schema=pa.schema([("sizes", pa.binary()), ("ids", pa.binary()), ("sum", pa.binary())]))
        return pa.table({c: (table if c in ("chunk", "bucket") else spelt).column(c) for c in ("chunk", "bucket", "sizes", "ids", "sum")})

    dealt = chunks.mapInArrow(words, "chunk long, bucket int, packed binary")
    spelled = dealt.groupBy("bucket").applyInArrow(spell, "chunk long, bucket int, sizes binary, ids binary, sum binary")
    spelled = spelled.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "sizes", "ids", "sum")).alias("spelled"))
    joined = chunks.join(spelled, "chunk", "left")  # all columns, so that both sides read one exchange

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                lists = sorted(row["spelled"].as_py() or [], key=lambda s: s["bucket"])
                places = _unpack(row["places"].as_py())
                by_word: list[bytes] = [b""] * len(places)
                at = 0
                for part in lists:
                    ends = np.cumsum(_unpack(part["sizes"]), dtype=np.int64) * 4
                    raw = _unpack(part["ids"]).tobytes()
                    for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False):
                        by_word[places[at]] = raw[a:b]
                        at += 1
                if at != len(places) or zlib.crc32(b"".join(s["sum"] for s in lists)) != row["sum"].as_py():
                    raise ValueError("the ids of a chunk do not fit its words")
                positions = _unpack(row["positions"].as_py())
                ends = np.cumsum(_unpack(row["counts"].as_py()), dtype=np.int64).tolist()
                others = row["rows"].values
                for a in range(0, len(ends), 256):
                    some = range(a, min(a + 256, len(ends)))
                    ids = [b"".join([by_word[p] for p in positions[ends[d - 1] if d else 0 : ends[d]].tolist()]) for d in some]
                    columns = [others.field(j).slice(a, len(some)) for j in range(len(keep))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names=[*keep, "ids"])

    schema = T.StructType([*[docs.schema[c] for c in keep], T.StructField("ids", T.BinaryType())])
    return joined.mapInArrow(assemble, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """The columns of `encoded` but `ids`, and `text`: the pieces of the ids joined, bytes that are no UTF-8 replaced.

    Added tokens are spelled out.  NULL ids give an empty text; a column named `text` is replaced.
    """
    shared = encoded.sparkSession.sparkContext.broadcast(load(path).pieces)
    keep = [c for c in encoded.columns if c not in ("text", "ids")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in sliced(batches):
            texts = [
                b"".join([pieces[i] for i in np.frombuffer(ids or b"", dtype="<u4").tolist()]).decode("utf-8", "replace")
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    return encoded.select(*keep, "ids").mapInArrow(run, T.StructType([*[encoded.schema[c] for c in keep], T.StructField("text", T.StringType())]))

"""Document fingerprints by one-permutation MinHash.

Shingles are hashed once; the high bits of a hash choose its bin and each bin keeps its least hash.  An empty bin takes
the value of a random other bin, the same for all documents (optimal densification).  A fingerprint stores the low-order
bits of each bin; the share of equal bins, corrected for chance matches, estimates the Jaccard similarity.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowkit.llm.documents import sliced
from flowkit.llm.hashing import blocks, mix, shingles, stream

BINS = 256
BITS = 8
SHINGLE = 5
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_LEAST = -(1 << 63)


@cache
def donors(bins: int) -> np.ndarray:
    """For each bin, the order in which an empty one asks the others."""
    return np.argsort(stream(bins * bins, 41).reshape(bins, bins), axis=1)


def sketches(texts: list[bytes], bins: int = BINS, bits: int = BITS, size: int = SHINGLE) -> list[bytes]:
    """Packed fingerprint of each text; b"" for a text without words.  `bins` is a power of two, `bits` 1 to 8."""
    out: list[bytes] = []
    for a, b in blocks(texts, rows=1_024):
        owner, hashes = shingles(texts[a:b], size, distinct=False)
        least = np.full((b - a) * bins, EMPTY)
        slot = owner * bins + (hashes >> np.uint64(65 - bins.bit_length())).astype(np.int64)
        np.minimum.at(least, slot, hashes)
        least = least.reshape(b - a, bins)
        filled = least != EMPTY
        row, column = np.nonzero(~filled & filled.any(axis=1)[:, None])
        for turn in range(bins):
            if not len(row):
                break
            donor = donors(bins)[column, turn]
            found = filled[row, donor]
            least[row[found], column[found]] = least[row[found], donor[found]]
            row, column = row[~found], column[~found]
        low = (mix(least) & np.uint64((1 << bits) - 1)).astype(np.uint8)
        packed = low if bits == 8 else np.packbits(np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - bits :].reshape(b - a, -1), axis=1)
        out += [p.tobytes() if any_ else b"" for p, any_ in zip(packed, filled.any(axis=1), strict=True)]
    return out


def likeness(left: bytes, right: bytes, bits: int = BITS) -> float:
    """Estimated Jaccard similarity of two fingerprints, 0 to 1; two texts without words are alike."""
    if left == right:
        return 1.0
    if not left or not right:
        return 0.0
    a, b = np.frombuffer(left, np.uint8), np.frombuffer(right, np.uint8)
    if bits < 8:
        a, b = (np.unpackbits(x).reshape(-1, bits) for x in (a, b))
        equal = float((a == b).all(axis=1).mean())
    else:
        equal = float((a == b).mean())
    chance = 2.0**-bits
    return max(0.0, (equal - chance) / (1 - chance))


def fingerprint(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Adds `fingerprint` (hex, replaced if there) of `text`: "" for a text that is null or has no words."""
    docs = docs.drop("fingerprint")
    names = [*docs.columns, "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            made = sketches([(t or "").encode() for t in batch.column("text").to_pylist()], bins, bits)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([m.hex() for m in made])], names=names)

    return docs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema) + ", fingerprint string")


def compare_edited(docs: DataFrame, bins: int = BINS, bits: int = BITS) -> DataFrame:
    """Fingerprints of each text and of its edited text, in which the next document replaces the last half.

    The next document is the one before in the order of (`doc_id`, nulls first, text by hash), and the last one for
    the first; the last floor(n / 2) code points give way to as many, or all, of its first.  Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next, a row per input row; a null text counts
    as empty, and a table of one row is its own next document.

    Documents are dealt to ranges of ids, one per shuffle partition.  A range also gets the last document of the range
    before it, so texts move once.  (Runs: quantiles and the last id per range.)
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ids = rows.select(F.coalesce("doc_id", F.lit(_LEAST)).alias("key"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.unique(np.array(ids.approxQuantile("key", [i / ranges for i in range(1, ranges)], 0.2 / ranges), dtype=float)).astype(np.int64) if ranges > 1 else np.empty(0, np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(np.searchsorted(cuts, key, side="right"), pa.int32()), batch.column(0)], names=["range", "key"])

    lasts = ids.mapInArrow(place, "range int, key long").groupBy("range").agg(F.max("key").alias("last")).orderBy("range").collect()
    if not lasts:
        return spark.createDataFrame([], _COMPARED)
    follower = {lasts[i - 1]["last"]: lasts[i]["range"] for i in range(len(lasts))}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column(0).fill_null(_LEAST).to_numpy()
            own = np.searchsorted(cuts, key, side="right")
            carried = np.flatnonzero(np.isin(key, list(follower)))
            take = np.concatenate([np.arange(len(key)), carried])
            where = np.concatenate([own, [follower[k] for k in key[carried]]]).astype(np.int32)
            first = np.concatenate([np.ones(len(key)), np.zeros(len(carried))]).astype(np.int32)
            taken = batch.take(pa.array(take))
            yield pa.RecordBatch.from_arrays([pa.array(where), pa.array(first), *taken.columns], names=["range", "own", "doc_id", "text"])

    dealt = rows.mapInArrow(deal, "range int, own int, doc_id long, text string")
    dealt = dealt.repartition(ranges, "range").sortWithinPartitions("range", "own", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        range_, text_before, made_before = None, "", b""
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            for a, b in blocks([t.encode() for t in texts], rows=1_024):
                part = texts[a:b]
                made = sketches([t.encode() for t in part], bins, bits)
                edited, nexts = [], []
                for i, r in enumerate(batch.column("range").to_pylist()[a:b]):
                    if r != range_:
                        range_, text_before, made_before = r, "", b""
                    half = len(part[i]) // 2
                    edited.append((part[i][: len(part[i]) - half] + text_before[:half]).encode())
                    nexts.append(made_before)
                    text_before, made_before = part[i], made[i]
                changed = sketches(edited, bins, bits)
                keep = np.flatnonzero(batch.column("own").to_numpy()[a:b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a).take(pa.array(keep)),
                        pa.array([len(part[i]) for i in keep], pa.int64()),
                        pa.array([hashlib.sha256(edited[i]).hexdigest() for i in keep], pa.string()),
                        pa.array([made[i].hex() for i in keep], pa.string()),
                        pa.array([changed[i].hex() for i in keep], pa.string()),
                        pa.array([likeness(made[i], changed[i], bits) for i in keep], pa.float64()),
                        pa.array([likeness(made[i], nexts[i], bits) for i in keep], pa.float64()),
                    ],
                    names=[c.split()[0] for c in _COMPARED.split(", ")],
                )

    return dealt.mapInArrow(run, _COMPARED)


_COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)

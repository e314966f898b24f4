"""Similarity join of documents by the Jaccard similarity of their word shingles.

The global order of the shingles is cut into fragments (vertical partitioning).  Overlaps are counted per fragment and
summed per pair.  Three steps keep the pairs few without losing a link between different texts:

- Documents with equal sets are one class; one of them stands for it.
- A document with more than a quarter of its shingles found nowhere else has no partner.  Half of the fragments are
  counted for this, in packed form.
- Shingles of the rest are ordered by their number of documents.  Partners share one of the first shingles of both
  (prefix filter).  Documents that share one are first compared with a hub of the group; later rounds compare only
  documents of different components, so a group of near copies costs a few comparisons per document, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowkit.llm.documents import LEAST_ID, bucket_count, by_document, packed_texts, settled, sliced
from flowkit.llm.hashing import blocks, mix, shingles

PERCENT = 75
SHINGLE = 5
CHUNK_BYTES = 8 << 20
FRAGMENT_BITS = 2
LEADERS = 32
HUB_GAIN = 10
_SENT = "bucket int, chunk long, kind int, n int, packed binary"
_NONE = np.uint32(0xFFFFFFFF)


def _pack(columns: list[np.ndarray]) -> bytes:
    planes = [np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def _unpack(packed: bytes, n: int, kinds: tuple[str, ...]) -> list[np.ndarray]:
    raw, out, at = zstandard.ZstdDecompressor().decompress(packed), [], 0
    for kind in kinds:
        size = np.dtype(kind).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(kind).ravel())
        at += n * size
    return out


_INFO = ("i8", "u4", "u8", "u8", "u4")


def set_keys(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two 64-bit keys of each text's shingle set."""
    sizes = np.bincount(owner, minlength=n)
    keys = []
    for salt in (np.uint64(0x1234567), np.uint64(0x89ABCDEF)):
        with np.errstate(over="ignore"):
            running = np.append(np.uint64(0), np.cumsum(mix(hashes ^ salt), dtype=np.uint64))
            ends = np.cumsum(sizes)
            keys.append(mix(running[ends] - running[ends - sizes] + sizes.astype(np.uint64)))
    return sizes, keys[0], keys[1]


def _fragments(docs: DataFrame, buckets: int) -> DataFrame:
    """Per chunk of documents: what they are, and by bucket the shingles of the lower half of the order that only one
    document of the chunk has (kind 1), or several (owner `_NONE`)."""

    def rows(chunk: int, found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        ids, sizes, first, second = (np.concatenate([f[i] for f in found]) for i in range(4))
        base = np.cumsum([0] + [len(f[0]) for f in found[:-1]])
        owner = np.concatenate([f[4] + b for f, b in zip(found, base, strict=True)])
        hashes = np.concatenate([f[5] for f in found])
        same_set = np.unique(np.stack([first, second]), axis=1, return_inverse=True)[1].ravel()
        standing = np.zeros(len(ids), dtype=bool)
        standing[np.unique(same_set, return_index=True)[1]] = True
        half = (hashes < np.uint64(1 << 63)) & standing[owner]
        owner, hashes = owner[half], hashes[half] >> np.uint64(15)
        order = np.argsort(hashes, kind="stable")
        owner, hashes = owner[order], hashes[order]
        new = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
        times = np.bincount(np.cumsum(new) - 1) if len(hashes) else np.empty(0, int)
        owner = np.where(times > 1, _NONE, owner[new]).astype(np.uint32)
        hashes = hashes[new]
        lone = np.bincount(owner[owner != _NONE], minlength=len(ids)).astype(np.uint32)
        stand_in = np.zeros(int(same_set.max()) + 1 if len(same_set) else 0, dtype=np.int64)
        stand_in[same_set[standing]] = np.flatnonzero(standing)
        bucket = ((hashes >> np.uint64(24)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)
        cuts = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
        ends = np.append(cuts[1:], len(bucket)).astype(int)
        out = [{"bucket": int(bucket[a]), "chunk": chunk, "kind": 1, "n": int(b - a), "packed": _pack([hashes[a:b], owner[a:b]])} for a, b in zip(cuts, ends[: len(cuts)], strict=True)]
        info = [ids, sizes.astype(np.uint32), first, second, lone[stand_in[same_set]] if len(ids) else lone]
        link = stand_in[same_set].astype(np.uint32)
        out.append({"bucket": chunk % buckets, "chunk": chunk, "kind": 0, "n": len(ids), "packed": _pack([*info, link])})
        schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("kind", pa.int32()), ("n", pa.int32()), ("packed", pa.binary())])
        return pa.RecordBatch.from_pylist(out, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, found, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in sliced(batches):
            ids = batch.column("doc_id").fill_null(LEAST_ID).to_numpy()
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for a, b in blocks(texts):
                owner, hashes = shingles(texts[a:b], SHINGLE)
                found.append((ids[a:b], *set_keys(owner, hashes, b - a), owner, hashes))
                size += sum(map(len, texts[a:b]))
                if size >= CHUNK_BYTES:
                    yield rows(chunk, found)
                    chunk, found, size = chunk + 1, [], 0
        if found:
            yield rows(chunk, found)

    return docs.mapInArrow(run, _SENT)


def _told_apart(sent: DataFrame, percent: int) -> DataFrame:
    """Per document: doc, n_shingles, the two keys of its set, and whether it may have a partner with another set."""

    def count(table: pa.Table) -> pa.Table:
        columns = {c: table.column(c).to_pylist() for c in ("chunk", "kind", "n", "packed")}
        out: dict[str, list] = {"chunk": [], "kind": [], "n": [], "packed": []}
        hashes, owners, chunks = [], [], []
        for chunk, kind, n, packed in zip(*columns.values(), strict=True):
            if kind == 0:
                for name, value in zip(out, (chunk, 0, n, packed), strict=True):
                    out[name].append(value)
            else:
                h, o = _unpack(packed, n, ("u8", "u4"))
                hashes.append(h)
                owners.append(o)
                chunks.append(np.full(n, chunk))
        if hashes:
            h, o, c = (np.concatenate(x) for x in (hashes, owners, chunks))
            order = np.argsort(h, kind="stable")
            h, o, c = h[order], o[order], c[order]
            group = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
            several = np.bincount(group, 1.0 + (o == _NONE))[group] > 1
            c, o = c[several & (o != _NONE)], o[several & (o != _NONE)]
            for chunk in np.unique(c):
                own, credit = np.unique(o[c == chunk], return_counts=True)
                for name, value in zip(out, (int(chunk), 1, len(own), _pack([own, credit.astype(np.uint32)])), strict=True):
                    out[name].append(value)
        kinds = {"chunk": pa.int64(), "kind": pa.int32(), "n": pa.int32(), "packed": pa.binary()}
        return pa.table({c: pa.array(v, kinds[c]) for c, v in out.items()})

    def judge(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("kind", "n", "packed")), strict=True), key=lambda r: r[0])
        doc, size, first, second, lone, link = _unpack(rows[0][2], rows[0][1], (*_INFO, "u4"))
        credit = np.zeros(len(doc), dtype=np.int64)
        for _, n, packed in rows[1:]:
            own, times = _unpack(packed, n, ("u4", "u4"))
            credit[own] += times
        missing = lone.astype(np.int64) - credit[link]
        open_ = (size > 0) & (100 * missing <= (100 - percent) * size.astype(np.int64))
        return pa.table({"doc": doc, "n_shingles": size.astype(np.int64), "first": first.view(np.int64), "second": second.view(np.int64), "open": open_})

    counted = sent.groupBy("bucket").applyInArrow(count, "chunk long, kind int, n int, packed binary")
    return counted.groupBy("chunk").applyInArrow(judge, "doc long, n_shingles long, first long, second long, open boolean")


def _sets(texts: DataFrame) -> DataFrame:
    """The shingle set of each document: doc, n, hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress = zstandard.ZstdDecompressor()
        for batch in sliced(batches):
            texts = [unpress.decompress(p) for p in batch.column("packed").to_pylist()]
            for a, b in blocks(texts):
                owner, hashes = shingles(texts[a:b], SHINGLE)
                sizes = np.bincount(owner, minlength=b - a)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc").slice(a, b - a), pa.array(sizes), lists], names=["doc", "n", "hashes"])

    return texts.select("doc", "packed").mapInArrow(run, "doc long, n long, hashes array<long>")


def connect(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """`labels` (doc, comp) after joining the components that `edges` (a, b: components) link; comp is the least doc.

    Components take the least label of their neighbours and then the label of their label, until nothing changes.
    (Runs a few jobs a round; the rounds grow with the logarithm of the longest chain of links.)
    """
    both = settled(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    seen = settled(both.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), "labels")
    while True:
        of = seen.select(F.col("node").alias("b"), F.col("label").alias("near"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("near").alias("near"))
        lower = seen.join(near, "node").select("node", "label", F.least("label", "near").alias("low"))
        lower = settled(lower, "labels")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("far"))
        after = lower.join(jump, "low").select("node", F.col("far").alias("label"), (F.col("far") != F.col("label")).alias("moved"))
        after = settled(after, "labels")
        seen = after.select("node", "label")
        if after.where("moved").isEmpty():
            break
    moved = seen.select(F.col("node").alias("comp"), "label")
    return settled(labels.join(moved, "comp", "left").select("doc", F.coalesce("label", "comp").alias("comp")), "components")


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) with the similarity asked for: partial overlaps per fragment, summed per pair."""
    left = segments.select(F.col("doc").alias("x"), "fragment", F.col("hashes").alias("left"), F.col("n").alias("nx"))
    right = segments.select(F.col("doc").alias("y"), "fragment", F.col("hashes").alias("right"), F.col("n").alias("ny"))
    parts = pairs.select("x", "y").join(left, "x").join(right, ["y", "fragment"])
    parts = parts.select("x", "y", "nx", "ny", F.size(F.array_intersect("left", "right")).cast("long").alias("part"))
    sums = parts.groupBy("x", "y", "nx", "ny").agg(F.sum("part").alias("both"))
    return sums.where(100 * F.col("both") >= percent * (F.col("nx") + F.col("ny") - F.col("both"))).select("x", "y")


def components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Each document's shingle count and component: doc_id, n_shingles, component_id.

    Documents link when 100 * shared >= `percent` * all of their shingles; a component has the smallest id reachable by
    links.  A document without words is linked with nothing.  One row per id and text: a null text is empty, a null id
    stands before all others, and different texts that share an id (or have none) are documents of their own.  (Runs
    jobs for each round of comparisons.)
    """
    return by_document(docs, lambda rows: _components(rows, percent), ids=("doc_id", "component_id"))


def _components(docs: DataFrame, percent: int) -> DataFrame:
    buckets = bucket_count(docs)
    known = settled(_told_apart(_fragments(docs, buckets), percent), "sets")
    classes = known.where("n_shingles > 0").groupBy("first", "second").agg(F.min("doc").alias("stands"), F.max("open").alias("open"))
    classes = settled(classes, "classes")
    comps = _compare(packed_texts(docs), classes.where("open").select(F.col("stands").alias("doc")), percent)
    placed = classes.join(comps.withColumnRenamed("doc", "stands"), "stands", "left").select("first", "second", F.coalesce("comp", "stands").alias("comp"))
    found = known.join(placed, ["first", "second"], "left")
    real = lambda c: F.when(c != LEAST_ID, c)
    own = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "doc")).otherwise(F.col("doc"))
    return found.select(real(F.col("doc")).alias("doc_id"), "n_shingles", real(own).alias("component_id"))


def _compare(texts: DataFrame, open_: DataFrame, percent: int) -> DataFrame:
    """Components of the documents in `open_`: doc, comp, for those that still may have a partner."""
    sets = settled(_sets(texts.join(open_, "doc")), "shingles")
    each = sets.select("doc", "n", F.explode("hashes").alias("h"))
    shared = each.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    least = F.ceil(F.col("n") * percent / 100)
    ordered = each.join(shared, "h").groupBy("doc", "n").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).alias("order"))
    ordered = settled(ordered.where(F.size("order") >= least), "ordered")
    prefix = F.expr(f"slice(order, 1, cast(size(order) - ceil(n * {percent} / 100) + 1 as int))")
    postings = ordered.select("doc", "n", F.size("order").alias("m"), F.posexplode(prefix).alias("nth", "e"))
    place = (F.col("n") - F.col("m") + F.col("nth")).alias("place")
    postings = settled(_first_of_lists(postings.select("doc", "n", place, "e.df", "e.h")), "postings")
    fragment = F.shiftrightunsigned("e.h", 64 - FRAGMENT_BITS).cast("int")
    segments = ordered.select("doc", "n", F.explode("order").alias("e")).groupBy("doc", "n", fragment.alias("fragment"))
    segments = settled(segments.agg(F.collect_list("e.h").alias("hashes")), "segments")
    comps = settled(ordered.select("doc", F.col("doc").alias("comp")), "components")
    hubs = True
    while True:
        at = postings.join(comps, "doc")
        groups = at.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("h")
        at = settled(at.join(groups, "h"), "split")
        if at.isEmpty():
            return comps
        if hubs:
            pairs = settled(_with_hub(at, percent), "pairs")
            links = _link(pairs, segments, comps, percent)
            hubs = 0 < pairs.count() <= links.count() * HUB_GAIN
        else:
            leaders = _leaders(at)
            links = _link(settled(_with_leaders(at, leaders, percent), "pairs"), segments, comps, percent)
            postings = settled(at.join(leaders, "doc", "left_anti").select("doc", "n", "place", "h"), "postings")
        if not links.isEmpty():
            comps = connect(comps, links)


def _first_of_lists(postings: DataFrame) -> DataFrame:
    """The postings without shingles that the same documents have as an earlier one in the order.

    The first shingle that two documents share is the first of its list, so it stays.
    """
    lists = postings.groupBy("df", "h").agg(
        F.count(F.lit(1)).alias("size"), F.bit_xor(F.xxhash64("doc")).alias("one"), F.bit_xor(F.xxhash64("doc", F.lit(1))).alias("two")
    )
    kept = lists.where("size > 1").groupBy("size", "one", "two").agg(F.min(F.struct("df", "h")).alias("first"))
    return postings.join(kept.select("first.h"), "h").select("doc", "n", "place", "h")


def _may_link(percent: int) -> str:
    """Whether documents whose first shared shingle stands at `place` and `other` can share enough, by what is left."""
    return f"least(n - place, ny - other) >= ceil({percent} * (n + ny) / (100 + {percent}))"


def _with_hub(at: DataFrame, percent: int) -> DataFrame:
    """For each document the hub of another component with which it shares most of its first shingles: x, y."""
    firsts = at.groupBy("h", "comp").agg(F.min(F.struct("doc", "n", "place")).alias("hub"))
    nth = F.row_number().over(Window.partitionBy("h").orderBy("hub"))
    firsts = firsts.withColumn("nth", nth).where("nth <= 2")
    two = {f"hub{i}": F.max(F.when(F.col("nth") == i, F.struct("hub", "comp"))) for i in (1, 2)}
    hubs = firsts.groupBy("h").agg(*[c.alias(name) for name, c in two.items()])
    own = F.when(F.col("comp") != F.col("hub1.comp"), F.col("hub1.hub")).otherwise(F.col("hub2.hub"))
    chosen = at.join(hubs, "h").select(F.col("doc").alias("x"), "n", "place", own.alias("hub"))
    chosen = chosen.select("x", "n", "place", F.col("hub.doc").alias("y"), F.col("hub.n").alias("ny"), F.col("hub.place").alias("other"))
    counts = chosen.where(_may_link(percent)).groupBy("x", "y").agg(F.count(F.lit(1)).alias("times"))
    return counts.groupBy("x").agg(F.max(F.struct("times", "y")).alias("best")).select("x", "best.y")


def _leaders(at: DataFrame) -> DataFrame:
    """The next documents to compare with all others of their groups: of each group some, from the components with the
    fewest members in it, and none from the largest one."""
    times = at.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("times"))
    largest = times.groupBy("h").agg(F.max(F.struct("times", "comp")).alias("largest"))
    small = times.join(largest, "h").where("comp != largest.comp").select("h", "comp", "times")
    order = Window.partitionBy("h").orderBy("times", "comp", "doc")
    found = at.join(small, ["h", "comp"]).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= LEADERS)
    return settled(found.select("doc").distinct(), "leaders")


def _with_leaders(at: DataFrame, leaders: DataFrame, percent: int) -> DataFrame:
    """Pairs of a leader with a document of another component that may link: x, y."""
    led = at.join(leaders, "doc")
    led = led.select("h", F.col("doc").alias("y"), F.col("n").alias("ny"), F.col("place").alias("other"), F.col("comp").alias("to"))
    met = at.join(led, "h").where("comp != to").where(_may_link(percent))
    return met.select(F.greatest("doc", "y").alias("x"), F.least("doc", "y").alias("y")).distinct()


def _link(pairs: DataFrame, segments: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Links between components found among the pairs: a, b."""
    linked = _linked(pairs, segments, percent)
    linked = linked.join(comps.select(F.col("doc").alias("x"), F.col("comp").alias("a")), "x")
    linked = linked.join(comps.select(F.col("doc").alias("y"), F.col("comp").alias("b")), "y")
    return settled(linked.select("a", "b").where("a != b").distinct(), "links")

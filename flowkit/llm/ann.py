"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector is centred, rotated by a fixed random rotation and kept as the signs of its coordinates, with its residual
norm and the inner product between the rotated unit vector and its code.  From these the inner product with any query
is estimated without bias, with an error bound; only vectors whose bound reaches the query's k-th best score so far are
scored on the original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowkit.llm.documents import settled

FIT_ROWS = 2_000
BLOCK_ROWS = 32_768
QUERY_ROWS = 32_768
QUERY_STEP = 128
PAIRS = 1 << 16
BOUND = 3.5
SEED = 5
_RANKED = "query_id long, query_key long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Neither null nor zero, and without null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(dimension: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dimension, dimension)))
    return q * np.sign(np.diag(r))


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed signs, residual norms, and inner products of each rotated unit residual with its code."""
    residual = (vectors - centre) @ turn
    norms = np.linalg.norm(residual, axis=1)
    fit = np.abs(residual).sum(axis=1) / np.sqrt(vectors.shape[1])
    return np.packbits(residual > 0, axis=1), norms, np.divide(fit, norms, out=np.ones_like(norms), where=norms > 0)


def bounds(
    queries: np.ndarray, codes: np.ndarray, norms: np.ndarray, fits: np.ndarray, centre: np.ndarray, turn: np.ndarray
) -> np.ndarray:
    """Upper bound of the inner product of each query with each coded vector."""
    dimension = queries.shape[1]
    signs = np.unpackbits(codes, axis=1, count=dimension).astype(np.float32) * 2 - 1
    cosines = (queries @ turn).astype(np.float32) @ signs.T
    spread = np.sqrt(np.maximum(0, 1 - fits**2)) * BOUND / np.sqrt(max(1, dimension - 1))
    lengths = np.linalg.norm(queries, axis=1).astype(np.float32)
    cosines *= (norms / fits / np.sqrt(dimension)).astype(np.float32)
    cosines += lengths[:, None] * ((spread / fits + 1e-5) * norms).astype(np.float32)
    cosines += (queries @ centre + 1e-6 * lengths).astype(np.float32)[:, None]
    return cosines


def inner(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of the rows in double precision, summed in the order of the components."""
    total = np.zeros(len(left))
    for j in range(left.shape[1]):
        total += left[:, j] * right[:, j]
    return total


def best(owner: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k first rows per owner, by falling score, ties to the smaller id."""
    order = np.lexsort((ids, -scores, owner))
    sorted_owner = owner[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_owner, sorted_owner)
    return order[rank < k]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of a batch (id, vector, ...) for each length of vectors, with the vectors as a matrix."""
    sizes = pc.list_value_length(batch.column(1)).to_numpy(zero_copy_only=False)
    for dimension in np.unique(sizes).tolist():
        rows = batch.filter(pa.array(sizes == dimension))
        yield dimension, rows, rows.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _own(names: np.ndarray, points: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Whether a query and a vector are the same row: equal ids and equal components."""
    same = names[:, None] == ids[None, :]
    q, v = np.nonzero(same)
    same[q, v] = (points[q] == vectors[v]).all(axis=1)
    return same


def nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """The `k` largest inner products for each query row: query_id, rank, vec_id, score.

    `vectors` has `vec_id` and `embedding`; other columns are ignored.  Rows without an id, and vectors that are not
    `usable`, take no part.  Repeated rows, equal in id and vector, count as one; different vectors that share an id are
    all candidates, and each of them that is a query has ranks of its own and may find the others.  A query meets the
    vectors of its own length; those of another length are answered by themselves.  An empty table gives no rows.

    For each length a sample of about `FIT_ROWS` rows fits the centre and gives each query a first lower bound of its
    k-th best score.  Every row is coded, and every query block meets every block of codes: blocks have a fixed size, so
    a task's memory does not grow with the table, and rows are dealt by id and vector, so a frequent id spreads.  A
    block hands on k rows per query at most.  (Runs: the table of usable rows, counts per length, the samples.)
    """
    spark = vectors.sparkSession
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    kind = "float" if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else "double"
    rows = settled(rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>")).distinct(), "vectors")
    width = F.size("embedding")
    counts = rows.groupBy(width.alias("d")).agg(F.count(F.lit(1)).alias("n"), F.count_if(is_query).alias("asked")).collect()
    if not counts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def by_length(values: dict[int, int]) -> Column:
        return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[width]

    share = by_length({r["d"]: int(min(1.0, FIT_ROWS / r["n"]) * (1 << 20)) for r in counts})
    drawn = rows.where(F.pmod(F.xxhash64("vec_id", "embedding", F.lit(SEED)), F.lit(1 << 20)) < share)
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for dimension, part in (sample := drawn.limit(4 * FIT_ROWS * len(counts)).toPandas()).groupby(sample["embedding"].map(len)):
        known[dimension] = (part["vec_id"].to_numpy(), np.stack(part["embedding"].to_list()).astype(float))
    centres = {d: points.mean(axis=0) for d, (_, points) in known.items()}
    sampled, middle = spark.sparkContext.broadcast(known), spark.sparkContext.broadcast(centres)

    def frame(dimension: int) -> tuple[np.ndarray, np.ndarray]:
        return middle.value.get(dimension, np.zeros(dimension)), rotation(dimension)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frames: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for dimension, part, values in _by_length(batch):
                if dimension not in frames:
                    frames[dimension] = frame(dimension)
                codes, norms, fits = encode(values.astype(float), *frames[dimension])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dimension] * len(values), pa.int32()), part.column(0), _binary(values), _binary(codes), pa.array(norms), pa.array(fits), part.column(2)],
                    names=["d", "vec_id", "vector", "code", "norm", "fit", "blocks"],
                )

    def floor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dimension, part, values in _by_length(batch):
                ids, least = part.column(0).to_numpy(), np.full(len(values), -np.inf)
                known_ids, points = sampled.value.get(dimension, (np.empty(0, dtype=np.int64), np.empty((0, dimension))))
                for at in range(0, len(values) if len(points) >= k else 0, 512):
                    scores = np.where(ids[at : at + 512, None] == known_ids, -np.inf, values[at : at + 512].astype(float) @ points.T)
                    kth = np.partition(scores, -k, axis=1)[:, -k]
                    least[at : at + 512] = kth - 1e-9 * (1 + np.abs(kth))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dimension] * len(values), pa.int32()), part.column(0), part.column(3), _binary(values), pa.array(least), part.column(2)],
                    names=["d", "query_id", "query_key", "query", "least", "blocks"],
                )

    data_blocks = by_length({r["d"]: -(-r["n"] // BLOCK_ROWS) for r in counts})
    query_blocks = by_length({r["d"]: max(1, -(-r["asked"] // QUERY_ROWS)) for r in counts})
    # Each row goes to its own block, once for every block of the other side.
    place = F.xxhash64("vec_id", "embedding")
    coded = rows.select("vec_id", "embedding", F.struct(F.pmod(place, data_blocks).cast("int").alias("own"), query_blocks.alias("others")).alias("blocks"))
    coded = coded.mapInArrow(code, "d int, vec_id long, vector binary, code binary, norm double, fit double, blocks struct<own:int,others:int>")
    coded = coded.withColumn("db", F.col("blocks.own")).withColumn("qb", F.explode(F.sequence(F.lit(0), F.col("blocks.others") - 1))).drop("blocks")
    asked = rows.where(is_query).select(
        "vec_id", "embedding", F.struct(F.pmod(place, query_blocks).cast("int").alias("own"), data_blocks.alias("others")).alias("blocks"), place.alias("key")
    )
    asked = asked.mapInArrow(floor, "d int, query_id long, query_key long, query binary, least double, blocks struct<own:int,others:int>")
    asked = asked.withColumn("qb", F.col("blocks.own")).withColumn("db", F.explode(F.sequence(F.lit(0), F.col("blocks.others") - 1))).drop("blocks")
    stored = np.dtype("<f4" if kind == "float" else "<f8")

    def search(data: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        if not len(data) or not len(asked):
            return pd.DataFrame({c: [] for c in ("query_id", "query_key", "vec_id", "score")}).astype({"query_id": int, "query_key": int, "vec_id": int})
        dimension = int(data["d"].iloc[0])
        centre, turn = frame(dimension)
        vectors = np.frombuffer(b"".join(data["vector"]), dtype=stored).reshape(-1, dimension).astype(float)
        codes = np.frombuffer(b"".join(data["code"]), dtype=np.uint8).reshape(len(data), -1)
        ids, norms, fits = data["vec_id"].to_numpy(), data["norm"].to_numpy(), data["fit"].to_numpy()
        points = np.frombuffer(b"".join(asked["query"]), dtype=stored).reshape(-1, dimension).astype(float)
        names, keys, least = asked["query_id"].to_numpy(), asked["query_key"].to_numpy(), asked["least"].to_numpy()
        found = []
        for at in range(0, len(points), QUERY_STEP):
            own, part = names[at : at + QUERY_STEP], points[at : at + QUERY_STEP]
            reach = bounds(part, codes, norms, fits, centre, turn)
            missed = (reach < least[at : at + QUERY_STEP, None]) | _own(own, part, ids, vectors)
            chosen = np.flatnonzero(~missed.all(axis=0))
            near = part @ vectors[chosen].T
            near[missed[:, chosen]] = -np.inf
            floors = np.full(len(own), -np.inf)
            if len(chosen) > k:
                kth = np.partition(near, -k, axis=1)[:, -k]
                floors = kth - 1e-9 * (1 + np.abs(np.where(np.isfinite(kth), kth, 0)))
            q, v = np.nonzero((near >= floors[:, None]) & (near > -np.inf))
            v = chosen[v]
            scores = np.concatenate([inner(part[q[i : i + PAIRS]], vectors[v[i : i + PAIRS]]) for i in range(0, len(q), PAIRS)] or [np.empty(0)])
            top = best(q, ids[v], scores, k)
            found.append((own[q[top]], keys[at + q[top]], ids[v[top]], scores[top]))
        columns = (np.concatenate(x) for x in zip(*found, strict=True))
        return pd.DataFrame(dict(zip(("query_id", "query_key", "vec_id", "score"), columns, strict=True)))

    found = coded.groupBy("d", "qb", "db").cogroup(asked.groupBy("d", "qb", "db")).applyInPandas(search, _RANKED)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

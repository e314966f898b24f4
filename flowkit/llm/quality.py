"""Quality classifier: naive Bayes support vectors.

Features are indicators of hashed byte n-grams, and one of how often the text's n-grams repeat.  Each is scaled by the log ratio of its smoothed share among good and
among bad texts, rows are scaled by their number of features (`SPREAD` more, so that a few words alone decide little), and a linear model with hinge loss is fitted by dual coordinate
descent.  A logistic curve fitted on rows kept out of that turns margins into probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.llm.documents import sliced
from flowkit.llm.hashing import BYTE_VALUES, blocks, stream

GRAM = 3
FEATURE_BITS = 18
SAMPLE_ROWS = 6_000
EPOCHS = 12
COST = 1.0
SMOOTHING = 1.0
SPREAD = 200
REPEAT_LEVELS = 64
REPEAT_SCALE = 16.0
SIZE = (1 << FEATURE_BITS) + REPEAT_LEVELS
THRESHOLD = 0.7
SEED = 13


@dataclass
class Model:
    """Weight of each feature, bias, and the logistic curve from margin to score."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def features(texts: list[bytes], gram: int = GRAM, bits: int = FEATURE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashed n-grams of each text and its repeat level: (text index, feature), sorted by text.

    The repeat level, one of `REPEAT_LEVELS` features behind the hashed ones, counts quarters of log2(grams / distinct
    grams); a text without grams has no feature.  Grams do not cross texts.
    """
    buffer = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    made = np.maximum(0, sizes - gram + 1)
    owner = np.repeat(np.arange(len(texts)), made)
    if not len(owner):
        return owner, owner
    begin = np.repeat(np.cumsum(sizes) - sizes, made) + np.arange(len(owner)) - np.repeat(np.cumsum(made) - made, made)
    factors = stream(gram, 57) | np.uint64(1)
    total = np.zeros(len(owner), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            total += BYTE_VALUES[buffer[begin + k]] * factors[k]
    keys = np.sort(owner << bits | (total >> np.uint64(64 - bits)).astype(np.int64))
    keys = keys[np.append(True, keys[1:] != keys[:-1])]
    owner, feature = keys >> bits, keys & ((1 << bits) - 1)
    found = np.flatnonzero(made)
    level = 4 * np.log2(made[found] / np.bincount(owner, minlength=len(texts))[found])
    level = np.minimum(level.astype(np.int64), REPEAT_LEVELS - 1) + (1 << bits)
    ends = np.searchsorted(owner, found, side="right")
    return np.insert(owner, ends, found), np.insert(feature, ends, level)


def descend(rows: list[np.ndarray], labels: np.ndarray, scale: np.ndarray, epochs: int, cost: float, seed: int) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge-loss model of `labels` (-1, 1) by dual coordinate descent."""
    weights, bias = np.zeros(len(scale)), 0.0
    values = [scale[r] / np.sqrt(SPREAD + len(r)) for r in rows]
    squares = np.array([v @ v + 1.0 for v in values])
    alphas = np.zeros(len(rows))
    turns = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in turns.permutation(len(rows)):
            margin = labels[i] * (weights[rows[i]] @ values[i] + bias)
            moved = min(max(alphas[i] - (margin - 1) / squares[i], 0.0), cost)
            step = (moved - alphas[i]) * labels[i]
            if step:
                alphas[i] = moved
                weights[rows[i]] += step * values[i]
                bias += step
    return weights * scale, bias


def calibrate(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve from margins to labels (0, 1), by Newton steps on smoothed targets."""
    good, bad = labels.sum(), len(labels) - labels.sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    x = np.column_stack([margins, np.ones_like(margins)])
    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2), x.T @ (p - target) + 1e-3 * at)
        at = at - np.clip(step, -2, 2)
    return float(at[0]), float(at[1])


def fit(rows: list[np.ndarray], labels: np.ndarray) -> Model:
    """A model of rows of distinct features with labels 0 and 1; every fifth row only calibrates."""
    prior = (labels.sum() + 1) / (len(labels) + 2)
    if len(np.unique(labels)) < 2:
        return Model(np.zeros(SIZE), 0.0, 0.0, float(np.log(prior / (1 - prior))))
    kept = np.arange(len(rows)) % 5 == 4
    if len(np.unique(labels[kept])) < 2 or len(np.unique(labels[~kept])) < 2:
        kept[:] = True
        train = np.ones(len(rows), dtype=bool)
    else:
        train = ~kept
    counts = [np.full(SIZE, SMOOTHING), np.full(SIZE, SMOOTHING)]
    for i in np.flatnonzero(train):
        counts[int(labels[i])][rows[i]] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    ratio[1 << FEATURE_BITS :] *= REPEAT_SCALE
    chosen = [rows[i] for i in np.flatnonzero(train)]
    weights, bias = descend(chosen, 2.0 * labels[train] - 1, ratio, EPOCHS, COST, SEED)
    margins = np.array([weights[rows[i]].sum() / np.sqrt(SPREAD + len(rows[i])) + bias for i in np.flatnonzero(kept)])
    slope, shift = calibrate(margins, labels[kept])
    return Model(weights, bias, slope, shift)


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of the documents that `labels` (doc_id, quality 0 or 1) marks.

    Bounded sample: about `sample_rows` labelled ids by a hash of the id; rows without an id or label are left out, and
    an id with several labels counts with the smallest.  Without any label the score is 0.5 everywhere, with one class
    its smoothed share.  (Runs: the count of labels and the sample, whose ids are few enough to be broadcast.)
    """
    marked = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = int(min(1.0, sample_rows / max(1, marked.count())) * (1 << 30))
    drawn = marked.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < share)
    sample = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(drawn), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            packed = []
            for a, b in blocks(texts):
                owner, feature = features(texts[a:b])
                cuts = np.searchsorted(owner, np.arange(1, b - a))
                packed += [f.astype(np.int32).tobytes() for f in np.split(feature, cuts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(packed, pa.binary())], names=["doc_id", "quality", "features"])

    rows = sample.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"), "text")
    rows = rows.mapInArrow(run, "doc_id long, quality int, features binary").toArrow().to_pydict()
    order = sorted(range(len(rows["doc_id"])), key=lambda i: (hash((rows["doc_id"][i], SEED)), rows["doc_id"][i], rows["features"][i]))
    return fit([np.frombuffer(rows["features"][i], dtype=np.int32) for i in order], np.array([rows["quality"][i] for i in order]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds `score` (double, 0 to 1, higher: better) and `predicted` (1 from 0.7 on, else 0) by the whole `text`.

    A null or empty text scores as one without features.  Columns with these names are replaced, others pass through.
    """
    docs = docs.drop("score", "predicted")
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches):
            texts = [(t or "").encode() for t in batch.column("text").to_pylist()]
            scores = [np.empty(0)]
            for a, b in blocks(texts):
                owner, feature = features(texts[a:b])
                found = np.bincount(owner, minlength=b - a)
                margin = np.bincount(owner, model.weights[feature], minlength=b - a) / np.sqrt(SPREAD + found) + model.bias
                scores.append(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30))))
            made = np.concatenate(scores)
            columns = [*batch.columns, pa.array(made), pa.array((made >= THRESHOLD).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)

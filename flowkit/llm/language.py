"""Language identification by cross-parsing.

Each language is a suffix automaton of a bounded sample of its labelled text.  A text is parsed greedily into the
longest phrases that occur in the sample; the language with the least estimated cross entropy, phrases * log2(sample
length) / text length, wins.  Every letter of the samples has a class of its own.  The automata are transition tables,
dense while that stays small and else sorted edges, so that a block of texts is parsed by numpy, one step for all of
them at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowkit.llm.documents import sliced
from flowkit.llm.hashing import blocks

SAMPLE_CHARS = 32_000
PIECE_CHARS = 500
SAMPLE_ROWS = 400
DENSE_CELLS = 1 << 25
LANE = 512
UNDETERMINED = "und"
SEED = 3
SPACE, OTHER = 0, 1
DEAD, ROOT = 0, 1


@dataclass
class Model:
    """Languages in code-point order, the character classes, the transitions of all, and log2 of sample lengths.

    Transitions go from `state * width + class` to a state: as a table of all cells, or as sorted `edges` and `targets`.
    """

    languages: list[str]
    classes: np.ndarray
    targets: np.ndarray
    edges: np.ndarray | None
    starts: np.ndarray
    width: int
    bits: np.ndarray

    def moved(self, cells: np.ndarray) -> np.ndarray:
        """The states that transitions lead to, DEAD where there is none."""
        if self.edges is None:
            return self.targets[cells]
        place = np.minimum(np.searchsorted(self.edges, cells), len(self.edges) - 1)
        return np.where(self.edges[place] == cells, self.targets[place], DEAD)


def plain(text: str) -> str:
    """Lower case, with every run of other characters than letters as one space."""
    return " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split())


def transitions(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a sequence: code -> state, by state; 0 is dead and 1 the root."""
    links, lengths, moves = [0, 0], [0, 0], [{}, {}]
    last = ROOT
    for code in codes:
        state = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(ROOT)
        at = last
        while at and code not in moves[at]:
            moves[at][code] = state
            at = links[at]
        if at:
            target = moves[at][code]
            if lengths[at] + 1 == lengths[target]:
                links[state] = target
            else:
                copy = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                while at and moves[at].get(code) == target:
                    moves[at][code] = copy
                    at = links[at]
                links[target] = links[state] = copy
        last = state
    return moves


def automaton(codes: list[int], width: int) -> np.ndarray:
    """The same as a table: [state, code] -> state."""
    moves = transitions(codes)
    table = np.zeros((len(moves), width), dtype=np.int32)
    for state, edges in enumerate(moves):
        if edges:
            table[state, list(edges)] = list(edges.values())
    return table


def build(samples: dict[str, list[str]]) -> Model:
    """The model of sampled pieces of text per language."""
    languages = sorted(samples, key=lambda x: x.encode())
    texts = [" ".join(plain(t) for t in samples[x])[:SAMPLE_CHARS] for x in languages]
    letters = sorted(set("".join(texts)) - {" "})
    codes = {" ": SPACE} | {c: i + 2 for i, c in enumerate(letters)}
    width = len(codes) + 1
    kind = np.min_scalar_type(width)
    classes = np.fromiter((OTHER if chr(i).isalpha() else SPACE for i in range(0x110000)), dtype=kind, count=0x110000)
    for c, i in codes.items():
        classes[ord(c)] = i
        if len(c.upper()) == 1:
            classes[ord(c.upper())] = i
    starts, edges, targets, states = [], [], [], 0
    for text in texts:
        moves = transitions([codes.get(c, OTHER) for c in text])
        starts.append(states)
        for state, to in enumerate(moves):
            for code in sorted(to):
                if code != OTHER:
                    edges.append((states + state) * width + code)
                    targets.append(states + to[code])
        states += len(moves)
    cells, into = np.array(edges, dtype=np.int64), np.array(targets, dtype=np.int32)
    bits = np.log2([max(2, len(t)) for t in texts])
    if states * width > DENSE_CELLS:
        return Model(languages, classes, into, cells, np.array(starts), width, bits)
    table = np.full(states * width, DEAD, dtype=np.int32)
    table[cells] = into
    return Model(languages, classes, table, None, np.array(starts), width, bits)


def _read(model: Model, states: np.ndarray, roots: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """States after one more character, and whether a phrase ended before it."""
    moved = model.moved(states * model.width + code)
    ended = moved == DEAD
    return np.where(ended, model.moved(roots * model.width + code), moved), ended


def parse(model: Model, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each text in each language, and the length of each text without other characters than letters.

    Texts are read in lanes of `LANE` characters side by side, each as if a phrase began with it.  A lane is then
    corrected for the state in which the lane before it ends: both readings go on until they are in the same state, from
    where they agree.  That is repeated while the end of a lane changes, so the phrases are those of the whole text.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    codes = model.classes[points]
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != SPACE) | (codes[:-1] != SPACE) | (owner[1:] != owner[:-1])
    codes, owner = codes[keep].astype(np.int32), owner[keep]
    letters = np.bincount(owner[codes != SPACE], minlength=len(texts))
    sizes = np.bincount(owner, minlength=len(texts))
    lanes = -(-sizes // LANE)
    lane_owner = np.repeat(np.arange(len(texts)), lanes)
    within = np.arange(len(lane_owner)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = (np.cumsum(sizes) - sizes)[lane_owner] + within * LANE
    length = np.minimum(LANE, sizes[lane_owner] - within * LANE)
    order = np.argsort(-length, kind="stable")
    begin, length, lane_owner, within = begin[order], length[order], lane_owner[order], within[order]
    roots = np.tile((model.starts + ROOT)[:, None], len(begin)).astype(np.int64)
    states = roots.copy()
    counts = np.zeros((len(model.languages), len(begin)), dtype=np.int64)
    active = np.searchsorted(-length, -np.arange(LANE), side="left")
    for step in range(int(length[0]) if len(length) else 0):
        k = active[step]
        states[:, :k], ended = _read(model, states[:, :k], roots[:, :k], codes[begin[:k] + step])
        if step:
            counts[:, :k] += ended
        else:
            counts += np.where(within == 0, 1, ended)
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    later = np.flatnonzero(within > 0)
    previous = place[order[later] - 1]
    assumed = roots[:, later].copy()
    while True:
        language, at = np.nonzero(assumed != states[:, previous])
        if not len(at):
            break
        lane, old, new = later[at], assumed[language, at], states[language, previous[at]]
        assumed[language, at] = new
        step = 0
        while len(lane):
            code, root = codes[begin[lane] + step], roots[language, lane]
            old, less = _read(model, old, root, code)
            new, more = _read(model, new, root, code)
            counts[language, lane] += more.astype(np.int64) - less
            step += 1
            over = length[lane] == step
            states[language[over], lane[over]] = new[over]
            on = (old != new) & ~over
            language, lane, old, new = language[on], lane[on], old[on], new[on]
    phrases = np.stack([np.bincount(lane_owner, weights=c, minlength=len(texts)) for c in counts])
    return phrases, letters


def learn(docs: DataFrame, label: str = "lang") -> Model | None:
    """A model of the rows with a text and a label; None without any.

    Bounded sample: of each language, about `SAMPLE_ROWS` rows by a hash of `doc_id` are cut into pieces of
    `PIECE_CHARS` characters, and the pieces with the smallest hashes give `SAMPLE_CHARS` characters.
    (Runs: the counts per language and the sample.)
    """
    labelled = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", F.col(label).alias("lang"))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return None
    bound = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, int(min(1.0, SAMPLE_ROWS / n) * (1 << 30)))])
    drawn = labelled.where(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) < bound[F.col("lang")])
    pieces = F.sequence(F.lit(0), F.floor((F.length("text") - 1) / PIECE_CHARS).cast("int"))
    drawn = drawn.where(F.length("text") > 0).select("doc_id", "lang", "text", F.explode(pieces).alias("at"))
    drawn = drawn.select("lang", F.expr(f"substring(text, at * {PIECE_CHARS} + 1, {PIECE_CHARS})").alias("piece"), F.xxhash64("doc_id", "at").alias("key"))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("key", "piece"))
    rows = drawn.withColumn("nth", first).where(F.col("nth") <= 2 * SAMPLE_CHARS // PIECE_CHARS).orderBy("lang", "nth").collect()
    samples: dict[str, list[str]] = {}
    for row in rows:
        samples.setdefault(row["lang"], []).append(row["piece"])
    return build(samples) if samples else None


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """Adds `lang_pred` and `score` (double, 0 to 1) to documents with a `text`; other columns pass through.

    `und` with score 0 for a text that is null or has no letter, and for every text if nothing was learned; otherwise
    the language with the least cross entropy, ties to the first by code point.  The score is the winner's share of the
    inverse entropies.  Columns named `lang_pred` or `score` are replaced; rows stay as they are, repeated or not.
    """
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in sliced(batches, 2_048):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names, scores = [], []
            for a, b in blocks([t.encode() for t in texts]):
                phrases, letters = parse(model, texts[a:b])
                inverse = 1 / np.maximum(phrases * model.bits[:, None], 1e-9)
                best = inverse.argmax(axis=0)
                score = inverse.max(axis=0) / inverse.sum(axis=0)
                names += [model.languages[i] if n else UNDETERMINED for i, n in zip(best, letters, strict=True)]
                scores += np.where(letters > 0, score, 0.0).tolist()
            columns = [*batch.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(run, schema)


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4 (NULL for a null id)."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4

"""Document quality: random-indexing word vectors pooled per document, then a small network.

Every word slot has a sparse random index vector that is never stored, only derived from its hash. A
slot's word vector adds up the index vectors of its neighbours over the whole corpus, so words used
alike get alike vectors. A document is the mean and the spread of its words' vectors, with their own
index vectors beside, and how often a word repeats. A network of two layers scores it, its probabilities calibrated by a
temperature fitted on labelled rows it was not trained on."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upswell.llm import arrays
from upswell.llm.frames import held_out, in_batches, staged

#: Words fall into this many slots; with DIMS, it bounds what is sent to tasks (2 MB).
SLOTS, DIMS = 1 << 13, 64
#: Index vectors have so many entries of +1 or -1; neighbours up to WINDOW words away count.
ENTRIES, WINDOW = 4, 2
#: Labelled documents the network learns from, at most; taken in the order of a hash of the id.
MOST_LABELLED = 12_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 30, 128, 2e-3, 1e-4
CUT = 0.7


def tokens(text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the tokens of a slice, and tokens before each row. Tokens are runs of letters and
    digits (any byte above 127 too) and runs of other visible bytes."""
    kind = np.zeros(len(text) + 2, np.int8)
    inner = kind[1:-1]
    visible = (text != 32) & ((text < 9) | (text > 13))
    letter = (text > 127) | ((text >= 48) & (text <= 57)) | (((text | 32) >= 97) & ((text | 32) <= 122))
    inner[visible] = 1
    inner[letter] = 2
    change = np.flatnonzero(np.diff(kind))
    border = np.unique(np.concatenate([change, ends]))
    starts, stops = border[:-1], border[1:]
    shown = kind[starts + 1] > 0
    starts, stops = starts[shown], stops[shown]
    hashes = arrays.word_hashes(text, starts, stops)
    return (hashes % np.uint64(SLOTS)).astype(np.int64), np.searchsorted(starts, ends, side="left")


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the entries of every slot's index vector."""
    draws = arrays.seeds(SLOTS * ENTRIES, 1_500_000).reshape(SLOTS, ENTRIES)
    return (draws % np.uint64(DIMS)).astype(np.int64), ((draws >> np.uint64(40)) & np.uint64(1)).astype(np.int8) * 2 - 1


def _neighbour_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's sums of neighbours' index vectors, one row for each slot that occurs."""
    at, sign = index_vectors()
    total = np.zeros(SLOTS * DIMS, np.int64)
    seen = np.zeros(SLOTS, np.int64)
    for batch in batches:
        for _, _, text, ends in arrays.text_slices(batch.column("text"), 2 * arrays.SLICE_BYTES):
            slots, before = tokens(text, ends)
            if not len(slots):
                continue
            row = arrays.rows_of(before)
            seen += np.bincount(slots, minlength=SLOTS)
            pairs = np.concatenate(
                [(slots[:-gap] * SLOTS + slots[gap:])[row[:-gap] == row[gap:]] for gap in range(1, WINDOW + 1) if gap < len(slots)] or [slots[:0]]
            )
            # a pair adds to either word; equal pairs are added once, with their number
            pairs, times = np.unique(pairs, return_counts=True)
            a, b = pairs // SLOTS, pairs % SLOTS
            for word, other in ((a, b), (b, a)):
                for e in range(ENTRIES):
                    total += np.bincount(word * DIMS + at[other, e], weights=sign[other, e] * times, minlength=SLOTS * DIMS).astype(np.int64)
    used = np.flatnonzero(seen)
    if len(used):
        values = total.reshape(SLOTS, DIMS)[used]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(seen[used]), arrays.list_array(values.ravel(), np.full(len(used), DIMS), pa.int64())],
            names=["slot", "n", "sums"],
        )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Word vectors of all slots, learned from every text: at most SLOTS rows come to the driver."""
    parts = docs.select(F.col("text").cast("string")).mapInArrow(_neighbour_rows, "slot long, n long, sums array<long>")
    sums = parts.groupBy("slot").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[d]).alias(f"d{d}") for d in range(DIMS)))
    own = np.zeros((SLOTS, DIMS))
    at, sign = index_vectors()
    np.add.at(own, (np.arange(SLOTS)[:, None], at), sign)
    own /= np.sqrt(ENTRIES)
    near = np.zeros((SLOTS, DIMS))
    rows = sums.toArrow().to_pandas()
    if len(rows):
        near[rows["slot"].to_numpy()] = rows[[f"d{d}" for d in range(DIMS)]].to_numpy(float)
        near -= np.outer(np.where(np.isin(np.arange(SLOTS), rows["slot"]), 1.0, 0.0) * np.abs(near).sum(axis=1), near.sum(axis=0) / max(1.0, np.abs(near).sum()))
    length = np.linalg.norm(near, axis=1, keepdims=True)
    near = np.divide(near, length, out=np.zeros_like(near), where=length > 0)
    return np.concatenate([own, near], axis=1).astype(np.float32)


def pooled(column: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each row's words, the length of the mean, the shares of
    words that equal the next one and that are distinct, and the words' number on a log scale; zeros
    for a row without words."""
    width = vectors.shape[1]
    out = np.zeros((len(column), 2 * width + 4), np.float32)
    for first, last, text, ends in arrays.text_slices(column):
        slots, before = tokens(text, ends)
        for i in range(last - first):
            own = slots[before[i] : before[i + 1]]
            if len(own):
                found, times = np.unique(own, return_counts=True)
                share = (times / len(own)).astype(np.float32)
                rows = vectors[found]
                mean = share @ rows
                out[first + i, :width] = mean * 4
                out[first + i, width : 2 * width] = np.sqrt(np.maximum(share @ np.square(rows) - np.square(mean), 0)) * 4
                repeated = np.count_nonzero(own[1:] == own[:-1]) / len(own)
                out[first + i, 2 * width :] = np.linalg.norm(mean), repeated, len(found) / len(own), np.log1p(len(own)) / 4
    return out


@dataclass
class Model:
    """Word vectors, the network's layers and the temperature of its probabilities."""

    vectors: np.ndarray
    hidden: np.ndarray
    hidden_bias: np.ndarray
    out: np.ndarray
    out_bias: float
    temperature: float

    def margins(self, features: np.ndarray) -> np.ndarray:
        return np.maximum(features @ self.hidden + self.hidden_bias, 0) @ self.out + self.out_bias

    def scores(self, features: np.ndarray) -> np.ndarray:
        return _chance(self.margins(features).astype(np.float64) / self.temperature)


def _chance(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def trained(features: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Model:
    """Network and temperature. A fifth of the rows sets the temperature and is not trained on. Without
    rows of both labels every score is the share of label 1, or 0.5 without rows."""
    rng = np.random.default_rng(7)
    n, width = features.shape
    share = (labels.sum() + 0.5) / (n + 1)
    if n < 20 or labels.min() == labels.max():
        return Model(vectors, np.zeros((width, HIDDEN), np.float32), np.zeros(HIDDEN, np.float32), np.zeros(HIDDEN, np.float32), float(np.log(share / (1 - share))), 1.0)
    order = rng.permutation(n)
    apart, rows = order[: n // 5], order[n // 5 :]
    weights = [
        (rng.standard_normal((width, HIDDEN)) * np.sqrt(2 / width)).astype(np.float32), np.zeros(HIDDEN, np.float32),
        (rng.standard_normal(HIDDEN) * np.sqrt(1 / HIDDEN)).astype(np.float32), np.full(1, np.log(share / (1 - share)), np.float32),
    ]
    first, second, t = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
    for _ in range(EPOCHS):
        rows = rng.permutation(rows)
        for at in range(0, len(rows), BATCH):
            some = rows[at : at + BATCH]
            x, y = features[some], labels[some].astype(np.float32)
            inner = np.maximum(x @ weights[0] + weights[1], 0)
            error = (_chance(inner @ weights[2] + weights[3]) - y).astype(np.float32) / len(some)
            back = np.outer(error, weights[2]) * (inner > 0)
            slopes = [x.T @ back + DECAY * weights[0], back.sum(axis=0), inner.T @ error + DECAY * weights[2], error.sum(keepdims=True)]
            t += 1
            for i, g in enumerate(slopes):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                weights[i] -= RATE * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)
    model = Model(vectors, weights[0], weights[1], weights[2], float(weights[3][0]), 1.0)
    margins, truth = model.margins(features[apart]).astype(np.float64), labels[apart]
    grid = np.exp(np.linspace(np.log(0.25), np.log(8), 81))
    loss = [-np.mean(np.log(np.clip(np.where(truth == 1, _chance(margins / g), 1 - _chance(margins / g)), 1e-12, 1))) for g in grid]
    model.temperature = float(grid[int(np.argmin(loss))])
    return model


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of labels.quality (0 or 1). It learns labels only from documents that are not held
    out (``frames.held_out``), of these from at most MOST_LABELLED; word vectors come from all texts.
    Documents with several labels count once for each; null labels and ids teach nothing."""
    vectors = word_vectors(docs)
    wanted = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    wanted = wanted.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id")).distinct()
    chosen = staged(wanted.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(MOST_LABELLED))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    joined = texts.join(F.broadcast(chosen), "doc_id")  # at most MOST_LABELLED short rows
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        x = pooled(batch.column("text"), shared.value)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("quality"), pa.array([row.tobytes() for row in x], pa.binary())],
            names=["doc_id", "quality", "x"],
        )

    # Arrow batches of packed floats: rows of lists would be many times as large in the driver.
    found = in_batches(joined, features, "doc_id long, quality int, x binary").toArrow()
    found = found.sort_by([(c, "ascending") for c in ("doc_id", "quality", "x")])
    x = np.frombuffer(b"".join(found["x"].to_pylist()), np.float32).reshape(-1, 4 * DIMS + 4)
    return trained(x, found["quality"].to_numpy().astype(np.int64), vectors)


def scored(docs: DataFrame, model: Model, score: str = "quality_score", kept: str = "quality_kept") -> DataFrame:
    """``docs`` with a score (0 to 1) and whether it reaches the cut of 0.7; columns of these names
    are replaced. Only the text is looked at; a null or empty text is scored as one without words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.drop(score, kept)
    schema = T.StructType([*own.schema.fields, T.StructField(score, T.DoubleType()), T.StructField(kept, T.BooleanType())])

    def rate(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = shared.value.scores(pooled(batch.column("text"), shared.value.vectors))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found), pa.array(found >= CUT)], names=[*batch.schema.names, score, kept])

    return in_batches(own, rate, schema)


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents whose score reaches the cut, with all their columns."""
    return scored(docs, fit(docs, labels), "__score", "__kept").filter("__kept").select(docs.columns)

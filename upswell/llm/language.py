"""Language of a text by a string kernel, Nyström landmarks and kernel ridge regression.

The kernel of two texts is the number of different n-grams of 1 to 4 bytes they share (a blended
spectrum of presences, A-Z in lower case, n-grams hashed to slots), divided by the geometric mean of
their own numbers. A few training texts are landmarks; a text is its kernel values with them. One
ridge regression for each language, against the rest, gives the scores, so a batch of texts is
scored by two matrix products: presences by landmarks, and kernel values by weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from upswell.llm import arrays
from upswell.llm.frames import held_out, in_batches, staged

ORDERS = (1, 2, 3, 4)
#: Slots of n-grams; with LANDMARKS it bounds what is sent to tasks (12 MB).
SLOTS = 1 << 15
#: Texts of each language that are learned from, at most, and landmarks in all, at most; both taken
#: in the order of a hash of the id.
TEXTS_EACH, LANDMARKS = 300, 96
RIDGE = 1e-3
#: How sharply differences between the languages' scores turn into a probability.
SHARPNESS = 6.0
UNKNOWN = "und"


def presences(column: pa.Array) -> Iterator[np.ndarray]:
    """Slots of the n-grams of runs of rows, 1.0 where present: one matrix for each run."""
    for first, last, text, ends in arrays.text_slices(column, 1 << 18, 256):
        low = arrays.lowered(text)
        row = np.repeat(np.arange(last - first), np.diff(ends))
        found = np.zeros((last - first) * SLOTS, bool)
        gram = np.zeros(len(low), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            # the n-gram that ends at each byte; those that reach over a row's start are left out
            gram = (gram << np.uint32(8)) | low if n == 1 else _shifted(gram, low)
            if n in ORDERS:
                inside = np.zeros(len(low), bool)
                inside[n - 1 :] = row[n - 1 :] == row[: len(row) - n + 1] if n > 1 else True
                with np.errstate(over="ignore"):
                    slot = ((gram ^ np.uint32(n * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - 15)
                found[row[inside] * SLOTS + slot[inside]] = True
        yield found.reshape(last - first, SLOTS).astype(np.float32)


def _shifted(gram: np.ndarray, low: np.ndarray) -> np.ndarray:
    """n-grams one byte longer, from those that end a byte before."""
    out = low.astype(np.uint32)
    out[1:] |= gram[:-1] << np.uint32(8)
    return out


@dataclass
class Model:
    """Landmarks' presences by slot, scaled, and each language's weights."""

    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray

    def kernel(self, present: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))
        return (present @ self.landmarks) / size

    def scores(self, column: pa.Array) -> np.ndarray:
        parts = [self.kernel(p) @ self.weights for p in presences(column)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))


def _scaled(present: np.ndarray) -> np.ndarray:
    return (present / np.sqrt(np.maximum(present.sum(axis=1, keepdims=True), 1))).T.astype(np.float32)


def fit(docs: DataFrame) -> Model:
    """The model of the languages in ``lang``, from documents that are not held out
    (``frames.held_out``), at most TEXTS_EACH of each. Rows without a language, id or letter teach
    nothing; without any row there is no language to predict."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    usable = rows.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id") & F.col("text").rlike(r"\p{L}"))
    picked = usable.select("doc_id", "lang", F.xxhash64("text").alias("h")).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id", "h")))
    chosen = staged(picked.filter(F.col("n") <= TEXTS_EACH))
    texts = usable.withColumn("h", F.xxhash64("text")).join(chosen, ["doc_id", "lang", "h"])

    def features(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        bits = [np.packbits(p.astype(bool), axis=1) for p in presences(batch.column("text"))]
        flat = [r.tobytes() for b in bits for r in b]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("lang"), batch.column("n"), pa.array(flat, pa.binary())], names=["doc_id", "lang", "n", "bits"])

    # sets of n-grams of at most TEXTS_EACH texts a language, 4 KB each
    found = in_batches(texts.select("doc_id", "lang", "n", "text"), features, "doc_id long, lang string, n int, bits binary").toPandas()
    found = found.drop_duplicates(["lang", "n"]).sort_values(["n", "lang"], kind="stable")
    languages = sorted(found["lang"].unique())
    if not languages:
        return Model([], np.zeros((SLOTS, 1), np.float32), np.zeros((1, 0)))
    present = np.unpackbits(np.stack([np.frombuffer(b, np.uint8) for b in found["bits"]]), axis=1).astype(np.float32)
    marks = _scaled(present[:LANDMARKS])
    model = Model(languages, marks, np.zeros((marks.shape[1], len(languages))))
    k = model.kernel(present).astype(np.float64)
    # Nyström features are k times the inverse root of the landmarks' own kernel
    values, vectors = np.linalg.eigh(k[: marks.shape[1]])
    root = vectors / np.sqrt(np.maximum(values, 1e-6))
    x = k @ root
    lang = found["lang"].to_numpy()
    y = np.where(lang[:, None] == np.array(languages)[None, :], 1.0, -1.0)
    # a language counts the same however many texts it has
    share = 1.0 / np.array([(lang == v).sum() for v in lang])[:, None]
    a = x.T @ (x * share) + RIDGE * np.eye(x.shape[1])
    model.weights = root @ np.linalg.solve(a, x.T @ (y * share))
    return model


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and lang_score (0 to 1: the probability of the language predicted).
    Only the text is looked at. A text that is null or has no letter is ``und`` with a score of 0,
    and so is every text where no language was learned."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    own = docs.drop("lang_pred", "lang_score")
    kept = own.columns
    schema = T.StructType([*own.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("lang_score", T.DoubleType())])

    def name(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        m = shared.value
        scores = m.scores(batch.column("text")) * SHARPNESS
        if m.languages:
            chance = np.exp(scores - scores.max(axis=1, keepdims=True))
            chance /= chance.sum(axis=1, keepdims=True)
            best = chance.argmax(axis=1)
            langs, values = pa.array([m.languages[i] for i in best], pa.string()), chance[np.arange(len(best)), best]
        else:
            langs, values = pa.array([UNKNOWN] * len(batch), pa.string()), np.zeros(len(batch))
        yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, langs, pa.array(values)], names=[*kept, "lang_pred", "lang_score"])

    named = in_batches(own, name, schema)
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    return named.withColumns({"lang_pred": F.when(letters, F.col("lang_pred")).otherwise(UNKNOWN), "lang_score": F.when(letters, F.col("lang_score")).otherwise(0.0)})

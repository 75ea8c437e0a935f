"""Token ids of a corpus in Simple-8b files, in the order of doc_id."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from upswell.llm import arrays, simple8b
from upswell.llm.bpe import Known, _sums, gathered
from upswell.llm.frames import in_batches
from upswell.staging import scratch_path

#: Bytes of text whose new words go to the library together, and whose ids make one chunk of a file.
RUN_BYTES = 4 << 20
#: Words a Python worker remembers, whole and without what surrounds them.
MOST_KNOWN = 600_000

#: A lower-case word of letters below U+0250 and the punctuation after it. Word-level BPE cuts
#: between the two, so either is encoded by itself, and few words are new.
_PARTS = re.compile("([a-zß-öø-ɏ]+)([!-&(-/:-@\\[-`{-~]*)")
_ONE_RUN = re.compile("[a-zß-öø-ɏ]+|[!-&(-/:-@\\[-`{-~]+")
#: Runs that go to the library as one text; that is quicker than one by one, and than very many.
RUNS_TOGETHER = 200


class Encoder:
    """The tokenizers library over texts cut at spaces and line feeds, which this vocabulary drops,
    each part encoded once and remembered."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.words, self.parts = Known(), Known()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # ids that end a run
        self.last[[i for token, i in vocab.items() if token.endswith("</w>")]] = True

    def _library(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.int32), np.array([len(ids) for ids in found], np.int64)

    def _runs(self, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for runs of letters or of punctuation, many in a text; each ends with an id that
        nothing else has at its end."""
        ids, _ = self._library([" ".join(runs[i : i + RUNS_TOGETHER]) for i in range(0, len(runs), RUNS_TOGETHER)])
        counts = np.diff(np.flatnonzero(self.last[ids]), prepend=-1)
        return (ids, counts) if len(counts) == len(runs) else self._library(runs)

    def _learn_parts(self) -> None:
        new = self.parts.new()
        one = np.array([_ONE_RUN.fullmatch(p) is not None for p in new], bool)
        ids, counts = zip(self._runs([p for p, o in zip(new, one) if o]), self._library([p for p, o in zip(new, one) if not o]))
        order = np.empty(len(new), np.int64)
        order[np.concatenate([np.flatnonzero(one), np.flatnonzero(~one)])] = np.arange(len(new))
        both = np.concatenate(counts)
        self.parts.learned(gathered(np.concatenate(ids), both, order), both[order])

    def _learn_words(self) -> None:
        parts, sizes = [], []
        for word in self.words.new():
            low = word.lower()
            split = _PARTS.fullmatch(low) if len(low) == len(word) else None
            own = [p for p in split.groups() if p] if split else [word]
            parts += own
            sizes.append(len(own))
        flat = self.parts.numbers(parts)
        self._learn_parts()
        self.words.learned(gathered(self.parts.ids, self.parts.counts, flat), _sums(self.parts.counts[flat], np.array(sizes, np.int64)))

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and how many each has."""
        if len(self.words) > MOST_KNOWN:
            self.words = Known()
        if len(self.parts) > MOST_KNOWN:
            self.parts = Known()
        numbers = [self.words.numbers(text.replace("\n", " ").split(" ")) for text in texts]
        self._learn_words()
        flat = np.concatenate([*numbers, np.zeros(0, np.int64)])
        sizes = np.array([len(n) for n in numbers], np.int64)
        return gathered(self.words.ids, self.words.counts, flat), _sums(self.words.counts[flat], sizes)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The encoder of a file, kept by each Python worker."""
    return Encoder(path)


def write(docs: DataFrame, tokenizer: str, path: str, end_id: int = 1) -> None:
    """Encode every text, end it with ``end_id`` and write the ids in ascending order of doc_id.

    A file is a Parquet part whose rows are chunks of whole documents: part and seq give the order,
    doc_ids and n_tokens the documents, payload the Simple-8b blocks of their ids. Null texts count
    as empty; null doc_ids come first; rows with one doc_id are ordered by their text. Extra columns
    are ignored, an empty table writes no chunk."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, library = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        for batch in batches:
            for first, last, texts in arrays.string_slices(batch.column("text"), RUN_BYTES):
                ids, counts = library.encoded(texts)
                ids = np.insert(ids, np.cumsum(counts), end_id)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()), pa.array([seq], pa.int64()),
                        arrays.list_array(batch.column("doc_id").slice(first, last - first), np.array([last - first]), pa.int64()),
                        arrays.list_array(counts + 1, np.array([len(counts)]), pa.int64()),
                        pa.array([simple8b.encode(ids)], pa.binary()),
                    ],
                    names=["part", "seq", "doc_ids", "n_tokens", "payload"],
                )
                seq += 1

    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(pack, "part int, seq long, doc_ids array<long>, n_tokens array<long>, payload binary").write.parquet(path)


def _unpack(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(len(batch)):
        ids = simple8b.decode(batch.column("payload")[i].as_py()).astype("<u4")
        counts = np.array(batch.column("n_tokens")[i].as_py(), np.int64)
        ends = np.cumsum(counts)
        starts = ends - counts
        sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_ids")[i].values, pa.array(starts + batch.column("before")[i].as_py()), pa.array(counts), pa.array(sums, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the ids in the files."""
    chunks = spark.read.parquet(path).withColumn("n", F.aggregate("n_tokens", F.lit(0).cast("long"), lambda a, x: a + x))
    # running totals: over parts, one row each, and within a part over its chunks
    parts = chunks.groupBy("part").agg(F.sum("n").alias("n"))
    earlier = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    within = F.sum("n").over(Window.partitionBy("part").orderBy("seq")) - F.col("n")
    places = chunks.select("part", "seq", within.alias("within")).join(earlier, "part")
    placed = chunks.join(places.select("part", "seq", (F.col("within") + F.col("part_start")).alias("before")), ["part", "seq"])
    return in_batches(placed.select("doc_ids", "n_tokens", "payload", "before"), _unpack, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _ids(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for i in range(len(batch)):
        ids = simple8b.decode(batch.column("payload")[i].as_py())
        counts = np.array(batch.column("n_tokens")[i].as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_ids")[i].values, arrays.list_array(arrays.signed(ids), counts, pa.int64())], names=["doc_id", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """doc_id and ids of every document in the files."""
    return in_batches(spark.read.parquet(path).select("doc_ids", "n_tokens", "payload"), _ids, "doc_id long, ids array<long>")


def fresh_path(spark: SparkSession) -> str:
    """A new folder for files among the shared ones."""
    return scratch_path(spark, "token-files")

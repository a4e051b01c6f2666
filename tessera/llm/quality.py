"""A quality classifier by compression.

Two Zstandard dictionaries are built from good and from bad labelled text.  A text's blocks are
compressed with each; the difference of the sizes over their sum, calibrated on further
labelled documents, is the score.  Blocks are compressed apart, so that a long text is measured
against the dictionaries throughout, not only where it begins.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, small_batches, staged, text_buffer
from .labelled import fit_logistic, fold, lowest_hashes, sample

FOLDS, HELD_OUT = 3, 1
#: most labelled documents, by label, that dictionaries and calibration are fitted on
SAMPLE = {1: 3000, 0: 3000}
#: most blocks of labelled texts, by label, that a dictionary is trained on, and its own size
TRAINED_BLOCKS, DICTIONARY_BYTES = 6000, 112_640
BLOCK, LEVEL = 2048, 3
_CALIBRATION = 4  # every fourth sampled document calibrates, the others fill the dictionaries


@dataclass
class Classifier:
    """Two dictionaries (empty: plain compression) and the calibration."""

    good: bytes
    bad: bytes
    weights: list[float]

    def __getstate__(self):
        return {"good": self.good, "bad": self.bad, "weights": self.weights}

    def _compressors(self):
        if not hasattr(self, "_pair"):
            pair = []
            for raw in (self.good, self.bad):
                options = {"level": LEVEL, "write_content_size": False, "write_checksum": False}
                if raw:
                    known = zstandard.ZstdCompressionDict(raw)
                    known.precompute_compress(level=LEVEL)
                    options["dict_data"] = known
                pair.append(zstandard.ZstdCompressor(**options))
            self._pair = pair
        return self._pair

    def difference(self, text: bytes) -> float:
        """Over 0: the good dictionary fits better.  An empty text has 0."""
        good, bad = self._compressors()
        a = b = 0
        for lo in range(0, len(text), BLOCK):
            part = text[lo : lo + BLOCK]
            a += len(good.compress(part))
            b += len(bad.compress(part))
        return (b - a) / (a + b) if a + b else 0.0

    def features(self, text: bytes) -> list[float]:
        return [100 * self.difference(text)]

    def score(self, text: bytes) -> float:
        z = sum(w * x for w, x in zip(self.weights, [*self.features(text), 1.0], strict=True))
        return round(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), 6)


def _dictionary(parts: list[bytes]) -> bytes:
    """A dictionary from blocks; too little text gives none."""
    if len(parts) < 20 or sum(map(len, parts)) < 20_000:
        return b""
    return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, parts)) // 8), parts, k=256, d=8).as_bytes()


def _blocks(held: DataFrame) -> DataFrame:
    """(key, y, block): the blocks of whole texts, each with a number of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            at, out = offsets.tolist(), []
            for h, y, a, b in zip(batch.column("h").to_pylist(), batch.column("y").to_pylist(), at, at[1:], strict=False):
                out += [(h, i, y, data[lo : min(lo + BLOCK, b)].tobytes()) for i, lo in enumerate(range(a, b, BLOCK))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.binary()))], ["h", "i", "y", "block"])

    return held.select("h", "text", "y").mapInArrow(run, "h bigint, i bigint, y int, block binary").select(F.xxhash64("h", "i").alias("key"), "y", "block")


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label: str = "quality", rows: dict[int, int] | None = None, most_blocks: int = TRAINED_BLOCKS) -> Classifier:
    """Dictionaries and calibration from at most ``rows`` labelled documents of the training folds.

    A dictionary is trained on at most ``most_blocks`` blocks out of all blocks of those documents, by a
    hash of document and place, so a long text gives many and none is left out for its length.
    Calibration measures whole texts in the tasks; numbers alone reach the driver.  Without
    labels of both kinds every text gets the same score."""
    small_batches(docs.sparkSession)
    held = sample(docs, labels, label, fold(id_col, FOLDS) != HELD_OUT, rows or SAMPLE, id_col, text_col).withColumn("h", F.xxhash64("id"))
    later = F.pmod("h", F.lit(_CALIBRATION)) == 0
    blocks, path = staged(_blocks(held.where(~later)), "blocks")
    counts = {r["y"]: r["count"] for r in blocks.groupBy("y").count().collect()}
    chosen = {y: [bytes(r["block"]) for r in lowest_hashes(blocks.where(F.col("y") == y), "key", most_blocks, counts.get(y, 0)).select("block").toLocalIterator()] for y in (1, 0)}
    discard(docs.sparkSession, path)
    found = Classifier(_dictionary(chosen[1]), _dictionary(chosen[0]), [0.0, 0.0])
    shared = docs.sparkSession.sparkContext.broadcast(found)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            at = offsets.tolist()
            yield pa.RecordBatch.from_arrays([pa.array([known.features(data[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.list_(pa.float64())), batch.column("y")], ["x", "y"])

    fitted = held.where(later).select("text", "y", "id").mapInArrow(measured, "x array<double>, y int").toPandas()
    if len(fitted):
        found.weights = fit_logistic(np.array(fitted["x"].tolist()), fitted["y"].to_numpy(float), 1e-4).round(9).tolist()
    return Classifier(found.good, found.bad, found.weights)


def score(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row, from the whole text alone; null texts count as empty."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            at = offsets.tolist()
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([known.score(data[a:b].tobytes()) for a, b in zip(at, at[1:])], pa.float64())], ["id", "score"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {dict(docs.dtypes)[id_col]}, score double").withColumnRenamed("id", id_col)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's columns; the labels of held-out documents are never used."""
    scored = score(docs, learn(docs, labels))
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

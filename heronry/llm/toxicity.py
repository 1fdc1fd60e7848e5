"""Toxicity by logistic regression, trained with FTRL-proximal over hashed word n-grams and skip-grams.

Features are hashed and counted over a bounded sample of labelled rows; the rows then go through the
learner one after another, several times. State and features have a size that the width of the hash bounds.
The L1 term leaves few weights other than zero, so what the scoring tasks get is small.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from functools import reduce
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from heronry.llm.batches import WORDS, bounded_batches, map_texts, pieces, utf8
from heronry.llm.labelled import labelled_sample
from heronry.session import materialize

# Labelled rows of each class that are learned from; a larger class gives those with the smallest hash
# of the id.
MAX_ROWS_PER_CLASS = 8_000
EPOCHS = 8
# A feature is learned if so many rows of the sample have it.
MIN_ROWS = 4
# Bits of a feature's hash: at most 2^24 features, whatever the texts.
FEATURE_BITS = 24
ALPHA, BETA, L1, L2 = 4.0, 1.0, 4.0, 0.0

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def hashes(text: bytes) -> np.ndarray:
    """Hashes of a text's words, of pairs of neighbours, and of pairs that skip one or two words."""
    words = text.translate(WORDS).split()
    h = np.fromiter(map(crc32, words), np.uint64, len(words)) * _MULTIPLIERS[0]
    made = [h]
    for kind, gap in enumerate((1, 2, 3), 1):
        made.append(h[:-gap] * _MULTIPLIERS[1] + h[gap:] * _MULTIPLIERS[2] + np.uint64(kind))
    mixed = np.concatenate(made)
    mixed ^= mixed >> np.uint64(29)
    mixed *= _MULTIPLIERS[1]
    return (mixed >> np.uint64(64 - FEATURE_BITS)).astype(np.uint32)


@dataclass
class Model:
    """Hashes of the features with a weight, sorted, and their weights."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float

    def parts(self) -> tuple[np.ndarray, np.ndarray, float]:
        return self.hashes, self.weights, self.bias

    def score(self, text: bytes) -> float:
        found, total = hashes(text), self.bias
        if len(self.hashes) and len(found):
            at = np.minimum(np.searchsorted(self.hashes, found), len(self.hashes) - 1)
            # Each feature counts once, however often the text has it.
            total += float(self.weights[np.unique(at[self.hashes[at] == found])].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


def _weights(z: np.ndarray, n: np.ndarray, l1: np.ndarray) -> np.ndarray:
    """The proximal step: zero where |z| is within the L1 bound."""
    return np.where(
        np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
    )


def learn(rows: Iterable[np.ndarray], labels: list[int], z: np.ndarray, n: np.ndarray) -> None:
    """One pass over ``rows`` (places of the features in the state), changing ``z`` and ``n``. Place 0 is
    the bias, which has no L1 term."""
    for places, label in zip(rows, labels):
        l1 = np.where(places == 0, 0.0, L1)
        zs, ns = z[places], n[places]
        w = _weights(zs, ns, l1)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -40, 40))) - label
        step = (np.sqrt(ns + g * g) - np.sqrt(ns)) / ALPHA
        z[places] = zs + g - step * w
        n[places] = ns + g * g


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, rows): how many rows of each piece have a feature."""
    for piece in pieces(batches):
        made = [np.unique(hashes(t)) for t in utf8(piece.column("text"))]
        found, n = np.unique(np.concatenate(made), return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found.astype(np.int32)), pa.array(n, pa.int64())], names=["feature", "n"]
        )


def _places(vocabulary: Broadcast) -> Callable[[pa.RecordBatch], dict[str, object]]:
    """The places of a text's features in the state, as bytes; place 0 is the bias."""

    def places(text: bytes) -> bytes:
        known, found = vocabulary.value, np.unique(hashes(text))
        at = np.searchsorted(known, found)
        at = at[known[np.minimum(at, len(known) - 1)] == found] if len(known) else at[:0]
        return np.concatenate([[0], at + 1]).astype("<i4").tobytes()

    return lambda piece: {"places": pa.array(map(places, utf8(piece.column("text"))), pa.binary())}


def _learned(features: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """All rows learned as they come: the places of the weights other than zero, and these weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z, n = np.zeros(features + 1), np.zeros(features + 1)
        for batch in batches:
            rows = (np.frombuffer(p.as_py(), "<i4") for p in batch.column("places"))
            learn(rows, batch.column("label").to_pylist(), z, n)
        l1 = np.full(len(z), L1)
        l1[0] = 0
        w = _weights(z, n, l1)
        used = np.flatnonzero(w)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used.astype(np.int32)), pa.array(w[used])], names=["at", "w"]
        )

    return run


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "toxic",
    id_col: str = "doc_id",
    text: str = "text",
    bound: int = MAX_ROWS_PER_CLASS,
) -> Model:
    """A model of ``label_col`` from at most ``bound`` labelled ids of each class in ``labels``.

    Texts are the only input. Of the rows of an id one is learned from (see ``labelled_sample``). Features that
    fewer than ``MIN_ROWS`` rows of the sample have are left out. Rows are learned in the order of the ids'
    hashes, so the model does not depend on how the tables are split. Scores are probabilities under the mix
    of classes in the sample. Without labelled rows the model gives 0 to every text.
    """
    spark = docs.sparkSession
    sample = materialize(
        labelled_sample(docs, labels, label_col, id_col, text, bound), "training-rows"
    )
    if sample.isEmpty():
        return Model(np.zeros(0, np.uint32), np.zeros(0, np.float32), -np.inf)
    counted = bounded_batches(sample).select("text").mapInArrow(_feature_rows, "feature int, n long")
    frequent = counted.groupBy("feature").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_ROWS)
    # At most 2^FEATURE_BITS integers.
    found = frequent.select("feature").toArrow().column("feature").to_numpy()
    features = np.sort(found).astype(np.uint32)
    sent = spark.sparkContext.broadcast(features)
    packed = materialize(
        map_texts(
            sample.withColumn("turn", F.xxhash64("doc_id")),
            _places(sent),
            ["turn", "label"],
            "turn long, label int, places binary",
        ),
        "training",
    )
    # At most 2 * ``bound`` rows, one after another, as the method has it. The epochs are the same rows again:
    # none is held longer than its batch, and only weights come to the driver.
    ordered = packed.coalesce(1).sortWithinPartitions("turn", "places", "label")
    epochs = reduce(DataFrame.unionAll, [ordered.select("label", "places")] * EPOCHS).coalesce(1)
    learned = bounded_batches(epochs).mapInArrow(_learned(len(features)), "at int, w double").toArrow()
    sent.destroy()
    at, w = learned.column("at").to_numpy(), learned.column("w").to_numpy()
    used = at > 0
    bias = float(w[~used].sum())
    return Model(features[at[used] - 1], w[used].astype(np.float32), bias)


def scored(docs: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row: 0 to 1. A null text counts as empty and has the score of a text
    without words; repeated rows are each returned; an empty table gives no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model.parts())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def add(piece: pa.RecordBatch) -> dict[str, object]:
        score = Model(*sent.value).score
        return {"score": np.array([score(t) for t in utf8(piece.column("text"))])}

    return map_texts(rows, add, ["doc_id"], "doc_id long, score double")


def drop_toxic(docs: DataFrame, model: Model, text: str = "text", bound: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``bound``, with all columns, whatever their names. A null text
    counts as empty and has the score of a text without words; repeated rows are judged alike; an empty
    table gives no rows."""
    sent = docs.sparkSession.sparkContext.broadcast(model.parts())

    def run(batches):
        for piece in pieces(batches, text):
            score = Model(*sent.value).score
            yield piece.filter(pa.array([score(t) < bound for t in utf8(piece.column(text))], pa.bool_()))

    return bounded_batches(docs).mapInArrow(run, docs.schema)

"""A quality classifier by nearest-neighbour voting over latent-semantic vectors.

Terms are counted in hashed buckets and weighted by their inverse document frequency over all rows.
A bounded sample of labelled rows gives the latent space (subspace iteration on its term matrix, summed
over the tasks) and the labelled vectors. Both have a fixed size and are sent to all tasks; every row is
compared with every labelled vector, in blocks of rows.
"""

from __future__ import annotations

from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from heronry.llm.batches import LOWER, bounded_batches, map_texts, pieces, utf8
from heronry.llm.labelled import labelled_sample
from heronry.session import materialize

# Labelled rows of each class that are learned from; a larger class gives those with the smallest hash
# of the id.
MAX_ROWS_PER_CLASS = 3_000
BUCKETS = 1 << 13
DIMENSIONS = 48
ITERATIONS = 4
NEIGHBOURS = 15
# Similarities that differ by less count as equal; single precision tells no more.
TIED = 1e-6
# Similarities are raised to this power before they are added up.
SHARPNESS = 4
SEED = 7

# Each byte's class: letters by case, digits, blanks, and every other ASCII character for itself.
SHAPE = bytes(
    97 if 97 <= b <= 122 or b >= 128 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57
    else 32 if b == 32 or 9 <= b <= 13 else b
    for b in range(256)
)


def terms(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text's terms and how often each occurs.

    Terms are the words' shapes (runs of one class of characters count once), pairs of shapes, the words,
    and whether a word and a pair of words occurred before.
    """
    words = text.translate(LOWER).split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    shape = np.frombuffer(text.translate(SHAPE), np.uint8)
    runs = np.concatenate([[True], shape[1:] != shape[:-1]])
    shapes = shape[runs].tobytes().split()
    s = np.fromiter(map(crc32, shapes), np.uint64, len(shapes))
    w = np.fromiter(map(crc32, words), np.uint64, len(words))
    odd = np.uint64(0x9E3779B97F4A7C15)
    pair = w[:-1] * odd + w[1:]
    n_words, n_pairs = len(np.unique(w)), len(np.unique(pair))
    made = np.concatenate([s, s[:-1] * odd + s[1:] * np.uint64(3), w * np.uint64(5) + np.uint64(1)])
    made ^= made >> np.uint64(31)
    made *= odd
    # The first buckets are kept for the repeats, in tenths of the words and pairs.
    hashed = (made >> np.uint64(40)) % np.uint64(BUCKETS - 32) + np.uint64(32)
    repeats = [
        (10 * (len(w) - n_words)) // len(w),
        16 + (10 * (len(pair) - n_pairs)) // max(1, len(pair)),
    ]
    every = np.concatenate([hashed.astype(np.int64), np.repeat(repeats, max(1, len(w) // 4))])
    return np.unique(every, return_counts=True)


@dataclass
class Space:
    """Inverse document frequencies and the latent directions."""

    weights: np.ndarray
    directions: np.ndarray

    def rows(self, texts: list[bytes]) -> np.ndarray:
        """Latent vectors of length one (zero for texts without terms)."""
        made = np.zeros((len(texts), self.directions.shape[1]), np.float32)
        for i, text in enumerate(texts):
            at, n = terms(text)
            made[i] = weighted(at, n, self.weights) @ self.directions[at]
        return made / np.maximum(np.linalg.norm(made, axis=1, keepdims=True), 1e-12)


def weighted(at: np.ndarray, n: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights of a text's terms, of length one together."""
    x = (1 + np.log(n)) * weights[at] if len(at) else np.zeros(0)
    return x / max(np.linalg.norm(x), 1e-12)


@dataclass
class Voters:
    """The space, the labelled vectors in it, and their labels."""

    space: Space
    vectors: np.ndarray
    labels: np.ndarray

    def parts(self) -> tuple[np.ndarray, ...]:
        return self.space.weights, self.space.directions, self.vectors, self.labels

    @classmethod
    def of(cls, weights, directions, vectors, labels) -> Voters:
        return cls(Space(weights, directions), vectors, labels)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, each counted by its similarity. Vectors tied with
        the last of them vote as well; a text without terms is as near to all, and gets the sample's share."""
        if not len(self.labels):
            return np.zeros(len(texts))
        vectors = self.space.rows(texts)
        made = np.empty(len(texts))
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(texts), 256):
            cosines = vectors[at : at + 256] @ self.vectors.T
            least = -np.partition(-cosines, k - 1, axis=1)[:, k - 1 : k]
            # Every voter as near as the last one votes, so the order of the voters decides nothing.
            row, best = np.nonzero(cosines >= least - TIED)
            near = np.maximum(cosines[row, best], 0).astype(float) ** SHARPNESS + 1e-9
            ones = np.bincount(row, near * self.labels[best], len(cosines))
            made[at : at + 256] = ones / np.bincount(row, near, len(cosines))
        return np.clip(made, 0, 1)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many rows each bucket occurs, and the number of rows: sums over all rows."""

    def count(batches):
        n, rows = np.zeros(BUCKETS, np.int64), 0
        for piece in pieces(batches, "text"):
            for t in utf8(piece.column("text")):
                n[terms(t)[0]] += 1
            rows += piece.num_rows
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1, *at.tolist()], pa.int64()), pa.array([rows, *n[at].tolist()], pa.int64())],
            names=["bucket", "n"],
        )

    sums = (
        bounded_batches(docs)
        .select(F.col(text).cast("string").alias("text"))
        .mapInArrow(count, "bucket long, n long")
        .groupBy("bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    # At most BUCKETS + 1 rows.
    found = dict(zip(sums["bucket"].to_pylist(), sums["n"].to_pylist()))
    made = np.zeros(BUCKETS, np.int64)
    for bucket, n in found.items():
        if bucket >= 0:
            made[bucket] = n
    return made, found.get(-1, 0)


def _iterate(sample: DataFrame, weights: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The sample's second moments times ``directions``, summed over the tasks."""
    sent = sample.sparkSession.sparkContext.broadcast((weights, directions))

    def multiply(batches):
        weights, q = sent.value
        total = np.zeros(q.shape)
        for batch in batches:
            for at, n in zip(*(c for c in batch.columns)):
                at, n = at.values.to_numpy(), n.values.to_numpy()
                x = weighted(at, n, weights)
                np.add.at(total, at, np.outer(x, x @ q[at]))
        yield pa.RecordBatch.from_arrays(
            [pa.array([total.astype("<f8").tobytes()], pa.binary())], names=["total"]
        )

    parts = sample.select("at", "n").coalesce(8).mapInArrow(multiply, "total binary")
    total = np.zeros(directions.shape)
    # One matrix of fixed size from each of at most eight tasks.
    for row in parts.toLocalIterator():
        total += np.frombuffer(row["total"], "<f8").reshape(directions.shape)
    sent.unpersist()
    return total


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text: str = "text",
    bound: int = MAX_ROWS_PER_CLASS,
) -> Voters:
    """Voters from at most ``bound`` labelled ids of each class, with term frequencies of all rows."""
    spark = docs.sparkSession
    seen, n_rows = document_frequencies(docs, text)
    weights = np.log((1 + n_rows) / (1 + seen)) + 1

    def counted(piece: pa.RecordBatch) -> dict[str, object]:
        both = [terms(t) for t in utf8(piece.column("text"))]
        kind = pa.list_(pa.int64())
        return {"at": pa.array([a for a, _ in both], kind), "n": pa.array([n for _, n in both], kind)}

    sample = materialize(
        map_texts(
            labelled_sample(docs, labels, label_col, id_col, text, bound),
            counted,
            ["doc_id", "label"],
            "doc_id long, label int, at array<long>, n array<long>",
        ),
        "labelled",
    )
    q = np.linalg.qr(np.random.default_rng(SEED).normal(size=(BUCKETS, DIMENSIONS)))[0]
    for _ in range(ITERATIONS):
        q = np.linalg.qr(_iterate(sample, weights, q))[0]
    space = Space(weights, q.astype(np.float32))
    sent = spark.sparkContext.broadcast((space.weights, space.directions))

    def project(batches):
        space = Space(*sent.value)
        for batch in batches:
            made = [
                weighted(a.values.to_numpy(), n.values.to_numpy(), space.weights)
                @ space.directions[a.values.to_numpy()]
                for a, n in zip(batch.column("at"), batch.column("n"))
            ]
            vectors = pa.array([np.asarray(v, "<f4").tobytes() for v in made], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), vectors], names=["doc_id", "label", "v"]
            )

    # At most 2 * ``bound`` rows of DIMENSIONS numbers.
    rows = (
        sample.mapInArrow(project, "doc_id long, label int, v binary").orderBy("doc_id", "v").toArrow()
    )
    vectors = np.frombuffer(b"".join(rows["v"].to_pylist()), "<f4").reshape(-1, DIMENSIONS)
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    return Voters(space, vectors.astype(np.float32), rows["label"].to_numpy().astype(float))


def scored(docs: DataFrame, voters: Voters, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row: 0 to 1. Texts without words (null ones too) are alike to no labelled
    row and get the mean of some of them; repeated rows are each returned; an empty table gives no
    rows; other columns are not read. Without labelled rows every score is 0."""
    sent = docs.sparkSession.sparkContext.broadcast(voters.parts())
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_texts(
        rows,
        lambda p: {"score": Voters.of(*sent.value).scores(utf8(p.column("text")))},
        ["doc_id"],
        "doc_id long, score double",
    )

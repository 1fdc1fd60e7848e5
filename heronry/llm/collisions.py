"""Nearest neighbours by cosine with collision-counting hashing.

Every vector is scaled to length one and projected on random directions. The rows are dealt into blocks;
a block keeps, for each direction, its rows sorted by that single projection. A query places a window
around its own projection in each sorted array and widens all of them together by virtual rehashing: the
arrays stay as they are, only the ends of the windows move, and only what they newly cover is counted. Rows
that collide with the query in enough windows are verified by their exact cosine. A query is done in a
block when its k best verified rows lie within the radius that the windows stand for; the last radius
covers everything, so no query ends without an answer.

With the number of directions and the threshold below, a row within the radius is missed with a
probability under ``MISSED`` by Hoeffding's bound, whatever the data; nothing limits the number of rows
that are verified.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from heronry.llm.batches import bounded_batches
from heronry.session import materialize

SEED = 97
# Rows of a block, and queries that meet a block at once. They bound a task's memory.
BLOCK_ROWS = 131_072
QUERY_ROWS = 65_536
# Queries whose windows are looked up together.
LOOKED_UP = 512
# Chance that a row within the radius is missed, and rows beyond twice the radius verified in a block.
MISSED = 0.2
FALSE_ROWS = 100
# Ratio of distances that the threshold separates, and the width of a window of radius 1 that separates
# them best.
RATIO = 2.0
WIDTH = math.sqrt(8 * RATIO**2 * math.log(RATIO) / (RATIO**2 - 1))
# Radii between vectors of length one, and after them a radius that covers everything.
FIRST_RADIUS, GROWTH = 0.1, 1.25
RADII = [FIRST_RADIUS * GROWTH**i for i in range(14)]


def directions_and_threshold(rows: int) -> tuple[int, int]:
    """How many directions a block of ``rows`` rows needs, and how many collisions make a candidate."""

    def collide(distance: float) -> float:
        return math.erf(WIDTH / 2 / distance / math.sqrt(2))

    near, far = collide(1.0), collide(RATIO)
    false = math.sqrt(math.log(2 / min(1.0, FALSE_ROWS / max(rows, 1))))
    missed = math.sqrt(math.log(1 / MISSED))
    directions = math.ceil((false + missed) ** 2 / (2 * (near - far) ** 2))
    share = (false * near + missed * far) / (false + missed)
    return directions, math.ceil(share * directions)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors as doubles, each times a power of two: cosines stay the same to the bit, and no square
    overflows."""
    made = vectors.astype(np.float64)
    _, exponents = np.frexp(np.abs(made).max(axis=1, initial=0.0))
    return np.ldexp(made, -exponents[:, None])


def cosines(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Cosine of each row with ``query`` in doubles; equal rows get equal values wherever they stand."""
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / norms


class Block:
    """Rows of one block with an array sorted by projection for each direction."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, scaled(vectors)
        self.n, size = self.vectors.shape
        m, self.threshold = directions_and_threshold(self.n)
        # The same directions in every block of this size.
        self.directions = np.random.default_rng(SEED).standard_normal((m, size)).astype(np.float32)
        projected = self.project(self.vectors).T
        order = np.argsort(projected, axis=1).astype(np.int32)
        self.sorted = np.take_along_axis(projected, order, axis=1)
        self.order = order.ravel()
        self.first = np.arange(m, dtype=np.int64) * self.n

    def project(self, vectors: np.ndarray) -> np.ndarray:
        unit = vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
        return unit.astype(np.float32) @ self.directions.T

    def search(self, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple]:
        """(place of the query, ids, cosines) of each query's ``k`` best rows with another id."""
        vectors = scaled(vectors)
        for at in range(0, len(ids), LOOKED_UP):
            part = vectors[at : at + LOOKED_UP]
            begins, ends = self._windows(self.project(part))
            for i in range(len(part)):
                found = self._one(ids[at + i], part[i], begins[:, i], ends[:, i], k)
                yield (at + i, *found)

    def _windows(self, projected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the window of each radius (first axis), query and direction begins and ends."""
        shape = (len(RADII) + 1, *projected.shape)
        begins, ends = np.zeros(shape, np.int64), np.full(shape, self.n, np.int64)
        half = (np.array(RADII, np.float32) * np.float32(WIDTH / 2))[:, None]
        for i, keys in enumerate(self.sorted):
            begins[:-1, :, i] = np.searchsorted(keys, projected[:, i] - half, "left")
            ends[:-1, :, i] = np.searchsorted(keys, projected[:, i] + half, "right")
        return begins, ends

    def _covered(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Rows at places ``begins`` to ``ends`` of each direction's array, one after another."""
        lengths = ends - begins
        starts = np.tile(self.first, len(begins) // len(self.first)) + begins
        steps = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
        return self.order[steps + np.arange(len(steps))]

    def _one(self, own, query, begins, ends, k: int) -> tuple[np.ndarray, np.ndarray]:
        counts, seen = np.zeros(self.n, np.int64), np.zeros(self.n, bool)
        ids, scores = self.ids[:0], np.zeros(0)
        # k rows with enough collisions need so many in all, so narrower windows are not counted.
        enough = (ends - begins).sum(axis=1) >= k * self.threshold
        enough[-1] = True
        first = int(np.argmax(enough))
        for step in range(first, len(begins)):
            if step == len(RADII):
                new = np.flatnonzero(~seen)
            else:
                if step == first:
                    covered = self._covered(begins[step], ends[step])
                else:
                    left = begins[step], begins[step - 1]
                    right = ends[step - 1], ends[step]
                    covered = self._covered(*(np.concatenate(x) for x in zip(left, right)))
                counts += np.bincount(covered, minlength=self.n)
                new = np.flatnonzero((counts >= self.threshold) & ~seen)
            seen[new] = True
            new = new[self.ids[new] != own]
            if len(new):
                ids = np.concatenate([ids, self.ids[new]])
                scores = np.concatenate([scores, cosines(self.vectors[new], query)])
                best = np.lexsort((ids, -scores))[:k]
                ids, scores = ids[best], scores[best]
            if step < len(RADII) and len(ids) == k and 2 - 2 * scores[-1] <= RADII[step] ** 2:
                break
        return ids, scores


def _vectors(table: pa.Table, size: int) -> np.ndarray:
    column = table["vector"].combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _search(k: int):
    schema = pa.schema(
        [("query_id", pa.int64()), ("query_hash", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
    )

    def run(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        if not rows.num_rows or not queries.num_rows:
            return schema.empty_table()
        size = key[0].as_py()
        block = Block(rows["vec_id"].to_numpy(), _vectors(rows, size))
        ids, hashes = queries["vec_id"].to_numpy(), queries["hash"].to_numpy()
        places, found, scores = [], [], []
        for place, near, cosine in block.search(ids, _vectors(queries, size), k):
            places.append(np.full(len(near), place))
            found.append(near)
            scores.append(cosine)
        at = np.concatenate(places)
        made = [ids[at], hashes[at], np.concatenate(found), np.concatenate(scores)]
        return pa.Table.from_arrays([pa.array(x) for x in made], schema=schema)

    return run


def usable(vector: Column) -> Column:
    """Whether a vector takes part: not null, without null or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row that meets ``is_query``, the ``k`` rows of other ids
    with the largest cosines that were found, nearest first, ties to the smaller id; all of them where
    there are fewer than ``k``.

    ``score`` is the cosine of the vectors as given, in double precision. Rows whose vector is null, zero or
    holds a null or non-finite component, and rows without an id, take no part; vectors meet only those of
    their own length. Repeated rows count once; an id with several vectors has an answer for each of them.
    Other columns are not read. An empty table gives no rows.

    A row is compared with the queries block by block: the table is sent once for every ``QUERY_ROWS``
    queries, the queries once for every ``BLOCK_ROWS`` rows, and of a block only ``k`` rows a query leave
    the task.
    """
    spark = rows.sparkSession
    kept = materialize(
        bounded_batches(rows)
        .where(F.col(id_col).isNotNull() & usable(F.col(vector)))
        .select(
            F.col(id_col).cast("long").alias("vec_id"),
            F.col(vector).alias("vector"),
            F.coalesce(is_query, F.lit(False)).alias("is_query"),
        )
        .distinct()
        .withColumn("hash", F.xxhash64("vec_id", "vector")),
        "vectors",
    )
    counts = kept.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    row_blocks = max(-(-counts.n // BLOCK_ROWS), spark.sparkContext.defaultParallelism)
    query_blocks = max(-(-counts.q // QUERY_ROWS), 1)
    row_block = F.pmod("hash", F.lit(row_blocks)).cast("int")
    query_block = F.pmod(F.xxhash64("hash"), F.lit(query_blocks)).cast("int")
    every_row_block = F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1)))
    every_query_block = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    size = F.size("vector").alias("size")
    cell = ["size", "row_block", "query_block"]
    dealt = kept.select(
        size, row_block.alias("row_block"), every_query_block.alias("query_block"), "vec_id", "vector"
    )
    asked = kept.where("is_query").select(
        size, query_block.alias("query_block"), every_row_block.alias("row_block"), "vec_id", "hash", "vector"
    )
    found = (
        dealt.groupBy(*cell)
        .cogroup(asked.groupBy(*cell))
        .applyInArrow(_search(k), "query_id long, query_hash long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id", "query_hash").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

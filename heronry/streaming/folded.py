"""Keyed tables fed by micro-batches.

Totals that only add up, and rows of which the newest counts, need no read-modify-write: each batch
appends its own rows as one version, and a reader combines the versions. Writing a batch costs what
the batch costs, however large the table is, and writing it again changes nothing. Every
``fold_after`` batches the versions are combined into a base. What the base before last and all earlier
versions held is then removed, so the folders that anyone lists are bounded by ``fold_after``, however
many batches there have been.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from heronry.sinks.versions import committed, remove_versions, write_version

FOLD_AFTER = 24


class FoldedTable:
    """``root/parts/batch_id=N`` holds the rows of batch N; ``root/base/batch_id=N`` all batches up to N
    combined. ``combine`` reduces rows of the same key to one and keeps the columns; it must not
    depend on the order or the grouping in which rows are combined."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        combine: Callable[[DataFrame], DataFrame],
        fold_after: int = FOLD_AFTER,
    ):
        self.spark, self.combine, self.fold_after = spark, combine, fold_after
        self.parts, self.base = f"{root}/parts", f"{root}/base"

    def _folded(self, before: int | None = None) -> int:
        known = committed(self.spark, self.base, "batch_id")
        return max((n for n in known if before is None or n < before), default=-1)

    def put(self, rows: DataFrame, batch_id: int) -> None:
        """Store the rows of a batch, unless a base already contains them."""
        folded = self._folded()
        if batch_id <= folded:
            return
        write_version(rows, self.parts, batch_id, "batch_id")
        pending = [n for n in committed(self.spark, self.parts, "batch_id") if n > folded]
        if len(pending) >= self.fold_after:
            self.fold(batch_id - 1)

    def part(self, batch_id: int) -> DataFrame:
        """The rows of one batch."""
        return self.spark.read.parquet(f"{self.parts}/batch_id={batch_id}")

    def read(self, before: int | None = None, among: DataFrame | None = None) -> DataFrame | None:
        """One row per key from all batches, or from those with a number under ``before``; None if
        there are none. ``among`` is a column of keys: others are dropped before rows are combined."""
        base = self._folded(before)
        paths = [f"{self.base}/batch_id={base}"] if base >= 0 else []
        paths += [
            f"{self.parts}/batch_id={n}"
            for n in committed(self.spark, self.parts, "batch_id")
            if n > base and (before is None or n < before)
        ]
        if not paths:
            return None
        rows = self.spark.read.parquet(*paths)
        if among is not None:
            (key,) = among.columns
            wanted = among.select(F.col(key).alias("__wanted"))
            rows = rows.join(wanted, F.col(key).eqNullSafe(F.col("__wanted")), "left_semi")
        return self.combine(rows)

    def fold(self, upto: int) -> None:
        """Write the base that contains every batch up to ``upto``. :meth:`put` leaves the newest batch
        out, so that a replay of it still finds the table as it was before. The last base and what came
        after it stay until the next fold, for readers that have begun with them."""
        last = self._folded()
        if upto <= last:
            return
        combined = self.read(before=upto + 1)
        if combined is None:
            return
        write_version(combined, self.base, upto, "batch_id")
        for root, keep_from in ((self.base, last), (self.parts, last + 1)):
            old = [n for n in committed(self.spark, root, "batch_id") if n < keep_from]
            remove_versions(self.spark, root, old, "batch_id")


def newest(key: str, *columns: str) -> Callable[[DataFrame], DataFrame]:
    """Combine rows by keeping the one of the latest ``batch`` for each key."""
    return lambda rows: rows.groupBy(key).agg(
        *[F.max_by(c, "batch").alias(c) for c in columns], F.max("batch").alias("batch")
    )


def numbered(table: FoldedTable) -> Callable[[DataFrame, int], None]:
    """Handler that puts batches into a table of newest rows."""
    return lambda batch, number: table.put(batch.withColumn("batch", F.lit(number)), number)

"""The bounded sample of labelled rows that the classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text: str, bound: int
) -> DataFrame:
    """(doc_id, label, text): one row for each of at most ``bound`` labelled ids of each class, those with
    the smallest hash.

    An id with several labels has the largest, one with several texts the smallest in byte order (null if it
    has no other). Null ids and null labels are left out, and so are ids without a row in ``docs``.
    """
    known = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    one, other = (
        known.where(c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        for c in (F.col("label") > 0, F.col("label") <= 0)
    )
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).cast("string").alias("text"))
    # At most 2 * ``bound`` rows of two numbers are sent; each task keeps one text of an id before the shuffle.
    return (
        rows.join(F.broadcast(one.unionAll(other)), "doc_id")
        .groupBy("doc_id", "label")
        .agg(F.min("text").alias("text"))
    )

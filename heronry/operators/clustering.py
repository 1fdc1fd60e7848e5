"""Datasets clustered on several columns at once by a space-filling curve."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Ranks have so many bits, so a column is cut into 2 ** BITS slices of about equal numbers of rows.
BITS = 6
# Relative error of the slices' bounds.
ACCURACY = 0.001


def slice_bounds(df: DataFrame, columns: list[str], bits: int = BITS) -> dict[str, list[float]]:
    """The values between the slices of each column: approximate quantiles of all rows, from one pass. Columns must
    be numeric; 2 ** bits - 1 numbers for each come to the driver."""
    steps = [i / 2**bits for i in range(1, 2**bits)]
    found = df.approxQuantile(columns, steps, ACCURACY)
    return {c: sorted(set(b)) for c, b in zip(columns, found)}


def rank_in(value: Column, bounds: list[float]) -> Column:
    """How many bounds are at most ``value``: a binary search as nested conditions. Null ranks lowest."""
    if not bounds:
        return F.lit(0)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(value >= F.lit(bounds[middle]), search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def interleaved(ranks: list[Column], bits: int = BITS) -> Column:
    """The place on the curve: bits of the ranks in turn, the highest first."""
    place = F.lit(0).cast("long")
    for bit in reversed(range(bits)):
        for rank in ranks:
            one = F.shiftright(rank.cast("long"), bit).bitwiseAND(F.lit(1))
            place = F.shiftleft(place, 1).bitwiseOR(one)
    return place


def write_clustered(
    df: DataFrame,
    path: str,
    columns: list[str],
    files: int,
    group_bytes: int = 128 << 20,
    distinct: int = 1_000_000,
    bits: int = BITS,
) -> None:
    """Write ``df`` along the curve through ``columns``, so that files and row groups cover a small range of each
    column and not only of the first. Filters on any of them then skip the rest by the statistics in the files;
    Bloom filters, for up to ``distinct`` values a row group, serve equality where ranges overlap.

    The ranges of the curve are sampled, and many rows with equal values of all columns are split only where the
    curve is: rows of one place go to one task, a share of about 1 / 4 ** bits for two even columns. ``df`` is
    evaluated twice (bounds, rows), its sample once more.
    """
    bounds = slice_bounds(df, columns, bits)
    place = interleaved([rank_in(F.col(c), bounds[c]) for c in columns], bits)
    rows = df.withColumn("__place", place)
    # Equal places may be many: the rest of the order spreads them over tasks.
    order = ["__place", *columns]
    writer = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("__place").write
    writer = writer.option("parquet.block.size", group_bytes)
    for c in columns:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{c}", str(distinct))
    writer.mode("overwrite").parquet(path)

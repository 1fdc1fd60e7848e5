"""Streaming jobs. Handlers first store the batch by its number and go on from the stored rows: that
fixes the rows for every later step, replaces a cache that executors could lose, and runs the
heavy part in the caller's session with adaptive execution."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from heronry.functions.numbers import exact_sum
from heronry.operators.aggregates import add_parts, finish_metrics, metric_parts
from heronry.operators.joins import enrich_orders
from heronry.operators.projections import stamp
from heronry.operators.running import add_key_totals, key_totals
from heronry.operators.running import running_average as average_so_far
from heronry.sinks.versions import committed, remove_versions, write_version
from heronry.streaming.folded import FoldedTable
from heronry.streaming.runs import to_batches


def stored_batch(spark: SparkSession, batch: DataFrame, root: str, number: int) -> DataFrame:
    """Write a batch under its number, replacing an earlier attempt, and read it back."""
    write_version(batch, root, number, "batch_id")
    return spark.read.schema(batch.schema).parquet(f"{root}/batch_id={number}")


def stored_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows of all batches with their ``batch_id``, read as one partitioned dataset. A batch that is being
    written is not seen: its files lie in a hidden folder until Spark commits them."""
    return spark.read.parquet(root)


# --- running sums -----------------------------------------------------------------------------


def sums_by_key(stream: DataFrame, key: str, value: str, result: str, scale: int = 2) -> DataFrame:
    """Running sum per key. Spark adds up each batch before it touches the state.

    Store all sums and filter them on reading: a sum that is filtered out here once it falls below a
    bound would leave its earlier value in the stored table.
    """
    return stream.groupBy(key).agg(exact_sum(F.col(value), scale).alias(result))


def changes_to(root: str) -> Callable[[DataFrame, int], None]:
    """Handler that stores the rows a batch changed."""
    return lambda batch, number: write_version(batch, root, number, "batch_id")


# --- running average --------------------------------------------------------------------------


def running_average(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    key: str,
    order: list[str],
    value: str,
    scale: int = 2,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Emit, for every record, the average of its key so far; ``root/out`` receives the rows.

    Records count in batch order and, within a batch, in ``order``. A hot key is summed in pieces
    (see :mod:`heronry.operators.running`), which state kept per key could not do.
    """
    spark = stream.sparkSession
    state = FoldedTable(spark, f"{root}/state", lambda parts: add_key_totals(parts, key))

    def handle(batch: DataFrame, number: int) -> None:
        rows = stored_batch(spark, batch, f"{root}/in", number)
        # Storing the totals first tells how large the batch's keys are, so that a small set of them
        # is broadcast to the stored totals instead of shuffling those.
        state.put(key_totals(rows, key, value, scale), number)
        earlier = state.read(before=number, among=state.part(number).select(key))
        averaged = average_so_far(rows, key, order, value, scale=scale, earlier=earlier)
        write_version(averaged, f"{root}/out", number, "batch_id")
        # The rows of earlier batches are needed no more.
        old = [n for n in committed(spark, f"{root}/in", "batch_id") if n < number]
        remove_versions(spark, f"{root}/in", old, "batch_id")

    return to_batches(stream, handle, checkpoint, trigger=trigger)


# --- enrichment -------------------------------------------------------------------------------


def enriched(
    orders: DataFrame, customers: DataFrame, root: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Orders with the name of their customer in ``root/out``.

    The stored batch is joined in the caller's session, where a hot customer is split, and only with the
    customers it names: their table is scanned, but not shuffled, for every batch.
    """
    spark = orders.sparkSession

    def handle(batch: DataFrame, number: int) -> None:
        rows = stored_batch(spark, batch, f"{root}/in", number)
        wanted = rows.select("customer_id").distinct()
        named = customers.join(wanted, "customer_id", "left_semi")
        write_version(enrich_orders(rows, named), f"{root}/out", number, "batch_id")
        old = [n for n in committed(spark, f"{root}/in", "batch_id") if n < number]
        remove_versions(spark, f"{root}/in", old, "batch_id")

    return to_batches(orders, handle, checkpoint, trigger=trigger)


# --- customer metrics -------------------------------------------------------------------------


class CustomerMetrics:
    """Customer metrics kept up to date by a stream of transactions."""

    def __init__(self, spark: SparkSession, root: str, discount: str = "amount", **options: int):
        self.spark, self.root, self.discount = spark, root, discount
        add = lambda parts: add_parts(parts, "customer_id")
        self.metrics = FoldedTable(spark, f"{root}/metrics", add, **options)

    def handle(self, batch: DataFrame, number: int) -> None:
        """Store the raw rows of a batch and add its metrics. Safe to repeat; errors are raised, so
        the stream does not move on."""
        if batch.isEmpty():
            return
        rows = stored_batch(self.spark, stamp(batch), f"{self.root}/raw", number)
        self.metrics.put(metric_parts(rows, "customer_id", self.discount), number)

    def start(self, stream: DataFrame, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
        """Feed the metrics from a stream of transactions."""
        return to_batches(stream, self.handle, checkpoint, "update", trigger)

    def raw(self) -> DataFrame:
        """All transactions received, with batch number and processing time."""
        return stored_rows(self.spark, f"{self.root}/raw")

    def table(self, as_of: date) -> DataFrame:
        """The metrics table, with inactivity counted up to ``as_of``."""
        totals = self.metrics.read()
        if totals is None:
            raise LookupError("no transactions received yet")
        return finish_metrics(totals, as_of)

"""Starting streaming queries: triggers, sinks, checkpoints."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from heronry.operators.projections import stamp
from heronry.sources.topics import encode_json

# Everything that has arrived, in as many batches as the source limits ask for, then stop.
AVAILABLE: dict = {"availableNow": True}


def every(interval: str) -> dict:
    """Trigger for a batch per ``interval``, such as ``1 minute``."""
    return {"processingTime": interval}


def to_files(
    stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, **options: str
) -> StreamingQuery:
    """Append rows to a parquet dataset, each exactly once."""
    writer = stream.writeStream.format("parquet").outputMode("append").options(**options)
    writer = writer.option("checkpointLocation", checkpoint).option("path", path)
    return writer.trigger(**(trigger or AVAILABLE)).start()


def to_topic(
    stream: DataFrame,
    checkpoint: str,
    fmt: str = "kafka",
    trigger: dict | None = None,
    mode: str = "append",
    **options: str,
) -> StreamingQuery:
    """Write rows to a topic as JSON records."""
    writer = encode_json(stream).writeStream.format(fmt).outputMode(mode).options(**options)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE)).start()


def to_batches(
    stream: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every micro-batch with its number to ``handle``.

    A batch may be handed over again after a failure, so handlers must be idempotent by number.
    """
    writer = stream.writeStream.foreachBatch(handle).outputMode(mode)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or AVAILABLE)).start()


def to_console(
    stream: DataFrame,
    checkpoint: str,
    rows: int = 20,
    emit: Callable[[str], None] = print,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Show the first rows of every batch. Only those reach the driver; the console format of
    Spark would gather the whole batch there first."""

    def show(batch: DataFrame, number: int) -> None:
        lines = "\n".join(str(row.asDict()) for row in batch.take(rows))
        emit(f"batch {number}\n{lines}")

    return to_batches(stream, show, checkpoint, mode, trigger)


def finish(query: StreamingQuery) -> StreamingQuery:
    """Wait for a query with the ``AVAILABLE`` trigger; its error, if any, is raised here."""
    query.awaitTermination()
    return query


def stamped(stream: DataFrame) -> DataFrame:
    """Rows with the time their batch was processed."""
    return stamp(stream)

"""Arrow batches cut to a bounded size, and the byte tables shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

# Bytes of text that a task holds as Python objects at a time; a longer text is a piece of its own.
PIECE_BYTES = 4 << 20

# Bytes of an Arrow batch between Spark and Python. A task holds several (in the JVM, in Python, read and
# written), and Spark's own limit of 64 MB would be most of a small executor.
BATCH_BYTES = 8 << 20

# A-Z lower-cased, everything else kept.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# A-Z lower-cased; every byte that is no ASCII letter, digit or part of a longer character is a blank.
WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def pieces(batches: Iterable[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in record batches of about ``PIECE_BYTES`` of text each."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        begins = np.cumsum(sizes, dtype=np.int64) - sizes
        cuts = np.flatnonzero(np.diff(begins // PIECE_BYTES)) + 1
        edges = [0, *cuts.tolist(), batch.num_rows]
        for first, last in zip(edges, edges[1:]):
            yield batch.slice(first, last - first)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null counts as empty."""
    return pc.fill_null(column.cast(pa.binary()), b"").to_pylist()


def bounded_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session whose Arrow batches have at most ``BATCH_BYTES``. A lower limit that the session
    has stays; the setting is read when a query runs, so it is not reset."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = df.sparkSession.conf
    now = conf.get(name).lower().removesuffix("b")
    if not now.isdigit() or not 0 < int(now) <= BATCH_BYTES:
        conf.set(name, str(BATCH_BYTES))
    return df


def map_texts(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], dict[str, object]],
    keep: list[str],
    schema: str,
    text: str = "text",
) -> DataFrame:
    """Columns made from each text by ``function``, beside the columns ``keep``.

    ``function`` gets a piece of rows and returns a list or array for each new column of ``schema``,
    which lists the kept columns first. Runs without a shuffle, on as many tasks as the input has.
    """
    read = list(dict.fromkeys([*keep, text]))

    def run(batches):
        for piece in pieces(batches, text):
            made = function(piece)
            arrays = [piece.column(c) for c in keep] + [
                v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *made])

    return bounded_batches(df).select(*[F.col(c) for c in read]).mapInArrow(run, schema)

"""A growing Parquet table as a stream that starts at a given position.

Spark's own file stream always begins with what is there already. Here the rows have a number that only grows, and
a stream begins with the earliest row, behind the latest one, or behind a given number. Once a batch has run, its
checkpoint decides where the stream goes on.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

# The source travels by value, so executors need not have this library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FORMAT = "numbered_table"


@dataclass
class Rows(InputPartition):
    """The rows of a row group with numbers above ``after`` and up to ``upto``."""

    file: str
    group: int
    after: int
    upto: int


class NumberedReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.uri, self.number, self.start = options["path"], options["number"], options.get("start", "earliest")
        self.first: dict | None = None

    def _groups(self) -> Iterator[tuple[str, int, int, int]]:
        """(file, row group, least and greatest number) from the files' footers."""
        store, path = fs.FileSystem.from_uri(self.uri)
        for info in store.get_file_info(fs.FileSelector(path, recursive=False)):
            if info.type != fs.FileType.File or info.base_name[0] in "._":
                continue
            with pq.ParquetFile(info.path, filesystem=store) as file:
                at = file.schema_arrow.names.index(self.number)
                for i in range(file.metadata.num_row_groups):
                    group = file.metadata.row_group(i)
                    stats = group.column(at).statistics
                    if group.num_rows and stats is not None and stats.has_min_max:
                        yield info.path, i, stats.min, stats.max

    def initialOffset(self) -> dict:
        # Asked again until a batch has run, and must stay as it was when the stream began.
        if self.first is None:
            if self.start == "latest":
                self.first = self.latestOffset()
            elif self.start == "earliest":
                self.first = {"at": min((low for *_, low, _ in self._groups()), default=0) - 1}
            else:
                self.first = {"at": int(self.start)}
        return self.first

    def latestOffset(self) -> dict:
        # Never before the start: an offset that went back would deliver rows twice.
        first = self.first["at"] if self.first else -1
        return {"at": max([first, *(high for *_, high in self._groups())])}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        after, upto = start["at"], end["at"]
        return [Rows(f, i, after, upto) for f, i, low, high in self._groups() if high > after and low <= upto]

    def read(self, partition: Rows) -> Iterator[pa.RecordBatch]:
        store, _ = fs.FileSystem.from_uri(self.uri)
        with pq.ParquetFile(partition.file, filesystem=store) as file:
            for batch in file.iter_batches(row_groups=[partition.group]):
                number = batch.column(self.number)
                wanted = pc.and_(pc.greater(number, partition.after), pc.less_equal(number, partition.upto))
                yield batch.filter(wanted)

    def commit(self, end: dict) -> None:
        pass


class NumberedTable(DataSource):
    """Options: ``path``, the folder; ``number``, the column of growing numbers; ``start``, where to begin
    (``earliest``, ``latest`` or a number)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        raise ValueError("declare the schema of the table")

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return NumberedReader(self.options)


def stream_numbered(
    spark: SparkSession, path: str, schema: StructType, number: str, start: str | int = "earliest"
) -> DataFrame:
    """Rows of the Parquet files in ``path`` as a stream in the order of ``number``, a bigint that is greater in every
    later file. ``start`` counts for a stream without a checkpoint: ``earliest``, ``latest`` (only rows that come
    after the stream began) or a number (only greater ones). Rows without a number are never delivered.

    Tasks read row groups, of which the footers' statistics say that they have rows in question. The files must lie
    where the executors' ``pyarrow`` reaches them.
    """
    spark.dataSource.register(NumberedTable)
    reader = spark.readStream.format(FORMAT).schema(schema).option("number", number).option("start", str(start))
    return reader.load(path)

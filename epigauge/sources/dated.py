"""A dated table as a stream of its own, one date per micro-batch, without files in between.

A streaming source in Spark's Python data source interface. The offset is a date; what is read between two offsets are
the table's rows of the dates after the first and up to the second, so a restart goes on where the checkpoint stands.
"""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have this package

NAME = "dated_replay"
#: Where a stream begins: before the first date.
BEFORE = "0000-00-00"
TYPES = "value string, arrived timestamp"


def stage(messages: DataFrame, date: str, path: str) -> None:
    """Write ``value`` and the date column as the table that :func:`dated_records` replays: a folder per date."""
    rows = messages.where(F.col(date).isNotNull()).select("value", F.date_format(date, "yyyy-MM-dd").alias("date"))
    rows.repartitionByRange("date", F.xxhash64("value")).write.partitionBy("date").parquet(path)


def dated_records(spark: SparkSession, path: str) -> DataFrame:
    """``value`` and ``arrived`` (the end of its date) of a staged table, one date per micro-batch.

    A trigger by time goes through all dates, one after the other; ``availableNow`` takes one date a start. Executors
    read the folder through Arrow's file systems (local or mounted folders, or a URI that Arrow knows).
    """
    spark.dataSource.register(DatedReplay)
    return spark.readStream.format(NAME).option("path", path).load()


@dataclass
class DatedFile(InputPartition):
    date: str
    file: str

    def __init__(self, date: str, file: str):
        super().__init__((date, file))
        self.date, self.file = date, file


def _folder(path: str) -> tuple:
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class DatedReplay(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return TYPES

    def streamReader(self, schema) -> DataSourceStreamReader:  # noqa: N802
        return DatedReader(self.options["path"])


class DatedReader(DataSourceStreamReader):
    """Gives out the date after the last one that was planned; the engine tells that one on a restart, too."""

    def __init__(self, path: str):
        self.path, self.planned = path, None

    def _dates(self) -> list[str]:
        from pyarrow import fs

        files, root = _folder(self.path)
        found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
        return sorted(f.base_name[5:] for f in found if f.type == fs.FileType.Directory and f.base_name.startswith("date="))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"date": BEFORE}

    def latestOffset(self) -> dict:  # noqa: N802
        at = self.planned or BEFORE
        return {"date": next((d for d in self._dates() if d > at), at)}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        from pyarrow import fs

        self.planned = max(self.planned or BEFORE, end["date"])
        files, root = _folder(self.path)
        parts = []
        for date in self._dates():
            if start["date"] < date <= end["date"]:
                found = files.get_file_info(fs.FileSelector(f"{root}/date={date}"))
                parts += [DatedFile(date, f.path) for f in found if f.is_file and f.base_name.endswith(".parquet")]
        return parts

    def read(self, partition: DatedFile) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        files, _ = _folder(self.path)
        end = dt.datetime.fromisoformat(partition.date).replace(tzinfo=dt.timezone.utc) + dt.timedelta(days=1)
        for batch in pq.ParquetFile(files.open_input_file(partition.file)).iter_batches(columns=["value"]):
            arrived = pa.array([end] * batch.num_rows, pa.timestamp("us", "UTC"))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.string()), arrived], ["value", "arrived"])

"""Streaming sources and the message sink: a ``value`` column of JSON text, and when it ``arrived``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def kafka_records(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Messages of one topic. Needs the spark-sql-kafka package on the session's class path.

    ``starting_offsets`` counts only for a new checkpoint; a restarted query goes on where it was.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    return reader.options(**(options or {})).load().select("value", F.col("timestamp").alias("arrived"))


def kafka_send(messages: DataFrame, servers: str, topic: str) -> None:
    messages.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option(
        "topic", topic
    ).save()


def file_records(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines from a folder that grows, oldest file first; a record arrived when its file was written."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select("value", F.col("_metadata.file_modification_time").alias("arrived"))


def table_stream(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table as a stream; the table may be a folder or a single file."""
    folder, name = path.rstrip("/").rsplit("/", 1)
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = location.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(schema)
    if files.getFileStatus(location).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", name).parquet(folder)

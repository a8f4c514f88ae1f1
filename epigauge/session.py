"""Session settings and the shared folder for tables that outlive a job."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

R = TypeVar("R")


def build_session(name: str = "epigauge", **options: str) -> SparkSession:
    """A session with the settings the package relies on; the caller's options win."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **options,
    }
    builder = SparkSession.builder.appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Settings that keep streaming state off the JVM heap.
ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state off the JVM heap; for feeds with many open windows and locations."""
    for key, value in ROCKSDB.items():
        spark.conf.set(key, value)


_local_folders: list[tempfile.TemporaryDirectory] = []
_cleared_at_exit: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it then gets a folder that lives as long as the process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if not _local_folders:
        _local_folders.append(tempfile.TemporaryDirectory(prefix="epigauge-", ignore_cleanup_errors=True))
    return _local_folders[0].name


def tables_dir(spark: SparkSession) -> str:
    """Where this application's intermediate tables are; see :func:`clear_tables`."""
    path = f"{shared_dir(spark)}/epigauge-{spark.sparkContext.applicationId}"
    if path not in _cleared_at_exit:
        _cleared_at_exit.add(path)
        atexit.register(_clear_quietly, spark)
    return path


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A path of its own for one run; nothing else writes there."""
    path = f"{tables_dir(spark)}/{purpose}-{uuid.uuid4().hex}"
    for scope in _scopes:
        scope.append(path)
    return path


_scopes: list[list[str]] = []


@contextlib.contextmanager
def inner_tables(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was materialised inside, however it ends.

    For a caller that writes its result inside: frames made there can no longer be read afterwards. Of scopes open at the same
    time (threads) each removes what any of them made since it began, so they must not overlap but nest.
    """
    made: list[str] = []
    _scopes.append(made)
    try:
        yield
    finally:
        _scopes.remove(made)
        for path in made:
            remove(spark, path)


def clear_tables(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; frames that read them can no longer be used.

    Frames are lazy, so the tables must outlive the call that made them. This is done when the driver's
    process ends, and may be done before.
    """
    if spark.sparkContext._jsc is not None and not spark.sparkContext._jsc.sc().isStopped():
        remove(spark, tables_dir(spark))


def _clear_quietly(spark: SparkSession) -> None:
    with contextlib.suppress(Exception):  # the session may be gone by now
        clear_tables(spark)


def _files(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder in any file system that Spark reaches; nothing happens if there is none."""
    files, location = _files(spark, path)
    files.delete(location, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    files, location = _files(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location))


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content, read by the driver."""
    files, location = _files(spark, path)
    stream = files.open(location)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False, and nothing is changed, if it is there already.

    Of several processes that try at once one succeeds: the file is written under another name and renamed, which is
    refused where the name is taken.
    """
    files, location = _files(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(location.getParent(), f".{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(files.makeQualified(location).toUri(), spark._jsc.hadoopConfiguration())
    nothing = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(files.makeQualified(draft), files.makeQualified(location), nothing)
        return True
    except Py4JJavaError as error:
        files.delete(draft, False)
        if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise


def at_once(spark: SparkSession, works: Sequence[Callable[[], R]], limit: int = 8) -> list[R]:
    """Run independent driver-side steps (fits, each many small jobs) side by side, results in order."""
    with ThreadPoolExecutor(max_workers=min(limit, len(works))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(work)) for work in works]]


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` once as a shared Parquet table and read it back.

    Used before anything that passes over the same small result several times (model fits,
    min/max followed by a rescale): the raw input is scanned once, and a lost executor costs a
    re-read of this table, not a new scan.
    """
    spark = df.sparkSession
    path = run_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

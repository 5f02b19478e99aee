"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_LOCAL_FOLDERS: dict[str, str] = {}
#: Open scopes of this thread or task, the innermost last.
_SCOPES: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())
#: Spark deletes the shuffle files of a query at its end (from 4.1 on).
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Tables are written once and read a few times; their size counts more than the time to unpack them.
_COMPRESSION = "zstd"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a scratch folder of our own only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="tonewright-")
    return _LOCAL_FOLDERS[app]


def new_name() -> str:
    return uuid.uuid4().hex


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that :func:`materialize` writes inside, at the end.

    Whatever is to be read afterwards has to be written inside as ``lasting``, so that it depends on
    none of them; a lasting table belongs to the scope around this one, if there is one. Only
    tables made by this library below the shared folder are deleted.
    """
    own: list[str] = []
    before = _SCOPES.set((*_SCOPES.get(), own))
    try:
        yield
    finally:
        _SCOPES.reset(before)
        delete(spark, *own)


def delete(spark: SparkSession, *paths: str) -> None:
    """Deletes tables that this library wrote below the shared folder."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """The files that a write shuffles go as soon as its table is there, not when the driver happens to
    collect its garbage: nothing reads them again."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialize(
    frame: DataFrame,
    name: str,
    schema: StructType | None = None,
    lasting: bool = False,
    reader: SparkSession | None = None,
) -> DataFrame:
    """Writes a frame as a table and reads it back.

    This cuts the lineage in a way that outlives lost executors, stores the data by column, and
    lets later scans prune columns and push filters down. ``schema`` replaces the stored schema on
    reading; it must describe the same columns. ``lasting``: see :func:`temporary`.
    ``reader`` is the session that the result belongs to, if it isn't the frame's.
    """
    spark = frame.sparkSession
    path = _new_path(spark, name, lasting)
    with _shuffles_deleted(spark):
        frame.write.option("compression", _COMPRESSION).parquet(path)
    return (reader or spark).read.schema(schema or frame.schema).parquet(path)


def materialize_parts(frames: Iterable[DataFrame], name: str, lasting: bool = False) -> DataFrame:
    """Frames of the same columns as one table, written one after the other: the shuffle files of one go
    before the next begins."""
    path = None
    for frame in frames:
        spark, schema = frame.sparkSession, frame.schema
        path = path or _new_path(spark, name, lasting)
        with _shuffles_deleted(spark):
            frame.write.option("compression", _COMPRESSION).mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder in the shared one, deleted with the tables of its scope."""
    return _new_path(spark, name)


def _new_path(spark: SparkSession, name: str, lasting: bool = False) -> str:
    path = f"{shared_folder(spark)}/{name}-{new_name()}"
    scopes = _SCOPES.get()[:-1] if lasting else _SCOPES.get()
    if scopes:
        scopes[-1].append(path)
    return path


@dataclass(frozen=True)
class Buckets:
    """A table written in buckets: its name in the catalog, and its files."""

    name: str
    path: str


def materialize_buckets(frame: DataFrame, name: str, key: str, buckets: int) -> Buckets:
    """Writes a frame in ``buckets`` files by the hash of ``key``, so that joins and groups that hold the
    key together find it so, and move nothing.

    Spark keeps the layout in its catalog; :func:`forget` takes the entry out again.
    """
    return materialize_dealt(frame.repartition(buckets, key), name, key, buckets)


def materialize_dealt(
    frame: DataFrame, name: str, key: str, buckets: int, lasting: bool = False
) -> Buckets:
    """As :func:`materialize_buckets`, for a frame that is dealt out so already: it is not moved."""
    table = f"{name.replace('-', '_')}_{new_name()}"
    path = _new_path(frame.sparkSession, name, lasting)
    writer = frame.write.option("compression", _COMPRESSION).bucketBy(buckets, key).sortBy(key)
    with _shuffles_deleted(frame.sparkSession):
        writer.option("path", path).saveAsTable(table)
    return Buckets(table, path)


def forget(spark: SparkSession, *tables: Buckets) -> None:
    """Takes tables out of the catalog; their files stay until their scope ends."""
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS {table.name}")

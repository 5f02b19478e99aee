"""Versions of stored models: tables that are written once, and a manifest for each version.

A version is a file ``manifest-N.json`` in the folder of the store. It names the tables of the version
and carries a few facts about them; the tables lie beside it and never change. The manifest is created
after its tables are complete, and only if no other has its number. So a reader sees a whole version or
none, a job that dies leaves tables that nothing names, and of two writers of a version one fails.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tonewright.sources.workspace import new_name

_MANIFEST = re.compile(r"manifest-([0-9]+)\.json")


@dataclass(frozen=True)
class Version:
    """A version of a store: ``tables`` are lists of folders by name, ``facts`` are plain values."""

    folder: str
    number: int
    tables: dict[str, list[str]]
    schemas: dict[str, str]
    facts: dict[str, Any] = field(default_factory=dict)

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        """Rows of all parts of a table."""
        schema = StructType.fromJson(json.loads(self.schemas[name]))
        paths = [f"{self.folder}/{part}" for part in self.tables[name]]
        return spark.read.schema(schema).parquet(*paths)


def _path(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the versions in a store, ascending; none if there is no such folder."""
    system, place = _path(spark, folder)
    if not system.exists(place):
        return []
    names = (_MANIFEST.fullmatch(s.getPath().getName()) for s in system.listStatus(place))
    return sorted(int(m[1]) for m in names if m)


def latest(spark: SparkSession, folder: str) -> Version | None:
    known = versions(spark, folder)
    return load(spark, folder, known[-1]) if known else None


def load(spark: SparkSession, folder: str, number: int | None = None) -> Version:
    """A version by its number, or the latest."""
    known = versions(spark, folder)
    if not known or (number is not None and number not in known):
        raise ValueError(f"no version {'at all' if number is None else number} in {folder}")
    number = known[-1] if number is None else number
    system, place = _path(spark, f"{folder}/manifest-{number}.json")
    stream = system.open(place)
    try:
        body = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    held = json.loads(body)
    return Version(folder, number, held["tables"], held["schemas"], held["facts"])


def write_part(frame: DataFrame, folder: str, name: str) -> str:
    """Writes a table into the store and returns its folder there. No version names it yet."""
    part = f"{name}-{new_name()}"
    frame.write.parquet(f"{folder}/{part}")
    return part


def commit(
    spark: SparkSession,
    folder: str,
    number: int,
    tables: dict[str, list[str]],
    schemas: dict[str, StructType],
    facts: dict[str, Any],
) -> Version:
    """Makes written parts a version. Fails if the number is taken: somebody else was faster.

    This rests on the exclusive creation of a file, which HDFS and local folders have. On a store of
    objects without it, writers have to be kept apart by other means.
    """
    stored = {name: schema.json() for name, schema in schemas.items()}
    body = json.dumps({"tables": tables, "schemas": stored, "facts": facts}, sort_keys=True)
    system, place = _path(spark, f"{folder}/manifest-{number}.json")
    if system.exists(place):
        raise FileExistsError(f"version {number} of {folder} is there already")
    stream = system.create(place, False)
    try:
        stream.write(bytearray(body.encode("utf-8")))
    finally:
        stream.close()
    return Version(folder, number, tables, stored, facts)

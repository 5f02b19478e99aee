"""Writes the token ids of a corpus as seekable binary files, and reads documents from them.

Documents are dealt out by ranges of their id, so the files in the order of the manifest hold the
corpus in ascending order of ids. Each task encodes its range and writes files of independent
zstandard frames (``seekable``), opened under a new name, so that a task that runs again leaves
nothing half-written behind under a name that counts: a file counts if the manifest names it, and
the manifest is a table that Spark commits. It has one row for each file (at most ``FILE_DOCS``
documents or about ``FILE_IDS`` ids): the number of documents and ids, and the ids in all files
before it. Readers open a file by its table and decompress only frames that hold ids they want.

The row's number is the second key of the range, so that rows with one id, or without, are split
over tasks. Files are written and read through ``pyarrow.fs``, which knows local and shared folders
and the common object stores; the manifest through Spark.

Defined results: a null or empty text is the end id alone; rows without an id come first; repeated
rows are documents of their own; a text of any length is encoded in parts and cut into frames; an
empty table gives a manifest without files.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonewright.llm.part_encoder import PartEncoder
from tonewright.llm.seekable import Reader, Writer

VOCABULARY = "word_bpe_49k.json"
FILE_IDS, FILE_DOCS = 1 << 28, 1 << 20
#: Bytes of ids in a batch that goes to Spark.
_BATCH = 8 << 20


def _key(frame: DataFrame) -> str:
    return frame.schema["doc_id"].dataType.simpleString()


def write(
    docs: DataFrame,
    folder: str,
    vocabulary: str = VOCABULARY,
    end_id: int = 1,
    file_ids: int = FILE_IDS,
    file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Writes all texts below ``folder`` and returns the manifest, which is stored there too."""
    spark = docs.sparkSession
    path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
    order = [F.asc_nulls_first("doc_id"), F.asc("row")]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    schema = f"part int, number int, file string, n_docs bigint, n_ids bigint, n_bytes bigint, first_doc {_key(docs)}, last_doc {_key(docs)}"
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        encoder, end = PartEncoder.of(path), np.array([end_id], dtype="<u4").tobytes()
        store, place = pafs.FileSystem.from_uri(folder)
        writer, file, ids = None, "", 0

        def closed() -> pa.RecordBatch:
            nonlocal number
            writer.close()
            docs, n = len(writer.names), sum(writer.counts)
            row = (part, number, file, docs, n, writer.written, writer.names[0], writer.names[-1])
            number += 1
            kinds = [pa.int32(), pa.int32(), pa.string(), *[pa.int64()] * 3, writer.key, writer.key]
            arrays = [pa.array([x], k) for x, k in zip(row, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names)

        for batch in batches:
            keys, last = batch.column(0).to_pylist(), -1
            for i, some in encoder.encode(batch.column(1).to_pylist()):
                if i != last:
                    if last >= 0:
                        writer.add(end)
                        ids += 1
                    if writer is not None and (ids >= file_ids or len(writer.names) >= file_docs):
                        yield closed()
                        writer = None
                    if writer is None:
                        file, ids = f"ids-{part:06d}-{number:04d}-{uuid.uuid4().hex}.zst", 0
                        store.create_dir(place, recursive=True)
                        stream = store.open_output_stream(f"{place}/{file}", compression=None)
                        writer = Writer(stream, batch.schema.field(0).type)
                    writer.begin(keys[i])
                    last = i
                writer.add(some)
                ids += len(some) // 4
            if last >= 0:
                writer.add(end)
                ids += 1
        if writer is not None:
            yield closed()

    dealt.mapInArrow(run, schema).write.parquet(f"{folder}/files")
    _add_starts(spark.read.parquet(f"{folder}/files")).write.parquet(f"{folder}/manifest")
    return manifest(spark, folder)


def _add_starts(files: DataFrame) -> DataFrame:
    """``start``: the ids of all files before. Sums of blocks of parts come first, so that no window
    holds more than the files of 1,024 tasks or one row for each block."""
    blocked = files.withColumn("block", F.floor(F.col("part") / 1024))
    past = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.groupBy("block").agg(F.sum("n_ids").alias("n"))
    sums = sums.select("block", F.coalesce(F.sum("n").over(past), F.lit(0)).alias("before"))
    within = Window.partitionBy("block").orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n_ids").over(within), F.lit(0))
    return blocked.withColumn("inside", inside).join(sums, "block").select(
        *files.columns, (F.col("before") + F.col("inside")).alias("start")
    )


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/manifest")


def _batch(columns: list[list], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _one_task_each(files: DataFrame) -> DataFrame:
    """The rows of the manifest, each in a task of its own."""
    return files.coalesce(1).repartition(max(1, files.count()))


def _read_files(rows: DataFrame, folder: str, key: str, with_ids: bool) -> DataFrame:
    """Documents of the files in ``rows`` (file, start), with or without their ids."""
    names = ["doc_id", "start", "n_tokens", *(["ids"] if with_ids else ["file", "first"])]
    schema = f"doc_id {key}, start bigint, n_tokens bigint, " + ("ids binary" if with_ids else "file string, first bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for file, start in zip(*(batch.column(i).to_pylist() for i in (0, 1)), strict=True):
                with store.open_input_file(f"{place}/{file}") as opened:
                    reader = Reader(opened)
                    index = reader.index()
                    kind = index.schema.field(0).type
                    first, count = (index.column(i).to_pylist() for i in (1, 2))
                    if not with_ids:
                        starts = pa.array(index.column(1).to_numpy() + start)
                        files = pa.array([file] * len(first), pa.string())
                        columns = [index.column(0), starts, index.column(2), files, index.column(1)]
                        yield pa.RecordBatch.from_arrays(columns, names)
                        continue
                    keys = index.column(0).to_pylist()
                    kinds = [kind, pa.int64(), pa.int64(), pa.binary()]
                    held: list[list] = [[], [], [], []]
                    size = 0
                    for key_, at, n, ids in zip(keys, first, count, reader.ids(zip(first, count, strict=True)), strict=True):
                        for column, value in zip(held, (key_, start + at, n, ids), strict=True):
                            column.append(value)
                        size += len(ids)
                        if size >= _BATCH:
                            yield _batch(held, kinds, names)
                            held, size = [[], [], [], []], 0
                    if held[0]:
                        yield _batch(held, kinds, names)

    return rows.mapInArrow(run, schema)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files of the manifest."""
    files = manifest(spark, folder)
    key = files.schema["first_doc"].dataType.simpleString()
    return _read_files(_one_task_each(files.select("file", "start")), folder, key, with_ids=True)


def index(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, file, first`` of every document; no data frame is opened."""
    files = manifest(spark, folder)
    key = files.schema["first_doc"].dataType.simpleString()
    return _read_files(_one_task_each(files.select("file", "start")), folder, key, with_ids=False)


def fetch(wanted: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of the documents with the ids in ``wanted`` (null finds null).

    Rows of the index that are wanted go to their files' tasks in order, which decompress only the
    frames that hold them.
    """
    spark = wanted.sparkSession
    keys = wanted.select(F.col("doc_id").alias("_wanted")).distinct()
    places = index(spark, folder)
    found = places.join(keys, places["doc_id"].eqNullSafe(keys["_wanted"]), "left_semi")
    order = ["file", "first"]
    dealt = found.repartitionByRange(*order).sortWithinPartitions(*order)
    names = ["doc_id", "start", "n_tokens", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            rows = list(zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True))
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.binary()]
            at = 0
            while at < len(rows):
                end = at
                while end < len(rows) and rows[end][3] == rows[at][3]:
                    end += 1
                with store.open_input_file(f"{place}/{rows[at][3]}") as opened:
                    reader = Reader(opened)
                    spans = ((r[4], r[2]) for r in rows[at:end])
                    held: list[list] = [[], [], [], []]
                    size = 0
                    for row, ids in zip(rows[at:end], reader.ids(spans), strict=True):
                        for column, value in zip(held, (*row[:3], ids), strict=True):
                            column.append(value)
                        size += len(ids)
                        if size >= _BATCH:
                            yield _batch(held, kinds, names)
                            held, size = [[], [], [], []], 0
                    if held[0]:
                        yield _batch(held, kinds, names)
                at = end

    return dealt.mapInArrow(run, f"doc_id {_key(places)}, start bigint, n_tokens bigint, ids binary")

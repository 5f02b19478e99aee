"""Document folders in, prediction lines out."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonewright.sources.parallelism import spread


# A split holds at most 32 small files, since Spark takes opening a file for 4 MB. With very many, a task
# reads several splits, as many as this at most, once each slot has tasks enough.
SPLITS_OF_A_TASK = 32
SPLITS_PER_SLOT = 8


def document_name(file_name: Column) -> Column:
    """File name up to its first dot."""
    return F.substring_index(file_name, ".", 1)


def decoded(content: Column, encoding: str = "UTF-8") -> Column:
    """Text of a file's bytes. In UTF-8 each malformed sequence becomes U+FFFD, as the standard
    recommends; no sequence of bytes fails the job."""
    if encoding.upper() == "UTF-8":
        return F.make_valid_utf8(content.cast("string"))
    return F.decode(content, encoding)


def is_malformed(content: Column) -> Column:
    """Whether bytes are no UTF-8."""
    return ~F.is_valid_utf8(content.cast("string"))


def list_files(spark: SparkSession, *paths: str) -> DataFrame:
    """``path, name, length`` of all files below the paths. No file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select("path", _name().alias("name"), "length")


def _name() -> Column:
    return document_name(F.element_at(F.split("path", "/"), -1))


def _read_texts(spark: SparkSession, *paths: str, malformed: str = "replace") -> DataFrame:
    """One document for each file, decoded from its bytes.

    Spark lists the folder once and deals out whole files by their size, small ones many to a task.
    Files that are no UTF-8 are read with their malformed sequences replaced; ``"null"`` gives them a
    NULL text instead, so that they can be told apart and none is lost. An empty file is no document:
    Spark's index of files leaves it out.
    """
    if malformed not in ("replace", "null"):
        raise ValueError(f"malformed is 'replace' or 'null', not {malformed!r}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    text = decoded(F.col("content"))
    if malformed == "null":
        text = F.when(~is_malformed(F.col("content")), text)
    splits = files.rdd.getNumPartitions()
    files = files.coalesce(max(SPLITS_PER_SLOT * spark.sparkContext.defaultParallelism, -(-splits // SPLITS_OF_A_TASK)))
    documents = files.select(F.col("path").alias("doc_id"), _name().alias("name"), text.alias("text"))
    return spread(documents, "doc_id")


def read_labeled(spark: SparkSession, path: str, malformed: str = "replace") -> DataFrame:
    """Texts below ``path/pos`` with label 1.0 and below ``path/neg`` with label 0.0.

    One file is one document. The two classes are read apart, so a folder called ``pos`` further
    up or down the path does not decide a label.
    """
    positive = _read_texts(spark, f"{path}/pos", malformed=malformed).withColumn("label", F.lit(1.0))
    negative = _read_texts(spark, f"{path}/neg", malformed=malformed).withColumn("label", F.lit(0.0))
    return union_classes(positive, negative)


def read_unlabeled(spark: SparkSession, path: str, malformed: str = "replace") -> DataFrame:
    return _read_texts(spark, path, malformed=malformed)


def write_texts(texts: DataFrame, path: str) -> None:
    """One file for each row of a ``text`` column (its bytes and a line feed), all in one new folder.

    Hadoop's local file system starts a process for each file that it makes, to set its mode, so in a shared
    folder that is mounted the tasks write the files themselves. Elsewhere tasks move their files to the
    folder, since the driver would move them one by one. The folder is whole once this has returned.
    """
    spark = texts.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getUri().getScheme() == "file":
        _write_mounted(texts, store.makeQualified(place).toUri().getPath())
        return
    writer = texts.select("text").write.option("maxRecordsPerFile", 1)
    writer.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)


def _write_mounted(texts: DataFrame, folder: str) -> None:
    """Files are named by partition and attempt. Those of an attempt that failed are deleted."""
    os.makedirs(folder)

    def write(batches):
        task = TaskContext.get()
        part = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        n = 0
        for batch in batches:
            for text in batch["text"]:
                with open(f"{folder}/{part}-c{n:06d}.txt", "wb") as file:
                    file.write((text.as_py() or b"") + b"\n")
                n += 1
        if n:
            yield pa.RecordBatch.from_pydict({"part": [part], "n": [n]})

    raw = texts.select(F.col("text").cast("binary").alias("text"))
    whole = {r["part"]: r["n"] for r in raw.mapInArrow(write, "part string, n bigint").collect()}
    with os.scandir(folder) as entries:
        for entry in entries:
            if entry.name.rsplit("-", 1)[0] not in whole:
                os.remove(entry.path)


def compact(documents: DataFrame, path: str) -> DataFrame:
    """Stores documents that were read from many small files as a table, which later jobs read
    instead: a folder of files is listed and opened once."""
    documents.write.parquet(path)
    return documents.sparkSession.read.parquet(path)


def union_classes(positive: DataFrame, negative: DataFrame) -> DataFrame:
    """One corpus of both classes."""
    return positive.unionByName(negative)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """One ``name,prediction`` line each, without header or quotes; replaces what is there."""
    line = F.concat_ws(",", F.col("name").cast("string"), F.col("prediction").cast("string"))
    predictions.select(line.alias("value")).write.mode("overwrite").text(path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Reads prediction lines back; the name may hold commas, the prediction cannot."""
    line = F.col("value")
    prediction = F.substring_index(line, ",", -1)
    return spark.read.text(path).select(
        F.substring(line, F.lit(1), F.length(line) - F.length(prediction) - 1).alias("name"),
        prediction.cast("double").alias("prediction"),
    )

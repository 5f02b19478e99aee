"""One query for each operator of this package, and SQL where it has a form in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonewright.llm import (
    bpe_automaton,
    exact_search,
    importance,
    language_id,
    near_duplicates,
    oracles,
    packing,
    periodic_runs,
    pii,
    quality,
    sharding,
    suffix_dedup,
    token_files,
    tool_calls,
)
from tonewright.llm.shipping import ship
from tonewright.sources import workspace

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf}/documents.parquet")


def op1_packing(spark: SparkSession, sf: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf))
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "loss_tokens",
    )


def op2_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    cleaned = suffix_dedup.remove_repeats(_documents(spark, sf))
    return cleaned.select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf}/conversations.parquet")
    formatted = tool_calls.format_turns(turns, tool_calls.turn_schemas(spark))
    return formatted.select(
        "conv_id",
        "call_id",
        "order_turn",
        "order_step",
        "in_cycle",
        "status",
        F.array_join("errors", "|").alias("errors"),
        F.sha2(F.col("json").cast("binary"), 256).alias("json_sha256"),
    )


def op4_language(spark: SparkSession, sf: str) -> DataFrame:
    found = language_id.identify(_documents(spark, sf).select("doc_id", "text", "lang"))
    return found.select(
        "doc_id",
        language_id.held_out(F.col("doc_id")).alias("held_out"),
        F.col("identified.lang").alias("lang_pred"),
        F.col("identified.score").alias("score"),
    )


def op5_quality(spark: SparkSession, sf: str) -> DataFrame:
    judged, _ = quality.judge(_documents(spark, sf))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "votes",
        "quality",
    )


def op6_exact_search(spark: SparkSession, sf: str) -> DataFrame:
    ship(spark)
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return exact_search.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


def op7_bpe(spark: SparkSession, sf: str) -> DataFrame:
    coded = bpe_automaton.encode_decode(_documents(spark, sf))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_pii(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.find(_documents(spark, sf))
    return found.select(
        "row.doc_id",
        *(pii.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in pii.KINDS[: pii.BASE]),
        F.sha2(pii.listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def op9_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates.near_duplicates(_documents(spark, sf))


def op10_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed, _ = sharding.shard_records(_documents(spark, sf), shards=24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
        "map_version",
    )


def op11_token_files(spark: SparkSession, sf: str) -> DataFrame:
    folder = f"{workspace.shared_folder(spark)}/token-files-{workspace.new_name()}"
    token_files.write(_documents(spark, sf), folder)
    return token_files.read(spark, folder).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op12_importance(spark: SparkSession, sf: str) -> DataFrame:
    target = spark.read.parquet(f"{sf}/benchmark.parquet")
    drawn = importance.resample(_documents(spark, sf), target)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf).select("doc_id", "text")
    docs = docs.withColumn("text", periodic_runs.planted(F.col("doc_id"), F.col("text")))
    found = periodic_runs.find_runs(docs)
    first = F.array_sort("runs", periodic_runs.longest_first).getItem(0)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return found.select(
        "doc_id", "runs", "collapsed", F.when(F.size("runs") > 0, first).alias("longest")
    ).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        *(F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period")),
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_tool_calls": op3_tool_calls,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_exact_search": op6_exact_search,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_sharding": op10_sharding,
    "op11_token_files": op11_token_files,
    "op12_importance": op12_importance,
    "op13_periodic_runs": op13_periodic_runs,
}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": oracles.SUFFIX_DEDUP,
    "op6_exact_search": oracles.EXACT_SEARCH,
    "op9_near_duplicates": oracles.NEAR_DUPLICATES,
    "op12_importance": oracles.IMPORTANCE,
    "op13_periodic_runs": oracles.PERIODIC_RUNS,
}

"""Small extracts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_per_class(
    corpus: DataFrame, k: int = 1000, label: str = "label", order: str = "name", shards: int = 256
) -> DataFrame:
    """The first ``k`` documents of each class in name order.

    There are only two classes, so ranking each in one task would put half of the corpus there.
    Each class is ranked in shards first; what is left for the last ranking is at most
    ``k * shards`` rows of a class. The text is not needed to rank.
    """
    shard = F.pmod(F.xxhash64(order), F.lit(shards))
    within = Window.partitionBy(label, "shard").orderBy(order)
    overall = Window.partitionBy(label).orderBy(order)
    ranked = (
        corpus.withColumn("shard", shard)
        .withColumn("rank", F.row_number().over(within))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(overall))
        .where(F.col("rank") <= k)
    )
    return ranked.drop("shard", "rank")


def with_documents(chosen: DataFrame, documents: DataFrame) -> DataFrame:
    """The chosen rows with their texts.

    At most ``k`` rows of each class were chosen, so the texts of all others stay unread by the
    join: the small side is the one to be sent.
    """
    return documents.join(F.broadcast(chosen), "doc_id")

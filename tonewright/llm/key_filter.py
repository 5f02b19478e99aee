"""A bitmap of bounded size that lets tasks skip rows whose key can't be among chosen ones.

Collisions only let more rows through, so whoever uses it decides exactly afterwards. When there are
far more keys than bits nothing is skipped, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonewright.llm.batches import giving_back

#: 4 MB, whatever the input.
BITS = 1 << 25


def bits_of(keys: DataFrame, column: str) -> bytes:
    """The bitmap of a column of 64-bit hashes; at most BITS / 32768 rows of 4 KB are collected."""
    at = F.col(column).bitwiseAND(F.lit(BITS - 1))
    parts = (
        keys.select((at / 32768).cast("int").alias("part"), (at % 32768).alias("bit"))
        .groupBy("part")
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
        .collect()
    )
    bits = bytearray(BITS // 8)
    for row in parts:
        bits[row["part"] * 4096 : (row["part"] + 1) * 4096] = row["bits"]
    return bytes(bits)


@giving_back
def chosen(batches: Iterator[pa.RecordBatch], bits: bytes, present: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows whose first column, a 64-bit hash, has its bit set, or not set."""
    mask = np.frombuffer(bits, dtype=np.uint8)
    for batch in batches:
        at = batch.column(0).to_numpy(zero_copy_only=False) & (BITS - 1)
        yield batch.filter(pa.array(((mask[at >> 3] >> (at & 7)) & 1 == 1) == present))

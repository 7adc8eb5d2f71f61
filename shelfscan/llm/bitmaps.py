"""Key filters of a fixed size, for map-side pruning before a shuffle.

A filter holds one bit for each residue of a 64-bit key. Its size does not depend on
the data, so it may always be broadcast; it never loses a key, and as it fills up it
only lets more rows pass to the exact join behind it.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SEGMENT = 32768


def key_filter(df: DataFrame, key: str | Column, bits: int) -> Broadcast:
    """Broadcast filter of the key's values; at most bits / 32768 rows of 4 KB reach the driver."""
    bit = F.pmod(F.col(key) if isinstance(key, str) else key, F.lit(bits)) + 1  # these functions count from 1
    rows = (
        df.select(bit.alias("bit"))
        .groupBy(F.bitmap_bucket_number("bit").alias("segment"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("part"))
        .where("segment is not null")
        .collect()
    )
    held = np.zeros((bits // _SEGMENT, _SEGMENT // 8), dtype=np.uint8)
    for row in rows:
        held[row["segment"] - 1] = np.frombuffer(row["part"], dtype=np.uint8)
    return df.sparkSession.sparkContext.broadcast(held.reshape(-1))


def passes(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys may be in the filter; none of its keys is refused."""
    bit = keys.astype(np.uint64) & np.uint64(len(held) * 8 - 1)
    return (held[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1

"""Bitmaps of fixed size over 64-bit hashes, for filters that may pass too much but never too little."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP_BITS = 1 << 24


def has_bit(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes are in the bitmap."""
    place = hashes & np.uint64(BITMAP_BITS - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def bitmap_of(keys: DataFrame) -> np.ndarray:
    """The bitmap of the column ``key``, put together by an aggregation.

    The driver gets at most ``BITMAP_BITS / 32`` numbers, whatever the data.
    """
    words = (
        keys.select(F.expr(f"key & {BITMAP_BITS - 1}L").alias("place"))
        .select(F.shiftright("place", 5).alias("word"), F.expr("shiftleft(1L, int(place & 31L))").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    table = words.toArrow()
    out = np.zeros(BITMAP_BITS // 32, np.uint32)
    out[table["word"].to_numpy()] = table["bits"].to_numpy().astype(np.uint32)
    return out.view(np.uint8)

"""Broadcast bitmaps of bounded size that screen rows before a shuffle.

A screen has no false negatives: a row whose bit is unset is proven not to matter.  What passes wrongly costs a shuffled
row and changes no result, so beyond the bound a screen only gets weaker.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Largest number of bits of a screen; 2^28 bits are 32 MB in every worker.
MAX_BITS = 1 << 28


def bits_for(n: int, per_entry: int = 16, max_bits: int = MAX_BITS) -> int:
    """A power of two with at least ``per_entry`` bits an entry, within the bound."""
    return min(max_bits, 1 << max(10, (max(n, 1) * per_entry - 1).bit_length()))


def packed(df: DataFrame, position: Column, bits: int) -> np.ndarray:
    """The set positions as 64-bit words; words are put together by the executors, at most bits / 64 of them."""
    words = (
        df.select(position.alias("p"))
        .groupBy(F.shiftright("p", 6).alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("set"))
        .toArrow()
    )
    screen = np.zeros((bits + 63) >> 6, np.uint64)
    screen[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
    return screen


def passes(screen: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Whether the bit of each position is set."""
    positions = positions.astype(np.int64)
    return (screen[positions >> 6] >> (positions & 63).astype(np.uint64)) & np.uint64(1) != 0

"""A bitmap of fixed size of 64-bit hashes, for tasks to skip rows that surely have no partner.

It has no misses. Where more hashes are marked than it has room for, more rows pass than needed, and none is lost.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def marked(rows: DataFrame, hashes: str, bits: int) -> bytes:
    """Bitmap of the top ``bits`` bits of the column ``hashes`` (long); at most 2 ** (bits - 6) rows reach the driver."""
    bit = f"shiftrightunsigned(`{hashes}`, {64 - bits})"
    words = rows.selectExpr(f"{bit} >> 6 AS word", f"shiftleft(1L, CAST({bit} & 63 AS INT)) AS bits")
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bitmap = np.zeros(max(1, 1 << (bits - 6)), np.int64)
    bitmap[found["word"].to_numpy()] = found["bits"].to_numpy()
    return bitmap.tobytes()


def may_hold(bitmap: bytes, hashes: np.ndarray, bits: int) -> np.ndarray:
    """Which of the hashes (uint64) may be marked."""
    words = np.frombuffer(bitmap, np.uint64)
    bit = hashes >> np.uint64(64 - bits)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

"""Measured sizes, so that only proven small frames are broadcast."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Extent:
    """Row count, approximate bytes, and (lowest, highest) literals of the columns that hold any value."""

    rows: int
    bytes: int
    ranges: dict[str, tuple[Column, Column]] = field(default_factory=dict)

    @property
    def fits(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.bytes <= BROADCAST_BYTES


def extent(df: DataFrame, range_of: Sequence[str] = ()) -> Extent:
    """One distributed aggregate over ``df``; only a single row reaches the driver."""
    width = F.lit(0)
    for name in df.columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) + F.lit(8)
    ends = []
    for i, name in enumerate(range_of):
        kind = df.schema[name].dataType
        ends += [carried(F.min(name), kind).alias(f"low_{i}"), carried(F.max(name), kind).alias(f"high_{i}")]
    row = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes"), *ends).first()
    ranges = {
        name: tuple(restored(F.lit(row[f"{end}_{i}"]), df.schema[name].dataType) for end in ("low", "high"))
        for i, name in enumerate(range_of)
        if row[f"low_{i}"] is not None
    }
    return Extent(row["rows"], row["bytes"], ranges)


def carried(value: Column, kind: T.DataType) -> Column:
    """Times travel as numbers or text, since Python's would depend on the driver's time zone."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    return value.cast("string") if isinstance(kind, T.TimestampNTZType) else value


def restored(value: Column, kind: T.DataType) -> Column:
    """What ``carried`` made, as a value of ``kind`` again."""
    return F.timestamp_micros(value) if isinstance(kind, T.TimestampType) else value.cast(kind)


def distinct_extent(df: DataFrame) -> Extent:
    """Extent of the distinct rows of ``df``, with the range of every column.

    Most frames that are too large show it in an estimate, which needs no shuffle; only the others are counted.
    """
    estimate = df.agg(F.approx_count_distinct(F.struct(*df.columns), 0.02).alias("n")).first()["n"]
    if estimate > 1.2 * BROADCAST_ROWS:
        return Extent(estimate, BROADCAST_BYTES + 1)
    return extent(df.distinct(), range_of=df.columns)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it, else as it is (a shuffled join)."""
    return F.broadcast(df) if extent(df).fits else df

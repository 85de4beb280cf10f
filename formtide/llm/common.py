"""Small helpers for column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the white space that parts words.
SPACE = r"[\x20\x09-\x0D]+"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row, also where ``use`` reads it inside another lambda."""
    return F.transform(F.array(value), use)[0]


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text: what stands between ASCII white space."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def steps(count: Column) -> Column:
    """0, 1, ... count - 1; empty for counts below 1."""
    return F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))

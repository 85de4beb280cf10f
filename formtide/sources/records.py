"""Request records: inline rows and JSON objects turned into typed rows."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def inline_rows(spark: SparkSession, rows: Iterable[tuple], ddl: str) -> DataFrame:
    """A few literal rows with a declared schema."""
    return spark.createDataFrame(list(rows), ddl)


def request_frame(spark: SparkSession, records: Iterable[Mapping[str, Any]], ddl: str) -> DataFrame:
    """A request body (a list of objects) as typed rows; fields absent from an object are null."""
    lines = spark.createDataFrame([(json.dumps(dict(r), default=str),) for r in records], "body string")
    return expand_records(lines, "body", ddl, keep=())


def expand_records(df: DataFrame, body: str | Column, ddl: str, keep: Iterable[str] | None = None) -> DataFrame:
    """Parse a JSON object column into the columns of ``ddl``, next to ``keep`` (default: all other columns)."""
    schema = T.StructType.fromDDL(ddl) if hasattr(T.StructType, "fromDDL") else T._parse_datatype_string(ddl)
    if keep is None:
        keep = [c for c in df.columns if c != body]
    parsed = df.select(*keep, F.from_json(body, schema).alias("_record"))
    return parsed.select(*keep, *[F.col(f"_record.`{f.name}`").alias(f.name) for f in schema.fields])

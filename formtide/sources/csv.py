"""Typed results from headered CSV files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from formtide.config import ParsingConfig
from formtide.functions.scalar import lenient_timestamp

# The texts that the common dataframe CSV readers take as missing.
MISSING_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Column of the raw table that holds the whole text of records that do not have the header's number of values.
MALFORMED = "_malformed"


def load_results(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None,
    parsing: ParsingConfig,
    strict: bool = False,
) -> DataFrame:
    """Read ``columns`` (in that order) from CSV, rename them and give them types.

    Absent columns are left out, or raise with ``strict``. Unreadable values become null; ``load_with_rejects`` tells which.
    The parsed time is always called ``date``, whichever column it came from.
    """
    raw, kept, types = _raw(spark, path, columns, parsing, strict)
    return typed_results(raw, kept, parsing, types)


def load_with_rejects(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None,
    parsing: ParsingConfig,
    strict: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(the typed rows as of ``load_results``, what could not be read).

    The second has a row for each value that is present but not of its column's type (column, value, expected), and one for
    each record with more or fewer values than the header (no column, the record's text as the value).
    """
    raw, kept, types = _raw(spark, path, columns, parsing, strict, malformed=True)
    return typed_results(raw, kept, parsing, types), rejected_values(raw, kept, parsing, types)


def _raw(
    spark: SparkSession, path: str, columns: Sequence[str] | None, parsing: ParsingConfig, strict: bool, malformed: bool = False
) -> tuple[DataFrame, list[str], dict[str, str]]:
    """(the file's columns as text, those that are wanted, their types)."""
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=parsing.multi_line)
    header = reader.csv(path).columns
    wanted = list(columns) if columns is not None else header
    missing = [c for c in wanted if c not in header]
    if strict and missing:
        raise ValueError(f"columns not in the file: {', '.join(missing)}")
    rename = dict(parsing.rename or {})
    kept = {c: rename.get(c, c) for c in wanted if c in header}
    types = dict(parsing.types)
    text = {*parsing.categories, parsing.date_column}
    if any(name not in text and name not in types for name in kept.values()):
        inferred = reader.option("inferSchema", True).csv(path).schema
        types = {rename.get(f.name, f.name): _widened(f.dataType) for f in inferred.fields} | types
    # Every column is read as text by name; the parser still skips the ones not selected.
    as_text = T.StructType([T.StructField(c, T.StringType()) for c in [*header, *([MALFORMED] if malformed else [])]])
    reader = reader.schema(as_text).options(enforceSchema=False, inferSchema=False)
    if malformed:
        reader = reader.options(enforceSchema=True, columnNameOfCorruptRecord=MALFORMED)
    return reader.csv(path), list(kept), types


def typed_results(
    raw: DataFrame, columns: Sequence[str], parsing: ParsingConfig, types: Mapping[str, str] | None = None
) -> DataFrame:
    """Text columns to typed ones: missing markers to null, names and types as configured, ``date`` parsed.

    Columns without a configured type stay text.
    """
    rename = dict(parsing.rename or {})
    kept = {c: rename.get(c, c) for c in columns if c in raw.columns}
    lost = [c for c in (*parsing.categories, parsing.date_column) if c not in kept.values()]
    if lost:
        raise ValueError(f"configured columns not in the file: {', '.join(lost)}")
    types = parsing.types if types is None else types
    typed = []
    for source, name in kept.items():
        text = F.col(f"`{source}`")
        value = F.when(~text.isin(*MISSING_TEXTS), text)
        as_is = name in parsing.categories or name == parsing.date_column or name not in types
        typed.append((value if as_is else value.try_cast(types[name])).alias(name))
    return raw.select(*typed).withColumn("date", lenient_timestamp(parsing.date_column, parsing.date_format))


def rejected_values(
    raw: DataFrame, columns: Sequence[str], parsing: ParsingConfig, types: Mapping[str, str] | None = None
) -> DataFrame:
    """(column, value, expected) of the texts that ``typed_results`` makes null although they are not missing.

    Where ``raw`` has the column MALFORMED, its values come too, without a column. Names are those after renaming.
    """
    rename = dict(parsing.rename or {})
    types = parsing.types if types is None else types
    found = []
    for source in columns:
        name, text = rename.get(source, source), F.col(f"`{source}`")
        if name == parsing.date_column:
            read, expected = lenient_timestamp(source, parsing.date_format), parsing.date_format or "time"
        elif name in types and name not in parsing.categories:
            read, expected = text.try_cast(types[name]), types[name]
        else:
            continue
        bad = ~text.isin(*MISSING_TEXTS) & read.isNull()
        found.append(F.when(bad, F.struct(F.lit(name).alias("column"), text.alias("value"), F.lit(expected).alias("expected"))))
    if MALFORMED in raw.columns:
        whole = F.struct(F.lit(None).cast("string").alias("column"), F.col(MALFORMED).alias("value"), F.lit("record").alias("expected"))
        found.append(F.when(F.col(MALFORMED).isNotNull(), whole))
    if not found:
        return raw.sparkSession.createDataFrame([], "column string, value string, expected string")
    return raw.select(F.inline(F.filter(F.array(*found), lambda x: x.isNotNull())))


def _widened(kind: T.DataType) -> str:
    if isinstance(kind, (T.IntegerType, T.LongType)):
        return "bigint"
    if isinstance(kind, (T.DoubleType, T.BooleanType)):
        return kind.simpleString()
    return "string"

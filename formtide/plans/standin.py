"""Match results derived from order lines, for checks on tables that hold no matches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MATCHES_SQL = """
  SELECT l_shipdate AS date,
         concat('S', l_suppkey) AS team_1,
         concat('S', l_partkey % 100) AS team_2,
         concat(l_returnflag, l_linestatus) AS map_name,
         CASE WHEN l_quantity > 25 THEN 1 ELSE 2 END AS map_winner,
         1 + l_linenumber % 2 AS starting_ct,
         l_linenumber AS rank_1,
         CAST(l_quantity AS INT) AS rank_2
  FROM lineitem
  WHERE l_suppkey <> l_partkey % 100
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def matches(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order line: supplier against part group, the flags as the map, the larger half wins."""
    opponent = F.col("l_partkey") % 100
    return (
        table(spark, folder, "lineitem")
        .where(F.col("l_suppkey") != opponent)
        .select(
            F.col("l_shipdate").alias("date"),
            F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias("team_1"),
            F.concat(F.lit("S"), opponent.cast("string")).alias("team_2"),
            F.concat("l_returnflag", "l_linestatus").alias("map_name"),
            F.when(F.col("l_quantity") > 25, 1).otherwise(2).alias("map_winner"),
            (1 + F.col("l_linenumber") % 2).alias("starting_ct"),
            F.col("l_linenumber").alias("rank_1"),
            F.col("l_quantity").cast("int").alias("rank_2"),
        )
    )

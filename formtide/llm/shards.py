"""Sharding by a hierarchical weighted hash tree.

Documents descend from regions to racks to shards. At each level every child draws -ln(u) / weight from a hash of key and
child, and the smallest draw wins, so a child gets its share by weight. A draw depends on nothing but key, child and its own
weight: if weights change, keys move only into or out of subtrees whose weight changed, and ``grow`` puts a new shard into a
region of its own, so that whatever moves goes to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formtide.llm.common import text_of
from formtide.operators.sizing import broadcast_if_small
from formtide.session import materialize

RACK_SHARDS = 4
REGION_RACKS = 2


@dataclass(frozen=True)
class Tree:
    """Weights by region, rack and shard. Shards are numbered from left to right."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]

    @property
    def shards(self) -> int:
        return sum(len(rack) for region in self.regions for rack in region)

    def grow(self, weight: float = 1.0) -> Tree:
        return Tree((*self.regions, ((weight,),)))


def even_tree(shards: int) -> Tree:
    """A tree of equal weights, filled rack by rack."""
    racks = [(1.0,) * min(RACK_SHARDS, shards - k) for k in range(0, shards, RACK_SHARDS)]
    return Tree(tuple(tuple(racks[k : k + REGION_RACKS]) for k in range(0, len(racks), REGION_RACKS)))


def _winner(key: Column, children: list[tuple[int, float]], level: str, base: str) -> Column:
    """The child with the smallest draw; children of weight 0 never win unless all are."""

    def draw(child: int, weight: float) -> Column:
        bits = F.shiftrightunsigned(F.xxhash64(F.lit(f"{level}/{base}/{child}"), key), 11)
        size = -F.log((bits + F.lit(0.5)) / F.lit(float(1 << 53)))
        return F.struct((size / F.lit(weight) if weight > 0 else F.lit(float("inf"))).alias("draw"), F.lit(child).alias("child"))

    return F.array_min(F.array(*(draw(c, w) for c, w in children)))["child"]


def _case(of: Column, choices: list[tuple[int, Column]]) -> Column:
    out = F.when(of == choices[0][0], choices[0][1])
    for value, choice in choices[1:]:
        out = out.when(of == value, choice)
    return out


def place(docs: DataFrame, tree: Tree, key: str = "doc_id", name: str = "shard") -> DataFrame:
    """``docs`` with ``name`` (int), decided by the key and the tree alone. All null keys share one shard."""
    k = F.col(key).cast("string")
    totals = [[sum(rack) for rack in region] for region in tree.regions]
    region = _winner(k, [(i, sum(t)) for i, t in enumerate(totals)], "region", "")
    rows = docs.withColumn("__region", region)
    racks = [(i, _winner(k, list(enumerate(t)), "rack", str(i))) for i, t in enumerate(totals)]
    rows = rows.withColumn("__rack", _case(F.col("__region"), racks))
    first, cases = 0, []
    for i, racks_of in enumerate(tree.regions):
        inner = []
        for j, rack in enumerate(racks_of):
            inner.append((j, F.lit(first) + _winner(k, list(enumerate(rack)), "shard", f"{i}/{j}")))
            first += len(rack)
        cases.append((i, _case(F.col("__rack"), inner)))
    return rows.withColumn(name, _case(F.col("__region"), cases).cast("int")).drop("__region", "__rack")


def number_slots(rows: DataFrame, shard: str = "shard", order: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``rows`` with ``slot`` (long): 0, 1, ... within each shard, without gaps.

    Rows are written once with the input partition they came from. Each (shard, partition) is numbered on its own and shifted
    by the rows of the partitions before it, so neither a shard nor a repeated key gathers in one task. Within a partition
    slots follow ``order``; equal rows are numbered as they come.
    """
    stored = materialize(rows.withColumn("__part", F.spark_partition_id()), "slots")
    parts = stored.groupBy(shard, "__part").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(shard).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(shard, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    within = Window.partitionBy(shard, "__part").orderBy(*order)
    numbered = stored.withColumn("__row", F.row_number().over(within))
    joined = numbered.join(broadcast_if_small(materialize(offsets, "offsets")), [shard, "__part"])
    return joined.withColumn("slot", (F.col("__offset") + F.col("__row") - 1).cast("long")).select(*rows.columns, "slot")


def shard_documents(docs: DataFrame, shards: int) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law ("key"), shard, slot and grown_shard (with one shard more).

    A null text counts as an empty one; repeated rows get slots of their own.
    """
    text = text_of()
    tree = even_tree(shards)
    rows = docs.select(
        "doc_id",
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(place(rows, tree), tree.grow(), name="grown_shard")
    slots = number_slots(rows, order=("doc_id", "size", "text_crc32"))
    return slots.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")

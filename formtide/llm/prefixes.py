"""Prefix trie of conversations by ROLLUP over positional turn columns.

A conversation is a row of blocks, a block a row with the ids of up to WIDTH consecutive turns in positional columns. One
``GROUP BY block, key, ROLLUP (t1, ..., tWIDTH)`` aggregates the prefixes of all lengths together; ``grouping_id`` tells how
long each is. ``key`` stands for the node at which the block before ended, so conversations of any length go on in further
blocks of the same statement. Those keys are made along runs of RUN blocks, level by level of a tree over the runs, so the
number of rounds is the logarithm of the longest conversation, and no cell holds more than RUN entries.

Sums over subtrees need no walk down the trie. Each node is owned by its smallest member; a conversation owns the nodes of
its path from some depth on. What a subtree holds is what its members own, less what its owner owns above it: a second
ROLLUP over the same blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formtide.session import materialize

#: Turns of a block, which are the columns of the ROLLUP.
WIDTH = 8
#: Blocks of a run.
RUN = 64
#: Conversations whose first turns are taken from one of them, and the number of lengths that these may have.
FAMILY = 5
LENGTHS = 9
#: Members of one packed piece of a list.
PACK = 1 << 15

_IDS = [f"t{j + 1}" for j in range(WIDTH)]


def numbered_turns(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, id) of every turn, (id, size) of every distinct turn).

    Positions count from 1 by turn, null first; turns of one number are in order of a digest of role and text. They are counted
    within range partitions and carried over from one to the next, so a conversation of any length is dealt over tasks. An
    id stands for one (role, text); a 256-bit digest of both tells them apart.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    dealt = rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id())
    dealt = materialize(dealt, "turns")
    counts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("conv_id", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(*order))
    kinds = dealt.groupBy("digest").agg(F.min("size").alias("size")).withColumn("id", F.monotonically_increasing_id())
    kinds = materialize(kinds, "kinds")
    placed = dealt.withColumn("own", own).join(counts, ["conv_id", "part"])
    placed = placed.select("conv_id", (F.col("own") + F.col("before")).alias("pos"), "digest")
    return placed.join(kinds.select("digest", "id"), "digest").select("conv_id", "pos", "id"), kinds.select("id", "size")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, n) of every conversation, (conv_id, pos, id) of its turns) after the first turns are those of another.

    Conversation c takes the first h turns of c - c % FAMILY, h = crc32(c) % LENGTHS, and goes on with its own after its
    first h. The first turns of a conversation are fewer than LENGTHS, so they travel as one short array.
    """
    turns = materialize(turns, "placed")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    heads = turns.filter(F.col("pos") < LENGTHS).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("pos", "id"))).alias("first"))
    take = (F.crc32(F.col("conv_id").cast("string")) % LENGTHS).cast("int")
    convs = sizes.select("conv_id", "own", take.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base"))
    convs = convs.join(heads.select(F.col("conv_id").alias("base"), "first"), "base", "left")
    # A slice of a null array is null: an absent conversation has no turns to give.
    head = F.coalesce(F.slice("first", F.lit(1), F.col("h")), F.array().cast("array<struct<pos:bigint,id:bigint>>"))
    convs = convs.select("conv_id", "h", "own", head.alias("head"))
    convs = materialize(convs.withColumn("n_head", F.size("head").cast("long")), "heads")
    taken = convs.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.pos", "t.id")
    kept = turns.join(convs.select("conv_id", "h", "n_head"), "conv_id").filter(F.col("pos") > F.col("h"))
    kept = kept.select("conv_id", (F.col("pos") - F.col("h") + F.col("n_head")).alias("pos"), "id")
    n = F.col("n_head") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return convs.select("conv_id", n.alias("n")), taken.unionByName(kept)


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat_ws(",", *parts), 256))


def _before(rows: DataFrame, count: int) -> DataFrame:
    """(conv_id, j, before): what stands for all of a conversation's entries before j, of rows (conv_id, j, own), j < count.

    Within a run the digests of its entries are chained; the run itself is an entry of the level above. Equal sequences of
    entries have equal digests, and different ones don't.
    """
    run = F.floor(F.col("j") / RUN).cast("long")
    runs = rows.groupBy("conv_id", run.alias("run")).agg(F.sort_array(F.collect_list(F.struct("j", "own"))).alias("items"))
    chain = lambda done, x: F.concat(done, F.array(F.sha2(F.concat_ws(",", F.element_at(done, -1), x["own"]), 256)))
    chained = F.aggregate("items", F.array(F.lit("")), chain)
    runs = runs.select("conv_id", "run", "items", chained.alias("chained"))
    if count > RUN:
        whole = runs.select("conv_id", F.col("run").alias("j"), F.element_at("chained", -1).alias("own"))
        above = _before(whole, -(-count // RUN)).withColumnRenamed("j", "run")
        runs = runs.join(above, ["conv_id", "run"])
    else:
        runs = runs.withColumn("before", F.lit(""))
    pairs = F.transform("items", lambda x, i: F.struct(x["j"].alias("j"), F.get("chained", i).alias("inner")))
    inner = runs.select("conv_id", F.explode(pairs).alias("p"), F.col("before").alias("outer")).select("conv_id", "p.j", "p.inner", "outer")
    return inner.select("conv_id", "j", F.concat_ws("/", "outer", "inner").alias("before"))


def blocks(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """(conv_id, block, key, last, n, t1, ..., tWIDTH): ids are null after the end; ``last`` marks a conversation's last block."""
    place = (F.col("pos") - 1) % WIDTH
    cells = [F.max(F.when(place == j, F.col("id"))).alias(name) for j, name in enumerate(_IDS)]
    rows = turns.groupBy("conv_id", F.floor((F.col("pos") - 1) / WIDTH).cast("long").alias("block")).agg(*cells)
    empty = convs.filter("n = 0").select("conv_id", F.lit(0).cast("long").alias("block"), *(F.lit(None).cast("long").alias(c) for c in _IDS))
    last = F.greatest(F.ceil(F.col("n") / WIDTH) - 1, F.lit(0)).cast("long")
    rows = rows.unionByName(empty).join(convs.select("conv_id", last.alias("last"), "n"), "conv_id")
    rows = materialize(rows, "blocks")
    longest = rows.agg(F.max("last")).first()[0] or 0
    # Only conversations that go on need keys; the first block's is empty.
    own = F.sha2(F.concat_ws(",", *_IDS), 256)
    more = rows.filter("last > 0").select("conv_id", F.col("block").alias("j"), own.alias("own"))
    keys = _before(more, longest + 1).select("conv_id", F.col("j").alias("block"), F.unhex(F.sha2("before", 256)).alias("key"))
    rows = rows.join(keys.filter("block > 0"), ["conv_id", "block"], "left")
    return rows.withColumns({"key": F.coalesce("key", F.lit(b"")), "last": F.col("block") == F.col("last")})


def _node(length: Column) -> Column:
    """Digest of the node ``length`` turns into a block."""
    ids = F.slice(F.array(*_IDS), F.lit(1), length)
    return _digest(F.col("block").cast("string"), F.hex("key"), F.array_join(ids, ","))


def _rolled(rows: DataFrame, *sums: str) -> DataFrame:
    """All nodes from blocks: (node, block, key, t1, ..., length, conv_id) and ``sums``, by one ROLLUP."""
    rows.createOrReplaceTempView("formtide_blocks")
    ids = ", ".join(_IDS)
    # grouping_id has a bit for each turn column that is rolled up, from the last on.
    length = f"{WIDTH} - CAST(bit_count(grouping_id()) AS INT)"
    rolled = rows.sparkSession.sql(
        f"SELECT block, key, {ids}, {length} AS length, min(conv_id) AS conv_id, {', '.join(sums)} "
        f"FROM formtide_blocks GROUP BY block, key, ROLLUP ({ids})"
    )
    rows.sparkSession.catalog.dropTempView("formtide_blocks")
    # A null at the end: the members ended before. No turns of a later block: the node is the block's before.
    reached = (F.col("length") > 0) & F.get(F.array(*_IDS), F.col("length") - 1).isNotNull()
    rolled = rolled.filter(reached | ((F.col("length") == 0) & (F.col("block") == 0)))
    return rolled.withColumn("node", _node(F.col("length")))


def _ends(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ids of the conversations that end at a node, numerically ascending.

    Sorted by range, so the members of one node may lie in many tasks; each packs its part, and only packs of up to PACK
    members meet where the digest is taken, one after the other.
    """
    length = F.size(F.filter(F.array(*_IDS), lambda x: x.isNotNull()))
    ends = rows.filter("last").select(_node(length).alias("node"), "conv_id")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "first", "ids"]
            )

        for batch in batches:
            for at, conv_id in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (at != node or len(ids) == PACK):
                    yield packed()
                    ids = []
                node = at
                ids.append(conv_id)
        if ids:
            yield packed()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            for at, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if at != node:
                    if state:
                        done.append((node, state.hexdigest()))
                    node, state = at, sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done], pa.string())], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    packs = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(pack, "node binary, first long, ids string")
    return packs.repartition("node").sortWithinPartitions("node", "first").mapInArrow(digest, "node binary, ends_sha256 string")


def trie(conversations: DataFrame) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens (long), ends_sha256 (string).

    Null roles and texts are empty. Rows without a conv_id belong to no conversation. Turns of one number, repeated rows
    among them, all count, in order of their digests. An empty table has no conversation, so no root, and gives no rows.
    Columns besides conv_id, turn, role and text are not read.
    """
    turns, sizes = numbered_turns(conversations)
    convs, turns = rebuilt(turns)
    rows = materialize(blocks(convs, turns), "keyed")
    nodes = _rolled(rows, "count(*) AS n_convs")
    last = F.get(F.array(*_IDS), F.col("length") - 1)
    nodes = nodes.withColumns({"id": last, "depth": F.col("block") * WIDTH + F.col("length")}).join(sizes, "id", "left")
    # The parent is one turn shorter in the same block, or where the members' block before ended.
    above = F.when(F.col("length") > 1, _node(F.col("length") - 1)).when((F.col("length") == 1) & (F.col("block") == 0), _node(F.lit(0)))
    nodes = nodes.withColumns({"inner": above, "weight": F.coalesce((F.col("n_convs") - 1) * F.col("size"), F.lit(0))})
    nodes = materialize(nodes.select("node", "inner", "block", "length", "conv_id", "depth", "n_convs", "weight"), "nodes")
    turned = nodes.filter("inner IS NULL AND depth > 0").select("node", "conv_id", (F.col("block") - 1).alias("block"))
    ended = turned.join(rows, ["conv_id", "block"]).select("node", _node(F.lit(WIDTH)).alias("outer"))
    nodes = nodes.join(ended, "node", "left").withColumn("parent", F.coalesce("inner", "outer"))
    nodes = nodes.select("node", "parent", "conv_id", "depth", "n_convs", "weight")

    children = nodes.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = Window.partitionBy("conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    nodes = nodes.join(children, "node", "left").fillna(0, ["n_children"])
    nodes = materialize(nodes.withColumn("higher", F.coalesce(F.sum("weight").over(above), F.lit(0))), "nodes")
    owned = nodes.groupBy("conv_id").agg(F.sum("weight").alias("weight"), F.count_if(F.col("n_children") == 0).alias("leaves"))
    shares = rows.join(owned, "conv_id", "left").fillna(0, ["weight", "leaves"])
    sums = _rolled(shares, "sum(weight) AS weight", "sum(leaves) AS n_leaves").select("node", F.col("weight").alias("all"), "n_leaves")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(sums, "node").join(_ends(rows), "node", "left").join(parents, "parent", "left")
    return out.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"),
        (F.col("all") - F.col("higher")).cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"),
    )

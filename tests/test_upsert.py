import random

import pytest

from formtide.operators.changes import latest_per_key
from formtide.streaming.upsert import SyncedTable

DDL = "team string, day int, version bigint, prediction int"


def rows(seed, n=200):
    rng = random.Random(seed)
    return [(rng.choice("ABC"), rng.randrange(10), v, rng.choice((1, 2))) for v in rng.sample(range(10_000), n)]


def add_file(spark, folder, part):
    spark.createDataFrame(part, DDL).coalesce(1).write.mode("append").parquet(folder)


def synced(spark, tmp_path):
    schema = spark.createDataFrame([], DDL).schema
    copy = SyncedTable(spark, str(tmp_path / "copy"), schema, ("team", "day"), ("version",))
    folder = str(tmp_path / "source")
    (tmp_path / "source").mkdir()
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    return copy, folder, stream


def expected(spark, parts):
    everything = spark.createDataFrame([r for part in parts for r in part], DDL)
    return sorted(map(tuple, latest_per_key(everything, ["team", "day"], ["version"]).collect()))


def state(copy):
    return sorted(map(tuple, copy.read().collect()))


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_final_state_does_not_depend_on_the_order_of_files(spark, tmp_path, order):
    parts = [rows(s) for s in range(4)]
    copy, folder, stream = synced(spark, tmp_path)
    for i in order:
        add_file(spark, folder, parts[i])
    query = copy.sync(stream)
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) == 4
    assert state(copy) == expected(spark, parts)


def test_only_new_files_are_applied_and_compaction_changes_nothing(spark, tmp_path):
    parts = [rows(s) for s in range(10, 14)]
    copy, folder, stream = synced(spark, tmp_path)
    assert copy.compact() is None and state(copy) == []
    add_file(spark, folder, parts[0])
    add_file(spark, folder, parts[1])
    copy.sync(stream).awaitTermination()
    assert copy.compact() == 1 and copy.compact() == 1
    assert state(copy) == expected(spark, parts[:2])
    add_file(spark, folder, parts[2])
    query = copy.sync(stream)
    query.awaitTermination()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 200
    add_file(spark, folder, parts[3])
    copy.sync(stream).awaitTermination()
    assert state(copy) == expected(spark, parts)
    assert copy.compact() == 3
    assert state(copy) == expected(spark, parts)


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    parts = [rows(s, 50) for s in range(20, 22)]
    copy, _, _ = synced(spark, tmp_path)
    for i, part in enumerate(parts):
        copy.apply_batch(spark.createDataFrame(part, DDL), i)
    once = state(copy)
    copy.apply_batch(spark.createDataFrame(parts[1], DDL), 1)
    assert state(copy) == once == expected(spark, parts)


def test_an_unlisted_base_is_ignored(spark, tmp_path):
    """As after a driver lost while folding."""
    copy, _, _ = synced(spark, tmp_path)
    copy.apply_batch(spark.createDataFrame(rows(1), DDL), 0)
    spark.createDataFrame(rows(2), DDL).write.parquet(f"{copy.root}/base/upto=7")
    assert state(copy) == expected(spark, [rows(1)])

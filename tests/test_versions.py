import random

import pytest
from pyspark.sql import functions as F

from formtide.operators.changes import AFTER, BEFORE, DELETE, INSERT
from formtide.plans import checks
from formtide.sources.tables import KeyViolation, TableStore
from formtide.sources.versions import VersionConflict, VersionedTable
from formtide.streaming.upsert import SyncedTable

DDL = "team string, day int, share double"


def frame(spark, seed):
    rng = random.Random(seed)
    keys = rng.sample([(t, d) for t in "ABC" for d in range(12)], 24)
    return spark.createDataFrame([(t, d, rng.choice([None, 0.0, 0.5])) for t, d in keys], DDL)


def state(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture
def versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "form"), ["team", "day"])
    for seed in range(4):
        table.publish(frame(spark, seed))
    return table


@pytest.mark.parametrize("kind", ["folder", "catalog"])
def test_a_reader_keeps_its_version(spark, tmp_path, kind):
    if kind == "folder":
        store = TableStore(spark, "league", "form", str(tmp_path))
    else:
        spark.sql(f"CREATE DATABASE kept LOCATION '{tmp_path}/warehouse'")
        store = TableStore(spark, "spark_catalog", "kept")
    store.create_keyed(frame(spark, 0), "form", ["team", "day"])
    reader = store.keyed("form", ["team", "day"]).df
    store.create_keyed(frame(spark, 1), "form", ["team", "day"], replace=True)
    assert state(reader) == state(frame(spark, 0)) == state(store.keyed("form", ["team", "day"], version=1).df)
    assert state(store.read("form")) == state(frame(spark, 1)) == state(store.read("form", version=2))
    assert [(p.version, p.rows) for p in store.versions("form").published()] == [(1, 24), (2, 24)]
    assert store.keyed("form", ["team", "day"]).checked and not store.keyed("form", ["team"]).checked
    with pytest.raises(KeyError, match="no version 3"):
        store.read("form", version=3)


def test_a_table_without_versions_is_not_replaced_by_a_view(spark, tmp_path):
    spark.sql(f"CREATE DATABASE plain LOCATION '{tmp_path}/warehouse'")
    store = TableStore(spark, "spark_catalog", "plain")
    store.write(frame(spark, 0), "form")
    with pytest.raises(ValueError, match="without versions"):
        store.create_keyed(frame(spark, 1), "form", ["team", "day"], replace=True)
    store.drop("form")
    store.create_keyed(frame(spark, 1), "form", ["team", "day"])
    store.drop("form")
    assert not store.exists("form")


def test_a_failed_write_leaves_the_version_before(spark, tmp_path, versions):
    broken = frame(spark, 9).withColumn("share", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        versions.publish(broken)
    assert versions.entry().version == 4 and state(versions.read()) == state(frame(spark, 3))
    store = TableStore(spark, "league", "form", str(tmp_path))
    store.create_keyed(frame(spark, 0), "keyed", ["team", "day"])
    with pytest.raises(KeyViolation):
        store.create_keyed(frame(spark, 0).union(frame(spark, 0)), "keyed", ["team", "day"], replace=True)
    assert len(store.versions("keyed").published()) == 1


def test_the_slower_of_two_writers_is_refused(spark, versions):
    with pytest.raises(VersionConflict, match="not 3"):
        versions.publish(frame(spark, 5), after=3)

    def overtaken(df, folder):
        df.write.parquet(folder)
        VersionedTable(spark, versions.place, versions.keys).publish(frame(spark, 6))

    with pytest.raises(VersionConflict, match="another writer"):
        versions.publish(frame(spark, 5), write=overtaken)
    assert state(versions.read()) == state(frame(spark, 6))
    assert versions.changes(4).count() == versions.changes(4, 5).count() > 0


@pytest.mark.parametrize(("first", "last"), [(0, 1), (0, 4), (1, 2), (1, 4), (2, 4), (3, None)])
def test_changes_lead_from_one_version_to_another(spark, versions, first, last):
    at = {tuple(r)[:2]: tuple(r) for r in versions.read(first).collect()} if first else {}
    feed = versions.changes(first, last).collect()
    for v in range(first + 1, (last or 4) + 1):
        step = [r for r in feed if r["version"] == v]
        for r in step:
            if r["change_type"] in (BEFORE, DELETE):
                assert at.pop((r["team"], r["day"])) == tuple(r)[:3]
        for r in step:
            if r["change_type"] in (AFTER, INSERT):
                assert (r["team"], r["day"]) not in at
                at[r["team"], r["day"]] = tuple(r)[:3]
        assert sorted(at.values(), key=str) == state(versions.read(v))
    assert {r["version"] for r in feed} <= set(range(first + 1, (last or 4) + 1))


def test_no_changes(spark, tmp_path, versions):
    assert versions.changes(4).count() == 0 == versions.changes(2, 2).count()
    for span in ((0, 5), (3, 2), (7, 9)):
        with pytest.raises(KeyError):
            versions.changes(*span)
    with pytest.raises(KeyError):
        VersionedTable(spark, str(tmp_path / "nothing"), ["team"]).changes(0)


def test_changes_of_a_lost_writer_are_brought_to_their_place(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "form"), ["team", "day"])
    table.publish(frame(spark, 0))
    with monkeypatch.context() as lost:
        lost.setattr(VersionedTable, "settle", lambda self: None)
        table.publish(frame(spark, 1))
    assert not (tmp_path / "form/changes/version=2").exists()
    assert table.changes(1).count() > 0 and (tmp_path / "form/changes/version=2").exists()


def test_a_new_column_is_null_in_older_rows(spark, versions):
    versions.publish(frame(spark, 3).withColumn("n", F.lit(1)))
    feed = versions.changes(3)
    assert {r["n"] for r in feed.where("version = 4").collect()} == {None}
    assert {(r["change_type"], r["n"]) for r in feed.where("version = 5").collect()} == {(BEFORE, None), (AFTER, 1)}


# --- copies that follow the log -------------------------------------------------------------------------------


def copy_of(spark, versions, root):
    changes = versions.change_stream(maxFilesPerTrigger=1)
    return SyncedTable(spark, str(root), changes.schema, versions.keys, ("version",), tombstone="deleted"), changes


def test_a_copy_follows_the_log_in_many_batches(spark, tmp_path, versions):
    for seed in range(4, 7):
        versions.publish(frame(spark, seed))
    copy, changes = copy_of(spark, versions, tmp_path / "copy")
    copy.start_from(versions.read(1))
    with pytest.raises(ValueError, match="base already"):
        copy.start_from(versions.read(1))
    query = copy.sync(changes)
    query.awaitTermination()
    assert len({p["batchId"] for p in query.recentProgress if p["numInputRows"]}) >= 5
    assert state(copy.read().drop("version")) == state(versions.read())
    copy.compact()
    assert state(copy.read().drop("version")) == state(versions.read())
    versions.publish(frame(spark, 20))
    copy.sync(versions.change_stream()).awaitTermination()
    assert state(copy.read().drop("version")) == state(versions.read())
    copy.compact(settled=F.col("version") <= 8)
    assert state(copy.read().drop("version")) == state(versions.read())
    assert copy._newest().count() == copy.read().count()  # no tombstone is left


@pytest.mark.parametrize("seed", range(3))
def test_deletes_in_any_order_replayed_and_compacted(spark, tmp_path, seed):
    ddl = "team string, version long, share int, deleted boolean"
    rng = random.Random(seed)
    rows = [(rng.choice("ABCDEF"), v, rng.randrange(9), rng.choice([True, False, None])) for v in range(60)]
    newest = {r[0]: r for r in sorted(rows, key=lambda r: r[1])}
    copy = SyncedTable(spark, str(tmp_path / "copy"), spark.createDataFrame([], ddl).schema, ("team",), ("version",), "deleted")
    rng.shuffle(rows)
    for batch in range(6):
        part = spark.createDataFrame(rows[10 * batch : 10 * batch + 10], ddl)
        copy.apply_batch(part, batch)
        if batch in (1, 3):
            copy.apply_batch(part, batch)
            copy.compact()
    want = sorted(r[:3] for r in newest.values() if not r[3])
    assert state(copy.read()) == want
    copy.compact()
    assert state(copy.read()) == want


def test_the_checked_query_takes_at_least_five_batches(spark):
    copy = checks._followed(spark, "/root/testdata/sf0.001")
    assert copy._pending(-1).select("batch").distinct().count() >= 5
    before = state(copy.read())
    copy.compact()
    assert state(copy.read()) == before

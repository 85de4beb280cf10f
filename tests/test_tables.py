import datetime as dt

import pytest
from pyspark.sql import functions as F

from formtide.sources.records import expand_records, request_frame
from formtide.sources.tables import KeyViolation, SchemaChange, TableStore, key_violations


@pytest.fixture(params=["folder", "catalog"])
def store(request, spark, tmp_path):
    if request.param == "folder":
        return TableStore(spark, "league", "form", str(tmp_path))
    name = f"form_{tmp_path.name}".replace("-", "_")
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/warehouse'")
    return TableStore(spark, "spark_catalog", name)


@pytest.fixture(scope="module")
def form(spark):
    rows = [("A", dt.datetime(2020, 1, d), d / 10) for d in (1, 2)] + [("B", dt.datetime(2020, 1, 1), 0.0)]
    return spark.createDataFrame(rows, "team string, date timestamp, share double")


def test_round_trip_and_schema_change(store, form):
    store.store_parsed(form)
    assert sorted(store.read("parsed_data").collect()) == sorted(form.collect())
    store.store_parsed(form.select("team"))
    assert store.read("parsed_data").columns == ["team"]


def test_splits_keep_their_schema(store, form):
    store.store_splits(form, form.limit(1))
    train, test = store.store_splits(form.limit(2), form)
    assert (train.count(), test.count()) == (2, 3)
    with pytest.raises(SchemaChange):
        store.store_splits(form.withColumn("share", F.lit(1)), form)


def test_keyed_table(store, form):
    table = store.create_keyed(form, "form", ["team", "date"], "date")
    assert table.keys == ("team",) and table.ts == "date" and table.features == ["share"]
    assert store.keyed("form", ["team", "date"], "date").primary_keys == ["team", "date"]


def test_bad_keys_are_refused(store, form):
    with pytest.raises(KeyViolation, match="team"):
        store.create_keyed(form, "bad", ["team"])
    nameless = form.withColumn("team", F.when(F.col("team") == "A", F.col("team")))
    with pytest.raises(KeyViolation):
        store.create_keyed(nameless, "nameless", ["team", "date"], "date")


def test_replace_keeps_good_data_from_bad(store, form):
    store.create_keyed(form, "form", ["team", "date"], "date")
    with pytest.raises(KeyViolation):
        store.create_keyed(form.union(form), "form", ["team", "date"], "date", replace=True)
    assert store.read("form").count() == 3
    store.create_keyed(form.limit(1), "form", ["team", "date"], "date", replace=True)
    assert store.read("form").count() == 1


def test_buckets_spare_the_shuffle(spark, form, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/warehouse'")
    store = TableStore(spark, "spark_catalog", "bucketed")
    table = store.create_keyed(form, "form", ["team", "date"], "date", cluster_buckets=4)
    plan = table.df.groupBy("team").agg(F.sum("share"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_violations_count_rows(form):
    found = key_violations(form, ["team"]).collect()
    assert [(r["team"], r["n_rows"]) for r in found] == [("A", 2)]


def test_request_records(spark):
    body = [{"date": "2020-03-06", "team_1": "A", "rank_1": 12}, {"date": "2020-03-07", "team_1": None}]
    rows = request_frame(spark, body, "date timestamp, team_1 string, rank_1 int")
    assert [tuple(r) for r in rows.collect()] == [
        (dt.datetime(2020, 3, 6), "A", 12),
        (dt.datetime(2020, 3, 7), None, None),
    ]


def test_malformed_records_are_null(spark):
    lines = spark.createDataFrame([(1, '{"k": 5}'), (2, "{oops"), (3, None)], "id int, body string")
    assert [tuple(r) for r in expand_records(lines, "body", "k bigint").orderBy("id").collect()] == [
        (1, 5),
        (2, None),
        (3, None),
    ]

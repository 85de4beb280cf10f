import datetime as dt

import pytest

from formtide.config import ParsingConfig
from formtide.sources.csv import load_results, load_with_rejects

HEADER = "date,team_1,team_2,_map,result_1,result_2,map_winner,event_id"
ROWS = """
2020-03-08,Red `Foxes,F.C. North,Harbour,16,10,1,77
2020-03-07,"Owls, Old",Red `Foxes,Mill,7,16,2,78
2020-13-45,Owls,NA,Mill,16,,1,79
soon,F.C. North,Owls,Harbour,3,16,2,80
2020-02-27,Two Words,Owls,Abbey,19,17,1,81
"""
COLUMNS = ["date", "team_1", "team_2", "_map", "not_there", "result_1", "result_2", "map_winner"]
TYPES = {"result_1": "bigint", "result_2": "bigint", "map_winner": "bigint"}


def parsing(**changes):
    values = {"categories": ("team_1", "team_2", "map_name"), "date_column": "date", "rename": {"_map": "map_name"}}
    return ParsingConfig(**(values | {"types": TYPES} | changes))


@pytest.fixture
def path(tmp_path):
    file = tmp_path / "results.csv"
    file.write_text(HEADER + ROWS)
    return str(file)


def test_typed_rows_in_configured_order(spark, path):
    df = load_results(spark, path, COLUMNS, parsing())
    assert df.dtypes == [
        ("date", "timestamp"),
        ("team_1", "string"),
        ("team_2", "string"),
        ("map_name", "string"),
        ("result_1", "bigint"),
        ("result_2", "bigint"),
        ("map_winner", "bigint"),
    ]
    day = dt.datetime
    assert [tuple(r) for r in df.collect()] == [
        (day(2020, 3, 8), "Red `Foxes", "F.C. North", "Harbour", 16, 10, 1),
        (day(2020, 3, 7), "Owls, Old", "Red `Foxes", "Mill", 7, 16, 2),
        (None, "Owls", None, "Mill", 16, None, 1),
        (None, "F.C. North", "Owls", "Harbour", 3, 16, 2),
        (day(2020, 2, 27), "Two Words", "Owls", "Abbey", 19, 17, 1),
    ]


def test_types_are_inferred_where_none_are_given(spark, path):
    df = load_results(spark, path, COLUMNS, parsing(types={}))
    assert df.dtypes == load_results(spark, path, COLUMNS, parsing()).dtypes


def test_strict_raises_on_absent_columns(spark, path):
    with pytest.raises(ValueError, match="not_there"):
        load_results(spark, path, COLUMNS, parsing(), strict=True)


def test_absent_category_raises(spark, path):
    with pytest.raises(ValueError, match="map_name"):
        load_results(spark, path, ["date", "team_1", "team_2"], parsing())


def test_time_is_always_called_date(spark, tmp_path):
    file = tmp_path / "other.csv"
    file.write_text("played,team\n2020-01-02 03:04:05,A\n")
    df = load_results(spark, str(file), None, ParsingConfig(categories=("team",), date_column="played"))
    assert df.dtypes == [("played", "string"), ("team", "string"), ("date", "timestamp")]
    assert df.first()["date"] == dt.datetime(2020, 1, 2, 3, 4, 5)


def test_only_selected_columns_are_parsed(spark, path):
    df = load_results(spark, path, ["date", "team_1", "team_2", "_map"], parsing()).select("team_1")
    assert "ReadSchema: struct<team_1:string>" in df._jdf.queryExecution().toString()


@pytest.fixture
def ugly(tmp_path):
    file = tmp_path / "ugly.csv"
    file.write_text(
        HEADER
        + '\n2020-03-08,"Red ""Foxes""\nof, the\n\nNorth",B,Mill,16,ten,1,77'  # line breaks and quotes in a value
        + "\n2020-13-45,A,B,Mill,x,1.5,1,78"
        + "\n2020-03-09,A,B,Mill,NA,,1,79"
        + "\n2020-03-10,A,B"  # too short
        + "\n2020-03-11,A,B,Mill,1,2,1,80,more\n"  # too long
    )
    return str(file)


def test_line_breaks_in_quotes(spark, ugly):
    rows = load_results(spark, ugly, COLUMNS, parsing()).collect()
    assert len(rows) == 5
    assert rows[0]["team_1"] == 'Red "Foxes"\nof, the\n\nNorth' and rows[0]["map_winner"] == 1


def test_rejects_name_every_value_that_was_lost(spark, ugly):
    typed, rejects = load_with_rejects(spark, ugly, COLUMNS, parsing())
    assert sorted(map(str, typed.collect())) == sorted(map(str, load_results(spark, ugly, COLUMNS, parsing()).collect()))
    found = sorted((tuple(r) for r in rejects.collect()), key=str)
    assert found == sorted(
        [
            ("result_2", "ten", "bigint"),
            ("date", "2020-13-45", "time"),
            ("result_1", "x", "bigint"),
            ("result_2", "1.5", "bigint"),
            (None, "2020-03-10,A,B", "record"),
            (None, "2020-03-11,A,B,Mill,1,2,1,80,more", "record"),
        ],
        key=str,
    )


def test_a_clean_file_has_no_rejects(spark, path, tmp_path):
    file = tmp_path / "clean.csv"
    file.write_text("played,team\n2020-01-02,A\n")
    clean = ParsingConfig(categories=("team",), date_column="played")
    assert load_with_rejects(spark, str(file), None, clean)[1].collect() == []
    assert [r["column"] for r in load_with_rejects(spark, path, COLUMNS, parsing())[1].collect()] == ["date", "date"]

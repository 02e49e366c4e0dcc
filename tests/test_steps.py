from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from qualitypipe import StepError, apply_steps


@pytest.fixture(scope="module")
def books(spark):
    return spark.createDataFrame(
        [
            ("b11", "Tides", 8.4, "soon", "north"),
            ("b12", "Moss", 31.9, "1998-11-03", "south"),
            ("b13", "Kites", 19.5, "2004-02-29", "south"),
            ("b14", "Ember", 12.0, "2011-06-30", "north"),
            ("b15", "Quill", 64.25, "2019-12-31", "attic"),
        ],
        "code string, title string, price double, printed string, shelf string",
    )


def _frame(df, *steps):
    return apply_steps(df, steps).frame


def _notes(df, *steps):
    return [(n.step_no, n.step, n.target, n.reason) for n in apply_steps(df, steps).notes]


def test_rename(books):
    step = {"type": "rename_columns", "mapping": {"title": "name", "gone": "here", "shelf": "place"}}
    assert _frame(books, step).columns == ["code", "name", "price", "printed", "place"]
    assert _notes(books, step) == [(1, "rename_columns", "gone", "column not found")]


def test_rename_to_a_name_that_differs_in_case_only(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(StepError, match="one name"):
        _frame(df, {"type": "rename_columns", "mapping": {"a": "B"}})
    assert _frame(df, {"type": "rename_columns", "mapping": {"a": "A"}}).columns == ["A", "b"]
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        assert _frame(df, {"type": "rename_columns", "mapping": {"a": "B"}}).columns == ["B", "b"]
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_rename_is_sequential(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    chain = {"type": "rename_columns", "mapping": {"a": "c", "c": "d"}}
    assert _frame(df, chain).columns == ["d", "b"]
    swap = {"type": "rename_columns", "mapping": {"a": "b", "b": "a"}}
    with pytest.raises(StepError, match="one name"):
        _frame(df, swap)


def test_rename_dotted_name(spark):
    df = spark.createDataFrame([(1,)], ["a.b"])
    assert _frame(df, {"type": "rename_columns", "mapping": {"a.b": "c"}}).first().c == 1


@given(names=st.lists(st.text("xyz.`", min_size=1, max_size=4), min_size=1, max_size=4, unique_by=str.lower))
@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
def test_rename_and_back_is_identity(spark, names):
    df = spark.createDataFrame([tuple(range(len(names)))], names)
    there = {name: f"new{i}" for i, name in enumerate(names)}
    back = {new: old for old, new in there.items()}
    result = _frame(
        df, {"type": "rename_columns", "mapping": there}, {"type": "rename_columns", "mapping": back}
    )
    assert result.columns == df.columns
    assert result.first() == df.first()


def test_cast(books):
    result = _frame(books, {"type": "cast_columns", "casts": {"price": "integer", "printed": "date", "shelf": "boolean"}})
    assert dict(result.dtypes) == {
        "code": "string", "title": "string", "price": "int", "printed": "date", "shelf": "boolean",
    }
    assert [(r.price, r.printed, r.shelf) for r in result.collect()] == [
        (8, None, None),
        (31, date(1998, 11, 3), None),
        (19, date(2004, 2, 29), None),
        (12, date(2011, 6, 30), None),
        (64, date(2019, 12, 31), None),
    ]


def test_cast_to_every_type(spark):
    df = spark.createDataFrame(
        [("7.9", "1.5", 3, "yes", "2023-01-02", "2023-01-02 03:04:05"), ("x", "y", None, "z", "w", "v")],
        "i string, d string, s int, b string, dt string, ts string",
    )
    casts = {"i": "integer", "d": "double", "s": "string", "b": "boolean", "dt": "date", "ts": "timestamp"}
    result = _frame(df, {"type": "cast_columns", "casts": casts})
    assert [t for _, t in result.dtypes] == ["int", "double", "string", "boolean", "date", "timestamp"]
    good, bad = result.collect()
    assert tuple(good) == (7, 1.5, "3", True, date(2023, 1, 2), datetime(2023, 1, 2, 3, 4, 5))
    assert tuple(bad) == (None,) * 6


def test_cast_notes(spark):
    df = spark.createDataFrame([(1, "2")], "n int, t string")
    step = {"type": "cast_columns", "casts": {"n": "date", "t": "integer", "gone": "date", "q": "long"}}
    result = apply_steps(df.withColumnRenamed("n", "n").selectExpr("*", "1 AS q"), [step])
    assert dict(result.frame.dtypes) == {"n": "int", "t": "int", "q": "int"}
    assert [n.target for n in result.notes] == ["gone", "q", "n"]
    assert "unsupported type: long" in result.notes[1].reason


def test_drop(books):
    step = {"type": "drop_columns", "columns": ["shelf", "absent", "code"]}
    assert _frame(books, step).columns == ["title", "price", "printed"]
    assert _notes(books, step) == []


def test_filter(books):
    assert _frame(books, {"type": "filter_rows", "condition": "price < 19.5"}).count() == 2
    null_drops = _frame(books, {"type": "filter_rows", "condition": "nullif(shelf, 'south') <> 'north'"})
    assert [r.code for r in null_drops.collect()] == ["b15"]
    assert _frame(books, {"type": "filter_rows"}).count() == 5


@pytest.mark.parametrize("condition", ["absent > 1", "price >", "max(price) > 1", True])
def test_filter_that_does_not_fit_is_left_out(books, condition):
    result = apply_steps(books, [{"type": "filter_rows", "condition": condition}])
    assert result.frame.count() == 5
    assert len(result.notes) == 1


def test_runtime_errors_surface(books):
    result = apply_steps(books, [{"type": "filter_rows", "condition": "cast(printed AS int) > 1"}])
    assert result.notes == []
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        result.frame.collect()


def test_add_columns(books):
    columns = {
        "size": "if(length(title) > 5, 'long', if(length(title) = 5, 'middle', 'short'))",
        "net": "price / 1.5",
        "rounded": "round(net)",
        "shelf": "upper(shelf)",
        "broken": "nope + 1",
        "total": "sum(price)",
        "not_text": 5,
        "place": "row_number() OVER (ORDER BY title)",
    }
    result = apply_steps(books, [{"type": "add_columns", "columns": columns}])
    rows = {r.title: r for r in result.frame.collect()}
    assert [rows[t].size for t in ("Tides", "Moss")] == ["middle", "short"]
    assert [rows[t].rounded for t in ("Ember", "Kites", "Moss")] == [8.0, 13.0, 21.0]
    assert sorted(rows, key=lambda t: rows[t].place) == ["Ember", "Kites", "Moss", "Quill", "Tides"]
    assert {r.shelf for r in rows.values()} == {"NORTH", "SOUTH", "ATTIC"}
    assert [n.target for n in result.notes] == ["broken", "total", "not_text"]


def test_null_takes_the_else_branch_of_a_plain_case(spark):
    df = spark.sql("SELECT cast(NULL AS int) AS p")
    case = "CASE WHEN p <= 3 THEN 'few' ELSE 'many' END"
    assert _frame(df, {"type": "add_columns", "columns": {"c": case}}).first().c == "many"


def test_extract_coordinates_keeps_other_columns(spark):
    df = spark.createDataFrame([("mine", "[4.5,45.5]"), ("too", "[4.5]")], "coordinates string, xy string")
    step = {"type": "extract_coordinates", "source_column": "xy", "longitude_column": "lon"}
    rows = _frame(df, step).collect()
    assert [tuple(r) for r in rows] == [("mine", "[4.5,45.5]", 4.5, 45.5), ("too", "[4.5]", 4.5, None)]
    onto_source = {**step, "longitude_column": "xy"}
    assert [r.xy for r in _frame(df, onto_source).collect()] == [4.5, 4.5]


def test_extract_city(spark):
    df = spark.createDataFrame([("1 rue 69000 Lyon",), ("x",), (None,)], "a string")
    step = {"type": "extract_city", "source_column": "a"}
    assert [r.city for r in _frame(df, step).collect()] == ["Lyon", "", None]
    custom = {**step, "target_column": "code", "pattern": r"(\d{5})"}
    assert [r.code for r in _frame(df, custom).collect()] == ["69000", "", None]


@pytest.mark.parametrize("kind", ["extract_coordinates", "extract_city", "bucketize"])
def test_missing_source_is_noted(books, kind):
    step = {"type": kind, "source_column": "nope"}
    assert _frame(books, step).columns == books.columns
    assert _notes(books, step) == [(1, kind, "nope", "column not found")]


def test_first_true_bucketize_parse_dates(spark):
    df = spark.createDataFrame(
        [(True, 10, "2023-01-01"), (None, None, "bad")], "flag boolean, power int, day string"
    )
    result = apply_steps(
        df,
        [
            {"type": "first_true", "target_column": "kind", "labels": {"flag": "F", "gone": "G"}, "default": "U"},
            {
                "type": "bucketize",
                "source_column": "power",
                "target_column": "size",
                "bounds": [{"below": 50, "label": "Low"}],
                "top_label": "High",
                "null_label": "Unknown",
            },
            {"type": "parse_dates", "columns": ["day", "gone"]},
        ],
    )
    rows = [(r.kind, r.size, r.day) for r in result.frame.collect()]
    assert rows == [("F", "Low", date(2023, 1, 1)), ("U", "Unknown", None)]
    assert [(n.step_no, n.target) for n in result.notes] == [(1, "gone"), (3, "gone")]


def test_bucketize_text(spark):
    df = spark.createDataFrame([("49.5",), ("100",), ("many",), ("",), (None,)], "power string")
    step = {
        "type": "bucketize",
        "source_column": "power",
        "target_column": "size",
        "bounds": [{"below": 50, "label": "Low"}],
        "top_label": "High",
        "null_label": "Unknown",
    }
    assert [r.size for r in _frame(df, step).collect()] == ["Low", "High", "Unknown", "Unknown", "Unknown"]


def test_parse_dates_keeps_dates_and_the_day_of_timestamps(spark):
    df = spark.sql("SELECT date'2020-02-29' AS d, timestamp'2021-03-04 23:59:59' AS ts, '2022-05-06' AS t, '07/08/2022' AS u")
    for date_format, text in (("yyyy-MM-dd", date(2022, 5, 6)), ("dd/MM/yyyy", None)):
        row = _frame(df, {"type": "parse_dates", "columns": ["d", "ts", "t"], "format": date_format}).first()
        assert (row.d, row.ts, row.t) == (date(2020, 2, 29), date(2021, 3, 4), text)
    assert _frame(df, {"type": "parse_dates", "columns": ["u"], "format": "dd/MM/yyyy"}).first().u == date(2022, 8, 7)


def test_select_columns(books):
    assert _frame(books, {"type": "select_columns", "columns": ["printed", "title"]}).columns == ["printed", "title"]
    with pytest.raises(StepError, match="nope"):
        _frame(books, {"type": "select_columns", "columns": ["nope"]})


def test_steps_build_on_each_other(books):
    result = _frame(
        books,
        {"type": "filter_rows", "condition": "shelf <> 'attic'"},
        {"type": "parse_dates", "columns": ["printed"]},
        {"type": "add_columns", "columns": {"age": "2030 - year(printed)"}},
        {"type": "rename_columns", "mapping": {"age": "years"}},
        {"type": "drop_columns", "columns": ["price", "printed"]},
    )
    assert result.columns == ["code", "title", "shelf", "years"]
    assert {r.title: r.years for r in result.collect()} == {"Tides": None, "Moss": 32, "Kites": 26, "Ember": 19}


def test_unknown_step_is_noted(books):
    assert _notes(books, {"type": "sort"}) == [(1, "sort", None, "unknown step type")]
    assert _frame(books, {"type": "sort"}).columns == books.columns


@pytest.mark.parametrize(
    "step",
    [
        {"type": "sort"},
        {"type": "filter_rows", "condition": "absent = 1"},
        {"type": "rename_columns", "mapping": {"x": "y"}},
        {"type": "cast_columns", "casts": {"price": "long"}},
    ],
)
def test_raise_instead_of_skip(books, step):
    with pytest.raises(StepError, match="step 1"):
        apply_steps(books, [step], on_error="raise")


def test_on_error_is_checked(books):
    with pytest.raises(ValueError, match="on_error"):
        apply_steps(books, [], on_error="ignore")


def test_a_chain_of_steps_is_one_projection_over_a_pruned_scan(spark, tmp_path):
    path = str(tmp_path / "data")
    spark.range(50).selectExpr("id", "cast(id AS string) AS t", "id * 2 AS wide", "'x' AS unused").write.parquet(
        path
    )
    result = _frame(
        spark.read.parquet(path),
        {"type": "rename_columns", "mapping": {"id": "key"}},
        {"type": "cast_columns", "casts": {"t": "integer"}},
        {"type": "filter_rows", "condition": "key > 10"},
        {"type": "add_columns", "columns": {"a": "t + 1", "b": "a + 1"}},
        {"type": "select_columns", "columns": ["key", "b"]},
    )
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Project") == 1
    assert "GreaterThan(id,10)" in plan
    assert "unused" not in plan
    assert "Exchange" not in plan

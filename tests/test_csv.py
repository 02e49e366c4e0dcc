from __future__ import annotations

import re
from datetime import date

import pytest

from qualitypipe import read_csv, split_bad_rows
from qualitypipe.sources.csv import CsvSource


def _write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture
def sample(tmp_path):
    return _write(tmp_path / "sample.csv", "day,reading,station\n2020-02-29,-3.5,Säntis\n2020-03-01,0.25,\n2020-03-02,12,Napf\n")


def test_inferred(spark, sample):
    df = read_csv(spark, {"input_path": sample})
    assert df.dtypes == [("day", "date"), ("reading", "double"), ("station", "string")]
    assert [tuple(r) for r in df.orderBy("day").collect()] == [
        (date(2020, 2, 29), -3.5, "Säntis"),
        (date(2020, 3, 1), 0.25, None),
        (date(2020, 3, 2), 12.0, "Napf"),
    ]


def test_named_keys(spark, tmp_path):
    path = _write(tmp_path / "x.csv", "1;2\n3;4\n")
    df = read_csv(
        spark, {"input_path": path, "header": False, "delimiter": ";", "infer_schema": "false", "mode": "FAILFAST"}
    )
    assert df.dtypes == [("_c0", "string"), ("_c1", "string")]
    assert df.count() == 2


def test_options_override_named_keys(spark, tmp_path):
    path = _write(tmp_path / "x.csv", "a|b\n1|NULL\n2|01/02/2023\n")
    config = {
        "input_path": path,
        "delimiter": ",",
        "options": {"delimiter": "|", "nullValue": "NULL", "dateFormat": "dd/MM/yyyy"},
    }
    assert [tuple(r) for r in read_csv(spark, config).collect()] == [(1, None), (2, date(2023, 2, 1))]


@pytest.mark.parametrize("config", [{}, {"input_path": None}, {"input_path": ""}])
def test_missing_path(spark, config):
    with pytest.raises(ValueError, match="Input path must be specified"):
        read_csv(spark, config)


def test_schema_is_positional(spark, tmp_path):
    path = _write(tmp_path / "x.csv", "other,names\n1,N/A\n2,x\n")
    config = {"input_path": path, "schema": "a int, b string", "options": {"nullValue": "N/A"}}
    assert [tuple(r) for r in read_csv(spark, config).collect()] == [(1, None), (2, "x")]


def test_empty_cells(spark, tmp_path):
    path = _write(tmp_path / "x.csv", 'a,b\n1,\n2,""\n')
    config = {"input_path": path, "schema": "a int, b string"}
    assert [r.b for r in read_csv(spark, config).collect()] == [None, None]
    config["options"] = {"nullValue": "N/A"}
    assert [r.b for r in read_csv(spark, config).collect()] == [None, ""]


ROWS = "a,b,c\n1,x,1\nbad,y,2\n3\n4,z,4,extra\n5,w,bad\n"


def test_permissive_keeps_every_row(spark, tmp_path):
    config = {"input_path": _write(tmp_path / "x.csv", ROWS), "schema": "a int, b string, c int"}
    assert [tuple(r) for r in read_csv(spark, config).collect()] == [
        (1, "x", 1), (None, "y", 2), (3, None, None), (4, "z", 4), (5, "w", None),
    ]


def test_other_modes(spark, tmp_path):
    config = {"input_path": _write(tmp_path / "x.csv", ROWS), "schema": "a int, b string, c int"}
    assert len(read_csv(spark, {**config, "mode": "DROPMALFORMED"}).collect()) == 1
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_csv(spark, {**config, "mode": "FAILFAST"}).collect()


def test_corrupt_records_are_seen_by_any_query(spark, tmp_path):
    config = {
        "input_path": _write(tmp_path / "x.csv", ROWS),
        "schema": "a int, b string, c int",
        "corrupt_record_column": "bad_row",
    }
    df = read_csv(spark, config)
    expected = [None, "bad,y,2", "3", "4,z,4,extra", "5,w,bad"]
    assert [r.bad_row for r in df.collect()] == expected
    assert [r.bad_row for r in df.select("b", "bad_row").collect()] == expected
    assert df.filter("bad_row IS NOT NULL").select("bad_row").count() == 4
    assert df.columns == ["a", "b", "c", "bad_row"]


def test_corrupt_records_under_inference(spark, tmp_path):
    """The inferred schema is fixed first, so rows of another width are bad, and with a sample also other cells."""
    config = {"input_path": _write(tmp_path / "x.csv", ROWS), "corrupt_record_column": "bad_row"}
    df = read_csv(spark, config)
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string"), ("bad_row", "string")]
    assert [r.bad_row for r in df.collect()] == [None, None, "3", "4,z,4,extra", None]
    good, bad = split_bad_rows(df, "bad_row")
    assert good.columns == ["a", "b", "c"]
    assert (good.count(), sorted(r.value for r in bad.collect())) == (3, ["3", "4,z,4,extra"])


def test_corrupt_records_without_inference(spark, tmp_path):
    config = {"input_path": _write(tmp_path / "x.csv", "1,2\n3\n"), "header": "false", "infer_schema": "false", "corrupt_record_column": "bad"}
    assert [tuple(r) for r in read_csv(spark, config).collect()] == [("1", "2", None), ("3", None, "3")]


def test_kept_apart_rows_need_the_permissive_mode(sample):
    with pytest.raises(ValueError, match="PERMISSIVE"):
        CsvSource(sample, mode="DROPMALFORMED", bad_rows_path="x")


@pytest.fixture
def headers(tmp_path):
    folder = tmp_path / "in [1] {a} %20 b"
    folder.mkdir()
    _write(folder / "one.csv", "a,b\n1,x\n2,y\n")
    _write(folder / "two.csv", "b,a\nz,3\n")
    _write(folder / "three.csv", "\na,b\n4,\n")
    _write(folder / "four.csv", "c,a\n0.5,5\n")
    _write(folder / "empty.csv", "")
    return re.sub(r"([{}\[\]])", r"\\\1", str(folder))


def test_headers_of_another_order(spark, headers):
    config = {"input_path": headers, "schema": "a int, b string", "match_headers": True}
    assert sorted(map(tuple, read_csv(spark, config).collect()), key=str) == [(1, "x"), (2, "y"), (3, "z"), (4, None), (5, None)]
    swapped = read_csv(spark, {**config, "match_headers": False}).collect()
    assert (None, "3") in [tuple(r) for r in swapped]  # by position, as Spark reads them


def test_headers_under_inference(spark, headers):
    df = read_csv(spark, {"input_path": headers, "match_headers": True})
    assert sorted(df.dtypes) == [("a", "int"), ("b", "string"), ("c", "double")]
    found = sorted(tuple(r) for r in df.select("a", "b", "c").fillna({"b": "-", "c": 0.0}).collect())
    assert found == [(1, "x", 0.0), (2, "y", 0.0), (3, "z", 0.0), (4, "-", 0.0), (5, "-", 0.5)]


def test_headers_with_types_inferred_apart(spark, tmp_path):
    _write(tmp_path / "1.csv", "n,t,d,l\n1,5,2020-01-01,1\n")
    _write(tmp_path / "2.csv", "t,n,l,d\nx,1.5,5000000000,2020-01-01 10:00:00\n")
    df = read_csv(spark, {"input_path": str(tmp_path), "match_headers": True})
    assert dict(df.dtypes) == {"n": "double", "t": "string", "d": "timestamp", "l": "bigint"}
    assert sorted((r.n, r.t, r.l) for r in df.collect()) == [(1.0, "5", 1), (1.5, "x", 5_000_000_000)]


def test_headers_with_bad_rows_comments_and_delimiter(spark, tmp_path):
    _write(tmp_path / "1.csv", "#note\na;b\n1;x\nno;y\n")
    _write(tmp_path / "2.csv", "b;a\nz;3;4\n")
    config = {
        "input_path": str(tmp_path), "schema": "a int, b string", "match_headers": True, "delimiter": ";",
        "options": {"comment": "#"}, "corrupt_record_column": "bad",
    }
    df = read_csv(spark, config)
    assert df.columns == ["a", "b", "bad"]
    assert sorted(map(tuple, df.collect()), key=str) == [(1, "x", None), (3, "z", "z;3;4"), (None, "y", "no;y")]


def test_headers_of_no_file_and_without_headers(spark, tmp_path):
    _write(tmp_path / "empty.csv", "")
    assert read_csv(spark, {"input_path": str(tmp_path), "schema": "a int", "match_headers": True}).collect() == []
    with pytest.raises(ValueError, match="headers"):
        CsvSource("x", header="false", match_headers=True)


def test_directories_globs_and_lists(spark, tmp_path):
    for part in ("one", "two"):
        (tmp_path / part).mkdir()
        _write(tmp_path / part / "data.csv", f"id,name\n1,{part}\n2,{part}\n")
    assert read_csv(spark, {"input_path": str(tmp_path / "one")}).count() == 2
    assert read_csv(spark, {"input_path": f"{tmp_path}/*"}).count() == 4
    paths = [str(tmp_path / "one"), str(tmp_path / "two" / "data.csv")]
    assert sorted(r.name for r in read_csv(spark, {"input_path": paths}).collect()) == ["one", "one", "two", "two"]


def test_only_needed_columns_are_parsed(spark, sample):
    df = read_csv(spark, {"input_path": sample}).select("reading")
    assert "ReadSchema: struct<reading:double>" in df._jdf.queryExecution().executedPlan().toString()

from __future__ import annotations

import pytest

from qualitypipe import count_by, group_counts, preview, top_n, write_files
from qualitypipe.operators.analytics import counted_values, group_counts_of, top_n_of
from qualitypipe.sinks import files


@pytest.fixture(scope="module")
def towns(spark):
    rows = [("Paris", 1)] * 3 + [("Lyon", 2)] * 2 + [("", 1)] * 2 + [(None, None)] * 2 + [("Nice", 3)]
    return spark.createDataFrame(rows, "city string, size int")


@pytest.mark.parametrize("file_format", ["parquet", "orc", "json"])
def test_write_replaces_and_counts(spark, towns, tmp_path, file_format):
    path = str(tmp_path / "out")
    assert write_files(towns, path, file_format) == 10
    assert write_files(towns.filter("size = 1"), path, file_format) == 5
    back = spark.read.format(file_format).schema(towns.schema).load(path)
    assert sorted(r.city for r in back.collect()) == ["", "", "Paris", "Paris", "Paris"]


def test_write_csv(spark, towns, tmp_path):
    path = str(tmp_path / "deep" / "out")
    assert write_files(towns, path, "csv", {"header": "true", "nullValue": "N/A"}) == 10
    back = spark.read.csv(path, header=True, nullValue="N/A", schema=towns.schema)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, towns.collect()), key=str)


def test_parquet_is_the_default(spark, towns, tmp_path):
    write_files(towns, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_written_rows_of_nothing(spark, towns, tmp_path):
    assert write_files(towns.filter("size > 5"), str(tmp_path / "out")) == 0
    assert write_files(towns.limit(0), str(tmp_path / "out2")) == 0
    assert spark.read.schema(towns.schema).parquet(str(tmp_path / "out2")).count() == 0


def test_written_rows_after_a_shuffle(spark, towns, tmp_path):
    assert write_files(towns.groupBy("city").count(), str(tmp_path / "out")) == 5


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
def test_a_failing_write_leaves_the_old_rows(spark, towns, tmp_path, file_format):
    path = str(tmp_path / "out")
    write_files(towns, path, file_format)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write_files(towns.selectExpr("cast(city AS int) AS city", "size"), path, file_format)
    assert spark.read.format(file_format).schema(towns.schema).load(path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_failing_first_write_leaves_nothing(towns, tmp_path):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        write_files(towns.selectExpr("cast(city AS int) AS city"), str(tmp_path / "deep" / "out"))
    assert list((tmp_path / "deep").iterdir()) == []


def test_a_failing_swap_puts_the_old_rows_back(spark, towns, tmp_path, monkeypatch):
    path = str(tmp_path / "out")
    write_files(towns, path)
    renames = []

    def rename_to(folder, other):
        renames.append(str(other))
        if len(renames) == 2:
            raise files.WriteError("no")
        assert folder.system.rename(folder.path, other.path)

    monkeypatch.setattr(files._Folder, "rename_to", rename_to)
    with pytest.raises(files.WriteError):
        write_files(towns.limit(1), path)
    assert len(renames) == 3
    assert spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["out"]


def test_a_file_in_the_place_of_the_target_and_a_trailing_slash(spark, towns, tmp_path):
    (tmp_path / "out").write_text("old")
    assert write_files(towns, f"{tmp_path}/out/") == 10
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10


def test_own_rows_can_be_rewritten(spark, towns, tmp_path):
    path = str(tmp_path / "out")
    write_files(towns, path)
    assert write_files(spark.read.parquet(path).filter("size = 1"), path) == 5
    assert spark.read.parquet(path).count() == 5


def test_answers_from_one_table_of_counts(towns):
    counted = counted_values(towns, ["city", "size"])
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert same(group_counts_of(counted, ["city", "size"], ["size"]), group_counts(towns, ["size"]))
    assert same(group_counts_of(counted, ["city", "size"]), group_counts(towns, ["city", "size"]))
    for column in ("city", "size"):
        assert top_n_of(counted, ["city", "size"], column, 3).collect() == top_n(towns, column, 3).collect()
        assert top_n_of(counted, ["city", "size"], column).schema == top_n(towns, column).schema


def test_preview(towns):
    assert preview(towns).count() == 5
    assert preview(towns, 2).count() == 2


def test_count_by(towns):
    assert {r.city: r["count"] for r in count_by(towns, "city").collect()} == {
        "Paris": 3, "Lyon": 2, "": 2, None: 2, "Nice": 1,
    }


def test_top_n_orders_ties_by_value(towns):
    assert [tuple(r) for r in top_n(towns, "city", 4).collect()] == [
        ("Paris", 3), ("", 2), ("Lyon", 2), (None, 2),
    ]
    assert top_n(towns, "city").count() == 5


def test_top_n_needs_no_full_sort(towns):
    plan = top_n(towns, "city", 3)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert "rangepartitioning" not in plan


def test_group_counts_equal_separate_counts(towns):
    found = {(r.column_name, r.value): r["count"] for r in group_counts(towns, ["city", "size"]).collect()}
    assert found == {
        ("city", "Paris"): 3, ("city", "Lyon"): 2, ("city", ""): 2, ("city", None): 2, ("city", "Nice"): 1,
        ("size", "1"): 5, ("size", "2"): 2, ("size", "3"): 1, ("size", None): 2,
    }


def test_group_counts_of_one_column(towns):
    assert group_counts(towns, ["size", "size"]).count() == 4


def test_group_counts_take_one_scan(spark, towns, tmp_path):
    path = str(tmp_path / "towns")
    towns.selectExpr("*", "'x' AS unused").write.parquet(path)
    plan = group_counts(spark.read.parquet(path), ["city", "size"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "unused" not in plan


def test_columns_named_with_dots(spark):
    df = spark.createDataFrame([("x",), ("x",)], ["a.b"])
    assert [tuple(r) for r in top_n(df, "a.b").collect()] == [("x", 2)]
    assert [tuple(r) for r in group_counts(df, ["a.b"]).collect()] == [("a.b", "x", 2)]

from __future__ import annotations

from datetime import date

import pytest

from qualitypipe import (
    ValidationError,
    read_stations,
    run_ingest,
    stations_config,
    stations_profile,
    transform_stations,
)
from qualitypipe import fixed_values as fixed

HARVEST = """plot,crop,kilos,picked,count
A1,rye,812,2022-08-01,4
A2,-,95,2022-08-03,2
B7,oats,1430,03.08.2022,4
B7,oats,-20,2022-08-09,1
C3,rye,640,2022-08-11,4
"""


@pytest.fixture
def config(tmp_path):
    source = tmp_path / "harvest.csv"
    source.write_text(HARVEST, encoding="utf-8")
    return {
        "spark": {"master": "ignored"},
        "ingestion": {
            "input_path": str(source),
            "schema": "plot string, crop string, kilos int, picked string, count int",
            "options": {"nullValue": "-"},
        },
        "quality_checks": {
            "rules": [
                {"name": "crop_known", "type": "not_null", "columns": ["crop", "plot"], "threshold": 0.9},
                {"name": "plots", "type": "unique", "columns": ["plot", "count"]},
                {"type": "regex_match", "column": "picked", "pattern": "^2022-08"},
                {"type": "regex_match", "column": "picked", "pattern": "1$"},
                {"name": "weighed", "type": "value_range", "column": "kilos", "max": 2000},
            ]
        },
        "transformation": {
            "transformations": [
                {"type": "parse_dates", "columns": ["picked"]},
                {"type": "add_columns", "columns": {"tonnes": "kilos / 1000", "big": "if(kilos >= 800, 'yes', 'no')"}},
                {"type": "filter_rows", "condition": "kilos BETWEEN 0 AND 1400"},
                {"type": "rename_columns", "mapping": {"plot": "field"}},
            ]
        },
        "output": {"path": str(tmp_path / "out"), "format": "parquet"},
        "strict_validation": False,
    }


def test_generic_run(spark, config):
    result = run_ingest(spark, config)
    assert (result.rows_read, result.rows_written) == (5, 3)
    assert result.validation.as_dict() == {
        "passed": False,
        "total_rules": 5,
        "passed_rules": 1,
        "failures": [
            {"rule": "crop_known", "details": "Column 'crop' has 1 null values (20.00%), exceeding threshold"},
            {"rule": "plots", "details": "Column 'plot' has 1 duplicate values"},
            {"rule": "plots", "details": "Column 'count' has 2 duplicate values"},
            {"rule": "regex_match", "details": "Column 'picked' has 1 values not matching pattern '^2022-08'"},
            {"rule": "regex_match", "details": "Column 'picked' has 3 values not matching pattern '1$'"},
        ],
    }
    rows = spark.read.parquet(config["output"]["path"]).orderBy("field").collect()
    assert [(r.field, r.crop, r.picked, r.tonnes, r.big) for r in rows] == [
        ("A1", "rye", date(2022, 8, 1), 0.812, "yes"),
        ("A2", None, date(2022, 8, 3), 0.095, "no"),
        ("C3", "rye", date(2022, 8, 11), 0.64, "no"),
    ]
    assert result.output.count() == 3
    assert result.notes == []
    assert result.analytics == {}


def test_examples_of_every_failed_rule(spark, config):
    """Also of unnamed rules on one column, and of a column that is called like the counts."""
    examples = run_ingest(spark, config).examples
    assert list(examples) == [(2, "plot"), (2, "count"), (3, "picked"), (4, "picked")]
    assert [tuple(r) for r in examples[2, "plot"].collect()] == [("B7", 2)]
    assert [tuple(r) for r in examples[2, "count"].collect()] == [(4, 3)]
    assert [r.picked for r in examples[3, "picked"].collect()] == ["03.08.2022"]
    assert [r.picked for r in examples[4, "picked"].collect()] == ["03.08.2022", "2022-08-03", "2022-08-09"]


def _jobs(spark, work):
    """Jobs that run until the work ends, by an error if it is one."""
    spark.sparkContext.setJobGroup("counted", "one run")
    try:
        work()
    finally:
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return jobs


@pytest.mark.parametrize(
    "broken",
    [
        {"transformation": {"transformations": [{"type": "select_columns", "columns": ["gone"]}]}},
        {"transformation": {"transformations": [{"type": "rename_columns", "mapping": {"plot": "CROP"}}]}},
        {"quality_checks": {"rules": [{"type": "regex_match", "column": "plot"}]}},
        {"analytics": {"groupby_columns": "crop"}},
    ],
)
def test_what_does_not_fit_fails_before_any_job(spark, config, tmp_path, broken):
    def work():
        with pytest.raises(ValueError):
            run_ingest(spark, {**config, **broken})

    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    assert set(_jobs(spark, work)) == before
    assert not (tmp_path / "out").exists()


@pytest.mark.parametrize("inside", ["", "/"])
def test_the_input_is_not_overwritten(spark, config, tmp_path, inside):
    source = config["ingestion"]["input_path"]
    config["output"]["path"] = str(tmp_path) + inside if inside else source
    with pytest.raises(ValueError, match="input files"):
        run_ingest(spark, config)
    assert open(source, encoding="utf-8").read() == HARVEST


def test_limits_of_a_scan_come_from_the_configuration(spark, config):
    config["quality_checks"]["checks_per_scan"] = 2
    config["quality_checks"]["keys_per_scan"] = 1
    result = run_ingest(spark, config)
    assert result.validation.scans == 3
    assert len(result.validation.failures) == 5


def test_strict_run_stops_before_the_write(spark, config, tmp_path):
    with pytest.raises(ValidationError, match="strict mode") as raised:
        run_ingest(spark, {**config, "strict_validation": True})
    assert len(raised.value.validation.failures) == 5
    assert not (tmp_path / "out").exists()


def test_strict_run_goes_on_when_all_rules_pass(spark, config):
    rules = config["quality_checks"]["rules"][4:]
    passing = {**config, "quality_checks": {"rules": rules}, "strict_validation": True}
    assert run_ingest(spark, passing).rows_written == 3


def test_only_a_source_is_needed(spark, config, tmp_path):
    result = run_ingest(spark, {"ingestion": config["ingestion"], "output": {"path": str(tmp_path / "o")}})
    assert (result.rows_read, result.rows_written) == (5, 5)
    assert result.validation.passed
    assert spark.read.parquet(str(tmp_path / "o")).count() == 5


def test_missing_path(spark):
    with pytest.raises(ValueError, match="Input path must be specified"):
        run_ingest(spark, {})


def test_notes_and_on_error(spark, config):
    config["transformation"] = {"transformations": [{"type": "filter_rows", "condition": "absent = 1"}]}
    result = run_ingest(spark, config)
    assert result.rows_written == 5
    assert [(n.step_no, n.step) for n in result.notes] == [(1, "filter_rows")]
    with pytest.raises(ValueError, match="step 1"):
        run_ingest(spark, config, on_error="raise")


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
def test_analytics_are_the_same_for_every_format(spark, config, file_format):
    config["transformation"]["transformations"][1]["columns"]["tag"] = "if(kilos < 100, '', crop)"
    config["output"]["format"] = file_format
    config["analytics"] = {"groupby_columns": ["tag", "big"], "top_n": {"column": "tag", "n": 1}}
    result = run_ingest(spark, config)
    counts = {(r.column_name, r.value): r["count"] for r in result.analytics["group_counts"].collect()}
    assert counts == {("tag", ""): 1, ("tag", "rye"): 2, ("big", "yes"): 1, ("big", "no"): 2}
    assert [tuple(r) for r in result.analytics["top_n"].collect()] == [("rye", 2)]
    for answer in result.analytics.values():
        assert "harvest.csv" not in "".join(answer.inputFiles())
        assert "harvest.csv" not in answer._jdf.queryExecution().executedPlan().toString()
    noted = [n.target for n in result.notes if n.step == "analytics"]
    assert noted == ([] if file_format in ("parquet", "orc") else [file_format])
    assert spark.read.format(file_format).schema(result.output.schema).load(config["output"]["path"]).count() == 3


def test_bad_rows_are_kept_apart(spark, config, tmp_path):
    source = tmp_path / "harvest.csv"
    source.write_text(HARVEST + "D4,rye,7\nD5,rye,8,2022-08-20,1,more\n", encoding="utf-8")
    del config["ingestion"]["schema"]
    config["ingestion"]["bad_rows_path"] = str(tmp_path / "bad")
    config["quality_checks"] = {}
    result = run_ingest(spark, config)
    assert (result.rows_read, result.rows_bad, result.rows_written) == (5, 2, 3)
    assert result.raw.columns == ["plot", "crop", "kilos", "picked", "count"]
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "bad")).collect()) == ["D4,rye,7", "D5,rye,8,2022-08-20,1,more"]
    # and a second run after they were mended
    source.write_text(HARVEST, encoding="utf-8")
    assert run_ingest(spark, config).rows_bad == 0
    assert spark.read.text(str(tmp_path / "bad")).count() == 0


@pytest.mark.parametrize("bad", ["out", "out/bad", "."])
def test_bad_rows_do_not_overwrite_input_or_output(spark, config, tmp_path, bad):
    config["ingestion"]["bad_rows_path"] = str(tmp_path) if bad == "." else str(tmp_path / bad)
    with pytest.raises(ValueError, match="input files|each other"):
        run_ingest(spark, config)


def test_answers_for_csv_take_one_more_pass(spark, config):
    """Report, write, and one pass for all answers; asking for them again reads the table of counts."""
    config["output"]["format"] = "csv"
    config["analytics"] = {"groupby_columns": ["big", "crop", "kilos"], "top_n": {"column": "picked", "n": 2}}
    result = run_ingest(spark, config)
    assert [tuple(r) for r in result.analytics["top_n"].collect()] == [(date(2022, 8, 1), 1), (date(2022, 8, 3), 1)]
    found = {(r.column_name, r.value, r["count"]) for r in result.analytics["group_counts"].collect()}
    assert ("kilos", "812", 1) in found and ("crop", None, 1) in found and not any(c == "picked" for c, _, _ in found)
    again = run_ingest(spark, config)
    assert again.analytics["top_n"].count() == 2


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv", "json"])
def test_a_failing_rerun_leaves_the_old_rows(spark, config, tmp_path, file_format):
    config["output"]["format"] = file_format
    config["quality_checks"] = {}
    assert run_ingest(spark, config).rows_written == 3
    steps = config["transformation"]["transformations"]
    config["transformation"]["transformations"] = [*steps, {"type": "add_columns", "columns": {"bad": "cast(crop AS int)"}}]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_ingest(spark, config)
    left = spark.read.format(file_format).load(config["output"]["path"])
    assert left.count() == 3
    assert "bad" not in left.columns
    assert sorted(p.name for p in tmp_path.iterdir()) == ["harvest.csv", "out"]


def test_analytics_on_columns_that_do_not_exist_are_noted(spark, config):
    config["analytics"] = {"groupby_columns": ["big", "gone"], "top_n": {"column": "lost", "n": 3}}
    result = run_ingest(spark, config)
    assert result.analytics["group_counts"].count() == 2
    assert "top_n" not in result.analytics
    assert [(n.step, n.target) for n in result.notes] == [("analytics", "gone"), ("analytics", "lost")]


# --- Charging stations -----------------------------------------------------------------------------

COLUMNS = [part.split()[0] for part in fixed.STATIONS_SCHEMA.split(",")]


def _station(**cells):
    defaults = {c: "false" if c.startswith(("prise_", "paiement_")) else "x" for c in COLUMNS}
    defaults |= {"gratuit": "false", "reservation": "false", "station_deux_roues": "false", "nbre_pdc": "2"}
    defaults |= {"date_mise_en_service": "2019-04-02", "date_maj": "2020-10-20"}
    return ",".join({**defaults, **cells}[c] for c in COLUMNS)


@pytest.fixture
def stations_csv(tmp_path):
    rows = [
        _station(
            id_pdc_itinerance="X100",
            nom_station="Quai",
            prise_type_combo_ccs="true",
            prise_type_2="true",
            puissance_nominale="150",
            adresse_station="9 quai Nord 29200 Brest",
            coordonneesXY='"[-4.5,48.4]"',
        ),
        _station(
            id_pdc_itinerance="X200",
            nom_station="N/A",
            prise_type_2="true",
            puissance_nominale="49",
            adresse_station="4 allee Est 31000 Toulouse",
            coordonneesXY='"[1.44,43.6]"',
            date_mise_en_service="bientot",
        ),
        _station(
            id_pdc_itinerance="X200",
            nom_station="Gare",
            prise_type_chademo="true",
            prise_type_ef="true",
            puissance_nominale="149",
            adresse_station="7 place Sud 80000 Amiens",
            coordonneesXY="N/A",
        ),
    ]
    path = tmp_path / "stations.csv"
    path.write_text("\n".join([",".join(COLUMNS), *rows]) + "\n", encoding="utf-8")
    return str(path)


def test_stations_schema_has_34_columns():
    assert len(COLUMNS) == len(set(COLUMNS)) == 34
    assert len(fixed.STATIONS_OUTPUT) == 16


def test_stations_run(spark, stations_csv, tmp_path):
    result = run_ingest(spark, stations_config(stations_csv, str(tmp_path / "out")))
    assert result.output.columns == fixed.STATIONS_OUTPUT
    assert dict(result.output.dtypes)["processed_timestamp"] == "timestamp"
    rows = {r.nom_station: r for r in result.output.collect()}
    taken = ["city", "longitude", "latitude", "power_category", "charging_type", "date_mise_en_service", "date_maj"]
    update = date(2020, 10, 20)
    assert {name: tuple(r[c] for c in taken) for name, r in rows.items()} == {
        "Quai": ("Brest", -4.5, 48.4, "High", "CCS", date(2019, 4, 2), update),
        None: ("Toulouse", 1.44, 43.6, "Low", "Type 2", None, update),
        "Gare": ("Amiens", None, None, "Medium", "CHAdeMO", date(2019, 4, 2), update),
    }
    assert all(r.processed_timestamp is not None for r in rows.values())
    assert [f["rule"] for f in result.validation.failures] == [
        "identified_and_located", "one_line_per_point", "service_date_iso",
    ]
    assert [tuple(r) for r in result.analytics["top_n"].collect()] == [("Amiens", 1), ("Brest", 1), ("Toulouse", 1)]
    assert [r[0] for r in result.examples[3, "date_mise_en_service"].collect()] == ["bientot"]


def test_stations_functions(spark, stations_csv):
    raw = read_stations(spark, stations_csv)
    clean = transform_stations(raw)
    assert raw.columns == COLUMNS
    assert clean.columns == fixed.STATIONS_OUTPUT
    assert sorted(r.power_category for r in clean.collect()) == ["High", "Low", "Medium"]
    assert stations_profile(raw).first().asDict() == {
        "null_id_pdc_itinerance": 0,
        "null_nom_station": 1,
        "null_adresse_station": 0,
        "null_puissance_nominale": 0,
        "invalid_dates": 1,
        "duplicate_ids": 1,
    }


def test_unquoted_coordinates_shift_the_row(spark, stations_csv, tmp_path):
    """Longitude and latitude then fill two cells, and everything after them moves by one."""
    text = open(stations_csv, encoding="utf-8").read().replace('"', "")
    shifted = tmp_path / "shifted.csv"
    shifted.write_text(text, encoding="utf-8")
    result = run_ingest(spark, stations_config(str(shifted), str(tmp_path / "out")))
    first = result.raw.filter("nom_station = 'Quai'").first()
    assert (first.coordonneesXY, first.nbre_pdc, first.date_maj) == ("[-4.5", None, "2019-04-02")
    assert result.rows_written == 3


def test_a_run_takes_few_jobs(spark, stations_csv, tmp_path):
    """Report, write and the count of the written rows in the footers, plus what adaptive execution splits off at shuffles."""
    config = stations_config(stations_csv, str(tmp_path / "out"))
    before = set(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    jobs = set(_jobs(spark, lambda: run_ingest(spark, config))) - before
    assert 2 <= len(jobs) <= 6

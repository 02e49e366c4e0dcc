"""Totals of the derived stations at sf0.01, worked out ahead of the engine."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from queries import QUERIES
from queries.stations_data import full_stations, stations

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="needs the given tables")


def _counts(spark, query, column):
    return {r[0]: r[1] for r in QUERIES[query](spark, SF_DIR).groupBy(column).count().collect()}


def test_full_stations_have_the_input_schema(spark):
    from qualitypipe import fixed_values as fixed

    declared = [tuple(part.split()) for part in fixed.STATIONS_SCHEMA.split(",")]
    assert full_stations(spark, SF_DIR).dtypes == declared
    assert stations(spark, SF_DIR).count() == 1500


def test_charging_types(spark):
    assert _counts(spark, "derive_first_true", "charging_type") == {
        "CCS": 428, "Type 2": 497, "EF": 110, "Other": 80, "CHAdeMO": 24, "Unknown": 361,
    }


def test_power_categories(spark):
    assert _counts(spark, "derive_bucket", "power_category") == {
        "High": 1077, "Medium": 256, "Low": 129, "Unknown": 38,
    }


def test_cities(spark):
    assert _counts(spark, "derive_city", "city") == {
        "MACHINERY": 265, "FURNITURE": 252, "AUTOMOBILE": 249, "BUILDING": 247, "HOUSEHOLD": 247,
        "": 210, None: 30,
    }


def test_unparsable_values(spark):
    row = (
        QUERIES["derive_coordinates"](spark, SF_DIR)
        .agg(F.count_if(F.col("longitude").isNull()), F.count_if(F.col("latitude").isNull()))
        .first()
    )
    assert tuple(row) == (217, 316)
    dates = QUERIES["derive_parse_date"](spark, SF_DIR)
    assert dates.filter("date_mise_en_service IS NULL").count() == 99


def test_profile(spark):
    assert QUERIES["stations_profile"](spark, SF_DIR).first().asDict() == {
        "null_id_pdc_itinerance": 0,
        "null_nom_station": 0,
        "null_adresse_station": 30,
        "null_puissance_nominale": 38,
        "duplicate_ids": 15,
        "invalid_dates": 50,
    }


def test_report(spark):
    lines = {(r.rule, r.column_name): r for r in QUERIES["dq_report"](spark, SF_DIR).collect()}
    found = {column: (line.status, line.failed) for (rule, column), line in lines.items() if rule == "identified_and_located"}
    assert found == {
        "id_pdc_itinerance": ("pass", 0),
        "nom_station": ("pass", 0),
        "adresse_station": ("pass", 30),
        "puissance_nominale": ("pass", 38),
    }
    assert lines["one_line_per_point", "id_pdc_itinerance"].failed == 15
    assert lines["service_date_iso", "date_mise_en_service"].failed == 50
    assert lines["plausible_power", "puissance_nominale"].failed == 126


def test_top_customers(spark):
    top = [tuple(r) for r in QUERIES["analytics_top_n"](spark, SF_DIR).take(3)]
    assert top == [(605, 25), (1242, 21), (1378, 21)]

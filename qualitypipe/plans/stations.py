"""The charging-stations data set as plain configuration for ``run_ingest``."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from qualitypipe import fixed_values as fixed
from qualitypipe.operators import quality as dq
from qualitypipe.operators.steps import apply_steps
from qualitypipe.sources.csv import read_csv

INGESTION: dict[str, Any] = {
    "schema": fixed.STATIONS_SCHEMA,
    "options": {"nullValue": fixed.STATIONS_NULL_TOKEN},
}

RULES: list[dict[str, Any]] = [
    {
        "name": "identified_and_located",
        "type": "not_null",
        "columns": fixed.REQUIRED_STATION_COLUMNS,
        "threshold": fixed.REQUIRED_SHARE,
    },
    {"name": "one_line_per_point", "type": "unique", "columns": ["id_pdc_itinerance"]},
    {
        "name": "service_date_iso",
        "type": "regex_match",
        "column": "date_mise_en_service",
        "pattern": fixed.ISO_DATE_PATTERN,
    },
    {
        "name": "plausible_power",
        "type": "value_range",
        "column": "puissance_nominale",
        "min": fixed.POWER_RANGE[0],
        "max": fixed.POWER_RANGE[1],
    },
]

DERIVATIONS: list[dict[str, Any]] = [
    {"type": "extract_coordinates", "source_column": "coordonneesXY"},
    {"type": "parse_dates", "columns": ["date_mise_en_service", "date_maj"]},
    {
        "type": "first_true",
        "target_column": "charging_type",
        "labels": fixed.CHARGING_TYPES,
        "default": fixed.UNKNOWN_LABEL,
    },
    {
        "type": "bucketize",
        "source_column": "puissance_nominale",
        "target_column": "power_category",
        "bounds": fixed.POWER_BOUNDS,
        "top_label": fixed.POWER_TOP_LABEL,
        "null_label": fixed.UNKNOWN_LABEL,
    },
    {"type": "add_columns", "columns": {"processed_timestamp": "current_timestamp()"}},
    {"type": "extract_city", "source_column": "adresse_station"},
]

STEPS = [*DERIVATIONS, {"type": "select_columns", "columns": fixed.STATIONS_OUTPUT}]

ANALYTICS: dict[str, Any] = {
    "groupby_columns": fixed.STATION_GROUPINGS,
    "top_n": {"column": "city", "n": fixed.TOP_N},
}


def stations_config(input_path: str | list[str], output_path: str) -> dict[str, Any]:
    """Read, check, derive, write and count charging stations."""
    return {
        "ingestion": {**INGESTION, "input_path": input_path},
        "quality_checks": {"rules": RULES},
        "transformation": {"transformations": STEPS},
        "output": {"path": output_path, "format": fixed.OUTPUT_FORMAT},
        "analytics": ANALYTICS,
    }


def read_stations(spark: SparkSession, input_path: str | list[str]) -> DataFrame:
    return read_csv(spark, {**INGESTION, "input_path": input_path})


def transform_stations(df: DataFrame) -> DataFrame:
    """The derived columns in output order."""
    return apply_steps(df, STEPS, on_error="raise").frame


def stations_profile(df: DataFrame) -> DataFrame:
    """NULL counts of the required columns, duplicate ids and badly formed dates, as one row."""
    return dq.profile(
        df,
        required=fixed.REQUIRED_STATION_COLUMNS,
        id_column="id_pdc_itinerance",
        date_column="date_mise_en_service",
    )

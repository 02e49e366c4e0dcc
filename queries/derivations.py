"""Text extraction, classification, the derived stations and counts on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qualitypipe import count_by, group_counts, top_n, transform_stations
from qualitypipe import fixed_values as fixed
from qualitypipe.operators.steps import apply_steps
from qualitypipe.plans import stations as stations_plan
from qualitypipe.plans.stations import DERIVATIONS
from queries.registry import query, table
from queries.stations_data import CLEAN_STATIONS_SQL, STATIONS_SQL, full_stations, stations


def _derived(spark: SparkSession, sf_dir: str, step: dict, *columns: str) -> DataFrame:
    return apply_steps(stations(spark, sf_dir), [step]).frame.select("nom_station", *columns)


def _step(kind: str) -> dict:
    return next(step for step in DERIVATIONS if step["type"] == kind)


def clean_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derivations and the final projection, without the time of processing."""
    return transform_stations(full_stations(spark, sf_dir)).drop("processed_timestamp")


@query(
    f"""
    SELECT nom_station,
      TRY_CAST(string_split(regexp_extract(coordonneesXY, '\\[(.*?)\\]', 1), ',')[1] AS DOUBLE)
        AS longitude,
      TRY_CAST(string_split(regexp_extract(coordonneesXY, '\\[(.*?)\\]', 1), ',')[2] AS DOUBLE)
        AS latitude
    FROM ({STATIONS_SQL}) AS stations"""
)
def derive_coordinates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _step("extract_coordinates"), "longitude", "latitude")


@query(
    f"""
    SELECT nom_station, regexp_extract(adresse_station, '\\d{{5}}\\s+([\\w-]+)', 1) AS city
    FROM ({STATIONS_SQL}) AS stations"""
)
def derive_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _step("extract_city"), "city")


@query(
    f"""
    SELECT nom_station,
      CAST(try_strptime(date_mise_en_service, '%Y-%m-%d') AS DATE) AS date_mise_en_service
    FROM ({STATIONS_SQL}) AS stations"""
)
def derive_parse_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = {"type": "parse_dates", "columns": ["date_mise_en_service"]}
    return _derived(spark, sf_dir, step, "date_mise_en_service")


@query(
    f"""
    SELECT nom_station,
      CASE WHEN prise_type_combo_ccs THEN 'CCS' WHEN prise_type_chademo THEN 'CHAdeMO'
           WHEN prise_type_2 THEN 'Type 2' WHEN prise_type_ef THEN 'EF'
           WHEN prise_type_autre THEN 'Other' ELSE 'Unknown' END AS charging_type
    FROM ({STATIONS_SQL}) AS stations"""
)
def derive_first_true(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _step("first_true"), "charging_type")


@query(
    f"""
    SELECT nom_station,
      CASE WHEN puissance_nominale < 50 THEN 'Low' WHEN puissance_nominale < 150 THEN 'Medium'
           WHEN puissance_nominale >= 150 THEN 'High' ELSE 'Unknown' END AS power_category
    FROM ({STATIONS_SQL}) AS stations"""
)
def derive_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _derived(spark, sf_dir, _step("bucketize"), "power_category")


@query(
    f"""
    SELECT nom_station,
      CASE WHEN puissance_nominale < 50 THEN 'Low' WHEN puissance_nominale < 150 THEN 'Medium'
           ELSE 'High' END AS power_category
    FROM ({STATIONS_SQL}) AS stations"""
)
def derive_bucket_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets as a SQL expression: its ELSE takes a NULL power for a high one."""
    case = (
        "CASE WHEN puissance_nominale < 50 THEN 'Low' WHEN puissance_nominale < 150 THEN 'Medium' "
        "ELSE 'High' END"
    )
    return _derived(spark, sf_dir, {"type": "add_columns", "columns": {"power_category": case}}, "power_category")


@query(CLEAN_STATIONS_SQL)
def stations_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_stations(spark, sf_dir)


@query(
    f"""
    SELECT
      count(*) FILTER (WHERE id_pdc_itinerance IS NULL) AS null_id_pdc_itinerance,
      count(*) FILTER (WHERE nom_station IS NULL) AS null_nom_station,
      count(*) FILTER (WHERE adresse_station IS NULL) AS null_adresse_station,
      count(*) FILTER (WHERE puissance_nominale IS NULL) AS null_puissance_nominale,
      count(*) FILTER (WHERE NOT regexp_matches(date_mise_en_service, '^\\d{{4}}-\\d{{2}}-\\d{{2}}$'))
        AS invalid_dates,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT id_pdc_itinerance FROM ({STATIONS_SQL}) AS s))
        AS duplicate_ids
    FROM ({STATIONS_SQL}) AS stations"""
)
def stations_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stations_plan.stations_profile(stations(spark, sf_dir))


@query(f'SELECT power_category, count(*) AS "count" FROM ({CLEAN_STATIONS_SQL}) AS clean GROUP BY 1')
def stations_by_power(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(clean_stations(spark, sf_dir), "power_category")


@query(f'SELECT charging_type, count(*) AS "count" FROM ({CLEAN_STATIONS_SQL}) AS clean GROUP BY 1')
def stations_by_charging_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(clean_stations(spark, sf_dir), "charging_type")


@query(
    f"""
    SELECT city, count(*) AS "count" FROM ({CLEAN_STATIONS_SQL}) AS clean GROUP BY 1
    ORDER BY 2 DESC, 1 ASC NULLS LAST LIMIT 10"""
)
def stations_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(clean_stations(spark, sf_dir), "city", fixed.TOP_N)


@query(
    "\n UNION ALL ".join(
        f'SELECT \'{column}\' AS column_name, {column} AS "value", count(*) AS "count" '
        f"FROM ({CLEAN_STATIONS_SQL}) AS clean GROUP BY {column}"
        for column in ("power_category", "charging_type", "city")
    )
)
def analytics_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return group_counts(clean_stations(spark, sf_dir), fixed.STATION_GROUPINGS)


@query(
    """
    SELECT o_custkey, count(*) AS "count" FROM orders GROUP BY 1
    ORDER BY 2 DESC, 1 ASC NULLS LAST LIMIT 10"""
)
def analytics_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_n(table(spark, sf_dir, "orders"), "o_custkey", 10)


@query(
    "\n UNION ALL ".join(
        f'SELECT \'{column}\' AS column_name, CAST({column} AS VARCHAR) AS "value", count(*) AS "count" '
        f"FROM lineitem GROUP BY {column}"
        for column in ("l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey")
    )
)
def analytics_group_counts_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["l_returnflag", "l_linestatus", "l_linenumber", "l_suppkey"]
    return group_counts(table(spark, sf_dir, "lineitem"), columns)


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
def derive_parse_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timestamps and dates are no text: the day is kept, whatever the format."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "cast(o_orderdate AS timestamp) AS o_orderdate")
    steps = [{"type": "parse_dates", "columns": ["o_orderdate"], "format": f} for f in ("dd/MM/yyyy", "yyyy-MM-dd")]
    return apply_steps(orders, steps).frame

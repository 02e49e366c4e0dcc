"""Charging stations derived from ``customer``: same rows, one station each, with gaps and bad values.

The two texts run unchanged on both engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from queries.registry import table

_STATIONS = """
SELECT
  concat('FR', lpad(cast(CASE WHEN c_custkey % 97 = 0 AND c_custkey > 0 THEN c_custkey - 1
                              ELSE c_custkey END AS string), 8, '0')) AS id_pdc_itinerance,
  c_name AS nom_station,
  CASE WHEN c_custkey % 50 = 0 THEN NULL
       WHEN c_custkey % 7 = 0 THEN 'Lieu-dit sans code'
       ELSE concat('Rue ', cast(c_custkey AS string), ' ',
                   lpad(cast(c_custkey % 100 AS string), 2, '0'), '000 ', c_mktsegment)
  END AS adresse_station,
  CASE WHEN c_custkey % 17 = 0 THEN NULL
       WHEN c_custkey % 11 = 0 THEN 'n/a'
       WHEN c_custkey % 13 = 0 THEN '[5.25]'
       ELSE concat('[', cast(c_custkey % 180 AS string), '.5,', cast(c_custkey % 90 AS string), '.25]')
  END AS coordonneesXY,
  cast(CASE WHEN c_custkey % 40 = 0 THEN NULL ELSE (c_custkey % 23) * 25 END AS int)
    AS puissance_nominale,
  cast(c_custkey % 8 + 1 AS int) AS nbre_pdc,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_custkey % 2 = 0 END AS prise_type_2,
  c_custkey % 9 = 0 AS prise_type_chademo,
  CASE WHEN c_custkey % 21 = 0 THEN NULL ELSE c_custkey % 3 = 0 END AS prise_type_combo_ccs,
  c_custkey % 5 = 0 AS prise_type_ef,
  c_custkey % 7 = 0 AS prise_type_autre,
  CASE WHEN c_custkey % 31 = 0 THEN NULL
       WHEN c_custkey % 29 = 0 THEN 'invalid-date'
       ELSE concat('2023-', lpad(cast(c_custkey % 12 + 1 AS string), 2, '0'), '-',
                   lpad(cast(c_custkey % 28 + 1 AS string), 2, '0'))
  END AS date_mise_en_service
FROM {customer}
"""

# All input columns of the data set in file order, with the derived ones in their places.
_FULL_STATIONS = """
SELECT
  id_pdc_itinerance, cast(NULL AS string) AS observations, prise_type_2, prise_type_autre,
  prise_type_chademo, prise_type_combo_ccs, prise_type_ef, puissance_nominale,
  'Amenageur' AS nom_amenageur, '123456789' AS siren_amenageur, 'a@example.org' AS contact_amenageur,
  'Operateur' AS nom_operateur, 'o@example.org' AS contact_operateur, 'Enseigne' AS nom_enseigne,
  concat('S', id_pdc_itinerance) AS id_station_itinerance, nom_station,
  'Voirie' AS implantation_station, adresse_station, coordonneesXY, nbre_pdc,
  nbre_pdc > 4 AS gratuit, true AS paiement_acte, true AS paiement_cb, false AS paiement_autre,
  'Acces libre' AS condition_acces, false AS reservation,
  CASE WHEN nbre_pdc = 1 THEN NULL ELSE 'Mo-Su 08:00-20:00' END AS horaires,
  CASE WHEN nbre_pdc < 3 THEN 'Non accessible' ELSE 'Accessible, mais non reserve' END
    AS accessibilite_pmr,
  'Hauteur 2m' AS restriction_gabarit, false AS station_deux_roues, 'Direct' AS raccordement,
  cast(NULL AS string) AS num_pdl, date_mise_en_service,
  concat('2024-0', cast(nbre_pdc AS string), '-15') AS date_maj
FROM {stations}
"""

STATIONS_SQL = _STATIONS.format(customer="customer")
FULL_STATIONS_SQL = _FULL_STATIONS.format(stations=f"({STATIONS_SQL}) AS stations")

# Every derivation of the data set in SQL, for oracles that build on the derived rows.
CLEAN_STATIONS_SQL = f"""
SELECT
  id_pdc_itinerance, nom_station, adresse_station,
  regexp_extract(adresse_station, '\\d{{5}}\\s+([\\w-]+)', 1) AS city,
  TRY_CAST(string_split(regexp_extract(coordonneesXY, '\\[(.*?)\\]', 1), ',')[2] AS DOUBLE) AS latitude,
  TRY_CAST(string_split(regexp_extract(coordonneesXY, '\\[(.*?)\\]', 1), ',')[1] AS DOUBLE) AS longitude,
  puissance_nominale,
  CASE WHEN puissance_nominale < 50 THEN 'Low' WHEN puissance_nominale < 150 THEN 'Medium'
       WHEN puissance_nominale >= 150 THEN 'High' ELSE 'Unknown' END AS power_category,
  CASE WHEN prise_type_combo_ccs THEN 'CCS' WHEN prise_type_chademo THEN 'CHAdeMO'
       WHEN prise_type_2 THEN 'Type 2' WHEN prise_type_ef THEN 'EF'
       WHEN prise_type_autre THEN 'Other' ELSE 'Unknown' END AS charging_type,
  nbre_pdc, gratuit, horaires, accessibilite_pmr,
  CAST(try_strptime(date_mise_en_service, '%Y-%m-%d') AS DATE) AS date_mise_en_service,
  CAST(try_strptime(date_maj, '%Y-%m-%d') AS DATE) AS date_maj
FROM ({FULL_STATIONS_SQL}) AS full_stations
"""


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns that rules and derivations look at."""
    return spark.sql(_STATIONS, customer=table(spark, sf_dir, "customer"))


def full_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 34 input columns."""
    return spark.sql(_FULL_STATIONS, stations=stations(spark, sf_dir))

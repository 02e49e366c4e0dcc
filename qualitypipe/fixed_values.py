"""Values that results depend on and that therefore may not change.

Everything here is fixed: defaults of the configuration surface, text patterns, report wording, and
the names, order and types of the charging-stations data set.
"""

# --- Fixed values: configuration defaults ---------------------------------------------------------
CSV_DEFAULTS = {"header": "true", "inferSchema": "true", "delimiter": ",", "mode": "PERMISSIVE"}
OUTPUT_PATH = "data/output"
OUTPUT_FORMAT = "parquet"
PREVIEW_ROWS = 5
EXAMPLE_ROWS = 5
TOP_N = 10
COUNT_COLUMN = "count"

# --- Fixed values: patterns and formats -----------------------------------------------------------
COORDINATES_PATTERN = r"\[(.*?)\]"
CITY_PATTERN = r"\d{5}\s+([\w-]+)"
ISO_DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DATE_FORMAT = "yyyy-MM-dd"

# --- Fixed values: report wording -----------------------------------------------------------------
MISSING_COLUMN = "Column '{column}' not found in DataFrame"
NULL_VALUES = "Column '{column}' has {failed} null values ({share}), exceeding threshold"
DUPLICATE_VALUES = "Column '{column}' has {failed} duplicate values"
OUTSIDE_RANGE = "Column '{column}' has {failed} values outside range [{low}, {high}]"
NOT_MATCHING = "Column '{column}' has {failed} values not matching pattern '{pattern}'"
UNKNOWN_RULE = "Unknown validation rule type: {kind}"
STRICT_FAILURE = "Data quality validation failed in strict mode"
MISSING_PATH = "Input path must be specified in configuration"

# --- Fixed values: charging stations, input columns in file order ---------------------------------
STATIONS_SCHEMA = """
    id_pdc_itinerance string, observations string, prise_type_2 boolean, prise_type_autre boolean,
    prise_type_chademo boolean, prise_type_combo_ccs boolean, prise_type_ef boolean,
    puissance_nominale int, nom_amenageur string, siren_amenageur string, contact_amenageur string,
    nom_operateur string, contact_operateur string, nom_enseigne string,
    id_station_itinerance string, nom_station string, implantation_station string,
    adresse_station string, coordonneesXY string, nbre_pdc int, gratuit boolean,
    paiement_acte boolean, paiement_cb boolean, paiement_autre boolean, condition_acces string,
    reservation boolean, horaires string, accessibilite_pmr string, restriction_gabarit string,
    station_deux_roues boolean, raccordement string, num_pdl string, date_mise_en_service string,
    date_maj string
"""
STATIONS_NULL_TOKEN = "N/A"

# --- Fixed values: charging stations, output columns in order -------------------------------------
STATIONS_OUTPUT = [
    "id_pdc_itinerance",
    "nom_station",
    "adresse_station",
    "city",
    "latitude",
    "longitude",
    "puissance_nominale",
    "power_category",
    "charging_type",
    "nbre_pdc",
    "gratuit",
    "horaires",
    "accessibilite_pmr",
    "date_mise_en_service",
    "date_maj",
    "processed_timestamp",
]

# --- Fixed values: charging stations, labels, bounds and checked columns --------------------------
CHARGING_TYPES = {  # first true flag wins
    "prise_type_combo_ccs": "CCS",
    "prise_type_chademo": "CHAdeMO",
    "prise_type_2": "Type 2",
    "prise_type_ef": "EF",
    "prise_type_autre": "Other",
}
POWER_BOUNDS = [{"below": 50, "label": "Low"}, {"below": 150, "label": "Medium"}]
POWER_TOP_LABEL = "High"
UNKNOWN_LABEL = "Unknown"
REQUIRED_STATION_COLUMNS = ["id_pdc_itinerance", "nom_station", "adresse_station", "puissance_nominale"]
REQUIRED_SHARE = 0.95
POWER_RANGE = (0, 500)
STATION_GROUPINGS = ["power_category", "charging_type", "city"]

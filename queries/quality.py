"""Quality rules and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qualitypipe import Wanted, build_report, duplicate_examples, example_lines, not_matching_examples, summarize
from qualitypipe import fixed_values as fixed
from qualitypipe.plans.stations import RULES
from queries.registry import query, table
from queries.stations_data import STATIONS_SQL, stations

_STATIONS = f"({STATIONS_SQL}) AS stations"
_ISO_DATE = "^\\d{4}-\\d{2}-\\d{2}$"


# --- SQL of one report line ------------------------------------------------------------------------


def _line(no, rule, kind, column, source, failed, details, allowed="0.0"):
    return f"""
    SELECT CAST({no} AS INTEGER) AS rule_no, '{rule}' AS rule, '{kind}' AS rule_type,
      '{column}' AS column_name, CASE WHEN fails THEN 'fail' ELSE 'pass' END AS status,
      failed, total, ratio, CASE WHEN fails THEN {details} END AS details
    FROM (SELECT *, failed > 0 AND ratio > {allowed} AS fails
          FROM (SELECT *, CASE WHEN total > 0 THEN CAST(failed AS DOUBLE) / total ELSE 0 END AS ratio
                FROM (SELECT CAST({failed} AS BIGINT) AS failed, count(*) AS total FROM {source})))"""


def _not_null(no, column, source, name="not_null", threshold="1.0"):
    share = "printf('%.2f%%', ratio * 100)"
    details = (
        f"concat('Column ''{column}'' has ', failed, ' null values (', {share}, '), exceeding threshold')"
    )
    failed = f"count(*) - count({column})"
    allowed = f"CAST(1.0 AS DOUBLE) - CAST({threshold} AS DOUBLE)"
    return _line(no, name, "not_null", column, source, failed, details, allowed)


def _unique(no, column, source, name="unique"):
    details = f"concat('Column ''{column}'' has ', failed, ' duplicate values')"
    distinct = f"count(DISTINCT {column}) + CASE WHEN count(*) > count({column}) THEN 1 ELSE 0 END"
    return _line(no, name, "unique", column, source, f"count(*) - ({distinct})", details)


def _range(no, column, source, low, high, name="value_range"):
    details = f"concat('Column ''{column}'' has ', failed, ' values outside range [{low}, {high}]')"
    outside = " OR ".join(
        [f"{column} < {low}"] * (low is not None) + [f"{column} > {high}"] * (high is not None)
    )
    return _line(
        no, name, "value_range", column, source, f"count(*) FILTER (WHERE {outside})", details
    )


def _regex(no, column, source, pattern, name="regex_match"):
    details = f"concat('Column ''{column}'' has ', failed, ' values not matching pattern ''{pattern}''')"
    failed = f"count(*) FILTER (WHERE NOT regexp_matches(CAST({column} AS VARCHAR), '{pattern}'))"
    return _line(no, name, "regex_match", column, source, failed, details)


def _missing(no, rule, kind, column):
    return f"""
    SELECT CAST({no} AS INTEGER) AS rule_no, '{rule}' AS rule, '{kind}' AS rule_type,
      '{column}' AS column_name, 'fail' AS status, CAST(NULL AS BIGINT) AS failed,
      CAST(NULL AS BIGINT) AS total, CAST(NULL AS DOUBLE) AS ratio,
      'Column ''{column}'' not found in DataFrame' AS details"""


def _report(*lines):
    return "\n UNION ALL ".join(lines)


# --- Single rules ----------------------------------------------------------------------------------


@query(
    _report(
        *(_not_null(1, c, _STATIONS) for c in ("id_pdc_itinerance", "adresse_station", "puissance_nominale"))
    )
)
def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["id_pdc_itinerance", "adresse_station", "puissance_nominale"]
    return build_report(stations(spark, sf_dir), [{"type": "not_null", "columns": columns}])


@query(
    _report(
        _not_null(1, "adresse_station", _STATIONS, threshold="0.95"),
        _not_null(1, "coordonneesXY", _STATIONS, threshold="0.95"),
        _not_null(2, "adresse_station", _STATIONS, name="strict", threshold="0.99"),
    )
)
def dq_not_null_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"type": "not_null", "columns": ["adresse_station", "coordonneesXY"], "threshold": 0.95},
        {"name": "strict", "type": "not_null", "columns": ["adresse_station"], "threshold": 0.99},
    ]
    return build_report(stations(spark, sf_dir), rules)


@query(
    _report(
        _unique(1, "id_pdc_itinerance", _STATIONS),
        _unique(1, "nom_station", _STATIONS),
        _unique(2, "date_mise_en_service", _STATIONS, name="dates"),
    )
)
def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"type": "unique", "columns": ["id_pdc_itinerance", "nom_station"]},
        {"name": "dates", "type": "unique", "columns": ["date_mise_en_service"]},
    ]
    return build_report(stations(spark, sf_dir), rules)


@query(_report(_unique(1, "o_orderkey", "orders"), _unique(1, "o_custkey", "orders")))
def dq_unique_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"type": "unique", "columns": ["o_orderkey", "o_custkey"]}]
    return build_report(table(spark, sf_dir, "orders"), rules)


@query(
    """
    SELECT p_name, count(*) AS "count" FROM part GROUP BY 1 HAVING count(*) > 1
    ORDER BY 2 DESC, sha256(p_name) ASC NULLS LAST LIMIT 5"""
)
def dq_duplicate_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_examples(table(spark, sf_dir, "part"), "p_name")


@query(_report(_range(1, "puissance_nominale", _STATIONS, 0, 500)))
def dq_value_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"type": "value_range", "column": "puissance_nominale", "min": 0, "max": 500}]
    return build_report(stations(spark, sf_dir), rules)


@query(_report(_range(1, "c_acctbal", "customer", 0, None)))
def dq_value_range_min_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"type": "value_range", "column": "c_acctbal", "min": 0}]
    return build_report(table(spark, sf_dir, "customer"), rules)


@query(_report(_range(1, "puissance_nominale", _STATIONS, None, 500)))
def dq_value_range_max_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"type": "value_range", "column": "puissance_nominale", "max": 500}]
    return build_report(stations(spark, sf_dir), rules)


@query(
    _report(
        _regex(1, "date_mise_en_service", _STATIONS, _ISO_DATE),
        _regex(2, "nom_station", _STATIONS, "0", name="anywhere"),
        _regex(3, "nbre_pdc", _STATIONS, "^[1-4]$", name="number"),
    )
)
def dq_regex_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"type": "regex_match", "column": "date_mise_en_service", "pattern": fixed.ISO_DATE_PATTERN},
        {"name": "anywhere", "type": "regex_match", "column": "nom_station", "pattern": "0"},
        {"name": "number", "type": "regex_match", "column": "nbre_pdc", "pattern": "^[1-4]$"},
    ]
    return build_report(stations(spark, sf_dir), rules)


@query(
    f"""
    SELECT date_mise_en_service FROM {_STATIONS}
    WHERE NOT regexp_matches(date_mise_en_service, '{_ISO_DATE}') ORDER BY 1 LIMIT 5"""
)
def dq_regex_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return not_matching_examples(
        stations(spark, sf_dir), "date_mise_en_service", fixed.ISO_DATE_PATTERN
    )


@query(
    _report(
        _not_null(1, "o_orderkey", "orders", name="keys"),
        _missing(1, "keys", "not_null", "absent"),
        _missing(2, "unique", "unique", "absent"),
        _missing(3, "value_range", "value_range", "absent"),
        _missing(4, "regex_match", "regex_match", "absent"),
    )
)
def dq_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"name": "keys", "type": "not_null", "columns": ["o_orderkey", "absent"]},
        {"type": "unique", "columns": ["absent"]},
        {"type": "value_range", "column": "absent", "min": 0},
        {"type": "regex_match", "column": "absent", "pattern": "x"},
    ]
    return build_report(table(spark, sf_dir, "orders"), rules)


def _unfit(no, rule, kind, column, reason):
    reason = reason.replace("'", "''")
    return f"""
    SELECT CAST({no} AS INTEGER) AS rule_no, '{rule}' AS rule, '{kind}' AS rule_type,
      '{column}' AS column_name, 'fail' AS status, CAST(NULL AS BIGINT) AS failed,
      CAST(NULL AS BIGINT) AS total, CAST(NULL AS DOUBLE) AS ratio,
      'Rule does not fit column ''{column}'': {reason}' AS details"""


@query(
    _report(
        _unfit(1, "broken", "regex_match", "o_orderpriority", "'^[1-3' is no regular expression"),
        _unfit(2, "value_range", "value_range", "o_custkey", "bounds [x, None] are no values of type bigint"),
        _unfit(3, "value_range", "value_range", "o_orderdate", "bounds [None, soon] are no values of type timestamp_ntz"),
        _unfit(4, "most", "not_null", "o_orderkey", "threshold 'all' is no number"),
        _regex(5, "o_orderpriority", "orders", "^[1-3]-"),
        _range(6, "o_totalprice", "orders", "10000", "200000"),
        _not_null(7, "o_orderkey", "orders", threshold="0.9"),
        _unique(8, "o_custkey", "orders"),
    )
)
def dq_unfit_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules that can't be evaluated are a failed line each; all others are measured."""
    rules = [
        {"name": "broken", "type": "regex_match", "column": "o_orderpriority", "pattern": "^[1-3"},
        {"type": "value_range", "column": "o_custkey", "min": "x"},
        {"type": "value_range", "column": "o_orderdate", "max": "soon"},
        {"name": "most", "type": "not_null", "columns": ["o_orderkey"], "threshold": "all"},
        {"type": "regex_match", "column": "o_orderpriority", "pattern": "^[1-3]-"},
        {"type": "value_range", "column": "o_totalprice", "min": "10000", "max": "200000"},
        {"type": "not_null", "columns": ["o_orderkey"], "threshold": "0.9"},
        {"type": "unique", "columns": ["o_custkey"]},
    ]
    return build_report(table(spark, sf_dir, "orders"), rules)


_NESTED_SQL = """(
    SELECT {'type': event_type, 'odd': CASE WHEN user_id % 2 = 1 THEN [value, -value] END} AS pair,
      [event_type, props] AS texts, {'k': event_type, 'v': user_id % 10} AS entry FROM events) AS nested"""


@query(_report(*(_unique(1, c, _NESTED_SQL, name="copies") for c in ("pair", "texts", "entry"))))
def dq_unique_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structs with a list, lists and maps, which travel as digests."""
    nested = table(spark, sf_dir, "events").selectExpr(
        "struct(event_type AS type, if(user_id % 2 = 1, array(value, -value), NULL) AS odd) AS pair",
        "array(event_type, props) AS texts",
        "map(event_type, user_id % 10) AS entry",
    )
    return build_report(nested, [{"name": "copies", "type": "unique", "columns": ["pair", "texts", "entry"]}])


_BOUNDS = [("l_quantity", 0.5), ("l_discount", 0.001), ("l_tax", 0.001), ("l_extendedprice", 900.0)]
_MANY = [(column, round(step * i, 3)) for i in range(30) for column, step in _BOUNDS]


@query(
    _report(
        *(_range(no, column, "lineitem", None, bound) for no, (column, bound) in enumerate(_MANY, start=1)),
        _unique(len(_MANY) + 1, "l_orderkey", "lineitem"),
    )
)
def dq_many_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """120 row checks and a unique column, in one scan."""
    rules = [{"type": "value_range", "column": column, "max": bound} for column, bound in _MANY]
    return build_report(table(spark, sf_dir, "lineitem"), [*rules, {"type": "unique", "columns": ["l_orderkey"]}])


@query(
    """
    SELECT * FROM (
      SELECT CAST(1 AS INTEGER) AS rule_no, 'user_id' AS column_name, CAST(row_number() OVER (ORDER BY n DESC, user_id) AS INTEGER) AS place,
        CAST(user_id AS VARCHAR) AS value, n AS number
      FROM (SELECT user_id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1) AS users ORDER BY place LIMIT 3) AS repeated
    UNION ALL SELECT * FROM (
      SELECT CAST(1 AS INTEGER), 'props', CAST(row_number() OVER (ORDER BY n DESC, sha256(props)) AS INTEGER) AS place, props, n
      FROM (SELECT props, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 1) AS texts ORDER BY place LIMIT 3) AS copied
    UNION ALL SELECT * FROM (
      SELECT CAST(2 AS INTEGER), 'event_type', CAST(row_number() OVER (ORDER BY event_type) AS INTEGER) AS place, event_type, NULL
      FROM events WHERE NOT regexp_matches(event_type, '^[a-p]') ORDER BY place LIMIT 3) AS unmatched
    UNION ALL SELECT * FROM (
      SELECT CAST(3 AS INTEGER), 'user_id', CAST(row_number() OVER (ORDER BY user_id) AS INTEGER) AS place, CAST(user_id AS VARCHAR), NULL
      FROM events WHERE NOT regexp_matches(CAST(user_id AS VARCHAR), '[02468]$') ORDER BY place LIMIT 3) AS odd"""
)
def dq_example_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Examples of four rules; repeated texts are fetched by a second scan."""
    wanted = [Wanted(1, "user_id"), Wanted(1, "props"), Wanted(2, "event_type", "^[a-p]"), Wanted(3, "user_id", "[02468]$")]
    return example_lines(table(spark, sf_dir, "events"), wanted, 3)


# --- Whole reports ---------------------------------------------------------------------------------

_STATIONS_REPORT = _report(
    *(
        _not_null(1, c, _STATIONS, name="identified_and_located", threshold="0.95")
        for c in ("id_pdc_itinerance", "nom_station", "adresse_station", "puissance_nominale")
    ),
    _unique(2, "id_pdc_itinerance", _STATIONS, name="one_line_per_point"),
    _regex(3, "date_mise_en_service", _STATIONS, _ISO_DATE, name="service_date_iso"),
    _range(4, "puissance_nominale", _STATIONS, 0, 500, name="plausible_power"),
)


@query(_STATIONS_REPORT)
def dq_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_report(stations(spark, sf_dir), RULES)


@query(
    f"""
    SELECT NOT bool_or(failed) AS passed, count(*) AS total_rules,
      count(*) FILTER (WHERE NOT failed) AS passed_rules,
      count(*) FILTER (WHERE failed) AS failed_rules, CAST(0 AS BIGINT) AS skipped_rules
    FROM (SELECT rule_no, bool_or(status = 'fail') AS failed
          FROM ({_STATIONS_REPORT}) AS report GROUP BY 1)"""
)
def dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize(build_report(stations(spark, sf_dir), RULES))


@query(
    _report(
        _not_null(1, "l_shipdate", "lineitem", name="required"),
        _not_null(1, "l_partkey", "lineitem", name="required"),
        _unique(2, "l_orderkey", "lineitem"),
        _unique(2, "l_returnflag", "lineitem"),
        _regex(3, "l_returnflag", "lineitem", "^[AR]$"),
        _range(4, "l_quantity", "lineitem", 5, 45, name="quantity"),
        _range(5, "l_discount", "lineitem", None, 0.05, name="discount"),
    )
)
def dq_report_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"name": "required", "type": "not_null", "columns": ["l_shipdate", "l_partkey"]},
        {"type": "unique", "columns": ["l_orderkey", "l_returnflag"]},
        {"type": "regex_match", "column": "l_returnflag", "pattern": "^[AR]$"},
        {"name": "quantity", "type": "value_range", "column": "l_quantity", "min": 5, "max": 45},
        {"name": "discount", "type": "value_range", "column": "l_discount", "max": 0.05},
    ]
    return build_report(table(spark, sf_dir, "lineitem"), rules)


@query(
    _report(
        _unique(1, "doc_id", "documents", name="copies"),
        _unique(1, "text", "documents", name="copies"),
        _not_null(2, "text", "documents"),
        _regex(3, "lang", "documents", "^(en|fr)$", name="languages"),
        _regex(4, "text", "documents", "[0-9]", name="has_digit"),
        _range(5, "n_chars", "documents", 100, 5000, name="length"),
    )
)
def dq_report_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"name": "copies", "type": "unique", "columns": ["doc_id", "text"]},
        {"type": "not_null", "columns": ["text"]},
        {"name": "languages", "type": "regex_match", "column": "lang", "pattern": "^(en|fr)$"},
        {"name": "has_digit", "type": "regex_match", "column": "text", "pattern": "[0-9]"},
        {"name": "length", "type": "value_range", "column": "n_chars", "min": 100, "max": 5000},
    ]
    return build_report(table(spark, sf_dir, "documents"), rules)


@query(
    _report(
        _unique(1, "event_id", "events"),
        _unique(1, "user_id", "events"),
        _regex(2, "props", "events", '^\\{"k": [0-9]+\\}$'),
        _range(3, "value", "events", 1, None),
        _regex(4, "event_type", "events", "^(click|view|purchase)$", name="types"),
    )
)
def dq_report_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [
        {"type": "unique", "columns": ["event_id", "user_id"]},
        {"type": "regex_match", "column": "props", "pattern": '^\\{"k": [0-9]+\\}$'},
        {"type": "value_range", "column": "value", "min": 1},
        {"name": "types", "type": "regex_match", "column": "event_type", "pattern": "^(click|view|purchase)$"},
    ]
    return build_report(table(spark, sf_dir, "events"), rules)


@query(
    """
    SELECT text, count(*) AS "count" FROM documents GROUP BY 1 HAVING count(*) > 1
    ORDER BY 2 DESC, sha256(text) ASC NULLS LAST LIMIT 5"""
)
def dq_duplicate_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_examples(table(spark, sf_dir, "documents"), "text")


@query(
    """
    SELECT CAST(1 AS INTEGER) AS rule_no, 'ordered' AS rule, 'sorted' AS rule_type, CAST(NULL AS VARCHAR) AS column_name,
      'skipped' AS status, CAST(NULL AS BIGINT) AS failed, CAST(NULL AS BIGINT) AS total, CAST(NULL AS DOUBLE) AS ratio,
      'Unknown validation rule type: sorted' AS details
    UNION ALL """
    + _unique(2, "o_orderkey", "orders")
)
def dq_unknown_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [{"name": "ordered", "type": "sorted", "column": "o_orderkey"}, {"type": "unique", "columns": ["o_orderkey"]}]
    return build_report(table(spark, sf_dir, "orders"), rules)

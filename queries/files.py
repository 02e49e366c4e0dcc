"""CSV sources, file sinks and whole ingest runs.

The inputs are written from the tables first, into the folder that the executors share.
"""

from __future__ import annotations

import re

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitypipe import fixed_values as fixed
from qualitypipe import preview, read_csv, run_ingest, stations_config, write_files
from qualitypipe.plans.stations import DERIVATIONS
from queries.registry import query, scratch, table
from queries.stations_data import CLEAN_STATIONS_SQL, full_stations


def _as_csv(df: DataFrame, path: str, **options: str) -> str:
    write_files(df, path, "csv", {"header": "true", **options})
    return path


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, base = table(spark, sf_dir, "customer"), scratch(spark, "src_csv_inferred")
    _as_csv(customer.filter("c_custkey % 2 = 0"), f"{base}/even")
    _as_csv(customer.filter("c_custkey % 2 <> 0"), f"{base}/odd")
    rows = read_csv(spark, {"input_path": f"{base}/*"})
    # Inference picks the narrowest integer type that holds the values.
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


@query(
    """
    SELECT o_orderkey, nullif(o_orderstatus, 'P') AS o_orderstatus, CAST(o_orderdate AS DATE) AS o_orderdate
    FROM orders"""
)
def src_csv_options(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "nullif(o_orderstatus, 'P') AS o_orderstatus", "cast(o_orderdate AS date) AS o_orderdate"
    )
    written = {"sep": "|", "nullValue": "NULL", "dateFormat": "dd/MM/yyyy"}
    path = _as_csv(orders, scratch(spark, "src_csv_options"), **written)
    config = {
        "input_path": path,
        "delimiter": ",",
        "options": {"delimiter": "|", "nullValue": "NULL", "dateFormat": "dd/MM/yyyy"},
    }
    return read_csv(spark, config).withColumn("o_orderkey", F.col("o_orderkey").cast("bigint"))


@query(
    """
    SELECT s_suppkey, s_name, s_nationkey, CASE WHEN s_acctbal >= 0 THEN s_acctbal END AS s_acctbal
    FROM supplier"""
)
def src_csv_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").withColumn(
        "s_acctbal", F.when(F.col("s_acctbal") >= 0, F.col("s_acctbal"))
    )
    path = _as_csv(supplier, scratch(spark, "src_csv_schema"), nullValue="N/A")
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return read_csv(spark, {"input_path": path, "schema": schema, "options": {"nullValue": "N/A"}})


@query(
    """
    SELECT p_partkey, CASE WHEN p_size <= 40 THEN p_size END AS p_size, p_name, p_size > 40 AS malformed
    FROM part"""
)
def src_csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "CASE WHEN p_size > 40 THEN 'large' ELSE cast(p_size AS string) END AS p_size", "p_name"
    )
    path = _as_csv(part, scratch(spark, "src_csv_malformed"))
    schema = "p_partkey bigint, p_size int, p_name string"
    config = {"input_path": path, "schema": schema, "corrupt_record_column": "bad_row"}
    rows = read_csv(spark, config)
    return rows.select("p_partkey", "p_size", "p_name", F.col("bad_row").isNotNull().alias("malformed"))


_LINES_SQL = """
    SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderkey % 10 = 3 AS malformed FROM orders"""


@query(_LINES_SQL)
def src_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that miss a cell or have one too many, under inference: kept apart by a run, and good and bad together are all."""
    base = scratch(spark, "src_csv_quarantine")
    # a row of another width can't be written as CSV, so it is a line of text
    lines = table(spark, sf_dir, "orders").selectExpr(
        """concat_ws(',', cast(o_orderkey AS string), cast(o_totalprice AS string),
             CASE WHEN o_orderkey % 10 <> 3 THEN o_orderpriority WHEN o_orderkey % 20 = 3 THEN concat(o_orderpriority, ',more') END) AS value"""
    )
    header = spark.range(1).selectExpr("'o_orderkey,o_totalprice,o_orderpriority' AS value")
    write_files(lines, f"{base}/in/rows", "text")
    write_files(header, f"{base}/in/header", "text")
    files = [f"{base}/in/header", f"{base}/in/rows"]
    config = {
        # the header is a file of its own here, so the names come from a schema without types
        "ingestion": {"input_path": files, "header": "false", "bad_rows_path": f"{base}/bad", "options": {"comment": "o"}},
        "transformation": {"transformations": [{"type": "rename_columns", "mapping": {"_c0": "o_orderkey", "_c1": "o_totalprice", "_c2": "o_orderpriority"}}]},
        "output": {"path": f"{base}/out"},
    }
    result = run_ingest(spark, config)
    good = result.output.selectExpr("cast(o_orderkey AS bigint) AS o_orderkey", "o_totalprice", "o_orderpriority", "false AS malformed")
    bad = spark.read.schema("value string").text(f"{base}/bad").selectExpr("split(value, ',') AS cells")
    bad = bad.selectExpr("cast(cells[0] AS bigint) AS o_orderkey", "cast(cells[1] AS double) AS o_totalprice", "get(cells, 2) AS o_orderpriority", "true AS malformed")
    # rows that lost their last cell get it back for the comparison
    priorities = table(spark, sf_dir, "orders").filter("o_orderkey % 10 = 3").select(F.col("o_orderkey").alias("k"), F.col("o_orderpriority").alias("p"))
    bad = bad.join(priorities, F.col("o_orderkey") == F.col("k")).withColumn("o_orderpriority", F.coalesce("o_orderpriority", "p")).drop("k", "p")
    return good.unionByName(bad)


@query("SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 3 <> 2 THEN c_acctbal END AS c_acctbal FROM customer")
def src_csv_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose headers name the same columns in other orders, and one without a column."""
    customer, base = table(spark, sf_dir, "customer"), scratch(spark, "src_csv_headers")
    orders = ["c_custkey c_name c_nationkey c_acctbal", "c_acctbal c_nationkey c_mktsegment c_name c_custkey", "c_name c_custkey c_nationkey"]
    for i, columns in enumerate(orders):
        _as_csv(customer.filter(f"c_custkey % 3 = {i}").select(*columns.split()), f"{base}/{i}")
    schema = "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double"
    return read_csv(spark, {"input_path": f"{base}/*", "schema": schema, "match_headers": True})


def _round_trip(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    path = scratch(spark, f"sink_{file_format}_roundtrip")
    write_files(supplier.filter("s_acctbal < 0"), path, file_format)
    write_files(supplier, path, file_format)
    return spark.read.format(file_format).schema(supplier.schema).load(path)


@query("SELECT * FROM supplier")
def sink_parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "parquet")


@query("SELECT * FROM supplier")
def sink_orc_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "orc")


@query("SELECT * FROM supplier")
def sink_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "csv")


@query("SELECT * FROM supplier")
def sink_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


_DATED_ORDERS = "SELECT o_orderkey, cast(o_orderdate AS date) AS o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders"


def _orders_round_trip(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    """Dates and NULLs through a format."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "cast(o_orderdate AS date) AS o_orderdate", "nullif(o_orderpriority, '5-LOW') AS o_orderpriority"
    )
    path = scratch(spark, f"sink_{file_format}_orders")
    write_files(orders, path, file_format)
    return spark.read.format(file_format).schema(orders.schema).load(path)


@query(_DATED_ORDERS)
def sink_csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_round_trip(spark, sf_dir, "csv")


@query(_DATED_ORDERS)
def sink_json_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_round_trip(spark, sf_dir, "json")


@query(_DATED_ORDERS)
def sink_orc_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders_round_trip(spark, sf_dir, "orc")


#: What CSV needs for text with line breaks, quotes and backslashes. Files read with ``multiLine`` are not split.
_ANY_TEXT = {"escape": '"', "quoteAll": "true", "multiLine": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks and quotes: every row comes back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch(spark, "sink_csv_documents")
    write_files(docs, path, "csv", {**_ANY_TEXT, "header": "true"})
    return read_csv(spark, {"input_path": path, "schema": docs.schema, "options": _ANY_TEXT})


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def sink_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    path = scratch(spark, "sink_json_documents")
    write_files(docs, path, "json")
    return spark.read.schema(docs.schema).json(path)


@query("SELECT p_partkey, p_size, p_name FROM part WHERE p_size <= 40")
def src_csv_dropmalformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows whose size is no number are left out."""
    part = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "CASE WHEN p_size > 40 THEN 'large' ELSE cast(p_size AS string) END AS p_size", "p_name"
    )
    path = _as_csv(part, scratch(spark, "src_csv_dropmalformed"))
    schema = "p_partkey bigint, p_size int, p_name string"
    return read_csv(spark, {"input_path": path, "schema": schema, "mode": "DROPMALFORMED"})


@query("SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return preview(orders.orderBy(F.desc("o_totalprice"), "o_orderkey"))


_ORDER_RULES = [
    {"name": "priority_known", "type": "not_null", "columns": ["o_orderpriority"], "threshold": 0.9},
    {"name": "one_line_each", "type": "unique", "columns": ["o_orderkey", "o_custkey"]},
    {"name": "urgency", "type": "regex_match", "column": "o_orderpriority", "pattern": "^[1-3]-"},
    {"type": "regex_match", "column": "o_orderpriority", "pattern": "[A-Z]$"},
    {"name": "price_band", "type": "value_range", "column": "o_totalprice", "min": 0, "max": 1000000},
]

_ORDER_STEPS = [
    {"type": "rename_columns", "mapping": {"o_orderkey": "order_no", "o_totalprice": "price"}},
    {"type": "cast_columns", "casts": {"price": "integer"}},
    {"type": "add_columns", "columns": {"year": "year(o_orderdate)", "per_month": "price div 12"}},
    {"type": "filter_rows", "condition": "year(o_orderdate) % 2 = 1 OR o_orderpriority IS NULL"},
    {"type": "drop_columns", "columns": ["o_custkey"]},
]

_SINK_SQL = "SELECT s_suppkey, s_name, s_nationkey, s_acctbal, s_acctbal < 0 AS in_debt FROM supplier"


def _failing_rerun(spark: SparkSession, sf_dir: str, file_format: str) -> DataFrame:
    """What is there after a second write that fails: the rows of the first."""
    supplier = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_acctbal < 0 AS in_debt")
    path = scratch(spark, f"sink_{file_format}_rerun")
    write_files(supplier, path, file_format)
    try:
        write_files(supplier.withColumn("s_acctbal", F.expr("cast(s_name AS double)")), path, file_format)
    except PySparkException:
        return spark.read.format(file_format).schema(supplier.schema).load(path)
    raise AssertionError("the second write should have failed")


@query(_SINK_SQL)
def sink_parquet_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing_rerun(spark, sf_dir, "parquet")


@query(_SINK_SQL)
def sink_csv_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failing_rerun(spark, sf_dir, "csv")


_ORDER_SCHEMA = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate date, o_orderpriority string"
_ORDER_COLUMNS = """o_orderkey, o_custkey, o_totalprice, cast(o_orderdate AS date) AS o_orderdate,
    nullif(o_orderpriority, '5-LOW') AS o_orderpriority"""


def _ingest_orders(spark: SparkSession, sf_dir: str, name: str, file_format: str = "parquet", analytics: dict | None = None):
    orders = table(spark, sf_dir, "orders").selectExpr(*_split(_ORDER_COLUMNS))
    base = scratch(spark, name)
    config = {
        "ingestion": {
            "input_path": _as_csv(orders, f"{base}/in", nullValue="-"),
            "schema": _ORDER_SCHEMA,
            "options": {"nullValue": "-"},
        },
        "quality_checks": {"rules": _ORDER_RULES, "checks_per_scan": 20},
        "transformation": {"transformations": _ORDER_STEPS},
        "output": {"path": f"{base}/out", "format": file_format},
        "analytics": analytics or {},
    }
    return run_ingest(spark, config)


def _split(columns: str) -> list[str]:
    """At commas outside of brackets."""
    return re.split(r",\s*(?![^(]*\))", columns)


_ORDERS_OUT = f"""
    SELECT o_orderkey AS order_no, CAST(trunc(o_totalprice) AS INTEGER) AS price, o_orderdate, o_orderpriority,
      CAST(year(o_orderdate) AS INTEGER) AS year, CAST(trunc(o_totalprice) AS BIGINT) // 12 AS per_month
    FROM (SELECT {_ORDER_COLUMNS} FROM orders) AS o
    WHERE year(o_orderdate) % 2 = 1 OR o_orderpriority IS NULL"""


@query(_ORDERS_OUT)
def ingest_generic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_orders(spark, sf_dir, "ingest_generic").output


_ORDER_ANALYTICS = {"groupby_columns": ["o_orderpriority", "year"], "top_n": {"column": "o_orderdate", "n": 5}}


@query(
    f"""
    WITH written AS ({_ORDERS_OUT})
    SELECT 'o_orderpriority' AS column_name, o_orderpriority AS value, count(*) AS "count" FROM written GROUP BY 2
    UNION ALL SELECT 'year', CAST(year AS VARCHAR), count(*) FROM written GROUP BY year"""
)
def ingest_csv_group_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a run that writes CSV, read from one table of counts."""
    return _ingest_orders(spark, sf_dir, "ingest_csv_group_counts", "csv", _ORDER_ANALYTICS).analytics["group_counts"]


@query(f'SELECT o_orderdate, count(*) AS "count" FROM ({_ORDERS_OUT}) AS written GROUP BY 1 ORDER BY 2 DESC, 1 ASC NULLS LAST LIMIT 5')
def ingest_csv_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_orders(spark, sf_dir, "ingest_csv_top_n", "csv", _ORDER_ANALYTICS).analytics["top_n"]


@query(
    f"""
    SELECT (SELECT count(*) FROM orders) AS rows_read, (SELECT count(*) FROM ({_ORDERS_OUT}) AS kept) AS rows_written,
      CAST(2 AS BIGINT) AS passed_rules, CAST(5 AS BIGINT) AS total_rules, CAST(1 AS BIGINT) AS scans"""
)
def metric_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _ingest_orders(spark, sf_dir, "metric_row_counts")
    metrics = {
        "rows_read": result.rows_read,
        "rows_written": result.rows_written,
        "passed_rules": result.validation.passed_rules,
        "total_rules": result.validation.total_rules,
        "scans": result.validation.scans,
    }
    return spark.range(1).select(*(F.lit(n).cast("bigint").alias(name) for name, n in metrics.items()))


@query(
    f"""
    WITH o AS (SELECT {_ORDER_COLUMNS} FROM orders)
    SELECT * FROM (
      SELECT CAST(2 AS INTEGER) AS rule_no, 'o_custkey' AS column_name, CAST(o_custkey AS VARCHAR) AS value, count(*) AS number
      FROM o GROUP BY o_custkey HAVING count(*) > 1 ORDER BY count(*) DESC, o_custkey LIMIT 5) AS repeated
    UNION ALL SELECT * FROM (
      SELECT CAST(3 AS INTEGER), 'o_orderpriority', o_orderpriority, NULL FROM o
      WHERE NOT regexp_matches(o_orderpriority, '^[1-3]-') ORDER BY o_orderpriority LIMIT 5) AS unmatched"""
)
def ingest_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The examples of a run, all from one scan."""
    return _ingest_orders(spark, sf_dir, "ingest_examples").example_lines.drop("place")


def _ingest_stations(spark: SparkSession, sf_dir: str, name: str):
    base = scratch(spark, name)
    source = _as_csv(full_stations(spark, sf_dir), f"{base}/in", nullValue=fixed.STATIONS_NULL_TOKEN)
    return run_ingest(spark, stations_config(source, f"{base}/out"))


@query(CLEAN_STATIONS_SQL)
def ingest_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_stations(spark, sf_dir, "ingest_stations").output.drop("processed_timestamp")


@query(
    f"""
    SELECT city, count(*) AS "count" FROM ({CLEAN_STATIONS_SQL}) AS clean GROUP BY 1
    ORDER BY 2 DESC, 1 ASC NULLS LAST LIMIT 10"""
)
def ingest_stations_top_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ingest_stations(spark, sf_dir, "ingest_stations_top_cities").analytics["top_n"]


# The derivations that generic steps can express, but with casts instead of ``parse_dates`` and plain SQL for the power.
_POWER_SQL = (
    " ".join(["CASE", *(f"WHEN puissance_nominale < {b['below']} THEN '{b['label']}'" for b in fixed.POWER_BOUNDS)])
    + f" ELSE '{fixed.POWER_TOP_LABEL}' END"
)
_GENERIC = ("extract_coordinates", "extract_city")
_CONFIGURED_STEPS = [
    *(step for step in DERIVATIONS if step["type"] in _GENERIC),
    {"type": "cast_columns", "casts": {"puissance_nominale": "integer", "date_maj": "date", "date_mise_en_service": "date"}},
    {"type": "add_columns", "columns": {"power_category": _POWER_SQL}},
]


@query(
    f"""
    SELECT id_pdc_itinerance, longitude, latitude, date_mise_en_service, date_maj, puissance_nominale,
      {_POWER_SQL} AS power_category, city
    FROM ({CLEAN_STATIONS_SQL}) AS clean"""
)
def ingest_stations_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations by inference and generic steps only; a NULL power then counts as high."""
    base = scratch(spark, "ingest_stations_inferred")
    source = _as_csv(full_stations(spark, sf_dir), f"{base}/in", nullValue=fixed.STATIONS_NULL_TOKEN)
    config = stations_config(source, f"{base}/out")
    config["ingestion"] = {
        "input_path": source,
        "options": {"header": "true", "delimiter": ",", "mode": "PERMISSIVE", "nullValue": "N/A"},
    }
    config["transformation"] = {"transformations": _CONFIGURED_STEPS}
    wanted = (
        "id_pdc_itinerance longitude latitude date_mise_en_service date_maj puissance_nominale "
        "power_category city"
    )
    return run_ingest(spark, config).output.select(*wanted.split())

"""Transformation steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitypipe import apply_steps
from queries.registry import query, table


def _orders(spark: SparkSession, sf_dir: str, *steps: dict) -> DataFrame:
    return apply_steps(table(spark, sf_dir, "orders"), steps).frame


def _cast(df: DataFrame, **casts: str) -> DataFrame:
    return apply_steps(df, [{"type": "cast_columns", "casts": casts}]).frame


@query(
    """
    SELECT o_orderkey AS id, o_custkey AS customer_id, o_orderstatus, o_totalprice, o_orderdate,
      o_orderpriority FROM orders"""
)
def step_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"o_orderkey": "order_id", "o_custkey": "customer_id", "order_id": "id", "absent": "x"}
    return _orders(spark, sf_dir, {"type": "rename_columns", "mapping": mapping})


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def step_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderpriority", "o_orderstatus", "absent"]
    return _orders(spark, sf_dir, {"type": "drop_columns", "columns": columns})


@query("SELECT * FROM orders WHERE o_totalprice > 100000 AND nullif(o_orderstatus, 'P') <> 'F'")
def step_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(
        spark,
        sf_dir,
        {"type": "filter_rows", "condition": "o_totalprice > 100000"},
        {"type": "filter_rows", "condition": "nullif(o_orderstatus, 'P') <> 'F'"},
        {"type": "filter_rows", "condition": "absent = 1"},
        {"type": "filter_rows", "condition": ""},
    )


@query(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, upper(o_orderpriority)
      AS o_orderpriority,
      CASE WHEN o_totalprice < 100000 THEN 'low' WHEN o_totalprice < 300000 THEN 'medium'
           ELSE 'high' END AS price_category,
      o_totalprice * 2 AS doubled, true AS processed, o_totalprice * 2 > 500000 AS large
    FROM orders"""
)
def step_add_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "price_category": "CASE WHEN o_totalprice < 100000 THEN 'low' "
        "WHEN o_totalprice < 300000 THEN 'medium' ELSE 'high' END",
        "doubled": "o_totalprice * 2",
        "processed": "true",
        "large": "doubled > 500000",
        "o_orderpriority": "upper(o_orderpriority)",
        "no_such_input": "absent + 1",
        "total": "sum(o_totalprice)",
    }
    return _orders(spark, sf_dir, {"type": "add_columns", "columns": columns})


@query(
    """
    SELECT l_orderkey, CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
      CAST(l_partkey AS INTEGER) AS l_partkey,
      CASE l_returnflag || l_linestatus
        WHEN 'AO' THEN CAST(l_quantity AS INTEGER) WHEN 'AF' THEN CAST(l_quantity AS INTEGER)
        WHEN 'RO' THEN -CAST(l_quantity AS INTEGER) WHEN 'NO' THEN 0 END AS text
    FROM lineitem"""
)
def step_cast_integer(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        CASE concat(l_returnflag, l_linestatus)
          WHEN 'AO' THEN concat(' ', cast(l_quantity AS int), ' ')
          WHEN 'AF' THEN concat('+', cast(l_quantity AS int), '.9')
          WHEN 'RO' THEN concat('-', cast(l_quantity AS int), '.5')
          WHEN 'RF' THEN concat('x', cast(l_quantity AS int))
          WHEN 'NO' THEN '.5'
          ELSE concat(cast(l_quantity AS int), '0000000000') END"""
    df = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_extendedprice", "l_partkey", F.expr(text).alias("text")
    )
    return _cast(df, l_extendedprice="integer", l_partkey="integer", text="integer", absent="integer")


@query(
    """
    SELECT o_orderkey,
      CASE o_orderstatus WHEN 'O' THEN o_custkey + 0.25e0 WHEN 'F' THEN CAST(o_custkey AS DOUBLE) END
        AS text,
      CAST(o_custkey AS DOUBLE) AS o_custkey
    FROM orders"""
)
def step_cast_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        CASE o_orderstatus WHEN 'O' THEN concat(o_custkey, '.25') WHEN 'F' THEN concat(' ', o_custkey, ' ')
                           ELSE '' END"""
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(text).alias("text"), "o_custkey")
    return _cast(df, text="double", o_custkey="double")


@query(
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority,
      CASE WHEN o_totalprice > 100000 THEN 'true' ELSE 'false' END AS large
    FROM orders"""
)
def step_cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    large = (F.col("o_totalprice") > 100000).alias("large")
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", large)
    return _cast(df, o_orderkey="string", o_orderpriority="string", large="string")


@query(
    """
    SELECT o_orderkey, o_custkey <> 0 AS o_custkey,
      CASE left(o_orderpriority, 1) WHEN '1' THEN true WHEN '2' THEN false WHEN '3' THEN true
                                    WHEN '4' THEN false END AS text
    FROM orders"""
)
def step_cast_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        CASE left(o_orderpriority, 1) WHEN '1' THEN 'yes' WHEN '2' THEN '0' WHEN '3' THEN ' T '
                                      WHEN '4' THEN 'false' ELSE 'maybe' END"""
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.expr(text).alias("text"))
    return _cast(df, o_custkey="boolean", text="boolean")


@query(
    """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS text
    FROM orders"""
)
def step_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "CASE WHEN o_orderstatus = 'P' THEN '2023-99-99' ELSE date_format(o_orderdate, 'yyyy-MM-dd') END"
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.expr(text).alias("text"))
    return _cast(df, o_orderdate="date", text="date")


@query(
    """
    SELECT o_orderkey,
      CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + INTERVAL 3723 SECOND END AS text
    FROM orders"""
)
def step_cast_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = """
        CASE WHEN o_orderstatus = 'P' THEN 'yesterday'
             ELSE concat(date_format(o_orderdate, 'yyyy-MM-dd'), ' 01:02:03') END"""
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(text).alias("text"))
    return _cast(df, text="timestamp").withColumn("text", F.col("text").cast("timestamp_ntz"))


@query("SELECT o_orderkey, true AS stamped, true AS same_day FROM orders")
def step_lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "processed_timestamp": "current_timestamp()",
        "processed_date": "current_date()",
        "stamped": "processed_timestamp IS NOT NULL",
        "same_day": "cast(processed_timestamp AS date) = processed_date",
    }
    stamped = _orders(spark, sf_dir, {"type": "add_columns", "columns": columns})
    return stamped.select("o_orderkey", "stamped", "same_day")


@query(
    """
    SELECT o_orderkey AS record_id, o_custkey AS customer, CAST(trunc(o_totalprice) AS INTEGER) AS amount,
      CAST(o_orderdate AS DATE) AS o_orderdate, CAST(trunc(o_totalprice) AS INTEGER) * 2 AS doubled
    FROM orders WHERE trunc(o_totalprice) * 2 > 400000"""
)
def step_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = {"o_orderkey": "record_id", "o_custkey": "customer", "o_totalprice": "amount"}
    return _orders(
        spark,
        sf_dir,
        {"type": "rename_columns", "mapping": mapping},
        {"type": "drop_columns", "columns": ["o_orderstatus", "o_orderpriority"]},
        {"type": "cast_columns", "casts": {"amount": "integer", "o_orderdate": "date"}},
        {"type": "add_columns", "columns": {"doubled": "amount * 2"}},
        {"type": "filter_rows", "condition": "doubled > 400000"},
        {"type": "no_such_step"},
    )


@query("SELECT o_orderpriority, o_orderkey FROM orders")
def step_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["o_orderpriority", "o_orderkey"]
    return _orders(spark, sf_dir, {"type": "select_columns", "columns": columns})


@query(
    """
    SELECT o_orderkey, o_custkey, o_totalprice, rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS place,
      count(*) OVER (PARTITION BY o_custkey) AS orders
    FROM orders QUALIFY rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) <= 3"""
)
def step_add_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Window functions in ``add_columns``, partitioned, so that the work is spread by customer."""
    columns = {
        "place": "cast(rank() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC) AS bigint)",
        "orders": "count(1) OVER (PARTITION BY o_custkey)",
    }
    steps = [{"type": "add_columns", "columns": columns}, {"type": "filter_rows", "condition": "place <= 3"}]
    return _orders(spark, sf_dir, *steps).select("o_orderkey", "o_custkey", "o_totalprice", "place", "orders")


@query(
    """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)
      AND EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)"""
)
def step_filter_subquery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subqueries in ``filter_rows``, over views of the session; they are planned as semi-joins."""
    for name in ("customer", "lineitem"):
        table(spark, sf_dir, name).createOrReplaceTempView(f"step_filter_{name}")
    condition = """
        o_custkey IN (SELECT c_custkey FROM step_filter_customer WHERE c_acctbal < 0)
        AND EXISTS (SELECT 1 FROM step_filter_lineitem WHERE l_orderkey = o_orderkey AND l_quantity > 45)"""
    return _orders(spark, sf_dir, {"type": "filter_rows", "condition": condition}).select("o_orderkey", "o_custkey")

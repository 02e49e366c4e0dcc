"""Grouped counts and top-n. Counting starts before the shuffle, so hot keys do not skew it."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitypipe import fixed_values as fixed
from qualitypipe.functions.columns import col_named, count_name


def count_by(df: DataFrame, column: str) -> DataFrame:
    """``(column, count)``; NULL is a group of its own. Beside a column called count, the count is ``number``."""
    counts = df.groupBy(col_named(column).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.select(F.col("_value").alias(column), F.col("_rows").alias(count_name(column)))


def top_n(df: DataFrame, column: str, n: int = fixed.TOP_N) -> DataFrame:
    """The ``n`` most frequent values; equal counts are ordered by value."""
    return count_by(df, column).orderBy(F.desc(count_name(column)), col_named(column).asc_nulls_last()).limit(n)


def counted_values(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(_column, _key0, .., count)``: the counts of several columns from one scan by grouping sets.

    ``_column`` is the position of the column that a row counts, whose value is in the key of that number, in its own type;
    the other keys are NULL. Counts of all columns and their most frequent values can be read from these rows.
    """
    columns = list(dict.fromkeys(columns))
    keys = [f"_key{i}" for i in range(len(columns))]
    keyed = df.select(*(col_named(c).alias(k) for c, k in zip(columns, keys, strict=True)))
    counted = keyed.groupingSets([[k] for k in keys], *keys).agg(
        *(F.grouping(k).alias(f"_off{i}") for i, k in enumerate(keys)),
        F.count(F.lit(1)).alias("count"),
    )
    own = F.coalesce(*(F.when(F.col(f"_off{i}") == 0, F.lit(i)) for i in range(len(keys))))
    return counted.select(own.alias("_column"), *keys, "count")


def group_counts_of(counted: DataFrame, columns: Iterable[str], asked: Iterable[str] | None = None) -> DataFrame:
    """``(column_name, value, count)`` of the columns asked for, from ``counted_values`` of ``columns``."""
    columns = list(dict.fromkeys(columns))
    places = [columns.index(c) for c in dict.fromkeys(columns if asked is None else asked)]

    def of_own_set(cell):
        return F.coalesce(*(F.when(F.col("_column") == i, cell(i)) for i in places))

    rows = counted if len(places) == len(columns) else counted.filter(F.col("_column").isin(places))
    return rows.select(
        of_own_set(lambda i: F.lit(columns[i])).alias("column_name"),
        of_own_set(lambda i: F.col(f"_key{i}").cast("string")).alias("value"),
        "count",
    )


def top_n_of(counted: DataFrame, columns: Iterable[str], column: str, n: int = fixed.TOP_N) -> DataFrame:
    """``top_n`` of one column from ``counted_values`` of ``columns``."""
    place = list(dict.fromkeys(columns)).index(column)
    counts = counted.filter(F.col("_column") == place).select(F.col(f"_key{place}").alias(column), F.col("count").alias(count_name(column)))
    return counts.orderBy(F.desc(count_name(column)), col_named(column).asc_nulls_last()).limit(n)


def group_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``(column_name, value, count)`` for several columns from one scan by grouping sets."""
    columns = list(columns)
    return group_counts_of(counted_values(df, columns), columns)

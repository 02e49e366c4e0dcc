"""CSV source."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe import fixed_values as fixed
from qualitypipe.config import from_config
from qualitypipe.functions.columns import col_named, quoted

# Keys of the configuration and the reader option each one sets.
_NAMED_OPTIONS = {
    "header": "header",
    "infer_schema": "inferSchema",
    "delimiter": "delimiter",
    "mode": "mode",
}
# Options that say which files are read and how their lines are cut, in lower case as Spark compares them.
_FILE_OPTIONS = {"pathglobfilter", "recursivefilelookup", "modifiedbefore", "modifiedafter", "encoding", "charset", "linesep"}
#: The column of bad rows that are kept apart, if no other is configured.
BAD_ROW = "_bad_row"


@dataclass(frozen=True)
class CsvSource:
    """One CSV data set: a file, directory, glob or list of them.

    ``options`` takes any Spark CSV option and overrides the named keys. With ``schema`` (DDL text or
    ``StructType``) nothing is inferred; without it, inference reads the whole input once more, which
    ``options={"samplingRatio": ...}`` cuts down.

    ``corrupt_record_column`` adds the text of rows that do not fit the schema, given or inferred; an inferred one is fixed
    before the rows are read. ``bad_rows_path`` is where a run keeps these rows instead of going on with them.

    Columns are taken by position, as Spark does; with ``match_headers``, by the names in each file's own header.
    """

    input_path: str | list[str] | None = None
    header: Any = None
    infer_schema: Any = None
    delimiter: Any = None
    mode: Any = None
    options: dict[str, Any] = field(default_factory=dict)
    schema: str | T.StructType | None = None
    corrupt_record_column: str | None = None
    bad_rows_path: str | None = None
    match_headers: bool = False

    def __post_init__(self):
        if not self.input_path:
            raise ValueError(fixed.MISSING_PATH)
        options = {key.lower(): str(value).lower() for key, value in self.reader_options().items()}
        if self.bad_rows_path and options["mode"] != "permissive":
            raise ValueError("bad_rows_path needs the mode PERMISSIVE: others drop bad rows or fail")
        if self.match_headers and options["header"] != "true":
            raise ValueError("match_headers needs files with headers")

    @property
    def bad_row(self) -> str | None:
        """The column that holds the text of a bad row."""
        return self.corrupt_record_column or (BAD_ROW if self.bad_rows_path else None)

    def reader_options(self) -> dict[str, Any]:
        given = {option: getattr(self, key) for key, option in _NAMED_OPTIONS.items()}
        named = {option: value for option, value in given.items() if value is not None}
        return {**fixed.CSV_DEFAULTS, **named, **self.options}


def read_csv(spark: SparkSession, config: CsvSource | dict[str, Any]) -> DataFrame:
    """Lazy scan of the configured CSV files. Bad rows are among them, marked if a column for them is configured."""
    source = config if isinstance(config, CsvSource) else from_config(CsvSource, config)
    options, schema = source.reader_options(), source.schema
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if source.match_headers:
        return _read_by_header(spark, source, options, schema)
    if schema is None and source.bad_row is None:
        return spark.read.format("csv").options(**options).load(source.input_path)
    if schema is None:
        schema = spark.read.format("csv").options(**options).load(source.input_path).schema
    return _scan(spark, source.input_path, options, schema, source.bad_row)


def split_bad_rows(rows: DataFrame, bad_row: str) -> tuple[DataFrame, DataFrame]:
    """The rows that fit, without the column that marks the others; and the text of the others as ``value``."""
    good = rows.filter(col_named(bad_row).isNull()).drop(bad_row)
    return good, rows.filter(col_named(bad_row).isNotNull()).select(col_named(bad_row).alias("value"))


def _scan(spark: SparkSession, paths: str | list[str], options: dict[str, Any], schema: T.StructType, corrupt: str | None) -> DataFrame:
    options = {key: value for key, value in options.items() if key.lower() != "inferschema"}
    if corrupt is None:
        return spark.read.format("csv").options(**options).schema(schema).load(paths)

    # Only cells that are read are parsed, so a query that selects few columns would miss bad cells in
    # the others. Hashing the row makes every cell part of the corrupt-record column.
    data_columns = [col_named(f.name) for f in schema.fields if f.name != corrupt]
    with_corrupt = T.StructType([f for f in schema.fields if f.name != corrupt]).add(corrupt, "string")
    options["columnNameOfCorruptRecord"] = corrupt
    rows = spark.read.format("csv").options(**options).schema(with_corrupt).load(paths)
    every_cell_parsed = F.xxhash64(*data_columns) >= F.lit(-(2**63))
    return rows.withColumn(corrupt, F.when(every_cell_parsed, col_named(corrupt)))


# ---------------------------------------------------------------------------------------------------
# Files whose headers differ


def _read_by_header(spark: SparkSession, source: CsvSource, options: dict[str, Any], schema: T.StructType | None) -> DataFrame:
    """Files with the same header are one scan, with its columns in that order; the scans are put together by name.

    With a schema, its columns come out: NULL where a file lacks one, and columns that it does not name are left out. Without,
    all columns of all headers, in the order in which they are first met, each of a type that holds what was inferred for it.
    """
    groups = _files_by_header(spark, source, options)
    if not groups:
        return spark.read.format("csv").options(**options).load(source.input_path) if schema is None else spark.createDataFrame([], schema)
    if schema is not None:  # names only, from one file each
        options = {key: value for key, value in options.items() if key.lower() != "inferschema"}
    asked = groups if schema is None else [files[:1] for files in groups]
    shapes = [spark.read.format("csv").options(**options).load(files).schema for files in asked]
    if schema is None:
        kinds: dict[str, list[T.DataType]] = {}
        for shape in shapes:
            for f in shape.fields:
                kinds.setdefault(f.name, []).append(f.dataType)
        schema = T.StructType([T.StructField(name, _common_type(types)) for name, types in kinds.items()])
    corrupt = source.bad_row
    types = {f.name: f.dataType for f in schema.fields if f.name != corrupt}
    frames = []
    for shape, files in zip(shapes, groups, strict=True):
        # columns of the file that nobody asked for are read as text, if at all
        own = T.StructType([T.StructField(f.name, types.get(f.name, T.StringType())) for f in shape.fields])
        rows = _scan(spark, files, options, own, corrupt)
        cells = [(col_named(name) if name in shape.names else F.lit(None).cast(kind)).alias(name) for name, kind in types.items()]
        frames.append(rows.select(*cells, *([quoted(corrupt)] if corrupt else [])))
    return reduce(DataFrame.unionByName, frames)


def _files_by_header(spark: SparkSession, source: CsvSource, options: dict[str, Any]) -> list[list[str]]:
    """The files, those with the same header line together. One pass over the first split of each file finds the lines;
    the names of the files reach the driver, where the scan lists them anyway."""
    passed = {key: value for key, value in options.items() if key.lower() in _FILE_OPTIONS}
    comment = next((value for key, value in options.items() if key.lower() == "comment"), None)
    lines = spark.read.format("text").options(**passed).load(source.input_path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = lines.filter((F.col("start") == 0) & (F.trim("value") != ""))
    if comment:
        lines = lines.filter(~F.col("value").startswith(comment))
    # a file's first split is read by one task, from its first line on
    headers = lines.groupBy("file").agg(F.first("value").alias("header"))
    grouped = headers.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files"))
    return sorted([_literal_path(name) for name in r.files] for r in grouped.collect())


def _literal_path(uri: str) -> str:
    """The path that a file's URI names, for readers that take paths for patterns."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def _common_type(types: list[T.DataType]) -> T.DataType:
    """A type for values that were inferred apart: numbers widen, days become timestamps, and anything else is text."""
    distinct = list(dict.fromkeys(types))
    if len(distinct) == 1:
        return distinct[0]
    if all(isinstance(t, (T.IntegerType, T.LongType)) for t in distinct):
        return T.LongType()
    if all(isinstance(t, T.NumericType) for t in distinct):
        return T.DoubleType()
    if all(isinstance(t, (T.DateType, T.TimestampType)) for t in distinct):
        return T.TimestampType()
    return T.StringType()

"""Column expressions: lenient casts, text extraction and classification.

All of them are built-in Catalyst expressions, so they stay inside whole-stage code generation, and
none depends on ``spark.sql.ansi.enabled``: unusable input always becomes NULL instead of an error.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe import fixed_values as fixed

CAST_TARGETS = {
    "integer": "int",
    "double": "double",
    "string": "string",
    "boolean": "boolean",
    "date": "date",
    "timestamp": "timestamp",
}

# try_cast turns every bad text into a caught exception, some 50 times the cost of a good one. These
# shapes cover all that can be converted and keep almost everything else away from the cast.
_BLANK = r"[\x00-\x20\x7F]*+"
_INT_DIGITS = "[0-9]{1,9}|1[0-9]{9}|20[0-9]{8}|21[0-4][0-9]{7}"  # what fits, and little beyond
_INT_TEXT = rf"^{_BLANK}[+-]?(?:0*+(?:{_INT_DIGITS})|0++)(?:\.[0-9]*+)?{_BLANK}\z"
_FRACTION_TEXT = rf"^{_BLANK}[+-]?\.[0-9]*+{_BLANK}\z"
_DOUBLE_TEXT = (
    rf"^{_BLANK}[+-]?(?:(?:[0-9]++\.?[0-9]*+|\.[0-9]++)(?:[eE][+-]?[0-9]++)?[dDfF]?"
    rf"|0[xX][0-9a-fA-F.]++[pP][+-]?[0-9]++[dDfF]?|(?i:inf|infinity|nan)){_BLANK}\z"
)
_DATE_TEXT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_TRUE_TEXT = ["t", "true", "y", "yes", "1"]
_FALSE_TEXT = ["f", "false", "n", "no", "0"]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def col_named(name: str) -> Column:
    """The column with exactly this name, also when the name holds dots or backticks."""
    return F.col(quoted(name))


def count_name(column: str) -> str:
    """What a count beside this column is called: ``count``, or ``number`` if the column itself has that name."""
    return "number" if column.lower() == fixed.COUNT_COLUMN else fixed.COUNT_COLUMN


def is_text(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.StringType, T.CharType, T.VarcharType))


_PLAIN_LEAVES = (T.BooleanType, T.IntegralType, T.DecimalType, T.DateType, T.TimestampNTZType, T.DayTimeIntervalType, T.YearMonthIntervalType)


def _has_canonical_text(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _has_canonical_text(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _has_canonical_text(data_type.keyType) and _has_canonical_text(data_type.valueType)
    if isinstance(data_type, T.StructType):
        return all(_has_canonical_text(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.StringType):
        return data_type == T.StringType() or isinstance(data_type, (T.CharType, T.VarcharType))
    return isinstance(data_type, (*_PLAIN_LEAVES, T.BinaryType, T.FloatType, T.DoubleType, T.TimestampType, T.CharType, T.VarcharType, T.NullType))


def is_nested(data_type: T.DataType) -> bool:
    return isinstance(data_type, (T.ArrayType, T.MapType, T.StructType))


def is_wide(data_type: T.DataType) -> bool:
    """Values of any length that a digest can stand for: text compared byte by byte, binary, and arrays, structs and
    maps of what has a canonical text."""
    if isinstance(data_type, (T.BinaryType, T.CharType, T.VarcharType)):
        return True
    return data_type == T.StringType() or (is_nested(data_type) and _has_canonical_text(data_type))


def canonical_text(value: Column, data_type: T.DataType) -> Column:
    """Text that two values share exactly if grouping takes them for equal; NULL stays NULL.

    Parts are written with their length in front, so that none can be taken for another. NaNs are equal, and so are 0.0 and
    -0.0; timestamps are instants, whatever the session's time zone; entries of a map are sorted.
    """

    def framed(part: Column, part_type: T.DataType) -> Column:
        text = canonical_text(part, part_type)
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    if isinstance(data_type, T.ArrayType):
        parts = F.transform(value, lambda part: framed(part, data_type.elementType))
        return F.array_join(parts, "")
    if isinstance(data_type, T.MapType):
        entry = lambda e: F.concat(framed(e["key"], data_type.keyType), framed(e["value"], data_type.valueType))
        return F.array_join(F.array_sort(F.transform(F.map_entries(value), entry)), "")
    if isinstance(data_type, T.StructType):
        fields = [framed(value.getField(f.name), f.dataType) for f in data_type.fields]
        return F.when(value.isNotNull(), F.concat(F.lit(""), *fields))
    if isinstance(data_type, T.BinaryType):
        return F.hex(value)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, F.lit("0.0")).otherwise(value.cast("string"))
    if isinstance(data_type, T.TimestampType):
        return F.unix_micros(value).cast("string")
    return value.cast("string")


def digest(column: Column, data_type: T.DataType | None = None) -> Column:
    """The 32 bytes of SHA-256 of text or binary, or of the canonical text of a nested value; NULL stays NULL."""
    if data_type is not None and is_nested(data_type):
        column = canonical_text(column, data_type)
    return F.unhex(F.sha2(column.cast("binary"), 256))


def text_to_int(text: Column) -> Column:
    """Text to int: ``'7.9'`` gives 7 and ``'-.5'`` 0; text that is no number or does not fit, NULL."""
    whole_number = F.substring_index(text, ".", 1).try_cast("int")
    return F.when(text.rlike(_INT_TEXT), whole_number).when(text.rlike(_FRACTION_TEXT), F.lit(0))


def text_to_double(text: Column) -> Column:
    return F.when(text.rlike(_DOUBLE_TEXT), text.try_cast("double"))


def text_to_boolean(text: Column) -> Column:
    word = F.lower(F.regexp_extract(text, rf"^{_BLANK}([a-zA-Z01]{{1,5}}){_BLANK}\z", 1))
    return F.when(word.isin(_TRUE_TEXT), F.lit(True)).when(word.isin(_FALSE_TEXT), F.lit(False))


_TEXT_CASTS = {"integer": text_to_int, "double": text_to_double, "boolean": text_to_boolean}


def lenient_cast(column: Column, source: T.DataType, target: str) -> Column:
    """Cast to one of ``CAST_TARGETS``; values that cannot be converted become NULL."""
    if is_text(source) and target in _TEXT_CASTS:
        return _TEXT_CASTS[target](column)
    return column.try_cast(CAST_TARGETS[target])


def parse_date(
    column: Column, date_format: str = fixed.DATE_FORMAT, source: T.DataType | None = None
) -> Column:
    """To date. Text is read by a format, and text that does not follow it becomes NULL; dates stay, and of
    timestamps the day is kept, whatever the format. Without a ``source`` type the column is taken for text."""
    if source is not None and not is_text(source):
        return column.try_cast("date")
    parsed = F.try_to_date(column, date_format)
    if date_format != fixed.DATE_FORMAT:
        return parsed
    # The same dates without the formatter, which is needed for signed years only.
    plain = F.when(column.rlike(_DATE_TEXT), column.try_cast("date"))
    return plain.when(column.rlike("^[+-]"), parsed)


def coordinates(column: Column) -> tuple[Column, Column]:
    """(longitude, latitude) out of text such as ``[4.85,45.76]``."""
    inside = F.regexp_extract(column, fixed.COORDINATES_PATTERN, 1)
    numbers = F.split(inside, ",")
    return text_to_double(F.get(numbers, 0)), text_to_double(F.get(numbers, 1))


def city(column: Column, pattern: str = fixed.CITY_PATTERN) -> Column:
    """First group of ``pattern``: ``''`` without a match, NULL for NULL."""
    return F.regexp_extract(column, pattern, 1)


def first_true(labels: Mapping[str, str], default: str | None) -> Column:
    """Label of the first flag column that is true; a NULL flag counts as not true."""
    return F.coalesce(
        *(F.when(col_named(flag), F.lit(label)) for flag, label in labels.items()), F.lit(default)
    )


def bucketize(
    column: Column, bounds: Iterable[Mapping], top_label: str, null_label: str | None
) -> Column:
    """Label of the first bound above the value, ``top_label`` beyond all of them."""
    null_case = F.when(column.isNull(), F.lit(null_label))
    cases = reduce(lambda c, b: c.when(column < F.lit(b["below"]), F.lit(b["label"])), bounds, null_case)
    return cases.otherwise(F.lit(top_label))

"""Transformation steps.

A step turns one DataFrame into the next without running anything. Parts of a step that do not fit the
data (a missing column, an expression that fails analysis) are left out and noted, or raised with
``on_error="raise"``. Only analysis is guarded: errors that appear while rows are processed always
surface. Expressions of ``add_columns`` and ``filter_rows`` are Spark SQL and follow the session's own
ANSI setting.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any, Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualitypipe import fixed_values as fixed
from qualitypipe.config import from_config
from qualitypipe.functions import columns as fn
from qualitypipe.functions.columns import col_named, quoted


@dataclass(frozen=True)
class StepNote:
    """Something a step, or the analytics after the steps, left out."""

    step_no: int | None
    step: str | None
    target: str | None
    reason: str


class StepError(ValueError):
    """A step did not fit the data under ``on_error="raise"``."""


Notify = Callable[[str | None, str], None]


class Step(Protocol):
    def apply(self, df: DataFrame, notify: Notify) -> DataFrame: ...


STEP_TYPES: dict[str, type[Step]] = {}


def _step(kind: str):
    def register(cls):
        STEP_TYPES[kind] = dataclass(frozen=True)(cls)
        return STEP_TYPES[kind]

    return register


def _attempt(df: DataFrame, change: Callable[[], DataFrame], target: str | None, notify: Notify) -> DataFrame:
    """``change()`` if it passes analysis, else the frame as it was and a note."""
    try:
        changed = change()
        changed.schema  # noqa: B018  analysis may be deferred until asked for
    except AnalysisException as error:
        notify(target, str(error).splitlines()[0])
        return df
    return changed


@_step("rename_columns")
class RenameColumns:
    """``mapping`` of old to new names, applied one after the other."""

    mapping: Mapping[str, str] = field(default_factory=dict)

    def apply(self, df, notify):
        names = df.columns
        for old, new in self.mapping.items():
            if old not in names:
                notify(old, "column not found")
            names = [new if name == old else name for name in names]
        # names that the session takes for one are one
        exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        before, after = ({n if exact else n.lower() for n in some} for some in (df.columns, names))
        if len(after) < len(before):
            raise StepError(f"rename_columns would leave several columns of one name: {names}")
        return df.toDF(*names) if names != df.columns else df


@_step("cast_columns")
class CastColumns:
    """``casts`` of column to type name; values that cannot be converted become NULL."""

    casts: Mapping[str, str] = field(default_factory=dict)

    def apply(self, df, notify):
        fitting = {}
        for column, target in self.casts.items():
            if column not in df.columns:
                notify(column, "column not found")
            elif target not in fn.CAST_TARGETS:
                notify(column, f"unsupported type: {target}")
            else:
                fitting[column] = fn.lenient_cast(col_named(column), df.schema[column].dataType, target)
        # One projection for all casts; one by one only to single out a cast that analysis rejects.
        rejected = []
        together = _attempt(
            df, lambda: df.withColumns(fitting), None, lambda _, reason: rejected.append(reason)
        )
        if not rejected:
            return together
        for column, cast in fitting.items():
            df = _attempt(df, lambda d=df, c=column, x=cast: d.withColumn(c, x), column, notify)
        return df


@_step("drop_columns")
class DropColumns:
    columns: Iterable[str] = ()

    def apply(self, df, notify):
        return df.drop(*(c for c in self.columns if c in df.columns))


@_step("filter_rows")
class FilterRows:
    """Keeps the rows whose SQL ``condition`` is true."""

    condition: str = ""

    def apply(self, df, notify):
        if not self.condition:
            return df
        if not isinstance(self.condition, str):
            notify(None, "condition is not SQL text")
            return df
        return _attempt(df, lambda: df.filter(self.condition), None, notify)


@_step("add_columns")
class AddColumns:
    """``columns`` of name to SQL expression, in order; a later one may use an earlier one."""

    columns: Mapping[str, str] = field(default_factory=dict)

    def apply(self, df, notify):
        for name, expression in self.columns.items():
            if not isinstance(expression, str):
                notify(name, "expression is not SQL text")
                continue
            df = _attempt(df, lambda d=df, n=name, e=expression: d.withColumn(n, F.expr(e)), name, notify)
        return df


@_step("extract_coordinates")
class ExtractCoordinates:
    """Longitude and latitude out of text such as ``[4.85,45.76]``."""

    source_column: str | None = None
    longitude_column: str = "longitude"
    latitude_column: str = "latitude"

    def apply(self, df, notify):
        if self.source_column not in df.columns:
            notify(self.source_column, "column not found")
            return df
        longitude, latitude = fn.coordinates(col_named(self.source_column))
        added = {self.longitude_column: longitude, self.latitude_column: latitude}
        return _attempt(df, lambda: df.withColumns(added), self.source_column, notify)


@_step("extract_city")
class ExtractCity:
    """First group of ``pattern``; by default the word after a five-digit postal code."""

    source_column: str | None = None
    target_column: str = "city"
    pattern: str = fixed.CITY_PATTERN

    def apply(self, df, notify):
        if self.source_column not in df.columns:
            notify(self.source_column, "column not found")
            return df
        found = fn.city(col_named(self.source_column), self.pattern)
        return _attempt(df, lambda: df.withColumn(self.target_column, found), self.source_column, notify)


@_step("parse_dates")
class ParseDates:
    """Columns to dates: text by a fixed format, NULL where it does not follow it; of timestamps the day."""

    columns: Iterable[str] = ()
    format: str = fixed.DATE_FORMAT

    def apply(self, df, notify):
        parsed = {}
        for column in self.columns:
            if column in df.columns:
                parsed[column] = fn.parse_date(col_named(column), self.format, df.schema[column].dataType)
            else:
                notify(column, "column not found")
        return _attempt(df, lambda: df.withColumns(parsed), None, notify)


@_step("first_true")
class FirstTrue:
    """Label of the first true flag among ``labels`` (flag column -> label), else ``default``."""

    target_column: str = "category"
    labels: Mapping[str, str] = field(default_factory=dict)
    default: str | None = None

    def apply(self, df, notify):
        present = {flag: label for flag, label in self.labels.items() if flag in df.columns}
        for flag in self.labels:
            if flag not in present:
                notify(flag, "column not found")
        label = fn.first_true(present, self.default)
        return _attempt(df, lambda: df.withColumn(self.target_column, label), self.target_column, notify)


@_step("bucketize")
class Bucketize:
    """Label of the first of ``bounds`` (``{"below": 50, "label": "Low"}``) above the value.

    Text is compared as a number, and text that is none counts as NULL.
    """

    source_column: str | None = None
    target_column: str = "category"
    bounds: Iterable[Mapping[str, Any]] = ()
    top_label: str = ""
    null_label: str | None = None

    def apply(self, df, notify):
        if self.source_column not in df.columns:
            notify(self.source_column, "column not found")
            return df
        value = col_named(self.source_column)
        if fn.is_text(df.schema[self.source_column].dataType):
            value = fn.text_to_double(value)
        label = fn.bucketize(value, self.bounds, self.top_label, self.null_label)
        return _attempt(df, lambda: df.withColumn(self.target_column, label), self.target_column, notify)


@_step("select_columns")
class SelectColumns:
    """Exactly these ``columns`` in this order; one that is missing is always an error."""

    columns: Iterable[str] = ()

    def apply(self, df, notify):
        missing = [c for c in self.columns if c not in df.columns]
        if missing:
            raise StepError(f"select_columns: not found: {', '.join(missing)}")
        return df.select(*map(quoted, self.columns))


@dataclass(frozen=True)
class Transformed:
    frame: DataFrame
    notes: list[StepNote]


def apply_steps(
    df: DataFrame, steps: Iterable[Mapping[str, Any]], on_error: str = "skip"
) -> Transformed:
    """The steps in order, as one lazy plan, with notes on everything left out."""
    if on_error not in ("skip", "raise"):
        raise ValueError(f"on_error must be 'skip' or 'raise', not {on_error!r}")
    notes: list[StepNote] = []
    for step_no, config in enumerate(steps, start=1):
        kind = config.get("type")

        def notify(target, reason, step_no=step_no, kind=kind):
            if on_error == "raise":
                raise StepError(f"step {step_no} ({kind}), {target}: {reason}")
            notes.append(StepNote(step_no, kind, target, reason))

        if kind not in STEP_TYPES:
            notify(None, "unknown step type")
            continue
        df = from_config(STEP_TYPES[kind], config, ignore=("type",)).apply(df, notify)
    return Transformed(df, notes)

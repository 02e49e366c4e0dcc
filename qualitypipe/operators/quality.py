"""Quality rules and their report.

A rule is turned into *checks*, one per column. Row checks (null, range, pattern) are a condition on
one row; unique checks need all rows with the same value to meet. ``measure`` answers all of them in
one scan of the data, and ``build_report`` lays the answers out as one row per rule and column. Nothing
here runs a job except ``validate``, which collects the report: its size is set by the rules, not by
the data.

Rules are proved before the scan: each condition is evaluated on one constant row of the column's types, which
the optimizer does without a job. A pattern that can't be compiled or a bound that is no value of the column's type
thus becomes a failed line instead of an error in the middle of the scan.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from datetime import date, datetime
from decimal import Decimal
from functools import reduce
from itertools import zip_longest
from string import Formatter
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe import fixed_values as fixed
from qualitypipe.config import from_config
from qualitypipe.functions.columns import col_named, count_name, digest, is_nested, is_text, is_wide, quoted, text_to_double

# Row checks that share one outcome mask. 2^10 bounds the distinct masks a task can send to the shuffle.
_CHECKS_PER_MASK = 10
# Row checks beside unique columns up to which masks are computed in the same generated method as the scan. Many more make
# that method too large to be compiled (8,000 bytes of code); they get a generated class of their own, cut into small methods.
_CHECKS_IN_SCAN_METHOD = 40
# What shares one scan of the data unless the caller says otherwise: all row checks, and so many unique columns, each of
# which makes the shuffled rows 8 bytes wider.
CHECKS_PER_SCAN = None
KEYS_PER_SCAN = 8
# Offending values of a pattern up to which they share the scan of all examples.
_SHARED_EXAMPLES = 1_000_000


# ---------------------------------------------------------------------------------------------------
# Rules


@dataclass(frozen=True)
class Check:
    """One question about one column: a row condition, a uniqueness question, or a settled answer.

    ``terms`` are the parts of a condition that is an alternative: one that holds keeps the next from being evaluated.
    ``unfit`` is the reason to give if one can't be evaluated on values of the column's type.
    """

    column: str | None
    failing: Column | None = None
    unique: bool = False
    allowed_share: float = 0.0
    details: str | None = None
    parts: Mapping[str, Any] = field(default_factory=dict)
    status: str | None = None
    terms: tuple[Column, ...] = ()
    unfit: str | None = None

    @property
    def settled(self) -> bool:
        return self.status is not None


def _missing(column: str | None) -> Check:
    return Check(column, status="fail", details=fixed.MISSING_COLUMN)


def _list_of_names(rule: str, columns: Any) -> None:
    if isinstance(columns, str):
        raise ValueError(f"rule '{rule}': columns must be a list of names, not the text {columns!r}")


def _failed_line(check: Check, reason: str) -> Check:
    return Check(check.column, status="fail", details=_UNFIT, parts={"reason": reason})


def _fitting(df: DataFrame, check: Check) -> Check:
    """The check, or a failed line with the reason if its condition does not fit the column's type."""
    if check.settled:
        return check
    try:
        asked = col_named(check.column) if check.unique else check.failing
        (df.groupBy(asked).count() if check.unique else df.select(asked)).schema  # noqa: B018  analysis only
    except AnalysisException as error:
        return _failed_line(check, str(error).splitlines()[0])
    return check


def _specimen(data_type: T.DataType) -> Column:
    """A constant of the type, not NULL wherever the type has an obvious one: NULL would hide errors."""
    if isinstance(data_type, T.StructType):
        return F.struct(*(_specimen(f.dataType).alias(f.name) for f in data_type.fields)).cast(data_type)
    if isinstance(data_type, T.ArrayType):
        return F.array().cast(data_type)
    if isinstance(data_type, T.MapType):
        return F.create_map().cast(data_type)
    if isinstance(data_type, (T.NumericType, T.BooleanType)):
        return F.lit(0).cast(data_type)
    if isinstance(data_type, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.lit("2000-01-01").cast(data_type)
    if is_text(data_type) or isinstance(data_type, T.BinaryType):
        return F.lit("").cast(data_type)
    return F.lit(None).cast(data_type)


def _proved(df: DataFrame, checks: list[Check]) -> list[Check]:
    """The checks, with failed lines for those whose conditions fail on a constant row of the columns' types.

    The row is part of the plan, so the optimizer evaluates it and nothing runs. All are tried at once, and one by one
    only if that fails.
    """
    by_row = [check for check in checks if not check.settled and not check.unique]
    if not by_row:
        return checks
    columns = list(dict.fromkeys(check.column for check in by_row))
    constant = df.sparkSession.sql("SELECT * FROM VALUES (0) AS one(zero)")
    row = constant.select(*(_specimen(df.schema[c].dataType).alias(c) for c in columns))

    def reason(some: list[Check]) -> str | None:
        try:
            terms = [term for check in some for term in check.terms or (check.failing,)]
            row.select(*(term.alias(f"c{i}") for i, term in enumerate(terms))).collect()
        except (PySparkException, Py4JJavaError) as error:
            return str(error).splitlines()[0]
        return None

    if reason(by_row) is None:
        return checks
    out = []
    for check in checks:
        why = reason([check]) if not check.settled and not check.unique else None
        out.append(check if why is None else _failed_line(check, check.unfit or why))
    return out


_UNFIT = "Rule does not fit column '{column}': {reason}"


@dataclass(frozen=True)
class NotNull:
    """NULLs may make up at most ``1 - threshold`` of a column; each column is checked on its own."""

    name: str = "not_null"
    columns: Iterable[str] = ()
    threshold: float = 1.0

    def __post_init__(self):
        _list_of_names(self.name, self.columns)

    def checks(self, df: DataFrame) -> list[Check]:
        try:
            allowed = 1.0 - float(self.threshold)
        except (TypeError, ValueError):
            reason = f"threshold {self.threshold!r} is no number"
            return [_failed_line(Check(c), reason) if c in df.columns else _missing(c) for c in self.columns]
        return [
            Check(c, failing=col_named(c).isNull(), allowed_share=allowed, details=fixed.NULL_VALUES)
            if c in df.columns
            else _missing(c)
            for c in self.columns
        ]


@dataclass(frozen=True)
class Unique:
    """No value, NULL included, may occur twice; each column is checked on its own."""

    name: str = "unique"
    columns: Iterable[str] = ()

    def __post_init__(self):
        _list_of_names(self.name, self.columns)

    def checks(self, df: DataFrame) -> list[Check]:
        return [
            Check(c, unique=True, details=fixed.DUPLICATE_VALUES) if c in df.columns else _missing(c)
            for c in self.columns
        ]


@dataclass(frozen=True)
class ValueRange:
    """Values must lie in ``[min, max]``; either bound may be left out and NULL always passes.

    Numeric bounds on a text column compare the text as a number, dates and timestamps as such; text that is none passes.
    Text as a bound is taken for a value of the column's type; if it is none, the rule does not fit.
    """

    name: str = "value_range"
    column: str | None = None
    min: Any = None
    max: Any = None

    def checks(self, df: DataFrame) -> list[Check]:
        if self.column not in df.columns:
            return [_missing(self.column)]
        value = col_named(self.column)
        kind = df.schema[self.column].dataType
        bounds = [b for b in (self.min, self.max) if b is not None]
        if is_text(kind) and all(isinstance(b, (int, float, Decimal)) for b in bounds):
            value = text_to_double(value)
        elif is_text(kind) and all(isinstance(b, date) for b in bounds):
            value = value.try_cast("timestamp" if any(isinstance(b, datetime) for b in bounds) else "date")
        outside = []
        if self.min is not None:
            outside.append(value < F.lit(self.min))
        if self.max is not None:
            outside.append(value > F.lit(self.max))
        failing = reduce(Column.__or__, outside) if outside else F.lit(False)
        parts = {"low": self.min, "high": self.max}
        unfit = f"bounds [{self.min}, {self.max}] are no values of type {kind.simpleString()}"
        return [Check(self.column, failing=failing, details=fixed.OUTSIDE_RANGE, parts=parts, terms=tuple(outside), unfit=unfit)]


@dataclass(frozen=True)
class RegexMatch:
    """The text form of a value must contain a match of ``pattern``; NULL passes."""

    name: str = "regex_match"
    column: str | None = None
    pattern: str | None = None

    def __post_init__(self):
        if not isinstance(self.pattern, str):
            raise ValueError(f"rule '{self.name}': regex_match needs a pattern")

    def checks(self, df: DataFrame) -> list[Check]:
        if self.column not in df.columns:
            return [_missing(self.column)]
        failing = not_matching(self.column, self.pattern)
        unfit = f"'{self.pattern}' is no regular expression"
        return [Check(self.column, failing=failing, details=fixed.NOT_MATCHING, parts={"pattern": self.pattern}, unfit=unfit)]


@dataclass(frozen=True)
class UnknownRule:
    """A rule of a type that does not exist: reported as skipped."""

    name: str | None
    kind: str | None

    def checks(self, df: DataFrame) -> list[Check]:
        return [Check(None, status="skipped", details=fixed.UNKNOWN_RULE, parts={"kind": self.kind})]


RULE_TYPES = {
    "not_null": NotNull,
    "unique": Unique,
    "value_range": ValueRange,
    "regex_match": RegexMatch,
}
Rule = NotNull | Unique | ValueRange | RegexMatch | UnknownRule


def parse_rule(config: Mapping[str, Any] | Rule) -> Rule:
    if not isinstance(config, Mapping):
        return config
    kind = config.get("type")
    if kind not in RULE_TYPES:
        return UnknownRule(config.get("name", kind), kind)
    return from_config(RULE_TYPES[kind], config, ignore=("type",))


def _rule_type(rule: Rule) -> str | None:
    if isinstance(rule, UnknownRule):
        return rule.kind
    return next(kind for kind, cls in RULE_TYPES.items() if isinstance(rule, cls))


def not_matching(column: str, pattern: str) -> Column:
    """True for non-NULL values whose text form has no match of ``pattern``."""
    return ~col_named(column).cast("string").rlike(pattern)


# ---------------------------------------------------------------------------------------------------
# Measuring


def _key(df: DataFrame, column: str) -> Column:
    value, kind = col_named(column), df.schema[column].dataType
    return digest(value, kind) if is_wide(kind) else value


def measure(
    df: DataFrame, conditions: Mapping[str, Column] | None = None, unique: Mapping[str, str] | None = None
) -> DataFrame:
    """One row with ``total``, how many rows meet each condition, and how many rows repeat a value of
    each ``unique`` column (alias -> column).

    Without unique columns this is a plain aggregation. With them it stays one scan: a row's outcomes
    are packed into bit masks, and the rows are counted by grouping sets, one per unique column and one
    per mask. Text, binary and nested values are replaced by 256-bit digests, so that a shuffled key has 32 bytes at
    most. Counting starts before the shuffle, so a value that many rows share, and above all the
    few masks, leave a task as a single record. More than 40 conditions are evaluated in a generated class apart from
    the scan's, so their number does not slow a row down more than in proportion.
    """
    conditions, unique = dict(conditions or {}), dict(unique or {})
    outcomes = df.select(
        *(_key(df, column).alias(f"_key{i}") for i, column in enumerate(unique.values())),
        *(condition.alias(f"_fact{i}") for i, condition in enumerate(conditions.values())),
    )
    if not unique:
        counts = (f"count_if(_fact{i}) AS {quoted(name)}" for i, name in enumerate(conditions))
        return outcomes.selectExpr("count(1) AS total", *counts)

    keys = [f"_key{i}" for i in range(len(unique))]
    flags: dict[str, list[str]] = {}
    bits = []
    for i in range(len(conditions)):
        mask, bit = f"_mask{i // _CHECKS_PER_MASK}", 1 << (i % _CHECKS_PER_MASK)
        flags.setdefault(mask, []).append(f"if(_fact{i}, {bit}, 0)")
        bits.append((mask, bit))
    sums = {mask: " + ".join(terms) for mask, terms in flags.items()}
    if len(conditions) > _CHECKS_IN_SCAN_METHOD:
        # A higher-order function takes its projection out of whole-stage code generation: it is then compiled by itself,
        # with its expressions spread over small methods.
        sums["_mask0"] += " + element_at(transform(array(0), x -> x), 1)"
    masked = outcomes.selectExpr(*keys, *(f"{total} AS {mask}" for mask, total in sums.items()))

    grouped_by = [*keys, *flags]
    counted = masked.groupingSets([[name] for name in grouped_by], *grouped_by).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_rows")
    )
    # grouping_id() has a bit for every column, leftmost first, that is cleared in the column's own set.
    width = len(grouped_by)
    in_set = {
        name: f"_set = {(1 << width) - 1 - (1 << (width - 1 - position))}"
        for position, name in enumerate(grouped_by)
    }

    def summed(value: str, where: str, name: str) -> str:
        return f"coalesce(sum(CASE WHEN {where} THEN {value} END), 0L) AS {quoted(name)}"

    return counted.selectExpr(
        summed("_rows", in_set[grouped_by[-1]], "total"),
        *(
            summed("_rows", f"{in_set[mask]} AND ({mask} & {bit}) != 0", name)
            for name, (mask, bit) in zip(conditions, bits, strict=True)
        ),
        *(summed("_rows - 1", in_set[key], name) for name, key in zip(unique, keys, strict=True)),
    )


# ---------------------------------------------------------------------------------------------------
# Report


@dataclass(frozen=True)
class _Entry:
    """A check with its place in the rules: all of a report line but the numbers."""

    rule_no: int
    rule: str | None
    rule_type: str | None
    check: Check

    def as_json(self) -> dict[str, Any]:
        check = self.check
        wording = None
        if check.details is not None:
            wording = _wording(check.details, column=check.column, **check.parts)
        return {
            "rule_no": self.rule_no,
            "rule": self.rule,
            "rule_type": self.rule_type,
            "column_name": check.column,
            "settled": check.status,
            "allowed_share": check.allowed_share,
            "wording": wording,
        }


_ENTRY_TYPE = (
    "array<struct<rule_no: int, rule: string, rule_type: string, column_name: string, settled: string, "
    "allowed_share: double, wording: array<string>>>"
)


def _wording(template: str, **parts: Any) -> list[str]:
    """The template filled in but for ``failed`` and ``share``: the text before, between and after."""
    texts = [""]
    for text, part, _, _ in Formatter().parse(template):
        texts[-1] += text
        if part in ("failed", "share"):
            texts.append("")
        elif part is not None:
            texts[-1] += str(parts[part])
    return texts


def _chunks(items: list, size: int | None) -> list[list]:
    size = size or max(1, len(items))
    return [items[i : i + size] for i in range(0, len(items), size)]


def build_report(
    df: DataFrame,
    rules: Iterable[Mapping[str, Any] | Rule],
    checks_per_scan: int | None = CHECKS_PER_SCAN,
    keys_per_scan: int = KEYS_PER_SCAN,
) -> DataFrame:
    """Lazy report, one row per rule and column: ``rule_no, rule, rule_type, column_name, status,
    failed, total, ratio, details``. A rule that does not fit its column's type is a failed line.

    One scan takes ``checks_per_scan`` row checks (all, unless given) and ``keys_per_scan`` unique columns; ``count_scans``
    tells how many there are. Lines of different scans see a source that changes meanwhile at different times.
    """
    return _joined(df, _parts(df, rules, checks_per_scan, keys_per_scan))


def _joined(df: DataFrame, parts) -> DataFrame:
    reports = [_lines(*part) for part in parts]
    if not reports:
        return _lines(df.sparkSession.range(0).selectExpr("cast(NULL AS bigint) AS total"), [])
    return reduce(DataFrame.unionByName, reports)


def count_scans(
    df: DataFrame,
    rules: Iterable[Mapping[str, Any] | Rule],
    checks_per_scan: int | None = CHECKS_PER_SCAN,
    keys_per_scan: int = KEYS_PER_SCAN,
) -> int:
    """Scans of the data that a report takes. Lines that need no data, such as missing columns, take none."""
    return _scans(_parts(df, rules, checks_per_scan, keys_per_scan))


def _scans(parts) -> int:
    return sum(any(name != "NULL" for name, _ in entries) for _, entries in parts)


def _parts(df, rules, checks_per_scan, keys_per_scan) -> list[tuple[DataFrame, list[tuple[str, _Entry]]]]:
    """Measured rows with the entries each one answers."""
    if (checks_per_scan is not None and checks_per_scan < 1) or keys_per_scan < 1:
        raise ValueError("a scan takes one check and one key at least")
    settled: list[_Entry] = []
    by_row: list[_Entry] = []
    by_key: dict[str, list[_Entry]] = {}
    asked = [
        (rule_no, rule, _fitting(df, check))
        for rule_no, rule in enumerate(map(parse_rule, rules), start=1)
        for check in rule.checks(df) or [Check(None, status="pass")]
    ]
    proved = _proved(df, [check for _, _, check in asked])
    for (rule_no, rule, _), check in zip(asked, proved, strict=True):
        entry = _Entry(rule_no, rule.name, _rule_type(rule), check)
        if check.settled:
            settled.append(entry)
        elif check.unique:
            by_key.setdefault(check.column, []).append(entry)
        else:
            by_row.append(entry)

    reports = []
    if settled:
        nothing = df.sparkSession.range(1).selectExpr("cast(NULL AS bigint) AS total")
        reports.append((nothing, [("NULL", entry) for entry in settled]))
    row_chunks, key_chunks = _chunks(by_row, checks_per_scan), _chunks(list(by_key), keys_per_scan)
    for row_entries, keys in zip_longest(row_chunks, key_chunks, fillvalue=[]):
        conditions = {f"row{i}": entry.check.failing for i, entry in enumerate(row_entries)}
        unique = {f"key{i}": column for i, column in enumerate(keys)}
        entries = list(zip(conditions, row_entries, strict=True))
        entries += [(name, entry) for name, column in unique.items() for entry in by_key[column]]
        reports.append((measure(df, conditions, unique), entries))
    return reports


def _lines(measured: DataFrame, entries: list[tuple[str, _Entry]]) -> DataFrame:
    """One line per entry from the one row of numbers; an entry comes with the name of its number.

    Shares are written by ``format_number``: it rounds the double itself, where ``format_string`` rounds its
    shortest decimal form and turns 1.005, which is below 1.005 as a double, into 1.01.
    """
    numbers = ", ".join(f"cast({name} AS bigint)" for name, _ in entries)
    known = F.from_json(F.lit(json.dumps([entry.as_json() for _, entry in entries])), _ENTRY_TYPE)
    return (
        measured.selectExpr("total", f"posexplode(array({numbers})) AS (position, failed)")
        .select("total", "failed", F.get(known, F.col("position")).alias("entry"))
        .selectExpr("*", "if(total > 0, failed / total, if(total = 0, 0D, NULL)) AS ratio")
        .selectExpr("*", "failed > 0 AND ratio > entry.allowed_share AS fails")
        .selectExpr(
            "entry.rule_no",
            "entry.rule",
            "entry.rule_type",
            "entry.column_name",
            "coalesce(entry.settled, if(fails, 'fail', 'pass')) AS status",
            "failed",
            "total",
            "ratio",
            """CASE WHEN entry.settled IS NOT NULL THEN entry.wording[0]
                    WHEN NOT fails THEN NULL
                    WHEN size(entry.wording) = 2 THEN concat(entry.wording[0], failed, entry.wording[1])
                    ELSE concat(entry.wording[0], failed, entry.wording[1],
                                format_number(ratio * 100, 2), '%', entry.wording[2])
               END AS details""",
        )
    )


def summarize(report: DataFrame) -> DataFrame:
    """One row of totals over a report; a rule fails if any of its lines does."""
    per_rule = report.groupBy("rule_no").agg(
        F.expr("bool_or(status = 'fail') AS failed"), F.expr("bool_or(status = 'skipped') AS skipped")
    )
    return per_rule.selectExpr(
        "NOT coalesce(bool_or(failed), false) AS passed",
        "count(1) AS total_rules",
        "count_if(NOT failed AND NOT skipped) AS passed_rules",
        "count_if(failed) AS failed_rules",
        "count_if(skipped) AS skipped_rules",
    )


@dataclass(frozen=True)
class Validation:
    """A collected report."""

    lines: list[Row]
    total_rules: int
    scans: int = 0

    @property
    def failures(self) -> list[dict[str, str]]:
        return [{"rule": r.rule, "details": r.details} for r in self.lines if r.status == "fail"]

    @property
    def passed(self) -> bool:
        return not self.failures

    @property
    def passed_rules(self) -> int:
        not_passed = {r.rule_no for r in self.lines if r.status != "pass"}
        return self.total_rules - len(not_passed)

    @property
    def rows(self) -> int | None:
        """Rows of the validated data, if any line was measured."""
        return next((r.total for r in self.lines if r.total is not None), None)

    def as_dict(self) -> dict[str, Any]:
        return {
            "passed": self.passed,
            "total_rules": self.total_rules,
            "passed_rules": self.passed_rules,
            "failures": self.failures,
        }


def validate(
    df: DataFrame,
    rules: Iterable[Mapping[str, Any] | Rule],
    checks_per_scan: int | None = CHECKS_PER_SCAN,
    keys_per_scan: int = KEYS_PER_SCAN,
) -> Validation:
    """Run the report, whatever the number of rules. Lines come in the order of rules and columns."""
    parsed = [parse_rule(rule) for rule in rules]
    parts = _parts(df, parsed, checks_per_scan, keys_per_scan) if parsed else []
    lines = _joined(df, parts).collect() if parsed else []
    place = {
        (rule_no, column): position
        for rule_no, rule in enumerate(parsed, start=1)
        for position, column in enumerate(getattr(rule, "columns", ()))
    }
    lines.sort(key=lambda line: (line.rule_no, place.get((line.rule_no, line.column_name), 0)))
    return Validation(lines, len(parsed), _scans(parts))


# ---------------------------------------------------------------------------------------------------
# Examples and profile


def duplicate_examples(df: DataFrame, column: str, n: int = fixed.EXAMPLE_ROWS) -> DataFrame:
    """The ``n`` most repeated values with their counts; equal counts are ordered by value, NULL last.

    Text, binary and nested values are counted by their digests, and equal counts are ordered by these; a second scan
    fetches the values of the ``n`` digests found, by a join with these few rows.
    """
    wide = is_wide(df.schema[column].dataType)
    keyed = df.select(col_named(column).alias("_value"), _key(df, column).alias("_key"))
    counts = keyed.groupBy("_key").agg(F.count(F.lit(1)).alias("_rows")).filter("_rows > 1")
    found = counts.orderBy(F.desc("_rows"), F.col("_key").asc_nulls_last()).limit(n)
    if wide:
        few = F.broadcast(found.withColumnRenamed("_key", "_found"))  # n rows
        fetched = keyed.join(few, F.col("_key").eqNullSafe(F.col("_found"))).groupBy("_key", "_rows")
        found = fetched.agg(F.any_value("_value").alias("_value")).orderBy(F.desc("_rows"), F.col("_key").asc_nulls_last())
        return found.select(F.col("_value").alias(column), F.col("_rows").alias(count_name(column)))
    return found.select(F.col("_key").alias(column), F.col("_rows").alias(count_name(column)))


def not_matching_examples(
    df: DataFrame, column: str, pattern: str, n: int = fixed.EXAMPLE_ROWS
) -> DataFrame:
    """The ``n`` smallest values that do not match the pattern."""
    offending = df.filter(not_matching(column, pattern)).select(col_named(column).alias(column))
    return offending.orderBy(col_named(column)).limit(n)


@dataclass(frozen=True)
class Wanted:
    """Examples to be found: of repeated values, or of values that do not match ``pattern``. ``failed`` is the number of these, if known."""

    rule_no: int
    column: str
    pattern: str | None = None
    failed: int | None = None


def example_lines(df: DataFrame, wanted: Iterable[Wanted], n: int = fixed.EXAMPLE_ROWS, shared: int = _SHARED_EXAMPLES) -> DataFrame:
    """The examples of many rules from one scan: ``rule_no, column_name, place, value, number``.

    Values are the same as those of ``duplicate_examples`` and ``not_matching_examples``, as text; ``number`` is NULL for the latter.
    All are counted by grouping sets, so that what is shuffled are distinct keys and distinct offending values, and a window
    keeps the ``n`` first of each set in every task already. Two cases take further scans: texts and nested values that
    repeat are fetched for the digests found, all in one scan; and a pattern with more than ``shared`` offending values
    is a top-n of its own, which shuffles ``n`` values a task.
    """
    wanted = list(wanted)
    alone = [w for w in wanted if w.pattern is not None and (w.failed or 0) > shared]
    together = [w for w in wanted if w not in alone]
    frames = [_shared_lines(df, together, n)] if together else []
    for w in alone:
        found = not_matching_examples(df, w.column, w.pattern, n).select(col_named(w.column).alias("_value"))
        order = Window.partitionBy(F.lit(0)).orderBy("_value")  # n rows
        frames.append(found.select(_line_of(w), F.row_number().over(order).alias("place"), F.col("_value").cast("string").alias("value"), F.lit(None).cast("long").alias("number")).select("w.*", "place", "value", "number"))
    if not frames:
        return df.sparkSession.createDataFrame([], "rule_no int, column_name string, place int, value string, number long")
    return reduce(DataFrame.unionByName, frames)


def _line_of(w: Wanted) -> Column:
    return F.struct(F.lit(w.rule_no).alias("rule_no"), F.lit(w.column).alias("column_name")).alias("w")


def _shared_lines(df: DataFrame, wanted: list[Wanted], n: int) -> DataFrame:
    def offending(w: Wanted) -> Column:
        value = col_named(w.column)
        if is_nested(df.schema[w.column].dataType):
            value = value.cast("string")
        return F.when(not_matching(w.column, w.pattern), value)

    keys = [f"_key{i}" for i in range(len(wanted))]
    cells = [_key(df, w.column) if w.pattern is None else offending(w) for w in wanted]
    keyed = df.select(*(cell.alias(key) for cell, key in zip(cells, keys, strict=True)))
    counted = keyed.groupingSets([[key] for key in keys], *keys).agg(
        *(F.grouping(key).alias(f"_off{i}") for i, key in enumerate(keys)), F.count(F.lit(1)).alias("_rows")
    )
    own = [F.col(f"_off{i}") == 0 for i in range(len(keys))]
    repeated = [own[i] & (F.col("_rows") > 1) for i, w in enumerate(wanted) if w.pattern is None]
    bad = [own[i] & F.col(keys[i]).isNotNull() for i, w in enumerate(wanted) if w.pattern is not None]
    sets = F.coalesce(*(F.when(own[i], F.lit(i)) for i in range(len(keys))))
    most = F.when(reduce(Column.__or__, repeated, F.lit(False)), -F.col("_rows")).otherwise(F.lit(0))
    kept = counted.filter(reduce(Column.__or__, repeated + bad)).select(sets.alias("_set"), most.alias("_most"), "_rows", *keys)
    order = ["_most", *(F.col(key).asc_nulls_last() for key in keys)]
    first = kept.withColumn("place", F.row_number().over(Window.partitionBy("_set").orderBy(*order))).filter(F.col("place") <= n)
    # an offending value counts as often as it occurs; these are n rows a set
    copies = F.when(F.col("_most") < 0, F.lit(1)).otherwise(F.least("_rows", F.lit(n)))
    each = first.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
    each = each.withColumn("place", F.row_number().over(Window.partitionBy("_set").orderBy("place", "_copy"))).filter(F.col("place") <= n)

    lines = F.array(*(_line_of(w) for w in wanted))
    number = F.when(F.col("_most") < 0, F.col("_rows")).alias("number")
    wide = [i for i, w in enumerate(wanted) if w.pattern is None and is_wide(df.schema[w.column].dataType)]
    plain = [i for i in range(len(wanted)) if i not in wide]
    value = F.coalesce(*(F.when(F.col("_set") == i, F.col(keys[i]).cast("string")) for i in plain), F.lit(None).cast("string"))
    digests = F.coalesce(*(F.when(F.col("_set") == i, F.col(keys[i])) for i in wide), F.lit(None).cast("binary"))
    found = each.select("_set", F.get(lines, F.col("_set")).alias("w"), "place", value.alias("value"), digests.alias("_digest"), number)
    if wide:
        cells = [F.struct(F.lit(i).alias("_of"), _key(df, wanted[i].column).alias("_is"), col_named(wanted[i].column).cast("string").alias("_text")) for i in wide]
        few = F.broadcast(found.select(F.col("_set").alias("_in"), F.col("_digest").alias("_for")))  # n rows a set
        texts = df.select(F.inline(F.array(*cells))).join(few, (F.col("_of") == F.col("_in")) & (F.col("_is") == F.col("_for")))
        texts = texts.groupBy("_in", "_for").agg(F.any_value("_text").alias("_text"))
        found = found.join(F.broadcast(texts), (F.col("_set") == F.col("_in")) & (F.col("_digest") == F.col("_for")), "left")
        found = found.withColumn("value", F.coalesce("_text", "value"))
    return found.select("w.*", "place", "value", "number")


def profile(
    df: DataFrame,
    required: Iterable[str],
    id_column: str,
    date_column: str,
    date_pattern: str = fixed.ISO_DATE_PATTERN,
) -> DataFrame:
    """One row: ``null_<column>`` per required column, ``duplicate_ids`` and ``invalid_dates``."""
    conditions = {f"null_{c}": col_named(c).isNull() for c in required}
    conditions["invalid_dates"] = not_matching(date_column, date_pattern)
    return measure(df, conditions, {"duplicate_ids": id_column}).drop("total")

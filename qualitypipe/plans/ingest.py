"""The configured run: read, validate, gate, transform, write, count.

Two passes over the source do all of it: one for the whole quality report, one for the write. (Schema
inference, if asked for, is a third, and so are bad rows that are kept apart.) Everything is analysed before the first of
them, so a configuration that does not fit fails at once; a write that fails leaves the former output.
Analytics read the written output where its format keeps the rows exactly. For other formats one more pass over the source
counts all that is asked for into a small table beside the rows, from which every answer is read.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from qualitypipe import fixed_values as fixed
from qualitypipe.config import from_config
from qualitypipe.operators import analytics as an
from qualitypipe.operators import quality as dq
from qualitypipe.operators.steps import StepNote, apply_steps
from qualitypipe.sinks.files import FileSink, write_files
from qualitypipe.sources.csv import CsvSource, read_csv, split_bad_rows

_SCAN_LIMITS = ("checks_per_scan", "keys_per_scan")
# Formats whose files carry the schema, so that reading them back gives the written rows exactly.
_SELF_DESCRIBING = {"parquet", "orc"}
_FROM_SOURCE = "counted by one more scan of the source: this format does not keep the rows exactly"
# Counts of a run whose output does not keep types. Readers of the output skip names that start so.
_COUNTS_FOLDER = "_analytics"


class ValidationError(ValueError):
    """The gate was closed: strict validation and at least one failed rule."""

    def __init__(self, validation: dq.Validation):
        super().__init__(fixed.STRICT_FAILURE)
        self.validation = validation


@dataclass(frozen=True)
class TopN:
    column: str
    n: int = fixed.TOP_N


@dataclass(frozen=True)
class IngestConfig:
    """The configuration sections; all are optional but ``ingestion.input_path``."""

    ingestion: Mapping[str, Any] = field(default_factory=dict)
    quality_checks: Mapping[str, Any] = field(default_factory=dict)
    transformation: Mapping[str, Any] = field(default_factory=dict)
    output: Mapping[str, Any] = field(default_factory=dict)
    analytics: Mapping[str, Any] = field(default_factory=dict)
    strict_validation: bool = False


@dataclass(frozen=True)
class IngestResult:
    validation: dq.Validation
    notes: list[StepNote]
    rows_read: int
    rows_written: int
    rows_bad: int
    raw: DataFrame
    output: DataFrame
    analytics: dict[str, DataFrame]
    examples: dict[tuple[int, str], DataFrame]
    example_lines: DataFrame


def run_ingest(
    spark: SparkSession, config: Mapping[str, Any] | IngestConfig, on_error: str = "skip"
) -> IngestResult:
    """Run a configuration. The session is the caller's: its section ``spark`` is left alone."""
    if not isinstance(config, IngestConfig):
        config = from_config(IngestConfig, config, ignore=("spark",))
    source = from_config(CsvSource, config.ingestion)
    raw, bad = read_csv(spark, source), None
    if source.bad_rows_path:
        raw, bad = split_bad_rows(raw, source.bad_row)

    rules = [dq.parse_rule(rule) for rule in config.quality_checks.get("rules") or []]
    limits = {key: config.quality_checks[key] for key in _SCAN_LIMITS if config.quality_checks.get(key)}
    transformed = apply_steps(raw, config.transformation.get("transformations") or [], on_error)
    sink = from_config(FileSink, config.output)
    _check_names(transformed.frame)
    _check_paths(spark, raw, sink.path)
    if bad is not None:
        _check_paths(spark, raw, source.bad_rows_path)
        if _inside(spark, sink.path, source.bad_rows_path) or _inside(spark, source.bad_rows_path, sink.path):
            raise ValueError("bad_rows_path and the output path may not hold each other")
    _, analytics_notes = analyze(transformed.frame, config.analytics)

    validation = dq.validate(raw, rules, **limits)
    if config.strict_validation and not validation.passed:
        raise ValidationError(validation)
    rows_read = validation.rows if validation.rows is not None else dq.measure(raw).first().total
    wanted = failed_for_examples(rules, validation)
    examples, example_lines = failure_examples(raw, wanted), dq.example_lines(raw, wanted)

    rows_bad = 0 if bad is None else write_files(bad, source.bad_rows_path, "text")
    rows_written = write_files(transformed.frame, sink.path, sink.format)
    output = read_back(spark, transformed.frame, sink)
    analytics, _ = analyze(output, config.analytics)
    if analytics and output is transformed.frame:
        analytics = _analyze_once(spark, output, config.analytics, sink)
        analytics_notes.append(StepNote(None, "analytics", sink.format, _FROM_SOURCE))
    return IngestResult(
        validation=validation,
        notes=transformed.notes + analytics_notes,
        rows_read=rows_read,
        rows_written=rows_written,
        rows_bad=rows_bad,
        raw=raw,
        output=output,
        analytics=analytics,
        examples=examples,
        example_lines=example_lines,
    )


def _check_names(df: DataFrame) -> None:
    """Columns that the session takes for one cannot be written."""
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    names = df.columns if exact else [name.lower() for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"output columns of one name: {', '.join(repeated)}")


def _check_paths(spark: SparkSession, raw: DataFrame, output: str) -> None:
    """The write replaces its path, so it may not hold what is read."""
    target = _qualified(spark, output)
    if any(_plain(name) == target or _plain(name).startswith(f"{target}/") for name in raw.inputFiles()):
        raise ValueError(f"the output path {output} holds input files")


def _inside(spark: SparkSession, outer: str, inner: str) -> bool:
    return f"{_qualified(spark, inner)}/".startswith(f"{_qualified(spark, outer)}/")


def _qualified(spark: SparkSession, path: str) -> str:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return _plain(system.makeQualified(hadoop).toUri().toString())


def _plain(uri: str) -> str:
    return re.sub(r"^(\w+):/+", r"\1:/", uri).rstrip("/")


def read_back(spark: SparkSession, written: DataFrame, sink: FileSink) -> DataFrame:
    """The written rows; formats that would lose types or empty text keep the computed frame."""
    if sink.format.lower() in _SELF_DESCRIBING:
        return spark.read.format(sink.format).schema(written.schema).load(sink.path)
    return written


def _analyze_once(spark: SparkSession, df: DataFrame, config: Mapping[str, Any], sink: FileSink) -> dict[str, DataFrame]:
    """The answers of ``analyze`` from counts that one pass writes into a folder of the output."""
    groupings, top, _ = _asked(df, config)
    columns = list(dict.fromkeys([*groupings, *([top.column] if top else [])]))
    path = f"{sink.path.rstrip('/')}/{_COUNTS_FOLDER}"
    counted = an.counted_values(df, columns)
    write_files(counted, path, "parquet")
    counted = spark.read.schema(counted.schema).parquet(path)
    results = {}
    if groupings:
        results["group_counts"] = an.group_counts_of(counted, columns, groupings)
    if top:
        results["top_n"] = an.top_n_of(counted, columns, top.column, top.n)
    return results


def _asked(df: DataFrame, config: Mapping[str, Any]) -> tuple[list[str], TopN | None, list[str]]:
    """The columns to group by and the top-n to take, as far as there are such columns, and the missing ones."""
    groupings = config.get("groupby_columns") or []
    if isinstance(groupings, str):
        raise ValueError("groupby_columns must be a list of names")
    top = from_config(TopN, config["top_n"]) if config.get("top_n") else None
    asked = [*groupings, *([top.column] if top else [])]
    missing = [column for column in dict.fromkeys(asked) if column not in df.columns]
    return [c for c in groupings if c not in missing], top if top and top.column not in missing else None, missing


def analyze(df: DataFrame, config: Mapping[str, Any]) -> tuple[dict[str, DataFrame], list[StepNote]]:
    """``group_counts`` and ``top_n`` as configured, both lazy; columns that do not exist are noted."""
    groupings, top, missing = _asked(df, config)
    results = {}
    if groupings:
        results["group_counts"] = an.group_counts(df, groupings)
    if top:
        results["top_n"] = an.top_n(df, top.column, top.n)
    return results, [StepNote(None, "analytics", column, "column not found") for column in missing]


def failed_for_examples(rules: Iterable[dq.Rule], validation: dq.Validation) -> list[dq.Wanted]:
    """What examples are asked for: failed unique and pattern rules, by number of the rule and column."""
    failed = {
        (line.rule_no, line.column_name): line.failed
        for line in validation.lines
        if line.status == "fail" and line.total is not None
    }
    wanted = []
    for rule_no, rule in enumerate(rules, start=1):
        if isinstance(rule, dq.Unique):
            wanted += [dq.Wanted(rule_no, column) for column in dict.fromkeys(rule.columns) if (rule_no, column) in failed]
        elif isinstance(rule, dq.RegexMatch) and (rule_no, rule.column) in failed:
            wanted.append(dq.Wanted(rule_no, rule.column, rule.pattern, failed[rule_no, rule.column]))
    return wanted


def failure_examples(df: DataFrame, wanted: Iterable[dq.Wanted]) -> dict[tuple[int, str], DataFrame]:
    """Lazy examples of offending values, one frame each: for all in one scan, take ``example_lines``."""
    return {
        (w.rule_no, w.column): dq.duplicate_examples(df, w.column)
        if w.pattern is None
        else dq.not_matching_examples(df, w.column, w.pattern)
        for w in wanted
    }

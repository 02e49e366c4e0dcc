"""Declarative tabular ingestion on Spark: read, check, transform, write, count."""

from qualitypipe.operators.analytics import count_by, group_counts, top_n
from qualitypipe.operators.quality import (
    Wanted,
    build_report,
    duplicate_examples,
    example_lines,
    not_matching_examples,
    profile,
    summarize,
    validate,
)
from qualitypipe.operators.steps import StepError, apply_steps
from qualitypipe.plans.ingest import IngestResult, ValidationError, run_ingest
from qualitypipe.plans.stations import (
    read_stations,
    stations_config,
    stations_profile,
    transform_stations,
)
from qualitypipe.sinks.files import preview, write_files
from qualitypipe.sources.csv import read_csv, split_bad_rows

__all__ = [
    "IngestResult",
    "StepError",
    "ValidationError",
    "Wanted",
    "apply_steps",
    "build_report",
    "count_by",
    "duplicate_examples",
    "example_lines",
    "group_counts",
    "not_matching_examples",
    "preview",
    "profile",
    "read_csv",
    "read_stations",
    "run_ingest",
    "split_bad_rows",
    "stations_config",
    "stations_profile",
    "summarize",
    "top_n",
    "transform_stations",
    "validate",
    "write_files",
]

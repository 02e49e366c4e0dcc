"""The registered queries as a whole."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

from queries import QUERIES
from queries.registry import scratch

SF_DIR = Path("/root/testdata/sf0.001")
WRITING = ("src_", "sink_", "ingest_", "metric_")
#: A second scan fetches the few texts whose digests were found, by a join with that many rows.
FETCHING = ("dq_duplicate_texts", "dq_duplicate_examples", "dq_example_lines")
#: Semi-joins that the condition asks for.
JOINING = ("step_filter_subquery",)


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch(spark, "x"), scratch(spark, "x")
    assert one.startswith(f"{shared}/qualitypipe/x-")
    assert one != two


def test_core_queries_need_no_numpy():
    """What the training-data operators need may be missing: the others are registered all the same."""
    code = "import sys; sys.modules['numpy'] = None; import __spark_entry__ as e; print(*e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).resolve().parent.parent, capture_output=True, text=True, check=True)
    assert set(said.stdout.split()) == set(QUERIES)


@pytest.mark.skipif(not SF_DIR.exists(), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(WRITING) and n not in FETCHING + JOINING))
def test_plans_stay_in_the_jvm_and_join_nothing(spark, name):
    plan = QUERIES[name](spark, str(SF_DIR))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert "Cartesian" not in plan
    assert "Python" not in plan
    assert "Pandas" not in plan
    assert "BroadcastExchange" not in plan
    assert plan.count("FileScan") == 1

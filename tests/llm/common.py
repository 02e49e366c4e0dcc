"""Small inputs and plain recomputations for the tests of the training-data operators."""

from __future__ import annotations

import random
import re
from pathlib import Path

import pytest

SF = Path("/root/testdata/sf0.001")
SF_LARGER = Path("/root/testdata/sf0.01")
needs_tables = pytest.mark.skipif(not SF.exists(), reason="needs the given tables")

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that clash with what operators add or use inside.
CLASHING = ["score", "_text", "n", "id", "band", "words", "label", "_row", "_held", "_dropped", "_source", "_0"]


def words(text: str | None) -> list[str]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingles(text: str | None) -> set:
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def documents(spark, texts: dict[int | None, str | None] | list[tuple[int | None, str | None]]):
    rows = list(texts.items()) if isinstance(texts, dict) else texts
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 2}", len(t or "")) for i, t in rows], DOCS)


def clashing(frame):
    """The rows with more columns, named like those that operators add."""
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit("x") for c in CLASHING if c not in frame.columns})


def prose(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n)]

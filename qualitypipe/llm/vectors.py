"""Vectors of a table as matrices inside tasks: what the three vector operators share.

A vector takes part if it is neither null nor holds a null or non-finite component, and has the table's dimension: the
length that most vectors have, of equally frequent ones the longest. Vectors of another length can't be compared with
these, and take no part either, as if they were null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors that are worked on at a time.
ROWS = 4096


def dimension(frame: DataFrame, vector: str) -> int:
    """The length most vectors have; 0 if there is none with a component. One row reaches the driver."""
    sizes = frame.select(F.size(F.col(vector)).alias("d")).filter("d > 0").groupBy("d").count()
    most = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return most.d if most else 0


def usable(column: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """The rows whose vectors take part, and these as a matrix of doubles."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero((lengths == d) & (lengths > 0))
    flat = pc.fill_null(column.values.cast(pa.float64()), pa.scalar(float("nan"))).to_numpy(zero_copy_only=False)
    begin = column.offsets.to_numpy(zero_copy_only=False)[rows].astype(np.int64)
    found = flat[begin[:, None] + np.arange(d)]
    finite = np.isfinite(found).all(axis=1)
    return rows[finite], found[finite]


def matrices(batches, d: int, column: str = "vector") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of the rows that take part, ``ROWS`` at most, each with its matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            rows, found = usable(part.column(column), d)
            if len(rows):
                yield part.take(pa.array(rows)), found

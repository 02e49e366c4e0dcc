"""Whitening of vectors from exact integer covariances, counted on bit planes.

Components become integers x = floor(64 * c) + 1000000. The covariance is that of the fit list, each distinct x vector once. Distinct vectors
are found by one shuffle of narrow keys (a byte a component for vectors of length one), counted in each task first. A task then
subtracts the least value of each component in a block of vectors, cuts the rest into bit planes and packs each plane across rows into
64-bit words. The sum over rows of a product of two components is the weighted sum of popcounts of the planes' ANDs; shifts are undone in
integers. Tasks send these sums, not vectors; n, sums and the n * sum(x y) - sum(x) sum(y) are exact integers, and
only their quotient with n * n becomes a double, before the eigenvectors are computed (dimension x dimension numbers, in the driver).

Defined results: rows without a usable vector (see ``vectors``) are dropped; an empty table gives no rows. Repeated rows
count once in the fit and each get their rows. Components without variance (of a table with one vector, say) are whitened to null and
explain 0, or null if nothing varies; ``identity_error`` is over the others. ``deviation`` is null where it exceeds a long.
Scaled components beyond +-2**40 are set to that bound. Only the two named columns are read, so others may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe.llm.vectors import dimension, matrices

SCALE, OFFSET, LARGEST = 64, 1_000_000, 1 << 40
WIDTHS = [np.int8, np.int16, np.int32, np.int64]
#: Vectors whose bit planes are counted at a time.
BLOCK = 8192


def integers(found: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(found * SCALE), -LARGEST, LARGEST).astype(np.int64) + OFFSET


def packed(x: np.ndarray) -> list[bytes]:
    """Each vector in the narrowest integers that hold it without the offset; equal vectors have equal bytes."""
    plain = x - OFFSET
    reach = np.maximum(plain.max(axis=1), -1 - plain.min(axis=1))
    width = np.searchsorted([(1 << 7) - 1, (1 << 15) - 1, (1 << 31) - 1], reach)
    out: list[bytes] = [b""] * len(x)
    for w, kind in enumerate(WIDTHS):
        rows = np.flatnonzero(width == w)
        for i, row in zip(rows, plain[rows].astype(kind), strict=True):
            out[i] = row.tobytes()
    return out


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    """The vectors again; their width follows from their length."""
    values = column.to_pylist()
    lengths = np.array([len(v) for v in values])
    out = np.empty((len(values), d), dtype=np.int64)
    for kind in WIDTHS:
        rows = np.flatnonzero(lengths == d * np.dtype(kind).itemsize)
        if len(rows):
            out[rows] = np.frombuffer(b"".join(values[i] for i in rows), dtype=kind).reshape(len(rows), d)
    return out + OFFSET


def planes(y: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of numbers from 0 on, (components, bits, words): bit b of all rows of a component packed into 64-bit words."""
    rows, d = y.shape
    out = np.zeros((d, bits, (rows + 63) // 64 * 8), dtype=np.uint8)
    for b in range(bits):
        out[:, b, : (rows + 7) // 8] = np.packbits(((y >> b) & 1).astype(bool).T, axis=1)
    return out.view(np.uint64)


def scatter(y: np.ndarray) -> np.ndarray:
    """Exact sums over rows of all products of two components of numbers from 0 on, as Python integers above the diagonal."""
    d, bits = y.shape[1], max(1, int(y.max(initial=0)).bit_length())
    sliced = planes(y, bits)
    kind = np.int64 if 2 * bits + len(y).bit_length() < 63 else object
    weight = np.array([1 << b for b in range(bits)], dtype=kind)
    out = np.zeros((d, d), dtype=object)
    for i in range(d):
        both = np.stack([np.bitwise_count(sliced[i:] & sliced[i, a]).sum(axis=2, dtype=np.int64) for a in range(bits)])
        out[i, i:] = np.einsum("ajb,a,b->j", both.astype(kind), weight, weight) if kind is np.int64 else (
            (both.astype(object) * weight[:, None, None]).sum(axis=0) * weight
        ).sum(axis=1)
    return out


@dataclass(frozen=True)
class Moments:
    """Exact numbers of the fit list: rows, sums, and n * sum(x y) - sum(x) sum(y) (n squared times the covariance)."""

    n: int
    sums: list[int]
    centred: np.ndarray

    def covariance(self) -> np.ndarray:
        """Each entry the double next to the exact one."""
        return np.array([[c / (self.n * self.n) for c in row] for row in self.centred], dtype=np.float64).reshape(self.centred.shape)


def moments(vectors: DataFrame, d: int) -> Moments:
    """Those of the distinct integer vectors; dimension x dimension numbers reach the driver."""

    def keys(batches):
        for _, found in matrices(batches, d):
            yield pa.RecordBatch.from_arrays([pa.array(packed(integers(found)), pa.binary())], names=["packed"])

    def sums(batches):
        n, total, products = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                x = unpacked(batch.column("packed").slice(at, BLOCK), d)
                low = x.min(axis=0)
                y = x - low
                shift, own = low.astype(object), y.sum(axis=0).astype(object)
                n, total = n + len(x), total + own + len(x) * shift
                # (y + s)(y + s)' from yy', which has the planes' counts
                cross = np.outer(shift, own) + np.outer(own, shift) + len(x) * np.outer(shift, shift)
                products += scatter(y) + np.triu(cross)
        if n:
            i, j = np.triu_indices(d)
            values = [n, *total, *products[i, j]]
            columns = [np.concatenate([[-1], np.full(d, -1), i]), np.concatenate([[-1], np.arange(d), j])]
            numbers = pa.array([int(v) for v in values], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int32()) for c in columns), numbers], names=["i", "j", "total"])

    distinct = vectors.select("vector").mapInArrow(keys, "packed binary").distinct()
    added = distinct.mapInArrow(sums, "i int, j int, total decimal(38, 0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    n, total, products = 0, [0] * d, np.zeros((d, d), dtype=object)
    for r in added.collect():
        if r.i >= 0:
            products[r.i, r.j] = products[r.j, r.i] = int(r.total)
        elif r.j >= 0:
            total[r.j] = int(r.total)
        else:
            n = int(r.total)
    return Moments(n, total, n * products - np.outer(np.array(total, dtype=object), np.array(total, dtype=object)))


def components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvectors as columns, by falling eigenvalue, the eigenvalues, and which of them are more than rounding."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:most]
    varies = values[order] > len(covariance) * np.finfo(float).eps * max(values.max(initial=0), 0)
    return vectors[:, order], values[order], varies


def deviations(v: np.ndarray) -> pa.Array:
    """Exact sums of squares; null beyond a long."""
    if int(np.abs(v).max(initial=0)) ** 2 * v.shape[1] < 1 << 63:
        return pa.array((v * v).sum(axis=1), pa.int64())
    exact = (v.astype(object) ** 2).sum(axis=1)
    return pa.array([s if s < 1 << 63 else None for s in exact], pa.int64())


def whiten(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", most: int = 16) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error), ``most`` components of every row with a usable vector."""
    vectors = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    d = dimension(vectors, "vector")
    fitted = moments(vectors, d)
    numbers = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    schema = T.StructType([vectors.schema["id"], *T.StructType.fromDDL(numbers)])
    if not fitted.n:
        return vectors.sparkSession.createDataFrame([], schema).withColumnRenamed("id", key)
    covariance = fitted.covariance()
    axes, values, varies = components(covariance, most)
    scaled = np.where(varies, axes / np.sqrt(np.where(varies, values, 1.0)), 0.0)
    # the whitened values are linear in x, so their covariance follows from that of x
    apart = scaled.T @ covariance @ scaled - np.diag(varies.astype(float))
    error = float(np.abs(apart).max(initial=0.0))
    trace = float(np.trace(covariance))
    explained = [float(e) / trace if v else 0.0 for e, v in zip(values, varies, strict=True)] if trace > 0 else [None] * len(values)
    n, sums = fitted.n, np.array(fitted.sums, dtype=object)
    reach = int(np.abs(sums).max(initial=0))

    def project(batches):
        k = len(values)
        for batch, found in matrices(batches, d):
            x = integers(found)
            # n * x leaves 64 bits only for very large components or tables
            fits = n * int(np.abs(x).max()) + reach < 1 << 62
            v = x * n - sums.astype(np.int64) if fits else x.astype(object) * n - sums
            white = (v / n).astype(np.float64) @ scaled
            no = np.tile(np.arange(k), len(x))
            at = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column("id").take(at),
                pa.array(no + 1, pa.int32()),
                pa.array(np.full(len(no), n), pa.int64()),
                deviations(v).take(at),
                pa.array(white.ravel(), pa.float64(), mask=~varies[no]),
                pa.array(explained, pa.float64()).take(pa.array(no)),
                pa.array(np.full(len(no), error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return vectors.mapInArrow(project, schema).withColumnRenamed("id", key)

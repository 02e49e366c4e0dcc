"""Product-quantisation codes of vectors, with nearest entries searched through memoised grid cells.

Components become integers floor(1024 * x); a vector is cut into ``PARTS`` consecutive parts (of equal length; if the dimension
is no multiple, the first ones have one component more). Each part position has a codebook, which starts as that part of the first 256
vectors and is fitted by ``rounds`` of nearest-entry assignment and replacement by floored means, over all vectors, in
integers. Each round is one scan: tasks send the counts and sums of their entries (at most entries x dimension rows), never vectors.

The nearest entry of a part is found through the grid cell it lies in, ``CELL`` integers wide in each component. For the box
of a cell, the smallest and largest squared distance to every entry are sums of per-component values. An entry whose smallest
distance exceeds the least of the largest ones is dominated all over the box. The other entries of the cell are kept in a cache, and only they
are evaluated, exactly, for each part in that cell. The cache is emptied when ``CELLS`` are known, so it takes 4 MB a part; that changes no result.

Defined results: rows without a usable vector (see ``vectors``) are dropped; an empty table gives no rows. The first 256 vectors
are those of the smallest ids, of equal ids the smaller vector, null ids last; with fewer vectors the codebooks are smaller. Repeated
rows each count and each get a row. Ties go to the lower index. Integers beyond +-2**27 (components beyond 131,072) are set to that bound, so that sums
fit a long. Only the three named columns are read, so others may have any name.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe.llm.shared import written
from qualitypipe.llm.vectors import dimension, matrices

PARTS, ENTRIES, SCALE = 4, 256, 1024
LARGEST = 1 << 27
#: Width of a grid cell is 2**CELL_BITS; cells that a task remembers for each part.
CELL_BITS, CELLS = 5, 16_384
#: Pairs of a part and an entry that are evaluated at a time.
PAIRS = 1 << 17
#: Labels up to which their errors are sent to all tasks.
FEW_LABELS = 1_000_000


def integers(found: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(found * SCALE), -LARGEST, LARGEST).astype(np.int64)


def bounds(d: int) -> list[tuple[int, int]]:
    """First and last+1 component of each part."""
    wide = [d // PARTS + (p < d % PARTS) for p in range(PARTS)]
    return [(sum(wide[:p]), sum(wide[: p + 1])) for p in range(PARTS)]


class Cells:
    """Nearest entries of one codebook, through remembered grid cells."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.known: dict[bytes, int] = {}
        self.kept = np.zeros((0, len(entries)), dtype=bool)
        self.evaluated = 0

    def candidates(self, cells: np.ndarray) -> np.ndarray:
        """For each cell, the entries that are nearest for some point of its box, and perhaps a few more."""
        low, high = cells << CELL_BITS, (cells << CELL_BITS) + ((1 << CELL_BITS) - 1)
        spread = max(int(np.abs(low).max(initial=0)), int(np.abs(high).max(initial=0))) + int(np.abs(self.entries).max(initial=0))
        kind = np.int32 if spread * spread * max(cells.shape[1], 1) < 1 << 31 else np.int64
        tables = []
        for t in range(cells.shape[1]):
            # the few intervals of a component, each against all entries
            _, first, at = np.unique(cells[:, t], return_index=True, return_inverse=True)
            under = self.entries[:, t] - low[first, t][:, None]
            over = high[first, t][:, None] - self.entries[:, t]
            gap = np.maximum(np.maximum(-under, -over), 0)
            far = np.maximum(under, over)
            tables.append((at, (gap * gap).astype(kind), (far * far).astype(kind)))
        kept = np.empty((len(cells), len(self.entries)), dtype=bool)
        for a in range(0, len(cells), 256):  # sums that stay in the processor's cache
            chunk = slice(a, a + 256)
            least = np.zeros(kept[chunk].shape, dtype=kind)
            most = np.zeros_like(least)
            for at, gaps, fars in tables:
                least += gaps.take(at[chunk], axis=0)
                most += fars.take(at[chunk], axis=0)
            kept[chunk] = least <= most.min(axis=1, keepdims=True)
        return kept

    def places(self, points: np.ndarray) -> np.ndarray:
        """The row of ``kept`` for each point's cell; cells not known yet are added."""
        cells = points >> CELL_BITS
        if len(self.known) + len(points) > max(CELLS, len(points)):
            self.known.clear()
        at, fresh = np.empty(len(points), dtype=np.int64), []
        for i, cell in enumerate(cells):
            key = cell.tobytes()
            found = self.known.get(key)
            if found is None:
                found = self.known[key] = len(self.known)
                fresh.append(i)
            at[i] = found
        if fresh:
            if len(self.known) > len(self.kept):
                grown = np.zeros((max(2 * len(self.kept), len(self.known)), len(self.entries)), dtype=bool)
                grown[: len(self.kept)] = self.kept
                self.kept = grown
            self.kept[at[fresh]] = self.candidates(cells[fresh])
        return at

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of each point's nearest entry."""
        at = self.places(points)
        index, error = np.empty(len(points), dtype=np.int64), np.empty(len(points), dtype=np.int64)
        step = max(1, PAIRS // len(self.entries))
        for a in range(0, len(points), step):
            point, entry = np.nonzero(self.kept[at[a : a + step]])
            difference = points[a + point] - self.entries[entry]
            distance = np.einsum("ij,ij->i", difference, difference)
            self.evaluated += len(point)
            # pairs come point by point, entries ascending: the first of the smallest is the one
            first = np.searchsorted(point, np.arange(point[-1] + 1))
            best = np.minimum.reduceat(distance, first)
            hits = np.flatnonzero(distance == best[point])
            own, where = np.unique(point[hits], return_index=True)
            index[a + own], error[a + own] = entry[hits[where]], best[own]
        return index, error


def _first(vectors: DataFrame, d: int) -> list[np.ndarray]:
    """The codebooks to start from: parts of the first vectors. At most 256 rows reach the driver."""

    def whole(batches):
        for batch, found in matrices(batches, d):
            rows = pa.array(list(integers(found)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), rows], names=["id", "x"])

    schema = T.StructType([vectors.schema["id"], T.StructField("x", T.ArrayType(T.LongType()))])
    rows = vectors.select("id", "vector").mapInArrow(whole, schema)
    start = rows.orderBy(F.col("id").asc_nulls_last(), "x").limit(ENTRIES).collect()
    whole_rows = np.array([r.x for r in start], dtype=np.int64).reshape(len(start), d)
    return [whole_rows[:, a:b] for a, b in bounds(d)]


def _refined(vectors: DataFrame, d: int, books: list[np.ndarray]) -> list[np.ndarray]:
    """Every entry replaced by the floored mean of the parts nearest to it. At most entries x dimension rows reach the driver."""

    def sums(batches):
        cells = [Cells(book) for book in books]
        totals = [np.zeros(book.shape, dtype=np.int64) for book in books]
        counts = [np.zeros(len(book), dtype=np.int64) for book in books]
        for _, found in matrices(batches, d):
            x = integers(found)
            for p, (a, b) in enumerate(bounds(d)):
                index, _ = cells[p].nearest(x[:, a:b])
                counts[p] += np.bincount(index, minlength=len(books[p]))
                for t in range(a, b):  # doubles hold these sums exactly: ROWS * 2**27 is below 2**53
                    totals[p][:, t - a] += np.bincount(index, x[:, t], len(books[p])).astype(np.int64)
        for p, book in enumerate(books):
            entry, position = (i.ravel() for i in np.indices(book.shape))
            used = counts[p][entry] > 0
            columns = [np.full(used.sum(), p), entry[used], position[used], totals[p].ravel()[used], counts[p][entry][used]]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "position", "total", "number"])

    schema = "part long, entry long, position long, total long, number long"
    added = vectors.select("vector").mapInArrow(sums, schema).groupBy("part", "entry", "position")
    books = [book.copy() for book in books]
    for r in added.agg(F.sum("total").alias("total"), F.sum("number").alias("number")).collect():
        books[r.part][r.entry, r.position] = r.total // r.number
    return books


def fit(vectors: DataFrame, d: int, rounds: int) -> list[np.ndarray]:
    """The codebooks, one for each part."""
    books = _first(vectors, d)
    for _ in range(rounds if len(books[0]) else 0):
        books = _refined(vectors, d, books)
    return books


def digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for book in books for x in book.ravel().tolist())
    return hashlib.sha256(numbers.encode()).hexdigest()


def encode(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = 4) -> DataFrame:
    """(key, code, error, label_error, codebooks_sha256) of every row with a usable vector."""
    vectors = rows.select(F.col(key).alias("id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    d = dimension(vectors, "vector")
    books = fit(vectors, d, rounds)

    def codes(batches):
        cells = [Cells(book) for book in books]
        for batch, found in matrices(batches, d):
            x = integers(found)
            found = [cells[p].nearest(x[:, a:b]) for p, (a, b) in enumerate(bounds(d))]
            index = np.stack([i for i, _ in found], axis=1).astype(np.uint8)
            text = [row.tobytes().hex() for row in index]
            columns = [batch.column("id"), batch.column("label"), pa.array(text), pa.array(sum(e for _, e in found), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])

    schema = T.StructType([vectors.schema["id"], vectors.schema["label"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    coded = written(vectors.mapInArrow(codes, schema), "codes")
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("rows"))
    by_label = written(by_label.select(F.col("label").alias("_label"), "label_error", "rows"), "label-errors")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if by_label.limit(FEW_LABELS + 1).count() <= FEW_LABELS:
        joined = coded.join(F.broadcast(by_label), same)
    else:
        # labels with a ten-thousandth of all rows are 10,000 at most and go to all tasks, so the shuffle has no hot key
        total = by_label.agg(F.sum("rows")).first()[0]
        hot = by_label.filter(F.col("rows") * 10_000 >= total)
        rare = coded.join(F.broadcast(hot), same, "left_anti").join(by_label, same)
        joined = coded.join(F.broadcast(hot), same).unionByName(rare)
    return joined.select(F.col("id").alias(key), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))

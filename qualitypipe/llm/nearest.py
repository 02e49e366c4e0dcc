"""Nearest neighbours through randomly rotated one-bit codes.

A vector, less the mean of all, is padded to ``bits`` components, rotated by a random orthogonal matrix and kept as the signs of what
comes out, packed into 64-bit words, with two numbers: its length, and the inner product of its direction with that of its
code. A query is rotated alike and rounded to 4 bits a component, so that its inner product with a code is a weighted sum
of popcounts of ANDs. That gives an estimate of the distance, and from the second number a bound on the estimate's error. A
vector whose distance less ``DEVIATIONS`` error bounds is above the k-th smallest distance known is left out; all others are
reranked by their exact distance in double precision.

Work is spread by candidates: the coded table is scanned once for every ``QUERY_BYTES`` of queries, which all tasks get; so what is sent
never grows, only the number of scans does. Each task keeps its k nearest of each query (ids and distances only), and these
are merged by one ranking for each query. Codes and vectors are a written table, so a lost executor costs its tasks.

Defined results: vectors that are null, zero, of another dimension or hold null or non-finite components take no part (see
``vectors``); an empty table gives no rows. Every row is a vector of its own: copies of a query's row are its neighbours at
distance 0, the row itself isn't. Rows whose id is null are candidates, not queries, and last of equal distances. Queries that share
an id get their ranks each. Other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe.llm.shared import written
from qualitypipe.llm.vectors import dimension, matrices

#: A code has this many bits for each component, rounded up to whole words: longer codes have smaller errors.
BITS_PER_COMPONENT = 4
#: How many error bounds a vector must be too far away to be left out.
DEVIATIONS = 2.5
#: Queries that all tasks hold at a time, as doubles.
QUERY_BYTES = 32 << 20
#: Bits of a rounded query component; queries and candidates compared at a time.
QUERY_BITS, QUERIES, CANDIDATES = 4, 16, 4096


def rotation(d: int, seed: int = 7) -> np.ndarray:
    """The first d rows of a random orthogonal matrix: what rotates vectors padded with zeros."""
    bits = -(-d * BITS_PER_COMPONENT // 64) * 64
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:d]


def coded(centred: np.ndarray, rotate: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sign bits in words, lengths, and inner products of each direction with its code's."""
    length = np.linalg.norm(centred, axis=1)
    turned = centred @ rotate
    signs = turned >= 0
    along = np.abs(turned).sum(axis=1) / np.sqrt(rotate.shape[1])
    return np.packbits(signs, axis=1).view(np.uint64), length, np.divide(along, length, out=np.ones_like(length), where=length > 0)


def prepared(ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, mean: np.ndarray, rotate: np.ndarray) -> dict[str, np.ndarray]:
    """Queries as all tasks need them: vectors, and their rotated directions rounded to a few bits, in bit planes."""
    centred = vectors - mean
    length = np.linalg.norm(centred, axis=1)
    turned = (centred @ rotate) / np.maximum(length, np.finfo(float).tiny)[:, None]
    low = turned.min(axis=1, initial=0)
    step = np.maximum(turned.max(axis=1, initial=0) - low, 1e-12) / ((1 << QUERY_BITS) - 1)
    levels = np.rint((turned - low[:, None]) / step[:, None]).astype(np.uint8)
    planes = np.stack([np.packbits((levels >> b) & 1, axis=1).view(np.uint64) for b in range(QUERY_BITS)], axis=1)
    total = levels.sum(axis=1, dtype=np.int64)
    return {"ids": ids, "rows": rows, "vectors": vectors, "length": length, "low": low, "step": step, "total": total, "planes": planes}


def estimates(queries: dict[str, np.ndarray], codes: np.ndarray, ones: np.ndarray, length: np.ndarray, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Estimated squared distances of queries and codes, and the bounds on their errors."""
    planes, bits = queries["planes"], codes.shape[1] * 64
    hits = np.zeros((len(planes), len(codes)), dtype=np.int32)
    for b in range(QUERY_BITS):
        for w in range(codes.shape[1]):
            hits += np.bitwise_count(codes[:, w] & planes[:, b, w][:, None]).astype(np.int32) << b
    low, step, total, own = (queries[c][:, None] for c in ("low", "step", "total", "length"))
    inner = (2 * step * hits + 2 * low * ones - step * total - low * bits) / np.sqrt(bits)
    both = 2 * own * length
    distance = length * length + own * own - both * (inner / along)
    # the code's part of the error, and the rounding of the query's components
    spread = np.sqrt(np.maximum(1 / (along * along) - 1, 0) / (bits - 1)) + step / np.sqrt(12) / along
    return distance, both * spread * DEVIATIONS


def search(batches, queries: dict[str, np.ndarray], k: int):
    """(query, at, score, id) of the k nearest of these candidates, for every query."""
    n, own = len(queries["rows"]), queries["rows"]
    score = np.full((n, k), np.inf)
    at = np.full((n, k), -1, dtype=np.int64)
    ids = np.full((n, k), None, dtype=object)
    asked = queries["vectors"]
    d = asked.shape[1]
    for batch in batches:
        for start in range(0, batch.num_rows, CANDIDATES):
            part = batch.slice(start, CANDIDATES)
            row = part.column("row").to_numpy(zero_copy_only=False)
            key = np.array(part.column("id").to_pylist(), dtype=object)
            vector = np.frombuffer(b"".join(part.column("vector").to_pylist())).reshape(len(row), d)
            codes = np.frombuffer(b"".join(part.column("code").to_pylist()), dtype=np.uint64).reshape(len(row), -1)
            length, along = (part.column(c).to_numpy(zero_copy_only=False) for c in ("length", "along"))
            ones = np.bitwise_count(codes).sum(axis=1, dtype=np.int64)
            for a in range(0, n, QUERIES):
                some = {name: values[a : a + QUERIES] for name, values in queries.items()}
                distance, error = estimates(some, codes, ones, length, along)
                least = distance - error
                for q in range(a, min(a + QUERIES, n)):
                    # k + 1, because the query's own row may be among these
                    limit = score[q, -1] ** 2
                    if len(row) > k:
                        limit = min(limit, np.partition(distance[q - a] + error[q - a], k)[k])
                    near = np.flatnonzero((least[q - a] <= limit * (1 + 1e-9)) & (row != own[q]))
                    if not len(near):
                        continue
                    # squares are added from the first component to the last, so that the result is the same everywhere
                    exact = np.sqrt(np.cumsum((vector[near] - asked[q]) ** 2, axis=1)[:, -1])
                    near, exact = near[exact <= score[q, -1]], exact[exact <= score[q, -1]]
                    if not len(near):
                        continue
                    s, r, i = np.append(score[q], exact), np.append(at[q], row[near]), np.append(ids[q], key[near])
                    unknown = np.array([x is None for x in i])
                    order = np.lexsort((r, np.where(unknown, 0, i).astype(np.int64), unknown, s))[:k]
                    score[q], at[q], ids[q] = s[order], r[order], i[order]
    q, j = np.nonzero(np.isfinite(score))
    columns = [pa.array(queries["ids"][q], pa.int64()), pa.array(own[q]), pa.array(at[q, j]), pa.array(score[q, j])]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(list(ids[q, j]), pa.int64())], names=["query_id", "query_row", "row", "score", "id"])


def neighbours(rows: DataFrame, is_query: Column | str, k: int = 10, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, key, score): the k nearest rows of every row for which ``is_query`` holds, an expression over its id."""
    condition = F.expr(is_query) if isinstance(is_query, str) else is_query
    asked = F.coalesce(condition & F.col(key).isNotNull(), F.lit(False))
    vectors = rows.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), asked.alias("asked"), F.monotonically_increasing_id().alias("row"))
    d = dimension(vectors, "vector")
    rotate = rotation(d) if d else np.zeros((0, 64))
    result = "query_id long, rank int, id long, score double"
    spark = vectors.sparkSession

    def sums(batches):
        n, total = 0, np.zeros(d)
        for _, found in matrices(batches, d):
            some = found[found.any(axis=1)]
            n, total = n + len(some), total + some.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(total), pa.array(np.full(d, n))], names=["position", "total", "n"])

    added = vectors.select("vector").mapInArrow(sums, "position long, total double, n long").groupBy("position")
    means = added.agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()  # a row for each component
    if not means or not means[0].n:
        return spark.createDataFrame([], result).withColumnRenamed("id", key)
    mean = np.array([r.total / r.n for r in sorted(means, key=lambda r: r.position)])

    def codes(batches):
        for batch, found in matrices(batches, d):
            some = np.flatnonzero(found.any(axis=1))
            words, length, along = coded(found[some] - mean, rotate)
            kept = batch.select(["id", "row", "asked"]).take(pa.array(some))
            binary = [pa.array([r.tobytes() for r in matrix], pa.binary()) for matrix in (found[some], words)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *binary, pa.array(length), pa.array(along)], names=["id", "row", "asked", "vector", "code", "length", "along"])

    schema = "id long, row long, asked boolean, vector binary, code binary, length double, along double"
    table = written(vectors.mapInArrow(codes, schema), "one-bit-codes")
    found = None
    for queries in _blocks(table.filter("asked").select("id", "row", "vector"), d, mean, rotate):
        shared = spark.sparkContext.broadcast(queries)
        nearest = table.drop("asked").mapInArrow(lambda batches, shared=shared: search(batches, shared.value, k), "query_id long, query_row long, row long, score double, id long")
        # ids ascending, null ids last, as in the tasks
        order = Window.partitionBy("query_row").orderBy("score", F.col("id").isNull(), "id", "row")
        ranked = nearest.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        part = written(ranked.select("query_id", "rank", "id", "score"), "neighbours")
        shared.destroy()
        found = part if found is None else found.unionByName(part)
    found = spark.createDataFrame([], result) if found is None else found
    return found.withColumnRenamed("id", key)


def _blocks(asked: DataFrame, d: int, mean: np.ndarray, rotate: np.ndarray):
    """The queries, as many at a time as ``QUERY_BYTES`` hold; the driver has one block and one partition of about that size."""
    most, held = max(1, QUERY_BYTES // (8 * d)), []
    asked = asked.repartition(asked.count() // most + 1)

    def block():
        matrix = np.frombuffer(b"".join(r.vector for r in held)).reshape(len(held), d)
        return prepared(np.array([r.id for r in held], dtype=np.int64), np.array([r.row for r in held], dtype=np.int64), matrix, mean, rotate)

    for row in asked.toLocalIterator():
        held.append(row)
        if len(held) == most:
            yield block()
            held.clear()
    if held:
        yield block()

"""The vector operators against plain recomputation."""

from __future__ import annotations

import hashlib
import math
from pathlib import Path

import duckdb
import numpy as np
import pytest

from qualitypipe.llm import catalogue, nearest, vector_codes, whitening
from qualitypipe.llm.shared import table
from tests.llm.common import SF, SF_LARGER, needs_tables

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")
#: Rows whose vectors take no part.
UNUSABLE = [(900, None, 1), (901, [1.0, None, 0.0, 2.0, 3.0, 4.0, 5.0, 6.0], 1), (902, [NAN] * 8, 2), (903, [INF] + [0.0] * 7, 2), (904, [], 1), (905, [1.0, 2.0], 3)]
CLASHING = ["id", "vector", "row", "score", "rank", "code", "error", "label_error", "n", "part", "asked"]


def vectors(seed: int, n: int, d: int = 8, copies: int = 0) -> list[tuple]:
    r = np.random.default_rng(seed)
    base = r.standard_normal((n, d)).astype(np.float32) / 3
    rows = [(int(i), [float(x) for x in v], int(i % 3) if i % 5 else None) for i, v in enumerate(base)]
    return rows + [(n + j, rows[0][1], 1) for j in range(copies)]


def given(spark, sf=SF):
    return [(r.vec_id, list(r.embedding), r.label) for r in table(spark, str(sf), "embeddings").collect()]


def clashing(frame):
    from pyspark.sql import functions as F

    return frame.withColumns({c: F.lit("x") for c in CLASHING})


def usable(rows, d):
    return [r for r in rows if r[1] is not None and len(r[1]) == d and all(x is not None and math.isfinite(x) for x in r[1])]


# --- codes -----------------------------------------------------------------------------------------


def codes_by_force(rows, d, rounds=4):
    rows = sorted(usable(rows, d), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = np.array([[math.floor(1024 * c) for c in r[1]] for r in rows], dtype=np.int64).reshape(len(rows), d)
    wide = [d // 4 + (p < d % 4) for p in range(4)]
    cuts = [(sum(wide[:p]), sum(wide[: p + 1])) for p in range(4)]
    books = [x[:256, a:b].copy() for a, b in cuts]

    def assign():
        out = []
        for (a, b), book in zip(cuts, books, strict=True):
            distance = ((x[:, None, a:b] - book[None]) ** 2).sum(axis=2)
            out.append((distance.argmin(axis=1), distance.min(axis=1)))
        return out

    for _ in range(rounds):
        for p, ((a, b), (index, _)) in enumerate(zip(cuts, assign(), strict=True)):
            for e in set(index.tolist()):
                own = x[index == e, a:b]
                books[p][e] = [int(s) // len(own) for s in own.sum(axis=0)]
    found = assign()
    error = sum(e for _, e in found)
    labels = [r[2] for r in rows]
    total = {label: int(sum(e for e, other in zip(error, labels, strict=True) if other == label)) for label in set(labels)}
    sha = hashlib.sha256(",".join(str(v) for book in books for v in book.ravel()).encode()).hexdigest()
    return sorted(
        (r[0] is None, r[0] or 0, "".join(f"{i[k]:02x}" for i, _ in found), int(error[k]), total[r[2]], sha) for k, r in enumerate(rows)
    )


def codes_found(frame):
    return sorted((r.vec_id is None, r.vec_id or 0, r.code, r.error, r.label_error, r.codebooks_sha256) for r in frame.collect())


@pytest.mark.parametrize(("n", "d", "copies"), [(700, 8, 30), (40, 8, 0), (300, 6, 3), (1, 8, 0), (5, 3, 0)])
def test_codes_equal_brute_force(spark, n, d, copies):
    rows = vectors(n, n, d, copies)
    found = vector_codes.encode(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert codes_found(found) == codes_by_force(rows, d)


@needs_tables
def test_codes_of_the_given_table(spark):
    assert codes_found(catalogue.QUERIES["op11_vector_codes"](spark, str(SF))) == codes_by_force(given(spark), 64)


def test_codes_of_unusable_rows_null_and_repeated_ids_and_clashing_names(spark):
    rows = [*vectors(4, 300), *UNUSABLE, (None, [0.5] * 8, None), (7, [0.25] * 8, 1), (7, [0.25] * 8, 1)]
    found = vector_codes.encode(clashing(spark.createDataFrame(rows, SCHEMA)))
    assert codes_found(found) == codes_by_force(rows, 8)


def test_codes_of_empty_tables(spark):
    assert vector_codes.encode(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vector_codes.encode(spark.createDataFrame([(1, None, 1), (2, [], 1)], SCHEMA)).collect() == []


def test_codes_with_many_labels_are_joined_by_shuffle(spark, monkeypatch):
    rows = vectors(5, 400)
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 1)
    assert codes_found(vector_codes.encode(spark.createDataFrame(rows, SCHEMA))) == codes_by_force(rows, 8)


def test_cells_keep_every_nearest_entry_and_leave_out_most(monkeypatch):
    r = np.random.default_rng(2)
    entries = r.integers(-400, 400, (256, 16))
    entries[7] = entries[3]  # a tie: the lower index wins
    points = np.concatenate([r.integers(-450, 450, (3000, 16)), entries, entries[::2] + 1])
    distance = ((points[:, None] - entries[None]) ** 2).sum(axis=2)
    for remembered in (16, 16_384):
        monkeypatch.setattr(vector_codes, "CELLS", remembered)
        cells = vector_codes.Cells(entries)
        for a in range(0, len(points), 500):
            index, error = cells.nearest(points[a : a + 500])
            assert (index == distance[a : a + 500].argmin(axis=1)).all()
            assert (error == distance[a : a + 500].min(axis=1)).all()
        assert cells.evaluated < 0.4 * len(points) * len(entries)


def test_cells_are_remembered():
    cells = vector_codes.Cells(np.arange(256)[:, None] * np.ones((1, 4), dtype=np.int64))
    points = np.full((1000, 4), 77)
    cells.nearest(points)
    assert len(cells.known) == 1
    known = dict(cells.known)
    cells.nearest(points)
    assert cells.known == known


def test_very_large_components_are_bounded(spark):
    rows = [(i, [1e30 if i == 3 else -1e30 if i == 4 else float(i)] * 8, 1) for i in range(9)]
    found = vector_codes.encode(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 9
    assert all(r.error == 0 for r in found)


# --- whitening -------------------------------------------------------------------------------------


def scaled(row):
    return tuple(math.floor(64 * c) + 1_000_000 for c in row[1])


def check_whitening(rows, d, found, k=16):
    rows = usable(rows, d)
    fit = sorted({scaled(r) for r in rows})
    n, s = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    k = min(k, d)
    assert len(found) == len(rows) * k
    centred = np.array([[n * c - t for c, t in zip(x, s, strict=True)] for x in fit], dtype=np.float64) / n
    covariance = centred.T @ centred / n
    values = np.linalg.eigvalsh(covariance)[::-1][:k]
    white = {}
    for r in found:
        white.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r.whitened)
        assert r.n == n
        assert abs(r.explained - values[r.component - 1] / values.sum() * (values.sum() / np.trace(covariance))) <= 1e-9
        assert r.identity_error <= 1e-9
    expected = sorted((r[0], sum((n * c - t) ** 2 for c, t in zip(scaled(r), s, strict=True))) for r in rows)
    assert sorted((r.vec_id, r.deviation) for r in found if r.component == 1) == expected
    # one whitened vector for each row of the fit list: their covariance is the identity
    by_id = {r[0]: r for r in rows}
    first = {}
    for (i, deviation), components in white.items():
        first.setdefault(scaled(by_id[i]), [components[c + 1][0] for c in range(k)])
    w = np.array([first[x] for x in fit])
    apart = np.cov(w.T, bias=True).reshape(k, k) - np.eye(k)
    assert np.abs(apart).max() <= 1e-8
    # and they are projections on eigenvectors: back in the space of x they keep their lengths
    axes = np.linalg.lstsq(w, centred, rcond=None)[0]
    assert np.allclose(np.linalg.norm(axes, axis=1) ** 2, values, rtol=1e-6)


@pytest.mark.parametrize(("n", "d", "copies"), [(300, 8, 40), (60, 20, 0), (9000, 5, 9), (200, 2, 0)])
def test_whitening_equals_brute_force(spark, n, d, copies):
    rows = vectors(n + 1, n, d, copies)
    found = whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()
    check_whitening(rows, d, found)


@needs_tables
def test_whitening_of_the_given_table(spark):
    check_whitening(given(spark), 64, catalogue.QUERIES["op12_whitening"](spark, str(SF)).collect())


def test_whitening_of_unusable_rows_null_and_repeated_ids_and_clashing_names(spark):
    rows = [*vectors(4, 300), *UNUSABLE]
    found = whitening.whiten(clashing(spark.createDataFrame(rows, SCHEMA)))
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(rows, 8, found.collect())
    again = [*vectors(4, 300), (None, [0.5] * 8, 1), (3, vectors(4, 300)[3][1], 1), (3, [0.125] * 8, 1)]
    found = whitening.whiten(spark.createDataFrame(again, SCHEMA)).collect()
    assert len(found) == len(again) * 8
    assert {r.n for r in found} == {302}


def test_whitening_without_variance_and_of_empty_tables(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None, 1)], SCHEMA)).collect() == []
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.25, 0.0, 1.0], 1)] * 3, SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, None)] * 12
    flat = [(i, [i / 8, 0.5, -i / 8], 1) for i in range(40)]  # varies in one direction only
    found = whitening.whiten(spark.createDataFrame(flat, SCHEMA)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert {round(r.explained, 12) for r in found} == {1.0, 0.0}


def test_scatter_of_bit_planes_is_exact():
    r = np.random.default_rng(1)
    for y in (r.integers(0, 90, (1000, 7)), r.integers(0, 2**40, (130, 3)), np.zeros((3, 2), dtype=np.int64), r.integers(0, 2, (64, 65))):
        exact = y.astype(object)
        assert (whitening.scatter(y) == np.triu(exact.T @ exact)).all()


def test_packed_vectors_come_back_and_are_told_apart():
    import pyarrow as pa

    x = np.array([[0, 127], [-128, 5], [128, 0], [-129, 0], [1 << 15, 0], [1 << 31, -(1 << 31)], [-(1 << 40), 1 << 40]]) + whitening.OFFSET
    keys = whitening.packed(x)
    assert len(set(keys)) == len(x)
    assert [len(k) // 2 for k in keys] == [1, 1, 2, 2, 4, 8, 8]
    assert (whitening.unpacked(pa.array(keys, pa.binary()), 2) == x).all()


def test_deviations_beyond_a_long_are_null():
    assert whitening.deviations(np.array([[1 << 31, 0], [1 << 33, 1]])).to_pylist() == [1 << 62, None]


def test_large_components_stay_exact(spark):
    rows = [(i, [float(2**20 + 17 * i), float(i * i), 0.5 * (i * 7 % 50)], 1) for i in range(50)]
    check_whitening(rows, 3, whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect())


# --- nearest neighbours ----------------------------------------------------------------------------


def nearest_by_force(rows, d, divisor, k=10):
    rows = [r for r in usable(rows, d) if any(x != 0 for x in r[1])]
    found = []
    for at, q in enumerate(rows):
        if q[0] is None or q[0] % divisor:
            continue
        others = [
            (math.sqrt(sum((a - b) ** 2 for a, b in zip(q[1], c[1], strict=True))), c[0] is None, c[0] or 0)
            for j, c in enumerate(rows)
            if j != at
        ]
        found += [(q[0], rank, None if unknown else i, score) for rank, (score, unknown, i) in enumerate(sorted(others)[:k], start=1)]
    return found


def same_neighbours(found, expected):
    order = lambda r: (r[0], r[1], r[3])
    found, expected = sorted(map(tuple, found), key=order), sorted(expected, key=order)
    assert [r[:3] for r in found] == [r[:3] for r in expected]
    assert np.allclose([r[3] for r in found], [r[3] for r in expected], rtol=1e-12, atol=0)


@pytest.mark.parametrize(("n", "d", "copies"), [(400, 8, 0), (6, 8, 0), (300, 70, 0), (150, 1, 0), (1, 8, 0)])
def test_neighbours_equal_brute_force(spark, n, d, copies):
    rows = vectors(n, n, d, copies)
    found = nearest.neighbours(spark.createDataFrame(rows, SCHEMA).repartition(4), "vec_id % 20 = 0")
    same_neighbours(found.collect(), nearest_by_force(rows, d, 20))


def test_neighbours_of_unusable_rows_ties_copies_null_and_repeated_ids(spark):
    rows = [*vectors(4, 120, copies=15), *UNUSABLE, (910, [0.0] * 8, 1), (None, vectors(4, 120)[0][1], 1), (20, [0.25] * 8, 1)]
    found = nearest.neighbours(clashing(spark.createDataFrame(rows, SCHEMA)), "vec_id % 20 = 0")
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    same_neighbours(found.collect(), nearest_by_force(rows, 8, 20))


def test_neighbours_in_several_blocks_of_queries(spark, monkeypatch):
    rows = vectors(8, 200)
    monkeypatch.setattr(nearest, "QUERY_BYTES", 3 * 8 * 8)
    found = nearest.neighbours(spark.createDataFrame(rows, SCHEMA), "vec_id % 10 = 0")
    same_neighbours(found.collect(), nearest_by_force(rows, 8, 10))


def test_neighbours_of_empty_tables_and_without_queries(spark):
    for rows in ([], [(100, None, 1)], [(1, [0.5] * 8, 1), (2, [0.25] * 8, 1)]):
        found = nearest.neighbours(spark.createDataFrame(rows, SCHEMA), "vec_id % 100 = 0")
        assert found.columns == ["query_id", "rank", "vec_id", "score"]
        assert found.collect() == []


@needs_tables
def test_recall_and_share_reranked_on_the_given_table(spark):
    """All neighbours are found, and error bounds leave out most vectors."""
    rows = given(spark, SF_LARGER)
    found = nearest.neighbours(table(spark, str(SF_LARGER), "embeddings"), "vec_id % 100 = 0").collect()
    same_neighbours(found, nearest_by_force(rows, 64, 100))
    x = np.array([r[1] for r in rows])
    mean, rotate = x.mean(axis=0), nearest.rotation(64)
    codes, length, along = nearest.coded(x - mean, rotate)
    queries = nearest.prepared(np.arange(0, 500, 50), np.arange(0, 500, 50), x[::50], mean, rotate)
    distance, error = nearest.estimates(queries, codes, np.bitwise_count(codes).sum(axis=1), length, along)
    exact = ((x[None] - x[::50][:, None]) ** 2).sum(axis=2)
    assert (np.abs(distance - exact) <= error).mean() > 0.99
    tenth = np.partition(exact, 10, axis=1)[:, 10:11]
    assert ((distance - error)[exact <= tenth] <= np.broadcast_to(tenth, exact.shape)[exact <= tenth]).mean() > 0.99
    assert (distance - error <= tenth).mean() < 0.25


# --- the queries against SQL -----------------------------------------------------------------------


@needs_tables
@pytest.mark.parametrize("name", ["op11_vector_codes", "op13_nearest"])
def test_vector_queries_equal_their_sql(spark, name):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{Path(SF_LARGER)}/embeddings.parquet')")
    relation = connection.sql(catalogue.ORACLES[name])
    frame = catalogue.QUERIES[name](spark, str(SF_LARGER)).select(*relation.columns)
    found, expected = sorted(map(tuple, frame.collect())), sorted(relation.fetchall())
    assert found == expected

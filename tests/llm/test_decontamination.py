"""SimHash windows and multi-index search against sliding every item over every document."""

from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from qualitypipe.llm import decontamination
from tests.llm.common import SF, SF_LARGER, clashing, documents, needs_tables, prose, words


def runs(w):
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def brute_force(docs, items):
    """(doc, item) -> best similarity of any window of the item's size."""
    out = {}
    for d, text in docs:
        w = words(text)
        whole = {tuple(w[k : k + n]) for n in (1, 2, 3, 4, 5) for k in range(len(w) - n + 1)}
        for i, item in items:
            want = words(item)
            if not want or not w:
                continue
            wanted, best = runs(want), 0.0
            if not whole & wanted.keys():
                continue
            for s in range(max(1, len(w) - len(want) + 1)):
                have = runs(w[s : s + len(want)])
                names = have.keys() | wanted.keys()
                best = max(best, sum(min(have[x], wanted[x]) for x in names) / sum(max(have[x], wanted[x]) for x in names))
            if best >= 0.75:
                out[d, i] = round(best, 9)
    return out


def found(docs, items):
    return {(r.doc_id, r.item_id): round(r.similarity, 9) for r in decontamination.contained(docs, items).collect()}


def test_planted_passages(spark):
    items = [(k, " ".join(prose(k, n))) for k, n in enumerate((14, 36, 58, 5, 3, 0))]
    one, two = items[0][1].split(), items[1][1].split()
    docs = [
        (1, " ".join(prose(50, 100)) + " " + items[1][1] + " " + " ".join(prose(51, 30))),
        (2, items[0][1].upper()),
        (3, " ".join(two[:17] + ["inserted"] + two[17:])),
        (4, " ".join(two[:20])),
        (5, " ".join(["x", *one[:-1], "changed", "y"])),
        (6, items[3][1] + " tail " + items[4][1]),
        (7, None),
        (8, ""),
        (None, "a b c " + items[2][1]),
        (9, items[1][1] + " and " + items[1][1]),
    ]
    frame = spark.createDataFrame(items, "item_id long, text string")
    expected = brute_force(docs, items)
    assert {(1, 1), (2, 0), (5, 0), (6, 3), (6, 4), (None, 2), (9, 1)} <= expected.keys() and (4, 1) not in expected
    assert found(documents(spark, docs), frame) == expected
    assert found(clashing(documents(spark, docs)), clashing(frame)) == expected
    left = decontamination.decontaminate(clashing(documents(spark, docs)), frame)
    assert sorted(r.doc_id for r in left.collect()) == sorted({d for d, _ in docs if d} - {d for d, _ in expected if d})
    assert set(left.columns) == set(clashing(documents(spark, docs)).columns)


def test_clean_rows_stay_beside_held_ones_of_the_same_id(spark):
    items = spark.createDataFrame([(1, " ".join(prose(1, 20)))], "item_id long, text string")
    held, clean = "before " + " ".join(prose(1, 20)), [" ".join(prose(k, 40)) for k in (7, 8, 9)]
    rows = [(None, held), (None, clean[0]), (None, None), (None, ""), (5, held), (5, clean[1]), (6, clean[2]), (7, held)]
    left = decontamination.decontaminate(clashing(documents(spark, rows)), items)
    assert sorted(map(str, ((r.doc_id, r.text) for r in left.collect()))) == sorted(map(str, (x for x in rows if x[1] != held)))


def test_without_broadcast_and_with_empty_tables(spark, monkeypatch):
    items = spark.createDataFrame([(1, " ".join(prose(1, 20)))], "item_id long, text string")
    docs = documents(spark, {1: "before " + " ".join(prose(1, 20)), 2: "nothing here"})
    monkeypatch.setattr(decontamination, "FEW_SHINGLES", 0)
    monkeypatch.setattr(decontamination, "FEW_DOCUMENTS", 0)
    assert found(docs, items) == {(1, 1): 1.0}
    assert found(docs, items.limit(0)) == {} and found(docs.limit(0), items) == {}
    assert decontamination.decontaminate(docs, items.limit(0)).count() == 2


def test_blocks_cover_the_fingerprint_and_find_all_within_the_radius(spark):
    assert sum(decontamination.BLOCK_BITS) == 64 and len(decontamination.BLOCK_BITS) == decontamination.RADIUS + 1
    r = random.Random(1)
    pairs = []
    for _ in range(200):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), decontamination.RADIUS):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    frame = spark.createDataFrame(pairs, "a long, b long")
    blocks = [decontamination.block_values(F.col(c)) for c in ("a", "b")]
    assert frame.filter(F.exists(F.zip_with(*blocks, lambda x, y: x == y), lambda same: same)).count() == 200
    # one row for each pair within the radius, none for another item's fingerprint or a bit more
    numbered = [(k, k, a, b) for k, (a, b) in enumerate(pairs)]
    windows = spark.createDataFrame([(k, i, a) for k, i, a, _ in numbered] + [(900, 1, pairs[0][0] ^ 0xFFFFF)], "window long, item long, print long")
    items = spark.createDataFrame([(i, b) for _, i, _, b in numbered], "item long, print long")
    assert sorted(r.window for r in decontamination.within_radius(windows, items).collect()) == list(range(200))


def test_items_without_an_id_of_one_id_and_rows_of_one_id(spark):
    one, two, three = (" ".join(prose(k, 20)) for k in (1, 2, 3))
    items = spark.createDataFrame([(None, one), (4, two), (4, three), (5, three)], "item_id long, text string")
    docs = documents(spark, [(1, "a " + one), (2, two + " b"), (3, "x y " + three), (9, "a " + one), (9, "b c d " + three), (9, None)])
    rows = {(r.doc_id, r.item_id): (r.similarity, r.start_word, r.n_windows > 0) for r in decontamination.contained(docs, items).collect()}
    assert rows == {(1, None): (1.0, 1, True), (2, 4): (1.0, 0, True), (3, 4): (1.0, 2, True), (3, 5): (1.0, 2, True),
                    (9, None): (1.0, 1, True), (9, 4): (1.0, 3, True), (9, 5): (1.0, 3, True)}


def test_long_text(spark):
    item = prose(1, 40)
    text = prose(2, 150_000) + item[:39] + ["changed"] + prose(3, 150_000) + item
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    (row,) = decontamination.contained(documents(spark, {1: " ".join(text)}), items).collect()
    assert (row.similarity, row.start_word) == (1.0, 300_040)


@needs_tables
def test_given_tables(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(str(SF / "documents.parquet")).collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(str(SF / "benchmark.parquet")).collect()]
    frames = [spark.read.parquet(str(SF / f"{t}.parquet")) for t in ("documents", "benchmark")]
    assert found(*frames) == brute_force(docs, items)


@needs_tables
def test_plan_runs_no_python(spark):
    frames = [spark.read.parquet(str(SF_LARGER / f"{t}.parquet")) for t in ("documents", "benchmark")]
    plan = decontamination.contained(*frames)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

"""HyperMinHash near-duplicate groups against comparing all pairs."""

from __future__ import annotations

import itertools
import random
from pathlib import Path

import numpy as np
from pyspark.sql import functions as F

from qualitypipe.llm import near_dedup
from qualitypipe.llm.shared import Scratch
from tests.llm.common import SF, clashing, documents, needs_tables, prose, shingles


def brute_force(rows):
    """doc_id -> (shingles, component) over all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def compare(spark, rows):
    found = near_dedup.groups(documents(spark, rows)).collect()
    assert len(found) == len(rows)
    expected = brute_force(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)


def changed(base, share, r):
    return " ".join(w if r.random() > share else w + "x" for w in base)


def test_copies_near_copies_chains_and_strangers(spark):
    r = random.Random(3)
    rows, at = [], 0
    for group in range(12):
        base = prose(group, r.choice([6, 30, 80, 200]))
        for _ in range(5):
            rows.append((at, changed(base, r.choice([0, 0.01, 0.02, 0.05]), r)))
            at += 1
        chain = list(base)
        for _ in range(4):  # each a little further from the first
            chain[r.randrange(len(chain))] = f"c{at}"
            rows.append((at, " ".join(chain)))
            at += 1
    compare(spark, rows)


def test_null_empty_short_repeated_and_clashing(spark):
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE two"), (6, "one two three"), (7, "a b c d e"), (8, "a b c d e"), (None, "a b c d e")]
    found = {r.doc_id: r for r in near_dedup.groups(clashing(documents(spark, rows).withColumnRenamed("n_chars", "n"))).collect()}
    assert {i: (r.n_shingles, r.component_id) for i, r in found.items() if i is not None} == brute_force(rows)
    assert found[5].component_id == 4 and not found[5].kept
    assert found[None].component_id is None and found[None].kept
    assert found[1].component_id == 1 and found[1].n_shingles == 0
    again = documents(spark, [*rows, *rows])
    kept = near_dedup.deduplicated(again)
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 2, 3, 4, 6, 7]


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """With next to no room for pairs, the join on rare shingles has to find the links."""
    monkeypatch.setattr(near_dedup, "FEW_COMPONENTS", 0)
    r = random.Random(9)
    base = prose(1, 60)
    rows = [(i, changed(base, 0.035, r)) for i in range(100)]
    compare(spark, rows)


def test_registers_estimate_the_similarity():
    pool = near_dedup.mix(np.arange(1, 3000, dtype=np.uint64))
    for shared, own in ((900, 100), (600, 400), (50, 10)):
        a, b = pool[: shared + own], np.concatenate([pool[:shared], pool[2000 : 2000 + own]])
        agree = (near_dedup.registers(a) == near_dedup.registers(b)).sum()
        estimate = near_dedup.estimated(np.array([agree]), np.array([len(a)]), np.array([len(b)]))[0]
        true = shared / (shared + 2 * own)
        assert abs(estimate - true) < 4 * np.sqrt(true * (1 - true) / near_dedup.REGISTERS)


def test_an_empty_table(spark):
    assert near_dedup.groups(documents(spark, {1: "a"}).limit(0)).count() == 0


def test_a_long_text_is_one_of_many_shingles(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    found = near_dedup.groups(documents(spark, [(1, long), (2, long + " end"), (3, "w1 w2 w3 w4 w5")])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {1: (59_996, 1), 2: (59_997, 1), 3: (1, 3)}


@needs_tables
def test_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(str(SF / "documents.parquet")).select("doc_id", "text").collect()]
    compare(spark, rows)


def test_components_of_long_chains(spark):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    with Scratch(spark, "test") as scratch:
        assert {r.root for r in near_dedup.components(links, scratch).collect()} == {0}


def test_ids_of_text_and_of_rows_that_share_one(spark):
    base, other = " ".join(prose(1, 40)), " ".join(prose(2, 40))
    rows = [("b", base), ("a", base + " end"), ("c", other), ("a", other), ("a", "one two"), ("a", base + " end")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    found = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dedup.groups(docs).collect())
    assert found == [("a", 1, "a", True), ("a", 36, "a", True), ("a", 37, "a", True), ("a", 37, "a", True), ("b", 36, "a", False), ("c", 36, "a", False)]
    kept = sorted(tuple(r) for r in near_dedup.deduplicated(docs).collect())
    assert kept == sorted([("a", base + " end"), ("a", other), ("a", "one two")])


def test_near_copies_under_one_id_are_one_group(spark):
    base = " ".join(prose(1, 60))
    docs = documents(spark, [(1, base), (1, base + " end"), (2, base + " more"), (3, None), (3, None), (None, base)])
    kept = near_dedup.deduplicated(docs).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 3]


def _pairs_estimated(spark, monkeypatch, n):
    """Rows that are estimated for one group of near copies, a quarter of whose pairs are links."""
    r = random.Random(n)
    base = prose(5, 150)
    other = lambda w, rate: w if r.random() > rate else f"{w}{r.randrange(10**6)}"
    rates = [0.002, 0.01, 0.02, 0.03, 0.05]
    docs = documents(spark, [(i, " ".join(other(w, rates[i % 5]) for w in base)) for i in range(n)])
    asked, estimated = [], near_dedup._estimated

    def counting(pairs, sketches):
        asked.append(pairs.count())
        return estimated(pairs, sketches)

    monkeypatch.setattr(near_dedup, "_estimated", counting)
    near_dedup.groups(docs).count()
    monkeypatch.setattr(near_dedup, "_estimated", estimated)
    return sum(asked)


def test_pairs_of_a_group_grow_with_its_size(spark, monkeypatch):
    """Four times the members, well below sixteen times the pairs, and a few for each member."""
    few, many = (_pairs_estimated(spark, monkeypatch, n) for n in (300, 1200))
    assert many < 8 * few and many < 20 * 1200


def test_tables_in_between_go(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir")) / "qualitypipe-llm"
    before = {p.name for p in folder.iterdir()} if folder.exists() else set()
    near_dedup.groups(documents(spark, {1: "a b c d e f", 2: "a b c d e f g"})).count()
    assert [p.name.rsplit("-", 1)[0] for p in folder.iterdir() if p.name not in before] == ["near-dedup"]

"""The pipeline against its stages' plain definitions, and the package against imports from outside."""

from __future__ import annotations

import re
import tracemalloc
from pathlib import Path

import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import queries
from qualitypipe.llm import catalogue, near_dedup, shared, toxicity
from qualitypipe.llm.shared import ARROW_ROWS, fold, labelled_sample, written
from tests.llm.common import SF, SF_LARGER, clashing, documents, needs_tables
from tests.llm.test_decontamination import brute_force as held
from tests.llm.test_near_dedup import brute_force as grouped


@needs_tables
def test_stages_in_turn(spark):
    sf = str(SF)
    docs = spark.read.parquet(str(SF / "documents.parquet"))
    rows = [(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5), (-3, "", None, None, 0)]
    docs = written(docs.unionByName(spark.createDataFrame(rows, docs.schema)), "test-documents")
    languages, toxic, near, leaks, mixed = (stage for _, stage in corpus_pipeline.STAGES)
    one = written(languages(spark, docs, sf), "test")
    assert one.columns == docs.columns
    assert {r.doc_id for r in docs.select("doc_id").subtract(one.select("doc_id")).collect()} == {-1, -2, -3}
    two = written(toxic(spark, one, sf), "test")
    labels = spark.read.parquet(str(SF / "labels.parquet"))
    model = toxicity.fit(labelled_sample(one, labels, "toxic", fold("doc_id", 4) != 2, per_class=1800))
    clean = toxicity.score(one, model, ["doc_id"]).filter("score < 0.3").select("doc_id")
    assert sorted(r.doc_id for r in two.collect()) == sorted(r.doc_id for r in clean.collect())
    three = written(near(spark, two, sf), "test")
    texts = {r.doc_id: r.text for r in two.collect()}
    assert sorted(r.doc_id for r in three.collect()) == sorted(i for i, (_, c) in grouped(list(texts.items())).items() if i == c)
    four = written(leaks(spark, three, sf), "test")
    items = [(r.item_id, r.text) for r in spark.read.parquet(str(SF / "benchmark.parquet")).collect()]
    texts = {r.doc_id: r.text for r in three.collect()}
    assert sorted(r.doc_id for r in four.collect()) == sorted(texts.keys() - {d for d, _ in held(list(texts.items()), items)})
    five = mixed(spark, four, sf)
    assert five.columns == [*docs.columns, "copy_no", "shuffle_key"]
    assert {r.doc_id for r in five.collect()} <= {r.doc_id for r in four.collect()}
    assert five.groupBy("doc_id", "copy_no").count().filter("count > 1").count() == 0


@needs_tables
def test_run_gives_the_same_rows_twice(spark):
    one, two = (sorted(map(str, corpus_pipeline.run(spark, str(SF)).collect())) for _ in range(2))
    assert one == two and one


@needs_tables
def test_extra_columns_and_empty_tables(spark):
    docs = clashing(spark.read.parquet(str(SF / "documents.parquet")))
    for _, stage in corpus_pipeline.STAGES:
        assert set(docs.columns) <= set(stage(spark, docs, str(SF)).columns)
        assert stage(spark, docs.limit(0), str(SF)).count() == 0


def test_queries_are_registered():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in catalogue.QUERIES)
    assert numbers == list(range(1, 14)) and "pipeline" in queries()


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2]
    for path in [*root.glob("qualitypipe/**/*.py"), *root.glob("queries/*.py"), root / "bench.py"]:
        if "llm" not in path.parts:
            assert "llm" not in path.read_text(), path


@needs_tables
def test_every_query_reads_its_whole_table(spark):
    sizes = {t: spark.read.parquet(str(SF_LARGER / f"{t}.parquet")).count() for t in ("documents", "pages")}
    for name in ("op3_language_id", "op9_url_filter"):
        found = queries()[name](spark, str(SF_LARGER))
        assert found.count() == sizes["pages" if "url" in name else "documents"]
        assert found.select(F.col(found.columns[0])).distinct().count() == found.count()


def batch_rows(frame):
    """Rows of each Arrow batch that Python gets."""

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return [r.n for r in frame.coalesce(1).mapInArrow(rows, "n long").collect()]


def test_python_gets_documents_in_small_batches(spark):
    texts = {i: f"some words of document {i}" for i in range(5000)}
    for stage in (corpus_pipeline.identify_language, corpus_pipeline.remove_near_duplicates):
        own = spark.newSession()
        docs = documents(own, texts)
        found = stage(own, docs, "")
        sizes = batch_rows(docs)
        assert max(sizes) <= ARROW_ROWS and sum(sizes) == len(texts)
        assert found.count() == len(texts)
    given = spark.newSession()
    given.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1700")
    docs = documents(given, texts)
    corpus_pipeline.identify_language(given, docs, "")
    assert max(batch_rows(docs)) == 1700


def test_workers_give_memory_back_after_each_task(monkeypatch):
    calls = []
    monkeypatch.setattr(shared, "give_back", lambda: calls.append(1))
    batch = pa.RecordBatch.from_pydict({"id": [1, 2], "row": [1, 2], "_text": ["a b c d e f", None]})
    assert [b.num_rows for b in near_dedup.sketch([batch])] == [2] and len(calls) == 1
    cut = near_dedup.sketch([batch, batch])
    next(cut)
    cut.close()
    assert len(calls) == 2
    assert list(near_dedup.banded([])) == [] and len(calls) == 3


def test_toxicity_is_learnt_in_little_memory():
    words = lambda d: ["bad" if d % 2 and i == d % 200 else f"w{(i * 7 + d * 13) % 4000}" for i in range(200)]
    rows = [(" ".join(words(d)), d % 2) for d in range(5000)]
    tracemalloc.start()
    try:
        model = toxicity.fit(rows, rounds=2)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    tokens = 200 * len(rows)
    # what Adam keeps of each slot, and arrays with a line for each token; texts, and what a step takes, in parts
    assert most < 5 * 8 * toxicity.SLOTS + 72 * tokens
    assert model.weights is not None and len(model.document) == 3


def test_fit_takes_texts_in_parts(monkeypatch):
    rows = [(f"word{d % 7} and some others {d}" if d % 5 else "", d % 2) for d in range(700)]
    lengths, which, pairs, slot = toxicity._types(rows)
    assert [int(n) for n in lengths] == [len(text.split()) for text, _ in rows]
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 3)
    monkeypatch.setattr(toxicity, "_FIT_BYTES", 40)
    monkeypatch.setattr(toxicity, "_PIECE", 5)
    for a, b in zip((lengths, which, pairs, slot), toxicity._types(rows), strict=True):
        assert (a == b).all()

"""The training-data pipeline: documents in, a shuffled mixture of kept documents out.

Stages take and return documents with all their columns (the last adds two); each works on all its predecessor kept.
Null texts have no letters and go in the first stage. Ties, repeated rows, empty tables and further columns are as each
operator defines; columns may have any name (the last stage puts underscores behind the names it adds if they are taken).
Stages with Python in their tasks set the rows of an Arrow batch for the session, unless it has a number of its own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qualitypipe.llm import decontamination, language_id, mixing, near_dedup, toxicity
from qualitypipe.llm.shared import fold, labelled_sample, narrow_batches, table, written

#: A language is rejected only if the score is next to a guess, a document as toxic only from here on.
LEAST_LANGUAGE_SCORE, LEAST_TOXIC_SCORE = 0.3, 0.3


def _filtered(docs: DataFrame, judge: Callable[[DataFrame, list[str], str], DataFrame], condition: str) -> DataFrame:
    """The documents for which the condition holds on what the operator adds, whatever their columns are called."""
    names = [f"_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*names)
    text = names[docs.columns.index("text")]
    return judge(plain, names, text).filter(condition).select(*names).toDF(*docs.columns)


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a recognisable language go: no letters, or a decision next to a guess."""
    narrow_batches(spark)
    model = language_id.train(docs, fold("doc_id", 4) != 2)
    judge = lambda rows, keep, text: language_id.identify(rows, model, keep, text)
    return _filtered(docs, judge, f"lang_pred <> 'und' and score >= {LEAST_LANGUAGE_SCORE}")


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    narrow_batches(spark)
    labels = table(spark, sf_dir, "labels")
    model = toxicity.fit(labelled_sample(docs, labels, "toxic", fold("doc_id", 4) != 2, per_class=1800))
    judge = lambda rows, keep, text: toxicity.score(rows, model, keep, text)
    return _filtered(docs, judge, f"score < {LEAST_TOXIC_SCORE}")


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group stays."""
    narrow_batches(spark)
    return near_dedup.deduplicated(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as drawn for equal shares of all sources, in a shuffled order."""
    return mixing.mix(docs)


STAGES = [
    ("language_id", identify_language),
    ("toxicity", remove_toxic),
    ("near_dedup", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("mixing", mix_sources),
]

#: Classifiers and groups of similar documents can't be put in SQL; the tests compare stage by stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

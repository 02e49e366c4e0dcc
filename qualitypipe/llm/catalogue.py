"""The queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qualitypipe.llm import (
    context_tree,
    decontamination,
    html_text,
    language_id,
    mixing,
    near_dedup,
    nearest,
    quality_classifier,
    quality_rules,
    toxicity,
    url_filter,
    vector_codes,
    whitening,
)
from qualitypipe.llm.shared import fold, labelled_sample, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

URL_RULES = [
    url_filter.rule("org/", "allow"),
    url_filter.rule("example.org/es/", "block"),
    url_filter.rule("example.org/en/1", "block"),
    url_filter.rule("com/fr/", "allow"),
    url_filter.rule("com/de/", "block"),
]


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.groups(table(spark, sf_dir, "documents"))


ORACLES["op1_near_dedup"] = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM split) AS every),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingles AS a JOIN shingles AS b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM shared JOIN sizes AS p ON p.doc_id = x JOIN sizes AS q ON q.doc_id = y WHERE 100 * k >= 75 * (p.n + q.n - k)),
edges AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION SELECT y, root FROM reach JOIN edges ON x = doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) AS found LEFT JOIN sizes USING (doc_id)
"""


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.train(docs, fold("doc_id", 4) != 2)
    found = language_id.identify(docs, model, ["doc_id"])
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "ambiguous")


@query
def op4_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = context_tree.score(docs, fold("doc_id", 10) != 0, ["doc_id"])
    return scored.select(
        "doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


@query
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


#: The given pages keep their text in one article element; this says what must come out of them.
ORACLES["op5_html_text"] = r"""
SELECT page_id, url, text, length(text) AS n_chars FROM (
  SELECT page_id, url, array_to_string(list_filter(list_transform(
    regexp_split_to_array(regexp_replace(regexp_extract(html, '(?s)<article>(.*)</article>', 1), '</?b>', '', 'g'), '</?(p|h1)>'),
    lambda b: trim(regexp_replace(replace(replace(replace(replace(replace(replace(b, '<br>', ' '), '&lt;', '<'), '&gt;', '>'),
      '&quot;', '"'), '&#x27;', chr(39)), '&amp;', '&'), '\s+', ' ', 'g'))), lambda b: b <> ''), chr(10)) AS text
  FROM pages) AS extracted
"""


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(labelled_sample(docs, table(spark, sf_dir, "labels"), "toxic", fold("doc_id", 4) != 2, per_class=1800))
    scored = toxicity.score(docs, model, ["doc_id"])
    predicted = (F.col("score") >= 0.3).cast("int").alias("predicted")
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", predicted, "n_spans", F.to_json("spans").alias("spans"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), ["doc_id"])


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


ORACLES["op8_mixing"] = mixing.oracle_sql("doc_id, text, lang, source, n_chars")


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    model = url_filter.train(url_filter.labelled_by_rules(pages, URL_RULES))
    return url_filter.judge(pages, URL_RULES, model, ["page_id"])


@query
def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    model = quality_classifier.fit(labelled_sample(docs, labels, "quality", fold("doc_id", 3) != 1, per_class=1000, most_bytes=16 << 20))
    scored = quality_classifier.score(docs, model, ["doc_id"])
    predicted = (F.col("score") >= 0.5).cast("int").alias("predicted")
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", predicted, "n_passages", "top_attention")


@query
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.encode(table(spark, sf_dir, "embeddings"))


def _vector_codes_sql(rounds: int = 4) -> str:
    """The rounds written out one after the other; the dimension must be a multiple of 4."""
    squared = "list_sum(list_transform(list_zip(a.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""
assigned{k} AS MATERIALIZED (
  SELECT vec_id, p, any_value(v) AS v, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT a.vec_id, a.p, a.v, b.e, CAST({squared} AS BIGINT) AS d FROM parts AS a JOIN book{k} AS b USING (p)) AS every GROUP BY 1, 2)""")
        if k < rounds:
            steps.append(f"""
moved{k} AS (
  SELECT p, e, list(CAST(floor(total / number) AS BIGINT) ORDER BY i) AS v FROM (
    SELECT p, best.e AS e, i, CAST(sum(v[i]) AS DOUBLE) AS total, count(*) AS number
    FROM assigned{k}, unnest(range(1, len(v) + 1)) AS positions(i) GROUP BY 1, 2, 3) AS summed GROUP BY 1, 2),
book{k + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.v, b.v) AS v FROM book{k} AS b LEFT JOIN moved{k} AS m USING (p, e))""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)),
parts AS MATERIALIZED (SELECT vec_id, p, x[p * len(x) // 4 + 1:(p + 1) * len(x) // 4] AS v FROM kept, range(4) AS positions(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept),
book0 AS MATERIALIZED (SELECT p, e, v FROM parts JOIN first USING (vec_id) WHERE e < 256),{",".join(steps)},
coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM assigned{rounds} GROUP BY 1),
books AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books"""


ORACLES["op11_vector_codes"] = _vector_codes_sql()


@query
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


ORACLES["op13_nearest"] = r"""
WITH usable AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS place FROM (
    SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda x, y: x + y)) AS score
    FROM usable AS q JOIN usable AS c ON c.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0) AS every) AS ranked
WHERE place <= 10
"""

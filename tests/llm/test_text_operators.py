"""HTML extraction, context-tree scoring, quality rules and mixing."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from qualitypipe.llm import context_tree, html_text, mixing, quality_rules
from qualitypipe.llm.shared import blocks_of, fold
from tests.llm.common import SF, SF_LARGER, clashing, documents, needs_tables, prose, words

PAGE = """<html><body class="has-sidebar"><div class="wrap"><header><h1>Site</h1></header><nav>a b</nav><div id="main-content"><h2>T &amp; U</h2>
<p>Long paragraph of content  that&nbsp;goes on and on<br>for quite a while, really it does.</p><p>Short.</p><div class="share">Share this</div>
<ul><li>item one is here<li>two</ul><script>if (a < b) { x("</p>") }</script><aside><p>By the way, this is aside and rather long too.</p></aside></div>
<div class="sidebar"><p>Some text in a sidebar that is long enough to matter in this case.</p></div><section id="comments"><p>Great post! I really
loved it and will come back again soon.</p></section></div><form><p>Enter text</p></form><div class="cookie-notice">We use cookies here.</div></body>"""


def test_main_text_of_a_page_with_everything():
    expected = "T & U\nLong paragraph of content that goes on and on for quite a while, really it does.\nShort.\nitem one is here\ntwo"
    assert html_text.main_text(PAGE) == expected


LONG = "A paragraph of some length that says a good deal about the matter, and then says it once more."


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (f"<article><h1>T</h1><p class='share'>Share<p>{LONG}<p>{LONG}</article>", ["T", LONG, LONG]),
        (f"<article><h1>T</h1><ul><li class='ad'>Buy<li>{LONG}</ul><p>{LONG}</article>", ["T", LONG, LONG]),
        (f"<article><dl><dt class='promo'>Buy<dd>{LONG}</dl></article>", [LONG]),
        (f"<article><table><tr class='ad'><td>Buy<tr><td>{LONG}<td>{LONG}</table></article>", [LONG, LONG]),
        *((f"<article><h1>T</h1><p class='{c}'>{LONG}</p></article>", ["T", LONG]) for c in ("legal", "search", "related-work", "ad-hoc")),
        (f"<div><p>{LONG}</p></div><div><table><tr><td>1<td>2</table></div><div><p>{LONG}</p></div>", [LONG, "1", "2", LONG]),
        (f"<div class='site-footer'>{LONG}</div><div><p>{LONG}</p></div><div id='reader_comments_list'><p>x</p></div>", [LONG]),
    ],
)
def test_main_text_of_odd_markup(page, expected):
    assert html_text.main_text(page) == "\n".join(expected)


def test_ratios_and_clusters_choose(monkeypatch):
    """Nothing in these names tells menus from text; without ratios the menus would come out."""
    menu = "<div>" + "".join(f"<a href='/{i}'>Item {i}</a> " for i in range(30)) + "</div>"
    page = f"{menu}<div><p>{LONG}</p><p>{LONG}</p></div>{menu}"
    assert html_text.main_text(page) == f"{LONG}\n{LONG}"
    monkeypatch.setattr(html_text, "upper_cluster", lambda values: values >= 0)
    assert "Item 7" in html_text.main_text(page)


def test_html_edges(spark):
    pages = {1: None, 2: "", 3: "<p>", 4: "just text &lt;b&gt;", 5: "<p>a<p>b", 6: "<![x[ <p>one</p>", 7: "<article>" + "<p>long words here</p>" * 20_000, 8: "<div" * 500}
    frame = clashing(spark.createDataFrame([(i, "u", h) for i, h in [*pages.items(), (5, "<p>a<p>b")]], "page_id long, url string, html string"))
    found = html_text.extract(frame, ["page_id", "url"]).collect()
    texts = {r.page_id: r.text for r in found}
    assert len(found) == 9 and all(r.n_chars == len(r.text) for r in found)
    assert (texts[1], texts[2], texts[3], texts[4], texts[5]) == ("", "", "", "just text <b>", "a\nb")
    assert texts[7].count("\n") == 19_999
    assert html_text.extract(frame.limit(0), ["page_id"]).count() == 0


@needs_tables
def test_articles_of_the_given_pages(spark):
    found = {r.page_id: r.text for r in queries()["op5_html_text"](spark, str(SF_LARGER)).collect()}
    for r in spark.read.parquet(str(SF_LARGER / "pages.parquet")).collect():
        article = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        blocks = (" ".join(html.unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:p|h1)>", article))
        assert found[r.page_id] == "\n".join(b for b in blocks if b)


def weighted(counts, depth, context, decision):
    """log of the weighted probability of a node's bits, and of its own estimate, by plain recursion."""
    a, b = counts.get((context, decision), (0, 0))
    own = math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - 2 * math.lgamma(0.5) - math.lgamma(a + b + 1)
    if len(context) == depth:
        return own, own
    below = sum(weighted(counts, depth, context + (c,), decision)[0] for c in range(256) if (context + (c,), decision) in counts)
    return np.logaddexp(own, below) - math.log(2), own


def test_context_tree_equals_plain_recursion(spark, monkeypatch):
    monkeypatch.setattr(context_tree, "DEPTH", 2)
    texts = ["abab abba", "abba abab", "b"]
    tree = context_tree.grow(documents(spark, dict(enumerate(texts))), share=10_000)
    counts: dict = {}
    for text in texts:
        stream = [255, 255, *text.encode(), 255]
        for t in range(2, len(stream)):
            for bit in range(8):
                decision, one = (bit, stream[t] >> (8 - bit)), stream[t] >> (7 - bit) & 1
                for d in range(3):
                    key = (tuple(stream[t - 1 - k] for k in range(d)), decision)
                    zeros, ones = counts.get(key, (0, 0))
                    counts[key] = (zeros + 1 - one, ones + one)

    def chance(context, decision, one):
        chances = []
        for d in range(3):
            a, b = counts.get((context[:d], decision), (0, 0))
            chances.append(((b if one else a) + 0.5) / (a + b + 1))
        p = chances[2]
        for d in (1, 0):
            total, own = weighted(counts, 2, context[:d], decision)
            w = math.exp(own - math.log(2) - total)
            p = w * chances[d] + (1 - w) * p
        return p

    for text in ("abab", "bb a", "", "zebra"):
        stream = [255, 255, *text.encode(), 255]
        expected = sum(
            math.log10(chance((stream[t - 1], stream[t - 2]), (bit, stream[t] >> (8 - bit)), stream[t] >> (7 - bit) & 1)) for t in range(2, len(stream)) for bit in range(8)
        )
        found = context_tree.score_block(tree, next(blocks_of([text])), tree.after_two())[0]
        assert found == pytest.approx(expected, rel=1e-4)
    assert (10.0 ** tree.table.astype(float)).sum(1) == pytest.approx(1, rel=1e-5)


def base_scores(rows, train):
    counts = Counter(w for i, t in rows if train(i) for w in words(t))
    n_docs = sum(train(i) for i, _ in rows)
    n, v = sum(counts.values()) + n_docs, len(counts) + (n_docs > 0)
    score = lambda c: math.log10((c + 0.1) / (n + 0.1 * (v + 1)))
    return n, [(len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + (n_docs > 0), sum(score(counts[w]) for w in words(t)) + score(n_docs)) for _, t in rows]


@pytest.mark.parametrize("frequent", [0, 3, 50_000])
def test_token_baseline(spark, monkeypatch, frequent):
    monkeypatch.setattr(context_tree, "FREQUENT", frequent)
    rows = [(1, "The cat. The dog"), (2, None), (3, "the CAT sat"), (4, ""), (5, "unseen words"), (5, "unseen words"), (None, "the")]
    found = context_tree.score(clashing(documents(spark, rows)), F.col("doc_id").isin(1, 2, 3), ["doc_id", "n_chars"])
    n, expected = base_scores(rows, lambda i: i in (1, 2, 3))
    got = sorted((r.doc_id or 0, r.n_tokens, r.n_known, round(r.base_score, 9)) for r in found.collect())
    assert got == sorted((i or 0, *e[:2], round(e[2], 9)) for (i, _), e in zip(rows, expected, strict=True))
    assert {r.train_tokens for r in found.collect()} == {n}
    assert found.filter("score > 0 or score is null").count() == 0


def test_context_tree_without_rows(spark):
    docs = documents(spark, {1: "ab"})
    found = context_tree.score(docs, F.lit(False), ["doc_id"]).collect()
    assert found[0].score == pytest.approx(-3 * math.log10(256), rel=1e-6) and (found[0].n_known, found[0].train_tokens) == (0, 0)
    assert context_tree.score(docs.limit(0), F.lit(True), ["doc_id"]).count() == 0


@pytest.mark.parametrize(("depth", "looked_up"), [(2, 30), (5, 0), (5, 2_000_000)])
def test_context_tree_keeps_rare_contexts_of_a_large_corpus(spark, monkeypatch, depth, looked_up):
    monkeypatch.setattr(context_tree, "DEPTH", depth)
    monkeypatch.setattr(context_tree, "LOOKED_UP", looked_up)
    monkeypatch.setattr(context_tree, "CHUNK", 10)
    # 400,000 bytes: one in 65,536 are six, and the rare word occurs twice
    texts = [" ".join(prose(3, 60)), *["the cat sat on the mat " * 4400] * 4, "xqzjkv", "a xqzjkv", "", " ".join(prose(4, 60)), "xqzjkv", "xqzj \U0001f600", "zzz"]
    docs = documents(spark, [*enumerate(texts), (None, None)])
    found = {r.doc_id: r.score for r in context_tree.score(clashing(docs), F.col("doc_id") < 8, ["doc_id"]).collect()}
    tree = context_tree.grow(docs.filter("doc_id < 8"), share=10**9)
    for i, text in [*enumerate(texts), (None, "")]:
        expected = context_tree.score_block(tree, next(blocks_of([text])), tree.after_two())[0]
        assert found[i] == pytest.approx(expected, rel=1e-4)


@needs_tables
def test_context_tree_predicts_held_out_documents(spark):
    found = queries()["op4_context_tree"](spark, str(SF_LARGER))
    texts = spark.read.parquet(str(SF_LARGER / "documents.parquet")).select("doc_id", F.octet_length("text").alias("bytes"))
    bits = found.filter("held_out").join(texts, "doc_id").agg((-F.sum("score") / F.log10(F.lit(2.0)) / F.sum("bytes")).alias("b")).first()[0]
    assert bits < 2.5
    assert found.filter(F.col("held_out") != (fold("doc_id", 10) == 0)).count() == 0


def plain_measures(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    repeated = {i + k for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for k in range(3)}
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(repeated)


def test_base_counts_and_verdicts(spark):
    texts = {1: None, 2: "", 3: "a b c a b c", 4: "x\n\nx\n y\n y \nx", 5: "a a a a", 6: " ".join(prose(1, 80)), 7: "é#1 *|* <&>", 8: "b c " * 30_000, 9: "one two", 10: "\t\x0b\n \r"}
    found = quality_rules.judge(clashing(documents(spark, [*texts.items(), (3, texts[3])])), ["doc_id"]).collect()
    assert len(found) == 11
    for r in found:
        assert tuple(r[c] for c in quality_rules.BASE) == plain_measures(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.p_good >= 0.5)
    assert quality_rules.judge(documents(spark, {1: "a"}).limit(0), ["doc_id"]).count() == 0


@needs_tables
def test_quality_of_the_given_documents(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(str(SF_LARGER / "documents.parquet")).collect()}
    found = queries()["op7_quality_rules"](spark, str(SF_LARGER))
    for r in found.collect():
        assert tuple(r[c] for c in quality_rules.BASE) == plain_measures(rows[r.doc_id])
    labels = spark.read.parquet(str(SF_LARGER / "labels.parquet"))
    good = found.join(labels, "doc_id").filter("quality = 1 and not base_failed")
    assert good.agg(F.avg(F.col("kept").cast("int"))).first()[0] > 0.97
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_expectation_maximisation_finds_the_rules_accuracies():
    random = np.random.default_rng(5)
    good = random.random(20_000) < 0.7
    on_good, on_bad = [0.95, 0.9, 0.8], [0.2, 0.3, 0.5]
    votes = np.stack([np.where(random.random(20_000) < np.where(good, g, b), 1, -1) for g, b in zip(on_good, on_bad, strict=True)], 1)
    votes[random.random(votes.shape) < 0.2] = 0
    trust = quality_rules.expectation_maximisation(sorted(Counter(map(tuple, votes.tolist())).items()), 3, rounds=300)
    assert trust.good == pytest.approx(0.7, abs=0.05)
    assert trust.on_good == pytest.approx(on_good, abs=0.05) and trust.on_bad == pytest.approx(on_bad, abs=0.1)
    assert quality_rules.expectation_maximisation([], 2) == quality_rules.start(2)


@needs_tables
def test_mixing_equals_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF_LARGER}/documents.parquet')")
    expected = duck.sql(oracle_sql()["op8_mixing"])
    found = queries()["op8_mixing"](spark, str(SF_LARGER))
    assert sorted(found.columns) == sorted(expected.columns)
    assert sorted(map(tuple, found.select(*expected.columns).collect())) == sorted(expected.fetchall())


def test_mixing_reaches_the_weights(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 2 > 0, "small").alias("source"), F.lit("x").alias("_mean"))
    mixed = mixing.mix(docs, {"big": 1.0, "small": 2.0, None: 1.0}, epochs=2.0)
    shares = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert sum(shares.values()) == pytest.approx(40_000, rel=0.05) and shares["small"] == pytest.approx(20_000, rel=0.05)
    heavy = mixing.mix(docs.filter("doc_id < 6"), {"big": 0.0, "small": 1.0, None: 0.0}, epochs=200.0)
    assert {r.source for r in heavy.collect()} == {"small"} and heavy.count() == pytest.approx(1200, rel=0.2)
    keys = [r.shuffle_key for r in mixed.collect()]
    assert keys == sorted(keys)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix(docs, dict.fromkeys(("big", "small", None), 0.0)).count() == 0
    again = mixing.mix(docs.filter("doc_id < 9").withColumn("Copy_No", F.lit(7)))
    assert again.columns == [*docs.columns, "Copy_No", "copy_no_", "shuffle_key"] and {r.Copy_No for r in again.collect()} == {7}


def test_mixing_draws_for_every_row(spark, monkeypatch):
    """Rows without an id, rows that share one, and rows that repeat come as often as others."""
    texts = [(None, f"text {i}") for i in range(3000)] + [(5, f"text {i}") for i in range(3000)]
    for docs in (documents(spark, texts), documents(spark, [(None, "")] * 3000 + [(None, None)] * 3000 + [(1, "one")])):
        docs = docs.withColumn("source", F.lit("s"))
        mixed = mixing.mix(docs).collect()
        assert len(mixed) == pytest.approx(docs.count(), rel=0.1)
        parts = Counter((r.doc_id, r.text is None) for r in mixed)
        assert all(n == pytest.approx(3000, rel=0.1) for key, n in parts.items() if key[0] != 1)
        assert max(Counter((r.doc_id, r.text, r.copy_no) for r in mixed).values()) == 1
        monkeypatch.setattr(mixing, "FEW_REPEATED", 0)
        assert sorted(map(str, mixing.mix(docs).collect())) == sorted(map(str, mixed))
        monkeypatch.undo()


@needs_tables
def test_mixing_without_broadcast(spark, monkeypatch):
    docs = spark.read.parquet(str(SF / "documents.parquet")).select("doc_id", "source")
    expected = sorted(map(tuple, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "FEW_SOURCES", 0)
    assert sorted(map(tuple, mixing.mix(docs).collect())) == expected

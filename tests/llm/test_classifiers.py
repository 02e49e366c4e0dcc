"""Language, toxicity, quality and URL classifiers: held-out accuracy, exact inner steps, defined results."""

from __future__ import annotations

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from qualitypipe.llm import language_id, quality_classifier, toxicity, url_filter
from qualitypipe.llm.shared import blocks_of, fold, labelled_sample, sample_by_class
from tests.llm.common import SF_LARGER, clashing, documents, needs_tables, prose

ODD = {1: None, 2: "", 3: "123 !!", 4: "the the the", 5: "word " * 40_000, 6: "the the the"}


def labels(spark):
    return spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 40)], "doc_id long, quality int, toxic int")


def trained_texts():
    good, bad = "a quiet sentence about the river", "idiot | | | SHOUT SHOUT"
    return {i: (bad if i % 2 == 0 else good) + f" {i}" for i in range(1, 40)}


@needs_tables
def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(str(SF_LARGER / "documents.parquet"))
    found = queries()["op3_language_id"](spark, str(SF_LARGER))
    assert found.count() == docs.count()
    share = found.join(docs, "doc_id").filter("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert share > 0.97
    assert found.filter("score < 0 or score > 1").count() == 0
    assert found.filter(F.col("held_out") != (F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2)).count() == 0


@needs_tables
@pytest.mark.parametrize(("name", "label", "least"), [("op6_toxicity", "toxic", 0.9), ("op10_quality_classifier", "quality", 0.95)])
def test_held_out_labels(spark, name, label, least):
    found = queries()[name](spark, str(SF_LARGER)).join(spark.read.parquet(str(SF_LARGER / "labels.parquet")), "doc_id")
    assert found.filter("held_out").agg(F.avg((F.col(label) == F.col("predicted")).cast("int"))).first()[0] >= least


def test_language_edges(spark):
    texts = {10 + i: ("the river and the house" if i % 2 else "der fluss und das haus") + f" {i}" for i in range(20)}
    rows = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "en").otherwise("de"))
    model = language_id.train(clashing(rows), F.lit(True))
    assert model.languages == ["de", "en"]
    found = {r.doc_id: r for r in language_id.identify(clashing(documents(spark, ODD)), model, ["doc_id"]).collect()}
    assert {i: found[i].lang_pred for i in (1, 2, 3, 4)} == {1: "und", 2: "und", 3: "und", 4: "en"}
    assert found[1].score == 0 and found[4].score == found[6].score
    assert language_id.identify(rows.limit(0), model, ["doc_id"]).count() == 0
    nothing = language_id.train(rows.limit(0), F.lit(True))
    assert {r.lang_pred for r in language_id.identify(rows, nothing, ["doc_id"]).collect()} == {"und"}


def test_features_and_decoding_equal_plain_recomputation():
    texts = ["Der Fluß, das Haus", "", "a", "the river 12 the river", "é" * 50]
    found = np.concatenate([language_id.features(b) for b in blocks_of(texts)])
    letters = language_id._LETTERS
    for text, row in zip(texts, found, strict=True):
        data, counts = [int(letters[b]) for b in text.encode()], {}
        for n in language_id.ORDERS:
            for i in range(len(data) - n + 1):
                code = 0
                for b in data[i : i + n]:
                    code = (code * 257 + b) % 2**32
                slot = ((code * 2654435761 + n * 40503) * 2246822519 % 2**32) >> 19
                counts[slot] = counts.get(slot, 0) + 1
        norm = max(sum(counts.values()) ** 0.5, 1e-9)
        assert {int(i): pytest.approx(float(row[i]), rel=1e-5) for i in np.flatnonzero(row)} == {i: c**0.5 / norm for i, c in counts.items()}
    model = language_id.fit([(t, lang) for t, lang in zip(texts * 3, "abcab" * 3, strict=True) if t])
    best, score, lead = language_id.decode(model, found)
    for i, row in enumerate(found):
        margins = [float(row @ model.weights[:-1, k] + model.weights[-1, k]) for k in range(model.codes.shape[1])]
        losses = [sum(t * np.log1p(np.exp(-m * c)) for t, m, c in zip(model.trust, margins, code, strict=True)) for code in model.codes]
        order = sorted(losses)
        assert best[i] == losses.index(order[0]) and lead[i] == pytest.approx(order[1] - order[0], abs=1e-4)
        assert score[i] == pytest.approx(np.exp(-order[0]) / sum(np.exp(-np.array(losses))), abs=1e-4)


def test_blocks_are_bounded_in_rows():
    sizes = [b.size for b in blocks_of([""] * 1000 + ["x" * 3_000_000, ""])]
    assert sum(sizes) == 1002 and max(sizes) <= 256


def test_samples_of_repeated_ids_are_bounded_in_rows_and_bytes(spark):
    ids = spark.range(2000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("text"))
    docs = ids.unionByName(ids.withColumn("text", F.lit("same"))).unionByName(spark.createDataFrame([(2, "y" * 500)], "doc_id long, text string"))
    marks = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    sample = lambda **more: labelled_sample(docs, marks, "toxic", F.lit(True), 5, **more)
    assert len(sample()) == 20 and len(set(sample())) == 20
    small = sample(most_bytes=160)
    assert 0 < sum(len(t) for t, _ in small) <= 160 and sample(most_bytes=0) == []


def test_spans_of_a_long_toxic_text_take_one_pass():
    words = prose(4, 400)
    rows = [(" ".join([words[i], *(["idiot"] if i % 2 else []), words[i + 1], words[-i - 1], words[-i - 2]]), i % 2) for i in range(200)]
    model = toxicity.fit(rows)
    text = f"ä idiot {words[7]} {words[9]} {words[11]}. " * 40_000
    (block,) = blocks_of([text])
    began = time.monotonic()
    (spans,) = toxicity.score_block(model, block)[1]
    assert time.monotonic() - began < 20
    assert spans and all("idiot" in text[s["start_at"] : s["end_at"]] for s in spans[:50] + spans[-50:])


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 9, 20):
        codes = language_id.codewords(n)
        assert len(codes) == n
        distance = min((a != b).sum() for i, a in enumerate(codes) for b in codes[:i])
        assert distance >= (1 if n == 2 else 2)


def test_toxic_spans_and_edges(spark):
    words = prose(4, 400)
    rows = [(" ".join([words[i], *(["idiot"] if i % 2 else []), words[i + 1], words[-i - 1], words[-i - 2]]), i % 2) for i in range(200)]
    model = toxicity.fit(rows)
    texts = ODD | {7: "Ä quiet idiot, sentence"}
    found = {r.doc_id: r for r in toxicity.score(clashing(documents(spark, texts)), model, ["doc_id"]).collect()}
    assert len(found) == 7 and all(0 <= r.score <= 1 for r in found.values())
    assert [(texts[7][s.start_at : s.end_at]) for s in found[7].spans] == ["idiot"]
    assert found[7].score > 0.5 > found[4].score and found[1].score == found[2].score and found[4].score == found[6].score
    assert toxicity.score(documents(spark, ODD).limit(0), model, ["doc_id"]).count() == 0
    assert toxicity.fit([]).share == 0.0 and toxicity.fit([("a", 1)]).share == 1.0


def test_marginals_equal_plain_forward_backward():
    random = np.random.default_rng(0)
    steps, start = random.normal(size=(2, 2)), random.normal(size=2)
    lengths = np.array([0, 1, 3, 40, 70, 0, 32, 33, 100])
    emission = random.normal(size=lengths.sum()) * 3
    found, expected, opened = toxicity.marginals(emission, lengths, steps, start, pairs=True)
    at, pairs, first = 0, np.zeros((2, 2)), np.zeros(2)
    for n in lengths[lengths > 0]:
        e = np.stack([np.ones(n), np.exp(emission[at : at + n])], 1)
        a, b = np.zeros((n, 2)), np.ones((n, 2))
        a[0] = np.exp(start) * e[0]
        for t in range(1, n):
            a[t] = (a[t - 1] @ np.exp(steps)) * e[t]
            a[t] /= a[t].sum()
        for t in range(n - 2, -1, -1):
            b[t] = np.exp(steps) @ (e[t + 1] * b[t + 1])
            b[t] /= b[t].sum()
        g = a * b / (a * b).sum(1, keepdims=True)
        assert np.allclose(g[:, 1], found[at : at + n])
        first += g[0]
        for t in range(1, n):
            joint = a[t - 1][:, None] * np.exp(steps) * (e[t] * b[t])[None]
            pairs += joint / joint.sum()
        at += n
    assert np.allclose(pairs, expected) and np.allclose(first, opened)


def test_quality_edges(spark):
    model = quality_classifier.fit([(t, int("idiot" not in t)) for t in trained_texts().values()])
    found = {r.doc_id: r for r in quality_classifier.score(clashing(documents(spark, ODD | trained_texts())), model, ["doc_id"]).collect()}
    assert found[11].score > 0.5 > found[12].score
    assert found[1 if 1 in found else 2].n_passages == 1
    nulls = {r.doc_id: r for r in quality_classifier.score(documents(spark, ODD), model, ["doc_id"]).collect()}
    assert nulls[1].score == nulls[2].score and nulls[5].n_passages == -(-len(ODD[5]) // 512)
    assert quality_classifier.fit([]).share == 0.5 and quality_classifier.fit([("a", 1), ("b", 1)]).share == 1.0
    block = next(blocks_of(["x y z", "", "idiot | SHOUT"]))
    doc, x = quality_classifier.passages(block)
    assert doc.tolist() == [0, 1, 2] and np.isfinite(x).all()


def test_attention_gradients_match_differences():
    random = np.random.default_rng(1)
    shapes = {"encode": (7, 5), "encode0": (5,), "v": (5, 3), "u": (5, 3), "a": (3,), "out": (5,), "out0": (1,)}
    w = {k: random.normal(size=s) for k, s in shapes.items()}
    x, doc = random.normal(size=(11, 7)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3, 3, 3])
    y, weight = np.array([1.0, 0, 0, 1]), np.array([0.1, 0.4, 0.2, 0.3])

    def loss():
        p = quality_classifier._forward(w, x, doc, 4)["p"]
        return -(weight * np.log(np.where(y > 0, p, 1 - p))).sum() + 0.5e-4 * (w["encode"] ** 2).sum()

    found = quality_classifier._gradients(w, x, doc, 4, y, weight)
    for name, value in w.items():
        for at in np.ndindex(value.shape):
            kept, sides = value[at], []
            for step in (1e-5, -1e-5):
                value[at] = kept + step
                sides.append(loss())
            value[at] = kept
            assert found[name][at] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-7), name


def test_separable_bags_are_told_apart():
    rows = [("clean text here " * 60 + ("| | ! ! " * 20 if i % 2 else ""), i % 2) for i in range(40)]
    model = quality_classifier.fit(rows)
    p = np.concatenate([quality_classifier.score_block(model, b)[0] for b in blocks_of([t for t, _ in rows])])
    assert ((p > 0.5) == [bool(y) for _, y in rows]).all()


def test_samples_are_bounded_and_stable(spark):
    rows = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    one, two = (sample_by_class(rows, "label", 100).collect() for _ in range(2))
    assert one == two and len(one) <= 400
    assert {r.label for r in one} == {0, 1}
    sample = labelled_sample(documents(spark, trained_texts()), labels(spark).union(spark.sql("select null, 1, null")), "toxic", fold("doc_id", 4) != 2, 50)
    assert {y for _, y in sample} == {0, 1} and len(sample) < 40


RULES = [url_filter.rule(t, v) for t, v in (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))]


def plain_rule(url):
    head, found, rest = (url or "").partition("://")
    cut = lambda text, marks: text[: min([len(text), *(text.index(m) for m in marks if m in text)])]
    host = cut(rest, "/?#") if found else ""
    path = cut(rest[len(host) :], "?#")
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: (len(r.text), r.verdict == "block"), default=None)
    return host, path, best and best.text, best and best.verdict


def test_rules_on_urls(spark):
    urls = ["http://a.example.org/es/1", "HTTPS://Example.ORG/en/15?x#y", "http://b.com/fr/2", "http://com/de/9", "http://acom/de/9", "http://x.org", None, "no scheme",
            "http://x.org?y=/en", "a://b.com/fr/://z", "http://é.com/de/ü", "", "http://u@x.com:80/de/"]
    frame = clashing(spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string"))
    model = url_filter.fit([("a.com", "/bad/x", 1), ("b.com", "/good/y", 0)] * 5)
    for r in url_filter.judge(frame, RULES, model, ["page_id"]).collect():
        host, path, text, verdict = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, text)
        assert r.verdict == (verdict or ("block" if r.block_score >= 0.5 else "allow"))
    assert url_filter.judge(frame.limit(0), [], model, ["page_id"]).count() == 0
    with pytest.raises(ValueError):
        url_filter.judge(frame, RULES * 101, model, ["page_id"])


def test_url_classifier_learns_from_a_small_table(spark):
    rows = [(f"http://h{i}.example/{'casino' if i % 2 else 'science'}/{i}", i % 2) for i in range(60)]
    model = url_filter.train(spark.createDataFrame([*rows, (None, 1), ("http://x.example/", None)], "url string, label int"))
    test = spark.createDataFrame([(1, "http://new.example/casino/x"), (2, "http://new.example/science/x")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_filter.judge(test, [], model, ["page_id"]).collect()} == {1: "block", 2: "allow"}

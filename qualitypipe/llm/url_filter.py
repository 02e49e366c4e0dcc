"""URL filter: rules on host and path, and logistic regression on hashed character n-grams for the rest.

A rule is (host, path, verdict). It fits its host and all subdomains if the URL's path starts with the rule's; the longest rule
(host and path together) wins, of equal ones the blocking one, then the first in order. URLs that no rule fits get the
verdict of the classifier, which learns from a small table of labelled URLs.

Defined results: a null URL, or one without ``://``, has an empty host and path; no rule fits it, and the
classifier judges the empty text. Without labelled URLs of both verdicts the classifier says the verdict that occurs, else allow.
Repeated rows each get their row; only the columns named are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitypipe.llm.shared import Adam, Block, blocks, blocks_of, mix, sigmoid

DIMENSIONS = 1 << 14
ORDERS = (2, 3, 4, 5)
MOST_RULES = 500
#: Between host and path in the classifier's text; it occurs in no URL that a browser takes.
_BAR = "\x01"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def rule(text: str, verdict: str) -> Rule:
    host, slash, path = text.partition("/")
    return Rule(host.lower(), slash + path, verdict)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)


def matched(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the rule that wins, null if none fits. A case expression, so rules are limited in number."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    if not rules:
        return text, verdict
    order = sorted(rules, key=lambda r: (-len(r.text), r.verdict != "block"))
    fits = [((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path) for r in order]
    text, verdict = (F.when(fits[0], F.lit(getattr(order[0], what))) for what in ("text", "verdict"))
    for fit_, r in zip(fits[1:], order[1:], strict=True):
        text, verdict = text.when(fit_, F.lit(r.text)), verdict.when(fit_, F.lit(r.verdict))
    return text, verdict


@dataclass
class UrlModel:
    weights: np.ndarray | None  # of n-grams, then the constant
    share: float  # of blocked URLs


def _slots(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Document and slot of every n-gram; each n-gram also with its side of the bar."""
    docs, slots = [], []
    data = block.data.astype(np.uint64)
    path_side = np.cumsum(block.data == 1)
    before = np.concatenate([[0], path_side])[block.start]
    side = (path_side - before[block.doc] > 0).astype(np.uint64)
    code = data
    for n in ORDERS:
        if len(data) < n:
            break
        code = (data if n == 2 else code)[:-1] * np.uint64(257) + data[n - 1 :]
        same = block.doc[: len(code)] == block.doc[n - 1 :]
        docs.append(block.doc[: len(code)][same])
        slots.append((mix(code * np.uint64(8) + np.uint64(n) + side[: len(code)] * np.uint64(1 << 60)) >> np.uint64(64 - 14)).astype(np.int64)[same])
    return np.concatenate(docs or [np.zeros(0, np.int64)]), np.concatenate(slots or [np.zeros(0, np.int64)])


def _margin(weights: np.ndarray, block: Block, doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
    total = np.bincount(doc, weights=weights[slot], minlength=block.size)
    return total / np.sqrt(np.maximum(np.bincount(doc, minlength=block.size), 1)) + weights[-1]


def fit(rows: list[tuple[str, str, int]], steps: int = 150) -> UrlModel:
    """rows: (host, path, 1 to block or 0 to allow)."""
    y = np.array([float(label) for _, _, label in rows])
    share = float(y.mean()) if len(y) else 0.0
    if len(set(y)) < 2:
        return UrlModel(None, share)
    parts = [(b, *_slots(b)) for b in blocks_of([host + _BAR + path for host, path, _ in rows])]
    w = {"w": np.zeros(DIMENSIONS + 1)}
    adam = Adam(w, 0.05)
    for _ in range(steps):
        gradient, at = 1e-5 * w["w"], 0
        for block, doc, slot in parts:
            slope = (sigmoid(_margin(w["w"], block, doc, slot)) - y[at : at + block.size]) / len(y)
            scaled = slope / np.sqrt(np.maximum(np.bincount(doc, minlength=block.size), 1))
            gradient += np.bincount(slot, weights=scaled[doc], minlength=DIMENSIONS + 1)
            gradient[-1] += slope.sum()
            at += block.size
        adam.step({"w": gradient})
    return UrlModel(w["w"], share)


def predict(model: UrlModel, block: Block) -> np.ndarray:
    if model.weights is None:
        return np.full(block.size, model.share)
    return sigmoid(_margin(model.weights, block, *_slots(block)))


def train(labelled: DataFrame) -> UrlModel:
    """labelled: url and label (1 block, 0 allow), a small table; repeated URLs count once for each label."""
    host, path = host_and_path(F.col("url"))
    rows = labelled.filter("url is not null and label is not null").select(host.alias("host"), path.alias("path"), "label").distinct()
    return fit([tuple(r) for r in rows.orderBy("host", "path", "label").collect()])


def judge(urls: DataFrame, rules: list[Rule], model: UrlModel, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with host, path, rule, verdict (allow or block) and ``block_score`` of the classifier."""
    host, path = host_and_path(F.col("url"))
    source = urls.select(*keep, host.alias("_host"), path.alias("_path"))
    rule_text, rule_verdict = matched(F.col("_host"), F.col("_path"), rules)
    source = source.select(
        *keep, F.col("_host").alias("host"), F.col("_path").alias("path"), rule_text.alias("rule"), rule_verdict.alias("verdict"),
        F.concat("_host", F.lit(_BAR), "_path").cast("binary").alias("_text"),
    )
    schema = source.drop("_text").schema.add("block_score", "double")

    def score(batches):
        for block in blocks(batches, "_text"):
            columns = [block.rows.column(c) for c in schema.names[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(predict(model, block))], names=schema.names)

    scored = source.mapInArrow(score, schema)
    own = F.when(F.col("block_score") >= 0.5, "block").otherwise("allow")
    return scored.withColumn("verdict", F.coalesce("verdict", own))


def labelled_by_rules(urls: DataFrame, rules: list[Rule], most: int = 4000) -> DataFrame:
    """A small table of labelled URLs: at most ``most`` distinct ones that a rule decides, chosen by hash."""
    host, path = host_and_path(F.col("url"))
    _, verdict = matched(host, path, rules)
    rows = urls.select("url", verdict.alias("verdict")).filter("verdict is not null").distinct()
    return rows.orderBy(F.xxhash64("url"), "url").limit(most).select("url", (F.col("verdict") == "block").cast("int").alias("label"))

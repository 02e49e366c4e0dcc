"""Language identification by error-correcting output codes.

Each language has a codeword of bits. One binary classifier per bit, logistic regression on hashed byte
n-grams, predicts it; the language whose codeword costs least, with each bit's loss weighted by how
reliable its classifier is, wins. A small distance between the two cheapest codewords marks a text as
ambiguous.

Defined results: a text that is null or has no letter is ``und`` with score 0; so is every text if there is
nothing to learn from. Texts are read whole, in blocks of bounded size. Repeated rows each get their row.
Only the id, text and label columns are read, so other columns may have any name.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitypipe.llm.shared import Adam, Block, blocks, blocks_of, gives_back, leaves_little, sample_by_class

DIMENSIONS = 1 << 13
ORDERS = (1, 2, 3, 4)

#: Letters of any language stay, ASCII ones in lower case; everything else in ASCII becomes a space.
_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[65:91] += 32
_LETTERS[[b for b in range(128) if not chr(b).isalpha()]] = 32


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits, of -1 and 1
    weights: np.ndarray  # dimensions + 1 (constant) x bits
    trust: np.ndarray  # of each bit


def codewords(n: int, max_bits: int = 24) -> np.ndarray:
    """n codewords: all useful splits for up to 5 languages, else random ones of the best distance found."""
    if n <= 5:
        splits = [s for s in itertools.product((-1, 1), repeat=n) if s[0] == 1 and -1 in s]
        return np.array(splits, dtype=np.float32).T if splits else np.ones((n, 1), dtype=np.float32)
    bits = max(max_bits, int(4 * np.ceil(np.log2(n))))
    random = np.random.default_rng(7)
    found, distance = None, -1
    for _ in range(64):
        codes = random.choice(np.array([-1, 1], dtype=np.float32), size=(n, bits))
        gram = codes @ codes.T - 4 * bits * np.eye(n)
        least = (bits - gram.max()) / 2
        if least > distance and (np.abs(codes.sum(0)) < n).all():
            found, distance = codes, least
    return found


def features(block: Block) -> np.ndarray:
    """Square roots of hashed n-gram counts, one row per document of unit length."""
    data = _LETTERS[block.data].astype(np.uint32)
    out = np.zeros((block.size, DIMENSIONS), dtype=np.float32)
    # short runs of documents keep the counters in the cache
    for at in range(0, block.size, 64):
        to = min(at + 64, block.size)
        low, high = block.start[at], block.end[to - 1]
        part, doc = data[low:high], block.doc[low:high] - at
        counts = np.zeros((to - at) * DIMENSIONS, dtype=np.int64)
        code = np.zeros(len(part), dtype=np.uint32)
        for n in ORDERS:
            if len(part) < n:
                break
            code = code[: len(part) - n + 1] * np.uint32(257) + part[n - 1 :]
            slot = (code * np.uint32(2654435761) + np.uint32(n * 40503)) * np.uint32(2246822519) >> np.uint32(19)
            same = doc[: len(slot)] == doc[n - 1 :]
            counts += np.bincount((doc[: len(slot)] * DIMENSIONS + slot)[same], minlength=len(counts))
        out[at:to] = np.sqrt(counts).reshape(to - at, DIMENSIONS)
    out /= np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-9)
    return out


def fit(rows: list[tuple[str, str]], steps: int = 120) -> LanguageModel:
    """rows: (text, language). One logistic classifier per bit, all by the same gradient steps."""
    languages = sorted({language for _, language in rows})
    if not languages:
        return LanguageModel([], np.zeros((0, 0)), np.zeros((DIMENSIONS + 1, 0)), np.zeros(0))
    codes = codewords(len(languages))
    x, at = np.empty((len(rows), DIMENSIONS), dtype=np.float32), 0
    for block in blocks_of([text for text, _ in rows]):
        x[at : at + block.size] = features(block)
        at += block.size
    which = np.array([languages.index(language) for _, language in rows])
    target = codes[which]
    share = (1.0 / np.bincount(which, minlength=len(languages)))[which, None].astype(np.float32)
    share /= share.sum()
    model = {"w": np.zeros((DIMENSIONS, codes.shape[1]), np.float32), "b": np.zeros(codes.shape[1], np.float32)}
    adam = Adam(model, 0.15)
    for _ in range(steps):
        margin = x @ model["w"] + model["b"]
        slope = -target * share / (1 + np.exp(np.clip(target * margin, -30, 30)))
        adam.step({"w": x.T @ slope + 1e-6 * model["w"], "b": slope.sum(0)})
    right = (share * ((x @ model["w"] + model["b"]) * target > 0)).sum(0)
    right = np.clip(right, 0.5, 0.999)
    trust = np.maximum(np.log(right / (1 - right)), 1e-3)
    return LanguageModel(languages, codes, np.vstack([model["w"], model["b"]]), trust / trust.mean())


def decode(model: LanguageModel, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language of each row, its probability, and the lead over the second in bits of loss."""
    margin = x @ model.weights[:-1] + model.weights[-1]
    loss = np.stack([(model.trust * np.logaddexp(0, -margin * code)).sum(1) for code in model.codes], axis=1)
    p = np.exp(loss.min(1, keepdims=True) - loss)
    p /= p.sum(1, keepdims=True)
    best = loss.argmin(1)
    lead = np.partition(loss, 1, axis=1)[:, 1] - loss.min(1) if loss.shape[1] > 1 else np.full(len(x), np.inf)
    return best, p[np.arange(len(x)), best], lead


@gives_back
def train(docs: DataFrame, keep: Column, per_language: int = 400) -> LanguageModel:
    """Fits on at most ``2 * per_language`` documents for each language, from rows where ``keep`` holds."""
    rows = docs.filter(keep).select("text", "lang").filter("text is not null and lang is not null")
    return fit([(r.text, r.lang) for r in sample_by_class(rows, "lang", per_language).collect()])


def identify(docs: DataFrame, model: LanguageModel, keep: list[str], text: str = "text", min_lead: float = 1.0) -> DataFrame:
    """The columns ``keep`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``."""
    own = [] if text in keep else [text]
    source = docs.select(*keep, *own, F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")

    @leaves_little
    def predict(batches):
        for block in blocks(batches, text):
            letters = np.array(block.rows.column("_letters"))
            if model.languages:
                best, score, lead = decode(model, features(block))
                names = [model.languages[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
                score, close = np.where(letters, score, 0.0), (lead < min_lead) | ~letters
            else:
                names, score, close = ["und"] * block.size, np.zeros(block.size), np.ones(block.size, bool)
            columns = [block.rows.column(c) for c in keep]
            columns += [pa.array(names, pa.string()), pa.array(score.astype(float)), pa.array(close)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(predict, schema)

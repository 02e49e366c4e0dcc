"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of 512 bytes. Each passage is encoded from the bigrams of its byte classes and from how
often its words and three-word windows repeat; gated attention weighs the passages, the weighted sum is the
representation of the document, and a logistic unit scores it. Encoder, attention and unit are
learned together from document labels.

Defined results: a null or empty text has one empty passage and so the score of such a bag; with
labels of one class only, every score is that class's share; without labels it is 0.5. Whole texts are scored, in
blocks; repeated rows each get their row; only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from qualitypipe.llm.shared import Adam, Block, blocks, blocks_of, gives_back, lower_bytes, mix, sigmoid

PASSAGE_BYTES = 512
HIDDEN, GATE = 24, 12

#: Classes of bytes whose bigrams are counted: letters by case, digits, white space, each ASCII sign, and bytes of other letters.
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CLASS = np.zeros(256, dtype=np.int64)
_CLASS[[ord(c) for c in "abcdefghijklmnopqrstuvwxyz"]] = 1
_CLASS[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"]] = 2
_CLASS[[ord(c) for c in "0123456789"]] = 3
_CLASS[[32, 9]] = 4
_CLASS[10] = 5
_CLASS[128:] = 6
for _i, _c in enumerate(_SIGNS):
    _CLASS[ord(_c)] = 7 + _i
CLASSES = 7 + len(_SIGNS)
WIDTH = CLASSES * CLASSES + 4


@dataclass
class QualityModel:
    share: float  # of label 1, used alone if there is nothing to tell apart
    centre: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray] | None


def _repeated(keys: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Whether a key occurs more than once in its group."""
    if not len(keys):
        return np.zeros(0, dtype=bool)
    _, which, count = np.unique(mix(keys + groups.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    return count[which] > 1


def passages(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(document of each passage, its features); a document has one passage at least."""
    per_doc = np.maximum(1, -(-(block.end - block.start) // PASSAGE_BYTES))
    first = np.concatenate([[0], np.cumsum(per_doc)])
    doc = np.repeat(np.arange(block.size), per_doc)
    x = np.zeros((first[-1], WIDTH), dtype=np.float32)
    if not len(block.data):
        return doc, x
    passage = first[block.doc] + (np.arange(len(block.data)) - block.start[block.doc]) // PASSAGE_BYTES
    classes = _CLASS[block.data]
    if len(classes) > 1:
        pairs = CLASSES * classes[:-1] + classes[1:]
        inside = block.doc[:-1] == block.doc[1:]
        slots = (passage[:-1] * (CLASSES * CLASSES) + pairs)[inside]
        counts = np.bincount(slots, minlength=first[-1] * CLASSES * CLASSES).reshape(first[-1], -1)
        x[:, :-4] = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    word_doc, begin, stop = block.words()
    if len(begin):
        hashes = block.word_hashes(begin, stop, lower_bytes(block.data))
        at = passage[begin]
        n = np.maximum(np.bincount(at, minlength=first[-1]), 1)
        share = lambda mask: np.bincount(at[: len(mask)], weights=mask, minlength=first[-1]) / n
        again = np.zeros(len(begin), dtype=bool)
        again[1:] = (hashes[1:] == hashes[:-1]) & (word_doc[1:] == word_doc[:-1])
        x[:, -4] = share(again)
        x[:, -3] = share(_repeated(hashes, at))
        if len(begin) > 2:
            windows = mix(hashes[:-2] * np.uint64(3) ^ mix(hashes[1:-1] * np.uint64(5) ^ mix(hashes[2:])))
            x[:, -2] = share(_repeated(windows, word_doc[:-2]) & (word_doc[:-2] == word_doc[2:]))
        x[:, -1] = np.bincount(at, weights=stop - begin, minlength=first[-1]) / n / 16
    return doc, x


def _forward(w: dict[str, np.ndarray], x: np.ndarray, doc: np.ndarray, n: int) -> dict[str, np.ndarray]:
    h = np.maximum(x @ w["encode"] + w["encode0"], 0)
    tanh, gate = np.tanh(h @ w["v"]), sigmoid(h @ w["u"])
    energy = (tanh * gate) @ w["a"]
    top = np.full(n, -np.inf, dtype=energy.dtype)
    np.maximum.at(top, doc, energy)
    attention = np.exp(energy - top[doc])
    attention /= np.bincount(doc, weights=attention, minlength=n)[doc]
    bag = np.zeros((n, h.shape[1]), dtype=np.float64)
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])  # documents are in a row, and each has a passage
    bag[:] = np.add.reduceat(attention[:, None] * h, starts, axis=0)
    return {"h": h, "tanh": tanh, "gate": gate, "attention": attention, "bag": bag, "p": sigmoid(bag @ w["out"] + w["out0"])}


def _gradients(w: dict[str, np.ndarray], x: np.ndarray, doc: np.ndarray, n: int, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
    """Slopes of the weighted log loss, with a small ridge on the encoder."""
    f = _forward(w, x, doc, n)
    error = ((f["p"] - y) * weight).astype(x.dtype)
    d_bag = error[:, None] * w["out"]
    d_h = f["attention"][:, None] * d_bag[doc]
    d_attention = (f["h"] * d_bag[doc]).sum(1)
    mean = np.bincount(doc, weights=f["attention"] * d_attention, minlength=n)[doc]
    d_energy = (f["attention"] * (d_attention - mean)).astype(x.dtype)
    d_gated = d_energy[:, None] * w["a"]
    d_v = d_gated * f["gate"] * (1 - f["tanh"] ** 2)
    d_u = d_gated * f["tanh"] * f["gate"] * (1 - f["gate"])
    d_h = (d_h + d_v @ w["v"].T + d_u @ w["u"].T) * (f["h"] > 0)
    gradients = {"encode": x.T @ d_h + 1e-4 * w["encode"], "encode0": d_h.sum(0), "v": f["h"].T @ d_v, "u": f["h"].T @ d_u}
    return gradients | {"a": (f["tanh"] * f["gate"]).T @ d_energy, "out": f["bag"].T.astype(x.dtype) @ error, "out0": error.sum(keepdims=True)}


@gives_back
def fit(rows: list[tuple[str, int]], steps: int = 120) -> QualityModel:
    """rows: (text, label). Classes weigh as often as they occur in the rows given."""
    y = np.array([float(label == 1) for _, label in rows])
    share = float(y.mean()) if len(y) else 0.5
    blank = np.zeros(WIDTH, dtype=np.float32)
    if len(set(y)) < 2:
        return QualityModel(share, blank, blank + 1, None)
    docs, parts, n = [], [], 0
    for block in blocks_of([text for text, _ in rows]):
        doc, x = passages(block)
        docs.append(doc + n)
        parts.append(x)
        n += block.size
    doc, x = np.concatenate(docs), np.concatenate(parts)
    centre, scale = x.mean(0), np.maximum(x.std(0), 0.02)
    x = np.clip((x - centre) / scale, -8, 8).astype(np.float32)
    random = np.random.default_rng(11)
    draw = lambda *shape: (random.normal(size=shape) / np.sqrt(shape[0])).astype(np.float32)
    w = {"encode": draw(WIDTH, HIDDEN), "encode0": np.zeros(HIDDEN, np.float32), "v": draw(HIDDEN, GATE), "u": draw(HIDDEN, GATE)}
    w |= {"a": draw(GATE), "out": draw(HIDDEN), "out0": np.zeros(1, np.float32)}
    adam = Adam(w, 0.01)
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    for _ in range(steps):
        adam.step({k: g.astype(np.float32) for k, g in _gradients(w, x, doc, n, y, weight).items()})
    # the classes were weighed alike; the constant brings back their shares
    w["out0"] = w["out0"] + np.float32(np.log(share / (1 - share)))
    return QualityModel(share, centre, scale, w)


def score_block(model: QualityModel, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Score, number of passages, and weight of the passage that counts most, of each document."""
    doc, x = passages(block)
    number = np.bincount(doc, minlength=block.size)
    if model.weights is None:
        return np.full(block.size, model.share), number, 1.0 / number
    x = np.clip((x - model.centre) / model.scale, -8, 8)
    f = _forward(model.weights, x, doc, block.size)
    most = np.zeros(block.size)
    np.maximum.at(most, doc, f["attention"])
    return f["p"], number, most


def score(docs: DataFrame, model: QualityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score`` (0 to 1), ``n_passages`` and ``top_attention``."""
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)
    schema = docs.select(*keep).schema.add("score", "double").add("n_passages", "long").add("top_attention", "double")

    def apply(batches):
        for block in blocks(batches, text, limit=1 << 20):
            p, number, most = score_block(model, block)
            columns = [block.rows.column(c) for c in keep]
            columns += [pa.array(p.astype(float)), pa.array(number.astype(np.int64)), pa.array(most.astype(float))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(apply, schema)

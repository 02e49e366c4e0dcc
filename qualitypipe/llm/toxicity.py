"""Toxicity: a linear-chain conditional random field that tags toxic tokens.

Two states, clean and toxic. Tokens are runs of letters and digits, in lower case. A token's features are its whole form, its
beginnings of 3 to 6 bytes and its ending of 3; transitions join neighbours. Token labels come from labelled documents: a token of a toxic document
is labelled toxic if one of its features follows many different words there and next to none in clean documents.
Forward-backward gives each token's marginal. The marginals of a document, summed and at most,
give its score; runs of tokens over 0.5 are the offending spans.

Defined results: null and empty texts have no token and so the score of a document without toxic tokens;
without both labels to learn from, every score is the share of label 1 (0 without labels). Whole texts are tagged
with an exact blocked forward-backward whose memory is proportional to a block of documents. Repeated rows each get
their row; only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from qualitypipe.llm.shared import BLOCK_ROWS, Adam, Block, blocks, blocks_of, give_back, gives_back, leaves_little, lower_bytes, mix, sigmoid

SLOTS = 1 << 20
FEATURES = 7
_STEP = 32  # tokens in a row that are multiplied up before documents are joined
#: While fitting: bytes of a block, and tokens whose hashes are looked up or mixed at a time.
_FIT_BYTES, _PIECE = 1 << 18, 1 << 17
_WORD = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


@dataclass
class ToxicityModel:
    share: float
    weights: np.ndarray | None = None  # of features in state toxic; state clean has 0
    steps: np.ndarray | None = None  # transition weights, from x to
    start: np.ndarray | None = None
    document: np.ndarray | None = None  # constant, log(1 + sum of marginals), largest marginal


def token_slots(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per document, first and last+1 byte of each token, its hash, and the slots of its features."""
    data = lower_bytes(block.data)
    data[1:] |= (((block.data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) << 5).astype(np.uint8)
    doc, begin, stop = block.words(_WORD)
    slots = np.zeros((len(begin), FEATURES), dtype=np.int32)  # slot 0: the constant, and features a short token lacks
    whole = block.word_hashes(begin, stop, data)
    parts = [(begin, np.minimum(begin + n, stop)) for n in (3, 4, 5, 6)] + [(np.maximum(stop - 3, begin), stop)]
    hashes = [whole, *block.word_hashes_of(parts, data)]
    for k, h in enumerate(hashes):
        slot = (mix(h + np.uint64(k + 1)) >> np.uint64(64 - 20)).astype(np.int32)
        slots[:, k + 1] = np.where(stop - begin >= (0, 3, 4, 5, 6, 3)[k], np.maximum(slot, 1), 0)
    return np.bincount(doc, minlength=block.size), begin, stop, whole, slots


def marginals(emission: np.ndarray, lengths: np.ndarray, steps: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Probability of toxic for each token, documents in a row; with ``pairs`` also the expected transitions.

    Products of 2x2 matrices over runs of tokens are taken for all runs at once, then the runs of each document
    are chained, then the tokens within runs: the exact forward-backward in about length / 32 steps.
    """
    runs = -(-lengths // _STEP)
    total = int(runs.sum())
    if not total:
        return (np.zeros(0), np.zeros((2, 2)), np.zeros(2)) if pairs else np.zeros(0)
    first_run = np.cumsum(runs) - runs
    first_token = np.cumsum(lengths) - lengths
    position = np.repeat(first_run * _STEP - first_token, lengths) + np.arange(len(emission))
    row, column = position // _STEP, position % _STEP
    odds = np.ones((_STEP, total))  # of toxic against clean, by the emission
    odds[column, row] = np.exp(np.clip(emission, -20, 20))
    real = np.zeros((_STEP, total), dtype=bool)
    real[column, row] = True
    (m00, m01), (m10, m11) = np.exp(steps - steps.max())
    begin = np.exp(start - start.max())
    begin = begin / begin.sum()
    opening = first_run[runs > 0]

    # products of whole runs, rows by the state before the run; the last run of a document is never chained on
    p00, p01 = np.full(total, m00), m01 * odds[0]
    p10, p11 = np.full(total, m10), m11 * odds[0]
    p00[opening] = p10[opening] = begin[0]
    p01[opening] = p11[opening] = begin[1] * odds[0][opening]
    for t in range(1, _STEP):
        p00, p01 = p00 * m00 + p01 * m10, (p00 * m01 + p01 * m11) * odds[t]
        p10, p11 = p10 * m00 + p11 * m10, (p10 * m01 + p11 * m11) * odds[t]
        if t % 8 == 7:
            scale = 1 / (p00 + p01 + p10 + p11)
            p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale

    order = np.argsort(-runs, kind="stable")
    longest = int(runs.max())
    alive = np.searchsorted(-runs[order], -np.arange(longest + 1), side="left")  # documents with more than k runs
    left0, left1 = np.full(total, 0.5), np.full(total, 0.5)
    a0, a1 = np.full(len(lengths), 0.5), np.full(len(lengths), 0.5)
    for k in range(longest - 1):
        who = order[: alive[k + 1]]
        at = first_run[who] + k
        b0, b1 = a0[who] * p00[at] + a1[who] * p10[at], a0[who] * p01[at] + a1[who] * p11[at]
        a0[who] = left0[at + 1] = b0 / (b0 + b1)
        a1[who] = left1[at + 1] = b1 / (b0 + b1)

    # the last run of each document goes backward token by token, as it may be short; the others by their product
    def back(t: int, r0: np.ndarray, r1: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return m00 * r0 + m01 * o * r1, m10 * r0 + m11 * o * r1

    right0, right1 = np.ones(total), np.ones(total)
    a0[:], a1[:] = 0.5, 0.5
    closing = (first_run + runs - 1)[runs > 0]
    r0, r1 = np.full(len(closing), 0.5), np.full(len(closing), 0.5)
    for t in range(_STEP - 1, -1, -1):
        b0, b1 = back(t, r0, r1, odds[t][closing])
        inside = real[t][closing]
        scale = 1 / (b0 + b1)
        r0, r1 = np.where(inside, b0 * scale, r0), np.where(inside, b1 * scale, r1)
    a0[runs > 0], a1[runs > 0] = r0, r1
    for k in range(longest - 2, -1, -1):
        # of documents with a run after k, the message at the end of run k
        who = order[: alive[k + 1]]
        at = first_run[who] + k
        right0[at], right1[at] = a0[who], a1[who]
        b0, b1 = p00[at] * a0[who] + p01[at] * a1[who], p10[at] * a0[who] + p11[at] * a1[who]
        a0[who], a1[who] = b0 / (b0 + b1), b1 / (b0 + b1)

    toxic = np.empty((_STEP, total))
    after0, after1 = np.empty((_STEP, total)), np.empty((_STEP, total))
    r0, r1 = right0, right1
    for t in range(_STEP - 1, -1, -1):
        after0[t], after1[t] = r0, r1
        b0, b1 = back(t, r0, r1, odds[t])
        scale = 1 / (b0 + b1)
        r0, r1 = np.where(real[t], b0 * scale, r0), np.where(real[t], b1 * scale, r1)
    expected, opened = np.zeros((2, 2)), np.zeros(2)
    f0, f1 = left0, left1
    for t in range(_STEP):
        g0, g1 = f0 * m00 + f1 * m10, (f0 * m01 + f1 * m11) * odds[t]
        if t == 0:
            g0[opening], g1[opening] = begin[0], begin[1] * odds[0][opening]
        on, off = g1 * after1[t], g0 * after0[t]
        sums = on + off
        toxic[t] = on / sums
        if pairs:
            inner = real[t].copy()
            if t == 0:
                inner[opening] = False
                opened += [(off[opening] / sums[opening]).sum(), (on[opening] / sums[opening]).sum()]
            z = inner / sums
            expected[0, 0] += (f0 * m00 * after0[t] * z).sum()
            expected[0, 1] += (f0 * m01 * odds[t] * after1[t] * z).sum()
            expected[1, 0] += (f1 * m10 * after0[t] * z).sum()
            expected[1, 1] += (f1 * m11 * odds[t] * after1[t] * z).sum()
        scale = 1 / (g0 + g1)
        f0, f1 = g0 * scale, g1 * scale
    found = toxic[column, row]
    return (found, expected, opened) if pairs else found


@gives_back
def marked_types(slot: np.ndarray, which: np.ndarray, pairs: np.ndarray, toxic: np.ndarray, least_count: int, least_score: float = 3.7) -> np.ndarray:
    """Whether a token, by its type, has a feature that tells toxic documents; ``pairs`` is a hash of each token and the one before it.

    A feature counts once for each word it follows, so that copies of a document count once.
    """
    counts = []
    for label in (False, True):
        here = np.flatnonzero(toxic == label)
        _, first = np.unique(pairs[here], return_index=True)
        by_type = np.bincount(which[here[first]], minlength=len(slot))
        counts.append((sum(np.bincount(slot[:, k], weights=by_type, minlength=SLOTS) for k in range(1, FEATURES)), len(first)))
    (clean, n_clean), (found, n_found) = counts
    odds = np.log((found + 0.5) / (n_found + 1)) - np.log((clean + 0.5) / (n_clean + 1))
    marked = (found >= least_count) & (odds >= least_score)
    marked[0] = False
    return marked[slot].any(1)


@gives_back
def _types(rows: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens per document, type of each token, a hash of each token with the one before it, and the slots of each type."""
    lengths, hashes, known, known_slots = [], [], [], []
    # few texts are encoded at a time, and their types join those known
    for at in range(0, len(rows), BLOCK_ROWS):
        for block in blocks_of([text for text, _ in rows[at : at + BLOCK_ROWS]], _FIT_BYTES):
            n, _, _, found, slots = token_slots(block)
            names, first = np.unique(found, return_index=True)
            lengths.append(n)
            hashes.append(found)
            known.append(names)
            known_slots.append(slots[first])
        names, first = np.unique(np.concatenate(known), return_index=True)
        slot = np.concatenate(known_slots)[first]
        known, known_slots = [names], [slot]
    del block, found, slots, first
    give_back()
    lengths, hashes = np.concatenate(lengths), np.concatenate(hashes)
    which = np.empty(len(hashes), dtype=np.int32)
    pairs = hashes * np.uint64(3)
    pairs[1:] += hashes[:-1]
    for at in range(0, len(hashes), _PIECE):
        which[at : at + _PIECE] = np.searchsorted(names, hashes[at : at + _PIECE])
        pairs[at : at + _PIECE] = mix(pairs[at : at + _PIECE])
    return lengths, which, pairs, slot


@gives_back
def fit(rows: list[tuple[str, int]], rounds: int = 20) -> ToxicityModel:
    """rows: (text, label of the document). Learns the field by gradient steps, then the document score."""
    y = np.array([float(label == 1) for _, label in rows])
    if len(set(y)) < 2:
        return ToxicityModel(float(y.mean()) if len(y) else 0.0)
    lengths, which, pairs, slot = _types(rows)
    toxic = np.repeat(y > 0, lengths)
    marked = marked_types(slot, which, pairs, toxic, least_count=max(5, int(0.005 * y.sum())))
    labels = (toxic & marked[which]).astype(np.int8)
    del pairs, toxic
    weight = np.where(y > 0, 1.0, y.sum() / max((1 - y).sum(), 1))
    inner = np.ones(len(which), dtype=bool)
    inner[(np.cumsum(lengths) - lengths)[lengths > 0]] = False
    seen = np.array([[np.count_nonzero((labels[:-1] == a) & (labels[1:] == b) & inner[1:]) for b in (0, 1)] for a in (0, 1)], dtype=float)
    opened = np.array([np.count_nonzero((labels == a) & ~inner) for a in (0, 1)], dtype=float)
    del inner
    w = {"token": np.zeros(SLOTS), "steps": np.log((seen + 1) / (seen + 1).sum()), "start": np.log((opened + 1) / (opened + 1).sum())}
    adam = Adam(w, 0.3)
    runs = _runs_of_documents(lengths)
    for _ in range(rounds):
        p, expected, opening = _all_marginals(w["token"][slot].sum(1), which, lengths, runs, w)
        p -= labels
        for docs, tokens in runs:
            p[tokens] *= np.repeat(weight[docs], lengths[docs])
        slope = np.bincount(which, weights=p, minlength=len(slot))
        del p
        token = sum(np.bincount(slot[:, k], weights=slope, minlength=SLOTS) for k in range(FEATURES))
        n = len(which)
        gradients = {"token": token / n + 1e-7 * w["token"], "steps": (expected - seen) / n, "start": (opening - opened) / n}
        adam.step({k: g if k == "token" else 0.1 * g for k, g in gradients.items()})
    model = ToxicityModel(float(y.mean()), w["token"].astype(np.float32), w["steps"], w["start"])
    p, _, _ = _all_marginals(w["token"][slot].sum(1), which, lengths, runs, w)
    model.document = _logistic(_summary(p, lengths), y)
    return model


def _runs_of_documents(lengths: np.ndarray, most: int = 200_000) -> list[tuple[slice, slice]]:
    """Documents and tokens of runs of about ``most`` tokens, so that the memory of a step stays small."""
    ends = np.cumsum(lengths)
    out, at = [], 0
    while at < len(lengths):
        before = ends[at] - lengths[at]
        to = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        out.append((slice(at, to), slice(int(before), int(ends[to - 1]))))
        at = to
    return out


def _all_marginals(by_type: np.ndarray, which: np.ndarray, lengths: np.ndarray, runs, w: dict[str, np.ndarray]):
    """``marginals`` with pairs, run after run."""
    p, expected, opening = np.empty(len(which)), np.zeros((2, 2)), np.zeros(2)
    for docs, tokens in runs:
        found = marginals(by_type[which[tokens]], lengths[docs], w["steps"], w["start"], pairs=True)
        p[tokens] = found[0]
        expected += found[1]
        opening += found[2]
    return p, expected, opening


def _summary(p: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One row per document: 1, log(1 + expected toxic tokens), largest marginal."""
    out = np.zeros((len(lengths), 3))
    out[:, 0] = 1
    some = lengths > 0
    if some.any():
        starts = (np.cumsum(lengths) - lengths)[some]
        out[some, 1] = np.log1p(np.add.reduceat(p, starts))
        out[some, 2] = np.maximum.reduceat(p, starts)
    return out


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Newton steps with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(25):
        p = sigmoid(x @ w)
        curve = (x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(x.shape[1])
        w -= np.linalg.solve(curve, x.T @ (p - y) + 0.05 * w)
    return w


def score_block(model: ToxicityModel, block: Block) -> tuple[np.ndarray, list[list[dict]]]:
    """Scores and offending spans of each document: start and end in code points, and the largest marginal."""
    spans: list[list[dict]] = [[] for _ in range(block.size)]
    if model.weights is None:
        return np.full(block.size, model.share), spans
    lengths, begin, stop, _, slots = token_slots(block)
    p = marginals(model.weights[slots].sum(1, dtype=np.float64), lengths, model.steps, model.start)
    hits = np.flatnonzero(p > 0.5)
    doc = np.repeat(np.arange(block.size), lengths)
    # code points before each byte of the block, counted once
    before = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)]) if len(hits) else np.zeros(1, np.int64)
    for k, hit in enumerate(hits):
        d = doc[hit]
        points = [int(before[at] - before[block.start[d]]) for at in (begin[hit], stop[hit])]
        if k and hits[k - 1] == hit - 1 and doc[hit - 1] == d:
            spans[d][-1]["end_at"], spans[d][-1]["p"] = points[1], max(spans[d][-1]["p"], float(p[hit]))
        else:
            spans[d].append({"start_at": points[0], "end_at": points[1], "p": float(p[hit])})
    return sigmoid(_summary(p, lengths) @ model.document), spans


SPANS = T.ArrayType(T.StructType().add("start_at", "integer").add("end_at", "integer").add("p", "double"))


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` with ``score`` (0 to 1), ``spans`` and ``n_spans``."""
    source = docs.select(*keep) if text in keep else docs.select(*keep, text)
    schema = docs.select(*keep).schema.add("score", "double").add("spans", SPANS).add("n_spans", "integer")
    kind = pa.list_(pa.struct([("start_at", pa.int32()), ("end_at", pa.int32()), ("p", pa.float64())]))

    @leaves_little
    def apply(batches):
        for block in blocks(batches, text, limit=1 << 20):
            p, spans = score_block(model, block)
            columns = [block.rows.column(c) for c in keep]
            columns += [pa.array(p), pa.array(spans, kind), pa.array([len(s) for s in spans], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return source.mapInArrow(apply, schema)

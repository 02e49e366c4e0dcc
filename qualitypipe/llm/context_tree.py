"""Language-model scoring by context-tree weighting.

Texts are bytes (A-Z lower-cased) after an end mark and closed by one. The next byte is coded as eight binary decisions;
for each decision there is a context tree over the preceding bytes. Every node estimates its bit by Krichevsky-Trofimov counts, and
a node's weighted probability is half its own estimate's and half the product of its children's. Every context of up to ``DEPTH``
bytes that a training byte follows is a node, however rare it is and however many there are. A text's score is the sum of log10 of
the weighted predictions.

Contexts with the following byte are counted by a shuffle. Those that share their nearest bytes lie in one task, which weights them from
the leaves up; the sums of contexts of ``HEAD`` bytes, at most 256 ** HEAD whatever the corpus, meet in the driver, which weights the rest. In a
second pass over the same table the tasks go from the root down and write log10 of the prediction for each context and byte that
occurs in any text. The most frequent of these, a bounded number, are looked up in the tasks; the others are joined.

Also the token baseline: log10 of add-0.1 unigram probabilities, over all training tokens. The most frequent tokens, a bounded
number, are looked up in the tasks; the others by a join on the token.

Defined results: null texts are empty and are scored as the end mark alone; without training rows all bytes are equally likely. Texts
are scored whole. Rows that repeat an id each get their row. Only id and text are read, so other columns may have any name.

``grow``, ``build`` and ``score_block`` hold a tree in the driver, with only the contexts that at least one in ``share`` bytes follows as nodes.
``score`` does not use them; they serve to compare with.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe.llm.shared import Block, blocks, lower_bytes, written

DEPTH = 5
SHARE = 65536
END = 0xFF  # occurs in no UTF-8 text
FREQUENT = 50_000
HEAD = 2  # bytes of the contexts that are weighted in the driver
LOOKED_UP = 2_000_000  # contexts with a byte, 16 bytes each
CHUNK = 200_000  # rows of contexts that are weighted at a time, and the rest of the last group


def byte_stream(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """All documents in a row, each with DEPTH end marks before and one behind; and where the documents begin."""
    size = block.end - block.start
    starts = np.concatenate([[0], np.cumsum(size + DEPTH + 1)])
    out = np.full(starts[-1], END, dtype=np.uint8)
    out[np.arange(len(block.data)) + (starts[:-1] + DEPTH - block.start)[block.doc]] = lower_bytes(block.data)
    return out, starts


def coded(stream: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions to predict: all but the DEPTH marks at the start of each document."""
    hit = np.ones(len(stream), dtype=bool)
    hit[(starts[:-1, None] + np.arange(DEPTH)).ravel()] = False
    return np.flatnonzero(hit)


def codes_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """DEPTH preceding bytes, the nearest lowest but one, then the byte itself, of all bytes; and where the documents begin."""
    stream, starts = byte_stream(block)
    at = coded(stream, starts)
    code = np.zeros(len(at), dtype=np.int64)
    for d in range(DEPTH, -1, -1):
        code = (code << 8) | stream[at - d]
    return code, np.concatenate([[0], np.cumsum(np.diff(starts) - DEPTH)])


def count_contexts(batches):
    """(code, n): codes of all texts, and how often in those to learn from (all, if there is no column ``_train``)."""
    codes, counts, kept = [], [], 0

    def merged() -> pa.RecordBatch:
        code, which = np.unique(np.concatenate(codes), return_inverse=True)
        n = np.bincount(which, weights=np.concatenate(counts)).astype(np.int64)
        codes[:], counts[:] = [code], [n]
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["code", "n"])

    for block in blocks(batches, "_text"):
        code, first = codes_of(block)
        learn = np.ones(block.size, dtype=bool)
        if "_train" in block.rows.schema.names:
            learn = block.rows.column("_train").to_numpy(zero_copy_only=False)
        learn = np.repeat(learn, np.diff(first))
        for some, weight in ((code[learn], 1), (code[~learn], 0)):
            found, n = np.unique(some, return_counts=True)
            codes.append(found)
            counts.append(n * weight)
            kept += len(found)
        if kept > 1_500_000:
            yield merged()
            codes.clear()
            counts.clear()
            kept = 0
    if codes:
        yield merged()


def count_tokens(batches):
    """(token, n) of lower-cased words; a task empties its counter when it has grown."""
    counter: Counter = Counter()

    def out() -> pa.RecordBatch:
        arrays = [pa.array(list(counter.keys()), pa.binary()), pa.array(list(counter.values()), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, names=["token", "n"])

    for batch in batches:
        for text in batch.column("_text"):
            counter.update((text.as_py() or b"").lower().split())
            if len(counter) > 300_000:
                yield out()
                counter.clear()
    yield out()


@dataclass
class Tree:
    """children: next node by node and preceding byte, for nodes that have any (the first rows); log10 of each byte by end point.

    A walk starts at node 0 and ends at a number from ``len(children)`` on, whose row in ``table`` is that much lower.
    """

    children: np.ndarray
    table: np.ndarray

    def after_two(self) -> np.ndarray:
        """Where the walk is after the two nearest bytes, by nearest + 256 * the other."""
        first = self.children[0]
        out = np.repeat(first[None, :], 256, axis=0)
        for nearest in np.flatnonzero(first < len(self.children)):
            out[:, nearest] = self.children[first[nearest]]
        return out.ravel()


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series, after four steps of the recursion."""
    shift = np.log(x * (x + 1) * (x + 2) * (x + 3))
    z = x + 4
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - shift


def bit_counts(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Zeros and ones of the 255 decisions of a byte, by the bits so far (1, 1x, 1xx and so on, less 1)."""
    zeros, ones = [], []
    for bits in range(8):
        by = counts.reshape(len(counts), 1 << bits, 2, -1).sum(3)
        zeros.append(by[:, :, 0])
        ones.append(by[:, :, 1])
    return np.concatenate(zeros, 1), np.concatenate(ones, 1)


def _in_parts(kind: type):
    """Applies to a few thousand rows at a time, which bounds the memory beside the result."""

    def decorate(function):
        def apply(rows: np.ndarray) -> np.ndarray:
            parts = [function(rows[at : at + 2048].astype(float)).astype(kind) for at in range(0, max(len(rows), 1), 2048)]
            return np.concatenate(parts)

        return apply

    return decorate


@_in_parts(np.float64)
def log_estimate(counts: np.ndarray) -> np.ndarray:
    a, b = bit_counts(counts)
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - log_gamma(a + b + 1.0) - np.log(np.pi)


@_in_parts(np.float32)
def chance_of_one(counts: np.ndarray) -> np.ndarray:
    a, b = bit_counts(counts)
    return (b + 0.5) / (a + b + 1.0)


@_in_parts(np.float32)
def byte_logs(one: np.ndarray) -> np.ndarray:
    """log10 of all 256 bytes from the chances of a one in each decision."""
    out = np.zeros((len(one), 1))
    at = 0
    for bits in range(8):
        p = one[:, at : at + (1 << bits)]
        out = (out[:, :, None] + np.log10(np.stack([1 - p, p], axis=2))).reshape(len(one), 2 << bits)
        at += 1 << bits
    return out


def build(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Tree:
    """levels: for each depth, (context, byte, n) of the contexts that are nodes; bytes of a context, the nearest lowest."""
    contexts, counts = [], []
    for context, byte, n in levels:
        names, which = np.unique(context, return_inverse=True)
        table = np.zeros((len(names), 256))
        np.add.at(table, (which, byte), n)
        contexts.append(names)
        counts.append(table)
    if not len(contexts[0]):
        return Tree(np.full((1, 256), 1, np.int32), np.full((1, 256), -np.log10(256), np.float32))
    depth = max(d for d in range(len(contexts)) if len(contexts[d]))
    # from the leaves up: log of weighted probabilities, and the weight of each node's own estimate
    own_weight: list[np.ndarray] = [np.ones(0, np.float32)] * (depth + 1)
    parents, rest = [np.zeros(0, np.int64)] * (depth + 1), [np.zeros(0)] * (depth + 1)
    below = np.zeros(0)
    for d in range(depth, -1, -1):
        estimate = log_estimate(counts[d])
        weighted = estimate.copy()
        own = np.ones(estimate.shape, np.float32)
        if d < depth:
            up = np.searchsorted(contexts[d], contexts[d + 1] & ((1 << 8 * d) - 1))
            parents[d + 1] = up
            inside = np.zeros(counts[d].shape, counts[d].dtype)
            np.add.at(inside, up, counts[d + 1])
            rest[d] = np.maximum(counts[d] - inside, 0)
            product = np.zeros(estimate.shape)
            np.add.at(product, up, below)
            some = np.zeros(len(estimate), dtype=bool)
            some[up] = True
            product[some] += log_estimate(rest[d][some])
            both = np.logaddexp(estimate[some], product[some])
            weighted[some] = both - np.log(2)
            own[some] = np.exp(estimate[some] - both)
            del inside, product, both
        own_weight[d], below = own, weighted
    # from the root down: what is decided so far, and the weight that is left
    mixed, left = np.zeros((1, 255), np.float32), np.ones((1, 255), np.float32)
    inner = [np.isin(np.arange(len(contexts[d])), parents[d + 1]) if d < depth else np.zeros(len(contexts[d]), bool) for d in range(depth + 1)]
    n_inner = sum(int(i.sum()) for i in inner)
    children = np.zeros((max(n_inner, 1), 256), dtype=np.int32)
    rows, inner_at, n_rows = [], 0, 0
    number_above = np.zeros(0, np.int64)
    for d in range(depth + 1):
        if d:
            mixed, left = mixed[parents[d]], left[parents[d]]
        own = own_weight[d] * chance_of_one(counts[d])
        is_inner = inner[d]
        numbers = np.zeros(len(contexts[d]), dtype=np.int64)
        numbers[is_inner] = inner_at + np.arange(int(is_inner.sum()))
        leaf = ~is_inner
        ends = mixed[leaf] + left[leaf] * own[leaf]
        numbers[leaf] = n_inner + n_rows + np.arange(len(ends))
        rows.append(byte_logs(ends))
        n_rows += len(ends)
        if d:
            children[number_above[parents[d]], contexts[d] >> (8 * (d - 1)) & 255] = numbers
        mixed, left = mixed + left * own, left * (1 - own_weight[d])
        if is_inner.any():
            others = mixed[is_inner] + left[is_inner] * chance_of_one(rest[d][is_inner])
            rows.append(byte_logs(others))
            children[numbers[is_inner]] = (n_inner + n_rows + np.arange(len(others)))[:, None]
            n_rows += len(others)
        inner_at += int(is_inner.sum())
        number_above = numbers
    table = np.concatenate(rows)
    if not n_inner:  # the root alone
        children[:] = 1
    return Tree(children, table)


def score_block(tree: Tree, block: Block, two: np.ndarray) -> np.ndarray:
    """log10 of each document's probability, end mark included."""
    stream, starts = byte_stream(block)
    at = coded(stream, starts)
    inner = len(tree.children)
    node = two[stream[at - 1] + (stream[at - 2].astype(np.int32) << 8)]
    active = np.flatnonzero(node < inner)
    for d in range(3, DEPTH + 1):
        step = tree.children[node[active], stream[at[active] - d]]
        node[active] = step
        active = active[step < inner]
    logs = tree.table[node - inner, stream[at]]
    first = np.concatenate([[0], np.cumsum(np.diff(starts) - DEPTH)])
    return np.add.reduceat(logs.astype(np.float64), first[:-1])


def grow(train: DataFrame, share: int = SHARE) -> Tree:
    """Counts (context, byte) at every depth by shuffles, and builds the tree from the frequent contexts."""
    raw = train.select(F.col("text").cast("binary").alias("_text")).mapInArrow(count_contexts, "code long, n long")
    counts = written(raw.groupBy("code").agg(F.sum("n").alias("n")), "context-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    levels = []
    for d in range(DEPTH, -1, -1):
        # the byte is the lowest of the code, the nearest context byte the next one
        if d < DEPTH:
            counts = counts.groupBy(F.col("code").bitwiseAND((1 << 8 * (d + 1)) - 1).alias("code")).agg(F.sum("n").alias("n"))
            counts = written(counts, "context-counts")
        context = F.shiftright("code", 8)
        often = counts.groupBy(context.alias("context")).agg(F.sum("n").alias("all")).filter(F.col("all") * share >= total)
        # at most ``share`` contexts have so many bytes, each with at most 256 next ones
        next_ones = counts.join(F.broadcast(often.select("context")), context == F.col("context"))
        found = next_ones.select("context", F.col("code").bitwiseAND(255).alias("byte"), "n").toArrow()
        levels.append(tuple(found.column(c).to_numpy().astype(np.int64) for c in ("context", "byte", "n")))
    return build(levels[::-1])


def decisions(code: np.ndarray, n: np.ndarray) -> list[tuple]:
    """For each of the eight bits: keys (context, then the bits so far), zeros, ones. The codes are sorted and occur once."""
    out = []
    for bit in range(8):
        key = code >> (8 - bit)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        ones = np.add.reduceat(np.where(code >> (7 - bit) & 1, n, 0), first)
        out.append((key[first], np.add.reduceat(n, first) - ones, ones, None))
    return out


def climb(nodes: list[tuple], deep: int, top: int) -> tuple[dict, list[tuple]]:
    """Weights the nodes of depth ``deep`` and all above them up to depth ``top``.

    nodes: for each bit, keys, zeros, ones and the log of the children's product. Gives by depth and bit the keys, the chance of a one and
    the weight of the own estimate; and what the depth above ``top`` gets.
    """
    tables, above = {}, []
    for bit, (key, zeros, ones, product) in enumerate(nodes):
        for d in range(deep, top - 1, -1):
            weighted = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)
            own = np.ones(len(key))
            if d < DEPTH:
                both = np.logaddexp(weighted, product)
                own, weighted = np.exp(weighted - both), both - np.log(2)
            tables[d, bit] = key, (ones + 0.5) / (zeros + ones + 1.0), own
            if d:
                key, up = np.unique(key & ((1 << 8 * (d - 1) + bit) - 1), return_inverse=True)
                zeros, ones, product = (np.bincount(up, x, len(key)) for x in (zeros, ones, weighted))
        above.append((key, zeros, ones, product))
    return tables, above


def predicted(code: np.ndarray, tables: dict) -> np.ndarray:
    """log10 of each code's byte after its context, from the root down; what was never seen is a half."""
    logs = np.zeros(len(code))
    for bit in range(8):
        mixed, left = np.zeros(len(code)), np.ones(len(code))
        for d in range(DEPTH + 1):
            key, chance, own = (np.append(x, last) for x, last in zip(tables[d, bit], (-1, 0.5, 1.0), strict=True))
            wanted = (code & ((1 << 8 * (d + 1)) - 1)) >> (8 - bit)
            at = np.searchsorted(key[:-1], wanted)
            at[key[at] != wanted] = len(key) - 1
            mixed += left * own[at] * chance[at]
            left *= 1 - own[at]
        logs += np.log10(np.where(code >> (7 - bit) & 1, mixed, 1 - mixed))
    return logs


def whole_groups(batches, near: int):
    """Sorted (code, n), about CHUNK rows at a time, from rows ordered by the ``near`` nearest bytes: no group of these is cut in two."""
    code, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts, kept = [], 0

    def ordered(to: int):
        order = np.argsort(code[:to])
        return code[:to][order], n[:to][order]

    for batch in batches:
        parts.append((batch.column("code").to_numpy(), batch.column("n").to_numpy()))
        kept += len(batch)
        if kept >= CHUNK:
            code, n = (np.concatenate(x) for x in zip((code, n), *parts, strict=True))
            group = (code >> 8) & ((1 << 8 * near) - 1)
            to = int(np.argmax(group == group[-1]))
            if to:
                yield ordered(to)
            code, n = code[to:], n[to:]
            parts, kept = [], 0
    code, n = (np.concatenate(x) for x in zip((code, n), *parts, strict=True))
    if len(code):
        yield ordered(len(code))


def predictions(docs: DataFrame, train: Column) -> DataFrame:
    """A table of code, n and log: every context and byte of the texts, how often in those to learn from, and log10 of the prediction."""
    near = min(HEAD + 1, DEPTH)
    source = docs.select(F.coalesce(train, F.lit(False)).alias("_train"), F.col("text").cast("binary").alias("_text"))
    raw = source.mapInArrow(count_contexts, "code long, n long")
    counts = written(raw.groupBy("code").agg(F.sum("n").alias("n")), "context-counts")
    group = F.shiftright("code", 8).bitwiseAND((1 << 8 * near) - 1)

    def sums_above(batches):
        for code, n in whole_groups(batches, near):
            _, above = climb(decisions(code, n), DEPTH, near)
            for bit, (key, *values) in enumerate(above):
                arrays = [pa.array(np.full(len(key), bit, np.int32)), pa.array(key), *(pa.array(x.astype(float)) for x in values)]
                yield pa.RecordBatch.from_arrays(arrays, names=["bit", "key", "zeros", "ones", "product"])

    grouped = counts.filter("n > 0").repartition(group).sortWithinPartitions(group)
    sums = grouped.mapInArrow(sums_above, "bit int, key long, zeros double, ones double, product double").groupBy("bit", "key")
    # at most 256 ** HEAD contexts of 255 decisions each, whatever the corpus
    met = sums.agg(*(F.sum(c).alias(c) for c in ("zeros", "ones", "product"))).toArrow()
    bit, key, *values = (met.column(c).to_numpy() for c in ("bit", "key", "zeros", "ones", "product"))
    order = np.lexsort((key, bit))
    bounds = np.searchsorted(bit[order], np.arange(9))
    nodes = [tuple(x[order[a:b]] for x in (key, *values)) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    head, _ = climb(nodes, near - 1, 0)

    def predict(batches):
        for code, n in whole_groups(batches, near):
            tables, _ = climb(decisions(code[n > 0], n[n > 0]), DEPTH, near)
            logs = predicted(code, head | tables)
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n), pa.array(logs)], names=["code", "n", "log"])

    grouped = counts.repartition(group).sortWithinPartitions(group)
    return written(grouped.mapInArrow(predict, "code long, n long, log double"), "context-logs")


def most_frequent(logs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and logs of the most frequent codes, LOOKED_UP at most: all that occur at least 2 ** k times, for the least k that fits."""
    digits = F.length(F.bin("n"))
    sizes = logs.groupBy(digits.alias("digits")).count().collect()
    least, held = None, 0
    for r in sorted(sizes, key=lambda r: -r.digits):
        held += r["count"]
        if held > LOOKED_UP:
            break
        least = r.digits
    often = logs.filter(F.lit(False) if least is None else digits >= least).select("code", "log").toArrow()
    code, log = (often.column(c).to_numpy() for c in ("code", "log"))
    order = np.argsort(code)
    return code[order], log[order]


def look_up(block: Block, codes: np.ndarray, logs: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Of each document, the sum of the logs of its bytes that are found, and the codes that are not."""
    code, first = codes_of(block)
    names, which = np.unique(code, return_inverse=True)
    at = np.searchsorted(codes, names)
    found = np.append(codes, -1)[at] == names
    known = np.where(found, np.append(logs, 0.0)[at], 0.0)[which]
    other = np.flatnonzero(~found[which])
    others = pa.ListArray.from_arrays(np.searchsorted(other, first).astype(np.int32), pa.array(code[other]))
    return np.add.reduceat(known, first[:-1]), others


def score(docs: DataFrame, train: Column, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with n_tokens, n_known, train_tokens, base_score and score, learned from rows where ``train`` holds."""
    learned = docs.filter(train).select("text")
    logs_table = predictions(docs, train)
    codes, logs = most_frequent(logs_table)
    words = learned.select(F.col("text").cast("binary").alias("_text")).mapInArrow(count_tokens, "token binary, n long")
    vocabulary = written(words.groupBy("token").agg(F.sum("n").alias("n")), "token-counts")
    n_docs = learned.count()
    n_words, n_types = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_all, v = n_words + n_docs, n_types + int(n_docs > 0)
    base = float(np.log10(n_all + 0.1 * (v + 1)))
    # at most FREQUENT tokens, however large the vocabulary
    top = {bytes(r.token): r.n for r in vocabulary.orderBy(F.desc("n"), "token").limit(FREQUENT).collect()}
    known = {token: float(np.log10(n + 0.1)) - base for token, n in top.items()}
    end = float(np.log10(n_docs + 0.1)) - base
    columns = docs.select(*keep).schema
    schema = columns.add("_row", "long").add("n_tokens", "long").add("_known", "long").add("_base", "double").add("score", "double")
    schema = schema.add("_others", T.ArrayType(T.BinaryType())).add("_codes", T.ArrayType(T.LongType()))

    def first_pass(batches):
        for block in blocks(batches, "_text"):
            sums, other_codes = look_up(block, codes, logs)
            texts = block.rows.column("_text")
            number, found, base_sum, others = [], [], [], []
            for text in texts:
                tokens = (text.as_py() or b"").lower().split()
                values = [known.get(t) for t in tokens]
                unknown = [t for t, x in zip(tokens, values, strict=True) if x is None]
                number.append(len(tokens) + 1)
                found.append(len(tokens) - len(unknown) + int(n_docs > 0))
                base_sum.append(sum(x for x in values if x is not None) + end)
                others.append(unknown)
            arrays = [block.rows.column(c) for c in keep] + [block.rows.column("_row")]
            arrays += [pa.array(number, pa.int64()), pa.array(found, pa.int64()), pa.array(base_sum, pa.float64()), pa.array(sums)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(others, pa.list_(pa.binary())), other_codes], names=schema.names)

    source = docs.select(*keep, F.monotonically_increasing_id().alias("_row"), F.col("text").cast("binary").alias("_text"))
    scored = written(source.mapInArrow(first_pass, schema), "first-pass")
    rare = scored.select("_row", F.explode("_others").alias("token")).groupBy("_row", "token").agg(F.count("*").alias("k"))
    chance = F.log10(F.coalesce("n", F.lit(0)) + 0.1) - base
    sums = rare.join(vocabulary, "token", "left").groupBy("_row")
    sums = sums.agg(F.sum(F.col("k") * chance).alias("_more"), F.sum(F.when(F.col("n") > 0, F.col("k")).otherwise(0)).alias("_more_known"))
    rest = scored.select("_row", F.explode("_codes").alias("code")).groupBy("_row", "code").agg(F.count("*").alias("k"))
    rest = rest.join(logs_table, "code").groupBy("_row").agg(F.sum(F.col("k") * F.col("log")).alias("_more_score"))
    joined = scored.drop("_others", "_codes").join(sums, "_row", "left").join(rest, "_row", "left")
    return joined.select(
        *keep, "n_tokens", (F.col("_known") + F.coalesce("_more_known", F.lit(0))).alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("_more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("_more_score", F.lit(0.0))).alias("score"),
    )

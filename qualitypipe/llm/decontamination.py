"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact verification.

Words are A-Z lower-cased runs without white space. A document that holds an item shares most of the item's
five-word shingles, so windows of the item's size are laid only where shared shingles say, shifted by up to one word; documents in
which fewer than 75 % of an item's shingles occur can't reach the similarity and get none. Each window's and
item's 64-bit SimHash of its words is cut into 20 blocks: two that differ in at most 19 bits agree in one block at least, so a
join on (item, block, value) finds all of them, each at its first block that agrees. So the shingles say which windows and items
meet, and the fingerprints which of these are worth comparing; the join carries fingerprints only. Pairs within the radius are
verified by weighted Jaccard similarity of five-word shingles, weighted by how often each occurs: sum of minima over sum of maxima, 0.75
or more. Of windows at exactly 0.75, 0.02 % (20 words) to 0.35 % (200 words) are beyond the radius.

Defined results: null and empty texts hold no item; empty items are held by none. A text or item shorter than five words is one
shingle; a text shorter than an item is one window. In ``contained`` a null id is an id like any other, and rows with the same id
count as one document; ``decontaminate`` judges each row by its own text. Repeated items with different ids are found each; different
items of one id, or without one, are looked for each, and the best of them is returned. Of equally similar windows the first counts. Long
texts are read whole. Empty tables give no rows. Only the columns named are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualitypipe.llm.shared import lower_ascii, written

SHINGLE = 5
LEAST = 0.75
RADIUS = 19
#: Bits of each block: 20 blocks for a radius of 19.
BLOCK_BITS = [4] * 4 + [3] * 16
#: Beyond so many shingles of items (16 to 40 bytes each), or candidate documents, tables are joined by shuffle, not sent to all tasks.
FEW_SHINGLES = 300_000
FEW_DOCUMENTS = 500_000


def words_of(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def shingles_of(words: Column, size: int = SHINGLE) -> Column:
    """Hashes of all runs of ``size`` words in order; the whole sequence if it is shorter. ``words`` should be a plain column."""
    runs = F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(*[words[i + k] for k in range(size)]))
    short = F.array(F.xxhash64(F.concat_ws(" ", words)))
    return F.when(F.size(words) >= size, runs).when(F.size(words) > 0, short).otherwise(F.array().cast("array<bigint>"))


def simhash(words: Column) -> Column:
    """64 bits: each the sign of the sum, over all words, of that bit of the word's hash as 1 or -1."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(63)),
        lambda b: F.aggregate(hashes, F.lit(0), lambda a, h: a + F.getbit(h, b).cast("int") * 2 - 1),
    )
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda a, s: F.shiftleft(a, 1).bitwiseOR((s > 0).cast("bigint")))


def block_values(print_: Column) -> Column:
    """(number, value) of each block of a fingerprint."""
    out, at = [], 0
    for number, bits in enumerate(BLOCK_BITS):
        value = F.shiftrightunsigned(print_, at).bitwiseAND((1 << bits) - 1)
        out.append(F.struct(F.lit(number).alias("block"), value.cast("int").alias("value")))
        at += bits
    return F.array(*out)


def first_agreeing(difference: Column) -> Column:
    """The number of the first block without a bit in ``difference``, the XOR of two fingerprints; null if there is none."""
    whens, at = [], 0
    for number, bits in enumerate(BLOCK_BITS):
        whens.append(F.when(F.shiftrightunsigned(difference, at).bitwiseAND((1 << bits) - 1) == 0, F.lit(number)))
        at += bits
    return F.coalesce(*whens)


def within_radius(windows: DataFrame, items: DataFrame) -> DataFrame:
    """(window) of the fingerprints (window, item, print) within the radius of their item's (item, print), once each."""
    left = windows.select("window", "item", "print", F.inline(block_values(F.col("print"))))
    prints = items.select(F.col("item").alias("of"), F.col("print").alias("item_print"))
    right = prints.select("of", "item_print", F.inline(block_values(F.col("item_print")))).withColumnsRenamed({"block": "at", "value": "is"})
    difference = F.col("print").bitwiseXOR(F.col("item_print"))
    agree = (F.col("item") == F.col("of")) & (F.col("block") == F.col("at")) & (F.col("value") == F.col("is"))
    near = (F.col("block") == first_agreeing(difference)) & (F.bit_count(difference) <= RADIUS)
    return left.join(_few(right, FEW_SHINGLES), agree & near).select("window")


def similarity(a: Column, b: Column) -> Column:
    """Weighted Jaccard similarity of two arrays of shingles; both should be plain columns."""
    times = lambda s, x: F.size(F.filter(s, lambda y: y == x))
    shared = F.aggregate(F.array_distinct(a), F.lit(0), lambda t, x: t + F.least(times(a, x), times(b, x)))
    return shared / F.greatest(F.size(a) + F.size(b) - shared, F.lit(1))


def _few(frame: DataFrame, most: int) -> DataFrame:
    """Sent to all tasks if its rows are counted to be few, else left to be joined by shuffle."""
    return F.broadcast(frame) if frame.limit(most + 1).count() <= most else frame


def prepared_items(items: DataFrame, key: str) -> DataFrame:
    split = items.select(F.col(key).alias("item_id"), words_of(F.col("text")).alias("words")).filter(F.size("words") > 0)
    shingled = split.select("item_id", "words", shingles_of(F.col("words")).alias("shingles"))
    number = F.monotonically_increasing_id().alias("item")
    return shingled.select(number, "item_id", "shingles", F.size("words").alias("n"), simhash(F.col("words")).alias("print"))


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """(doc id, item id, similarity, start_word, n_windows): the best window of each item that a document holds."""
    bench = written(prepared_items(items, item_key), "items")
    keys = bench.select("item", "n", F.size("shingles").alias("wanted"), F.posexplode("shingles").alias("q", "h"))
    # sizes of the shingles to look for: 5, and the sizes of items that are shorter
    sizes = sorted({min(r.n, SHINGLE) for r in bench.select(F.least("n", F.lit(SHINGLE)).alias("n")).distinct().collect()})
    split = docs.select(F.col(key).alias("id"), words_of(F.col("text")).alias("words"))
    hits = None
    for size in sizes:
        runs = split.filter(F.size("words") >= size) if size < SHINGLE else split.filter(F.size("words") > 0)
        placed = runs.select("id", F.size("words").alias("m"), F.posexplode(_runs(F.col("words"), size)).alias("p", "h"))
        wanted = keys.filter(F.col("n") == size if size < SHINGLE else F.col("n") >= size)
        found = placed.join(_few(wanted, FEW_SHINGLES), "h")
        hits = found if hits is None else hits.unionByName(found)
    if hits is None:
        return split.select(F.col("id").alias(key), F.lit(None).cast(bench.schema["item_id"].dataType).alias("item_id"), F.lit(0.0).alias("similarity"),
                            F.lit(0).alias("start_word"), F.lit(0).alias("n_windows")).filter(F.lit(False))
    start = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("m") - F.col("n")))
    per_pair = hits.groupBy("id", "item").agg(
        F.first("n").alias("n"), F.first("wanted").alias("wanted"), F.count_distinct("q").alias("met"), F.collect_set(start).alias("starts")
    )
    likely = written(per_pair.filter(F.col("met") >= LEAST * F.col("wanted")).select("id", "item", "n", "starts"), "likely-documents")
    texts = docs.select(F.col(key).alias("id"), F.col("text").alias("text"))
    here = _few(likely.groupBy("id").agg(F.collect_set(F.struct("item", "n", "starts")).alias("places")).withColumnRenamed("id", "likely"), FEW_DOCUMENTS)
    chosen = texts.join(here, F.col("id").eqNullSafe(F.col("likely"))).select("id", "places", words_of(F.col("text")).alias("words"))
    per_item = chosen.select("id", "words", F.explode("places").alias("place"))
    shifted = F.flatten(F.transform("place.starts", lambda s: F.array(s - 1, s, s + 1)))
    inside = F.transform(shifted, lambda s: F.greatest(F.lit(0), F.least(s, F.size("words") - F.col("place.n"))))
    laid = per_item.select("id", "words", "place.item", "place.n", F.explode(F.array_distinct(inside)).alias("start"))
    cut = laid.select("id", "item", "start", F.slice("words", F.col("start") + 1, F.col("n")).alias("words"))
    # numbers that the written table fixes
    windows = written(cut.select(F.monotonically_increasing_id().alias("window"), "*", simhash(F.col("words")).alias("print")), "windows")
    near = written(within_radius(windows, bench), "near")
    shingled = windows.join(_few(near, FEW_DOCUMENTS), "window").select("id", "item", "start", shingles_of(F.col("words")).alias("shingles"))
    both = shingled.join(bench.select("item", "item_id", F.col("shingles").alias("item_shingles")), "item")
    verified = both.select("id", "item_id", "start", similarity(F.col("shingles"), F.col("item_shingles")).alias("similarity"))
    best = verified.filter(F.col("similarity") >= LEAST).groupBy("id", "item_id")
    top = F.max(F.struct("similarity", (-F.col("start")).alias("at")))
    return best.agg(top.alias("top"), F.count_distinct("start").cast("int").alias("n_windows")).select(
        F.col("id").alias(key), "item_id", F.col("top.similarity").alias("similarity"), (-F.col("top.at")).alias("start_word"), "n_windows"
    )


def _runs(words: Column, size: int) -> Column:
    """Shingles as items of that size have them: an item shorter than five words is one shingle of joined words."""
    if size == SHINGLE:
        return shingles_of(words)
    return F.transform(F.sequence(F.lit(0), F.size(words) - size), lambda i: F.xxhash64(F.concat_ws(" ", F.slice(words, i + 1, F.lit(size)))))


def decontaminate(docs: DataFrame, items: DataFrame, key: str = "doc_id") -> DataFrame:
    """``docs`` without the rows that hold an item; others of the same id, or without one, stay."""
    # a digest of id and text, the first digest of fixed length or empty
    row = F.unhex(F.sha2(F.concat(F.coalesce(F.sha2(docs[key].cast("string"), 256), F.lit("")), F.coalesce(docs["text"], F.lit(""))), 256))
    ids = written(contained(docs.select(row.alias("_key"), "text"), items, "_key").select(F.col("_key").alias("_held")).distinct(), "contaminated")
    return docs.join(_few(ids, FEW_DOCUMENTS), row == ids["_held"], "left_anti")

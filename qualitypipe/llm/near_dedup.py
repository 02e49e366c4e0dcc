"""Near-duplicate groups by HyperMinHash, banding and verification on full shingle sets.

A document is the set of its distinct five-word shingles (A-Z lower-cased words; fewer than five words are one shingle). Rows
with the same set form a class, and one node stands for it from then on. Each set has 384 registers. A register has a hash of its
own, and keeps of the smallest value only the number of leading zeros (6 bits) and the 10 bits behind the first one.
Six registers are packed into the 64-bit key of a band, 64 bands in all; sets with a Jaccard similarity of 0.75 agree in a band but
for 4 in a million. Register agreement, corrected for accidental collisions of compressed registers, estimates the similarity;
candidates below 0.64 (five standard deviations from 0.75) are left out and all others are verified on their full sets.

Pairs within a band's bucket are never listed as such.

1. Each member is compared with its bucket's hub: the member that shares most buckets with others, so that one hub serves
   most buckets of a group. What links is joined into components. In further rounds, the members that are not in their hub's
   component get a hub of their own.
2. Then only pairs across components count. A shingle crosses if documents of several components hold it; a document can be
   similar to one of another component only if it has as many crossing shingles as that takes. Documents without enough of
   them leave, and others may then have too few, until none does. This bound is exact and needs no pairs.
3. Of what is left, pairs across components that share a bucket are estimated and verified: all in small buckets; in
   large ones, those that an exact prefix-filter join on shingles finds. Shingles that the bucket's hub lacks come first, and prefixes
   are as long as the sizes of a pair demand: a document that is not similar to the hub has nothing else in its prefix.

So no bucket is cut, none goes to one task, and the work of a group of copies grows with its size.

Defined results: null and empty texts have no shingle and are linked with nothing. Rows may share an id: they are documents of
their own, linked by their texts like others; a null id is linked with nothing, and its component is null and it is kept. Ids may be
of any type that has an order. Of equally popular hubs one is taken; that changes no result. Very long texts are sets like others, built in blocks.
An empty table gives no rows. Only id and text are read, so other columns may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualitypipe.llm.shared import Block, Scratch, blocks, leaves_little, lower_bytes, mix, written

SHINGLE = 5
NEED, OF = 75, 100  # shared * OF >= NEED * all
REGISTERS, BAND = 384, 6
BANDS = REGISTERS // BAND
MANTISSA = 10
ESTIMATE = 0.64
#: Times that members try a hub, and that documents with too few crossing shingles leave, before all that is left is compared.
ROUNDS, LEAVING = 3, 4
#: Buckets of several components with more members than this are joined by shingles instead of pair by pair.
FEW_COMPONENTS = 48
#: Beyond so many ids (8 bytes each), documents are joined by shuffle rather than with a table sent to all tasks.
FEW_IDS = 1_000_000

_ODD = mix(np.arange(1, SHINGLE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_SALTS = mix(np.arange(1, REGISTERS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_FACTORS = mix(_SALTS + np.uint64(7)) | np.uint64(1)


def shingle_sets(block: Block) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each document's shingles."""
    doc, begin, stop = block.words()
    words = block.word_hashes(begin, stop, lower_bytes(block.data))
    n = np.bincount(doc, minlength=block.size)
    first = np.concatenate([[0], np.cumsum(n)])
    rolled = np.zeros(max(len(words) - SHINGLE + 1, 0), dtype=np.uint64)
    for k in range(SHINGLE):
        rolled = rolled + mix(words[k : k + len(rolled)] + _ODD[k]) * _ODD[k]
    rolled = mix(rolled)
    out = []
    for d in range(block.size):
        a, b = first[d], first[d + 1]
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            mixed = mix(words[a:b] + _ODD[: b - a]) * _ODD[: b - a]
            out.append(mix(mixed.sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def registers(found: np.ndarray) -> np.ndarray:
    """The compressed minima of a set, as 16-bit numbers."""
    least = np.full(REGISTERS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(found), 2048):  # a bounded table of values, whatever the set's size
        least = np.minimum(least, ((found[at : at + 2048, None] ^ _SALTS) * _FACTORS).min(axis=0))
    # the position of the highest one, from a double's exponent; the bit below it is cleared, so nothing is rounded up
    high = least & ~(least >> np.uint64(1))
    top = np.frexp(np.maximum(high, np.uint64(1)).astype(np.float64))[1] - 1
    zeros = 63 - np.minimum(top, 63)
    shifted = least << (zeros.astype(np.uint64) & np.uint64(63))
    mantissa = (shifted >> np.uint64(63 - MANTISSA)) & np.uint64((1 << MANTISSA) - 1)
    return ((zeros.astype(np.uint64) << np.uint64(MANTISSA)) | mantissa).astype(np.uint16)


def set_key(found: np.ndarray) -> tuple[int, int]:
    """128 bits that tell sets apart."""
    return tuple(int(x) for x in np.array([mix(found).sum(dtype=np.uint64), mix(found ^ _SALTS[0]).sum(dtype=np.uint64)]).view(np.int64))


@leaves_little
def sketch(batches):
    """(id, row, n, key_a, key_b, registers) of each document."""
    for block in blocks(batches, "_text"):
        sets = shingle_sets(block)
        keys = [set_key(s) for s in sets]
        columns = [block.rows.column("id"), block.rows.column("row"), pa.array([len(s) for s in sets], pa.int64())]
        columns += [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)]
        columns.append(pa.array([registers(s).view(np.int16) if len(s) else None for s in sets], pa.list_(pa.int16())))
        yield pa.RecordBatch.from_arrays(columns, names=["id", "row", "n", "key_a", "key_b", "registers"])


@leaves_little
def banded(batches):
    """(band key, node) of each set: the registers of a band hashed together with its number."""
    number = mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(1))
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("registers").flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(-1, BANDS, BAND)
        keys = np.broadcast_to(number, values.shape[:2])
        for k in range(BAND):
            keys = mix(keys + values[:, :, k] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
        nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(nodes)], names=["band", "node"])


def estimated(agree, n, m):
    """Jaccard similarity from the number of equal registers, less the expected share of accidental ones; columns or numbers."""
    ratio = 4.0 * n * m / ((n + m) * (n + m))
    accidental = 0.169919487159739 * 2.0**-MANTISSA * ratio
    return (agree / REGISTERS - accidental) / (1 - accidental)


def estimate(x: str, y: str, n: str, m: str) -> Column:
    """``estimated`` of two columns of registers and of set sizes."""
    agree = F.size(F.filter(F.zip_with(x, y, lambda a, b: a == b), lambda same: same))
    return estimated(agree, F.col(n).cast("double"), F.col(m).cast("double"))


def similar(a: str, b: str) -> Column:
    """Whether two columns of distinct shingles share enough."""
    shared = F.size(F.array_intersect(a, b))
    return OF * shared >= NEED * (F.size(a) + F.size(b) - shared)


def _sets(texts: DataFrame, classes: DataFrame, nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, found) of the nodes asked for: the sets, built once more from the text of one row of each class."""

    @leaves_little
    def sets(batches):
        for block in blocks(batches, "_text"):
            found = shingle_sets(block)
            keys = [set_key(s) for s in found]
            columns = [block.rows.column("row"), *(pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s.view(np.int64) for s in found], pa.list_(pa.int64()))], names=["row", "key_a", "key_b", "found"])

    wanted = scratch.written(classes.join(nodes, "node", "left_semi").select("row", "key_a", "key_b", "node"), "wanted")
    number = wanted.count()
    small = F.broadcast(wanted) if number <= FEW_IDS else wanted
    chosen = texts.join(small.select("row"), "row", "left_semi").select("row", "_text")
    built = chosen.mapInArrow(sets, "row long, key_a long, key_b long, found array<long>")
    found = scratch.written(built.join(small, ["row", "key_a", "key_b"]).select("node", "found"), "sets")
    if found.count() == number:
        return found
    return scratch.written(found.dropDuplicates(["node"]), "sets")  # exact repeats of rows


def _verified(sets: DataFrame, pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("found").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("found").alias("y"))
    return scratch.written(pairs.join(left, "a").join(right, "b").filter(similar("x", "y")).select("a", "b").distinct(), "links")


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): the smallest node each linked one can reach. Labels fall to the neighbours' smallest, then to their label's label."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("to")).unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("to")))
    edges = scratch.written(both.filter("node <> to").distinct(), "edges")
    labels = scratch.written(edges.groupBy("node").agg(F.min("to").alias("m")).select("node", F.least("node", "m").alias("root")), "labels")
    while True:
        seen = edges.join(labels.select(F.col("node").alias("to"), "root"), "to").groupBy("node").agg(F.min("root").alias("near"))
        lowered = labels.join(seen, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("root").alias("far"))
        moved = lowered.join(jump, "mid", "left").select("node", "old", F.least("mid", F.coalesce("far", "mid")).alias("root"))
        moved = scratch.written(moved, "labels")
        if moved.filter("root <> old").isEmpty():
            return moved.select("node", "root")
        labels = moved.select("node", "root")


def _labelled(rows: DataFrame, roots: DataFrame | None, column: str = "node", name: str = "root") -> DataFrame:
    """Adds the component of a node; without links a node is its own."""
    if roots is None:
        return rows.withColumn(name, F.col(column))
    found = roots.select(F.col("node").alias(column), F.col("root").alias("_root"))
    return rows.join(found, column, "left").withColumn(name, F.coalesce("_root", column)).drop("_root")


def _estimated(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs (a, b) with their estimate, those that may be similar."""
    left = sketches.select(F.col("node").alias("a"), F.col("registers").alias("x"), F.col("n").alias("na"))
    right = sketches.select(F.col("node").alias("b"), F.col("registers").alias("y"), F.col("n").alias("nb"))
    both = pairs.join(left, "a").join(right, "b").filter(F.least("na", "nb") * OF >= F.greatest("na", "nb") * NEED)
    return both.select("a", "b", estimate("x", "y", "na", "nb").alias("estimate")).filter(F.col("estimate") >= ESTIMATE)


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _crossing(sets: DataFrame, placed: DataFrame, scratch: Scratch) -> DataFrame:
    """(band, node, root, n) of ``placed`` whose documents may be similar to one of another component. Documents leave in
    rounds as one row each; their bands are looked up once, when it is known who stays."""
    spread = placed.groupBy("band").agg(F.count_distinct("root").alias("roots"), F.min("n").alias("least")).filter("roots > 1")
    shared_bands = placed.join(spread.drop("roots"), "band")
    # what it takes with the smallest partner m that there may be
    held = scratch.written(shared_bands.groupBy("node").agg(F.first("root").alias("root"), F.first("n").alias("n"), F.min(_partner("n", "least")).alias("m")), "held")
    number = held.count()
    for _ in range(LEAVING):
        tokens = sets.join(held, "node").select("node", "root", F.explode("found").alias("token"))
        crossing = tokens.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("token")
        shared = tokens.join(crossing, "token").groupBy("node").agg(F.count("*").alias("shared"))
        held = scratch.written(held.join(shared, "node").filter(F.col("shared") >= _needed("n", "m")).select("node", "root", "n", "m"), "held")
        before, number = number, held.count()
        if number in (before, 0):
            break
    return scratch.written(placed.join(held.select("node"), "node", "left_semi"), "placed")


def _needed(n: str, m: str) -> Column:
    """Shingles that sets of n and m must share: shared * OF >= NEED * (n + m - shared)."""
    return F.expr(f"(({n} + {m}) * {NEED} + {OF + NEED - 1}) div {OF + NEED}")


def _partner(n: str, least: str) -> Column:
    """The smallest size that a set similar to one of n has, if ``least`` is the smallest there is."""
    return F.greatest(F.col(least), F.expr(f"({n} * {NEED} + {OF - 1}) div {OF}"))


def prefixes(sets: DataFrame, placed: DataFrame) -> DataFrame:
    """(hub, token, node, root, n, place): of each set as many shingles as it must share one of with a set of ``m`` or more,
    in an order that is the same for all sets with one hub: those that the hub lacks, then those that it has."""
    hubs = sets.select(F.col("node").alias("hub"), F.col("found").alias("held"))
    both = placed.join(sets, "node").join(hubs, "hub")
    ordered = F.concat(F.array_sort(F.array_except("found", "held")), F.array_sort(F.array_intersect("found", "held")))
    first = F.slice(ordered, F.lit(1), (F.col("n") - _needed("n", "m") + 1).cast("int"))
    return both.select("hub", "node", "root", "n", F.posexplode(first).alias("place", "token"))


def _by_shingles(sets: DataFrame, placed: DataFrame, scratch: Scratch) -> DataFrame:
    """All pairs across components that have a hub in common and share a shingle of their prefixes for it; of the given nodes
    (node, hub, root, n, and m, the size of the smallest set that may be similar). The sizes of a pair say how long its prefixes are."""
    kept = scratch.written(prefixes(sets, placed), "prefixes")
    mixed = kept.groupBy("hub", "token").agg((F.min("root") < F.max("root")).alias("mixed")).filter("mixed").select("hub", "token")
    kept = scratch.written(kept.join(mixed, ["hub", "token"], "left_semi"), "prefixes")
    left, right = (kept.select(*(F.col(c).alias(f"{side}_{c}") for c in kept.columns)) for side in "xy")
    needed = _needed("x_n", "y_n")
    sizes = F.least("x_n", "y_n") * OF >= F.greatest("x_n", "y_n") * NEED
    within = sizes & (F.col("x_place") <= F.col("x_n") - needed) & (F.col("y_place") <= F.col("y_n") - needed)
    same = (F.col("x_hub") == F.col("y_hub")) & (F.col("x_token") == F.col("y_token"))
    return left.join(right, same & (F.col("x_root") < F.col("y_root")) & within).select(*_pair("x_node", "y_node")).distinct()


def _hubbed(members: DataFrame) -> DataFrame:
    """(node, hub, root, n, m): the members of buckets with the hubs of these, and the smallest partner there may be. A bucket's
    hub is the most popular node of the component that its own most popular member is in, so a group has few hubs."""
    popular = members.join(members.groupBy("node").agg(F.sum("size").alias("popular")), "node")
    first = F.struct("popular", "node")
    of_root = popular.groupBy("root").agg(F.max_by("node", first).alias("hub")).withColumnRenamed("root", "lead")
    of_band = popular.groupBy("band").agg(F.max_by("root", first).alias("lead"), F.min("n").alias("least")).join(of_root, "lead")
    partner = F.min(_partner("n", "least")).alias("m")
    return members.join(of_band, "band").groupBy("node", "hub").agg(F.first("root").alias("root"), F.first("n").alias("n"), partner)


def _links(members: DataFrame, sketches: DataFrame, sets: DataFrame, scratch: Scratch) -> DataFrame | None:
    """Components (node, root) of the nodes in shared buckets; None without links."""
    size = members.groupBy("band").agg(F.count("*").alias("size"))
    popular = members.join(size, "band").groupBy("node").agg(F.sum("size").alias("popular"))
    open_members = scratch.written(members.join(popular, "node").join(sketches.select("node", "n"), "node"), "popular")
    roots, links = None, None
    apart = open_members
    for _ in range(ROUNDS):
        best = F.max_by("node", F.struct("popular", "node"))
        hubs = apart.groupBy("band").agg(best.alias("hub"), F.count("*").alias("size")).filter("size > 1").drop("size")
        pairs = apart.join(hubs, "band").filter("node <> hub").select(*_pair("node", "hub")).distinct()
        pairs = _labelled(_labelled(pairs, roots, "a", "ra"), roots, "b", "rb").filter("ra <> rb").select("a", "b")
        near = scratch.written(_estimated(pairs, sketches).select("a", "b"), "near")
        found = _verified(sets, near, scratch)
        links = found if links is None else links.unionByName(found)
        roots = components(links, scratch)
        # who is not in the hub's component tries another hub next
        placed = _labelled(apart.join(hubs, "band"), roots)
        apart = _labelled(placed, roots, "hub", "hub_root").filter("root <> hub_root").select("band", "node", "popular", "n")
        apart = scratch.written(apart, "apart")
        if apart.isEmpty():
            break
    placed = scratch.written(_labelled(open_members.select("band", "node", "n"), roots), "placed")
    placed = _crossing(sets, placed, scratch)
    sized = placed.groupBy("band").agg(F.count("*").alias("size"), F.count_distinct("root").alias("roots")).filter("roots > 1")
    sized = scratch.written(placed.join(sized.drop("roots"), "band"), "sized")
    # pairs of a small bucket are at most FEW_COMPONENTS for each member
    few = F.col("size") <= FEW_COMPONENTS
    x = sized.filter(few).select("band", F.col("node").alias("x"), F.col("root").alias("rx"))
    y = sized.filter(few).select("band", F.col("node").alias("y"), F.col("root").alias("ry"))
    rest = x.join(y, "band").filter("rx < ry").select(*_pair("x", "y")).distinct()
    dense = scratch.written(_hubbed(sized.filter(~few)), "dense")
    if not dense.isEmpty():
        rest = rest.unionByName(_by_shingles(sets, dense, scratch)).distinct()
    near = scratch.written(_estimated(rest, sketches).select("a", "b"), "rest")
    if not near.isEmpty():
        roots = components(links.unionByName(_verified(sets, near, scratch)), scratch)
    return roots


def _grouped(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(id, row, n, root, component): a written table with a line for every row of ``docs``. ``row`` is a hash of id and text,
    ``root`` a number of the group, which tells groups apart whose smallest ids are equal."""
    texts = docs.select(F.col(key).alias("id"), F.xxhash64(F.col(key), F.col(text)).alias("row"), F.col(text).cast("binary").alias("_text"))
    longs = [T.StructField(c, T.LongType()) for c in ("row", "n", "key_a", "key_b")]
    with Scratch(docs.sparkSession, "near-dedup") as scratch:
        schema = T.StructType([texts.schema["id"], *longs, T.StructField("registers", T.ArrayType(T.ShortType()))])
        every = scratch.written(texts.mapInArrow(sketch, schema), "sketches")
        linked = every.filter("n > 0 and id is not null")
        first = F.min_by(F.struct("row", "n", "registers"), "row").alias("s")
        classes = linked.groupBy("key_a", "key_b").agg(F.min("id").alias("least"), first).select("key_a", "key_b", "least", "s.*")
        # numbers that the written table fixes
        classes = scratch.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        sketches = classes.select("node", "n", "registers")
        bands = scratch.written(sketches.select("node", "registers").mapInArrow(banded, "band long, node long"), "bands")
        crowded = bands.groupBy("band").agg(F.count("*").alias("size")).filter("size > 1").select("band")
        members = scratch.written(bands.join(crowded, "band"), "members")
        nodes = scratch.written(members.select("node").distinct(), "nodes")
        roots = None
        number = nodes.count()
        if number:
            sets = _sets(texts.filter("id is not null"), classes, nodes, scratch)
            asked = sketches.join(F.broadcast(nodes) if number <= FEW_IDS else nodes, "node", "left_semi")
            roots = _links(members, scratch.written(asked, "asked"), sets, scratch)
        placed = _labelled(classes.select("key_a", "key_b", "least", "node"), roots)
        smallest = placed.groupBy("root").agg(F.min("least").alias("component"))
        final = placed.join(smallest, "root").select("key_a", "key_b", "root", "component")
        joined = every.join(final, ["key_a", "key_b"], "left")
        component = F.when(F.col("n") == 0, F.col("id")).otherwise(F.when(F.col("id").isNotNull(), F.col("component")))
        return written(joined.select("id", "row", "n", "root", component.alias("component")), "near-dedup")


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row of ``docs``."""
    kept = F.coalesce(F.col("id") == F.col("component"), F.lit(True))
    return _grouped(docs, key, text).select(F.col("id").alias(key), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), kept.alias("kept"))


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group: of those with the smallest id, the one with the smallest hash. Rows that repeat id
    and text are one document, also without a word; rows with a null id all stay."""
    found = _grouped(docs, key, text).filter("id is not null")
    spark = docs.sparkSession
    with Scratch(spark, "dropped") as scratch:
        lost = found.filter("id <> component").select("id", "row")
        kept = found.filter("id = component")
        several = kept.filter("n > 0").groupBy("root").agg(F.min("row").alias("stays"), F.max("row").alias("last")).filter("stays < last")
        lost = lost.unionByName(kept.filter("n > 0").join(several, "root").filter("row <> stays").select("id", "row"))
        repeated = scratch.written(kept.groupBy("id", "row").agg(F.count("*").alias("k")).filter("k > 1").select("id", "row"), "repeated")
        dropped = written(lost.distinct().select(F.col("id").alias("_id"), F.col("row").alias("_row")), "dropped")
        same = lambda table: (docs[key] == table["_id"]) & (F.xxhash64(docs[key], docs[text]) == table["_row"])
        few = dropped.count() <= FEW_IDS
        stay = docs.join(F.broadcast(dropped) if few else dropped, same(dropped), "left_anti")
        if repeated.isEmpty():
            return stay
        again = written(repeated.select(F.col("id").alias("_id"), F.col("row").alias("_row")), "repeated")
    once = stay.join(again, same(again), "left_semi").dropDuplicates([key, text])
    return stay.join(again, same(again), "left_anti").unionByName(once)

"""Helpers the training-data operators share: folds, samples, written tables, and blocks of text as arrays."""

from __future__ import annotations

import ctypes
import functools
import platform
import tempfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text a task turns into arrays at a time; a longer document is a block of its own.
BLOCK_BYTES = 1 << 20
#: Documents in a block at most: matrices with a row per document stay small, however short the texts are.
BLOCK_ROWS = 256
#: Rows of an Arrow batch where whole documents go through Python; of blocks, a whole number.
ARROW_ROWS = 4 * BLOCK_ROWS
#: Bytes of text in a sample of labelled documents, unless the caller says less.
SAMPLE_BYTES = 64 << 20

#: Every byte that separates words.
_SPACES = np.zeros(256, dtype=bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True

_POWER = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_POWER), -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: ``spark.checkpoint.dir``, or a new one if the session runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="qualitypipe-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def written(frame: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, and safe when an executor is lost."""
    path = f"{shared_folder(frame.sparkSession)}/qualitypipe-llm/{name}-{uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


class Scratch:
    """Written tables that one call of an operator needs until it has written its result; then they go."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/qualitypipe-llm/{name}-{uuid4().hex}"

    def written(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}-{uuid4().hex[:8]}"
        frame.write.parquet(path)
        return self.spark.read.schema(frame.schema).parquet(path)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def fold(key: Column | str, modulus: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as an empty text."""
    column = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sample_by_class(rows: DataFrame, label: str, per_class: int, max_classes: int = 256) -> DataFrame:
    """At most about ``per_class`` rows of each label, chosen by a hash of the row, so that reruns agree.

    Two scans of the labels; rows are kept by a threshold on their hash that follows the class size.
    """
    sizes = rows.groupBy(label).count().limit(max_classes + 1).collect()
    if len(sizes) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label}")
    rows = rows.withColumn("_draw", F.pmod(F.xxhash64(*rows.columns), F.lit(1 << 30)))
    if not sizes:
        return rows
    limit = F.lit(0)
    for value, size in sizes:
        share = min(1.0, 1.2 * per_class / size)
        limit = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(int(share * (1 << 30)) + 1)).otherwise(limit)
    # copies of a row draw alike, and count once
    drawn = rows.filter(F.col("_draw") < limit).distinct()
    return drawn.orderBy("_draw", *rows.columns[:-1]).limit(2 * per_class * len(sizes))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, train: Column, per_class: int, most_bytes: int = SAMPLE_BYTES
) -> list[tuple]:
    """(text, label) of a bounded number of labelled documents, and of bytes of their texts.

    The labels are cut first, then joined. An id may have many texts, so rows and bytes are cut again behind the join: whole documents in
    the order of a hash, up to ``most_bytes`` of text, none of more than a sixteenth of that. A document with several labels counts by the largest one, an id
    with equal texts by one of them; null ids, labels and texts take no part.
    """
    rows = labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id is not null and label is not null")
    rows = rows.filter(train).groupBy("doc_id").agg(F.max("label").alias("label"))
    few = sample_by_class(rows, "label", per_class, max_classes=64).select("doc_id", "label")
    # at most 2 * per_class rows a class, by the limit of the sample
    joined = docs.select("doc_id", "text").filter(F.octet_length("text") <= most_bytes // 16).join(F.broadcast(few), "doc_id").distinct()
    place = [F.xxhash64("doc_id").alias("_draw"), "doc_id", F.xxhash64("text").alias("_text_draw")]
    with Scratch(docs.sparkSession, "labelled-sample") as scratch:
        drawn = scratch.written(joined.select(*place, "label", "text"), "texts")
        order = ["_draw", "doc_id", "_text_draw"]
        most = 2 * per_class * drawn.select("label").distinct().count()
        sizes = drawn.select(*order, F.octet_length("text").alias("_size")).orderBy(*order).limit(most).collect()
        last, total = None, 0
        for row in sizes:
            total += row["_size"]
            if total > most_bytes:
                break
            last = row
        if last is None:
            return []
        upto = F.struct(*order) <= F.struct(*[F.lit(last[c]).alias(c) for c in order])
        return [(r.text, r.label) for r in drawn.filter(upto).orderBy("_draw", "doc_id", "text").collect()]


def narrow_batches(spark: SparkSession) -> None:
    """Arrow batches of ``ARROW_ROWS`` from now on, unless the session was given a number: the JVM and Python both hold a batch outside
    the heap, and the JVM's allocator keeps the room of the largest."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(ARROW_ROWS))


def give_back() -> None:
    """Freed arrays and Arrow buffers go back to the system; their allocators would keep them as the process's memory."""
    pa.default_memory_pool().release_unused()
    if platform.libc_ver()[0] == "glibc":
        ctypes.CDLL(None).malloc_trim(0)


def gives_back(fit: Callable) -> Callable:
    """A fit, or a step of one, that leaves no freed arrays with the driver."""

    @functools.wraps(fit)
    def fitted(*arguments, **named):
        model = fit(*arguments, **named)
        give_back()
        return model

    return fitted


def leaves_little(function: Callable) -> Callable:
    """A map over batches that leaves no freed arrays with its worker, which waits for other tasks beside the executor."""

    @functools.wraps(function)
    def mapped(batches):
        try:
            yield from function(batches)
        finally:
            give_back()

    return mapped


class Block:
    """Some documents as one byte array.

    ``rows`` are the arrow columns, ``data`` the bytes of all texts in a row, ``start`` and ``end`` the bounds
    of each document, ``doc`` the document of each byte.
    """

    def __init__(self, rows: pa.RecordBatch | None, data: np.ndarray, offsets: np.ndarray):
        self.rows, self.data = rows, data
        self.start, self.end = offsets[:-1], offsets[1:]
        self.size = len(self.start)
        self.doc = np.repeat(np.arange(self.size), self.end - self.start)

    def words(self, table: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, first and last+1 byte of every word, by the separators or a table of the bytes of words."""
        inside = ~_SPACES[self.data] if table is None else table[self.data]
        edge = np.zeros(len(inside) + 1, dtype=bool)
        edge[self.start[self.start < len(inside)]] = True
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:] | edge[1:-1]
        begin = np.flatnonzero(first)
        return self.doc[begin], begin, np.flatnonzero(last) + 1

    def word_hashes(self, begin: np.ndarray, stop: np.ndarray, data: np.ndarray | None = None) -> np.ndarray:
        """A 64-bit hash of the bytes from begin to stop: polynomial over bytes and length, then mixed."""
        return self.word_hashes_of([(begin, stop)], data)[0]

    def word_hashes_of(self, ranges: list[tuple[np.ndarray, np.ndarray]], data: np.ndarray | None = None) -> list[np.ndarray]:
        """Hashes of several lists of ranges, with one pass over the bytes."""
        data = self.data if data is None else data
        up, down = _powers(len(data))
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return [mix((total[stop] - total[begin]) * down[begin] + (stop - begin).astype(np.uint64) * _POWER) for begin, stop in ranges]


def _powers(n: int) -> list[np.ndarray]:
    """Powers 0 to n of an odd number and of its inverse, modulo 2**64."""
    out = []
    for base in (_POWER, _INVERSE):
        grown = np.full(n + 1, base, dtype=np.uint64)
        grown[0] = 1
        out.append(np.multiply.accumulate(grown))
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits (a multiply-xorshift finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_bytes(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z lower-cased."""
    return np.where((data >= 65) & (data <= 90), data | np.uint8(32), data)


def blocks_of(texts: list[str], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of texts on the driver, for fitting."""
    yield from blocks([pa.RecordBatch.from_pydict({"text": pa.array([t.encode() for t in texts], pa.binary())})], limit=limit)


def blocks(batches, column: str = "text", limit: int = BLOCK_BYTES, rows: int = BLOCK_ROWS) -> Iterator[Block]:
    """Cuts arrow batches into blocks of whole documents, by bytes and rows; a null text counts as empty."""
    for batch in batches:
        texts = batch.column(column)
        if not pa.types.is_binary(texts.type) and not pa.types.is_large_binary(texts.type):
            texts = texts.cast(pa.binary() if pa.types.is_string(texts.type) else pa.large_binary())
        texts = pc.fill_null(texts, b"")
        if not len(texts):
            continue
        wide = pa.types.is_large_binary(texts.type)
        width = np.int64 if wide else np.int32
        ends = np.frombuffer(texts.buffers()[1], dtype=width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
        at = 0
        while at < len(texts):
            to = min(at + rows, max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1))
            offsets = ends[at : to + 1]
            yield Block(batch.slice(at, to - at), data[offsets[0] : offsets[-1]], offsets - offsets[0])
            at = to


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -50, 50)))


class Adam:
    """Plain Adam steps over a dictionary of arrays."""

    def __init__(self, weights: dict[str, np.ndarray], rate: float):
        self.weights, self.rate, self.t = weights, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in weights.items()}
        self.v = {k: np.zeros_like(v) for k, v in weights.items()}

    def step(self, gradients: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in gradients.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            m, v = self.m[k] / (1 - 0.9**self.t), self.v[k] / (1 - 0.999**self.t)
            self.weights[k] -= self.rate * m / (np.sqrt(v) + 1e-8)

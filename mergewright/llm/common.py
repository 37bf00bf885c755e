"""What several training-data operators share: scratch tables, whole-text word hashing, components."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import scratch
from ..shipping import by_value

by_value(__name__)

#: Bytes that separate words: space and \t \n \v \f \r.
SPACE_BYTES = (32, 9, 10, 11, 12, 13)
SPACE_CHARS = " \t\n\x0b\f\r"
#: Bytes of text that a Python worker handles at once; numpy temporaries are about 60 times as large.
CHUNK_BYTES = 1 << 20


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write df to a fresh table in the shared folder and read it back: lineage ends there, and its size is known."""
    return scratch.staged(df, name)


def unstash(*dfs: DataFrame) -> None:
    """Remove tables that stash() wrote and nothing reads any more."""
    scratch.drop(*dfs)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps, which nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession) -> None:
    """Batches of few documents and bytes, to Python and from Parquet, for some documents are long: a batch of 4096 rows, Spark's
    default, is one array of over 16 MB for texts of 4 KB."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", 500), ("spark.sql.parquet.columnarReaderBatchSize", 512)):
        if int(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def let(value: Column, f) -> Column:
    """f(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), f), 1)


def few(df: DataFrame, rows: int, each: int = 100_000) -> DataFrame:
    """df, whose last step is cheap and gives up to `rows` rows, in no more partitions than these fill: a file for each
    shuffle partition would cost more than its rows."""
    return df.coalesce(max(4, min(n_shuffle(df.sparkSession), -(-rows // each))))


def tidy(run: Callable) -> Callable:
    """run, a function over Arrow batches; at its end the memory that numpy and Arrow have freed goes back to the system, for
    Python workers stay alive between tasks and would hold it while others work."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            getattr(ctypes.CDLL(None), "malloc_trim", lambda _: None)(0)

    return tidied


def n_shuffle(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# ---------------------------------------------------------------- records by destination


def destinations(df: DataFrame) -> int:
    """Sixteen for each partition of the shuffle: a Python worker holds the records of one at a time."""
    return 16 * n_shuffle(df.sparkSession)


def one_by_one(batches, *columns: str) -> Iterator[tuple]:
    """(destination, values of each column) for each destination in turn; rows come sorted by it."""
    now, held = None, [[] for _ in columns]
    for batch in batches:
        for dest, *values in zip(batch.column("dest").to_pylist(), *(batch.column(c).to_pylist() for c in columns), strict=True):
            if dest != now and held[0]:
                yield now, *held
                held = [[] for _ in columns]
            now = dest
            for h, v in zip(held, values, strict=True):
                h.append(v)
    if held[0]:
        yield now, *held


def dealt(df: DataFrame) -> DataFrame:
    """df by destination, sorted, so that workers take one after the other; Spark's sort can spill."""
    return df.repartition(n_shuffle(df.sparkSession), "dest").sortWithinPartitions("dest")


# ---------------------------------------------------------------- words and hashes in numpy

_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLDED = _BYTE.copy()
_FOLDED[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACE_BYTES)] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept by the worker."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, CHUNK_BYTES + 64)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public-domain murmur3 constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes of their texts end to end, offsets): parts of a batch of about `limit` bytes; a longer text stands alone. Null reads as empty."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    if len(texts) == 0:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of each word, in order; fold: A-Z as a-z."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    space = _SPACE[data]
    first, last = np.empty(n, bool), np.empty(n, bool)
    first[0] = last[-1] = True
    first[1:] = space[:-1]
    last[:-1] = space[1:]
    cuts = offsets[1:-1]
    first[cuts[cuts < n]] = True
    last[cuts[cuts > 0] - 1] = True
    start, end = np.flatnonzero(first & ~space), np.flatnonzero(last & ~space) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((_FOLDED if fold else _BYTE)[data] * powers(_BASE, n), out=sums[1:])
    h = (sums[end] - sums[start]) * powers(_INVERSE, n)[start]
    return mix(h + (end - start).astype(np.uint64)), np.searchsorted(offsets, start, "right") - 1


# ---------------------------------------------------------------- connected components


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): for each node of the edges the smallest node that it reaches.

    Alternating large-star and small-star steps (Kiveris et al. 2014) as joins of each node's
    smallest neighbour; partial aggregation and skew joins bear hubs. Nothing goes to the driver but counts.
    """
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    e = stash(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    rows, before = e.count(), None
    while True:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").distinct()
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        # Edges never get more.
        new = stash(few(small.where("u <> v").distinct(), rows), "edges")
        unstash(e)
        e = new
        state = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if state == before:
            break
        rows, before = state[0], state
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select(F.col("v"), F.col("v")).distinct())

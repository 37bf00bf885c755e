"""Vector bin packing of documents into shards.

Bytes, tokens and rows are balanced jointly: each group of equal texts goes to the shard whose residual capacity has the
highest dot product with the group's vector, bytes weighing most, for the law that holds is `bytes`. This takes three steps:

1. Heavy groups, of over 1 / HEAVY of a shard, are placed on the driver, largest first; there are only so many. A group
   that no shard could hold is dealt out in pieces.
2. Light groups are dealt to the tasks of a shuffle. Each task has its part of every shard's residual capacity and places
   its groups by it, largest first.
3. A random set of up to BALANCE light groups waits till then, goes to the driver and evens out what the tasks have left.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..shipping import by_value
from .common import SPACE_CHARS, few, n_shuffle, stash, tidy, unstash

by_value(__name__)

#: A group over 1 / HEAVY of a shard's bytes, tokens or rows is heavy; one over a shard is cut into pieces of 1 / PIECE of it.
HEAVY, PIECE = 64, 16
#: Light groups that the driver places last.
BALANCE = 4096
#: Weights of bytes, tokens and rows in the dot product.
WEIGHTS = (4.0, 1.0, 1.0)
#: The rows of a shard are numbered in parts of about RANKED rows, RANKS parts at least.
RANKS, RANKED = 64, 200_000


def place(vectors: np.ndarray, left: np.ndarray, total: np.ndarray, load: np.ndarray, weights: tuple[float, float, float] = WEIGHTS) -> np.ndarray:
    """The shard of each item: largest first, to the highest dot product with residual capacity `left` (shards, dimensions, as
    shares of `total`; it is used up). Moves and swaps of items then even out the first dimension, of which shards hold `load`."""
    n, shards = len(vectors), len(left)
    where = np.zeros(n, np.int64)
    if n == 0:
        return where
    v = vectors / np.maximum(total, 1)
    w = np.asarray(weights)
    for i in np.lexsort((np.arange(n), -v.max(1))):
        s = int(np.argmax(left @ (v[i] * w)))
        where[i] = s
        left[s] -= v[i]
    size = vectors[:, 0].astype(np.int64)
    load = load + np.bincount(where, size, shards).astype(np.int64)
    for _ in range(40 * shards):
        hi, lo = int(load.argmax()), int(load.argmin())
        gap = int(load[hi] - load[lo])
        mine, theirs = np.flatnonzero(where == hi), np.flatnonzero(where == lo)
        if gap <= 1 or not len(mine):
            break
        # For each item of the fullest shard the item of the emptiest, or none, that is nearest to half the gap smaller.
        sizes = np.append(size[theirs], 0)
        order = np.argsort(sizes, kind="stable")
        theirs, sizes = np.append(theirs, -1)[order], sizes[order]
        at = np.clip(np.searchsorted(sizes, size[mine] - gap // 2), 1, len(sizes)) - 1
        near = np.stack([at, np.minimum(at + 1, len(sizes) - 1)])
        moved = size[mine] - sizes[near]
        good = np.where((moved > 0) & (moved < gap), np.abs(moved - gap / 2), np.inf)
        k = np.unravel_index(int(good.argmin()), good.shape)
        if not np.isfinite(good[k]):
            break
        i, j, d = mine[k[1]], theirs[near[k]], int(moved[k])
        where[i] = lo
        if j >= 0:
            where[j] = hi
        load[hi] -= d
        load[lo] += d
    return where


def place_light(groups: DataFrame, left: np.ndarray, total: np.ndarray, parts: dict[int, np.ndarray], rest: np.ndarray) -> DataFrame:
    """(g, h, shard) of light groups (g, h, part, size, tokens, rows). A part of them has its share, by what it holds of
    `rest`, of the residual capacity `left`. Rows come part by part, largest first, so a task holds one part's capacity only."""
    shared = groups.sparkSession.sparkContext.broadcast((left, total, parts, rest))

    def run(batches):
        left, total, parts, rest = shared.value
        w, now, own = np.asarray(WEIGHTS) / np.maximum(total, 1), None, None
        for batch in batches:
            vectors = np.stack([batch.column(c).to_numpy() for c in ("size", "tokens", "rows")], 1).astype(np.float64)
            weighed, shares, out = vectors * w, vectors / np.maximum(total, 1), np.zeros(len(vectors), np.int32)
            for i, part in enumerate(batch.column("part").to_pylist()):
                if part != now:
                    now, own = part, left * (parts[part] / np.maximum(rest, 1))
                s = int((own @ weighed[i]).argmax())
                out[i] = s
                own[s] -= shares[i]
            yield pa.RecordBatch.from_arrays([batch.column("g"), batch.column("h"), pa.array(out)], ["g", "h", "shard"])

    dealt = groups.repartition(n_shuffle(groups.sparkSession), "part").sortWithinPartitions("part", F.desc("size"), "g", "h")
    return dealt.mapInArrow(tidy(run), "g long, h long, shard int")


def capacity(held: np.ndarray, total: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """Residual capacity of shards that hold `held`, for groups that sum up to `rest`: in bytes what is left to an equal share, for
    that law holds; in tokens and rows that part of theirs which the shard gets of the bytes."""
    left = total[0] / len(held) - held[:, 0]
    return np.outer(left / max(rest[0], 1), rest) / np.maximum(total, 1)


def shard(docs: DataFrame, n_shards: int = 24) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens for each row of docs (doc_id, text).

    A null text has size 8 and CRC 0 and groups with empty ones. Rows with null or repeated doc_id are rows like others.
    Equal texts (by 128 bits of hash) share a shard unless together they are more than one holds. Slots number the rows of
    a shard. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text"), F.lit(""))
    base = stash(
        docs.select(
            F.col("doc_id"),
            (F.octet_length(text).cast("long") + F.lit(8)).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            (F.length(text) - F.length(F.translate(text, SPACE_CHARS, "")) + 1).cast("long").alias("tokens"),
            F.xxhash64(text).alias("g"),
            F.xxhash64(F.lit(1), text).alias("h"),
            F.monotonically_increasing_id().alias("row"),
        ),
        "sizes",
    )
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count("*").alias("rows")]
    vector = lambda r: np.array([r["size"] or 0, r["tokens"] or 0, r["rows"] or 0], np.float64)
    total = vector(base.agg(*sums).first())
    share = np.maximum(total / n_shards, 1)
    n = int(total[2])
    groups = stash(few(base.groupBy("g", "h").agg(*sums).withColumn("part", F.pmod("h", F.lit(n_shuffle(spark))).cast("int")), n), "groups")
    of_shard = F.greatest(*[F.col(c) / float(x) for c, x in zip(("size", "tokens", "rows"), share, strict=True)])
    # At most 3 * HEAVY * n_shards groups.
    heavy = sorted(groups.where(of_shard > 1 / HEAVY).select("g", "h", "size", "tokens", "rows", of_shard.alias("of")).collect(), key=lambda r: (r.g, r.h))
    cut = {(r.g, r.h): int(np.ceil(r.of * PIECE)) for r in heavy if r.of > 1}
    # Pieces by row; at most 3 * PIECE * (n_shards + 1) of them.
    pieces = spark.createDataFrame([(g, h, n) for (g, h), n in cut.items()], "g long, h long, pieces int")
    rows = base.join(F.broadcast(pieces), ["g", "h"], "left").withColumn("piece", F.when(F.col("pieces").isNotNull(), F.pmod(F.xxhash64("row"), F.col("pieces"))).otherwise(0).cast("int"))
    items = [(r.g, r.h, 0, vector(r)) for r in heavy if r.of <= 1]
    if cut:
        items += [(r.g, r.h, r.piece, vector(r)) for r in rows.where("pieces IS NOT NULL").groupBy("g", "h", "piece").agg(*sums).collect()]
    items.sort(key=lambda t: t[:3])
    left = np.full((n_shards, 3), 1.0 / n_shards)
    load = np.zeros(n_shards, np.int64)
    where = place(np.array([t[3] for t in items]).reshape(-1, 3), left, total, load)
    placed = [(*t[:3], int(s)) for t, s in zip(items, where, strict=True)]
    # `left` doesn't have the moves.
    held = np.zeros((n_shards, 3))
    for t, s in zip(items, where, strict=True):
        held[s] += t[3]
    light = groups.where(of_shard <= 1 / HEAVY)
    n_light = light.count()
    waits = F.pmod(F.xxhash64("g", "h"), F.lit(max(1, -(-2 * n_light // BALANCE)))) == 0
    if n_light <= BALANCE:
        waits = F.lit(True)
    early = light.where(~waits)
    parts = {r.part: vector(r) for r in early.groupBy("part").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")).collect()}
    rest = sum(parts.values(), np.zeros(3))
    after = total - held.sum(0) - rest  # what waits
    homes = stash(few(place_light(early, capacity(held, total, rest + after) * (rest / np.maximum(rest + after, 1)), total, parts, rest), n_light), "homes")
    for r in homes.join(early, ["g", "h"]).groupBy("shard").agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.sum("rows").alias("rows")).collect():
        held[r.shard] += vector(r)
    # BALANCE groups in expectation at half that number.
    last = sorted(light.where(waits).select("g", "h", "size", "tokens", "rows").collect(), key=lambda r: (r.g, r.h))
    where = place(np.array([vector(r) for r in last]).reshape(-1, 3), capacity(held, total, after), total, held[:, 0].astype(np.int64))
    placed += [(r.g, r.h, 0, int(s)) for r, s in zip(last, where, strict=True)]
    known = F.broadcast(spark.createDataFrame(placed, "g long, h long, piece int, shard int"))
    some = rows.join(known, ["g", "h", "piece"], "left")
    # Only rows of light groups are shuffled by group.
    out = some.where("shard IS NOT NULL").drop("pieces", "piece").unionByName(some.where("shard IS NULL").drop("pieces", "piece", "shard").join(homes, ["g", "h"]))
    ranks = max(RANKS, int(share[2]) // RANKED)
    out = stash(few(out.select("doc_id", "size", "text_crc32", "tokens", "shard", "row", F.pmod("row", F.lit(ranks)).cast("int").alias("rank")), n), "placed")
    unstash(groups, homes)
    # A row for each part.
    firsts, at = [], {}
    for r in sorted(out.groupBy("shard", "rank").count().collect(), key=lambda r: (r.shard, r["rank"])):
        firsts.append((r.shard, r["rank"], at.get(r.shard, 0)))
        at[r.shard] = at.get(r.shard, 0) + r["count"]
    firsts = F.broadcast(spark.createDataFrame(firsts, "shard int, rank int, first long"))
    place_ = F.row_number().over(Window.partitionBy("shard", "rank").orderBy("row"))
    return out.withColumn("k", place_).join(firsts, ["shard", "rank"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("first") + F.col("k") - 1).cast("long").alias("slot"),
        F.lit(None).cast(T.IntegerType()).alias("grown_shard"),
        "tokens",
    )


def op2_vector_bin_packing(spark, sf_dir: str) -> DataFrame:
    return shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""N-gram Jaccard join by parity sketches.

A document is the set of its hashed five-word shingles. Sets of sizes 4**i to 4**(i+1) form a band. In a band's
sketch the hash range is cut into 4**(i+1) segments of 2**32 bits, so that the members of a set share segments; each
shingle flips one bit of its segment, so that the
Hamming distance of two sketches is at most the symmetric difference of the sets. Jaccard similarity of s percent
allows a symmetric difference of d = (100 - s) * (a + b) / (100 + s), so that at most d segments differ (pigeonhole).
Of the non-empty segments of a set, in one global order, the first d + 1 therefore include one that is equal in both;
only these are joined (by a fingerprint of their parities). The order puts segments with a rare shingle first, by a count-min sketch
of fixed size over all documents. A set also joins the next lower band if a partner there is possible.

Pairs whose folded sketches (two to four bits for each shingle) differ in more than d bits are dropped; the others are
verified exactly, as far as they can still join components: first each set with its nearest partner, then the pairs
that are still in different components. A group with a common segment gives pairs with one of its sets at first, and
the pairs of its sets that are in different components then, so no link that joins components is lost.

Sets are named by a sum of their mixed hashes (64 bits); a second such sum tells sets of one name apart, and a name that
two sets share is given up for both. Documents with equal sets are one set throughout.
"""

from __future__ import annotations

import zlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import by_value
from .common import components, dealt, destinations, few, mix, n_shuffle, one_by_one, release, small_batches, stash, text_chunks, tidy, unstash, word_hashes

by_value(__name__)

#: Shingle length in words and least Jaccard similarity in percent.
WORDS, PERCENT = 5, 75
#: Counters of the count-min sketch, and parts in which it is merged.
COUNTERS, SLICES = 1 << 25, 64
#: Sets of a block; pairs of blocks are compared in a task.
BLOCK = 768
#: Up to so many rows of two numbers (8 MB) go to every executor, so that texts need no shuffle; beyond, texts are shuffled.
BROADCAST_ROWS = 500_000
#: Rows with sketches, and pairs with whole sets, that a pass shuffles at least.
PASS_ROWS, PASS_PAIRS = 1_000_000, 100_000
_MIX = mix(np.arange(1, 17, dtype=np.uint64))
_RECORD = np.dtype([("sig", "<u8"), ("node", "<u8")])
#: Of a signature 40 bits travel; the others have chosen the destination.
_SHORT = (1 << 40) - 1


def write_records(r: np.ndarray) -> bytes:
    """Records sorted by short signature: its bytes, highest first, as planes that compress, then the sets."""
    return b"".join((r["sig"] >> np.uint64(8 * k)).astype(np.uint8).tobytes() for k in (4, 3, 2, 1, 0)) + r["node"].tobytes()


def read_records(raw: bytes) -> np.ndarray:
    n = len(raw) // 13
    out = np.zeros(n, _RECORD)
    for k in range(5):
        out["sig"] = (out["sig"] << np.uint64(8)) | np.frombuffer(raw, np.uint8, n, k * n)
    out["node"] = np.frombuffer(raw, "<u8", n, 5 * n)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document index) of the distinct shingles, sorted by document and hash. A text of fewer words is one shingle."""
    h, d = word_hashes(data, offsets)
    docs = len(offsets) - 1
    out, own = [], []
    if len(h) >= words:
        g = np.zeros(len(h) - words + 1, np.uint64)
        for j in range(words):
            g += h[j : len(h) - words + 1 + j] * (_MIX[j] | np.uint64(1))
        inside = d[words - 1 :] == d[: len(h) - words + 1]
        out.append(mix(g[inside] + np.uint64(words)))
        own.append(d[words - 1 :][inside])
    count = np.bincount(d, minlength=docs)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    for k in range(1, words):
        short = np.flatnonzero(count == k)
        if len(short):
            g = np.zeros(len(short), np.uint64)
            for j in range(k):
                g += h[first[short] + j] * (_MIX[j] | np.uint64(1))
            out.append(mix(g + np.uint64(k)))
            own.append(short)
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    g, own = np.concatenate(out), np.concatenate(own)
    order = np.lexsort((g, own))
    g, own = g[order], own[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (own[1:] != own[:-1])
    return g[new], own[new]


def set_names(g: np.ndarray, own: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two names (independent hashes) and the size of each document's set; 0 for an empty one."""
    n = np.bincount(own, minlength=docs)
    ends = np.cumsum(n)

    def name(k: int) -> np.ndarray:
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(g ^ _MIX[k]))])
        return np.where(n > 0, mix(sums[ends] - sums[ends - n] + n.astype(np.uint64)), np.uint64(0))

    return name(9), name(11), n


def final_names(node: np.ndarray, other: np.ndarray, given_up: np.ndarray) -> np.ndarray:
    """The names, but for those given up (sorted) ones of both hashes."""
    if not len(given_up):
        return node
    met = given_up[np.minimum(np.searchsorted(given_up, node), len(given_up) - 1)] == node
    return np.where(met, mix(node ^ mix(other)), node)


def counter(g: np.ndarray) -> np.ndarray:
    return (g >> np.uint64(10)).astype(np.int64) & (COUNTERS - 1)


def sketches(g: np.ndarray, n: np.ndarray) -> list[bytes]:
    """Parity sketches of sets given one after the other: at least two bits for each member, a power of two of them."""
    out = []
    ends = np.cumsum(n)
    for k, e in zip(n.tolist(), ends.tolist(), strict=True):
        bits = 1 << max(6, (2 * k - 1).bit_length())
        at = (g[e - k : e] >> np.uint64(8)).astype(np.int64) & (bits - 1)
        out.append(np.packbits((np.bincount(at, minlength=bits) & 1).astype(bool), bitorder="little").tobytes() if k else b"")
    return out


def sketch_distance(x: bytes, y: bytes) -> int:
    """Hamming distance of two sketches, the longer one folded: at most the symmetric difference of the sets."""
    a, b = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return int(np.bitwise_count(a ^ b).sum())


def described(docs: DataFrame) -> DataFrame:
    """(doc_id, node, other, n, sketch) of each document; and rows with part, slice and counts: a task's share of the count-min sketch."""

    def run(batches):
        from pyspark import TaskContext

        counts, any_rows = np.zeros(COUNTERS, np.uint8), False
        names = ["doc_id", "node", "other", "n", "sketch", "part", "slice", "counts"]
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                any_rows = True
                g, own = shingle_sets(data, offsets)
                node, other, n = set_names(g, own, len(offsets) - 1)
                at, more = np.unique(counter(g), return_counts=True)
                counts[at] = np.minimum(counts[at] + more, 255)
                none = pa.nulls(len(n), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(node.view(np.int64)), pa.array(other.view(np.int64)), pa.array(n), pa.array(sketches(g, n), pa.binary()), none, none, pa.nulls(len(n), pa.binary())], names)
        if any_rows:
            blobs = [zlib.compress(x.tobytes(), 1) for x in np.split(counts, SLICES)]
            none = pa.nulls(SLICES, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [none, none, none, none, pa.nulls(SLICES, pa.binary()), pa.array([TaskContext.get().partitionId()] * SLICES, pa.int32()), pa.array(range(SLICES), pa.int32()), pa.array(blobs, pa.binary())], names
            )

    return docs.mapInArrow(tidy(run), "doc_id long, node long, other long, n long, sketch binary, part int, slice int, counts binary")


def rarity(shares: DataFrame) -> np.ndarray:
    """A class of rarity for each counter of the sum of all tasks' sketches, added in rounds of up to 64 shares: 0 for what
    may be noise, else eight for each doubling of the count. The driver gets one sketch of fixed size, slice by slice."""
    parts = (shares.agg(F.max("part")).first()[0] or 0) + 1
    shares = shares.select("part", "slice", "counts", F.lit(1).alias("width"))

    def add(batches):
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for part, at, width, blob in zip(*(batch.column(c).to_pylist() for c in ("part", "slice", "width", "counts")), strict=True):
                x = np.frombuffer(zlib.decompress(blob), f"<u{width}")
                key = (part // 64, at)
                if key in sums:
                    sums[key] += x
                else:
                    sums[key] = x.astype(np.uint32)
        for (part, at), x in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "slice": pa.array([at], pa.int32()), "counts": pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()), "width": pa.array([4], pa.int32())}
            )

    while True:
        to = max(1, min(SLICES * (parts // 64 + 1), n_shuffle(shares.sparkSession)))
        shares = shares.repartition(to, F.floor(F.col("part") / 64), "slice").mapInArrow(tidy(add), "part int, slice int, counts binary, width int")
        parts = (parts + 63) // 64
        if parts == 1:
            break
    total, classes = stash(shares, "counts"), np.zeros((SLICES, COUNTERS // SLICES), np.uint8)
    mean = 0.0
    for r in total.select(F.col("slice"), F.col("counts")).toLocalIterator():
        x = np.frombuffer(zlib.decompress(r.counts), "<u4")
        mean += float(x.mean()) / SLICES
        classes[r.slice] = np.where(x > 0, np.minimum(np.log2(np.maximum(x, 1)) * 8, 254).astype(np.uint8) + 1, 0)
    unstash(total)
    classes = classes.ravel()
    classes[classes <= 1 + 8 * np.log2(2 * mean + 2)] = 0
    return classes


def band_of(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(n, 1)) / 2).astype(np.int64)


def signatures(g: np.ndarray, own: np.ndarray, n: np.ndarray, classes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(signature, document index): the segments that each document has to show, in its own band and the next lower one."""
    sigs, owners = [], []
    band = band_of(n)
    rare = classes[counter(g)]
    for lower in (0, 1):
        low = 4 ** band
        if lower:
            limit = (100 - percent) * (low - 1 + n) // (100 + percent)
            wanted = (n > 0) & (band > 0) & (percent * n <= 100 * (low - 1))
        else:
            limit = (100 - percent) * n // percent
            wanted = n > 0
        scheme = band - lower
        use = wanted[own]
        if not use.any():
            continue
        t, o, r = g[use], own[use], rare[use]
        high = 4 ** (scheme[o] + 1)
        segments = np.where(high <= 64, 1 << 20, high).astype(np.uint64)
        seg = ((t >> np.uint64(32)) * segments) >> np.uint64(32)
        start = np.ones(len(t), bool)
        start[1:] = (seg[1:] != seg[:-1]) | (o[1:] != o[:-1])
        at = np.flatnonzero(start)
        bits = np.bitwise_xor.reduceat(mix((t & np.uint64(0xFFFFFFFF)) + _MIX[10]), at)
        sig = mix(bits + mix(seg[at] * np.uint64(64) + scheme[o[at]].astype(np.uint64)))
        # A segment is as rare as its rarest member.
        order_key = (np.minimum.reduceat(r, at).astype(np.uint64) << np.uint64(56)) | (sig >> np.uint64(8))
        o = o[at]
        order = np.lexsort((order_key, o))
        sig, o = sig[order], o[order]
        firsts = np.searchsorted(o, o, "left")
        keep = np.arange(len(o)) - firsts <= limit[o]
        sigs.append(sig[keep])
        owners.append(o[keep])
    if not sigs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(sigs), np.concatenate(owners)


def shown(docs: DataFrame, classes: np.ndarray, given_up: np.ndarray, percent: int) -> DataFrame:
    """(dest, records): packed (signature, set) records for each destination; a set once for each task."""
    spark = docs.sparkSession
    dests = destinations(docs)
    classes = spark.sparkContext.broadcast(classes)  # COUNTERS bytes

    def packed(records: list[np.ndarray]) -> pa.RecordBatch:
        r = np.concatenate(records)
        dest = ((r["sig"] >> np.uint64(40)) % np.uint64(dests)).astype(np.int64)
        order = np.lexsort((r["sig"] & np.uint64(_SHORT), dest))
        r, dest = r[order], dest[order]
        cuts = np.flatnonzero(np.diff(dest)) + 1
        return pa.RecordBatch.from_arrays(
            [pa.array(dest[np.concatenate([[0], cuts])].astype(np.int32)), pa.array([write_records(x) for x in np.split(r, cuts)], pa.binary())], ["dest", "records"]
        )

    def run(batches):
        seen: set[int] = set()
        held, size = [], 0
        for batch in batches:
            for _, data, offsets in text_chunks(batch, "text"):
                g, own = shingle_sets(data, offsets)
                node, other, n = set_names(g, own, len(offsets) - 1)
                node = final_names(node, other, given_up)
                new = np.zeros(len(n), bool)
                for i, x in enumerate(node.tolist()):
                    if n[i] and x not in seen:
                        seen.add(x)
                        new[i] = True
                if len(seen) > 1_000_000:
                    seen.clear()
                use = new[own]
                sig, o = signatures(g[use], own[use], n, classes.value, percent)
                r = np.empty(len(sig), _RECORD)
                r["sig"], r["node"] = sig, node[o]
                held.append(r)
                size += len(r)
                if size > 500_000:
                    yield packed(held)
                    held, size = [], 0
        if size:
            yield packed(held)

    return docs.mapInArrow(tidy(run), "dest int, records binary")


def met(records: DataFrame) -> DataFrame:
    """Groups of sets with a common signature: pairs (a, b) of its first set and each other one, and for groups of over two rows (sig, b) of all members."""

    def meet(dest: int, blobs: list[bytes]):
        r = np.concatenate([read_records(raw) for raw in blobs])
        r["sig"] |= np.uint64(dest << 40)
        r = r[np.lexsort((r["node"], r["sig"]))]
        sig, node = r["sig"], r["node"]
        new = np.ones(len(r), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node = sig[new], node[new]
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        sizes = np.diff(np.append(starts, len(sig)))
        size = np.repeat(sizes, sizes)
        some = size > 1
        sig, node, size = sig[some], node[some], size[some]
        lead = np.concatenate([[True], sig[1:] != sig[:-1]]) if len(sig) else np.zeros(0, bool)
        pivot = node[np.flatnonzero(lead)][np.cumsum(lead) - 1]
        large = size > 2
        a, b = pivot[~lead], node[~lead]
        if len(a):
            pairs = np.unique(np.stack([a, b], 1).view([("a", "<u8"), ("b", "<u8")]).ravel())
            for at in range(0, len(pairs), 100_000):
                p = pairs[at : at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(p["a"].copy().view(np.int64)), pa.array(p["b"].copy().view(np.int64)), pa.nulls(len(p), pa.int64())], ["a", "b", "sig"])
        s, m = sig[large], node[large]
        for at in range(0, len(s), 100_000):
            x = m[at : at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.nulls(len(x), pa.int64()), pa.array(x.view(np.int64)), pa.array(s[at : at + 100_000].view(np.int64))], ["a", "b", "sig"])

    def run(batches):
        for dest, blobs in one_by_one(batches, "records"):
            yield from meet(dest, blobs)

    return dealt(records).mapInArrow(tidy(run), "a long, b long, sig long")


def n_passes(rows: int, most: int) -> int:
    """Passes of about `most` rows each. Rows that carry sketches or sets are shuffled pass by pass, so that disk follows the
    number of sets where chance meetings grow faster than that."""
    return max(1, -(-rows // most))


def turn(df: DataFrame, k: int, i: int, *columns: str) -> DataFrame:
    """The rows of df for pass i of k."""
    return df if k == 1 else df.where(F.pmod(F.xxhash64(*columns, F.lit(7)), F.lit(k)) == i)


def in_turns(k: int, make, name: str, spark) -> DataFrame:
    """make(0) to make(k - 1) as one table each; the shuffle files of a pass go before the next."""
    parts = []
    for i in range(k):
        parts.append(stash(make(i), name))
        release(spark)
    out = reduce(DataFrame.union, parts)
    out.parts = parts
    return out


def near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, far) of the pairs (a, b) that their sizes and sketches allow to be similar; far: sketch distance to total size."""

    def run(batches):
        for batch in batches:
            far, keep = [], []
            for n, m, x, y in zip(*(batch.column(c).to_pylist() for c in ("n", "m", "x", "y")), strict=True):
                d = sketch_distance(x, y)
                keep.append(d * (100 + percent) <= (100 - percent) * (n + m))
                far.append(d / (n + m))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(far, pa.float64())], ["a", "b", "far"]).filter(pa.array(keep, pa.bool_()))

    left = classes.select(F.col("node").alias("a"), "n", F.col("sketch").alias("x"))
    right = classes.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    # Sizes first, so that few sketches travel.
    fit = pairs.join(left.select("a", "n"), "a").join(right.select("b", "m"), "b").where(f"{percent} * greatest(n, m) <= 100 * least(n, m)")
    return fit.join(left.select("a", "x"), "a").join(right.select("b", "y"), "b").select("a", "b", "n", "m", "x", "y").mapInArrow(tidy(run), "a long, b long, far double")


def sets_of(docs: DataFrame, nodes: DataFrame, classes: DataFrame, given_up: np.ndarray) -> DataFrame:
    """(node, members) of the named sets, from a document of each; members: sorted hashes of 48 bits, in 6 bytes each."""
    wanted = stash(classes.join(nodes, "node").select(F.col("rep").alias("doc_id"), "node"), "wanted")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)

    def run(batches):
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                g, own = shingle_sets(data, offsets)
                node, other, n = set_names(g, own, len(offsets) - 1)
                node = final_names(node, other, given_up)
                want = part.column("node").to_numpy().view(np.uint64)
                ends = np.cumsum(n)
                raw = np.ascontiguousarray((g >> np.uint64(16)).astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :6]
                right = np.flatnonzero(node == want)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[right].view(np.int64)), pa.array([raw[ends[i] - n[i] : ends[i]].tobytes() for i in right], pa.binary())], ["node", "members"]
                )

    return docs.join(wanted, "doc_id").select("text", "node").mapInArrow(tidy(run), "node long, members binary")


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose sets are similar, by exact intersection."""

    def members(raw: bytes) -> np.ndarray:
        x = np.zeros((len(raw) // 6, 8), np.uint8)
        x[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
        return x.view("<u8").ravel()

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                small, large = sorted((len(x), len(y)))
                if small * 100 < percent * large:
                    keep.append(False)
                    continue
                both = np.concatenate([members(x), members(y)])
                both.sort(kind="stable")
                common = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(100 * common >= percent * (len(both) - common))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("node").alias("a"), F.col("members").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("members").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long").distinct()


def verified(docs: DataFrame, pairs: DataFrame, classes: DataFrame, given_up: np.ndarray, percent: int) -> DataFrame:
    """The similar ones of the pairs (a, b), as a table."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    sets = stash(sets_of(docs, nodes, classes, given_up), "members")
    release(docs.sparkSession)
    rows = pairs.count()
    k = n_passes(rows, max(PASS_PAIRS, classes.count() // 4))
    links = in_turns(k, lambda i: few(linked(turn(pairs, k, i, "a", "b"), sets, percent), -(-rows // k)), "links", docs.sparkSession)
    unstash(sets)
    return links


def near_components(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of docs (doc_id, text).

    Texts without words and null texts have no shingles and link with nothing; they are components of their own. A row
    with null doc_id links with nothing and has a null component_id. Rows of one doc_id stand for one document of
    each text; component_id is then the smallest doc_id of any. An empty table gives an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    all_rows = stash(described(docs), "sets")
    rows, done = all_rows.where("part IS NULL"), [all_rows]
    # About one name for 10**10 sets.
    twice = rows.where("n > 0").select("node", "other").distinct().groupBy("node").count().where("count > 1").select("node").collect()
    given_up = np.sort(np.array([r.node for r in twice], np.int64).view(np.uint64))
    if len(given_up):

        def rename(batches):
            for batch in batches:
                node, other = (batch.column(c).to_numpy().view(np.uint64) for c in ("node", "other"))
                named = np.where(batch.column("n").to_numpy() > 0, final_names(node, other, given_up), node)
                yield batch.set_column(1, "node", pa.array(named.view(np.int64)))

        rows = stash(rows.select("doc_id", "node", "other", "n", "sketch").mapInArrow(tidy(rename), "doc_id long, node long, other long, n long, sketch binary"), "renamed")
        done.append(rows)
    counts = rarity(all_rows.where("part IS NOT NULL").select("part", "slice", "counts"))
    classes = rows.where("n > 0 AND doc_id IS NOT NULL").groupBy("node")
    most = rows.count()
    classes = stash(few(classes.agg(F.min("doc_id").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch")), most, 20_000), "classes")
    # Without sketches and counts, which are most of the table.
    rows = stash(few(rows.select("doc_id", "node", "n"), most), "rows_of_sets")
    unstash(*done)
    release(spark)
    named = docs.where("doc_id IS NOT NULL")
    groups = stash(met(shown(named, counts, given_up, percent)), "groups")
    release(spark)
    star, each = groups.where("sig IS NULL").select("a", "b"), max(PASS_ROWS, 2 * classes.count())
    k = n_passes(star.count(), each)
    pairs = in_turns(k, lambda i: near(turn(star, k, i, "a", "b").distinct(), classes, percent), "pairs", spark)
    first = stash(few(pairs.groupBy("b").agg(F.min_by("a", F.struct("far", "a")).alias("a")).select("a", "b"), pairs.count()), "nearest")
    links = verified(named, first, classes, given_up, percent)
    label = stash(few(components(links, "a", "b"), most), "labels")
    rest = [across(pairs.join(first, ["a", "b"], "left_anti").select("a", "b"), label)]
    tags, spans = spanning(groups.where("sig IS NOT NULL").select("sig", F.col("b").alias("node")), label, each)
    unstash(groups)
    done = [*tags.parts, *pairs.parts, first, spans]
    if not spans.isEmpty():
        rest.append(spanned(tags, spans, classes, percent, each))
        done += rest[1].parts
    more = stash(rest[0] if len(rest) == 1 else rest[0].union(rest[1]).distinct(), "pairs")
    unstash(*done)
    release(spark)
    if not more.isEmpty():
        links = links.union(verified(named, more, classes, given_up, percent))
    reps = classes.select("node", "rep")
    by_id = links.join(reps.select(F.col("node").alias("a"), F.col("rep").alias("u")), "a").join(reps.select(F.col("node").alias("b"), F.col("rep").alias("v")), "b")
    found = components(by_id, "u", "v")
    home = reps.join(found.withColumnRenamed("node", "u"), F.col("rep") == F.col("u"), "left").select("node", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(home, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def spanning(large: DataFrame, label: DataFrame, each: int) -> tuple[DataFrame, DataFrame]:
    """(sig, node, label, sets) of the members, and (sig, sets, least) of the groups, of groups (sig, node) that span components;
    each: rows of a pass.

    Groups of the same sets, which have the same pairs, count as one; two 64-bit hashes tell them from others."""
    spark, k = large.sparkSession, n_passes(large.count(), each)
    same = ("sets", "least", "most", "h", "i")

    def tagged(i: int) -> DataFrame:
        return turn(large, k, i, "sig").join(label, "node", "left").select("sig", "node", F.coalesce("component", "node").alias("label"))

    def spans_of(i: int) -> DataFrame:
        out = tagged(i).groupBy("sig").agg(
            F.count("*").alias("sets"), F.min("label").alias("least"), F.max("label").alias("most"), F.bit_xor(F.xxhash64("node")).alias("h"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("i")
        )
        return out.where("least <> most").groupBy(*same).agg(F.min("sig").alias("sig"))

    found = in_turns(k, spans_of, "spans", spark)
    spans = stash(found.groupBy(*same).agg(F.min("sig").alias("sig")).select("sig", "sets", "least"), "spans")
    unstash(*found.parts)
    release(spark)
    return in_turns(k, lambda i: tagged(i).join(turn(spans.select("sig", "sets"), k, i, "sig"), "sig"), "tags", spark), spans


def units(tags: DataFrame, spans: DataFrame) -> DataFrame:
    """(kind, unit, node, label, blocks): the sets that are compared with each other, and the number of their blocks.

    A group of up to BLOCK sets is a unit, whatever else its sets are in, so that units don't grow where groups overlap. Larger
    groups that overlap (share components) are compared one by one or as a whole, whichever deals out fewer sets."""
    blocks = lambda n: F.ceil(F.col(n) / BLOCK).cast("int")
    out = tags.where(F.col("sets") <= BLOCK).select(F.lit(0).alias("kind"), F.col("sig").alias("unit"), "node", "label", F.lit(1).alias("blocks"))
    many = spans.where(F.col("sets") > BLOCK)
    if many.isEmpty():
        return out
    large = tags.where(F.col("sets") > BLOCK)
    found = components(large.join(many.select("sig", "least"), "sig").select("label", "least"), "label", "least")
    by_sig = many.join(found.select(F.col("node").alias("least"), F.col("component").alias("span")), "least").select("sig", "span", "sets")
    members = large.join(by_sig.select("sig", "span"), "sig").select("span", "node", "label").distinct()
    apart = by_sig.groupBy("span").agg(F.sum(F.col("sets") * blocks("sets")).alias("apart"))
    whole = members.groupBy("span").agg(F.count("*").alias("n")).join(apart, "span").where(F.col("n") * blocks("n") <= F.col("apart")).select("span", "n")
    whole = stash(whole, "spans")
    alone = by_sig.join(whole, "span", "left_anti").select("sig")
    out = out.union(large.join(alone, "sig").select(F.lit(0), "sig", "node", "label", blocks("sets")))
    return out.union(members.join(whole, "span").select(F.lit(1), "span", "node", "label", blocks("n")))


def spanned(tags: DataFrame, spans: DataFrame, classes: DataFrame, percent: int, each: int) -> DataFrame:
    """(a, b) of sets of different components that a common group spans and whose sketches allow them to be similar, as tables;
    each: rows of a pass.

    The sets of a unit are dealt to blocks, and each pair of blocks is compared in one task, sketch by sketch; only pairs that
    may be similar leave it. A pass takes some of the pairs of blocks; sketches join the rows of its own only.
    """
    spark, member = tags.sparkSession, units(tags, spans)
    own = F.pmod(F.xxhash64("node", F.lit(3)), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.least(own, j) * F.col("blocks") + F.greatest(own, j))
    key_columns = ("kind", "unit", "pair")
    member = member.select("kind", "unit", "label", "node", own.alias("own"), "blocks", others.alias("others"))
    k = n_passes(member.agg(F.sum("blocks")).first()[0] or 0, each)
    member = member.select("kind", "unit", "label", "node", "own", F.explode("others").alias("pair"))

    def dealt_for(i: int) -> DataFrame:
        rows = turn(member, k, i, *key_columns).join(classes.select("node", "n", "sketch"), "node")
        return rows.repartition(n_shuffle(spark), *key_columns).sortWithinPartitions(*key_columns)


    def compare(rows: list[tuple]):
        """Pairs of the rows (label, node, n, sketch, own) of one pair of blocks."""
        rows.sort(key=lambda r: r[2])
        if len(rows) <= 4:
            for k, (p, u, n, x, i) in enumerate(rows):
                for q, v, m, y, j in rows[k + 1 :]:
                    if p != q and percent * m <= 100 * n and sketch_distance(x, y) * (100 + percent) <= (100 - percent) * (n + m):
                        yield u, v
            return
        label, node, n, own = (np.array([r[k] for r in rows], np.int64) for k in (0, 1, 2, 4))
        length = np.array([len(r[3]) for r in rows])
        both = own.max() != own.min()
        folded: dict[int, np.ndarray] = {}
        for size in np.unique(length).tolist():
            m = np.zeros((len(rows), size), np.uint8)
            for i in np.flatnonzero(length >= size):
                x = np.frombuffer(rows[i][3], np.uint8)
                while len(x) > size:
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                m[i] = x
            folded[size] = m
        for i in range(len(rows) - 1):
            to = int(np.searchsorted(n, 100 * n[i] // percent, "right"))
            j = np.arange(i + 1, max(i + 1, to))
            j = j[(label[j] != label[i]) & ((own[j] != own[i]) | (not both))]
            if len(j):
                m = folded[int(length[i])]
                d = np.bitwise_count(m[j] ^ m[i]).sum(1, dtype=np.int64)
                j = j[d * (100 + percent) <= (100 - percent) * (n[i] + n[j])]
                for v in node[j].tolist():
                    yield int(node[i]), v

    def run(batches):
        def groups():
            key, rows = None, []
            for batch in batches:
                for r in zip(*(batch.column(c).to_pylist() for c in (*key_columns, "label", "node", "n", "sketch", "own")), strict=True):
                    if r[:3] != key:
                        if len(rows) > 1:
                            yield rows
                        key, rows = r[:3], []
                    rows.append(r[3:])
            if len(rows) > 1:
                yield rows

        for rows in groups():
            found = list(compare(rows))
            for at in range(0, len(found), 50_000):
                part = found[at : at + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([y for _, y in part], pa.int64())], ["a", "b"])

    return in_turns(k, lambda i: dealt_for(i).mapInArrow(tidy(run), "a long, b long"), "found", spark)


def across(pairs: DataFrame, label: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose ends are in different components."""
    out = pairs.join(label.select(F.col("node").alias("a"), F.col("component").alias("p")), "a", "left")
    out = out.join(label.select(F.col("node").alias("b"), F.col("component").alias("q")), "b", "left")
    return out.where("p IS NULL OR q IS NULL OR p <> q").select("a", "b")


def op7_parity_sketch_join(spark, sf_dir: str) -> DataFrame:
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {WORDS} THEN list_transform(range(1, len(w) - {WORDS - 2}), lambda k: array_to_string(w[k:k + {WORDS - 1}], ' '))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= {PERCENT} * (x.n + y.n - i)),
e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id FROM documents LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY 1) USING (doc_id)
"""

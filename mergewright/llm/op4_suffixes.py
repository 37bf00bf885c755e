"""Removal of repeated byte strings by a hash-compared suffix sort.

Every 200-byte window is filed under its least 40-byte gram (by hash), so equal windows meet under one gram. Windows in
a row with one gram make a stretch of text; equal stretches (of one gram, length, 64-bit content hash and CRC-32, which
have nothing in common) are covered whole. Where different
stretches share a gram, their windows are suffixes to sort: bottom-up mergesort in which two suffixes are compared by
their longest common extension, found by binary search on prefix polynomial hashes; neighbours in that order that
agree over 200 bytes are checked byte by byte and covered. Only windows at the same distance from the gram can be
equal, so the sort runs within (gram, distance), all of them side by side in numpy.

A gram with very many different stretches is dealt out by distance, as sorts of their own, before its stretches meet.

Texts are named by a 64-bit hash, and a second one tells texts of one name apart: a name that two texts share is given up
for both. Of equal texts only one takes part, and all copies of at least 200 bytes are covered whole. Repeated stretches
are merged within a map task, so a passage in many documents is sent once a task.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..shipping import by_value
from .common import CHUNK_BYTES, dealt, destinations, mix, one_by_one, powers, release, small_batches, stash, text_chunks, tidy, unstash

by_value(__name__)

WINDOW, GRAM = 200, 40
#: A gram with more different stretches than COMMON is dealt out in pieces of STEP distances; of a task those count that have more than SEEN.
COMMON, SEEN, STEP = 256, 32, 10
#: Bytes of a text that are looked at together; a longer text is looked at in parts.
PART = CHUNK_BYTES
_BASE = 0xD1342543DE82EF95 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_TABLE = np.random.default_rng(977).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = 28
#: A stretch of text: its gram, its content and another hash of that, the text, the first window, the number of windows, the gram's distance from the first window, whether it is known to occur twice.
_STRETCH = np.dtype([("gram", "<u8"), ("content", "<u8"), ("crc", "<u4"), ("text", "<i8"), ("start", "<u4"), ("n", "<u2"), ("at", "<u2"), ("twice", "u1")])
_SPAN = np.dtype([("a", "<u4"), ("b", "<u4")])


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * powers(_BASE, len(data)), out=sums[1:])
    return sums


def sub_hash(sums: np.ndarray, start: np.ndarray, length) -> np.ndarray:
    """Hash of data[start : start + length], the same wherever the string stands."""
    return (sums[start + length] - sums[start]) * powers(_INVERSE, len(sums))[start]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i : i + width]) for each i, by blocks of that width."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    y = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    y[: len(x)] = x
    y = y.reshape(blocks, width)
    ahead = np.minimum.accumulate(y, 1).ravel()
    back = np.minimum.accumulate(y[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def stretches(data: np.ndarray, offsets: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The stretches of texts given end to end."""
    if len(texts) == 1 and len(data) > 2 * PART:
        parts = []
        for at in range(0, len(data) - WINDOW + 1, PART):
            own = data[at : at + PART + WINDOW - 1]
            parts.append(stretches(own, np.array([0, len(own)]), texts))
            parts[-1]["start"] += np.uint32(at)
        return np.concatenate(parts)
    if len(data) < WINDOW or int(np.diff(offsets).max()) < WINDOW:
        return np.zeros(0, _STRETCH)
    sums = prefix_hashes(data)
    grams = mix(sub_hash(sums, np.arange(len(data) - GRAM + 1), GRAM))
    keys = (grams >> np.uint64(_PLACE) << np.uint64(_PLACE)) | np.arange(len(grams), dtype=np.uint64)
    least = (sliding_min(keys, WINDOW - GRAM + 1) & np.uint64((1 << _PLACE) - 1)).astype(np.int64)
    whole = np.zeros(len(least), bool)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= WINDOW:
            whole[a : b - WINDOW + 1] = True
    starts = np.flatnonzero(whole)
    least = least[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (least[1:] != least[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(new)
    out = np.zeros(len(first), _STRETCH)
    s, p = starts[first], least[first]
    n = np.diff(np.append(first, len(starts)))
    doc = np.searchsorted(offsets, s, "right") - 1
    out["gram"], out["text"], out["start"], out["n"], out["at"] = grams[p], texts[doc], s - offsets[doc], n, p - s
    out["content"] = mix(sub_hash(sums, s, n + WINDOW - 1) + mix((n * 1024 + p - s).astype(np.uint64)))
    raw = memoryview(np.ascontiguousarray(data))
    out["crc"] = [zlib.crc32(raw[a:b]) for a, b in zip(s.tolist(), (s + n + WINDOW - 1).tolist(), strict=True)]
    return out


def same_as_before(r: np.ndarray, *fields: str) -> np.ndarray:
    """Whether each row of r has the values of the row before it."""
    out = np.zeros(len(r), bool)
    out[1:] = np.logical_and.reduce([r[f][1:] == r[f][:-1] for f in fields])
    return out


def span_rows(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """(text, spans): packed covered spans of each text, merged."""
    order = np.lexsort((a, text))
    text, a, b = text[order], a[order].astype(np.int64), b[order].astype(np.int64)
    cuts = np.flatnonzero(np.diff(text)) + 1
    names, blobs = [], []
    for x, p, q in zip(np.split(text, cuts), np.split(a, cuts), np.split(b, cuts), strict=True):
        if len(x):
            names.append(int(x[0]))
            blobs.append(merge_spans(p, q).tobytes())
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(blobs, pa.binary())], ["text", "spans"])


def merge_spans(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Spans in order of their starts, as maximal ones."""
    if not len(a):
        return np.zeros(0, _SPAN)
    reach = np.maximum.accumulate(b)
    new = np.concatenate([[True], a[1:] > reach[:-1]])
    out = np.zeros(int(new.sum()), _SPAN)
    out["a"], out["b"] = a[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(a) - 1)]
    return out


def by_destination(r: np.ndarray, dests: int) -> tuple[pa.Array, pa.Array]:
    """Destinations of the grams, and their records."""
    dest = ((r["gram"] >> np.uint64(35)) % np.uint64(dests)).astype(np.int64)
    order = np.argsort(dest, kind="stable")
    r, dest = r[order], dest[order]
    cuts = np.flatnonzero(np.diff(dest)) + 1
    return pa.array(dest[np.concatenate([[0], cuts])].astype(np.int32)), pa.array([x.tobytes() for x in np.split(r, cuts)], pa.binary())


def found_stretches(docs: DataFrame) -> DataFrame:
    """(dest, records) for the shuffle by gram, (text, spans) covered within a task, and (gram, n) of grams with many different stretches."""
    dests = destinations(docs)

    def run(batches):
        seen: set[int] = set()
        held: list[np.ndarray] = []
        size = 0

        def flush():
            r = np.concatenate(held)
            r = r[np.lexsort((r["crc"], r["content"], r["gram"]))]
            same = same_as_before(r, "gram", "content", "crc")
            twice = same.copy()
            twice[:-1] |= same[1:]
            lead = ~same
            names = ["dest", "records", "text", "spans", "gram", "n"]
            longs = pa.int64()
            if twice.any():
                t = r[twice]
                rows = span_rows(t["text"], t["start"], t["start"].astype(np.int64) + t["n"] + WINDOW - 1)
                none = pa.nulls(rows.num_rows, longs)
                yield pa.RecordBatch.from_arrays([none.cast(pa.int32()), pa.nulls(rows.num_rows, pa.binary()), *rows.columns, none, none], names)
            r["twice"] = twice
            r = r[lead]
            where, blobs = by_destination(r, dests)
            none = pa.nulls(len(where), longs)
            yield pa.RecordBatch.from_arrays([where, blobs, none, pa.nulls(len(where), pa.binary()), none, none], names)
            gram, n = np.unique(r["gram"], return_counts=True)
            gram, n = gram[n > SEEN], n[n > SEEN]
            if len(gram):
                none = pa.nulls(len(gram), longs)
                yield pa.RecordBatch.from_arrays([none.cast(pa.int32()), pa.nulls(len(gram), pa.binary()), none, pa.nulls(len(gram), pa.binary()), pa.array(gram.view(np.int64)), pa.array(n)], names)

        for batch in batches:
            names_of = batch.column("name").to_numpy()
            new = np.zeros(len(names_of), bool)
            for i, x in enumerate(names_of.tolist()):
                if x not in seen:
                    seen.add(x)
                    new[i] = True
            if len(seen) > 2_000_000:
                seen.clear()
            for part, data, offsets in text_chunks(batch.filter(pa.array(new)), "bytes"):
                s = stretches(data, offsets, part.column("name").to_numpy())
                if len(s):
                    held.append(s)
                    size += len(s)
                if size > 2_000_000:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return docs.select("name", F.col("text").cast("binary").alias("bytes")).mapInArrow(tidy(run), "dest int, records binary, text long, spans binary, gram long, n long")


def split_stretches(r: np.ndarray, step: int = STEP) -> np.ndarray:
    """The same windows in shorter stretches, each with `step` distances from the gram at most and under a gram of its own for them."""
    top, bottom = r["at"].astype(np.int64), r["at"].astype(np.int64) - r["n"] + 1
    pieces = top // step - bottom // step + 1
    owner = np.repeat(np.arange(len(r)), pieces)
    block = (top // step)[owner] - (np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    first, last = np.minimum(top[owner], block * step + step - 1), np.maximum(bottom[owner], block * step)
    out = r[owner].copy()
    out["start"] += (top[owner] - first).astype(np.uint32)
    out["n"], out["at"] = first - last + 1, first
    out["gram"] = mix(out["gram"] + block.astype(np.uint64) + np.uint64(1))
    return out


def without_common(found: DataFrame, common: int) -> DataFrame:
    """(dest, records), in which stretches under very common grams are split by distance, each piece under a gram of its own."""
    records = found.where("dest IS NOT NULL").select("dest", "records")
    hot = found.where("gram IS NOT NULL").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > common).select("gram")
    # A gram counts from SEEN stretches of a task on; their list is bounded by the records over `common`, of eight bytes each.
    hot = np.sort(np.array([r.gram for r in hot.toLocalIterator()], np.int64).view(np.uint64))
    if not len(hot):
        return records
    dests, shared = destinations(found), found.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        hot = shared.value
        for batch in batches:
            where, blobs = [], []
            for dest, raw in zip(batch.column("dest").to_pylist(), batch.column("records").to_pylist(), strict=True):
                r = np.frombuffer(raw, _STRETCH)
                some = hot[np.minimum(np.searchsorted(hot, r["gram"]), len(hot) - 1)] == r["gram"]
                if not some.any():
                    where.append(pa.array([dest], pa.int32()))
                    blobs.append(pa.array([raw], pa.binary()))
                    continue
                for part in (r[~some], split_stretches(r[some])):
                    if len(part):
                        w, x = by_destination(part, dests)
                        where.append(w)
                        blobs.append(x)
            if where:
                yield pa.RecordBatch.from_arrays([pa.concat_arrays(where), pa.concat_arrays(blobs)], ["dest", "records"])

    return records.mapInArrow(tidy(run), "dest int, records binary")


def met_stretches(records: DataFrame) -> DataFrame:
    """(text, spans) of equal stretches, and (text, records) of different stretches that share a gram."""

    def meet(blobs: list[bytes]):
        r = np.concatenate([np.frombuffer(x, _STRETCH) for x in blobs])
        r = r[np.lexsort((r["start"], r["text"], r["crc"], r["content"], r["n"], r["gram"]))]
        r = r[~same_as_before(r, "gram", "text", "start")]  # the same place, sent by several tasks
        start = ~same_as_before(r, "gram")
        sub = ~same_as_before(r, "gram", "n", "content", "crc")
        group, kind = np.cumsum(start) - 1, np.cumsum(sub) - 1
        copies = np.bincount(kind)[kind]
        twice = (copies > 1) | (np.bincount(kind, r["twice"]) > 0)[kind]
        names = ["text", "spans", "records"]
        if twice.any():
            t = r[twice]
            rows = span_rows(t["text"], t["start"], t["start"].astype(np.int64) + t["n"] + WINDOW - 1)
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.nulls(rows.num_rows, pa.binary())], names)
        # One of each content where the gram has several; a gram whose contents all occur twice has nothing left to find.
        kinds = np.bincount(group, sub)[group]
        open_ = np.bincount(group, ~twice)[group]
        ask = r[sub & (kinds > 1) & (open_ > 0)]
        if len(ask):
            ask = ask[np.argsort(ask["text"], kind="stable")]
            cuts = np.flatnonzero(np.diff(ask["text"])) + 1
            parts = np.split(ask, cuts)
            yield pa.RecordBatch.from_arrays([pa.array([int(x["text"][0]) for x in parts], pa.int64()), pa.nulls(len(parts), pa.binary()), pa.array([x.tobytes() for x in parts], pa.binary())], names)

    def run(batches):
        for _, blobs in one_by_one(batches, "records"):
            yield from meet(blobs)

    return dealt(records).mapInArrow(tidy(run), "text long, spans binary, records binary")


def read_stretches(asked: DataFrame) -> DataFrame:
    """(dest, heads, bodies): stretches with their bytes, for the sort by gram."""
    dests = destinations(asked)

    def run(batches):
        for batch in batches:
            by_dest: dict[int, tuple[list, list]] = {}
            for raw, blobs in zip(batch.column("bytes").to_pylist(), batch.column("records").to_pylist(), strict=True):
                for r in np.unique(np.concatenate([np.frombuffer(x, _STRETCH) for x in blobs])):
                    heads, bodies = by_dest.setdefault(int(r["gram"] >> np.uint64(35)) % dests, ([], []))
                    heads.append(r.tobytes())
                    bodies.append(raw[int(r["start"]) : int(r["start"]) + int(r["n"]) + WINDOW - 1])
            if by_dest:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(by_dest), pa.int32()), pa.array([b"".join(h) for h, _ in by_dest.values()], pa.binary()), pa.array([b"".join(b) for _, b in by_dest.values()], pa.binary())],
                    ["dest", "heads", "bodies"],
                )

    return asked.mapInArrow(tidy(run), "dest int, heads binary, bodies binary")


def common_extension(sums: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Length of the longest common extension of suffixes at p and q, up to WINDOW, by binary search on hashes."""
    low, high = np.zeros(len(p), np.int64), np.full(len(p), WINDOW, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) // 2
        same = sub_hash(sums, p, middle) == sub_hash(sums, q, middle)
        low = np.where(open_ & same, middle, low)
        high = np.where(open_ & ~same, middle - 1, high)


def suffix_less(data: np.ndarray, sums: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Whether the window at p comes before or with that at q."""
    e = common_extension(sums, p, q)
    tie = e >= WINDOW
    e = np.minimum(e, WINDOW - 1)
    return tie | (data[p + e] <= data[q + e])


def merge_sort(data: np.ndarray, sums: np.ndarray, place: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Order of suffixes by (group, window): bottom-up mergesort of all groups at once. group is ascending.

    In a round each run of `width` is merged with the next one of its group: a suffix's new place is its own rank plus
    its rank in the other run, by binary search with suffix comparisons.
    """
    n = len(place)
    first = np.searchsorted(group, group, "left")
    last = np.searchsorted(group, group, "right")
    order = np.arange(n)
    width = 1
    widest = int((last - first).max()) if n else 0
    while width < widest:
        slot = np.arange(n)
        run = (slot - first) // width
        mine = first + run * width
        left = run % 2 == 0
        other = np.where(left, mine + width, mine - width)
        end = np.minimum(other + width, last)
        busy = np.flatnonzero(other < last)
        low, high = other[busy].copy(), np.maximum(end[busy], other[busy])
        base = low.copy()
        own = order[busy]
        is_left = left[busy]
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            a, b = place[own[open_]], place[order[middle]]
            # A left suffix stays before equal right ones; a right one goes behind equal left ones.
            wins = np.where(is_left[open_], ~suffix_less(data, sums, a, b), suffix_less(data, sums, b, a))
            low[open_] = np.where(wins, middle + 1, low[open_])
            high[open_] = np.where(wins, high[open_], middle)
        to = slot.copy()
        to[busy] = np.where(is_left, busy, busy - width) + (low - base)
        nxt = np.empty_like(order)
        nxt[to] = order
        order = nxt
        width *= 2
    return order


def sorted_spans(read: DataFrame, budget: int = 100_000) -> DataFrame:
    """(text, spans) of windows that agree with another, from the suffix sort of each gram's stretches."""

    def solve(r: np.ndarray, bodies: np.ndarray):
        """r: stretches in order of their grams, whose bytes follow one another in bodies."""
        length = r["n"].astype(np.int64) + WINDOW - 1
        ends = np.cumsum(length)
        sums = prefix_hashes(bodies)
        n = r["n"].astype(np.int64)
        owner = np.repeat(np.arange(len(r)), n)
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        place = (ends - length)[owner] + step
        distance = r["at"].astype(np.int64)[owner] - step
        order = np.lexsort((distance, r["gram"][owner]))
        owner, step, place, distance = owner[order], step[order], place[order], distance[order]
        gram = r["gram"][owner]
        new = np.concatenate([[True], (gram[1:] != gram[:-1]) | (distance[1:] != distance[:-1])])
        group = np.cumsum(new) - 1
        ranked = merge_sort(bodies, sums, place, group)
        p = place[ranked]
        near = np.flatnonzero(group[1:] == group[:-1])
        near = near[common_extension(sums, p[near], p[near + 1]) >= WINDOW]
        # Collisions are ruled out byte by byte.
        offsets = np.arange(WINDOW)
        true = np.zeros(len(near), bool)
        for at in range(0, len(near), 20_000):
            k = near[at : at + 20_000]
            true[at : at + 20_000] = (bodies[p[k][:, None] + offsets] == bodies[p[k + 1][:, None] + offsets]).all(1)
        near = near[true]
        hit = ranked[np.union1d(near, near + 1)]
        if len(hit):
            s = r["start"].astype(np.int64)[owner[hit]] + step[hit]
            yield span_rows(r["text"][owner[hit]], s, s + WINDOW)

    def sort(heads: list[bytes], bodies: list[bytes]):
        r, data = np.concatenate([np.frombuffer(x, _STRETCH) for x in heads]), np.concatenate([np.frombuffer(x, np.uint8) for x in bodies])
        length = r["n"].astype(np.int64) + WINDOW - 1
        begin = np.cumsum(length) - length
        order = np.lexsort((r["start"], r["text"], r["gram"]))
        r, begin, length = r[order], begin[order], length[order]
        same = np.concatenate([[False], (r["gram"][1:] == r["gram"][:-1]) & (r["text"][1:] == r["text"][:-1]) & (r["start"][1:] == r["start"][:-1])])
        r, begin, length = r[~same], begin[~same], length[~same]
        cuts = np.append(np.flatnonzero(np.concatenate([[True], r["gram"][1:] != r["gram"][:-1]])), len(r))
        weight = np.concatenate([[0], np.cumsum(r["n"].astype(np.int64))])
        at = 0
        while at < len(cuts) - 1:  # whole grams, of about `budget` windows at a time
            to = max(at + 1, int(np.searchsorted(weight[cuts], weight[cuts[at]] + budget, "right")) - 1)
            a, b = cuts[at], cuts[to]
            size = length[a:b]
            index = np.repeat(begin[a:b] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
            yield from solve(r[a:b], data[index])
            at = to

    def run(batches):
        for _, heads, bodies in one_by_one(batches, "heads", "bodies"):
            yield from sort(heads, bodies)

    return dealt(read).mapInArrow(tidy(run), "text long, spans binary")


def named(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with a name for each text, and (name, copies, one) of the texts of at least 200 bytes.

    The name is a 64-bit hash. Should two texts of different other hash have one, both get names of a third hash."""
    docs = docs.withColumns({"name": name_hash("text"), "other": F.xxhash64(F.lit(1), "text")})
    table = docs.where(F.octet_length("text") >= WINDOW).groupBy("name", "other")
    copies = stash(table.agg(F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("one")), "copies")
    # About one for 10**10 texts.
    met = [r.name for r in copies.groupBy("name").count().where("count > 1").select("name").collect()]
    if met:
        again = F.when(F.col("name").isin(met), F.xxhash64(F.lit(2), "other", "name")).otherwise(F.col("name"))
        docs = docs.withColumn("name", again)
        unstash(copies)
        copies = stash(docs.where(F.octet_length("text") >= WINDOW).groupBy("name", "other").agg(F.count("*").alias("copies"), F.min(F.coalesce("doc_id", F.lit(-(2**63)))).alias("one")), "copies")
    return docs.drop("other"), copies


def name_hash(text: str):
    return F.xxhash64(text)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary, kept binary"


def covered(docs: DataFrame, common: int, texts: bool) -> DataFrame:
    """RESULT for each row of docs; spans and kept bytes only if texts are asked for."""
    spark = docs.sparkSession
    small_batches(spark)
    docs, copies = named(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")))
    first = stash(found_stretches(docs), "stretches")
    second = stash(met_stretches(without_common(first, common)), "met")
    asked = second.where("records IS NOT NULL").groupBy("text").agg(F.collect_list("records").alias("records")).withColumnRenamed("text", "name")
    asked = asked.join(copies.select("name", "one"), "name")
    rows = docs.select("name", F.coalesce("doc_id", F.lit(-(2**63))).alias("one"), F.col("text").cast("binary").alias("bytes"))
    third = stash(sorted_spans(read_stretches(rows.join(asked, ["name", "one"]).select("bytes", "records"))), "sorted")
    release(spark)
    spans = first.where("text IS NOT NULL").select("text", "spans").union(second.where("spans IS NOT NULL").select("text", "spans")).union(third)
    cover = spans.groupBy("text").agg(F.collect_list("spans").alias("spans")).withColumnRenamed("text", "name")
    several = copies.where("copies > 1").select("name", F.lit(True).alias("whole"))
    cover = stash(cover.join(several, "name", "full").select("name", F.coalesce("whole", F.lit(False)).alias("whole"), F.when(F.col("whole").isNull(), F.col("spans")).alias("spans")), "cover")
    unstash(first, second, third, copies)

    def finish(batches):
        for batch in batches:
            out = []
            for doc, raw, whole, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "bytes", "whole", "spans")), strict=True):
                s = np.array([(0, len(raw))], _SPAN) if whole else np.zeros(0, _SPAN)
                if spans:
                    s = np.concatenate([np.frombuffer(x, _SPAN) for x in spans])
                    s = s[np.argsort(s["a"], kind="stable")]
                    s = merge_spans(s["a"].astype(np.int64), s["b"].astype(np.int64))
                h, at, gone, kept = hashlib.sha256(), 0, 0, []
                for a, b in [*s.tolist(), (len(raw), len(raw))]:
                    h.update(raw[at:a])
                    if texts:
                        kept.append(raw[at:a])
                    gone, at = gone + b - a, b
                out.append((doc, len(raw), gone, len(s), h.hexdigest(), s.tobytes() if texts else None, b"".join(kept) if texts else None))
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()), pa.array(cols[5], pa.binary()), pa.array(cols[6], pa.binary())], RESULT.replace(" long", "").replace(" string", "").replace(" binary", "").split(", "))

    return docs.join(cover, "name", "left").select("doc_id", F.col("text").cast("binary").alias("bytes"), "whole", "spans").mapInArrow(tidy(finish), RESULT)


def removed_repeats(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of docs (doc_id, text).

    A null text reads as empty; texts of under 200 bytes keep everything. Rows with null or repeated doc_id are
    documents like others. An empty table gives an empty result; other columns are ignored.
    """
    return covered(docs, common, False).drop("spans", "kept")


def without_repeats(docs: DataFrame, common: int = COMMON) -> DataFrame:
    """removed_repeats() with the removed spans (an array of first byte and end) and the kept bytes, which may cut a character."""
    parts = F.expr("transform(sequence(0, n_spans - 1), k -> substring(hex(spans), cast(k * 16 + 1 as int), 16))")
    number = lambda x: F.conv(F.concat(*[F.substr(x, F.lit(2 * k + 1), F.lit(2)) for k in (3, 2, 1, 0)]), 16, 10).cast("long")
    spans = F.transform(parts, lambda x: F.struct(number(F.substr(x, F.lit(1), F.lit(8))).alias("start"), number(F.substr(x, F.lit(9), F.lit(8))).alias("end")))
    return covered(docs, common, True).withColumn("spans", F.when(F.col("n_spans") > 0, spans).otherwise(F.array().cast("array<struct<start:long,end:long>>")))


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return removed_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


#: Every window of every text as hexadecimal digits.
ORACLE = f"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
w AS (SELECT r, p, md5(substr(h, 2 * p + 1, {2 * WINDOW})) AS m FROM (SELECT r, h, unnest(range(0, greatest(len(h) // 2 - {WINDOW - 1}, 0))) AS p FROM d)),
k AS MATERIALIZED (SELECT * FROM w), g AS (SELECT m FROM k GROUP BY m HAVING count(*) > 1),
c AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM k JOIN g USING (m)),
i AS (SELECT r, p, sum(CASE WHEN p <= before + {WINDOW} THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS s FROM c),
s AS (SELECT r, s, min(p) AS a, max(p) + {WINDOW} AS b FROM i GROUP BY r, s),
l AS (SELECT r, s, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY s), 0) AS past FROM s),
t AS (SELECT r, sum(b - a) AS removed, count(*) AS spans, string_agg(substr(h, 2 * past + 1, 2 * (a - past)), '' ORDER BY s) AS kept, max(b) AS last FROM l JOIN d USING (r) GROUP BY r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
  sha256(unhex(CASE WHEN t.r IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN t USING (r)
"""

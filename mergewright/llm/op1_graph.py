"""Near-duplicate embeddings by a robust-pruned flat graph.

Vectors of a label are dealt to the shards of their nearest centres (overlapping); in each shard every vector gets a
robust-pruned list of neighbours (Subramanya et al. 2019); lists from all its shards are united. In each shard every
member then searches from the medoid and from itself, greedily with a beam, and goes on from every vector that it finds
in range until no new one is in range. Pairs found are verified in double precision.

Dense places don't rely on the graph: vertices in range of a centre are also dealt to a shard of all centres that hang
together within three ranges of each other, so two linked ones always meet, and there every pair is compared.

A pair is counted in one shard only: in the dense shard of both, else in the first that both are in. Shards return numbers
of links and a root for each member, never pairs, so rows stay in proportion to the input however large a group is.

Recall is audited by label on bounded samples against brute force. The audit only counts: nothing that it finds enters the
result. Labels under the least recall are searched again with more overlap, and at last all their pairs are compared.

Equal vectors of a label are one vertex. Large shards are cut into blocks, and each pair of blocks is a shard, so a
large group of near copies is spread over tasks.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import by_value
from .common import components, stash, tidy, unstash

by_value(__name__)

COSINE = 0.98
#: Rows wanted in a shard, and from how many on a shard is cut into blocks.
SHARD, BLOCK = 400, 4000
#: Centres in all labels (a sample of vectors): so many at most, and so many bytes of them, on the driver and every executor.
CENTRES, CENTRE_BYTES = 65_536, 64 << 20
#: Candidates and kept neighbours of a vertex, pruning factor, beam of the search.
CANDIDATES, DEGREE, ALPHA, BEAM = 48, 16, 1.2, 24
#: Queries of the audit, at most, among all vertices and among linked ones, and the recall that it must find in each label.
AUDIT, LEAST_RECALL = 256, 0.9
#: Shards of a vertex, and the overlap beyond which labels under that recall are compared whole.
OVERLAP, MOST_OVERLAP = 3, 12


def robust_lists(x: np.ndarray, candidates: int = CANDIDATES, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """(rows, degree) neighbours of each of the unit vectors x, -1 where there are fewer: the nearest candidate is kept, and
    candidates that are alpha times nearer to it than to the vertex are dropped; again until none is left."""
    n = len(x)
    out = np.full((n, degree), -1, np.int32)
    c = min(candidates, n - 1)
    if c < 1:
        return out
    for at in range(0, n, 512):
        rows = np.arange(at, min(n, at + 512))
        s = x[rows] @ x.T
        s[np.arange(len(rows)), rows] = -3
        near = np.argpartition(-s, c - 1, axis=1)[:, :c]
        own = np.take_along_axis(s, near, 1)
        order = np.argsort(-own, axis=1, kind="stable")
        near, own = np.take_along_axis(near, order, 1), 1 - np.take_along_axis(own, order, 1)
        alive = np.ones(near.shape, bool)
        for k in range(degree):
            some = alive.any(1)
            if not some.any():
                break
            first = alive.argmax(1)
            pick = near[np.arange(len(rows)), first]
            out[rows[some], k] = pick[some]
            alive[np.arange(len(rows)), first] = False
            between = 1 - np.einsum("rcd,rd->rc", x[near], x[pick])
            alive &= alpha * between > own
    return out


def neighbours(starts: np.ndarray, flat: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index into v, neighbour) for each neighbour of the vertices v; lists are flat[starts[v] : starts[v + 1]]."""
    size = starts[v + 1] - starts[v]
    owner = np.repeat(np.arange(len(v)), size)
    return owner, flat[np.repeat(starts[v] - (np.cumsum(size) - size), size) + np.arange(len(owner))]


def range_search(x: np.ndarray, starts: np.ndarray, flat: np.ndarray, medoid: int, cosine: float, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, found): for each row the rows with cosine of at least `cosine` that its search meets.

    First a greedy search with a beam; then from all met vertices in range to their neighbours, while new ones are in range.
    """
    n = len(x)
    queries, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, n, 1024):
        q = np.arange(at, min(n, at + 1024))
        m = len(q)
        seen = np.zeros((m, n), bool)
        hits = [np.arange(m) * n + q]
        seen[np.arange(m), q] = True
        ids = np.full((m, beam), -1, np.int64)
        sims = np.full((m, beam), -4.0)
        done = np.zeros((m, beam), bool)
        ids[:, 0], sims[:, 0] = q, 1.0
        fresh = ~seen[:, medoid]
        seen[:, medoid] = True
        ids[fresh, 1], sims[fresh, 1] = medoid, x[q[fresh]] @ x[medoid]
        active = np.arange(m)
        while len(active):
            open_ = np.where(done[active] | (ids[active] < 0), -4, sims[active])
            best = open_.argmax(1)
            go = open_[np.arange(len(active)), best] > -4
            active, best = active[go], best[go]
            if not len(active):
                break
            done[active, best] = True
            owner, v = neighbours(starts, flat, ids[active, best])
            r = active[owner]
            new = ~seen[r, v]
            r, v = r[new], v[new]
            seen[r, v] = True
            s = np.einsum("ij,ij->i", x[q[r]], x[v])
            near = s >= cosine
            hits.append(r[near] * n + v[near])
            # Into the beams: the new ones of a row side by side, then the best of old and new.
            rank = np.arange(len(r)) - np.searchsorted(r, r)
            rows = np.unique(r)
            if len(rows):
                at_row = np.searchsorted(rows, r)
                wide = int(rank.max()) + 1
                i2, s2 = np.full((len(rows), wide), -1, np.int64), np.full((len(rows), wide), -4.0)
                i2[at_row, rank], s2[at_row, rank] = v, s
                i3, s3 = np.concatenate([ids[rows], i2], 1), np.concatenate([sims[rows], s2], 1)
                d3 = np.concatenate([done[rows], np.zeros((len(rows), wide), bool)], 1)
                top = np.argpartition(-s3, beam - 1, axis=1)[:, :beam]
                ids[rows], sims[rows], done[rows] = (np.take_along_axis(y, top, 1) for y in (i3, s3, d3))
        front = np.unique(np.concatenate(hits))
        inside = [front]
        while len(front):
            owner, v = neighbours(starts, flat, front % n)
            r = front[owner] // n
            new = ~seen[r, v]
            key = np.unique(r[new] * n + v[new])
            r, v = key // n, key % n
            seen[r, v] = True
            front = key[np.einsum("ij,ij->i", x[q[r]], x[v]) >= cosine]
            inside.append(front)
        pairs = np.concatenate(inside)
        queries.append(q[pairs // n])
        found.append(pairs % n)
    return np.concatenate(queries), np.concatenate(found)


def unit_rows(column: pa.Array) -> np.ndarray:
    x = np.asarray(column.flatten()).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # squares of very large or small numbers leave the range of doubles
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def in_range(x: np.ndarray, y: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) of rows of x and y with a cosine of at least `cosine`; close ones are computed pair by pair."""
    s = x @ y.T
    i, j = np.nonzero(s >= cosine - 1e-9)
    s = s[i, j]
    edge = np.flatnonzero(s < cosine + 1e-9)
    s[edge] = np.einsum("ij,ij->i", x[i[edge]], y[j[edge]])
    good = s >= cosine
    return i[good], j[good]


def roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n rows the least row that the links (a, b) lead to."""
    out = np.arange(n)
    while True:
        new = out.copy()
        np.minimum.at(new, a, out[b])
        np.minimum.at(new, b, out[a])
        new = new[new]
        if (new == out).all():
            return out
        out = new


def can_link() -> Column:
    finite = F.forall("embedding", lambda c: c.isNotNull() & (F.abs(c) < float("inf")) & ~F.isnan(c))
    whole = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite & F.exists("embedding", lambda c: c != 0)
    return F.coalesce(whole, F.lit(False))


def vertices(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that can link as (vec_id, grp, k, l), and a vertex (node, grp, k, l, v, size, rep) for each group (label and
    length) and vector: k and l name its vector (128 bits), rep is the least of its `size` vec_ids."""
    good = vectors.where(can_link())
    small = isinstance(vectors.schema["label"].dataType, (T.ByteType, T.ShortType, T.IntegerType))
    grp = F.col("label").cast("long") * (1 << 24) + F.size("embedding") if small else F.xxhash64("label", F.size("embedding"))
    rows = good.select("vec_id", grp.alias("grp"), F.xxhash64("embedding").alias("k"), F.xxhash64(F.lit(29), "embedding").alias("l"), F.col("embedding").alias("v"))
    classes = rows.groupBy("grp", "k", "l").agg(F.first("v").alias("v"), F.count_distinct("vec_id").alias("size"), F.min("vec_id").alias("rep"))
    return rows.drop("v"), stash(classes.withColumn("node", F.monotonically_increasing_id()), "nodes")


def hanging_together(c: np.ndarray, cosine: float) -> np.ndarray:
    """For each of the unit vectors c the least row that a chain of cosines of at least `cosine` leads to."""
    out = np.full(len(c), -1, np.int64)
    for first in range(len(c)):
        front = np.array([first]) if out[first] < 0 else np.zeros(0, np.int64)
        out[front] = first
        while len(front):
            now, front = front[:256], front[256:]
            free = np.flatnonzero(out < 0)
            new = free[np.concatenate([(c[free[at : at + 8192]] @ c[now].T >= cosine).any(1) for at in range(0, len(free), 8192)] or [np.zeros(0, bool)])]
            out[new] = first
            front = np.concatenate([front, new])
    return out


def centres_of(nodes: DataFrame) -> dict[int, np.ndarray]:
    """Unit vectors of a sample, by group: one in SHARD vertices, but no more than CENTRES and CENTRE_BYTES allow."""
    sizes = nodes.groupBy("grp").count().where(F.col("count") > SHARD)
    total, dims = sizes.agg(F.sum("count")).first()[0] or 0, nodes.agg(F.max(F.size("v"))).first()[0] or 1
    most = min(CENTRES, max(2, CENTRE_BYTES // (8 * dims)))
    per = max(SHARD, -(-total // most))
    # The vertices with the least hashes are centres.
    ranked = nodes.select("node", "grp", F.xxhash64("node", F.lit(11)).alias("h"))
    share = ranked.join(sizes, "grp").where(F.pmod("h", F.lit(1 << 30)) < (F.lit(1 << 30) / per).cast("long"))
    got = share.orderBy("h").limit(most).select("node").join(nodes.select("node", "grp", "v"), "node").orderBy("grp", "node").toArrow()
    grp = got.column("grp").to_numpy()
    cuts = np.append(np.flatnonzero(np.diff(grp, prepend=grp[:1] - 1)), len(grp))
    return {int(grp[a]): unit_rows(got.column("v").slice(a, b - a).combine_chunks()) for a, b in zip(cuts[:-1], cuts[1:], strict=True)}


def member_type(nodes: DataFrame) -> str:
    return f"node long, grp long, v {nodes.schema['v'].dataType.simpleString()}, size long, homes array<long>, dense long, shard long"


def dealt(nodes: DataFrame, overlap: int, cosine: float) -> DataFrame:
    """(node, grp, v, size, homes, dense, shard): each vertex in the shards of its nearest centres (homes); one in range of a
    centre also in the dense shard of all centres that hang together (its shard is null). Two vertices in range of each other
    and of a centre each have centres within three ranges, so they share a dense shard."""
    spark = nodes.sparkSession
    wide = float(np.cos(min(np.pi, 3 * np.arccos(min(1.0, cosine))))) - 1e-6
    ready = spark.sparkContext.broadcast({g: (c, hanging_together(c, wide)) for g, c in centres_of(nodes).items()})

    def run(batches):
        for batch in batches:
            grp = batch.column("grp").to_numpy()
            for g in np.unique(grp).tolist():
                part = batch.take(pa.array(np.flatnonzero(grp == g)))
                c, together = ready.value.get(g, ((), ()))
                k = min(overlap, max(1, len(c)))
                if len(c) < 2:
                    top, dense = np.zeros((len(part), 1), np.int64), np.full(len(part), -1)
                else:
                    s = unit_rows(part.column("v")) @ c.T
                    top = np.sort(np.argpartition(-s, k - 1, axis=1)[:, :k].astype(np.int64), 1)
                    dense = np.where(s.max(1) >= cosine - 1e-9, together[s.argmax(1)], -1)
                both = np.flatnonzero(dense >= 0)
                rows = np.concatenate([np.repeat(np.arange(len(part)), k), both])
                homes = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * k), pa.array(top.ravel()))
                whole = pa.RecordBatch.from_arrays([*part.columns, homes, pa.array(dense, mask=dense < 0)], [*part.schema.names, "homes", "dense"])
                shard = np.concatenate([top.ravel(), np.zeros(len(both), np.int64)])
                out = whole.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(shard, mask=np.arange(len(shard)) >= k * len(part))], [*whole.schema.names, "shard"])

    return nodes.select("node", "grp", "v", "size").mapInArrow(tidy(run), member_type(nodes))


def cut(out: DataFrame) -> DataFrame:
    """Large shards cut into blocks, with a part for each pair of them; own is a vertex's block, cross tells parts of two."""
    out = out.select("*", F.when(F.col("shard").isNull(), F.col("dense")).alias("ball"))
    blocks = out.groupBy("grp", "shard", "ball").count().where(F.col("count") > BLOCK).select("grp", "shard", "ball", F.ceil(2 * F.col("count") / BLOCK).cast("int").alias("blocks"))
    # At most 2 / BLOCK of the members' rows have blocks to name.
    out = out.alias("m").join(blocks.alias("b"), (F.col("m.grp") == F.col("b.grp")) & F.col("m.shard").eqNullSafe(F.col("b.shard")) & F.col("m.ball").eqNullSafe(F.col("b.ball")), "left")
    out = out.select("m.*", F.coalesce("blocks", F.lit(1)).alias("blocks"))
    out = out.withColumn("own", F.pmod(F.xxhash64("node", F.lit(13)), F.col("blocks")).cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct((F.least("own", j).cast("long") * F.col("blocks") + F.greatest("own", j)).alias("id"), (j != F.col("own")).alias("two")))
    # The part of a block with itself has no pair of two blocks, and the others have only such pairs.
    return out.select("node", "grp", "v", "size", "homes", "dense", "shard", "ball", "own", F.explode(others).alias("pair")).select(
        "node", "grp", "v", "size", "homes", "dense", "shard", "ball", "own", F.col("pair.id").alias("part"), F.col("pair.two").alias("cross")
    )


FOUND = "node long, links long, root long"


def told(ids: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray, counted: np.ndarray) -> pa.Table:
    """(node, links, root): the vectors linked by the counted ones of the pairs (a, b), each pair once, and a root by all pairs."""
    n = len(ids)
    p, q = a[counted], b[counted]
    links = (np.bincount(p, size[q], n) + np.bincount(q, size[p], n)).astype(np.int64)
    root = roots(n, a, b)
    some = (links > 0) | (root != np.arange(n))
    return pa.table({"node": ids[some], "links": links[some], "root": ids[root[some]]})


def compared(members: DataFrame, cosine: float) -> DataFrame:
    """FOUND of all pairs within range in the parts of members; of a part of two blocks those between them."""

    def run(table: pa.Table) -> pa.Table:
        ids, own, size = (table.column(c).to_numpy() for c in ("node", "own", "size"))
        x = unit_rows(table.column("v").combine_chunks())
        cross = table.column("cross")[0].as_py()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left = np.flatnonzero(own == own.min()) if cross else np.arange(len(ids))
        right = np.flatnonzero(own != own.min()) if cross else left
        for at in range(0, len(left), 512):
            rows = left[at : at + 512]
            i, j = in_range(x[rows], x[right], cosine)
            i, j = rows[i], right[j]
            good = slice(None) if cross else i < j
            a.append(i[good])
            b.append(j[good])
        a, b = np.concatenate(a), np.concatenate(b)
        return told(ids, size, a, b, np.ones(len(a), bool))

    return members.groupBy("grp", "ball", "part").applyInArrow(run, FOUND)


def linked(nodes: DataFrame, overlap: int, cosine: float) -> DataFrame:
    """FOUND by the graph search, and of all pairs in dense shards: a row for a vertex and part."""
    first = stash(dealt(nodes, overlap, cosine), "dealt")
    everywhere = stash(cut(first), "members")
    members, dense = everywhere.where("shard IS NOT NULL"), everywhere.where("shard IS NULL")

    def build(table: pa.Table) -> pa.Table:
        ids = table.column("node").to_numpy()
        order = np.argsort(ids)
        ids = ids[order]
        lists = robust_lists(unit_rows(table.column("v").combine_chunks())[order])
        kept = [ids[row[row >= 0]] for row in lists]
        return pa.table({"node": pa.array(ids), "near": pa.array(kept, pa.list_(pa.int64()))})

    graph = members.select("node", "grp", "v", "shard", "part").groupBy("grp", "shard", "part").applyInArrow(build, "node long, near array<long>")
    graph = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))

    def search(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("node").to_numpy())
        table = table.take(pa.array(order))
        ids, own, size, ball = (table.column(c).to_numpy() for c in ("node", "own", "size", "ball_of"))
        x = unit_rows(table.column("v").combine_chunks())
        near = table.column("near").combine_chunks()
        count = np.diff(np.asarray(near.offsets))
        owner = np.repeat(np.arange(len(ids)), count)
        there = np.asarray(near.flatten())
        at = np.minimum(np.searchsorted(ids, there), len(ids) - 1)
        mine = ids[at] == there
        owner, at = owner[mine], at[mine]
        # Neighbours both ways, so that a found vertex leads back.
        u, v = np.concatenate([owner, at]), np.concatenate([at, owner])
        pairs = np.unique(u * len(ids) + v)
        u, v = pairs // len(ids), pairs % len(ids)
        starts = np.searchsorted(u, np.arange(len(ids) + 1))
        a, b = range_search(x, starts, v, int((x @ x.mean(0)).argmax()), cosine - 1e-9)
        a, b = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique((a * len(ids) + b)[a != b])
        a, b = pairs // len(ids), pairs % len(ids)
        good = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
        a, b = a[good], b[good]
        # Counted here: not in a dense shard of both, first shard of both, and this part of its blocks.
        homes = np.asarray(table.column("homes").combine_chunks().flatten()).reshape(len(ids), -1)
        both = np.where((homes[a][:, :, None] == homes[b][:, None, :]).any(2), homes[a], np.iinfo(np.int64).max).min(1)
        counted = ((ball[a] < 0) | (ball[a] != ball[b])) & (both == table.column("shard")[0].as_py())
        counted &= (own[a] != own[b]) == table.column("cross")[0].as_py()
        return told(ids, size, a, b, counted)

    placed = members.select("node", "grp", "v", "size", "homes", F.coalesce("dense", F.lit(-1)).alias("ball_of"), "shard", "own", "part", "cross")
    found = placed.join(graph, "node").groupBy("grp", "shard", "part").applyInArrow(search, FOUND)
    out = stash(found.union(compared(dense, cosine)), "found")
    unstash(first, everywhere)
    return out


@dataclass
class Audit:
    """Links of the audited vectors of a group, by brute force and as found; exact: all pairs of the group were compared afterwards."""

    grp: int
    overlap: int
    true: int
    found: int
    exact: bool = False

    @property
    def recall(self) -> float:
        return self.found / self.true if self.true else 1.0


def audit(nodes: DataFrame, found: DataFrame, overlap: int, cosine: float, queries: int | None = None) -> list[Audit]:
    """For each group asked the numbers of links of bounded samples of all vertices and of linked ones (these drawn from
    groups in turn), found and by brute force over all vertices."""
    spark, queries = nodes.sparkSession, queries or AUDIT
    sums = found.groupBy("node").agg(F.sum("links").alias("links"))
    some = nodes.withColumn("h", F.xxhash64("node", F.lit(17))).select("node", "grp", "h")
    mixed = some.orderBy("h").limit(queries).select("node")
    turns = some.join(sums.where("links > 0"), "node", "left_semi").groupBy("grp", F.pmod("h", F.lit(queries)).alias("turn")).agg(F.min_by("node", "h").alias("node"))
    turns = turns.orderBy("turn", "node").limit(queries).select("node")
    # Twice `queries` vectors at most.
    sample = mixed.union(turns).distinct().join(nodes, "node").join(sums, "node", "left").select("node", "grp", "v", F.coalesce("links", F.lit(0)).alias("links")).toArrow()
    ids, grp, links = (sample.column(c).to_numpy() for c in ("node", "grp", "links"))
    asked = {}
    for g in np.unique(grp).tolist():
        at = np.flatnonzero(grp == g)
        asked[g] = (ids[at], unit_rows(sample.column("v").take(pa.array(at)).combine_chunks()))
    shared = spark.sparkContext.broadcast(asked)

    def run(batches):
        for batch in batches:
            own, node, size = (batch.column(c).to_numpy() for c in ("grp", "node", "size"))
            for g in np.unique(own).tolist():
                q, y = shared.value.get(g, (None, None))
                if q is None:
                    continue
                at = np.flatnonzero(own == g)
                i, j = in_range(y, unit_rows(batch.column("v").take(pa.array(at))), cosine)
                other = q[i] != node[at[j]]
                true = np.bincount(i[other], size[at[j[other]]], len(q)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(true)], ["node", "true"])

    true = {r.node: r.true for r in nodes.select("node", "grp", "v", "size").mapInArrow(tidy(run), "node long, true long").groupBy("node").agg(F.sum("true").alias("true")).collect()}
    return [Audit(g, overlap, sum(true.get(i, 0) for i in q.tolist()), int(links[grp == g].sum())) for g, (q, _) in asked.items()]


def searched(vectors: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP) -> tuple[DataFrame, list[Audit]]:
    """near_vectors(), and the audits by which it was accepted."""
    kind = vectors.schema["embedding"].dataType.elementType
    wide = F.col("embedding") if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col("embedding").cast("array<double>")
    vectors = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), wide.alias("embedding"), "label")
    rows, nodes = vertices(vectors)
    rest, parts, audits = nodes, [], []
    while True:
        found = linked(rest, overlap, cosine)
        told_ = audit(rest, found, overlap, cosine)
        poor = [t.grp for t in told_ if t.recall < LEAST_RECALL]
        audits += [t for t in told_ if t.recall >= LEAST_RECALL]
        if not poor:
            parts.append(found)
            break
        bad = F.col("grp").isin(poor)
        parts.append(found.join(rest.where(~bad).select("node"), "node", "left_semi"))
        rest, overlap = rest.where(bad), 2 * overlap
        if overlap > MOST_OVERLAP:
            whole = rest.select("node", "grp", "v", "size", F.array().cast("array<long>").alias("homes"), F.lit(0).cast("long").alias("dense"), F.lit(None).cast("long").alias("shard"))
            parts.append(stash(compared(cut(whole), cosine), "found"))
            audits += [Audit(t.grp, t.overlap, t.true, t.found, True) for t in told_ if t.grp in poor]
            break
    for t in audits:
        logging.getLogger(__name__).info("group %d: recall %.3f of %d links, overlap %d%s", t.grp, t.recall, t.true, t.overlap, ", then compared whole" if t.exact else "")
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    degree = found.groupBy("node").agg(F.sum("links").alias("linked"))
    home = components(found, "node", "root")
    # The least vec_id of a component.
    placed = nodes.select("node", "rep").join(home, "node", "left").select("node", "rep", F.coalesce("component", "node").alias("home"))
    least = placed.join(placed.groupBy("home").agg(F.min("rep").alias("component_id")), "home").select("node", "component_id")
    each = nodes.select("node", "grp", "k", "l", "size").join(degree, "node", "left").join(least, "node")
    each = each.select("grp", "k", "l", (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component_id")
    mine = rows.join(each, ["grp", "k", "l"]).select("vec_id", "n_links", "component_id")
    cannot = vectors.where(~can_link()).select("vec_id", F.lit(0).alias("n_links"), F.col("vec_id").alias("component_id"))
    out = mine.union(cannot)
    return out.select("vec_id", F.col("n_links").cast("long").alias("n_links"), "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept")), audits


def near_vectors(vectors: DataFrame, cosine: float = COSINE, overlap: int = OVERLAP) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of vectors (vec_id, embedding, label).

    Vectors that are null, empty, zero or hold null or non-finite components, and rows with a null label or vec_id link
    with nothing and are their own component. Only vectors of one label and length link. A repeated row counts once as a
    vector and appears as often as in the input. Rows of one vec_id with different vectors are vectors of their own: each
    row has the links and the component of its vector. An empty table gives an empty result; other columns are ignored.
    """
    return searched(vectors, cosine, overlap)[0]


def op1_robust_graph(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM embeddings LEFT JOIN (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY 1) USING (vec_id) JOIN (SELECT a AS vec_id, min(b) AS component_id FROM r GROUP BY 1) USING (vec_id)
"""

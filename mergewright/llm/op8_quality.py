"""Quality classifier: a generalised additive model with pairwise interactions.

Shallow trees are boosted in turn, one feature after the other, on histograms; their sums are lookup tables, one for
each feature and for the strongest pairs of features. A score is a sum of table entries of the text's bins.
The model is fitted on a bounded sample of labelled rows (SAMPLE); every whole text is scored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..shipping import by_value
from .common import mix, small_batches, stash, text_chunks, tidy, unstash, word_hashes

by_value(__name__)

#: Labelled rows to fit on, at most: those whose hashed doc_id is least.
SAMPLE = 20_000
#: A score from here on predicts label 1.
THRESHOLD = 0.3
FEATURES = (
    "log_words", "word_bytes", "lower", "upper", "digit", "symbol", "bang", "pipe", "newline", "stop", "foreign", "other",
    "same_next", "same_second", "distinct_words", "distinct_triples", "word_marks",
)
_CLASS = np.full(256, 9, np.int64)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = 1, 2, 3, 8
for _c in b"#*$%&<>":
    _CLASS[_c] = 4
for _c in b" \t\x0b\x0c\r":
    _CLASS[_c] = 0
_CLASS[ord("!")], _CLASS[ord("|")], _CLASS[10], _CLASS[ord(".")], _CLASS[ord(",")] = 5, 6, 7, 10, 10


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(documents, features) of whole texts given end to end."""
    docs = len(offsets) - 1
    size = np.diff(offsets)
    owner = np.repeat(np.arange(docs), size)
    counts = np.bincount(owner * 11 + _CLASS[data], minlength=docs * 11).reshape(docs, 11).astype(np.float64)
    h, d = word_hashes(data, offsets)
    words = np.bincount(d, minlength=docs)
    per = np.maximum(words, 1)
    chars = np.maximum(size - counts[:, 0] - counts[:, 7], 1)

    def equal(step: int) -> np.ndarray:
        same = (h[step:] == h[:-step]) & (d[step:] == d[:-step])
        return np.bincount(d[step:][same], minlength=docs) / per

    def distinct(x: np.ndarray, own: np.ndarray) -> np.ndarray:
        order = np.lexsort((x, own))
        x, own = x[order], own[order]
        new = np.ones(len(x), bool)
        new[1:] = (x[1:] != x[:-1]) | (own[1:] != own[:-1])
        return np.bincount(own[new], minlength=docs) / np.maximum(np.bincount(own, minlength=docs), 1)

    if len(h) > 2:
        inside = d[2:] == d[:-2]
        triples = mix(h[:-2] + h[1:-1] * np.uint64(3) + h[2:] * np.uint64(5))[inside]
        distinct_triples = distinct(triples, d[2:][inside])
    else:
        distinct_triples = np.zeros(docs)
    share = [counts[:, k] / chars for k in (1, 2, 3, 4, 5, 6, 7, 10, 8, 9)]
    marks = (counts[:, 4] + counts[:, 5] + counts[:, 6]) / per
    return np.stack(
        [np.log1p(words), chars / per, *share, equal(1), equal(2), distinct(h, d) if len(h) else np.zeros(docs), distinct_triples, marks], axis=1
    )


@dataclass
class AdditiveModel:
    """Bin edges and lookup tables."""

    base: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> list[np.ndarray]:
        return [np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)]

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        total = np.full(len(x), self.base)
        for k, t in enumerate(self.tables):
            total += t[b[k]]
        for (i, j), g in zip(self.pairs, self.grids, strict=True):
            total += g[self.coarse[i][b[i]], self.coarse[j][b[j]]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def shallow_tree(g: np.ndarray, h: np.ndarray, splits: int = 3, ridge: float = 1.0) -> np.ndarray:
    """Leaf value of each bin of a tree of up to `splits` greedy cuts of an ordered axis."""
    cg, ch = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    gain = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + ridge)
    leaves = [(0, len(g))]
    for _ in range(splits):
        best = (1e-9, None, None)
        for a, b in leaves:
            if b - a > 1:
                c = np.arange(a + 1, b)
                won = gain(a, c) + gain(c, b) - gain(a, b)
                k = int(won.argmax())
                if won[k] > best[0]:
                    best = (won[k], (a, b), int(c[k]))
        if best[1] is None:
            break
        leaves.remove(best[1])
        leaves += [(best[1][0], best[2]), (best[2], best[1][1])]
    out = np.zeros(len(g))
    for a, b in leaves:
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + ridge)
    return out


def corner_tree(g: np.ndarray, h: np.ndarray, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """Gain and values of the best cut of a grid into four corners."""
    cg, ch = (np.pad(m, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for m in (g, h))
    n, m = g.shape
    i, j = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")

    def corners(c: np.ndarray) -> list[np.ndarray]:
        a = c[i, j]
        return [a, c[i, m] - a, c[n, j] - a, c[n, m] - c[i, m] - c[n, j] + a]

    gs, hs = corners(cg), corners(ch)
    won = sum(x**2 / (y + ridge) for x, y in zip(gs, hs, strict=True)) - cg[n, m] ** 2 / (ch[n, m] + ridge)
    if not won.size:
        return 0.0, np.zeros_like(g)
    k = np.unravel_index(int(won.argmax()), won.shape)
    p, q = int(i[k]), int(j[k])
    out = np.zeros_like(g)
    v = [float(x[k] / (y[k] + ridge)) for x, y in zip(gs, hs, strict=True)]
    out[:p, :q], out[:p, q:], out[p:, :q], out[p:, q:] = v
    return float(won[k]), out


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 60, rate: float = 0.1, bins: int = 32, cells: int = 8, n_pairs: int = 6) -> AdditiveModel:
    """Cyclic boosting on the log loss, of single features first, then of the pairs with the largest gain on what is left.

    Without rows of both labels the model is constant: the share of label 1 with one row of each added."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(base=float(np.log(share / (1 - share))))
    for k in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, k], np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0))
        n = len(model.edges[-1]) + 1
        model.tables.append(np.zeros(n))
        model.coarse.append(np.arange(n) * cells // max(n, cells) if n > cells else np.arange(n))
    if len(np.unique(y)) < 2:
        return model
    b = model.bins(x)
    total = np.full(len(y), model.base)

    def slope() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for k, t in enumerate(model.tables):
            g, h = slope()
            step = rate * shallow_tree(np.bincount(b[k], g, len(t)), np.bincount(b[k], h, len(t)))
            t += step
            total += step[b[k]]
    c = [m[i] for m, i in zip(model.coarse, b, strict=True)]
    width = [int(m.max()) + 1 for m in model.coarse]

    def grid(i: int, j: int, v: np.ndarray) -> np.ndarray:
        return np.bincount(c[i] * width[j] + c[j], v, width[i] * width[j]).reshape(width[i], width[j])

    g, h = slope()
    gains = [(corner_tree(grid(i, j, g), grid(i, j, h))[0], i, j) for i in range(x.shape[1]) for j in range(i)]
    for _, i, j in sorted(gains, reverse=True)[:n_pairs]:
        model.pairs.append((i, j))
        model.grids.append(np.zeros((width[i], width[j])))
    for _ in range(pair_rounds):
        for (i, j), t in zip(model.pairs, model.grids, strict=True):
            g, h = slope()
            step = rate * corner_tree(grid(i, j, g), grid(i, j, h))[1]
            t += step
            total += step[c[i], c[j]]
    return model


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5; of a null one 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5, F.lit(0))


def featured(docs: DataFrame) -> DataFrame:
    """doc_id, y and features (array) of each whole text of docs (doc_id, y, text)."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                x = features(data, offsets)
                rows = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("y"), rows], ["doc_id", "y", "x"])

    return docs.select("doc_id", "y", "text").mapInArrow(tidy(run), "doc_id long, y int, x array<double>")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> AdditiveModel:
    """The model of a bounded sample of docs with labels (doc_id, quality) that are not held out: of those rows the `sample`
    whose hashed doc_id is least. Only their texts are looked at."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y")).where("y IN (0, 1)").where(remainder(F.col("doc_id")) != 0)
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    labelled = stash(ids.join(known, "doc_id"), "labelled")
    # Of many rows, those whose hashes can't be among the least don't leave their tasks; about 2 * sample rows do.
    least = min(2**63 - 1, -(2**63) + 2 * sample * 2**64 // max(1, labelled.count()))
    near = stash(labelled.where(F.xxhash64("doc_id") <= F.lit(least)).distinct(), "near")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(near), "doc_id")
    got = featured(texts).orderBy(F.xxhash64("doc_id"), "doc_id", "y", "x").limit(sample).select("x", "y").toPandas()
    unstash(labelled, near)
    x = np.array(got["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    return fit(x, got["y"].to_numpy(np.float64))


def scores_of(batch: pa.RecordBatch, model: AdditiveModel) -> np.ndarray:
    """The score of each text of a batch."""
    return np.concatenate([model.score(features(data, offsets)) for _, data, offsets in text_chunks(batch, "text")] or [np.zeros(0)])


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs (doc_id, text).

    A null text reads as empty and is scored like other texts. Rows with null doc_id have no label and count as held
    out; a repeated doc_id gives a row for each. Without labels every score is 0.5. An empty table gives an empty
    result; other columns are ignored.
    """
    small_batches(docs.sparkSession)
    model = train(docs, labels, sample)

    def run(batches):
        for batch in batches:
            s = scores_of(batch, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s), pa.array((s >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), "doc_id long, score double, predicted int")
    return out.select("doc_id", (remainder(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")


def good_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that are predicted to be good, with all their columns; each is judged by its own text."""
    small_batches(docs.sparkSession)
    model = train(docs, labels, sample)

    def run(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores_of(batch, model) >= threshold))

    return docs.mapInArrow(tidy(run), docs.schema)


def op8_additive_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))

"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed in cells of source, language and topic over all documents. A cell's probability is the product of a
factor of its source, its language and its topic, but at most 1; the factors are raked in turn, each to the goals of its
marginal under that bound, until all marginals hold. Documents are then kept with their cell's probability, by a hash of
doc_id, so that the kept tokens have the goals of all three marginals in expectation. Where the goals can't hold at the
share of tokens asked for, a lower share is taken and reported.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shipping import by_value
from .common import small_batches, stash, text_chunks, tidy

by_value(__name__)

#: Targets of a marginal without weights of its own: its shares to this power, scaled to one.
POWER = 0.7
#: Share of the tokens to keep, and most that is kept of a value of a marginal.
SHARE, FULL = 0.8, 0.98
#: Rounds of raking, and how far the kept tokens of a value may be from its goal, as a share of all kept ones.
RAKING_ROUNDS, TOLERANCE = 1000, 1e-7
#: Cells whose table may go to the driver; beyond, sources are raked by the executors.
CELLS = 200_000
MARGINS = ("source", "lang", "topic")
CHANCES = "m_source string, m_lang string, m_topic string, m_probability double"


TOPICS = np.array(["table", "markup", "shouted", "long prose", "prose"])
#: Classes of bytes: white space, pipe, markup, exclamation, others.
_CLASS = np.full(256, 4, np.int64)
_CLASS[list(b" \t\n\x0b\x0c\r")], _CLASS[ord("|")], _CLASS[list(b"#*$%&<>")], _CLASS[ord("!")] = 0, 1, 2, 3


def forms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens (words, at least 1) and topic by form of texts given end to end: table (2 % pipes), markup (5 % signs),
    shouted (5 % exclamation marks), long prose (over 4,000 bytes) or prose."""
    docs, size = len(offsets) - 1, np.diff(offsets)
    kind = _CLASS[data]
    owner = np.repeat(np.arange(docs), size)
    counts = np.bincount(owner * 5 + kind, minlength=docs * 5).reshape(docs, 5)
    start = kind != 0
    start[1:] &= (kind[:-1] == 0) | (owner[1:] != owner[:-1])
    tokens = np.maximum(np.bincount(owner[start], minlength=docs), 1)
    n = np.maximum(size, 1)
    topic = np.select([counts[:, 1] * 100 >= 2 * n, counts[:, 2] * 100 >= 5 * n, counts[:, 3] * 100 >= 5 * n, size > 4000], [0, 1, 2, 3], 4)
    return tokens, TOPICS[np.where(size > 0, topic, 4)]


def measured(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """docs with mix_tokens, mix_topic and, if they have doc_id, mix_key (what a row is drawn by) of each whole text, with or without the text."""
    small_batches(docs.sparkSession)
    if "doc_id" in docs.columns:
        docs = docs.withColumn("mix_key", F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")))))
    names = [c for c in docs.columns if keep_text or c != "text"]

    def run(batches):
        for batch in batches:
            for part, data, offsets in text_chunks(batch, "text"):
                tokens, topic = forms(data, offsets)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(tokens, pa.int64()), pa.array(topic)], [*names, "mix_tokens", "mix_topic"])

    schema = T.StructType([f for f in docs.schema if f.name in names] + [T.StructField("mix_tokens", T.LongType()), T.StructField("mix_topic", T.StringType())])
    return docs.mapInArrow(tidy(run), schema)


@dataclass
class Plan:
    """The share of tokens kept, the rounds of raking, the largest distance of a value's kept tokens from its goal (as a share
    of all kept ones), and whether it is in bounds."""

    share: float
    rounds: int
    worst: float

    @property
    def met(self) -> bool:
        return self.worst <= TOLERANCE


def bounded(tokens: np.ndarray, q: np.ndarray, code: np.ndarray, goals: np.ndarray) -> np.ndarray:
    """For each value the factor f with which its cells' tokens * min(1, f * q) sum up to its goal; goals are below the sums of tokens."""
    f = np.ones(len(goals))
    full = np.zeros(len(q), bool)
    while True:
        rest = goals - np.bincount(code, tokens * full, len(goals))
        open_ = np.bincount(code, tokens * q * ~full, len(goals))
        f = np.where(open_ > 0, np.maximum(rest, 0) / np.where(open_ > 0, open_, 1), f)
        now = full | (f[code] * q >= 1)
        if (now == full).all():
            return f
        full = now


def rake(tokens: np.ndarray, codes: list[np.ndarray], goals: list[np.ndarray], rounds: int = RAKING_ROUNDS, tolerance: float = TOLERANCE / 10) -> tuple[np.ndarray, int, float]:
    """Probabilities of cells such that their tokens' sums by each code are the goals; the rounds taken, and the worst distance."""
    kept = max(float(goals[0].sum()), 1e-300)
    q = np.full(len(tokens), min(1.0, kept / max(float(tokens.sum()), 1.0)))
    worst = 0.0
    for k in range(1, rounds + 1):
        for code, goal in zip(codes, goals, strict=True):
            q = q * bounded(tokens, q, code, goal)[code]
        p = np.minimum(1, q)
        worst = max(float(np.abs(np.bincount(code, tokens * p, len(goal)) - goal).max(initial=0)) for code, goal in zip(codes, goals, strict=True)) / kept
        if worst <= tolerance:
            break
    return np.minimum(1, q), k, worst


def tempered(tokens: np.ndarray, power: float, share: float) -> np.ndarray:
    """Goals of a marginal without weights: tokens to `power`, at most FULL of them, scaled so that they are `share` of all."""
    t = tokens.astype(np.float64)
    if share >= FULL:
        return share * t
    r, full = t**power, np.zeros(len(t), bool)
    while True:
        c = (share * t.sum() - FULL * t[full].sum()) / max(r[~full].sum(), 1e-300)
        now = full | (c * r >= FULL * t)
        if (now == full).all():
            return np.where(full, FULL * t, c * r)
        full = now


def weighed(names: list, weights: dict) -> np.ndarray:
    """Given weights, scaled to one; 0 for a name without one."""
    w = np.array([weights.get(n, 0.0) for n in names], np.float64)
    return w / max(w.sum(), 1e-300)


def margins(topic: str) -> dict:
    value = lambda c: F.coalesce(F.col(f"d.`{c}`").cast("string"), F.lit("\x00null"))
    return {"source": value("source"), "lang": value("lang"), "topic": value(topic)}


def chances(docs: DataFrame, weights: dict[str, dict] | None = None, power: float = POWER, share: float = SHARE, topic: str = "mix_topic") -> tuple[DataFrame, Plan]:
    """m_source, m_lang, m_topic, m_probability of each cell of measured docs; and the plan."""
    weights = weights or {}
    cells = docs.alias("d").groupBy(*[c.alias(k) for k, c in margins(topic).items()]).agg(F.sum("d.mix_tokens").alias("tokens"))
    table = cells.limit(CELLS + 1).collect()
    if len(table) > CELLS:
        return wide_chances(stash(cells, "cells"), weights, power, share)
    table = sorted(((r.source, r.lang, r.topic, r.tokens) for r in table), key=lambda t: (-t[3], *t[:3]))
    if not table:
        return docs.sparkSession.createDataFrame([], CHANCES), Plan(share, 0, 0.0)
    tokens = np.array([t[3] for t in table], np.float64)
    codes, sums, given = [], [], []
    for k, margin in enumerate(MARGINS):
        found, code = np.unique([t[k] for t in table], return_inverse=True)
        codes.append(code)
        sums.append(np.bincount(code, tokens))
        given.append(weighed(found.tolist(), weights[margin]) if weights.get(margin) else None)
    share = feasible(share, [(g, s) for g, s in zip(given, sums, strict=True) if g is not None])
    while True:
        goals = [share * tokens.sum() * g if g is not None else tempered(s, power, share) for g, s in zip(given, sums, strict=True)]
        p, rounds, worst = rake(tokens, codes, goals)
        plan = Plan(share, rounds, worst)
        if plan.met or share < 1e-3:
            break
        share *= 0.9  # the marginals exclude each other under the bound
    # At most CELLS rows.
    return F.broadcast(docs.sparkSession.createDataFrame([(s, g, k, float(x)) for (s, g, k, _), x in zip(table, p, strict=True)], CHANCES)), plan


def feasible(share: float, given: list[tuple[np.ndarray, np.ndarray]]) -> float:
    """The highest share up to `share` at which no weighed value needs more than FULL of its tokens."""
    for weight, tokens in given:
        some = weight > 0
        if some.any():
            share = min(share, float((FULL * tokens[some] / weight[some]).min() / tokens.sum()))
    return share


def wide_chances(cells: DataFrame, weights: dict[str, dict], power: float, share: float, rounds: int = RAKING_ROUNDS, tolerance: float = TOLERANCE) -> tuple[DataFrame, Plan]:
    """chances() for any number of sources. The driver holds the factors of languages and topics; in each round executors find
    those of the sources, which follow from them, and return sums by language and topic."""
    spark = cells.sparkSession
    sums = [sorted((r[0], r.n) for r in cells.groupBy(m).agg(F.sum("tokens").alias("n")).collect()) for m in ("lang", "topic")]
    names = [[k for k, _ in one] for one in sums]
    counts = [np.array([n for _, n in one], np.float64) for one in sums]
    given = [weighed(names[i], weights[m]) if weights.get(m) else None for i, m in enumerate(("lang", "topic"))]
    total, n_lang, n_topic = float(counts[0].sum()), len(names[0]), len(names[1])
    code = [{k: i for i, k in enumerate(one)} for one in names]
    shared = spark.sparkContext.broadcast((code, weights.get("source")))

    def coded(batches):
        code, weights = shared.value
        for batch in batches:
            found = batch.column("cells").to_pylist()
            tokens = [[float(c["tokens"]) for c in x] for x in found]
            own = [sum(t) for t in tokens]
            want = [float(weights.get(k, 0.0)) if weights else t**power for k, t in zip(batch.column("source").to_pylist(), own, strict=True)]
            at = [[code[0][c["lang"]] * n_topic + code[1][c["topic"]] for c in x] for x in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source"), pa.array(at, pa.list_(pa.int64())), pa.array(tokens, pa.list_(pa.float64())), pa.array(want, pa.float64()), pa.array(own, pa.float64())], ["source", "at", "tokens", "want", "own"]
            )

    # A source has as many cells as languages and topics, at most.
    grouped = cells.groupBy("source").agg(F.collect_list(F.struct("lang", "topic", "tokens")).alias("cells"))
    table = stash(grouped.mapInArrow(tidy(coded), "source string, at array<long>, tokens array<double>, want double, own double"), "sources")
    share = feasible(share, [(g, c) for g, c in zip(given, counts, strict=True) if g is not None])
    if weights.get("source"):
        all_ = table.agg(F.sum("want")).first()[0]
        least = table.where("want > 0").agg(F.min(F.col("own") / F.col("want"))).first()[0]
        share = min(share, FULL * least * all_ / total) if least is not None else share

    def scale(share: float) -> float:
        """c such that min(c * want, FULL * own) is `share` of all."""
        c, full = 0.0, -1
        while True:
            sure = F.lit(c) * F.col("want") >= FULL * F.col("own")
            r = table.agg(F.count_if(sure).alias("n"), F.coalesce(F.sum(F.when(sure, F.col("own"))), F.lit(0.0)).alias("t"), F.coalesce(F.sum(F.when(~sure, F.col("want"))), F.lit(0.0)).alias("rest")).first()
            if r.n <= full or r.rest <= 0:
                return c
            full, c = r.n, (share * total - FULL * r.t) / r.rest

    def raked(batch, factor, c, share):
        """Place in the grid, tokens and factor of the cells of a batch."""
        at, t = batch.column("at").flatten().to_numpy(), batch.column("tokens").flatten().to_numpy()
        owner = np.repeat(np.arange(len(batch)), np.diff(np.asarray(batch.column("at").offsets)))
        want, own = batch.column("want").to_numpy(), batch.column("own").to_numpy()
        goal = c * want if weighted else share * own if share >= FULL else np.minimum(c * want, FULL * own)
        q = factor[at]
        return at, t, q * bounded(t, q, owner, goal)[owner]

    weighted = bool(weights.get("source"))

    def fitted(share: float) -> tuple[np.ndarray, float, Plan]:
        c = share * total / max(table.agg(F.sum("want")).first()[0] or 0, 1e-300) if weighted else scale(share) if share < FULL else 0.0
        goals = [share * total * g if g is not None else tempered(n, power, share) for g, n in zip(given, counts, strict=True)]
        lang, topic = np.full(n_lang, share), np.ones(n_topic)
        for k in range(1, rounds + 1):
            factor = np.outer(lang, topic).ravel()

            def add(batches, factor=factor):
                grids = np.zeros((2, n_lang * n_topic))
                for batch in batches:
                    at, t, q = raked(batch, factor, c, share)
                    full = q >= 1
                    grids[0] += np.bincount(at, t * full, n_lang * n_topic)
                    grids[1] += np.bincount(at, t * q * ~full, n_lang * n_topic)
                some = np.flatnonzero(grids.any(0))
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(grids[0][some]), pa.array(grids[1][some])], ["at", "full", "open"])

            # A row for each language and topic.
            full, open_ = np.zeros((n_lang, n_topic)), np.zeros((n_lang, n_topic))
            for r in table.mapInArrow(tidy(add), "at long, full double, open double").groupBy("at").agg(F.sum("full").alias("full"), F.sum("open").alias("open")).collect():
                full.ravel()[r["at"]], open_.ravel()[r["at"]] = r.full, r.open
            worst = max(float(np.abs((full + open_).sum(axis) - goals[1 - axis]).max(initial=0)) for axis in (1, 0)) / max(share * total, 1e-300)
            if worst <= tolerance:
                break
            for axis, own in ((1, lang), (0, topic)):
                rest, now = goals[1 - axis] - full.sum(axis), open_.sum(axis)
                step = np.where((now > 0) & (rest > 0), rest / np.where(now > 0, now, 1), np.where(goals[1 - axis] > 0, 0.5, 0.0))
                own *= step
                open_ *= step[:, None] if axis else step[None, :]
        return np.outer(lang, topic).ravel(), c, Plan(share, k, worst)

    while True:
        factor, c, plan = fitted(share)
        if plan.met or share < 1e-3:
            break
        share *= 0.9

    def probabilities(batches):
        for batch in batches:
            at, _, q = raked(batch, factor, c, share)
            size = np.diff(np.asarray(batch.column("at").offsets))
            source = batch.column("source").take(pa.array(np.repeat(np.arange(len(batch)), size)))
            named = [pa.array(names[0], pa.string()).take(pa.array(at // n_topic)), pa.array(names[1], pa.string()).take(pa.array(at % n_topic))]
            yield pa.RecordBatch.from_arrays([source, *named, pa.array(np.minimum(1, q))], ["m_source", "m_lang", "m_topic", "m_probability"])

    return table.mapInArrow(tidy(probabilities), CHANCES), plan


def sampled(docs: DataFrame, cells: DataFrame, topic: str = "mix_topic") -> DataFrame:
    """Measured docs with mix_probability and mix_kept."""
    names = margins(topic)
    joined = docs.alias("d").join(cells.alias("c"), (names["source"] == F.col("c.m_source")) & (names["lang"] == F.col("c.m_lang")) & (names["topic"] == F.col("c.m_topic")), "left")
    chance = F.col("c.m_probability")
    draw = F.conv(F.substr(F.md5(F.concat(F.lit("mix:"), F.col("d.mix_key"))), F.lit(1), F.lit(12)), 16, 10).cast("double") / float(2**48)
    return joined.select("d.*", chance.alias("mix_probability"), (draw < chance).alias("mix_kept")).drop("mix_key")


def mixture(docs: DataFrame, weights: dict[str, dict] | None = None, power: float = POWER, share: float = SHARE, topic: str | None = None) -> tuple[DataFrame, Plan]:
    """mixed(), and the plan: the share of tokens that is kept and whether the marginals hold."""
    docs = docs.drop("mix_tokens", "mix_topic", "mix_key", "mix_probability", "mix_kept")
    by = topic or "mix_topic"
    cells, plan = chances(measured(docs.select("source", "lang", "text", *([topic] if topic else [])), False), weights, power, share, by)
    logging.getLogger(__name__).info("mixture: %s", plan)
    return sampled(measured(docs), cells, by), plan


def mixed(docs: DataFrame, weights: dict[str, dict] | None = None, power: float = POWER, share: float = SHARE, topic: str | None = None) -> DataFrame:
    """docs with mix_tokens, mix_topic, mix_probability and mix_kept appended.

    weights: targets by marginal (source, lang, topic) and value, a value without one gets none; a marginal without them gets
    its tokens to `power`, but at most FULL of a value's tokens. topic: the column that is the third marginal, else the form
    of the text. A null source, language or topic is a value of its own. A null or empty text has one token and is prose.
    Equal doc_ids are kept or dropped together within a cell, as are equal texts without one. An empty table gives an empty
    result. Other columns pass through, whatever their names; earlier columns of the four names and mix_key are dropped.
    """
    return mixture(docs, weights, power, share, topic)[0]


def op6_raked_mixture(spark, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, topic, tokens, probability, kept of all documents, and the plan's share and whether it holds the marginals."""
    docs = stash(measured(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "lang", "text"), False), "forms")
    cells, plan = chances(docs)
    out = sampled(docs, cells)
    return out.select(
        "doc_id", "source", "lang", F.col("mix_topic").alias("topic"), F.col("mix_tokens").alias("tokens"), F.col("mix_probability").alias("probability"), F.col("mix_kept").alias("kept"),
        F.lit(plan.share).alias("plan_share"), F.lit(plan.met).alias("plan_met"),
    )

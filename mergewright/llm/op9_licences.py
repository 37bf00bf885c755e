"""Licence scan, in DataFrame functions only.

A text is normalised (lower case, runs of letters and digits as words, so line breaks and comment signs don't matter) and
compared with licence templates by the Dice coefficient over word bigrams (as sets): a template is held against windows
of as many words as it has, wherever a window starts with one of its bigrams, in lines, prose or wrapped paragraphs.

Dice t of m and n bigrams needs c >= t * m / (2 - t) common ones. So a template is a candidate only if the text has that
many bigrams and one of the template's m - c + 1 longest (probes); texts without a word of a probe aren't looked at
further. Both bounds lose nothing. Windows outside the sizes m * t / (2 - t) to m * (2 - t) / t are pruned.

Of windows that overlap, the one with more common bigrams counts, then the higher coefficient, then the earlier template.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let
from .licence_texts import PERMISSIVE, TEMPLATES

#: A window and a template match from this Dice coefficient on, in percent.
THRESHOLD_PERCENT = 80
#: A notice that other licences often come with; it counts where it stands alone.
RESERVED = "proprietary"


def words_of(text: str) -> list[str]:
    return re.findall("[a-z0-9]+", text.lower())


def bigrams_of(text: str) -> list[str]:
    words = words_of(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def prepared(templates, percent: int) -> list[dict]:
    """What a scan needs of each template: id, rank, size in words, its bigrams, the least number of common ones, the probes."""
    out = []
    for rank, (name, text) in enumerate(templates):
        grams = bigrams_of(text)
        if not grams:
            raise ValueError("a template needs two words")
        least = -(-percent * len(grams) // (200 - percent))
        probes = sorted(grams, key=lambda g: (-len(g), g))[: len(grams) - least + 1]
        out.append({"id": name, "rank": rank, "words": len(words_of(text)), "m": len(grams), "least": least, "probes": probes, "grams": grams})
    return out


def strings(values) -> Column:
    return F.array(*map(F.lit, values))


def better(a: Column, b: Column, last: str) -> Column:
    order = lambda x: F.struct(x["common"], x["percent"], -x[last])
    return order(a) > order(b)


def found_in(text: Column, templates, percent: int) -> tuple[Column, Column, Column]:
    """Columns for three projections: words of the text; their bigrams if the words have one of a probe; matches in these (`grams`, `distinct`)."""
    ready = prepared(templates, percent)
    table = F.array(*[
        F.struct(*[F.lit(t[k]).alias(k) for k in ("id", "rank", "words", "m", "least")], strings(t["probes"]).alias("probes"), strings(t["grams"]).alias("grams")) for t in ready
    ])
    anchors = sorted({max(p.split(), key=lambda w: (len(w), w)) for t in ready for p in t["probes"]})
    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("[a-z0-9]+"), F.lit(0))
    w = F.col("words")
    grams = F.when(
        F.arrays_overlap(w, strings(anchors)) & (F.size(w) > 1),
        F.transform(F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda x, i: F.concat_ws(" ", F.get(w, i), x)),
    ).otherwise(F.array().cast("array<string>"))
    b = F.col("grams")

    def windows(t: Column) -> Column:
        starts = let(F.array_intersect(F.col("distinct"), t["grams"]), lambda common: F.filter(F.transform(b, lambda x, i: F.when(F.array_contains(common, x), i)), lambda i: i.isNotNull()))
        sized = F.transform(starts, lambda i: F.struct(i.alias("start"), F.slice(b, i + 1, t["words"] - 1).alias("grams")))
        sized = F.transform(sized, lambda x: F.struct(x["start"], F.size(F.array_distinct(x["grams"])).alias("n"), F.size(F.array_intersect(x["grams"], t["grams"])).alias("common")))
        sized = F.filter(sized, lambda x: (x["n"] * (200 - percent) >= t["m"] * percent) & (x["n"] * percent <= t["m"] * (200 - percent)))
        told = F.transform(sized, lambda x: F.struct(
            x["start"], t["words"].alias("words"), x["common"], F.floor(200 * x["common"] / (t["m"] + x["n"])).cast("int").alias("percent"), t["rank"].alias("rank"), t["id"].alias("id")
        ))
        told = F.filter(told, lambda x: x["percent"] >= percent)
        # The best of a template's windows that overlap; they stand in order of their starts.
        return let(
            told,
            lambda all_: F.filter(all_, lambda x, j: ~F.exists(F.slice(all_, F.greatest(j + 1 - x["words"], F.lit(1)), 2 * x["words"]), lambda o: (F.abs(o["start"] - x["start"]) < x["words"]) & better(o, x, "start"))),
        )

    able = F.filter(table, lambda t: (F.size("distinct") >= t["least"]) & F.arrays_overlap(F.col("distinct"), t["probes"]))
    every = F.array_sort(F.flatten(F.transform(able, windows)))
    # So many windows can start within the longest template's length: those of one template don't overlap any more.
    longest = max(t["words"] for t in ready)
    near = sum(-(-longest // t["words"]) + 1 for t in ready)
    matches = let(
        every,
        lambda all_: F.filter(
            all_,
            lambda x, j: ~F.exists(
                F.slice(all_, F.greatest(j + 1 - near, F.lit(1)), F.lit(2 * near + 1)), lambda o: (o["start"] < x["start"] + x["words"]) & (x["start"] < o["start"] + o["words"]) & better(o, x, "rank")
            ),
        ),
    )
    probes = sorted({p for t in ready for p in t["probes"]})
    return words, grams, F.when(F.arrays_overlap(F.col("distinct"), strings(probes)), matches)


def matched(docs: DataFrame, templates=TEMPLATES, percent: int = THRESHOLD_PERCENT) -> DataFrame:
    """doc_id and matches (start and words: the window in words of the text; common, percent, rank, id) for each row of docs."""
    words, grams, matches = found_in(F.col("text"), templates, percent)
    out = docs.select("doc_id", words.alias("words")).select("doc_id", grams.alias("grams"))
    return out.select("doc_id", "grams", F.array_distinct("grams").alias("distinct")).select("doc_id", matches.alias("matches"))


def scan(docs: DataFrame, templates=TEMPLATES, percent: int = THRESHOLD_PERCENT, permissive=PERMISSIVE) -> DataFrame:
    """doc_id, n_matches, licences (sorted, joined by commas), best_licence, best_percent (Dice coefficient of the match with
    most common bigrams, in whole percent, rounded down), allowed for each row of docs (doc_id, text).

    Of equal matches the earlier template counts as best. A document without a match has no best licence (null), 0 percent
    and is allowed; one is not allowed if it has a licence outside `permissive`, where "all rights reserved" counts only
    alone. A null text reads as empty. Rows with null or repeated doc_id are documents like others; other columns are ignored.
    """
    empty = F.array().cast("array<struct<start:int,words:int,common:int,percent:int,rank:int,id:string>>")
    out = matched(docs, templates, percent).select("doc_id", F.coalesce("matches", empty).alias("m"))
    order = lambda x: F.struct(x["common"], x["percent"], (-x["rank"]).alias("rank"), x["id"])
    out = out.select("doc_id", "m", F.array_sort(F.array_distinct(F.transform("m", lambda x: x["id"]))).alias("ids"), F.array_max(F.transform("m", order)).alias("top"))
    return out.select(
        "doc_id",
        F.size("m").cast("long").alias("n_matches"),
        F.array_join("ids", ",").alias("licences"),
        F.col("top.id").alias("best_licence"),
        F.coalesce("top.percent", F.lit(0)).cast("long").alias("best_percent"),
        F.forall(F.when(F.size("ids") > 1, F.array_remove("ids", RESERVED)).otherwise(F.col("ids")), lambda x: x.isin(*permissive)).alias("allowed"),
    )


def op9_licence_dice(spark, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


_OVERLAP = "o.start < x.start + x.words AND x.start < o.start + o.words"
#: Every window that starts with a bigram of a template, without the bounds.
ORACLE = f"""
WITH t(id, rank, words, g) AS (VALUES {", ".join(f"('{name}', {rank}, {len(words_of(text))}, {_sql_list(bigrams_of(text))})" for rank, (name, text) in enumerate(TEMPLATES))}),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM d),
b AS MATERIALIZED (SELECT r, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1]) AS b FROM w),
p AS (SELECT r, unnest(b) AS gram, unnest(range(len(b))) AS start FROM b),
u AS (SELECT rank, unnest(g) AS gram FROM t),
v AS (SELECT r, rank, start FROM p JOIN u USING (gram)),
x0 AS (SELECT r, rank, start, t.words, t.id, len(list_intersect(b[start + 1:start + t.words - 1], g)) AS common, len(list_distinct(b[start + 1:start + t.words - 1])) AS n, len(g) AS m FROM v JOIN t USING (rank) JOIN b USING (r)),
x1 AS MATERIALIZED (SELECT r, rank, start, words, id, common, floor(200 * common / (m + n))::INT AS percent FROM x0 WHERE 200 * common >= {THRESHOLD_PERCENT} * (m + n)),
x2 AS MATERIALIZED (SELECT * FROM x1 x WHERE NOT EXISTS (SELECT 1 FROM x1 o WHERE o.r = x.r AND o.rank = x.rank AND {_OVERLAP} AND (o.common, o.percent, -o.start) > (x.common, x.percent, -x.start))),
m AS (SELECT * FROM x2 x WHERE NOT EXISTS (SELECT 1 FROM x2 o WHERE o.r = x.r AND {_OVERLAP} AND (o.common, o.percent, -o.rank) > (x.common, x.percent, -x.rank))),
s AS (SELECT r, count(*) AS n, list_sort(list_distinct(list(id))) AS ids, max(struct_pack(common := common, percent := percent, rank := -rank, id := id)) AS top FROM m GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_matches, coalesce(array_to_string(ids, ','), '') AS licences, top.id AS best_licence, coalesce(top.percent, 0)::BIGINT AS best_percent,
  coalesce(len(list_filter(ids, lambda k: NOT list_contains({_sql_list(PERMISSIVE)}, k) AND (k <> '{RESERVED}' OR len(ids) = 1))) = 0, true) AS allowed
FROM d LEFT JOIN s USING (r)
"""

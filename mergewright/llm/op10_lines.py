"""Cross-document line frequency, in DataFrame functions only.

Lines are normalised (lower case, single spaces) and hashed; for each host (source) the distinct documents of each line
are counted over all documents, where copies of a text are one document. A line in more of a host's documents than its
limit allows is boilerplate and is removed. A document that loses more than half of its words so, or has too few left, is
depleted and rejected, as is one that fails the base rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stash

#: A line is boilerplate in more than this percentage of a host's distinct documents, but in more than MIN_DOCUMENTS at least.
MAX_PERCENT, MIN_DOCUMENTS = 2, 5
#: A document that loses more than this percentage of its words is depleted, as is one with less than MIN_WORDS left.
MAX_LOST_PERCENT = 50
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: White space, and the same within a line.
SPACE, BLANK = "[ \\t\\n\\x0b\\f\\r]+", "[ \\t\\x0b\\f\\r]+"
SYMBOLS = "[#*$%&|<>]"


def line_words(line: Column) -> Column:
    return F.array_remove(F.split(F.lower(line), BLANK), "")


def line_hash(words: Column) -> Column:
    return F.xxhash64(F.array_join(words, " "))


def repeated_words(hashes: Column) -> Column:
    """How many words lie in a 3-word window whose hash occurs twice or more. Hashes are sorted with their places, so equal ones stand side by side."""

    def covered(placed: Column) -> Column:
        same = lambda x, other: F.coalesce(x["h"] == other["h"], F.lit(False))
        twins = F.filter(placed, lambda x, i: same(x, F.get(placed, i - 1)) | same(x, F.get(placed, i + 1)))
        places = F.sort_array(F.transform(twins, lambda x: x["p"]))
        return let(places, lambda at: F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))), F.lit(0), lambda a, x: a + x))

    placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    # Most texts repeat no window at all.
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(let(placed, covered)).cast("long")


def measured(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """The base figures of each row, and its lines as hash and number of words; with the text if asked."""
    text = F.coalesce(F.col("text"), F.lit(""))
    out = docs.select("doc_id", F.coalesce(F.col("source"), F.lit("\x00null")).alias("host"), text.alias("t"))
    out = out.select("doc_id", "host", "t", F.array_remove(F.split("t", SPACE), "").alias("words"), F.filter(F.split("t", "\n"), lambda x: F.btrim(x, F.lit(" \t\x0b\f\r")) != "").alias("lines"))
    n = F.size("words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))))
    out = out.select(
        "doc_id",
        "host",
        F.xxhash64("t").alias("name"),
        *(["t"] if keep_text else []),
        n.cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.regexp_replace("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(windows, F.array().cast("array<long>")).alias("windows"),
        F.transform("lines", line_words).alias("lines"),
    )
    return out.select(
        F.monotonically_increasing_id().alias("row"),
        *[c for c in out.columns if c not in ("windows", "lines")],
        repeated_words(F.col("windows")).alias("n_repeat_words"),
        F.transform("lines", lambda x: F.struct(line_hash(x).alias("line"), F.size(x).alias("n"))).alias("lines"),
    )


def common_lines(base: DataFrame, max_percent: float, min_documents: int) -> DataFrame:
    """(host, line) above the limit of the host."""
    each = base.select("host", "name", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("line"))
    # Copies of a text first, then documents of a line; both sum up within tasks, so a hot host or line is no single task.
    found = each.groupBy("host", "line").agg(F.count_distinct("name").alias("n")).where(F.col("n") > min_documents)
    hosts = base.groupBy("host").agg(F.count_distinct("name").alias("documents"))
    return found.join(hosts, "host").where(100 * F.col("n") > max_percent * F.col("documents")).select("host", "line")


def ruled(docs: DataFrame, max_percent: float, min_documents: int, max_lost_percent: float, keep_text: bool) -> DataFrame:
    base = stash(measured(docs, keep_text), "lines")
    common = stash(common_lines(base, max_percent, min_documents), "common")
    # Spark broadcasts the common lines only where the size of their table is under its threshold.
    lost = base.select("row", "host", F.explode("lines").alias("x")).select("row", "host", "x.line", "x.n").join(common, ["host", "line"])
    lost = lost.groupBy("row").agg(F.sum("n").alias("lost"), *([F.collect_set("line").alias("gone")] if keep_text else []))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    out = base.drop("lines", "host").join(lost, "row", "left").withColumn("lost", F.coalesce("lost", F.lit(0)).cast("long"))
    depleted = (100 * F.col("lost") > max_lost_percent * F.col("n_words")) | (F.col("n_words") - F.col("lost") < MIN_WORDS)
    return out.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def line_rules(docs: DataFrame, max_percent: float = MAX_PERCENT, min_documents: int = MIN_DOCUMENTS, max_lost_percent: float = MAX_LOST_PERCENT) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lost_words, kept for each row of
    docs (doc_id, text, source).

    A null or empty text has no words and fails the base rules. A null source is a host of its own. Rows with
    null or repeated doc_id are documents like others. An empty table gives an empty result; other columns are ignored.
    """
    return ruled(docs, max_percent, min_documents, max_lost_percent, False).select("doc_id", *COLUMNS, F.col("lost").alias("n_lost_words"), "kept")


def without_common_lines(docs: DataFrame, max_percent: float = MAX_PERCENT, min_documents: int = MIN_DOCUMENTS, max_lost_percent: float = MAX_LOST_PERCENT) -> DataFrame:
    """doc_id, text without its common lines, kept: as line_rules() with the cleaned texts. A null text is empty; a text
    that loses nothing stays as it is."""
    out = ruled(docs, max_percent, min_documents, max_lost_percent, True)
    stays = F.filter(F.split("t", "\n"), lambda x: ~F.array_contains("gone", line_hash(line_words(x))))
    return out.select("doc_id", F.when(F.col("lost") > 0, F.array_join(stays, "\n")).otherwise(F.col("t")).alias("text"), "kept")


def op10_line_frequency(spark, sf_dir: str) -> DataFrame:
    return line_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, chr(1)) AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
e AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS i FROM w),
g AS (SELECT r, i, word, lead(word, 1) OVER p AS word1, lead(word, 2) OVER p AS word2 FROM e WINDOW p AS (PARTITION BY r ORDER BY i)),
tri AS (SELECT r, i, count(*) OVER (PARTITION BY r, word, word1, word2) AS n FROM g WHERE word2 IS NOT NULL),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM (SELECT r, i, unnest([0, 1, 2]) AS o FROM tri WHERE n > 1) GROUP BY r),
ln AS (SELECT r, unnest(list_transform(lines, lambda x: regexp_extract_all(lower(x), '[^\x20\x09-\x0D]+'))) AS line FROM w),
hosts AS (SELECT host, count(DISTINCT t) AS documents FROM d GROUP BY host),
freq AS (SELECT host, line FROM ln JOIN d USING (r) JOIN hosts USING (host) GROUP BY host, line, documents HAVING count(DISTINCT t) > {MIN_DOCUMENTS} AND 100 * count(DISTINCT t) > {MAX_PERCENT} * documents),
lost AS (SELECT r, sum(len(line)) AS lost FROM ln JOIN d USING (r) JOIN freq USING (host, line) GROUP BY r),
s AS (SELECT doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
  (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0)::BIGINT AS n_lost_words
  FROM d JOIN w USING (r) LEFT JOIN rep USING (r) LEFT JOIN lost USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed, n_lost_words,
  (NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND 100 * n_lost_words <= {MAX_LOST_PERCENT} * n_words AND n_words - n_lost_words >= {MIN_WORDS}) AS kept
FROM s
"""

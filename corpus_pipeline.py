"""A training corpus in five stages: each takes the documents that its predecessor kept."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mergewright.llm.common import release, stash
from mergewright.llm.op3_pii import pseudonymise, session_key
from mergewright.llm.op5_packing import pack
from mergewright.llm.op6_mixing import mixed
from mergewright.llm.op7_parity import BROADCAST_ROWS, near_components
from mergewright.llm.op8_quality import good_rows

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good, each by its own text; ids only link labels to texts.

    A null text counts as empty; null and repeated ids, repeated rows and an empty table need no care."""
    return good_rows(docs.select(*COLUMNS), spark.read.parquet(posixpath.join(sf_dir, "labels.parquet")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id, null last, and of its first row.

    Rows, not ids, are compared: copies count as such whether ids are null, repeated or different. Texts without words
    are no copies of each other and stay. Where ids tell the rows apart, docs is read again and again and not written anew."""
    docs = docs.select(*COLUMNS)
    odd = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).count().where("count > 1 OR doc_id IS NULL")
    if odd.isEmpty():
        rows = docs.withColumn("row", F.col("doc_id").cast("long"))
    else:
        rows = stash(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    found = near_components(rows.select(F.col("row").alias("doc_id"), "text")).select(F.col("doc_id").alias("row"), "component_id")
    found = found.join(rows.select("row", "doc_id"), "row")
    kept = found.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("kept")).select("kept.row")
    # By row, so that a large group is no single task.
    extra = stash(found.select("row").join(kept, "row", "left_anti"), "copies")
    release(spark)
    # So that texts need no shuffle, up to the bound that holds for the join's own tables.
    return rows.join(F.broadcast(extra) if extra.count() <= BROADCAST_ROWS else extra, "row", "left_anti").select(*COLUMNS)


def protect(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms in place of personal data; n_chars follows the text. Null and empty texts stay as they are,
    and rows are changed one by one, whatever their ids."""
    out = pseudonymise(docs.select(*COLUMNS), session_key(spark))
    return out.withColumn("n_chars", F.when(F.col("n_changed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample with raked source, language and topic marginals. A null source or language is one of its own; rows of one id
    and cell are kept or dropped together, as are equal texts without one; a null text has one token."""
    return mixed(docs.select(*COLUMNS)).where("mix_kept").select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences. A null or empty text has one token; rows with null or repeated ids are documents like others."""
    return pack(docs)


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("pseudonyms", protect),
    ("mixing", mix),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all stages over documents; of an empty table none."""
    docs = spark.read.parquet(posixpath.join(sf_dir, "documents.parquet"))
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, f"stage{k}")
    return docs


#: SQL can't express the fitted classifier nor the tokens.
ORACLE_SQL = None

"""The read side: what an explorer of masters asks for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def query(spark: SparkSession, sql: str, params=()) -> DataFrame:
    """A query with ? markers."""
    return spark.sql(sql, args=list(params))


def key_figures(std: DataFrame, masters: DataFrame, xref: DataFrame, queue: DataFrame) -> DataFrame:
    prefix = F.substring("record_key", 1, 4)
    both = xref.groupBy("master_id").agg(F.count_distinct(prefix).alias("n")).agg(F.count_if(F.col("n") > 1).alias("both_registers"))
    records = std.agg(F.count("*").alias("records"))
    merged = masters.agg(F.count("*").alias("masters"), F.count_if(F.col("member_count") > 1).alias("merged"))
    reviews = queue.agg(F.count_if(F.col("status") == "OPEN").alias("open_reviews"))
    return records.crossJoin(merged).crossJoin(both).crossJoin(reviews)


def search(masters: DataFrame, name: str, n: int = 50) -> DataFrame:
    found = masters.where(F.col("master_name").ilike(f"%{name}%")).select("master_id", "master_name", "member_count", "nzbn_conflict")
    return found.orderBy(F.desc("member_count"), "master_name", "master_id").limit(n)


def members(xref: DataFrame, std: DataFrame, master_id: str) -> DataFrame:
    mine = xref.where(F.col("master_id") == master_id).select("record_key", "link_type", "link_confidence", "link_rules")
    return mine.join(std.drop("source_system"), "record_key").orderBy("record_key")


def records_of(xref: DataFrame, master_id: str) -> DataFrame:
    return xref.where(F.col("master_id") == master_id).select("record_key")


def pair_evidence(pairs: DataFrame, decisions: DataFrame, ledger: DataFrame, records: DataFrame) -> DataFrame:
    """Evidence of the pairs among the records (record_key)."""
    inside = pairs.select("pair_id", "left_key", "right_key")
    for side in ("left_key", "right_key"):
        inside = inside.join(records.withColumnRenamed("record_key", side), side, "left_semi")
    return inside.join(decisions.select("pair_id", "decision"), "pair_id").join(ledger, "pair_id")


def pair_summary(evidence: DataFrame, strong: float = 80) -> DataFrame:
    """For each pair the strong evidence (null if there is none), the sum of contributions, and what the identifiers say."""
    number = F.max(F.when(F.col("feature") == "NZBN_EQ", F.col("similarity")))
    features = F.collect_list(F.when(F.col("in_score") & (F.col("similarity") >= strong), F.col("feature")))
    return evidence.groupBy("pair_id", "left_key", "right_key", "decision").agg(
        F.when(F.size(features) > 0, F.array_sort(features)).alias("strong_evidence"),
        F.sum("contribution").alias("evidence_score"),
        F.when(number == 100, "same").when(number == 0, "different").otherwise("unknown").alias("identifier"),
    )


def queue_of(queue: DataFrame, pairs: DataFrame, records: DataFrame) -> DataFrame:
    """Items of the queue that name one of the records (record_key), themselves or through their pair."""
    out = queue.select("exception_id", "reason_code", "status", "record_key", "pair_id").join(pairs.select("pair_id", "left_key", "right_key"), "pair_id", "left")
    named = out.select("exception_id", F.explode(F.array_compact(F.array("record_key", "left_key", "right_key"))).alias("named"))
    mine = named.join(records.withColumnRenamed("record_key", "named"), "named", "left_semi").select("exception_id").distinct()
    return out.join(mine, "exception_id", "left_semi").select("reason_code", "status", "record_key", "left_key", "right_key")


def decision_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy("decision").agg(F.count("*").alias("pairs"))


def reason_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("reason_code").agg(F.count("*").alias("items"))


def master_sizes(masters: DataFrame) -> DataFrame:
    return masters.groupBy("member_count").agg(F.count("*").alias("masters"))

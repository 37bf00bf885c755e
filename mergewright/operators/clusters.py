"""Clusters of automatically matched records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.params import Params
from ..scratch import staged


@dataclass(frozen=True)
class Clusters:
    edges: DataFrame
    labels: DataFrame
    rounds: int
    converged: bool


def edges(pairs: DataFrame, decisions: DataFrame) -> DataFrame:
    """Automatic matches in both directions: pair_id, from_key, to_key, score, decision_path."""
    auto = decisions.where("decision = 'AUTO_MATCH'").join(pairs.select("pair_id", "left_key", "right_key"), "pair_id")
    ways = F.explode(F.array(F.struct(F.col("left_key").alias("from_key"), F.col("right_key").alias("to_key")), F.struct(F.col("right_key").alias("from_key"), F.col("left_key").alias("to_key"))))
    return auto.select("pair_id", ways.alias("w"), "score", "decision_path").select("pair_id", "w.*", "score", "decision_path")


def connected(std: DataFrame, links: DataFrame, p: Params = Params()) -> Clusters:
    """record_key, cluster_id: each record's smallest reachable key. Only linked records take part in the rounds; each
    round takes the smallest label of the neighbours, then the label of that label."""
    links = staged(links, "edges")
    near = links.select("from_key", "to_key").distinct()
    labels = staged(near.select(F.col("from_key").alias("record_key")).distinct().withColumn("cluster_id", F.col("record_key")), "labels")
    rounds, changed = 0, 1
    while changed:
        if rounds == p.max_rounds:
            raise RuntimeError(f"clusters still change after {rounds} rounds")
        rounds += 1
        least = near.join(labels, near["to_key"] == labels["record_key"]).groupBy("from_key").agg(F.min("cluster_id").alias("least"))
        step = labels.join(least, labels["record_key"] == least["from_key"], "left").select("record_key", F.col("cluster_id").alias("was"), F.least("cluster_id", "least").alias("cluster_id"))
        beyond = step.select(F.col("record_key").alias("cluster_id"), F.col("cluster_id").alias("beyond"))
        step = staged(step.join(beyond, "cluster_id", "left").select("record_key", "was", F.least("cluster_id", "beyond").alias("cluster_id")), "labels")
        changed = step.where("was <> cluster_id").count()
        labels = step.select("record_key", "cluster_id")
    ends = links.join(labels.select(F.col("record_key").alias("from_key"), F.col("cluster_id").alias("a")), "from_key").join(labels.select(F.col("record_key").alias("to_key"), F.col("cluster_id").alias("b")), "to_key")
    whole = std.select("record_key").join(labels, "record_key", "left").select("record_key", F.coalesce("cluster_id", "record_key").alias("cluster_id"))
    return Clusters(links, whole, rounds, ends.where("a <> b").isEmpty())


def entity_xref(std: DataFrame, clusters: Clusters) -> DataFrame:
    """Each record's master, and how it is linked to it."""
    size = clusters.labels.groupBy("cluster_id").agg(F.count("*").alias("members"))
    links = clusters.edges.groupBy("from_key").agg(F.max("score").alias("link_confidence"), F.array_sort(F.collect_set("decision_path")).alias("link_rules"))
    out = clusters.labels.join(size, "cluster_id").join(std.select("record_key", "source_system", "source_record_id"), "record_key").join(links, F.col("record_key") == F.col("from_key"), "left")
    return out.select(
        F.concat(F.lit("ORG-"), F.substring(F.sha2("cluster_id", 256), 1, 12)).alias("master_id"),
        "cluster_id",
        "record_key",
        "source_system",
        "source_record_id",
        F.when(F.col("members") == 1, "SINGLETON").when(F.col("record_key") == F.col("cluster_id"), "SEED").otherwise("AUTO_MATCH").alias("link_type"),
        F.when(F.col("members") > 1, F.col("link_confidence")).alias("link_confidence"),
        F.when(F.col("members") > 1, F.col("link_rules")).alias("link_rules"),
    )

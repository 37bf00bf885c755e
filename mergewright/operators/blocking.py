"""Candidate pairs by blocking keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..plans.params import Params


def block_keys(std: DataFrame) -> DataFrame:
    """record_key, block_type, block_value: all keys of a record in one pass, without repeats."""
    host = F.col("website_domain")
    key = lambda kind, value: F.array(F.struct(F.lit(kind).alias("block_type"), value.alias("block_value")))
    keys = F.concat(
        key("POSTCODE_NAME4", F.concat("postcode", F.lit("|"), F.substring("name_core", 1, 4))),
        key("PHONE", F.col("phone_clean")),
        key("EMAIL", F.when(~F.col("is_generic_email_domain"), F.col("email_clean"))),
        key("WEBSITE", F.when(F.contains(host, F.lit(".")) & ~X.is_generic_host(host), host)),
        key("NAME_EXACT", F.col("name_core")),
        F.transform("alt_names", lambda n: F.struct(F.lit("NAME_EXACT").alias("block_type"), X.name_core(n).alias("block_value"))),
        key("NZBN", F.col("nzbn")),
    )
    exploded = std.where("is_matchable").select("record_key", F.explode(F.array_distinct(F.filter(keys, lambda k: k["block_value"].isNotNull()))).alias("k"))
    return exploded.select("record_key", "k.block_type", "k.block_value").distinct()


def skipped_blocks(keys: DataFrame, params: Params = Params()) -> DataFrame:
    """Blocks of more than max_block records, which give no pairs."""
    return keys.groupBy("block_type", "block_value").agg(F.count("*").alias("record_count")).where(F.col("record_count") > params.max_block)


def candidate_pairs(std: DataFrame, keys: DataFrame, skipped: DataFrame) -> DataFrame:
    """One row for each pair that shares a block of at most max_block records (so a block makes a bounded number of pairs)."""
    kept = keys.join(skipped, ["block_type", "block_value"], "left_anti")
    left, right = kept.select("block_type", "block_value", F.col("record_key").alias("left_key")), kept.select("block_type", "block_value", F.col("record_key").alias("right_key"))
    pairs = left.join(right, ["block_type", "block_value"]).where("left_key < right_key")
    pairs = pairs.groupBy("left_key", "right_key").agg(F.array_sort(F.collect_set("block_type")).alias("block_types"))
    source = std.select("record_key", "source_system")
    pairs = pairs.join(source.select(F.col("record_key").alias("left_key"), F.col("source_system").alias("left_source")), "left_key")
    pairs = pairs.join(source.select(F.col("record_key").alias("right_key"), F.col("source_system").alias("right_source")), "right_key")
    short = lambda c: F.when(F.col(c) == "CHARITIES_REGISTER", "CHR").otherwise("COS")
    kind = F.when(F.col("left_source") == F.col("right_source"), F.concat_ws("-", short("left_source"), short("right_source"))).otherwise("CHR-COS")
    return pairs.select(
        F.sha2(F.concat_ws("|", "left_key", "right_key"), 256).alias("pair_id"),
        "left_key",
        "right_key",
        "left_source",
        "right_source",
        kind.alias("pair_type"),
        "block_types",
        F.size("block_types").cast("long").alias("block_count"),
        (F.col("block_types") == F.array(F.lit("NZBN"))).alias("only_nzbn_block"),
    )


def summary(pairs: DataFrame, keys: DataFrame, skipped: DataFrame) -> DataFrame:
    """metric, value."""
    spark = pairs.sparkSession
    kinds = spark.createDataFrame([("CHR-CHR",), ("CHR-COS",), ("COS-COS",)], "pair_type string")
    by_kind = kinds.join(pairs, "pair_type", "left").groupBy("pair_type").agg(F.count("pair_id").alias("value"))
    by_block = pairs.select(F.explode("block_types").alias("b")).groupBy("b").agg(F.count("*").alias("value"))
    largest = keys.join(skipped, ["block_type", "block_value"], "left_anti").groupBy("block_type", "block_value").count()
    parts = [
        pairs.agg(F.count("*").alias("value")).select(F.lit("total_pairs").alias("metric"), "value"),
        by_kind.select(F.concat(F.lit("pairs_"), "pair_type").alias("metric"), "value"),
        by_block.select(F.concat(F.lit("pairs_block_"), "b").alias("metric"), "value"),
        pairs.agg(F.count_if("only_nzbn_block").alias("value")).select(F.lit("only_nzbn_block_pairs").alias("metric"), "value"),
        skipped.agg(F.count("*").alias("value")).select(F.lit("blocks_skipped").alias("metric"), "value"),
        largest.agg(F.coalesce(F.max("count"), F.lit(0)).alias("value")).select(F.lit("largest_kept_block_size").alias("metric"), "value"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out

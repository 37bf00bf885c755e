"""Master records: survivorship, conflicts, lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..plans.params import Params
from .scoring import unreviewed
from .standardise import CHARITY, COMPANY, first_exports


def newest_first(*before: Column) -> Column:
    """Sort key: what comes before, then the newest date, missing ones last, then the key."""
    date = F.col("registered_date")
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(before)], date.isNull().alias("no_date"), (-F.unix_date(date)).alias("age"), F.col("record_key").alias("key"))


def open_reviews(queue: DataFrame, pairs: DataFrame) -> DataFrame:
    """Records that an open item of the queue names, itself or through its pair."""
    open_ = queue.where("status = 'OPEN'")
    by_pair = open_.join(pairs.select("pair_id", "left_key", "right_key"), "pair_id").select(F.explode(F.array("left_key", "right_key")).alias("record_key"))
    return by_pair.union(open_.where("record_key IS NOT NULL").select("record_key")).distinct()


def master_organisations(std: DataFrame, xref: DataFrame, queue: DataFrame, pairs: DataFrame, p: Params = Params()) -> DataFrame:
    reviewed = open_reviews(queue, pairs).withColumn("in_review", F.lit(True))
    members = xref.select("master_id", "record_key", "link_confidence").join(std, "record_key").join(reviewed, "record_key", "left")
    order = newest_first()
    newest = lambda c: F.min_by(F.col(c), F.when(F.col(c).isNotNull(), order))
    registered = F.col("entity_status") == "REGISTERED"
    name_order = newest_first(F.col("name_raw").isNull(), ~F.coalesce(registered, F.lit(False)))
    place = F.struct("address_line_clean", "suburb", "city", "postcode")
    placed = F.coalesce("address_line_clean", "suburb", "city", "postcode").isNotNull()
    base = members.groupBy("master_id").agg(
        F.min_by(F.struct("name_raw", "record_key"), name_order).alias("name"),
        F.min_by(place, F.when(placed, order)).alias("place"),
        newest("phone_clean").alias("phone"),
        newest("email_clean").alias("email"),
        newest("website_domain").alias("website"),
        (F.count_distinct("nzbn") > 1).alias("nzbn_conflict"),
        F.array_sort(F.collect_set("charity_reg_no")).alias("charity_reg_nos"),
        F.array_sort(F.collect_set("source_system")).alias("source_systems"),
        F.count("*").alias("member_count"),
        F.min("link_confidence").alias("min_link_confidence"),
        F.coalesce(F.bool_or("in_review"), F.lit(False)).alias("has_open_review"),
        F.when(F.coalesce(F.bool_or(registered), F.lit(False)), "REGISTERED").otherwise(newest("entity_status")).alias("status_summary"),
    )
    votes = members.where("nzbn IS NOT NULL").groupBy("master_id", "nzbn").agg(F.count("*").alias("n"))
    votes = votes.groupBy("master_id").agg(F.min_by("nzbn", F.struct(-F.col("n"), "nzbn")).alias("nzbn"))
    return base.join(votes, "master_id", "left").select(
        "master_id",
        F.col("name.name_raw").alias("master_name"),
        F.col("name.record_key").alias("name_source_key"),
        "nzbn",
        "nzbn_conflict",
        F.col("place.address_line_clean").alias("address_line"),
        F.col("place.suburb").alias("suburb"),
        F.col("place.city").alias("city"),
        F.col("place.postcode").alias("postcode"),
        "phone",
        "email",
        "website",
        "charity_reg_nos",
        "source_systems",
        "member_count",
        "min_link_confidence",
        (F.col("has_open_review") | F.col("nzbn_conflict")).alias("has_open_review"),
        (F.col("member_count") > p.large_cluster).alias("is_large_cluster"),
        "status_summary",
    )


def chain_queue(masters: DataFrame, xref: DataFrame) -> DataFrame:
    """Items for every member of a master whose records hold different numbers."""
    members = xref.join(masters.where("nzbn_conflict").select("master_id"), "master_id", "left_semi")
    code = F.lit("CHAIN_NZBN_CONFLICT")
    return members.select(
        F.sha2(F.concat_ws("|", "record_key", code), 256).alias("exception_id"),
        F.lit(None).cast("string").alias("pair_id"),
        "record_key",
        code.alias("reason_code"),
        F.lit(None).cast("decimal(5,2)").alias("score"),
        F.lit("OPEN").alias("status"),
        *unreviewed(),
    )


def entity_lineage(xref: DataFrame, masters: DataFrame, std: DataFrame, raw_charities: DataFrame, raw_companies: DataFrame) -> DataFrame:
    """From each master through its records to the rows of the source files."""

    def extra(raw: DataFrame, name: str, kind: str):
        return F.col(name) if name in raw.columns else F.lit(None).cast(kind)

    charity = raw_charities.select(
        F.lit(CHARITY).alias("source_system"), X.blank_to_null(F.col("organisationid")).alias("source_record_id"), F.col("name").alias("raw_name"),
        extra(raw_charities, "_source_file", "string").alias("raw_source_file"), extra(raw_charities, "_loaded_at", "timestamp_ntz").alias("raw_loaded_at"), F.lit(None).cast("string").alias("cos_export_file"),
    )
    company = first_exports(raw_companies).select(
        F.lit(COMPANY).alias("source_system"), X.blank_to_null(F.col("nzbn")).alias("source_record_id"), F.col("business_name").alias("raw_name"),
        extra(raw_companies, "_source_file", "string").alias("raw_source_file"), extra(raw_companies, "_loaded_at", "timestamp_ntz").alias("raw_loaded_at"), F.col("export_file").alias("cos_export_file"),
    )
    out = xref.join(masters.select("master_id", "master_name"), "master_id").join(std.select("record_key", "name_raw"), "record_key")
    out = out.join(charity.unionByName(company), ["source_system", "source_record_id"], "left")
    return out.select("master_id", "master_name", "record_key", "source_system", "source_record_id", "name_raw", "raw_name", "raw_source_file", "raw_loaded_at", "cos_export_file", "link_type", "link_confidence", "link_rules")


def summary(masters: DataFrame, xref: DataFrame, rounds: int | None = None) -> DataFrame:
    """metric, value."""
    both = F.array_contains("source_systems", CHARITY) & F.array_contains("source_systems", COMPANY)
    numbers = {
        "staging_records": F.sum("member_count"),
        "master_entities": F.count("*"),
        "singletons": F.count_if(F.col("member_count") == 1),
        "multi_record_masters": F.count_if(F.col("member_count") > 1),
        "records_merged_away": F.sum("member_count") - F.count("*"),
        "largest_cluster_size": F.max("member_count"),
        "masters_nzbn_conflict": F.count_if("nzbn_conflict"),
        "chain_nzbn_conflict_queued": F.sum(F.when(F.col("nzbn_conflict"), F.col("member_count")).otherwise(0)),
        "masters_has_open_review": F.count_if("has_open_review"),
        "large_clusters": F.count_if("is_large_cluster"),
        "cross_source_masters": F.count_if(both),
    }
    if rounds is not None:
        numbers["label_propagation_iterations"] = F.lit(rounds)
    wide = masters.agg(*[v.cast("double").alias(k) for k, v in numbers.items()])
    top = masters.where("member_count > 1").orderBy(F.desc("member_count"), "master_id").limit(5)
    named = top.select(F.concat(F.coalesce("master_name", "master_id"), F.lit(" ("), F.col("member_count").cast("string"), F.lit(" records)")).alias("metric"), F.col("min_link_confidence").cast("double").alias("value"))
    return wide.unpivot([], list(numbers), "metric", "value").union(named)

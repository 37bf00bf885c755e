"""Declared tables of a run: columns and types, agreed before any step writes to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = {
    "organisation_std": "record_key string, source_system string, source_record_id string, name_raw string, name_clean string, name_core string, alt_names array<string>, charity_reg_no string, charity_parent_reg_no string, nzbn string, company_no string, address_line_clean string, suburb string, city string, postcode string, phone_clean string, email_clean string, email_domain string, is_generic_email_domain boolean, website_domain string, entity_status string, registered_date date, is_matchable boolean, dq_flags array<string>, run_id string, standardised_at timestamp_ntz",
    "block_key": "record_key string, block_type string, block_value string, run_id string",
    "block_skipped": "block_type string, block_value string, record_count long, run_id string",
    "candidate_pair": "pair_id string, left_key string, right_key string, left_source string, right_source string, pair_type string, block_types array<string>, block_count long, only_nzbn_block boolean, run_id string, created_at timestamp_ntz",
    "match_feature": "pair_id string, name_jw decimal(5,2), name_core_jw decimal(5,2), name_core_jw_rev decimal(5,2), alt_name_jw decimal(5,2), address_jw decimal(5,2), name_token_jaccard decimal(5,2), postcode_eq boolean, city_eq boolean, phone_eq boolean, email_eq boolean, website_eq boolean, nzbn_eq boolean, company_no_eq boolean, same_parent_charity boolean, email_shared_count long, phone_shared_count long, website_shared_count long, nzbn_shared_count long, company_no_shared_count long, address_shared_count long, run_id string, computed_at timestamp_ntz",
    "match_decision": "pair_id string, score decimal(5,2), decision string, top_reasons array<string>, fuzzy_score decimal(5,2), fuzzy_decision string, decision_path string, rule_version string, run_id string, decided_at timestamp_ntz",
    "match_evidence": "pair_id string, feature string, left_value string, right_value string, similarity decimal(5,2), weight decimal(5,2), in_score boolean, contribution decimal(6,2), run_id string",
    "exception_queue": "exception_id string, pair_id string, record_key string, reason_code string, score decimal(5,2), status string, reviewer string, review_decision string, reviewed_at timestamp_ntz, run_id string",
    "entity_xref": "master_id string, cluster_id string, record_key string, source_system string, source_record_id string, link_type string, link_confidence decimal(5,2), link_rules array<string>, rule_version string, run_id string",
    "master_organisation": "master_id string, master_name string, name_source_key string, nzbn string, nzbn_conflict boolean, address_line string, suburb string, city string, postcode string, phone string, email string, website string, charity_reg_nos array<string>, source_systems array<string>, member_count long, min_link_confidence decimal(5,2), has_open_review boolean, is_large_cluster boolean, status_summary string, rule_version string, run_id string, built_at timestamp_ntz",
    "truth_pair": "left_key string, right_key string, nzbn string, nzbn_record_count long, pair_id string, in_candidates boolean, found_without_nzbn boolean, block_types array<string>, fuzzy_score decimal(5,2), fuzzy_decision string, run_id string",
    "evaluation_result": "run_id string, evaluated_at timestamp_ntz, rule_version string, metric_group string, metric string, value decimal(18,4), note string",
    "dq_profile": "run_id string, profiled_at timestamp_ntz, source string, check_name string, metric_value decimal(18,2), unit string, why_it_matters string",
    "pipeline_run": "run_id string, step string, started_at timestamp_ntz, finished_at timestamp_ntz, rows_out long, rule_version string, status string, notes string",
}
#: Tables that keep the rows of earlier runs.
HISTORY = ("evaluation_result", "dq_profile", "pipeline_run")

#: What a metric means, by the start of its name.
NOTES = {
    "total_true_pairs": "pairs of matchable records that share a business number which few records hold",
    "evaluable": "candidate pairs found without the number whose sides both have one",
    "blocking_recall_all": "share of the true pairs among the candidates",
    "blocking_recall_without": "share of the true pairs among the candidates that other blocks than the number's give",
    "prod_auto_nzbn_conflict": "automatic matches whose sides have different numbers; must be 0",
    "prod_auto_nzbn_equal": "automatic matches whose sides have the same number",
    "tp": "true pairs that are predicted",
    "fp": "predicted pairs that aren't true",
    "fn": "true pairs that aren't predicted, those out of the candidates included",
    "precision": "share of the predicted pairs that are true",
    "recall": "share of all true pairs that are predicted",
    "f1": "harmonic mean of precision and recall",
}
#: Why a check of the raw data matters, by the start of its name.
REASONS = {
    "row_count": "a change of size between loads shows an export that is cut or doubled",
    "pct_nonblank": "what is missing can't be evidence for or against a match",
    "organisationid": "the key of the charities; a repeat breaks record keys",
    "charityregistrationnumber": "members of a group share the first part of the number",
    "nzbn_shared": "records that share a number are the answer key, and branches of one legal entity",
    "nzbn": "the strongest identifier; repeats show branches and placeholder values",
    "records_sharing_exact_name": "an equal name alone doesn't make a match",
    "blank_name": "a record without a name can't be matched",
    "reg_no": "numbers with a suffix are members of a group and must not be merged with it",
    "phone": "several numbers, extensions and country codes hide equal telephones",
    "street_postcode": "postcodes that lost their leading zero block wrongly",
    "postal_postcode": "postcodes that lost their leading zero block wrongly",
    "no_business_name": "these fall back on the trading name",
    "no_physical_address": "these can only match by name and contact",
    "entity_type": "the mix of legal forms in the export",
    "dq_flag": "flags go along with the record and explain weak matches",
    "not_matchable": "records that take no part in matching",
    "pct_generic_email_domain": "a shared mail host isn't evidence",
    "shared_email": "addresses of agents that many records give",
}


def names(table: str) -> list[str]:
    return [c.split()[0] for c in TABLES[table].replace("(5,2)", "").replace("(6,2)", "").replace("(18,2)", "").replace("(18,4)", "").split(", ")]


def explained(df: DataFrame, column: str, texts: dict[str, str], name: str) -> DataFrame:
    """df with the text of the longest start of `column`, or null."""
    out = F.lit(None).cast("string")
    for start in sorted(texts, key=len):
        out = F.when(F.startswith(F.col(column), F.lit(start)), texts[start]).otherwise(out)
    return df.withColumn(name, out)


def conform(df: DataFrame, table: str) -> DataFrame:
    """df with the declared columns of a table, in order and as declared; a missing column is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in T._parse_datatype_string(TABLES[table]).fields])


def create_missing(spark: SparkSession, out: str, names=tuple(TABLES)) -> list[str]:
    """Write an empty table for each declared one that isn't there yet; the names of those written. What is there stays."""
    jvm = spark.sparkContext._jvm
    made = []
    for name in names:
        path = jvm.org.apache.hadoop.fs.Path(f"{out}/{name}")
        if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
            spark.createDataFrame([], TABLES[name]).write.parquet(f"{out}/{name}")
            made.append(name)
    return made

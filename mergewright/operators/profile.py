"""Data-quality profile: source, check_name, metric_value, unit. One pass over a table for each kind of check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

CHARITIES, COMPANIES = "RAW.CHARITIES", "RAW.COMPANIES"
CHARITY_FIELDS = (
    "name", "charityregistrationnumber", "nzbnnumber", "companiesofficenumber", "emailaddress1", "telephone1", "websiteurl", "streetaddressline1", "streetaddresspostcode",
)
COMPANY_FIELDS = ("business_name", "nzbn", "trading_as", "physical_address")


def long(df: DataFrame, source: str, unit: str, numbers: dict[str, Column]) -> DataFrame:
    """One aggregate row of df, as rows."""
    wide = df.agg(*[v.cast("decimal(18,2)").alias(f"m{i}") for i, v in enumerate(numbers.values())])
    rows = F.array(*[F.struct(F.lit(k).alias("check_name"), F.col(f"m{i}").alias("metric_value")) for i, k in enumerate(numbers)])
    return wide.select(F.explode(rows).alias("r")).select(F.lit(source).alias("source"), "r.*", F.lit(unit).alias("unit"))


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def percent(condition: Column) -> Column:
    return F.round(100 * F.count_if(condition) / F.nullif(F.count("*"), F.lit(0)), 2)


def known(name: str) -> Column:
    return X.blank_to_null(F.col(name))


def row_counts(charities: DataFrame, companies: DataFrame, std: DataFrame) -> DataFrame:
    staged = std.groupBy(F.concat(F.lit("STAGING."), "source_system").alias("source")).agg(F.count("*").cast("decimal(18,2)").alias("metric_value"))
    return union([
        long(charities, CHARITIES, "rows", {"row_count": F.count("*")}),
        long(companies, COMPANIES, "rows", {"row_count": F.count("*")}),
        staged.select("source", F.lit("row_count").alias("check_name"), "metric_value", F.lit("rows").alias("unit")),
    ])


def completeness(df: DataFrame, source: str, fields) -> DataFrame:
    return long(df, source, "%", {f"pct_nonblank_{f}": percent(known(f).isNotNull()) for f in fields})


def uniqueness(df: DataFrame, source: str, fields: dict[str, Column]) -> DataFrame:
    numbers = {}
    for f, c in fields.items():
        n, d = F.count(c), F.count_distinct(c)
        numbers |= {f"{f}_nonblank": n, f"{f}_distinct": d, f"{f}_duplicate_rows": n - d}
    return long(df, source, "values", numbers)


def duplicate_signals(charities: DataFrame) -> DataFrame:
    repeated = lambda c: charities.select(c.alias("v")).where("v IS NOT NULL").groupBy("v").count().where("count > 1")
    return union([
        long(repeated(known("nzbnnumber")), CHARITIES, "values", {"nzbn_shared_by_multiple_records": F.count("*")}),
        long(repeated(F.upper(known("name"))), CHARITIES, "records", {"records_sharing_exact_name": F.coalesce(F.sum("count"), F.lit(0))}),
        long(charities, CHARITIES, "records", {"blank_name_records": F.count_if(known("name").isNull())}),
    ])


def format_issues(charities: DataFrame) -> DataFrame:
    reg, tel = F.upper(known("charityregistrationnumber")), known("telephone1")
    street, postal = known("streetaddresspostcode"), known("postaladdresspostcode")
    four = lambda c: c.isNotNull() & ~X.matches(c, "[0-9]{4}")
    has = lambda c, *xs: reduce(lambda a, b: a | b, [F.contains(c, F.lit(x)) for x in xs])
    return long(charities, CHARITIES, "records", {
        "reg_no_not_CC_digits": F.count_if(reg.isNotNull() & ~X.matches(reg, "CC[0-9]+")),
        "reg_no_group_member": F.count_if(X.matches(reg, "CC[0-9]+-[0-9]+")),
        "phone_multi_number_or_ext": F.count_if(has(tel, "/", ",") | has(F.lower(tel), " or ", "ext")),
        "phone_intl_nz_prefix": F.count_if(F.startswith(tel, F.lit("+64")) | F.startswith(tel, F.lit("0064"))),
        "phone_overseas": F.count_if(X.phone_is_overseas(tel)),
        "street_postcode_not_4_digits": F.count_if(four(street)),
        "street_postcode_3_digits": F.count_if(X.matches(street, "[0-9]{3}")),
        "postal_postcode_not_4_digits": F.count_if(four(postal)),
    })


def company_specifics(companies: DataFrame) -> DataFrame:
    unit = "rows (raw, incl. overlap)"
    kinds = companies.groupBy(F.concat(F.lit("entity_type="), F.coalesce(known("entity_type"), F.lit("(blank)"))).alias("check_name")).agg(F.count("*").cast("decimal(18,2)").alias("metric_value"))
    return union([
        long(companies, COMPANIES, unit, {"no_business_name": F.count_if(known("business_name").isNull()), "no_physical_address": F.count_if(known("physical_address").isNull())}),
        kinds.select(F.lit(COMPANIES).alias("source"), "check_name", "metric_value", F.lit(unit).alias("unit")),
    ])


def staging_flags(std: DataFrame) -> DataFrame:
    source = F.concat(F.lit("STAGING."), "source_system")
    flags = std.select(source.alias("source"), F.explode("dq_flags").alias("f")).groupBy("source", "f").agg(F.count("*").cast("decimal(18,2)").alias("metric_value"))
    unmatched = std.groupBy(source.alias("source")).agg(F.count_if(~F.col("is_matchable")).cast("decimal(18,2)").alias("metric_value"))
    mailed = std.where("source_system = 'CHARITIES_REGISTER' AND email_clean IS NOT NULL")
    return union([
        flags.select("source", F.concat(F.lit("dq_flag="), "f").alias("check_name"), "metric_value", F.lit("records").alias("unit")),
        unmatched.select("source", F.lit("not_matchable").alias("check_name"), "metric_value", F.lit("records").alias("unit")),
        long(mailed, "STAGING.CHARITIES_REGISTER", "% of records with email", {"pct_generic_email_domain": percent(F.col("is_generic_email_domain"))}),
    ])


def shared_emails(std: DataFrame, n: int = 10) -> DataFrame:
    top = std.where("email_clean IS NOT NULL AND NOT is_generic_email_domain").groupBy("email_clean").count().where("count > 1").orderBy(F.desc("count"), "email_clean").limit(n)
    return top.select(F.col("email_clean").alias("source"), F.lit("shared_email_record_count").alias("check_name"), F.col("count").cast("decimal(18,2)").alias("metric_value"), F.lit("records").alias("unit"))


def data_quality(charities: DataFrame, companies: DataFrame, std: DataFrame) -> DataFrame:
    return union([
        row_counts(charities, companies, std),
        completeness(charities, CHARITIES, CHARITY_FIELDS),
        completeness(companies, COMPANIES, COMPANY_FIELDS),
        uniqueness(charities, CHARITIES, {"organisationid": known("organisationid"), "charityregistrationnumber": F.upper(known("charityregistrationnumber")), "nzbnnumber": known("nzbnnumber")}),
        uniqueness(companies, COMPANIES, {"nzbn": known("nzbn")}),
        duplicate_signals(charities),
        format_issues(charities),
        company_specifics(companies),
        staging_flags(std),
        shared_emails(std),
    ])

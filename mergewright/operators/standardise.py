"""Both registers in one standard shape, with shared cleaning rules applied once to their union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X

CHARITY, COMPANY = "CHARITIES_REGISTER", "COMPANIES_OFFICE"
STANDARD = (
    "record_key", "source_system", "source_record_id", "name_raw", "name_clean", "name_core", "alt_names", "charity_reg_no", "charity_parent_reg_no",
    "nzbn", "company_no", "address_line_clean", "suburb", "city", "postcode", "phone_clean", "email_clean", "email_domain", "is_generic_email_domain",
    "website_domain", "entity_status", "registered_date", "is_matchable", "dq_flags",
)


def flags(*pairs: tuple[Column, str]) -> Column:
    """The names whose conditions are true."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, n in pairs]))


def joined(*parts: Column) -> Column:
    return F.array_join(F.array_compact(F.array(*parts)), " ")


def charities(raw: DataFrame) -> DataFrame:
    """The charities register in the common raw shape."""
    c = {n: X.blank_to_null(F.col(n)) for n in raw.columns if not n.startswith("_")}
    at_street = c["streetaddressline1"].isNotNull()

    def block(part: str) -> Column:
        return F.when(at_street, c[f"streetaddress{part}"]).otherwise(c[f"postaladdress{part}"])

    line = F.when(at_street, joined(c["streetaddressline1"], c["streetaddressline2"])).otherwise(joined(c["postaladdressline1"], c["postaladdressline2"]))
    usable = lambda e: F.when(~X.is_placeholder_email(e), e)
    registration = F.upper(c["charityregistrationnumber"])
    return raw.select(
        F.concat(F.lit("CHR:"), c["organisationid"]).alias("record_key"),
        F.lit(CHARITY).alias("source_system"),
        c["organisationid"].alias("source_record_id"),
        c["name"].alias("name_raw"),
        c["othernames"].alias("alt_1"),
        F.lit(None).cast("string").alias("alt_2"),
        registration.alias("charity_reg_no"),
        F.split_part(registration, F.lit("-"), F.lit(1)).alias("charity_parent_reg_no"),
        c["nzbnnumber"].alias("nzbn_raw"),
        c["companiesofficenumber"].alias("company_no"),
        line.alias("line_raw"),
        block("suburb").alias("suburb_raw"),
        block("city").alias("city_raw"),
        block("postcode").alias("postcode_raw"),
        c["telephone1"].alias("phone_raw"),
        F.coalesce(usable(c["emailaddress1"]), usable(c["charityemailaddress"])).alias("email_raw"),
        c["websiteurl"].alias("website_raw"),
        F.upper(c["registrationstatus"]).alias("entity_status"),
        c["dateregistered"].alias("date_raw"),
        F.try_to_date(F.split_part(c["dateregistered"], F.lit(" "), F.lit(1)), "d/M/yyyy").alias("registered_date"),
        flags(
            (~at_street & c["postaladdressline1"].isNotNull(), "ADDRESS_FROM_POSTAL"),
            (X.is_placeholder_email(c["emailaddress1"]) | X.is_placeholder_email(c["charityemailaddress"]), "PLACEHOLDER_EMAIL"),
        ).alias("source_flags"),
    )


def first_exports(raw: DataFrame) -> DataFrame:
    """One row of each company number: of the first export file, then name, as received; missing ones last."""
    first = Window.partitionBy(X.blank_to_null(F.col("nzbn"))).orderBy(F.col("export_file").asc_nulls_last(), F.col("business_name").asc_nulls_last())
    return raw.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def companies(raw: DataFrame) -> DataFrame:
    """The companies register in the common raw shape; its one-line address is read from the right."""
    names = ("business_name", "nzbn", "registration_date", "trading_as", "physical_address", "previously_known_as", "status")
    base = first_exports(raw).select(*[X.blank_to_null(F.col(n)).alias(n) for n in names])
    base = base.withColumn("parts", F.split("physical_address", ", "))
    in_country = F.upper(F.trim(F.get("parts", F.size("parts") - 1))) == "NEW ZEALAND"
    base = base.withColumn("parts", F.when(in_country, F.slice("parts", 1, F.size("parts") - 1)).otherwise(F.col("parts")))
    last = F.trim(F.get("parts", F.array_size("parts") - 1))
    base = base.withColumn("has_postcode", F.coalesce(X.matches(last, "[0-9]+"), F.lit(False))).withColumn("postcode_raw", F.when(F.col("has_postcode"), last))
    base = base.withColumn("k", F.array_size("parts") - F.col("has_postcode").cast("int"))
    k = F.col("k")
    head = F.greatest(F.when(k >= 3, k - 2).otherwise(k - 1), F.lit(0))
    only_trading = F.col("business_name").isNull()
    return base.select(
        F.concat(F.lit("COS:"), "nzbn").alias("record_key"),
        F.lit(COMPANY).alias("source_system"),
        F.col("nzbn").alias("source_record_id"),
        F.coalesce("business_name", "trading_as").alias("name_raw"),
        F.when(~only_trading, F.col("trading_as")).alias("alt_1"),
        F.col("previously_known_as").alias("alt_2"),
        F.lit(None).cast("string").alias("charity_reg_no"),
        F.lit(None).cast("string").alias("charity_parent_reg_no"),
        F.col("nzbn").alias("nzbn_raw"),
        F.lit(None).cast("string").alias("company_no"),
        F.when(k >= 1, F.array_join(F.slice("parts", F.lit(1), head), " ")).alias("line_raw"),
        F.when(k >= 3, F.trim(F.get("parts", k - 2))).alias("suburb_raw"),
        F.when(k >= 1, F.trim(F.get("parts", k - 1))).alias("city_raw"),
        "postcode_raw",
        F.lit(None).cast("string").alias("phone_raw"),
        F.lit(None).cast("string").alias("email_raw"),
        F.lit(None).cast("string").alias("website_raw"),
        F.upper("status").alias("entity_status"),
        F.col("registration_date").alias("date_raw"),
        F.try_to_date("registration_date", "d-MMM-yyyy").alias("registered_date"),
        flags((only_trading & F.col("trading_as").isNotNull(), "NAME_FROM_TRADING_AS")).alias("source_flags"),
    )


def standardise(raw_charities: DataFrame, raw_companies: DataFrame) -> DataFrame:
    """One row for each source record in the STANDARD shape."""
    both = charities(raw_charities).unionByName(companies(raw_companies))
    cleaned = both.withColumns(
        {
            "name_clean": X.name_clean(F.col("name_raw")),
            "alt_names": F.array_compact(F.array(X.name_clean(F.col("alt_1")), X.name_clean(F.col("alt_2")))),
            "address_line_clean": X.address_clean(F.col("line_raw")),
            "suburb": X.place_clean(F.col("suburb_raw")),
            "city": X.place_clean(F.col("city_raw")),
            "postcode": X.postcode_clean(F.col("postcode_raw")),
            "phone_clean": X.phone_clean(F.col("phone_raw")),
            "overseas": X.phone_is_overseas(F.col("phone_raw")),
            "email_clean": F.lower("email_raw"),
            "website_domain": X.website_host(F.col("website_raw")),
            "nzbn": X.nzbn_clean(F.col("nzbn_raw")),
        }
    )
    cleaned = cleaned.withColumns({"name_core": X.name_core(F.col("name_clean")), "email_domain": X.email_domain(F.col("email_clean"))})
    missing = lambda raw, clean: F.col(raw).isNotNull() & F.col(clean).isNull()
    zeros = X.matches(F.replace("nzbn_raw", F.lit(" "), F.lit("")), "0+")
    more = flags(
        (F.col("name_clean").isNull(), "RESTRICTED_OR_NO_NAME"),
        (missing("postcode_raw", "postcode"), "INVALID_POSTCODE"),
        (F.col("overseas"), "OVERSEAS_PHONE"),
        (missing("phone_raw", "phone_clean") & ~F.col("overseas"), "INVALID_PHONE"),
        (missing("nzbn_raw", "nzbn") & zeros, "PLACEHOLDER_NZBN"),
        (missing("nzbn_raw", "nzbn") & ~zeros, "INVALID_NZBN"),
        (F.col("nzbn").isNull(), "MISSING_NZBN"),
        (missing("date_raw", "registered_date"), "INVALID_DATE"),
    )
    generic = F.coalesce(F.col("email_domain").isin(*X.GENERIC_EMAIL_DOMAINS), F.lit(False))
    return cleaned.withColumns({"is_generic_email_domain": generic, "is_matchable": F.col("name_clean").isNotNull(), "dq_flags": F.concat("source_flags", more)}).select(*STANDARD)


def summary(std: DataFrame) -> DataFrame:
    share = lambda c: F.round(100 * F.count(c) / F.count("*"), 1)
    return std.groupBy("source_system").agg(
        F.count("*").alias("rows_out"),
        F.count_if(~F.col("is_matchable")).alias("not_matchable"),
        share("nzbn").alias("pct_nzbn"),
        share("postcode").alias("pct_postcode"),
        share("phone_clean").alias("pct_phone"),
        share("email_clean").alias("pct_email"),
    )

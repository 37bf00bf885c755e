"""Cleaning rules as Column functions; register() gives SQL users the same surface."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values of the cleaning rules.
MACRONS, VOWELS = "āēīōūĀĒĪŌŪ", "aeiouAEIOU"
LEGAL_FORMS = (("LIMITED", "LTD"), ("INCORPORATED", "INC"), ("COMPANY", "CO"))
STREET_TYPES = (("STREET", "ST"), ("ROAD", "RD"), ("AVENUE", "AVE"), ("DRIVE", "DR"), ("PLACE", "PL"), ("CRESCENT", "CRES"), ("TERRACE", "TCE"))
LEADING = ("THE TRUSTEES OF THE", "TRUSTEES OF THE", "TRUSTEES IN THE", "THE")
TRAILING = ("CHARITABLE TRUST", "TRUST BOARD", "INCORPORATED SOCIETY", "INC SOCIETY", "TRUST", "INC", "LTD", "SOCIETY")
PLACEHOLDER_EMAILS = ("nocharityemail@dia.govt.nz", "noaddress@charities.govt.nz")
GENERIC_EMAIL_DOMAINS = (
    "gmail.com", "xtra.co.nz", "hotmail.com", "outlook.com", "yahoo.com", "yahoo.co.nz", "icloud.com", "live.com", "pgtrust.co.nz", "publictrust.co.nz",
)
GENERIC_HOSTS = ("facebook.com", "google.com", "sites.google.com", "wixsite.com", "wordpress.com", "blogspot.com", "weebly.com")


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def matches(c: Column, pattern: str) -> Column:
    """Whole-string match, across line breaks; null for null."""
    return c.rlike(rf"(?s)\A(?:{pattern})\z")


def plain_upper(c: Column) -> Column:
    # translate() looks up each character; few texts need it.
    return F.upper(F.when(c.rlike(f"[{MACRONS}]"), F.translate(c, MACRONS, VOWELS)).otherwise(c))


def squeezed(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def whole_words(c: Column, pairs) -> Column:
    """Each word of pairs replaced where blanks stand on both sides; a blank serves one word only."""
    padded = F.concat(F.lit(" "), c, F.lit(" "))
    return F.trim(reduce(lambda x, p: F.replace(x, F.lit(f" {p[0]} "), F.lit(f" {p[1]} ")), pairs, padded))


def name_clean(c: Column) -> Column:
    spelled = F.regexp_replace(F.replace(plain_upper(c), F.lit("&"), F.lit(" AND ")), "['’]", "")
    words = whole_words(F.trim(F.regexp_replace(spelled, "[^A-Z0-9]+", " ")), LEGAL_FORMS)
    return F.nullif(F.regexp_replace(words, rf"\A({'|'.join(LEADING)}) ", ""), F.lit(""))


def name_core(cleaned: Column) -> Column:
    """Of a cleaned name, without up to two legal forms at its end; a name of one word stays."""
    ending = rf" ({'|'.join(TRAILING)})\z"
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(cleaned, ending, ""), ending, ""), F.lit("")), cleaned)


def place_clean(c: Column) -> Column:
    return F.nullif(squeezed(plain_upper(c)), F.lit(""))


def address_clean(c: Column) -> Column:
    return F.nullif(whole_words(place_clean(F.regexp_replace(plain_upper(c), "[^A-Z0-9/ -]", " ")), STREET_TYPES), F.lit(""))


def phone_is_overseas(c: Column) -> Column:
    return F.coalesce(F.startswith(F.trim(c), F.lit("+")) & ~matches(F.trim(c), r"\+[^0-9]*64.*"), F.lit(False))


def phone_clean(c: Column) -> Column:
    """The first number, in local form with a leading 0; null if overseas or not of 8 to 11 digits."""
    first = F.regexp_replace(F.lower(c), r"(?s)(,| or |&|ext| ex | x ).*\z", "")
    first = F.regexp_replace(first, r"(?s)\A(([^0-9/]*[0-9]){7}[^/]*)/.*\z", "$1")
    local = F.regexp_replace(F.regexp_replace(first, "[^0-9]", ""), r"\A(0064|64)0*", "0")
    return F.when(~phone_is_overseas(c) & matches(local, "0[0-9]{7,10}"), local)


def is_placeholder_email(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c)).isin(*PLACEHOLDER_EMAILS), F.lit(False))


def postcode_clean(c: Column) -> Column:
    return F.when(matches(c, "[0-9]{4}"), c).when(matches(c, "[0-9]{3}"), F.lpad(c, 4, "0"))


def email_domain(email: Column) -> Column:
    return F.nullif(F.split_part(email, F.lit("@"), F.lit(2)), F.lit(""))


def website_host(c: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(F.lower(c), r"\Ahttps?://", ""), r"\Awww[.]", "")
    return F.nullif(F.split_part(bare, F.lit("/"), F.lit(1)), F.lit(""))


def is_generic_host(host: Column) -> Column:
    return host.isin(*GENERIC_HOSTS) | matches(host, r".*[.](facebook|google)[.]com")


def nzbn_clean(c: Column) -> Column:
    bare = F.replace(c, F.lit(" "), F.lit(""))
    return F.when(matches(bare, "94[0-9]{11}"), bare)


SQL_FUNCTIONS = {
    "name_clean": (name_clean, "STRING"),
    "name_core": (name_core, "STRING"),
    "place_clean": (place_clean, "STRING"),
    "address_clean": (address_clean, "STRING"),
    "phone_is_overseas": (phone_is_overseas, "BOOLEAN"),
    "phone_clean": (phone_clean, "STRING"),
    "is_placeholder_email": (is_placeholder_email, "BOOLEAN"),
}


def register(spark: SparkSession) -> None:
    """Temporary SQL functions of the same names, as expressions that Catalyst inlines."""
    probe = spark.createDataFrame([], "s string")
    for name, (function, kind) in SQL_FUNCTIONS.items():
        plan = probe.select(function(F.col("s")).alias("out"))
        body = plan._jdf.queryExecution().analyzed().expressions().head().child().sql()
        body = body.replace("spark_catalog.default.", "")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS {kind} RETURN {body}")

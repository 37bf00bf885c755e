"""One row of three-valued evidence for each candidate pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.fuzzy import best_of_names, jaccard, jaro_winkler, word_set

SIDE = (
    "name_clean", "name_core", "alt_names", "address_line_clean", "postcode", "city", "phone_clean", "email_clean", "is_generic_email_domain",
    "website_domain", "nzbn", "company_no", "charity_reg_no", "charity_parent_reg_no",
)
#: Values that few records may share, and the names of their features.
SHARED = {"email_clean": "email", "phone_clean": "phone", "website_domain": "website", "nzbn": "nzbn", "company_no": "company_no"}
FEATURES = (
    "pair_id", "name_jw", "name_core_jw", "name_core_jw_rev", "alt_name_jw", "address_jw", "name_token_jaccard", "postcode_eq", "city_eq", "phone_eq",
    "email_eq", "website_eq", "nzbn_eq", "company_no_eq", "same_parent_charity", "email_shared_count", "phone_shared_count", "website_shared_count",
    "nzbn_shared_count", "company_no_shared_count", "address_shared_count",
)


def with_sides(pairs: DataFrame, std: DataFrame, columns=SIDE) -> DataFrame:
    """Pairs with l_ and r_ columns of both records; Spark broadcasts the records only under its size threshold."""
    for side, key in (("l", "left_key"), ("r", "right_key")):
        pairs = pairs.join(std.select(F.col("record_key").alias(key), *[F.col(c).alias(f"{side}_{c}") for c in columns]), key)
    return pairs


def alt_name_similarity() -> Column:
    """The best of all names of one side against all of the other; only where a side has other names."""
    others = lambda s: F.coalesce(f"{s}_alt_names", F.array().cast("array<string>"))
    names = lambda s: F.concat(F.array_compact(F.array(f"{s}_name_clean")), others(s))
    some = (F.size(others("l")) > 0) | (F.size(others("r")) > 0)
    return best_of_names(F.when(some, names("l")), F.when(some, names("r")))


def best_jaccard() -> Column:
    """Word Jaccard of the main names, or of one main name and an other name of the other side; never of two other names."""
    main = {s: word_set(F.coalesce(f"{s}_name_core", f"{s}_name_clean")) for s in "lr"}
    others = {s: F.filter(F.transform(F.coalesce(f"{s}_alt_names", F.array().cast("array<string>")), lambda n: word_set(X.name_core(n))), lambda w: w.isNotNull()) for s in "lr"}
    found = F.concat(
        F.array(jaccard(main["l"], main["r"])),
        F.transform(others["r"], lambda w: jaccard(main["l"], w)),
        F.transform(others["l"], lambda w: jaccard(w, main["r"])),
    )
    return F.round(F.array_max(found), 2).cast("decimal(5,2)")


def equal(column: str) -> Column:
    """True, false, or null where a side is missing."""
    return F.col(f"l_{column}") == F.col(f"r_{column}")


def with_counts(std: DataFrame) -> DataFrame:
    """Records with the number of records that have their email address, phone and so on; counted once for each record, not for each pair."""
    values = {f"{name}_n": F.col(c) for c, name in SHARED.items()} | {"address_n": F.concat("address_line_clean", F.lit("|"), "postcode")}
    out = std.select("record_key", *SIDE)
    for name, value in values.items():
        n = out.select(value.alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias(name))
        out = out.join(n, value == F.col("v"), "left").drop("v")
    return out


#: What the evidence shows of each side.
SHOWN = ("name_clean", "name_core", "address_line_clean", "postcode", "city", "phone_clean", "email_clean", "website_domain", "nzbn", "company_no", "charity_parent_reg_no")


def compared(pairs: DataFrame, std: DataFrame) -> DataFrame:
    """The features of each pair, and the values of both sides (l_, r_) that they come from."""
    counted = with_counts(std)
    extra = [c for c in counted.columns if c.endswith("_n")]
    sided = with_sides(pairs.select("pair_id", "left_key", "right_key"), counted, (*SIDE, *extra))
    out = sided.select(
        "*",
        equal("phone_clean").alias("phone_eq"),
        F.when(~(F.col("l_is_generic_email_domain") | F.col("r_is_generic_email_domain")), equal("email_clean")).alias("email_eq"),
        equal("website_domain").alias("website_eq"),
        equal("nzbn").alias("nzbn_eq"),
        equal("company_no").alias("company_no_eq"),
    )
    # Where the values are equal, so are their counts.
    shared = [F.when(F.col(f"{name}_eq"), F.col(f"l_{name}_n")).alias(f"{name}_shared_count") for name in SHARED.values()]
    larger = F.when(F.col("l_address_n").isNotNull() & F.col("r_address_n").isNotNull(), F.greatest("l_address_n", "r_address_n"))
    return out.select(
        "pair_id",
        jaro_winkler(F.col("l_name_clean"), F.col("r_name_clean")).alias("name_jw"),
        jaro_winkler(F.col("l_name_core"), F.col("r_name_core")).alias("name_core_jw"),
        jaro_winkler(F.reverse("l_name_core"), F.reverse("r_name_core")).alias("name_core_jw_rev"),
        jaro_winkler(F.col("l_address_line_clean"), F.col("r_address_line_clean")).alias("address_jw"),
        alt_name_similarity().alias("alt_name_jw"),
        best_jaccard().alias("name_token_jaccard"),
        equal("postcode").alias("postcode_eq"),
        equal("city").alias("city_eq"),
        "phone_eq",
        "email_eq",
        "website_eq",
        "nzbn_eq",
        "company_no_eq",
        (equal("charity_parent_reg_no") & ~equal("charity_reg_no")).alias("same_parent_charity"),
        *shared,
        larger.alias("address_shared_count"),
        *[f"{s}_{c}" for s in "lr" for c in SHOWN],
    )


def match_features(compared_pairs: DataFrame) -> DataFrame:
    return compared_pairs.select(*FEATURES)


def summary(features: DataFrame) -> DataFrame:
    """metric, value; missing shares in percent, from one pass."""
    eq = ("postcode_eq", "city_eq", "phone_eq", "email_eq", "website_eq", "nzbn_eq", "company_no_eq")
    numbers = {
        "feature_rows": F.count("*"),
        "avg_name_core_jw": F.round(F.avg(F.col("name_core_jw").cast("double")), 2),
        **{f"pct_null_{c}": F.round(100 * F.count_if(F.col(c).isNull()) / F.nullif(F.count("*"), F.lit(0)), 2) for c in eq},
        "phone_eq_true": F.count_if("phone_eq"),
        "email_eq_true": F.count_if("email_eq"),
        "nzbn_eq_true": F.count_if("nzbn_eq"),
        "nzbn_eq_false_conflicting_ids": F.count_if(~F.col("nzbn_eq")),
        "email_eq_true_shared_gt_10": F.count_if(F.col("email_eq") & (F.col("email_shared_count") > 10)),
    }
    wide = features.agg(*[v.cast("double").alias(k) for k, v in numbers.items()])
    return wide.unpivot([], list(numbers), "metric", "value").where("value IS NOT NULL")

"""Evidence ledger, score, gates, identifier rules and the review queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..plans.params import Params

CONTACTS = ("PHONE_EQ", "EMAIL_EQ", "WEBSITE_EQ")


def rarity(equal: str | None, count: str, p: Params, never: Column | None = None) -> Column:
    """1 for a value that is not shared or rare, a part for some sharing, else 0."""
    n = F.col(count)
    full = n.isNull() if equal is None else ~F.coalesce(F.col(equal), F.lit(False))
    out = F.when(full, 1.0)
    if never is not None:
        out = out.when(never, 0.0)
    return out.when(n <= p.rare_max, 1.0).when(n <= p.shared_max, p.shared_factor).otherwise(0.0)


def name_similarity(p: Params) -> Column:
    forward = F.coalesce("name_core_jw", "name_jw", F.lit(0))
    back = F.coalesce("name_core_jw_rev", "name_core_jw", "name_jw", F.lit(0))
    best = F.greatest(F.least(forward, back), F.least(F.coalesce("alt_name_jw", F.lit(0)), F.lit(p.alt_name_cap)))
    return F.when(F.coalesce("name_token_jaccard", F.lit(0)) < p.low_jaccard, F.least(best, F.lit(p.low_jaccard_cap))).otherwise(best)


NUMBERS = ("nzbn_eq", "company_no_eq", "same_parent_charity", "name_token_jaccard", "nzbn_shared_count", "company_no_shared_count")


def pair_evidence(sided: DataFrame, p: Params = Params()) -> DataFrame:
    """pair_id, the features that the decision asks for, and evidence: an array with a row for each known feature (feature,
    left_value, right_value, similarity, weight, in_score, contribution). No pair leaves its row, so nothing is shuffled."""
    contact = {c: rarity(f"{c}_eq", f"{c}_shared_count", p) for c in ("phone", "email")}
    contact["website"] = rarity("website_eq", "website_shared_count", p, X.is_generic_host(F.col("l_website_domain")))
    at = rarity(None, "address_shared_count", p)
    hundred = lambda c: F.when(F.col(c), 100).when(~F.col(c), 0)

    def row(feature: str, value, similarity: Column, weight: Column | None) -> Column:
        left, right = (value("l"), value("r")) if callable(value) else (F.col(f"l_{value}"), F.col(f"r_{value}"))
        return F.struct(
            F.lit(feature).alias("feature"),
            left.alias("left_value"),
            right.alias("right_value"),
            similarity.cast("decimal(5,2)").alias("similarity"),
            (F.lit(None) if weight is None else weight).cast("decimal(5,2)").alias("weight"),
            F.lit(weight is not None).alias("in_score"),
        )

    rows = F.array(
        row("NAME_BEST_JW", lambda s: F.coalesce(f"{s}_name_core", f"{s}_name_clean"), name_similarity(p), F.lit(p.weight_name)),
        row("ADDRESS_JW", "address_line_clean", F.col("address_jw"), p.weight_address * at),
        row("POSTCODE_EQ", "postcode", hundred("postcode_eq"), p.weight_postcode * at),
        row("CITY_EQ", "city", hundred("city_eq"), p.weight_city * at),
        row("PHONE_EQ", "phone_clean", hundred("phone_eq"), p.weight_phone * contact["phone"]),
        row("EMAIL_EQ", "email_clean", hundred("email_eq"), p.weight_email * contact["email"]),
        row("WEBSITE_EQ", "website_domain", hundred("website_eq"), p.weight_website * contact["website"]),
        row("NZBN_EQ", "nzbn", hundred("nzbn_eq"), None),
        row("COMPANY_NO_EQ", "company_no", hundred("company_no_eq"), None),
        row("SAME_PARENT_CHARITY", "charity_parent_reg_no", hundred("same_parent_charity"), None),
    )
    known = sided.select("pair_id", *NUMBERS, F.filter(rows, lambda r: r["similarity"].isNotNull()).alias("evidence"))
    known = known.withColumn("whole", total("evidence", lambda r: r["weight"], "decimal(15,2)"))
    share = lambda r: F.when(r["in_score"], F.round(r["weight"] * r["similarity"] / F.nullif(F.col("whole"), F.lit(0)), 2)).cast("decimal(6,2)")
    return known.withColumn("evidence", F.transform("evidence", lambda r: r.withField("contribution", share(r)))).drop("whole")


def total(rows: str, value, kind: str) -> Column:
    """Sum of value(row) over those that are in the score."""
    return F.aggregate(F.filter(rows, lambda r: r["in_score"]), F.lit(0).cast(kind), lambda a, r: (a + value(r)).cast(kind))


def evidence(evidence_of_pairs: DataFrame) -> DataFrame:
    """The ledger: pair_id, feature, left_value, right_value, similarity, weight, in_score, contribution."""
    return evidence_of_pairs.select("pair_id", F.explode("evidence").alias("e")).select("pair_id", "e.*")


def pair_scores(evidence_of_pairs: DataFrame, p: Params = Params()) -> DataFrame:
    """The decision of each pair, with what led to it. top_reasons: up to three features by contribution, behind the deciding rule."""
    full = lambda r: r["similarity"] == 100
    contact = lambda r: r["feature"].isin(*CONTACTS) & full(r)
    second = lambda r: ((r["feature"] == "ADDRESS_JW") & (r["similarity"] >= p.second_address) | (r["feature"] == "POSTCODE_EQ") & full(r) | contact(r)) & (r["weight"] > 0)
    some = lambda f: F.exists("evidence", lambda r: F.coalesce(f(r), F.lit(False)))
    worth = F.transform(F.filter("evidence", lambda r: r["contribution"] > 0), lambda r: F.struct((-r["contribution"]).alias("c"), r["feature"].alias("f")))
    j = evidence_of_pairs.select(
        "pair_id",
        *NUMBERS,
        F.round(total("evidence", lambda r: r["weight"] * r["similarity"], "decimal(21,4)") / F.nullif(total("evidence", lambda r: r["weight"], "decimal(15,2)"), F.lit(0)), 2).cast("decimal(5,2)").alias("fuzzy_score"),
        F.get(F.filter("evidence", lambda r: r["feature"] == "NAME_BEST_JW"), F.lit(0))["similarity"].alias("name_score"),
        some(second).alias("has_second_evidence"),
        some(lambda r: contact(r) & (r["weight"] == 0)).alias("has_shared_contact"),
        F.transform(F.slice(F.sort_array(worth), 1, 3), lambda x: x["f"]).alias("reasons"),
    )
    similar = F.coalesce("name_token_jaccard", F.lit(0)) >= p.auto_jaccard
    by_company = F.col("company_no_eq") & F.col("nzbn_eq").isNull()
    same_id = F.col("nzbn_eq") | by_company
    holders = F.when(F.col("nzbn_eq"), F.col("nzbn_shared_count")).when(by_company, F.col("company_no_shared_count"))
    few = F.coalesce(holders <= p.id_shared_max, F.lit(False))
    gates = (F.col("fuzzy_score") >= p.auto_score) & (F.col("name_score") >= p.auto_name) & F.col("has_second_evidence") & similar
    path = (
        F.when(same_id & (~similar | ~few), "ID_MATCH_NAME_DIFFERS")
        .when(same_id, "ID_MATCH")
        .when(~F.col("nzbn_eq") & (F.col("name_score") >= p.id_conflict_review_name), "ID_CONFLICT_REVIEW")
        .when(~F.col("nzbn_eq"), "ID_CONFLICT")
        .when(F.col("same_parent_charity"), "RELATED_GROUP_MEMBER")
        .otherwise("FUZZY")
    )
    j = j.withColumns({"fuzzy_decision": F.when(gates, "AUTO_MATCH").when(F.col("fuzzy_score") >= p.review_score, "REVIEW").otherwise("NO_MATCH"), "decision_path": path})
    capped = F.col("decision_path").isin("ID_CONFLICT", "RELATED_GROUP_MEMBER")
    looked_at = F.col("decision_path").isin("ID_MATCH_NAME_DIFFERS", "ID_CONFLICT_REVIEW")
    is_id = F.col("decision_path") == "ID_MATCH"
    return j.select(
        "pair_id",
        F.when(is_id, F.lit(100)).when(capped, F.least("fuzzy_score", F.lit(p.id_conflict_cap))).otherwise(F.col("fuzzy_score")).cast("decimal(5,2)").alias("score"),
        F.when(is_id, "AUTO_MATCH").when(looked_at, "REVIEW").when(capped, "NO_MATCH").otherwise(F.col("fuzzy_decision")).alias("decision"),
        F.when(F.col("decision_path") == "FUZZY", F.col("reasons")).otherwise(F.array_prepend("reasons", F.col("decision_path"))).alias("top_reasons"),
        "fuzzy_score",
        "fuzzy_decision",
        "decision_path",
        "name_score",
        "has_second_evidence",
        (F.col("has_shared_contact") & ~F.col("has_second_evidence")).alias("has_shared_contact_only"),
    )


def match_decisions(scores: DataFrame) -> DataFrame:
    return scores.select("pair_id", "score", "decision", "top_reasons", "fuzzy_score", "fuzzy_decision", "decision_path")


def unreviewed() -> list:
    """Columns of a review, empty at first."""
    return [F.lit(None).cast(kind).alias(name) for name, kind in (("reviewer", "string"), ("review_decision", "string"), ("reviewed_at", "timestamp_ntz"))]


def with_reviews(queue: DataFrame, reviews: DataFrame) -> DataFrame:
    """The queue with the stored reviews (exception_id, reviewer, review_decision, reviewed_at) of its items, which are closed."""
    known = reviews.select("exception_id", "reviewer", "review_decision", "reviewed_at")
    out = queue.drop("reviewer", "review_decision", "reviewed_at").join(known, "exception_id", "left")
    return out.withColumn("status", F.when(F.col("review_decision").isNotNull(), "CLOSED").otherwise(F.col("status"))).select(*queue.columns)


def pair_queue(scores: DataFrame, p: Params = Params()) -> DataFrame:
    """exception_id, pair_id, record_key, reason_code, score, status and the columns of a review, of what people should look at; the id follows from the content."""
    review = F.col("decision") == "REVIEW"
    contact = (F.col("decision_path") == "FUZZY") & (F.col("decision") == "NO_MATCH") & (F.col("name_score") >= p.shared_contact_name) & F.col("has_shared_contact_only")
    code = (
        F.when(review & (F.col("decision_path") == "ID_CONFLICT_REVIEW"), "ID_CONFLICT_HIGH_NAME")
        .when(review & (F.col("decision_path") == "ID_MATCH_NAME_DIFFERS"), "SHARED_LEGAL_ENTITY")
        .when(review, "BORDERLINE_SCORE")
        .otherwise("SHARED_CONTACT_ONLY")
    )
    out = scores.where(review | contact).select("pair_id", F.lit(None).cast("string").alias("record_key"), code.alias("reason_code"), "score", F.lit("OPEN").alias("status"), *unreviewed())
    return out.select(F.sha2(F.concat_ws("|", "pair_id", "reason_code"), 256).alias("exception_id"), "*")


def summary(decisions: DataFrame, queue: DataFrame) -> DataFrame:
    """metric, value: counts by decision and reason, zero where there are none."""
    spark = decisions.sparkSession
    known = [("decision", d) for d in ("AUTO_MATCH", "REVIEW", "NO_MATCH")] + [("reason", r) for r in ("ID_CONFLICT_HIGH_NAME", "SHARED_LEGAL_ENTITY", "BORDERLINE_SCORE", "SHARED_CONTACT_ONLY")]
    names = spark.createDataFrame(known, "kind string, name string")
    found = decisions.select(F.lit("decision").alias("kind"), F.col("decision").alias("name")).union(queue.select(F.lit("reason"), "reason_code"))
    found = found.groupBy("kind", "name").agg(F.count("*").alias("n"))
    return names.join(found, ["kind", "name"], "left").select(F.concat_ws("_", "kind", "name").alias("metric"), F.coalesce("n", F.lit(0)).alias("value"))


def lowest_auto(decisions: DataFrame, n: int = 5) -> DataFrame:
    return decisions.where("decision = 'AUTO_MATCH'").orderBy("score", "pair_id").limit(n)


def sample(decisions: DataFrame, decision: str, n: int, seed: int) -> DataFrame:
    """n random pairs of a decision."""
    return decisions.where(F.col("decision") == decision).orderBy(F.rand(seed)).limit(n)

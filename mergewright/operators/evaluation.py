"""Match quality against the answer key of shared business numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.params import Params


def truth_pairs(std: DataFrame, pairs: DataFrame, decisions: DataFrame, p: Params = Params()) -> DataFrame:
    """Pairs of matchable records with one number that few records hold, blocked or not."""
    holders = std.where("nzbn IS NOT NULL").groupBy("nzbn").agg(F.count("*").alias("nzbn_record_count")).where(F.col("nzbn_record_count") <= p.true_id_max)
    known = std.where("is_matchable AND nzbn IS NOT NULL").select("record_key", "nzbn").join(holders, "nzbn")
    left, right = known.withColumnRenamed("record_key", "left_key"), known.select("nzbn", F.col("record_key").alias("right_key"))
    true = left.join(right, "nzbn").where("left_key < right_key")
    found = pairs.select("pair_id", "left_key", "right_key", "only_nzbn_block", "block_types")
    out = true.join(found, ["left_key", "right_key"], "left").join(decisions.select("pair_id", "fuzzy_score", "fuzzy_decision"), "pair_id", "left")
    return out.select(
        "left_key", "right_key", "nzbn", "nzbn_record_count", "pair_id", F.col("pair_id").isNotNull().alias("in_candidates"),
        F.coalesce(~F.col("only_nzbn_block"), F.lit(False)).alias("found_without_nzbn"), "block_types", "fuzzy_score", "fuzzy_decision",
    )


def evaluable_pairs(std: DataFrame, pairs: DataFrame, decisions: DataFrame, truth: DataFrame) -> DataFrame:
    """Candidates found without the number whose sides both have one; pairs with a widely held number are left out."""
    number = std.where("nzbn IS NOT NULL").select("record_key", "nzbn")
    out = pairs.where("NOT only_nzbn_block").select("pair_id", "left_key", "right_key")
    out = out.join(number.select(F.col("record_key").alias("left_key"), F.col("nzbn").alias("ln")), "left_key").join(number.select(F.col("record_key").alias("right_key"), F.col("nzbn").alias("rn")), "right_key")
    out = out.join(truth.select("left_key", "right_key", F.lit(True).alias("t")), ["left_key", "right_key"], "left").where("t OR ln <> rn")
    return out.join(decisions.select("pair_id", "fuzzy_score", "fuzzy_decision"), "pair_id").select("pair_id", "left_key", "right_key", F.coalesce("t", F.lit(False)).alias("is_true"), "fuzzy_score", "fuzzy_decision")


def confusion(evaluable: DataFrame, p: Params = Params()) -> DataFrame:
    """metric_group, suffix, tp, fp for both modes and all thresholds, zero where nothing is predicted. One pass over the pairs."""
    auto, review = F.col("fuzzy_decision") == "AUTO_MATCH", F.col("fuzzy_decision") == "REVIEW"
    modes = [("strict", "", auto), ("lenient", "", auto | review), *(("sweep", f"_t{t}", F.col("fuzzy_score") >= t) for t in p.thresholds)]
    true = F.col("is_true")
    wide = evaluable.agg(*[F.struct(F.count_if(c & true).alias("tp"), F.count_if(c & ~true).alias("fp")).alias(f"c{i}") for i, (_, _, c) in enumerate(modes)])
    rows = F.array(*[F.struct(F.lit(g).alias("metric_group"), F.lit(s).alias("suffix"), F.col(f"c{i}.tp").alias("tp"), F.col(f"c{i}.fp").alias("fp")) for i, (g, s, _) in enumerate(modes)])
    return wide.select(F.explode(rows).alias("r")).select("r.*")


def precision_recall(counts: DataFrame, truth: DataFrame) -> DataFrame:
    """tp, fp, fn, precision, recall, f1; recall is over all true pairs."""
    out = counts.crossJoin(truth.agg(F.count("*").alias("n_true")))
    ratio = lambda a, b: a / F.nullif(b, F.lit(0))
    out = out.select("metric_group", "suffix", "tp", "fp", (F.col("n_true") - F.col("tp")).alias("fn"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), ratio(F.col("tp"), F.col("n_true")).alias("recall"))
    both = F.col("precision") + F.col("recall")
    return out.withColumn("f1", 2 * F.col("precision") * F.col("recall") / F.when(both != 0, both))


def evaluation(evaluable: DataFrame, features: DataFrame, decisions: DataFrame, truth: DataFrame, p: Params = Params()) -> DataFrame:
    """metric_group, metric, value: truth, blocking, strict, lenient, sweep and production."""
    rates = precision_recall(confusion(evaluable, p), truth)
    kinds = ("tp", "fp", "fn", "precision", "recall", "f1")
    values = F.array(*[F.struct(F.concat(F.lit(k), "suffix").alias("metric"), F.col(k).cast("decimal(18,4)").alias("value")) for k in kinds])
    long = rates.select("metric_group", F.explode(values).alias("v")).select("metric_group", "v.*")
    long = long.where("metric_group <> 'sweep' OR NOT (metric LIKE 'tp%' OR metric LIKE 'fp%' OR metric LIKE 'fn%')")

    def rows(df: DataFrame, group: str, **numbers) -> DataFrame:
        wide = df.agg(*[v.cast("decimal(18,4)").alias(k) for k, v in numbers.items()])
        return wide.select(F.explode(F.array(*[F.struct(F.lit(group).alias("metric_group"), F.lit(k).alias("metric"), F.col(k).alias("value")) for k in numbers])).alias("v")).select("v.*")

    n = F.nullif(F.count("*"), F.lit(0))
    auto = decisions.where("decision = 'AUTO_MATCH'").join(features.select("pair_id", "nzbn_eq"), "pair_id")
    return (
        rows(truth, "truth", total_true_pairs=F.count("*"))
        .union(rows(evaluable, "truth", evaluable_candidate_pairs=F.count("*")))
        .union(rows(truth, "blocking", blocking_recall_all=F.count_if("in_candidates") / n, blocking_recall_without_nzbn=F.count_if("found_without_nzbn") / n))
        .union(long)
        .union(rows(auto, "production", prod_auto_nzbn_conflict=F.count_if(~F.col("nzbn_eq")), prod_auto_nzbn_equal=F.count_if("nzbn_eq")))
    )


def numbered(df: DataFrame, order, n: int) -> DataFrame:
    """The first n rows with their rank; the sort is a top-k, and only its n rows are numbered."""
    rows = df.orderBy(*order).limit(n).agg(F.collect_list(F.struct("*")).alias("rows"))
    return rows.select(F.posexplode("rows")).select((F.col("pos") + 1).alias("example_rank"), "col.*")


def error_examples(std: DataFrame, pairs: DataFrame, decisions: DataFrame, truth: DataFrame, n: int = 10) -> DataFrame:
    """The highest-scored false positives and lowest-scored false negatives."""
    name = std.select("record_key", "name_raw", "nzbn")
    sided = pairs.select("pair_id", "left_key", "right_key", "block_types")
    for s in ("left", "right"):
        sided = sided.join(name.select(F.col("record_key").alias(f"{s}_key"), F.col("name_raw").alias(f"{s}_name"), F.col("nzbn").alias(f"{s}_nzbn")), f"{s}_key")
    all_ = sided.join(decisions.select("pair_id", "fuzzy_score", "fuzzy_decision", "top_reasons"), "pair_id")
    wrong = all_.where("left_nzbn <> right_nzbn AND fuzzy_decision IN ('AUTO_MATCH', 'REVIEW')")
    missed = all_.join(truth.where("fuzzy_decision = 'NO_MATCH'").select("pair_id"), "pair_id", "left_semi")
    columns = ("example_type", "example_rank", "pair_id", "left_key", "left_name", "right_key", "right_name", "fuzzy_score", "fuzzy_decision", "top_reasons", "block_types")
    a = numbered(wrong, [F.desc("fuzzy_score"), F.asc("pair_id")], n).withColumn("example_type", F.lit("FALSE_POSITIVE"))
    b = numbered(missed, [F.asc_nulls_last("fuzzy_score"), F.asc("pair_id")], n).withColumn("example_type", F.lit("FALSE_NEGATIVE"))
    return a.select(*columns).unionByName(b.select(*columns))

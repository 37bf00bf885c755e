"""Queries by name over a data set, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import text as X
from ..functions.fuzzy import jaccard, jaro_winkler, word_set
from ..operators import blocking, clusters, evaluation, explorer, features, masters, profile, scoring, standardise
from ..scratch import fresh_path
from ..sources import registers
from . import oracle as O
from . import schemas
from .pipeline import Resolution, run
from .registers import raw_registers

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def flat(df: DataFrame) -> DataFrame:
    """Arrays and dates as text and decimals as doubles, so that results compare across engines."""

    def one(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            return F.array_join(c, ",").alias(f.name)
        if isinstance(f.dataType, T.DateType):
            return c.cast("string").alias(f.name)
        return c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c

    return df.select(*[one(f) for f in df.schema])


def query(sql: str | None):
    """Register a query under its function's name, with its twin."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


_RESOLUTIONS: dict[tuple, Resolution] = {}


def version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Modification time and length of a file, or those of the newest and of all in a folder."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = list(fs.listStatus(p))
    return max((x.getModificationTime() for x in found), default=0), sum(x.getLen() for x in found)


def resolution(spark: SparkSession, sf_dir: str) -> Resolution:
    """The pipeline over a data set; its stage tables are made once in a session, and again when the files change."""
    key = (spark.sparkContext.applicationId, sf_dir, *(version(spark, f"{sf_dir}/{t}.parquet") for t in ("customer", "supplier")))
    if key not in _RESOLUTIONS:
        _RESOLUTIONS[key] = Resolution(*raw_registers(spark, sf_dir))
    return _RESOLUTIONS[key]


def resolved(sql: str | None):
    """Register a query of the pipeline's tables: f(Resolution)."""

    def add(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return flat(f(resolution(spark, sf_dir)))

        QUERIES[f.__name__] = run
        if sql is not None:
            ORACLES[f.__name__] = O.query(sql)
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lists(columns: str) -> str:
    """Columns of a twin, those marked with [] as text."""

    return ", ".join("registered_date::VARCHAR AS registered_date" if c == "registered_date" else f"array_to_string({c[:-2]}, ',') AS {c[:-2]}" if c.endswith("[]") else c for c in columns.split())


# ---------------------------------------------------------------- sources: register exports written as CSV and read back


def exported(df: DataFrame) -> str:
    """The path of a CSV export of df in the scratch folder."""
    path = fresh_path(df.sparkSession, "export")
    registers.convert(df.sparkSession, df, path)
    return path


def blanks(columns) -> str:
    return ", ".join(f"{O.blank(c)} AS {c}" for c in columns)


def without_blanks(df: DataFrame, columns) -> DataFrame:
    return df.select(*[X.blank_to_null(F.col(c)).alias(c) for c in columns])


@query(O.query(f"SELECT {blanks(registers.CHARITIES)} FROM raw_charities"))
def csv_charities(spark, sf_dir):
    return without_blanks(registers.read_charities(spark, exported(raw_registers(spark, sf_dir)[0])), registers.CHARITIES)


@query(O.query(f"SELECT {blanks(registers.COMPANIES)} FROM raw_companies WHERE trim(nzbn) <> ''"))
def csv_companies(spark, sf_dir):
    """One file for each export, stacked."""
    raw = raw_registers(spark, sf_dir)[1].select(*registers.COMPANIES)
    exports = [registers.read_companies(spark, exported(raw.where(F.col("export_file") == x))) for x in ("a.xls", "b.xls")]
    return without_blanks(registers.stack_exports(*exports), registers.COMPANIES)


@query("SELECT s_name AS organisation_name, CASE WHEN s_suppkey % 7 = 0 THEN 'Yes, \"ceased\"' END AS ceased_as_donee FROM supplier")
def csv_donees(spark, sf_dir):
    raw = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("organisation_name"), F.when(F.col("s_suppkey") % 7 == 0, 'Yes, "ceased"').alias("ceased_as_donee"))
    return without_blanks(registers.read_donees(spark, exported(raw)), registers.DONEES)


@query(O.query("SELECT 'charities' AS source, count(*) AS n, 1 AS files FROM raw_charities UNION ALL SELECT 'companies', count(*), 1 FROM raw_companies"))
def csv_load_check(spark, sf_dir):
    """Rows of each load, and that all have a source file and one load time."""
    found = []
    for name, raw, read in zip(("charities", "companies"), raw_registers(spark, sf_dir), (registers.read_charities, registers.read_companies), strict=True):
        loaded = read(spark, exported(raw.coalesce(1)))
        found.append(loaded.where("_loaded_at IS NOT NULL").agg(F.lit(name).alias("source"), F.count("*").alias("n"), F.count_distinct("_source_file").cast("int").alias("files")))
    return found[0].union(found[1])


# ---------------------------------------------------------------- the batch run: tables, history and log


@query(O.query("""SELECT 'load' AS step, (SELECT count(*) FROM raw_charities) AS rows_out, 'SUCCESS' AS status UNION ALL SELECT 'standardise', (SELECT count(*) FROM std), 'SUCCESS' UNION ALL SELECT 'block', (SELECT count(*) FROM block_key), 'SUCCESS'
  UNION ALL SELECT 'features', (SELECT count(*) FROM match_feature), 'SUCCESS' UNION ALL SELECT 'decide', (SELECT count(*) FROM decision), 'SUCCESS' UNION ALL SELECT 'masters', (SELECT count(*) FROM xref), 'SUCCESS' UNION ALL SELECT 'evaluate', (SELECT count(*) FROM truth), 'SUCCESS'"""))
def run_log(spark, sf_dir):
    """The log of a batch run over both registers, but for the profile."""
    out = fresh_path(spark, "run")
    return run(resolution(spark, sf_dir), out).where("step <> 'profile'").select("step", "rows_out", "status")


@query("SELECT 'evaluation_result' AS tbl, 2 AS runs, true AS explained UNION ALL SELECT 'dq_profile', 2, true UNION ALL SELECT 'pipeline_run', 2, true")
def run_history(spark, sf_dir):
    """Two runs into one folder: the tables that keep their history have both."""
    out = fresh_path(spark, "run")
    r = resolution(spark, sf_dir)
    run(r, out)
    run(r, out)
    told = {"evaluation_result": "note", "dq_profile": "why_it_matters", "pipeline_run": "notes"}
    parts = [spark.read.parquet(f"{out}/{t}").agg(F.lit(t).alias("tbl"), F.count_distinct("run_id").cast("int").alias("runs"), F.bool_and(F.col(c).isNotNull()).alias("explained")) for t, c in told.items()]
    return parts[0].union(parts[1]).union(parts[2])


@query("SELECT * FROM (VALUES " + ", ".join(f"('{t}', {len(schemas.names(t))})" for t, d in schemas.TABLES.items()) + ") AS t(tbl, columns)")
def declared_tables(spark, sf_dir):
    """Contract tables that aren't there yet, made empty, with their columns."""
    out = fresh_path(spark, "declared")
    schemas.create_missing(spark, out)
    return spark.createDataFrame([(t, len(spark.read.parquet(f"{out}/{t}").columns)) for t in schemas.TABLES], "tbl string, columns int")


# ---------------------------------------------------------------- entity resolution

STD = "record_key source_system source_record_id name_raw name_clean name_core alt_names[] charity_reg_no charity_parent_reg_no nzbn company_no address_line_clean suburb city postcode phone_clean email_clean email_domain is_generic_email_domain website_domain entity_status registered_date is_matchable dq_flags[]"


@resolved(f"SELECT {lists(STD)} FROM std")
def org_std(r):
    return r.std


@resolved("""SELECT source_system, count(*) AS rows_out, count(*) FILTER (WHERE NOT is_matchable) AS not_matchable, round(100 * count(nzbn) / count(*), 1) AS pct_nzbn, round(100 * count(postcode) / count(*), 1) AS pct_postcode,
  round(100 * count(phone_clean) / count(*), 1) AS pct_phone, round(100 * count(email_clean) / count(*), 1) AS pct_email FROM std GROUP BY 1""")
def std_summary(r):
    return standardise.summary(r.std)


@resolved("SELECT record_key, block_type, block_value FROM block_key")
def block_keys(r):
    return r.block_keys


@resolved("SELECT block_type, block_value, record_count FROM block_skipped")
def block_skipped(r):
    return r.block_skipped


@resolved(f"SELECT {lists('pair_id left_key right_key left_source right_source pair_type block_types[] block_count only_nzbn_block')} FROM pairs")
def candidate_pairs(r):
    return r.pairs


@resolved("""SELECT 'total_pairs' AS metric, count(*) AS value FROM pairs UNION ALL SELECT 'pairs_' || t, count(pair_id) FROM (SELECT unnest(['CHR-CHR', 'CHR-COS', 'COS-COS']) AS t) LEFT JOIN pairs ON pair_type = t GROUP BY t
  UNION ALL SELECT 'pairs_block_' || b, count(*) FROM (SELECT unnest(block_types) AS b FROM pairs) GROUP BY b UNION ALL SELECT 'only_nzbn_block_pairs', count(*) FROM pairs WHERE only_nzbn_block UNION ALL SELECT 'blocks_skipped', count(*) FROM block_skipped
  UNION ALL SELECT 'largest_kept_block_size', coalesce(max(n), 0) FROM (SELECT count(*) AS n FROM kept GROUP BY block_type, block_value)""")
def blocking_summary(r):
    return blocking.summary(r.pairs, r.block_keys, r.block_skipped)


FEATURES = "pair_id name_jw::DOUBLE AS name_jw name_core_jw::DOUBLE AS name_core_jw name_core_jw_rev::DOUBLE AS name_core_jw_rev alt_name_jw::DOUBLE AS alt_name_jw address_jw::DOUBLE AS address_jw name_token_jaccard::DOUBLE AS name_token_jaccard"
FEATURES = FEATURES.replace(" name", ", name").replace("AS, name", "AS name").replace(" alt_name_jw::", ", alt_name_jw::").replace(" address_jw::", ", address_jw::")


@resolved(f"SELECT {FEATURES}, {', '.join(c for c in features.FEATURES if c not in ('pair_id', 'name_jw', 'name_core_jw', 'name_core_jw_rev', 'alt_name_jw', 'address_jw', 'name_token_jaccard'))} FROM match_feature")
def match_features(r):
    return r.features


EQ = ("postcode_eq", "city_eq", "phone_eq", "email_eq", "website_eq", "nzbn_eq", "company_no_eq")


@resolved(
    "SELECT 'feature_rows' AS metric, count(*)::DOUBLE AS value FROM match_feature UNION ALL SELECT 'avg_name_core_jw', round(avg(name_core_jw::DOUBLE), 2) FROM match_feature "
    + " ".join(f"UNION ALL SELECT 'pct_null_{c}', round(100 * count(*) FILTER (WHERE {c} IS NULL) / count(*), 2) FROM match_feature" for c in EQ)
    + " UNION ALL SELECT 'phone_eq_true', count(*) FILTER (WHERE phone_eq) FROM match_feature UNION ALL SELECT 'email_eq_true', count(*) FILTER (WHERE email_eq) FROM match_feature UNION ALL SELECT 'nzbn_eq_true', count(*) FILTER (WHERE nzbn_eq) FROM match_feature"
    + " UNION ALL SELECT 'nzbn_eq_false_conflicting_ids', count(*) FILTER (WHERE NOT nzbn_eq) FROM match_feature UNION ALL SELECT 'email_eq_true_shared_gt_10', count(*) FILTER (WHERE email_eq AND email_shared_count > 10) FROM match_feature"
)
def feature_summary(r):
    return features.summary(r.features)


@resolved("SELECT pair_id, feature, left_value, right_value, similarity::DOUBLE AS similarity, weight::DOUBLE AS weight, in_score, contribution::DOUBLE AS contribution FROM ledger")
def evidence_ledger(r):
    return r.ledger


@resolved(f"SELECT {lists('pair_id decision top_reasons[] fuzzy_decision decision_path')}, score::DOUBLE AS score, fuzzy_score::DOUBLE AS fuzzy_score FROM decision")
def match_decision(r):
    return r.decisions


@resolved("SELECT sha256(coalesce(pair_id, record_key) || '|' || reason_code) AS exception_id, pair_id, record_key, reason_code, score::DOUBLE AS score, status, NULL::VARCHAR AS reviewer, NULL::VARCHAR AS review_decision, NULL::VARCHAR AS reviewed_at FROM queue")
def exception_queue(r):
    return r.queue.withColumn("reviewed_at", F.col("reviewed_at").cast("string"))


_LOW = "pair_id IN (SELECT pair_id FROM decision WHERE score < 80)"


@resolved(f"""SELECT reason_code, CASE WHEN {_LOW} THEN 'CLOSED' ELSE status END AS status, CASE WHEN {_LOW} THEN 'NO_MATCH' END AS review_decision, count(*) AS items FROM queue GROUP BY ALL""")
def reviewed_queue(r):
    """Stored reviews carried over to a rebuilt queue: here all of pairs that score under 80."""
    low = r.queue.join(r.decisions.where("score < 80").select("pair_id"), "pair_id", "left_semi")
    reviews = low.select("exception_id", F.lit("someone").alias("reviewer"), F.lit("NO_MATCH").alias("review_decision"), F.localtimestamp().alias("reviewed_at"))
    return scoring.with_reviews(r.queue, reviews).groupBy("reason_code", "status", "review_decision").agg(F.count("*").alias("items"))


@resolved("""SELECT 'decision_' || d AS metric, count(decision) AS value FROM (SELECT unnest(['AUTO_MATCH', 'REVIEW', 'NO_MATCH']) AS d) LEFT JOIN decision ON decision = d GROUP BY d
  UNION ALL SELECT 'reason_' || d, count(reason_code) FROM (SELECT unnest(['ID_CONFLICT_HIGH_NAME', 'SHARED_LEGAL_ENTITY', 'BORDERLINE_SCORE', 'SHARED_CONTACT_ONLY']) AS d) LEFT JOIN pq ON reason_code = d GROUP BY d""")
def decision_summary(r):
    return scoring.summary(r.decisions, r.pair_queue)


@resolved("SELECT pair_id, score::DOUBLE AS score, decision_path FROM decision WHERE decision = 'AUTO_MATCH' ORDER BY score, pair_id LIMIT 5")
def lowest_auto_matches(r):
    return scoring.lowest_auto(r.decisions).select("pair_id", "score", "decision_path")


@resolved("SELECT decision, least(count(*), 5) AS pairs, true AS known FROM decision GROUP BY 1")
def sampled_decisions(r):
    """Random samples of each decision: how many, and that they are pairs with that decision."""
    some = scoring.sample(r.decisions, "AUTO_MATCH", 5, 1).union(scoring.sample(r.decisions, "REVIEW", 5, 1)).union(scoring.sample(r.decisions, "NO_MATCH", 5, 1))
    true = r.decisions.select("pair_id", "decision", F.lit(True).alias("true"))
    found = some.select("pair_id", "decision").distinct().join(true, ["pair_id", "decision"], "left")
    return found.groupBy("decision").agg(F.count("*").alias("pairs"), F.bool_and(F.coalesce("true", F.lit(False))).alias("known"))


@resolved("SELECT pair_id, a AS from_key, b AS to_key, score::DOUBLE AS score, decision_path FROM edge")
def cluster_edges(r):
    return clusters.edges(r.pairs, r.decisions)


@resolved("SELECT record_key, cluster_id FROM label")
def components(r):
    return r.clusters.labels


@resolved(f"SELECT {lists('master_id cluster_id record_key source_system source_record_id link_type link_rules[]')}, link_confidence::DOUBLE AS link_confidence FROM xref")
def entity_xref(r):
    return r.xref


MASTER = "master_id master_name name_source_key nzbn nzbn_conflict address_line suburb city postcode phone email website charity_reg_nos[] source_systems[] member_count has_open_review is_large_cluster status_summary"


@resolved(f"SELECT {lists(MASTER).replace('array_to_string(charity_reg_nos, ', 'array_to_string(coalesce(charity_reg_nos, []), ')}, min_link_confidence::DOUBLE AS min_link_confidence FROM master")
def master_record(r):
    return r.masters


@resolved("""SELECT master_id, master_name, record_key, x.source_system, x.source_record_id, s.name_raw, coalesce(c.name, k.business_name) AS raw_name, NULL::VARCHAR AS raw_source_file, NULL::VARCHAR AS raw_loaded_at, k.export_file AS cos_export_file, link_type, link_confidence::DOUBLE AS link_confidence, array_to_string(link_rules, ',') AS link_rules
  FROM xref x JOIN master USING (master_id) JOIN std s USING (record_key) LEFT JOIN raw_charities c ON x.source_system = 'CHARITIES_REGISTER' AND trim(c.organisationid) = x.source_record_id LEFT JOIN k0 k ON x.source_system = 'COMPANIES_OFFICE' AND trim(k.nzbn) = x.source_record_id""")
def entity_lineage(r):
    return r.lineage.withColumn("raw_loaded_at", F.col("raw_loaded_at").cast("string"))


@resolved("""SELECT 'staging_records' AS metric, sum(member_count)::DOUBLE AS value FROM master UNION ALL SELECT 'master_entities', count(*) FROM master UNION ALL SELECT 'singletons', count(*) FROM master WHERE member_count = 1 UNION ALL SELECT 'multi_record_masters', count(*) FROM master WHERE member_count > 1
  UNION ALL SELECT 'records_merged_away', sum(member_count - 1) FROM master UNION ALL SELECT 'largest_cluster_size', max(member_count) FROM master UNION ALL SELECT 'masters_nzbn_conflict', count(*) FROM master WHERE nzbn_conflict
  UNION ALL SELECT 'chain_nzbn_conflict_queued', count(*) FROM queue WHERE reason_code = 'CHAIN_NZBN_CONFLICT' UNION ALL SELECT 'masters_has_open_review', count(*) FROM master WHERE has_open_review UNION ALL SELECT 'large_clusters', count(*) FROM master WHERE is_large_cluster
  UNION ALL SELECT 'cross_source_masters', count(*) FROM master WHERE len(source_systems) = 2 UNION ALL SELECT m, v FROM (SELECT coalesce(master_name, master_id) || ' (' || member_count || ' records)' AS m, min_link_confidence::DOUBLE AS v FROM master WHERE member_count > 1 ORDER BY member_count DESC, master_id LIMIT 5)""")
def master_summary(r):
    return masters.summary(r.masters, r.xref)


@resolved("SELECT left_key, right_key, nzbn, nzbn_record_count, pair_id, in_candidates, found_without_nzbn, array_to_string(block_types, ',') AS block_types, fuzzy_score::DOUBLE AS fuzzy_score, fuzzy_decision FROM truth")
def truth_pairs(r):
    return r.truth


@resolved("SELECT pair_id, left_key, right_key, is_true, fuzzy_score::DOUBLE AS fuzzy_score, fuzzy_decision FROM evaluable")
def evaluable_pairs(r):
    return r.evaluable


@resolved("SELECT count(*) FILTER (WHERE in_candidates) / nullif(count(*), 0) AS blocking_recall_all, count(*) FILTER (WHERE found_without_nzbn) / nullif(count(*), 0) AS blocking_recall_without_nzbn FROM truth")
def blocking_recall(r):
    n = F.nullif(F.count("*"), F.lit(0))
    return r.truth.agg((F.count_if("in_candidates") / n).alias("blocking_recall_all"), (F.count_if("found_without_nzbn") / n).alias("blocking_recall_without_nzbn"))


@resolved("SELECT metric_group, suffix, tp, fp, fn, round(precision, 4) AS precision, round(recall, 4) AS recall, round(2 * precision * recall / nullif(precision + recall, 0), 4) AS f1 FROM rates")
def threshold_sweep(r):
    out = evaluation.precision_recall(evaluation.confusion(r.evaluable), r.truth)
    return out.select("metric_group", "suffix", "tp", "fp", "fn", *[F.round(c, 4).alias(c) for c in ("precision", "recall", "f1")])


_RATES = "rates WHERE metric_group %s 'sweep'"


@resolved(
    "SELECT 'truth' AS metric_group, 'total_true_pairs' AS metric, count(*)::DOUBLE AS value FROM truth UNION ALL SELECT 'truth', 'evaluable_candidate_pairs', count(*) FROM evaluable"
    " UNION ALL SELECT 'blocking', 'blocking_recall_all', round(count(*) FILTER (WHERE in_candidates) / nullif(count(*), 0), 4) FROM truth UNION ALL SELECT 'blocking', 'blocking_recall_without_nzbn', round(count(*) FILTER (WHERE found_without_nzbn) / nullif(count(*), 0), 4) FROM truth"
    + "".join(f" UNION ALL SELECT metric_group, '{k}', {k} FROM {_RATES % '<>'}" for k in ("tp", "fp", "fn"))
    + "".join(f" UNION ALL SELECT metric_group, '{k}' || suffix, round({v}, 4) FROM rates" for k, v in (("precision", "precision"), ("recall", "recall"), ("f1", "2 * precision * recall / nullif(precision + recall, 0)")))
    + " UNION ALL SELECT 'production', 'prod_auto_nzbn_conflict', count(*) FILTER (WHERE NOT nzbn_eq) FROM decision JOIN match_feature USING (pair_id) WHERE decision = 'AUTO_MATCH'"
    + " UNION ALL SELECT 'production', 'prod_auto_nzbn_equal', count(*) FILTER (WHERE nzbn_eq) FROM decision JOIN match_feature USING (pair_id) WHERE decision = 'AUTO_MATCH'"
)
def evaluation_result(r):
    return r.evaluation


@resolved("""SELECT 'FALSE_POSITIVE' AS example_type, row_number() OVER (ORDER BY fuzzy_score DESC, pair_id) AS example_rank, pair_id, left_key, l.name_raw AS left_name, right_key, r.name_raw AS right_name, fuzzy_score::DOUBLE AS fuzzy_score, fuzzy_decision, array_to_string(top_reasons, ',') AS top_reasons, array_to_string(block_types, ',') AS block_types
  FROM decision JOIN pairs USING (pair_id) JOIN std l ON l.record_key = left_key JOIN std r ON r.record_key = right_key WHERE l.nzbn <> r.nzbn AND fuzzy_decision IN ('AUTO_MATCH', 'REVIEW') QUALIFY example_rank <= 10
  UNION ALL SELECT 'FALSE_NEGATIVE', row_number() OVER (ORDER BY d.fuzzy_score, pair_id) AS example_rank, pair_id, p.left_key, l.name_raw, p.right_key, r.name_raw, d.fuzzy_score::DOUBLE, d.fuzzy_decision, array_to_string(top_reasons, ','), array_to_string(p.block_types, ',')
  FROM truth t JOIN decision d USING (pair_id) JOIN pairs p USING (pair_id) JOIN std l ON l.record_key = p.left_key JOIN std r ON r.record_key = p.right_key WHERE t.fuzzy_decision = 'NO_MATCH' QUALIFY example_rank <= 10""")
def error_examples(r):
    return r.examples.withColumn("example_rank", F.col("example_rank").cast("long"))


def _complete(t: str, source: str, fields) -> str:
    return " UNION ALL ".join(f"SELECT '{source}' AS source, 'pct_nonblank_{f}' AS check_name, round(100 * count({O.blank(f)}) / count(*), 2) AS metric_value, '%' AS unit FROM {t}" for f in fields)


@resolved(_complete("raw_charities", profile.CHARITIES, profile.CHARITY_FIELDS) + " UNION ALL " + _complete("raw_companies", profile.COMPANIES, profile.COMPANY_FIELDS))
def completeness_profile(r):
    return profile.completeness(r.raw_charities, profile.CHARITIES, profile.CHARITY_FIELDS).unionByName(profile.completeness(r.raw_companies, profile.COMPANIES, profile.COMPANY_FIELDS))


@resolved(" UNION ALL ".join(f"SELECT '{s}' AS source, '{f}_{m}' AS check_name, ({v})::DOUBLE AS metric_value, 'values' AS unit FROM {t}" for t, s, f, c in (("raw_charities", profile.CHARITIES, "organisationid", O.blank("organisationid")), ("raw_charities", profile.CHARITIES, "charityregistrationnumber", f"upper({O.blank('charityregistrationnumber')})"), ("raw_charities", profile.CHARITIES, "nzbnnumber", O.blank("nzbnnumber")), ("raw_companies", profile.COMPANIES, "nzbn", O.blank("nzbn"))) for m, v in (("nonblank", f"count({c})"), ("distinct", f"count(DISTINCT {c})"), ("duplicate_rows", f"count({c}) - count(DISTINCT {c})"))))
def uniqueness_profile(r):
    k = profile.known
    a = profile.uniqueness(r.raw_charities, profile.CHARITIES, {"organisationid": k("organisationid"), "charityregistrationnumber": F.upper(k("charityregistrationnumber")), "nzbnnumber": k("nzbnnumber")})
    return a.unionByName(profile.uniqueness(r.raw_companies, profile.COMPANIES, {"nzbn": k("nzbn")}))


@resolved(f"""SELECT '{profile.CHARITIES}' AS source, 'nzbn_shared_by_multiple_records' AS check_name, count(*)::DOUBLE AS metric_value, 'values' AS unit FROM (SELECT {O.blank('nzbnnumber')} AS v FROM raw_charities GROUP BY 1 HAVING v IS NOT NULL AND count(*) > 1)
  UNION ALL SELECT '{profile.CHARITIES}', 'records_sharing_exact_name', coalesce(sum(n), 0), 'records' FROM (SELECT upper({O.blank('name')}) AS v, count(*) AS n FROM raw_charities GROUP BY 1 HAVING v IS NOT NULL AND count(*) > 1)
  UNION ALL SELECT '{profile.CHARITIES}', 'blank_name_records', count(*) FILTER (WHERE {O.blank('name')} IS NULL), 'records' FROM raw_charities""")
def duplicate_signals(r):
    return profile.duplicate_signals(r.raw_charities)


_REG, _TEL, _SPC, _PPC = f"upper({O.blank('charityregistrationnumber')})", O.blank("telephone1"), O.blank("streetaddresspostcode"), O.blank("postaladdresspostcode")
_FORMATS = {
    "reg_no_not_CC_digits": f"NOT regexp_full_match({_REG}, 'CC[0-9]+')",
    "reg_no_group_member": f"regexp_full_match({_REG}, 'CC[0-9]+-[0-9]+')",
    "phone_multi_number_or_ext": f"regexp_matches(lower({_TEL}), '/|,| or |ext')",
    "phone_intl_nz_prefix": f"regexp_matches({_TEL}, '^([+]64|0064)')",
    "phone_overseas": O.overseas(_TEL),
    "street_postcode_not_4_digits": f"NOT regexp_full_match({_SPC}, '[0-9]{{4}}')",
    "street_postcode_3_digits": f"regexp_full_match({_SPC}, '[0-9]{{3}}')",
    "postal_postcode_not_4_digits": f"NOT regexp_full_match({_PPC}, '[0-9]{{4}}')",
}


@resolved(" UNION ALL ".join(f"SELECT '{profile.CHARITIES}' AS source, '{k}' AS check_name, count(*) FILTER (WHERE {v})::DOUBLE AS metric_value, 'records' AS unit FROM raw_charities" for k, v in _FORMATS.items()))
def format_issues(r):
    return profile.format_issues(r.raw_charities)


@resolved(f"""SELECT '{profile.COMPANIES}' AS source, 'no_business_name' AS check_name, count(*) FILTER (WHERE {O.blank('business_name')} IS NULL)::DOUBLE AS metric_value, 'rows (raw, incl. overlap)' AS unit FROM raw_companies
  UNION ALL SELECT '{profile.COMPANIES}', 'no_physical_address', count(*) FILTER (WHERE {O.blank('physical_address')} IS NULL), 'rows (raw, incl. overlap)' FROM raw_companies
  UNION ALL SELECT '{profile.COMPANIES}', 'entity_type=' || coalesce({O.blank('entity_type')}, '(blank)'), count(*), 'rows (raw, incl. overlap)' FROM raw_companies GROUP BY 2""")
def company_specifics(r):
    return profile.company_specifics(r.raw_companies)


@resolved("""SELECT 'STAGING.' || source_system AS source, 'dq_flag=' || f AS check_name, count(*)::DOUBLE AS metric_value, 'records' AS unit FROM (SELECT source_system, unnest(dq_flags) AS f FROM std) GROUP BY 1, 2
  UNION ALL SELECT 'STAGING.' || source_system, 'not_matchable', count(*) FILTER (WHERE NOT is_matchable), 'records' FROM std GROUP BY 1
  UNION ALL SELECT 'STAGING.CHARITIES_REGISTER', 'pct_generic_email_domain', round(100 * count(*) FILTER (WHERE is_generic_email_domain) / nullif(count(*), 0), 2), '% of records with email' FROM std WHERE source_system = 'CHARITIES_REGISTER' AND email_clean IS NOT NULL""")
def flag_counts(r):
    return profile.staging_flags(r.std)


@resolved("SELECT email_clean AS source, 'shared_email_record_count' AS check_name, count(*)::DOUBLE AS metric_value, 'records' AS unit FROM std WHERE email_clean IS NOT NULL AND NOT is_generic_email_domain GROUP BY 1 HAVING count(*) > 1 ORDER BY 3 DESC, 1 LIMIT 10")
def top_shared_values(r):
    return profile.shared_emails(r.std)


@resolved(f"""SELECT '{profile.CHARITIES}' AS source, 'row_count' AS check_name, count(*)::DOUBLE AS metric_value, 'rows' AS unit FROM raw_charities UNION ALL SELECT '{profile.COMPANIES}', 'row_count', count(*), 'rows' FROM raw_companies
  UNION ALL SELECT 'STAGING.' || source_system, 'row_count', count(*), 'rows' FROM std GROUP BY 1""")
def row_counts(r):
    return profile.row_counts(r.raw_charities, r.raw_companies, r.std)


@resolved("""SELECT (SELECT count(*) FROM std) AS records, (SELECT count(*) FROM master) AS masters, (SELECT count(*) FROM master WHERE member_count > 1) AS merged,
  (SELECT count(*) FROM (SELECT master_id FROM xref GROUP BY 1 HAVING count(DISTINCT left(record_key, 4)) > 1)) AS both_registers, (SELECT count(*) FROM queue WHERE status = 'OPEN') AS open_reviews""")
def explorer_figures(r):
    return explorer.key_figures(r.std, r.masters, r.xref, r.queue)


@resolved("SELECT master_id, master_name, member_count, nzbn_conflict FROM master WHERE master_name ILIKE '%rugby%' ORDER BY member_count DESC, master_name, master_id LIMIT 50")
def name_search(r):
    return explorer.search(r.masters, "rugby")


_FIRST = "(SELECT master_id FROM master ORDER BY member_count DESC, master_id LIMIT 1)"


def largest(r) -> str:
    """The largest master."""
    return r.masters.orderBy(F.desc("member_count"), "master_id").first().master_id


@resolved(f"SELECT record_key, link_type, link_confidence::DOUBLE AS link_confidence, name_raw, name_clean, nzbn FROM xref JOIN std USING (record_key, source_system, source_record_id) WHERE master_id = {_FIRST}")
def explorer_members(r):
    return explorer.members(r.xref, r.std, largest(r)).select("record_key", "link_type", "link_confidence", "name_raw", "name_clean", "nzbn")


@resolved(f"""SELECT pair_id, left_key, right_key, decision, array_to_string(list_sort(list(feature) FILTER (WHERE in_score AND similarity >= 80)), ',') AS strong_evidence, round(sum(contribution), 2) AS evidence_score,
  CASE max(CASE WHEN feature = 'NZBN_EQ' THEN similarity END) WHEN 100 THEN 'same' WHEN 0 THEN 'different' ELSE 'unknown' END AS identifier FROM pairs JOIN decision USING (pair_id) JOIN ledger USING (pair_id)
  WHERE left_key IN (SELECT record_key FROM xref WHERE master_id = {_FIRST}) AND right_key IN (SELECT record_key FROM xref WHERE master_id = {_FIRST}) GROUP BY 1, 2, 3, 4""")
def explorer_pairs(r):
    return explorer.pair_summary(explorer.pair_evidence(r.pairs, r.decisions, r.ledger, explorer.records_of(r.xref, largest(r))))


@resolved(f"""SELECT reason_code, status, q.record_key, left_key, right_key FROM queue q LEFT JOIN pairs USING (pair_id) WHERE EXISTS (SELECT 1 FROM xref x WHERE master_id = {_FIRST} AND x.record_key IN (q.record_key, left_key, right_key))""")
def explorer_queue(r):
    return explorer.queue_of(r.queue, r.pairs, explorer.records_of(r.xref, largest(r)))


@resolved("SELECT decision, count(*) AS pairs FROM decision GROUP BY 1")
def explorer_decisions(r):
    return explorer.decision_counts(r.decisions)


@resolved("SELECT reason_code, count(*) AS items FROM queue GROUP BY 1")
def explorer_reasons(r):
    return explorer.reason_counts(r.queue)


@resolved("SELECT member_count, count(*) AS masters FROM master GROUP BY 1")
def explorer_sizes(r):
    return explorer.master_sizes(r.masters)


# ---------------------------------------------------------------- cleaning functions and similarity over all documents, parts and pages

@query(f"SELECT doc_id, {O.name_clean('s')} AS name, {O.name_core(O.name_clean('s'))} AS core, {O.place('s')} AS place, {O.address('s')} AS address, {O.phone('s')} AS phone, {O.overseas('s')} AS overseas, {O.placeholder('s')} AS placeholder FROM (SELECT doc_id, text AS s FROM documents)")
def clean_functions(spark, sf_dir):
    """The cleaning rules over whole texts."""
    c = table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("s"))
    s = F.col("s")
    return c.select(
        "doc_id", X.name_clean(s).alias("name"), X.name_core(X.name_clean(s)).alias("core"), X.place_clean(s).alias("place"), X.address_clean(s).alias("address"),
        X.phone_clean(s).alias("phone"), X.phone_is_overseas(s).alias("overseas"), X.is_placeholder_email(s).alias("placeholder"),
    )


@query("SELECT page_id, nullif(split_part(regexp_replace(regexp_replace(lower(url), '^https?://', ''), '^www[.]', ''), '/', 1), '') AS host FROM pages")
def website_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", X.website_host(F.col("url")).alias("host"))


@query(f"""WITH n AS (SELECT DISTINCT p_name AS s FROM part), p AS (SELECT a.s AS a, b.s AS b FROM n a JOIN n b ON a.s < b.s AND left(a.s, 1) = left(b.s, 1))
SELECT a, b, {O.jw('a', 'b')}::DOUBLE AS forward, {O.jw('reverse(a)', 'reverse(b)')}::DOUBLE AS backward, round({O.jaccard("list_distinct(string_split(a, ' '))", "list_distinct(string_split(b, ' '))")}, 4) AS words FROM p""")
def name_similarity(spark, sf_dir):
    """Distinct part names that start alike: blocked pairs, both ways."""
    n = table(spark, sf_dir, "part").select(F.col("p_name").alias("a")).distinct().withColumn("k", F.substring("a", 1, 1))
    p = n.join(n.withColumnRenamed("a", "b"), "k").where("a < b")
    a, b = F.col("a"), F.col("b")
    return flat(p.select("a", "b", jaro_winkler(a, b).alias("forward"), jaro_winkler(F.reverse(a), F.reverse(b)).alias("backward"), F.round(jaccard(word_set(a), word_set(b)), 4).alias("words")))


# ---------------------------------------------------------------- relational operators that the pipeline relies on


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1")
def latest_per_key(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy(F.desc("o_orderdate"), "o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("r", F.row_number().over(w)).where("r = 1").select("o_custkey", "o_orderkey", "o_totalprice")


@query("SELECT l_suppkey, l_orderkey, l_linenumber, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3")
def topk_per_group(spark, sf_dir):
    w = Window.partitionBy("l_suppkey").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber")
    return table(spark, sf_dir, "lineitem").withColumn("r", F.row_number().over(w)).where("r <= 3").select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) = 1")
def majority_vote(spark, sf_dir):
    n = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return n.groupBy("user_id").agg(F.min_by(F.struct("event_type", "n"), F.struct(-F.col("n"), "event_type")).alias("x")).select("user_id", "x.*")


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey), 6) AS share FROM lineitem")
def share_of_group_sum(spark, sf_dir):
    share = F.col("l_extendedprice") / F.sum("l_extendedprice").over(Window.partitionBy("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(share, 6).alias("share"))


@query("SELECT c_custkey, c_mktsegment FROM customer c WHERE EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
def semi_join(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return table(spark, sf_dir, "customer").join(big, "c_custkey", "left_semi").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, c_mktsegment FROM customer c WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_totalprice > 300000)")
def anti_join(spark, sf_dir):
    big = table(spark, sf_dir, "orders").where("o_totalprice > 300000").withColumnRenamed("o_custkey", "c_custkey")
    return table(spark, sf_dir, "customer").join(big, "c_custkey", "left_anti").select("c_custkey", "c_mktsegment")


@query("SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000 AND c_acctbal > 0")
def left_join_condition(spark, sf_dir):
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return c.join(o, (c.c_custkey == o.o_custkey) & (o.o_totalprice > 400000) & (c.c_acctbal > 0), "left").select("c_custkey", "o_orderkey")


@query("SELECT coalesce(a.k, b.k) AS k, customers, suppliers FROM (SELECT c_nationkey AS k, count(*) AS customers FROM customer WHERE c_acctbal > 9500 GROUP BY 1) a FULL JOIN (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1) b ON a.k = b.k")
def full_outer(spark, sf_dir):
    a = table(spark, sf_dir, "customer").where("c_acctbal > 9500").groupBy(F.col("c_nationkey").alias("k")).agg(F.count("*").alias("customers"))
    b = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "full").select("k", "customers", "suppliers")


@query("SELECT t, count(p_partkey) AS n FROM (SELECT unnest([900, 1200, 1500, 1800, 99999]) AS t) LEFT JOIN part ON p_retailprice >= t GROUP BY t")
def theta_left_join(spark, sf_dir):
    """Thresholds against all parts: one pass that counts for each of a fixed list, in place of a nested loop."""
    steps = (900, 1200, 1500, 1800, 99999)
    wide = table(spark, sf_dir, "part").agg(*[F.count_if(F.col("p_retailprice") >= t).alias(f"n{t}") for t in steps])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(t).alias("t"), F.col(f"n{t}").alias("n")) for t in steps])).alias("x")).select("x.*")


@query("SELECT a.s_suppkey, a.s_nationkey, count(b.s_suppkey) AS richer FROM supplier a LEFT JOIN supplier b ON a.s_nationkey = b.s_nationkey AND b.s_acctbal > a.s_acctbal GROUP BY 1, 2")
def theta_left_join_thresholds(spark, sf_dir):
    """Thresholds from a table: an equi-join on the nation, with an inequality."""
    s = table(spark, sf_dir, "supplier")
    b = s.select(F.col("s_nationkey").alias("n"), F.col("s_acctbal").alias("other"), F.col("s_suppkey").alias("b"))
    j = s.join(b, (F.col("s_nationkey") == F.col("n")) & (F.col("other") > F.col("s_acctbal")), "left")
    return j.groupBy("s_suppkey", "s_nationkey").agg(F.count("b").alias("richer"))


@query("SELECT (SELECT count(*) FROM orders) AS orders, (SELECT count(*) FROM customer) AS customers, (SELECT max(o_totalprice) FROM orders) AS dearest")
def cross_scalars(spark, sf_dir):
    o = table(spark, sf_dir, "orders").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("dearest"))
    return o.crossJoin(table(spark, sf_dir, "customer").agg(F.count("*").alias("customers"))).select("orders", "customers", "dearest")


@query("SELECT p_partkey, w FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part)")
def explode_inner(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("w"))


@query("SELECT p_partkey, w FROM part LEFT JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_size > 25) USING (p_partkey)")
def explode_outer(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.explode_outer(F.when(F.col("p_size") > 25, F.split("p_name", " "))).alias("w"))


@query("SELECT s, count(o_orderkey) AS n FROM (SELECT unnest(['F', 'O', 'P', 'X']) AS s) LEFT JOIN orders ON o_orderstatus = s GROUP BY s")
def zero_filled_categories(spark, sf_dir):
    names = spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "s string")
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("s")).agg(F.count("*").alias("n"))
    return names.join(n, "s", "left").select("s", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT l_shipmode_, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers, count(*) AS n, round(avg(l_quantity), 4) AS quantity FROM (SELECT *, l_returnflag AS l_shipmode_ FROM lineitem) GROUP BY 1")
def multi_distinct(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("l_shipmode_")).agg(
        F.count_distinct("l_partkey").alias("parts"), F.count_distinct("l_suppkey").alias("suppliers"), F.count("*").alias("n"), F.round(F.avg("l_quantity"), 4).alias("quantity")
    )


@query("SELECT o_orderpriority, max(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS f, max(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS o, count(*) FILTER (WHERE o_totalprice > 100000) AS big FROM orders GROUP BY 1")
def conditional_agg(spark, sf_dir):
    price = lambda s: F.max(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")))
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(price("F").alias("f"), price("O").alias("o"), F.count_if(F.col("o_totalprice") > 100000).alias("big"))


@query("SELECT user_id, bool_or(event_type = 'purchase') AS bought, bool_or(value > 1e9) AS rich FROM events GROUP BY 1")
def bool_or_agg(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("bought"), F.bool_or(F.col("value") > 1e9).alias("rich"))


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY 1")
def sorted_distinct_array(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))


@query("SELECT o_custkey, (list(o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) FILTER (WHERE o_orderstatus <> 'O'))[1] AS newest FROM orders GROUP BY 1")
def first_non_null_by_date(spark, sf_dir):
    order = F.struct(-F.unix_micros(F.col("o_orderdate").cast("timestamp")), F.col("o_orderkey"))
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min_by("o_orderpriority", F.when(F.col("o_orderstatus") != "O", order)).alias("newest"))


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 10")
def having(spark, sf_dir):
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.count("*").alias("n")).where("n > 10")


@query("SELECT metric, value FROM (SELECT count(p_name)::DOUBLE AS names, max(p_size)::DOUBLE AS size, NULL::DOUBLE AS missing FROM part) UNPIVOT (value FOR metric IN (names, size, missing))")
def unpivot(spark, sf_dir):
    wide = table(spark, sf_dir, "part").agg(F.count("p_name").cast("double").alias("names"), F.max("p_size").cast("double").alias("size"), F.lit(None).cast("double").alias("missing"))
    return wide.unpivot([], ["names", "size", "missing"], "metric", "value").where("value IS NOT NULL")


@query("SELECT n_name AS name FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT r_name FROM region")
def union_all(spark, sf_dir):
    r = table(spark, sf_dir, "region").select("r_name")
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("name")).union(r).union(r)


@query("SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).union(table(spark, sf_dir, "supplier").select("s_nationkey")).distinct()


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 10")
def topk_global(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice").orderBy(F.desc("l_extendedprice"), "l_orderkey", "l_linenumber").limit(10)


@query("SELECT p_partkey, p_name FROM part WHERE p_size NOT BETWEEN 5 AND 45 AND p_brand IS DISTINCT FROM 'Brand#11' AND p_type NOT IN ('PROMO') AND NOT starts_with(p_name, 'a')")
def predicates(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.where(~F.col("p_size").between(5, 45) & ~F.col("p_brand").eqNullSafe("Brand#11") & ~F.col("p_type").isin("PROMO") & ~F.startswith("p_name", F.lit("a"))).select("p_partkey", "p_name")


@query("SELECT a.s_suppkey AS a, b.s_suppkey AS b FROM supplier a JOIN supplier b ON a.s_nationkey = b.s_nationkey AND a.s_suppkey < b.s_suppkey")
def pair_self_join(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    a, b = s.select("s_nationkey", F.col("s_suppkey").alias("a")), s.select("s_nationkey", F.col("s_suppkey").alias("b"))
    return a.join(b, "s_nationkey").where("a < b").select("a", "b")


@query("SELECT source, count(*) AS docs, count(DISTINCT text) AS texts, count(quality) AS labelled, round(avg(quality), 4) AS good FROM documents LEFT JOIN labels USING (doc_id) GROUP BY 1")
def labelled_sources(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.sha2("text", 256).alias("h"))
    j = d.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id", "left")
    return j.groupBy("source").agg(F.count("*").alias("docs"), F.count_distinct("h").alias("texts"), F.count("quality").alias("labelled"), F.round(F.avg("quality"), 4).alias("good"))

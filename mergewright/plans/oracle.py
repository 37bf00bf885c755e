"""The pipeline once more, as DuckDB SQL: an independent twin of each table for comparison."""

from __future__ import annotations

import re

from ..functions import text as X
from .params import Params
from .registers import CHARITIES, COMPANIES

P = Params()


def blank(c: str) -> str:
    return f"nullif(trim({c}), '')"


def in_list(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def words(c: str, pairs) -> str:
    out = f"' ' || {c} || ' '"
    for a, b in pairs:
        out = f"replace({out}, ' {a} ', ' {b} ')"
    return f"trim({out})"


def plain(c: str) -> str:
    return f"upper(replace(translate({c}, '{X.MACRONS}', '{X.VOWELS}'), 'ß', 'ss'))"


def name_clean(c: str) -> str:
    letters = f"regexp_replace(replace(replace(replace({plain(c)}, '&', ' AND '), '''', ''), '’', ''), '[^A-Z0-9]+', ' ', 'g')"
    return f"nullif(regexp_replace({words(f'trim({letters})', X.LEGAL_FORMS)}, '^({'|'.join(X.LEADING)}) ', ''), '')"


def name_core(c: str) -> str:
    end = f" ({'|'.join(X.TRAILING)})$"
    return f"coalesce(nullif(regexp_replace(regexp_replace({c}, '{end}', ''), '{end}', ''), ''), {c})"


def place(c: str) -> str:
    return f"nullif(trim(regexp_replace({plain(c)}, '\\s+', ' ', 'g')), '')"


def address(c: str) -> str:
    only = f"regexp_replace({plain(c)}, '[^A-Z0-9/ -]', ' ', 'g')"
    return f"nullif({words(place(only), X.STREET_TYPES)}, '')"


def overseas(c: str) -> str:
    return f"coalesce(starts_with(trim({c}), '+') AND NOT regexp_full_match(trim({c}), '\\+[^0-9]*64.*', 's'), false)"


def phone(c: str) -> str:
    first = f"regexp_replace(lower({c}), '(,| or |&|ext| ex | x ).*$', '', 's')"
    one = f"regexp_replace({first}, '^(([^0-9/]*[0-9]){{7}}[^/]*)/.*$', '\\1', 's')"
    local = f"regexp_replace(regexp_replace({one}, '[^0-9]', '', 'g'), '^(0064|64)0*', '0')"
    return f"CASE WHEN NOT {overseas(c)} AND regexp_full_match({local}, '0[0-9]{{7,10}}') THEN {local} END"


def placeholder(c: str) -> str:
    return f"coalesce(lower(trim({c})) IN {in_list(X.PLACEHOLDER_EMAILS)}, false)"


def generic_host(c: str) -> str:
    return f"({c} IN {in_list(X.GENERIC_HOSTS)} OR regexp_full_match({c}, '.*[.](facebook|google)[.]com'))"


def flag_list(pairs) -> str:
    return "list_filter([" + ", ".join(f"CASE WHEN {c} THEN '{n}' END" for c, n in pairs) + "], lambda v: v IS NOT NULL)"


def jw(a: str, b: str) -> str:
    return f"round(100 * jaro_winkler_similarity({a}, {b}), 2)::DECIMAL(5,2)"


def jaccard(a: str, b: str) -> str:
    return f"len(list_intersect({a}, {b})) / nullif(len(list_distinct(list_concat({a}, {b}))), 0)"


def share(equal: str | None, n: str, never: str = "false") -> str:
    full = f"{n} IS NULL" if equal is None else f"NOT coalesce({equal}, false)"
    return f"(CASE WHEN {full} THEN 1.0 WHEN {never} THEN 0 WHEN {n} <= {P.rare_max} THEN 1.0 WHEN {n} <= {P.shared_max} THEN {P.shared_factor} ELSE 0 END)"


STREET = "streetaddressline1 IS NOT NULL"
CTE: dict[str, str] = {"raw_charities": CHARITIES, "raw_companies": COMPANIES}
CTE["c0"] = "SELECT COLUMNS(*)::VARCHAR FROM raw_charities"
CTE["c1"] = "SELECT nullif(trim(COLUMNS(*)), '') FROM c0"
CTE["c2"] = f"""SELECT 'CHR:' || organisationid AS record_key, 'CHARITIES_REGISTER' AS source_system, organisationid AS source_record_id, name AS name_raw,
  othernames AS alt_1, NULL::VARCHAR AS alt_2, upper(charityregistrationnumber) AS charity_reg_no, split_part(upper(charityregistrationnumber), '-', 1) AS charity_parent_reg_no,
  nzbnnumber AS nzbn_raw, companiesofficenumber AS company_no,
  CASE WHEN {STREET} THEN concat_ws(' ', streetaddressline1, streetaddressline2) ELSE concat_ws(' ', postaladdressline1, postaladdressline2) END AS line_raw,
  CASE WHEN {STREET} THEN streetaddresssuburb ELSE postaladdresssuburb END AS suburb_raw, CASE WHEN {STREET} THEN streetaddresscity ELSE postaladdresscity END AS city_raw,
  CASE WHEN {STREET} THEN streetaddresspostcode ELSE postaladdresspostcode END AS postcode_raw, telephone1 AS phone_raw,
  coalesce(CASE WHEN NOT {placeholder('emailaddress1')} THEN emailaddress1 END, CASE WHEN NOT {placeholder('charityemailaddress')} THEN charityemailaddress END) AS email_raw,
  websiteurl AS website_raw, upper(registrationstatus) AS entity_status, dateregistered AS date_raw, try_strptime(split_part(dateregistered, ' ', 1), '%d/%m/%Y')::DATE AS registered_date,
  {flag_list([(f'NOT ({STREET}) AND postaladdressline1 IS NOT NULL', 'ADDRESS_FROM_POSTAL'), (f"{placeholder('emailaddress1')} OR {placeholder('charityemailaddress')}", 'PLACEHOLDER_EMAIL')])} AS source_flags FROM c1"""
CTE["k0"] = f"SELECT * FROM raw_companies QUALIFY row_number() OVER (PARTITION BY {blank('nzbn')} ORDER BY export_file NULLS LAST, business_name NULLS LAST) = 1"
CTE["k1"] = f"""SELECT {blank('business_name')} AS business_name, {blank('nzbn')} AS nzbn, {blank('registration_date')} AS registration_date, {blank('trading_as')} AS trading_as,
  {blank('previously_known_as')} AS previously_known_as, {blank('status')} AS status, string_split({blank('physical_address')}, ', ') AS parts0 FROM k0"""
CTE["k2"] = "SELECT *, CASE WHEN upper(trim(parts0[-1])) = 'NEW ZEALAND' THEN parts0[:-2] ELSE parts0 END AS parts FROM k1"
CTE["k3"] = "SELECT *, coalesce(regexp_full_match(trim(parts[-1]), '[0-9]+'), false) AS has_pc, len(parts) - (CASE WHEN coalesce(regexp_full_match(trim(parts[-1]), '[0-9]+'), false) THEN 1 ELSE 0 END) AS k FROM k2"
CTE["k4"] = f"""SELECT 'COS:' || nzbn AS record_key, 'COMPANIES_OFFICE' AS source_system, nzbn AS source_record_id, coalesce(business_name, trading_as) AS name_raw,
  CASE WHEN business_name IS NOT NULL THEN trading_as END AS alt_1, previously_known_as AS alt_2, NULL::VARCHAR AS charity_reg_no, NULL::VARCHAR AS charity_parent_reg_no, nzbn AS nzbn_raw, NULL::VARCHAR AS company_no,
  CASE WHEN k >= 1 THEN array_to_string(parts[1:greatest(CASE WHEN k >= 3 THEN k - 2 ELSE k - 1 END, 0)], ' ') END AS line_raw, CASE WHEN k >= 3 THEN trim(parts[k - 1]) END AS suburb_raw,
  CASE WHEN k >= 1 THEN trim(parts[k]) END AS city_raw, CASE WHEN has_pc THEN trim(parts[-1]) END AS postcode_raw, NULL::VARCHAR AS phone_raw, NULL::VARCHAR AS email_raw, NULL::VARCHAR AS website_raw,
  upper(status) AS entity_status, registration_date AS date_raw, try_strptime(registration_date, '%d-%b-%Y')::DATE AS registered_date,
  {flag_list([('business_name IS NULL AND trading_as IS NOT NULL', 'NAME_FROM_TRADING_AS')])} AS source_flags FROM k3"""
CTE["u"] = f"""SELECT *, {name_clean('name_raw')} AS name_clean, list_filter([{name_clean('alt_1')}, {name_clean('alt_2')}], lambda v: v IS NOT NULL) AS alt_names, {address('line_raw')} AS address_line_clean,
  {place('suburb_raw')} AS suburb, {place('city_raw')} AS city, CASE WHEN regexp_full_match(postcode_raw, '[0-9]{{4}}') THEN postcode_raw WHEN regexp_full_match(postcode_raw, '[0-9]{{3}}') THEN lpad(postcode_raw, 4, '0') END AS postcode,
  {phone('phone_raw')} AS phone_clean, {overseas('phone_raw')} AS overseas, lower(email_raw) AS email_clean, nullif(split_part(lower(email_raw), '@', 2), '') AS email_domain,
  nullif(split_part(regexp_replace(regexp_replace(lower(website_raw), '^https?://', ''), '^www[.]', ''), '/', 1), '') AS website_domain,
  CASE WHEN regexp_full_match(replace(nzbn_raw, ' ', ''), '94[0-9]{{11}}') THEN replace(nzbn_raw, ' ', '') END AS nzbn FROM (SELECT * FROM c2 UNION ALL SELECT * FROM k4)"""
ZEROS = "regexp_full_match(replace(nzbn_raw, ' ', ''), '0+')"
CTE["std"] = f"""SELECT record_key, source_system, source_record_id, name_raw, name_clean, {name_core('name_clean')} AS name_core, alt_names, charity_reg_no, charity_parent_reg_no, nzbn, company_no, address_line_clean, suburb, city, postcode,
  phone_clean, email_clean, email_domain, coalesce(email_domain IN {in_list(X.GENERIC_EMAIL_DOMAINS)}, false) AS is_generic_email_domain, website_domain, entity_status, registered_date, name_clean IS NOT NULL AS is_matchable,
  list_concat(source_flags, {flag_list([('name_clean IS NULL', 'RESTRICTED_OR_NO_NAME'), ('postcode_raw IS NOT NULL AND postcode IS NULL', 'INVALID_POSTCODE'), ('overseas', 'OVERSEAS_PHONE'), ('phone_raw IS NOT NULL AND phone_clean IS NULL AND NOT overseas', 'INVALID_PHONE'), (f'nzbn_raw IS NOT NULL AND nzbn IS NULL AND {ZEROS}', 'PLACEHOLDER_NZBN'), (f'nzbn_raw IS NOT NULL AND nzbn IS NULL AND NOT {ZEROS}', 'INVALID_NZBN'), ('nzbn IS NULL', 'MISSING_NZBN'), ('date_raw IS NOT NULL AND registered_date IS NULL', 'INVALID_DATE')])}) AS dq_flags FROM u"""
CTE["block_key"] = f"""SELECT DISTINCT record_key, block_type, block_value FROM (
  SELECT record_key, 'POSTCODE_NAME4' AS block_type, postcode || '|' || left(name_core, 4) AS block_value FROM std WHERE is_matchable
  UNION ALL SELECT record_key, 'PHONE', phone_clean FROM std WHERE is_matchable
  UNION ALL SELECT record_key, 'EMAIL', email_clean FROM std WHERE is_matchable AND NOT is_generic_email_domain
  UNION ALL SELECT record_key, 'WEBSITE', website_domain FROM std WHERE is_matchable AND contains(website_domain, '.') AND NOT {generic_host('website_domain')}
  UNION ALL SELECT record_key, 'NAME_EXACT', name_core FROM std WHERE is_matchable
  UNION ALL SELECT record_key, 'NAME_EXACT', {name_core('n')} FROM (SELECT record_key, unnest(alt_names) AS n FROM std WHERE is_matchable)
  UNION ALL SELECT record_key, 'NZBN', nzbn FROM std WHERE is_matchable) WHERE block_value IS NOT NULL"""
CTE["block_skipped"] = f"SELECT block_type, block_value, count(*) AS record_count FROM block_key GROUP BY ALL HAVING count(*) > {P.max_block}"
CTE["kept"] = "SELECT * FROM block_key b WHERE NOT EXISTS (SELECT 1 FROM block_skipped s WHERE s.block_type = b.block_type AND s.block_value = b.block_value)"
CTE["pair0"] = """SELECT l.record_key AS left_key, r.record_key AS right_key, list_sort(list(DISTINCT l.block_type)) AS block_types FROM kept l JOIN kept r
  ON l.block_type = r.block_type AND l.block_value = r.block_value AND l.record_key < r.record_key GROUP BY 1, 2"""
CTE["pairs"] = """SELECT sha256(left_key || '|' || right_key) AS pair_id, left_key, right_key, l.source_system AS left_source, r.source_system AS right_source,
  CASE WHEN l.source_system <> r.source_system THEN 'CHR-COS' WHEN l.source_system = 'CHARITIES_REGISTER' THEN 'CHR-CHR' ELSE 'COS-COS' END AS pair_type,
  block_types, len(block_types) AS block_count, block_types = ['NZBN'] AS only_nzbn_block FROM pair0 JOIN std l ON l.record_key = left_key JOIN std r ON r.record_key = right_key"""
SIDES = ("name_clean", "name_core", "alt_names", "address_line_clean", "postcode", "city", "phone_clean", "email_clean", "is_generic_email_domain", "website_domain", "nzbn", "company_no", "charity_reg_no", "charity_parent_reg_no")
CTE["sided"] = f"SELECT pair_id, left_key, right_key, {', '.join(f'l.{c} AS l_{c}, r.{c} AS r_{c}' for c in SIDES)} FROM pairs JOIN std l ON l.record_key = left_key JOIN std r ON r.record_key = right_key"
CTE["alt"] = f"""SELECT pair_id, max(least({jw('a', 'b')}, {jw('reverse(a)', 'reverse(b)')})) AS alt_name_jw FROM (
  SELECT pair_id, a, unnest(rs) AS b FROM (SELECT pair_id, unnest(list_concat([l_name_clean], l_alt_names)) AS a, list_concat([r_name_clean], r_alt_names) AS rs FROM sided WHERE len(l_alt_names) > 0 OR len(r_alt_names) > 0)) GROUP BY 1"""
LW, RW = ("list_distinct(string_split(coalesce(%s_name_core, %s_name_clean), ' '))" % (s, s) for s in "lr")
CTE["jac"] = f"""SELECT pair_id, round(max(j), 2)::DECIMAL(5,2) AS name_token_jaccard FROM (
  SELECT pair_id, {jaccard(LW, RW)} AS j FROM sided
  UNION ALL SELECT pair_id, {jaccard('w', 'o')} FROM (SELECT pair_id, {LW} AS w, list_distinct(string_split({name_core('n')}, ' ')) AS o FROM (SELECT *, unnest(r_alt_names) AS n FROM sided))
  UNION ALL SELECT pair_id, {jaccard('w', 'o')} FROM (SELECT pair_id, {RW} AS w, list_distinct(string_split({name_core('n')}, ' ')) AS o FROM (SELECT *, unnest(l_alt_names) AS n FROM sided))) GROUP BY 1"""


def held(value: str) -> str:
    return f"(SELECT {value} AS v, count(*) AS n FROM std WHERE {value} IS NOT NULL GROUP BY 1)"


AT = "address_line_clean || '|' || postcode"
CTE["match_feature"] = f"""SELECT s.pair_id, {jw('l_name_clean', 'r_name_clean')} AS name_jw, {jw('l_name_core', 'r_name_core')} AS name_core_jw, {jw('reverse(l_name_core)', 'reverse(r_name_core)')} AS name_core_jw_rev, alt_name_jw,
  {jw('l_address_line_clean', 'r_address_line_clean')} AS address_jw, name_token_jaccard, l_postcode = r_postcode AS postcode_eq, l_city = r_city AS city_eq, l_phone_clean = r_phone_clean AS phone_eq,
  CASE WHEN NOT (l_is_generic_email_domain OR r_is_generic_email_domain) THEN l_email_clean = r_email_clean END AS email_eq, l_website_domain = r_website_domain AS website_eq, l_nzbn = r_nzbn AS nzbn_eq, l_company_no = r_company_no AS company_no_eq,
  (l_charity_parent_reg_no = r_charity_parent_reg_no AND l_charity_reg_no <> r_charity_reg_no) AS same_parent_charity, ec.n AS email_shared_count, pc.n AS phone_shared_count, wc.n AS website_shared_count, nc.n AS nzbn_shared_count, cc.n AS company_no_shared_count,
  CASE WHEN la.n IS NOT NULL AND ra.n IS NOT NULL THEN greatest(la.n, ra.n) END AS address_shared_count
  FROM sided s LEFT JOIN alt ON alt.pair_id = s.pair_id LEFT JOIN jac ON jac.pair_id = s.pair_id
  LEFT JOIN {held('email_clean')} ec ON ec.v = l_email_clean AND l_email_clean = r_email_clean AND NOT (l_is_generic_email_domain OR r_is_generic_email_domain)
  LEFT JOIN {held('phone_clean')} pc ON pc.v = l_phone_clean AND l_phone_clean = r_phone_clean LEFT JOIN {held('website_domain')} wc ON wc.v = l_website_domain AND l_website_domain = r_website_domain
  LEFT JOIN {held('nzbn')} nc ON nc.v = l_nzbn AND l_nzbn = r_nzbn LEFT JOIN {held('company_no')} cc ON cc.v = l_company_no AND l_company_no = r_company_no
  LEFT JOIN {held(AT)} la ON la.v = l_address_line_clean || '|' || l_postcode LEFT JOIN {held(AT)} ra ON ra.v = r_address_line_clean || '|' || r_postcode"""
BEST = f"greatest(least(coalesce(name_core_jw, name_jw, 0), coalesce(name_core_jw_rev, name_core_jw, name_jw, 0)), least(coalesce(alt_name_jw, 0), {P.alt_name_cap}))"


def yes(c: str) -> str:
    return f"CASE WHEN {c} THEN 100 WHEN NOT {c} THEN 0 END"


HOST = share("website_eq", "website_shared_count", generic_host("l_website_domain"))
ROWS = (
    ("NAME_BEST_JW", "coalesce(%s_name_core, %s_name_clean)", f"CASE WHEN coalesce(name_token_jaccard, 0) < {P.low_jaccard} THEN least({BEST}, {P.low_jaccard_cap}) ELSE {BEST} END", f"{P.weight_name}"),
    ("ADDRESS_JW", "%s_address_line_clean", "address_jw", f"{P.weight_address} * {share(None, 'address_shared_count')}"),
    ("POSTCODE_EQ", "%s_postcode", yes("postcode_eq"), f"{P.weight_postcode} * {share(None, 'address_shared_count')}"),
    ("CITY_EQ", "%s_city", yes("city_eq"), f"{P.weight_city} * {share(None, 'address_shared_count')}"),
    ("PHONE_EQ", "%s_phone_clean", yes("phone_eq"), f"{P.weight_phone} * {share('phone_eq', 'phone_shared_count')}"),
    ("EMAIL_EQ", "%s_email_clean", yes("email_eq"), f"{P.weight_email} * {share('email_eq', 'email_shared_count')}"),
    ("WEBSITE_EQ", "%s_website_domain", yes("website_eq"), f"{P.weight_website} * {HOST}"),
    ("NZBN_EQ", "%s_nzbn", yes("nzbn_eq"), "NULL"),
    ("COMPANY_NO_EQ", "%s_company_no", yes("company_no_eq"), "NULL"),
    ("SAME_PARENT_CHARITY", "%s_charity_parent_reg_no", yes("same_parent_charity"), "NULL"),
)
CTE["ev"] = " UNION ALL ".join(
    f"SELECT pair_id, '{f}' AS feature, {v.replace('%s', 'l')} AS left_value, {v.replace('%s', 'r')} AS right_value, ({s})::DECIMAL(5,2) AS similarity, ({w})::DECIMAL(5,2) AS weight, {str(w != 'NULL').lower()} AS in_score FROM sided JOIN match_feature USING (pair_id) WHERE ({s}) IS NOT NULL"
    for f, v, s, w in ROWS
)
CTE["ledger"] = "SELECT *, CASE WHEN in_score THEN round(weight::DOUBLE * similarity::DOUBLE / nullif(sum(CASE WHEN in_score THEN weight ELSE 0 END) OVER (PARTITION BY pair_id), 0)::DOUBLE + 1e-9, 2) END AS contribution FROM ev"
CONTACT = "feature IN ('PHONE_EQ', 'EMAIL_EQ', 'WEBSITE_EQ') AND similarity = 100"
CTE["fz"] = f"""SELECT pair_id, round(sum(CASE WHEN in_score THEN weight * similarity END)::DOUBLE / nullif(sum(CASE WHEN in_score THEN weight END), 0)::DOUBLE + 1e-9, 2)::DECIMAL(5,2) AS fuzzy_score,
  max(CASE WHEN feature = 'NAME_BEST_JW' THEN similarity END) AS name_score,
  coalesce(bool_or(weight > 0 AND ((feature = 'ADDRESS_JW' AND similarity >= {P.second_address}) OR (feature = 'POSTCODE_EQ' AND similarity = 100) OR ({CONTACT}))), false) AS has_second_evidence,
  coalesce(bool_or(weight = 0 AND {CONTACT}), false) AS has_shared_contact,
  coalesce((list(feature ORDER BY contribution DESC, feature) FILTER (WHERE contribution > 0))[1:3], []) AS reasons FROM ledger GROUP BY 1"""
SAME = "(coalesce(nzbn_eq, false) OR (coalesce(company_no_eq, false) AND nzbn_eq IS NULL))"
HOLD = "CASE WHEN nzbn_eq THEN nzbn_shared_count WHEN company_no_eq AND nzbn_eq IS NULL THEN company_no_shared_count END"
CTE["fd"] = f"""SELECT *, CASE WHEN fuzzy_score >= {P.auto_score} AND name_score >= {P.auto_name} AND has_second_evidence AND coalesce(name_token_jaccard, 0) >= {P.auto_jaccard} THEN 'AUTO_MATCH' WHEN fuzzy_score >= {P.review_score} THEN 'REVIEW' ELSE 'NO_MATCH' END AS fuzzy_decision,
  CASE WHEN {SAME} AND (coalesce(name_token_jaccard, 0) < {P.auto_jaccard} OR NOT coalesce(({HOLD}) <= {P.id_shared_max}, false)) THEN 'ID_MATCH_NAME_DIFFERS' WHEN {SAME} THEN 'ID_MATCH'
  WHEN NOT nzbn_eq AND name_score >= {P.id_conflict_review_name} THEN 'ID_CONFLICT_REVIEW' WHEN NOT nzbn_eq THEN 'ID_CONFLICT' WHEN same_parent_charity THEN 'RELATED_GROUP_MEMBER' ELSE 'FUZZY' END AS decision_path FROM fz JOIN match_feature USING (pair_id)"""
CTE["decision"] = f"""SELECT pair_id, (CASE WHEN decision_path = 'ID_MATCH' THEN 100 WHEN decision_path IN ('ID_CONFLICT', 'RELATED_GROUP_MEMBER') THEN least(fuzzy_score, {P.id_conflict_cap}) ELSE fuzzy_score END)::DECIMAL(5,2) AS score,
  CASE WHEN decision_path = 'ID_MATCH' THEN 'AUTO_MATCH' WHEN decision_path IN ('ID_MATCH_NAME_DIFFERS', 'ID_CONFLICT_REVIEW') THEN 'REVIEW' WHEN decision_path <> 'FUZZY' THEN 'NO_MATCH' ELSE fuzzy_decision END AS decision,
  CASE WHEN decision_path = 'FUZZY' THEN reasons ELSE list_prepend(decision_path, reasons) END AS top_reasons, fuzzy_score, fuzzy_decision, decision_path, name_score, has_shared_contact AND NOT has_second_evidence AS shared_only FROM fd"""
CTE["pq"] = f"""SELECT pair_id, NULL::VARCHAR AS record_key, CASE WHEN decision <> 'REVIEW' THEN 'SHARED_CONTACT_ONLY' WHEN decision_path = 'ID_CONFLICT_REVIEW' THEN 'ID_CONFLICT_HIGH_NAME' WHEN decision_path = 'ID_MATCH_NAME_DIFFERS' THEN 'SHARED_LEGAL_ENTITY' ELSE 'BORDERLINE_SCORE' END AS reason_code,
  score, 'OPEN' AS status FROM decision WHERE decision = 'REVIEW' OR (decision_path = 'FUZZY' AND decision = 'NO_MATCH' AND name_score >= {P.shared_contact_name} AND shared_only)"""
CTE["edge"] = """SELECT pair_id, left_key AS a, right_key AS b, score, decision_path FROM decision JOIN pairs USING (pair_id) WHERE decision = 'AUTO_MATCH'
  UNION ALL SELECT pair_id, right_key, left_key, score, decision_path FROM decision JOIN pairs USING (pair_id) WHERE decision = 'AUTO_MATCH'"""
CTE["reach"] = "SELECT record_key AS a, record_key AS b FROM std UNION SELECT reach.a, edge.b FROM reach JOIN edge ON edge.a = reach.b"
CTE["label"] = "SELECT a AS record_key, min(b) AS cluster_id FROM reach GROUP BY 1"
CTE["xref"] = """SELECT 'ORG-' || left(sha256(cluster_id), 12) AS master_id, cluster_id, record_key, source_system, source_record_id, CASE WHEN m = 1 THEN 'SINGLETON' WHEN record_key = cluster_id THEN 'SEED' ELSE 'AUTO_MATCH' END AS link_type,
  CASE WHEN m > 1 THEN conf END AS link_confidence, CASE WHEN m > 1 THEN rules END AS link_rules FROM label JOIN (SELECT cluster_id, count(*) AS m FROM label GROUP BY 1) USING (cluster_id) JOIN std USING (record_key)
  LEFT JOIN (SELECT a AS record_key, max(score) AS conf, list_sort(list(DISTINCT decision_path)) AS rules FROM edge GROUP BY 1) USING (record_key)"""
CTE["reviewed"] = "SELECT left_key AS record_key FROM pq JOIN pairs USING (pair_id) UNION SELECT right_key FROM pq JOIN pairs USING (pair_id)"
CTE["member"] = "SELECT std.*, master_id, link_confidence, record_key IN (SELECT record_key FROM reviewed) AS in_review FROM xref JOIN std USING (record_key, source_system, source_record_id)"
ORDER = "ORDER BY registered_date DESC NULLS LAST, record_key"


def newest(c: str) -> str:
    return f"(list({c} {ORDER}) FILTER (WHERE {c} IS NOT NULL))[1]"


CTE["master"] = f"""SELECT a.master_id, n.name_raw AS master_name, n.record_key AS name_source_key, z.nzbn, nzbn_conflict, p.address_line_clean AS address_line, p.suburb, p.city, p.postcode, phone, email, website, charity_reg_nos, source_systems, member_count, min_link_confidence,
  has_open_review OR nzbn_conflict AS has_open_review, member_count > {P.large_cluster} AS is_large_cluster, status_summary FROM (SELECT master_id, {newest('phone_clean')} AS phone, {newest('email_clean')} AS email, {newest('website_domain')} AS website, count(DISTINCT nzbn) > 1 AS nzbn_conflict,
  list_sort(list(DISTINCT charity_reg_no) FILTER (WHERE charity_reg_no IS NOT NULL)) AS charity_reg_nos, list_sort(list(DISTINCT source_system)) AS source_systems, count(*) AS member_count, min(link_confidence) AS min_link_confidence, bool_or(in_review) AS has_open_review,
  CASE WHEN coalesce(bool_or(entity_status = 'REGISTERED'), false) THEN 'REGISTERED' ELSE {newest('entity_status')} END AS status_summary FROM member GROUP BY 1) a
  JOIN (SELECT master_id, name_raw, record_key FROM member QUALIFY row_number() OVER (PARTITION BY master_id ORDER BY name_raw IS NULL, NOT coalesce(entity_status = 'REGISTERED', false), registered_date DESC NULLS LAST, record_key) = 1) n USING (master_id)
  LEFT JOIN (SELECT master_id, nzbn FROM member WHERE nzbn IS NOT NULL GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY master_id ORDER BY count(*) DESC, nzbn) = 1) z USING (master_id)
  LEFT JOIN (SELECT master_id, address_line_clean, suburb, city, postcode FROM member WHERE coalesce(address_line_clean, suburb, city, postcode) IS NOT NULL QUALIFY row_number() OVER (PARTITION BY master_id {ORDER}) = 1) p USING (master_id)"""
CTE["queue"] = "SELECT * FROM pq UNION ALL SELECT NULL, record_key, 'CHAIN_NZBN_CONFLICT', NULL, 'OPEN' FROM xref JOIN master USING (master_id) WHERE nzbn_conflict"
CTE["truth"] = f"""SELECT l.record_key AS left_key, r.record_key AS right_key, nzbn, n AS nzbn_record_count, pair_id, pair_id IS NOT NULL AS in_candidates, coalesce(NOT only_nzbn_block, false) AS found_without_nzbn, block_types, fuzzy_score, fuzzy_decision
  FROM std l JOIN std r USING (nzbn) JOIN (SELECT nzbn, count(*) AS n FROM std GROUP BY 1) USING (nzbn) LEFT JOIN pairs p ON p.left_key = l.record_key AND p.right_key = r.record_key LEFT JOIN decision USING (pair_id)
  WHERE l.is_matchable AND r.is_matchable AND l.record_key < r.record_key AND n <= {P.true_id_max}"""
CTE["evaluable"] = """SELECT p.pair_id, p.left_key, p.right_key, t.left_key IS NOT NULL AS is_true, fuzzy_score, fuzzy_decision FROM pairs p JOIN decision USING (pair_id) JOIN std l ON l.record_key = p.left_key JOIN std r ON r.record_key = p.right_key
  LEFT JOIN (SELECT left_key, right_key FROM truth) t ON t.left_key = p.left_key AND t.right_key = p.right_key WHERE NOT only_nzbn_block AND l.nzbn IS NOT NULL AND r.nzbn IS NOT NULL AND (t.left_key IS NOT NULL OR l.nzbn <> r.nzbn)"""
CTE["confusion"] = f"""SELECT g AS metric_group, x AS suffix, count(*) FILTER (WHERE is_true) AS tp, count(*) FILTER (WHERE NOT is_true) AS fp FROM (SELECT 'strict' AS g, '' AS x, 0 AS t UNION ALL SELECT 'lenient', '', 0 UNION ALL SELECT 'sweep', '_t' || t, t FROM (SELECT unnest({list(P.thresholds)}) AS t)) m
  LEFT JOIN evaluable e ON CASE g WHEN 'strict' THEN fuzzy_decision = 'AUTO_MATCH' WHEN 'lenient' THEN fuzzy_decision IN ('AUTO_MATCH', 'REVIEW') ELSE fuzzy_score >= t END GROUP BY 1, 2"""
CTE["rates"] = "SELECT *, n_true - tp AS fn, tp / nullif(tp + fp, 0) AS precision, tp / nullif(n_true, 0) AS recall FROM confusion CROSS JOIN (SELECT count(*) AS n_true FROM truth)"


def needs(sql: str, found: list[str]) -> None:
    """The CTEs that sql names, each behind those that it needs."""
    names = set(re.findall(r"(?:FROM|JOIN) (\w+)", sql))
    for name, body in CTE.items():
        if name in names and name not in found:
            if name != "reach":
                needs(body, found)
            else:
                needs("FROM std JOIN edge", found)
            if name not in found:
                found.append(name)


def query(sql: str) -> str:
    found: list[str] = []
    needs(sql, found)
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n != 'reach' else ''}({CTE[n]})" for n in found) + "\n" + sql

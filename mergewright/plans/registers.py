"""Two raw registers derived from the driver's customer and supplier tables, in SQL that Spark and DuckDB both run.

Three customers in a row and one supplier are records of one organisation, spelled and filled differently; the first
260 customers are also records that the rarer rules need, so that every rule has rows from 1,500 customers on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Words of the names, places and streets.
FIRST = "Aroha|Kowhai|Rimu|Totara|Harbour|Southern|Pacific|Unity|Hope|River|Alpine|Ngāti Awa|Ōtaki|St. John''s|Smith & Sons|Green Valley"
SECOND = "Community|Rugby|Music|Sports|Arts|Health|School|Marae|Garden|Youth|Family|Housing"
THIRD = "Club|Centre|Network|Foundation|Group|House|Services|Association"
FORM = "Trust|Charitable Trust|Incorporated|Limited|Society Incorporated|Trust Board|Company Limited"
STREET = "High Street|Station Road|Queen Avenue|Beach Drive|Park Place|Hill Crescent|Ocean Terrace"
CITY = "Wellington|Ōtaki|Auckland|Dunedin|Napier"


def pick(words: str, number: str) -> str:
    return f"split_part('{words}', '|', CAST(({number}) % {words.count('|') + 1} AS INT) + 1)"


def text(number: str) -> str:
    return f"CAST({number} AS STRING)"


def padded(number: str, width: int) -> str:
    return f"lpad({text(number)}, {width}, '0')"


NAME = f"{pick(FIRST, 'e * 7')} || ' ' || {pick(SECOND, 'CAST(floor(e / 16.0) AS BIGINT)')} || ' ' || {pick(THIRD, 'CAST(floor(e / 192.0) AS BIGINT)')}"
LINE = f"{text('1 + e % 97')} || ' ' || {pick(STREET, 'e')}"
NUMBER = f"'94' || {padded('e * 7919 % 100000000000', 11)}"

CHARITIES = f"""
SELECT 'A' || {padded('k', 9)} AS organisationid,
  CASE WHEN k % 41 = 5 THEN ' ' WHEN k % 17 = 3 THEN 'The Trustees of the ' || nm || ' ' || {pick(FORM, 'e')} WHEN k % 3 = 1 THEN upper(nm) WHEN k % 3 = 2 THEN nm || '  ' || {pick(FORM, 'e + k')} ELSE nm || ' ' || {pick(FORM, 'e')} END AS name,
  CASE WHEN k % 7 = 0 THEN {pick(FIRST, 'e * 7')} || ' ' || {pick(THIRD, 'e')} END AS othernames,
  'cc' || {text('10000 + e')} || CASE WHEN k % 5 = 1 THEN '-' || {text('k % 3 + 1')} ELSE '' END AS charityregistrationnumber,
  CASE WHEN k % 29 = 0 THEN '0000000000000' WHEN k % 31 = 0 THEN '12345' WHEN k % 2 = 0 THEN {NUMBER} WHEN k % 11 = 0 THEN '94 ' || substr({NUMBER}, 3) END AS nzbnnumber,
  CASE WHEN k % 4 = 0 THEN {text('500000 + e')} END AS companiesofficenumber,
  CASE WHEN k % 13 = 0 THEN 'NoCharityEmail@dia.govt.nz' WHEN k % 9 = 0 THEN 'o' || {text('e')} || '@gmail.com' WHEN k % 3 < 2 THEN 'Info@org' || {text('e')} || '.org.nz' END AS emailaddress1,
  CASE WHEN k % 26 = 0 THEN 'office@group' || {text('e % 9')} || '.org.nz' END AS charityemailaddress,
  CASE WHEN k % 19 = 0 THEN '+61 2 9999 ' || {padded('e % 10000', 4)} WHEN k % 23 = 0 THEN 'n/a' WHEN k % 3 = 0 THEN '+64 (0)21 ' || {padded('e % 10000000', 7)} WHEN k % 3 = 1 THEN '021' || {padded('e % 10000000', 7)} || '/098373727' ELSE '021-' || {padded('e % 10000000', 7)} || ', extn 5' END AS telephone1,
  CASE WHEN k % 14 = 0 THEN 'https://m.facebook.com/x' WHEN k % 3 = 0 THEN 'https://www.org' || {text('e')} || '.org.nz/about' WHEN k % 3 = 1 THEN 'ORG' || {text('e')} || '.org.nz' END AS websiteurl,
  CASE WHEN k % 6 <> 4 THEN {LINE} END AS streetaddressline1, CASE WHEN k % 12 = 1 THEN 'Level 2' END AS streetaddressline2,
  CASE WHEN k % 6 <> 4 THEN 'Island Bay' END AS streetaddresssuburb, CASE WHEN k % 6 <> 4 THEN {pick(CITY, 'e')} END AS streetaddresscity,
  CASE WHEN k % 37 = 0 THEN '12' WHEN k % 6 <> 4 THEN {text('e % 40 + 600')} END AS streetaddresspostcode,
  CASE WHEN k % 5 <> 0 THEN 'PO Box ' || {text('e')} END AS postaladdressline1, CAST(NULL AS STRING) AS postaladdressline2,
  CAST(NULL AS STRING) AS postaladdresssuburb, {pick(CITY, 'e')} AS postaladdresscity, {text('e % 40 + 6000')} AS postaladdresspostcode,
  CASE WHEN k % 8 = 3 THEN 'Deregistered' ELSE 'Registered' END AS registrationstatus,
  CASE WHEN k % 43 = 0 THEN 'unknown' WHEN k % 47 <> 0 THEN {text('k % 28 + 1')} || '/' || {padded('k % 12 + 1', 2)} || '/' || {text('1990 + k % 30')} || ' 00:00' END AS dateregistered
FROM (SELECT k, e, {NAME} AS nm FROM (SELECT c_custkey AS k, CAST(floor(c_custkey / 3.0) AS BIGINT) AS e FROM customer) a) t
"""

#: Records for the rarer rules: twelve of which six share a telephone and seven a mail address, one of them both (a large cluster);
#: triples whose outer records have different numbers and are linked through the middle one; and a telephone that over 200 share.
_WORDS = "Orchard|Bakery|Weaver|Lantern|Meadow|Pottery|Sailing|Theatre|Walking|Archery"
_T = "CAST(floor((k - 13) / 3.0) AS BIGINT)"
SPECIAL = f"""
SELECT 'B' || {padded('k', 9)} AS organisationid,
  CASE WHEN k <= 12 THEN 'Chained Harbour Choir Limited' WHEN k <= 42 THEN {pick(_WORDS, _T)} || ' Conflict Society Incorporated' ELSE 'Solo Keeper ' || {text('k * 7919')} END AS name,
  CAST(NULL AS STRING) AS othernames, 'cc' || {text('9000000 + k')} AS charityregistrationnumber,
  CASE WHEN k > 12 AND k <= 42 AND (k - 13) % 3 = 0 THEN '9499' || {padded('k * 31', 9)} WHEN k > 12 AND k <= 42 AND (k - 13) % 3 = 2 THEN '9498' || {padded('k * 31', 9)} END AS nzbnnumber,
  CAST(NULL AS STRING) AS companiesofficenumber,
  CASE WHEN k >= 6 AND k <= 12 THEN 'sing@choir.org.nz' WHEN k > 12 AND k <= 42 AND (k - 13) % 3 > 0 THEN 'pair' || {text(_T)} || '@fruit.org.nz' END AS emailaddress1,
  CAST(NULL AS STRING) AS charityemailaddress,
  CASE WHEN k <= 6 THEN '0219990000' WHEN k > 12 AND k <= 42 AND (k - 13) % 3 < 2 THEN '0219980' || {padded(_T, 3)} WHEN k > 42 THEN '0800555123' END AS telephone1,
  CAST(NULL AS STRING) AS websiteurl, CAST(NULL AS STRING) AS streetaddressline1, CAST(NULL AS STRING) AS streetaddressline2, CAST(NULL AS STRING) AS streetaddresssuburb,
  CAST(NULL AS STRING) AS streetaddresscity, CAST(NULL AS STRING) AS streetaddresspostcode, CAST(NULL AS STRING) AS postaladdressline1, CAST(NULL AS STRING) AS postaladdressline2,
  CAST(NULL AS STRING) AS postaladdresssuburb, CAST(NULL AS STRING) AS postaladdresscity, CAST(NULL AS STRING) AS postaladdresspostcode, 'Registered' AS registrationstatus, '01/02/2001 00:00' AS dateregistered
FROM (SELECT c_custkey AS k FROM customer WHERE c_custkey <= 260) a
"""
CHARITIES = f"{CHARITIES} UNION ALL {SPECIAL}"

COMPANIES = f"""
SELECT CASE WHEN k % 21 = 4 THEN NULL ELSE upper(nm) || ' ' || upper({pick(FORM, 'e')}) END AS business_name, {NUMBER} AS nzbn,
  {padded('k % 28 + 1', 2)} || '-' || {pick('Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec', 'k')} || '-' || {text('2000 + k % 20')} AS registration_date,
  CASE WHEN k % 2 = 0 THEN 'NZ Limited Company' WHEN k % 3 = 0 THEN 'Charitable Trust' ELSE ' ' END AS entity_type, CAST(NULL AS STRING) AS act,
  CASE WHEN k % 21 = 4 THEN nm || ' Traders' WHEN k % 5 = 0 THEN nm || ' Shop' END AS trading_as,
  CASE WHEN k % 15 = 7 THEN NULL WHEN k % 10 = 3 THEN {pick(CITY, 'e')} || ', New Zealand' ELSE upper({LINE}) || ', ISLAND BAY, ' || upper({pick(CITY, 'e')}) || ', ' || {padded('e % 40 + 600', 4)} || ', New Zealand' END AS physical_address,
  CASE WHEN k % 7 = 2 THEN 'Old ' || nm END AS previously_known_as, CAST(NULL AS STRING) AS previously_trading_as,
  CASE WHEN k % 6 = 1 THEN 'Removed' ELSE 'Registered' END AS status, CAST(NULL AS STRING) AS status_date, x AS export_file
FROM (SELECT k, e, x, {NAME} AS nm FROM (SELECT s_suppkey AS k, s_suppkey * 2 AS e, x FROM supplier CROSS JOIN (SELECT 'a.xls' AS x UNION ALL SELECT 'b.xls' AS x) exports) a) t
WHERE x = 'a.xls' OR k % 4 = 0
"""


def raw_registers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The charities and companies registers of a data set."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey")
    return spark.sql(CHARITIES.replace("FROM customer", "FROM {t}"), t=customer), spark.sql(COMPANIES.replace("FROM supplier", "FROM {t}"), t=supplier)

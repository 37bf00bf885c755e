"""Cleaning rules and similarity: tables of cases and properties."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from mergewright.functions import text as X
from mergewright.functions.fuzzy import best_of_names, distinct_ratios, jaro_winkler, jaro_winkler_ratio

CASES = {
    "name_clean": (X.name_clean, [
        ("The Trustees of the Hocken Library Trust", "HOCKEN LIBRARY TRUST"), ("Music Futures Incorporated", "MUSIC FUTURES INC"), ("Ngāti Awa Farms Limited", "NGATI AWA FARMS LTD"),
        ("Smith & Sons Company Limited", "SMITH AND SONS CO LTD"), ("St. John's Foundation", "ST JOHNS FOUNDATION"), ("Otago Rugby Society Incorporated", "OTAGO RUGBY SOCIETY INC"), ("---", None), (None, None), ("", None),
    ]),
    "name_core": (lambda c: X.name_core(X.name_clean(c)), [
        ("The Trustees of the Hocken Library Trust", "HOCKEN LIBRARY"), ("Otago Rugby Society Incorporated", "OTAGO RUGBY"), ("Smith & Sons Company Limited", "SMITH AND SONS CO"), ("Trust", "TRUST"), (None, None),
    ]),
    "phone": (X.phone_clean, [
        ("+64 021 1325689", "0211325689"), ("098373727/0211449638", "098373727"), ("06/8710793", "068710793"), ("094807365, extn 5", "094807365"), ("+61 2 9999 1234", None), ("n/a", None), (None, None), ("0064 21 132 5689", "0211325689"),
    ]),
    "overseas": (X.phone_is_overseas, [("+61 2 9999", True), ("+64 21", False), ("+(64) 21", False), ("021", False), (None, False)]),
    "address": (X.address_clean, [("23 High Street.", "23 HIGH ST"), ("12-14 Road Road", "12-14 RD ROAD"), ("2/15 Ōtaki Road, x", "2/15 OTAKI RD X"), ("", None), (None, None)]),
    "postcode": (X.postcode_clean, [("6012", "6012"), ("612", "0612"), ("12", None), ("1234\n", None), (None, None)]),
    "host": (X.website_host, [("https://www.x.org.nz/about", "x.org.nz"), ("X.ORG", "x.org"), ("", None), (None, None)]),
    "generic": (X.is_generic_host, [("facebook.com", True), ("m.facebook.com", True), ("m.facebook.com.au", False), ("x.nz", False)]),
    "nzbn": (X.nzbn_clean, [("94 29000000001", "9429000000001"), ("0000000000000", None), ("9429", None), (None, None)]),
    "placeholder": (X.is_placeholder_email, [(" NoCharityEmail@dia.govt.nz", True), ("a@b.c", False), (None, False)]),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    rule, cases = CASES[name]
    rows = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(cases)], "i int, s string").select("i", rule(F.col("s")).alias("o")).orderBy("i").collect()
    assert [r.o for r in rows] == [b for _, b in cases]


def test_cleaning_twice_changes_nothing(spark):
    names = [a for a, _ in CASES["name_clean"][1] if a]
    rows = spark.createDataFrame([(n,) for n in names], "s string").select(X.name_clean(F.col("s")).alias("a")).select("a", X.name_clean(F.col("a")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_sql_functions(spark):
    X.register(spark)
    r = spark.sql("SELECT name_core(name_clean('Otago Rugby Society Incorporated')) AS a, phone_clean('06/8710793') AS b, phone_is_overseas('+61 2') AS c").first()
    assert (r.a, r.b, r.c) == ("OTAGO RUGBY", "068710793", True)


def plain_jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0 if a else 0.0
    reach, free, hits = max(max(len(a), len(b)) // 2 - 1, 0), [True] * len(b), []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if free[j] and b[j] == c:
                free[j] = False
                hits.append(c)
                break
    if not hits:
        return 0.0
    k = len(hits)
    turned = sum(x != y for x, y in zip(hits, (c for c, f in zip(b, free) if not f))) // 2
    ratio = (k / len(a) + k / len(b) + (k - turned) / k) / 3
    prefix = next((i for i, (x, y) in enumerate(zip(a[:4], b[:4])) if x != y), min(4, len(a), len(b)))
    return ratio + (prefix * 0.1 * (1 - ratio) if ratio > 0.7 else 0)


@given(st.lists(st.tuples(st.text("abcé ", max_size=14), st.text("abcé ", max_size=14)), max_size=12))
def test_jaro_winkler_side_by_side(pairs):
    got = distinct_ratios([a for a, _ in pairs], [b for _, b in pairs])
    assert got.tolist() == pytest.approx([plain_jaro_winkler(a, b) for a, b in pairs], abs=1e-12)


@given(st.text(max_size=12), st.text(max_size=12))
def test_jaro_winkler_properties(a, b):
    x = jaro_winkler_ratio(a, b)
    assert 0 <= x <= 1 and x == pytest.approx(jaro_winkler_ratio(b, a))
    assert x == 1 if a == b and a else True


def test_jaro_winkler_known(spark):
    assert jaro_winkler_ratio("MARTHA", "MARHTA") == pytest.approx(0.9611, abs=1e-4)
    assert jaro_winkler_ratio("DIXON", "DICKSONX") == pytest.approx(0.8133, abs=1e-4)
    row = spark.createDataFrame([("a", None), ("MARTHA", "MARHTA")], "a string, b string").select(jaro_winkler(F.col("a"), F.col("b")).alias("s")).collect()
    assert row[0].s is None and float(row[1].s) == 96.11


def test_best_of_names(spark):
    rows = [(["MARTHA", "X"], ["MARHTA", None]), ([], ["A"]), (None, ["A"]), (["AB"], ["AB", "CD"])]
    got = [r.s for r in spark.createDataFrame(rows, "l array<string>, r array<string>").select(best_of_names(F.col("l"), F.col("r")).alias("s")).collect()]
    both = min(plain_jaro_winkler("MARTHA", "MARHTA"), plain_jaro_winkler("AHTRAM", "ATHRAM"))
    assert float(got[0]) == round(100 * both, 2) and got[1] is None and got[2] is None and float(got[3]) == 100


def test_fixed_values():
    """Literal numbers and lists, for the twins take them from the same place as the code."""
    from dataclasses import asdict

    from mergewright.plans.params import Params

    assert asdict(Params()) == {
        "max_block": 200, "max_pairs": 2_000_000, "weight_name": 40, "weight_address": 15, "weight_postcode": 10, "weight_city": 5, "weight_phone": 15, "weight_email": 15, "weight_website": 10,
        "alt_name_cap": 90, "low_jaccard": 0.5, "low_jaccard_cap": 70, "rare_max": 3, "shared_max": 10, "shared_factor": 0.5, "id_shared_max": 3, "auto_score": 85, "auto_name": 85, "auto_jaccard": 0.75,
        "second_address": 85, "review_score": 75, "id_conflict_cap": 40, "id_conflict_review_name": 95, "shared_contact_name": 90, "max_rounds": 30, "large_cluster": 10, "true_id_max": 3,
        "thresholds": (50, 55, 60, 65, 70, 75, 80, 85, 90, 95), "expected_raw_charities": None, "expected_raw_companies": None, "expected_charities": None, "expected_companies": None,
    }
    assert dict(X.LEGAL_FORMS) == {"LIMITED": "LTD", "INCORPORATED": "INC", "COMPANY": "CO"}
    assert dict(X.STREET_TYPES) == {"STREET": "ST", "ROAD": "RD", "AVENUE": "AVE", "DRIVE": "DR", "PLACE": "PL", "CRESCENT": "CRES", "TERRACE": "TCE"}
    assert len(X.TRAILING) == 8 and len(X.LEADING) == 4 and len(X.GENERIC_EMAIL_DOMAINS) == 10 and len(X.GENERIC_HOSTS) == 7


def test_scratch_tables_go(spark):
    import os

    from mergewright import scratch

    kept, gone = scratch.staged(spark.range(3), "a"), scratch.staged(spark.range(3), "b")
    scratch.drop(gone)
    path = lambda df: df.staged_path.removeprefix("file:")
    assert kept.count() == 3 and not os.path.exists(path(gone)) and os.path.exists(path(kept))
    scratch._drop_the_rest()
    assert not os.path.exists(path(kept))

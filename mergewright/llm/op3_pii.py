"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Payment card numbers (Luhn-valid), telephone numbers, IPv4 addresses, US social security numbers, numeric dates, mail
addresses, account numbers (IBAN) and hexadecimal secrets are validated and then permuted by a keyed Feistel network
within their own format: a card stays a Luhn-valid card with its grouping, an account number gets new check digits, a
date stays a date between 1900 and 2099 in the same order and padding, letters and digits keep their places. Different
values of a format get different pseudonyms, and equal values the same everywhere, so they stay linked across documents.

The key has no default: whoever has it can undo the mapping. The query takes it from the session's setting KEY_SETTING,
or else a random one of the process.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import let

KEY_SETTING = "spark.mergewright.pseudonym.key"
_RANDOM_KEY = secrets.token_hex(32)

#: Finds candidates of all kinds in one pass; a candidate must not touch a letter, digit or a sign that continues it.
KINDS = {
    "mail": r"[A-Za-z0-9][A-Za-z0-9._%+\-]{0,63}@[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?)+",
    "secret": r"(?:[0-9a-f]{32,128}|[0-9A-F]{32,128})(?![A-Za-z0-9])",
    "iban": r"[A-Z]{2}\d{2}(?:(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])",
    # Of a timestamp the date; one sign between all parts.
    "date": "(?:" + "|".join(rf"(?:19|20)\d\d{c}[01]?\d{c}[0-3]?\d|[0-3]?\d{c}[0-3]?\d{c}(?:19|20)\d\d" for c in (r"\-", "/", r"\.")) + r")(?:(?=[Tt]\d\d:?\d\d)|(?![A-Za-z0-9]|[/\-.]\d))",
    "ip": r"(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)",
    "ssn": r"\d{3}-\d{2}-\d{4}(?!\d|-\d)",
    # International; 3-3-4 digits; ten digits as North American numbers have them; with a trunk 0, 9 to 12 digits.
    "phone": r"(?:\+\d(?:[ .\-/]?\(?\d\)?){6,14}(?!\d)|(?:\(\d{3}\)[ .\-]?|\d{3}[ .\-])\d{3}[ .\-]\d{4}(?!\d)|[2-9]\d\d[2-9]\d{6}(?![A-Za-z0-9]|[.\-]\d)"
    r"|(?=\(?0(?:[ .\-/()]{0,2}\d){8,11}(?![ .\-/]?\d))(?:0\d{1,4}|\(0\d{1,4}\))(?:[ .\-/]\d{2,8}){1,4}(?!\d))",
    "card": r"\d(?:[ \-]?\d){12,18}(?![\d])",
}
#: A letter or digit before continues any kind; a digit and a sign before continue numbers, but not mail addresses.
PATTERN = "(?:(?<![A-Za-z0-9])" + KINDS["mail"] + r"|(?<!\d[.\-/+])(?:(?<![A-Za-z0-9])(?:" + "|".join(v for k, v in KINDS.items() if k != "mail") + r")|(?<=[A-Za-z])(?=\+)" + KINDS["phone"] + "))"
#: Country codes of one, two and three digits.
COUNTRY = r"\A\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: A date candidate alone, without what follows it in a text.
DATE = r"\A(?:\d{4}([\-/.])\d\d?\1\d\d?|\d\d?([\-/.])\d\d?\2\d{4})\z"
ROUNDS = 8


def whole(value: Column, kind: str) -> Column:
    return value.rlike(r"\A(?:" + KINDS[kind] + r")\z")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, r"[^0-9]", "")


def luhn_sum(number: Column) -> Column:
    """Sum of Luhn for a string of digits whose last is the check digit."""
    twice = F.transform(
        F.sequence(F.lit(1), F.length(number)),
        lambda i: F.when(i % 2 == 1, F.substr(number, F.length(number) - i + 1, F.lit(1)).cast("int")).otherwise(
            (F.substr(number, F.length(number) - i + 1, F.lit(1)).cast("int") * 2).cast("int")
        ),
    )
    return F.aggregate(twice, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x))


def permute(key: Column, kind: str, value: Column, low: Column, high: Column) -> Column:
    """An alternating Feistel network over [0, low * high): value = a * high + b with a < low, b < high."""

    start = F.struct(F.floor(value / high).cast("long").alias("a"), (value % high).alias("b"))
    state = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, lambda s, i: _round(key, kind, s, i, low, high))
    return F.element_at(F.transform(F.array(state), lambda s: s["a"] * high + s["b"]), 1)


def _round(key: Column, kind: str, s: Column, i: Column, low: Column, high: Column) -> Column:
    """Round i: one half takes up a keyed hash (60 bits of SHA-256) of the other."""
    even = i % 2 == 0
    half, modulus = F.when(even, s["b"]).otherwise(s["a"]), F.when(even, low).otherwise(high)
    word = F.sha2(F.concat_ws(":", key, F.lit(kind), i.cast("string"), half.cast("string")), 256)
    add = F.conv(F.substr(word, F.lit(1), F.lit(15)), 16, 10).cast("long") % modulus
    return F.struct(
        F.when(even, (s["a"] + add) % low).otherwise(s["a"]).alias("a"),
        F.when(even, s["b"]).otherwise((s["b"] + add) % high).alias("b"),
    )


def ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permute_digits(key: Column, kind: str, number: Column) -> Column:
    """A string of up to 18 digits to another of the same length."""
    n = F.length(number)
    low, high = ten_to(F.floor(n / 2).cast("int")), ten_to((n - F.floor(n / 2)).cast("int"))
    return F.lpad(permute(key, kind, number.cast("long"), low, high).cast("string"), n, F.lit("0"))


def refill(shape: Column, number: Column) -> Column:
    """The digits of shape, in order, replaced by those of number."""
    chars = F.split(shape, "")
    place = F.aggregate(
        F.filter(chars, lambda c: c != ""),
        F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
        lambda a, c: F.struct(
            F.concat(a["s"], F.when(c.rlike("[0-9]"), F.substr(number, a["k"], F.lit(1))).otherwise(c)).alias("s"),
            (a["k"] + F.when(c.rlike("[0-9]"), 1).otherwise(0)).cast("int").alias("k"),
        ),
    )
    return place["s"]


def permute_text(key: Column, kind: str, text: Column, alphabet: str | None = None) -> Column:
    """A text in lower case to another of the same shape: digits become digits and letters letters (or characters of an
    alphabet others of it), by a Feistel network over the two halves of these characters; other characters stay.

    In a round each character of a half moves on within its class by a keyed hash of the other half."""
    own = f"[{alphabet}]" if alphabet else "[0-9a-z]"

    def coded(c: Column) -> Column:
        if alphabet:
            return F.struct((F.instr(F.lit(alphabet), c) - 1).alias("v"), F.lit(len(alphabet)).alias("r"))
        return F.when(c.rlike("[0-9]"), F.struct((F.ascii(c) - 48).alias("v"), F.lit(10).alias("r"))).otherwise(F.struct((F.ascii(c) - 97).alias("v"), F.lit(26).alias("r")))

    def moved(half: Column, other: Column, i: Column) -> Column:
        said = F.concat_ws(":", key, F.lit(kind), i.cast("string"), F.array_join(F.transform(other, lambda x: x["v"].cast("string")), ","))
        # 128 hexadecimal digits for 64 characters; longer halves take up more hashes.
        return let(
            F.transform(F.sequence(F.lit(0), F.floor(F.size(half) / 64).cast("int")), lambda k: F.sha2(F.concat_ws(":", said, k.cast("string")), 512)),
            lambda words: F.transform(
                half, lambda x, j: F.struct(((x["v"] + F.conv(F.substr(F.get(words, F.floor(j / 64).cast("int")), j % 64 * 2 + 1, F.lit(2)), 16, 10).cast("int")) % x["r"]).alias("v"), x["r"].alias("r"))
            ),
        )

    def rounds(codes: Column) -> Column:
        n = F.floor(F.size(codes) / 2).cast("int")
        start = F.struct(F.slice(codes, F.lit(1), n).alias("a"), F.slice(codes, n + 1, F.size(codes) - n).alias("b"))
        step = lambda s, i: F.when(i % 2 == 0, F.struct(moved(s["a"], s["b"], i).alias("a"), s["b"].alias("b"))).otherwise(F.struct(s["a"].alias("a"), moved(s["b"], s["a"], i).alias("b")))
        return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step, lambda s: F.concat(s["a"], s["b"]))

    def shown(x: Column) -> Column:
        letters = F.lit(alphabet) if alphabet else F.when(x["r"] == 10, F.lit("0123456789")).otherwise(F.lit("abcdefghijklmnopqrstuvwxyz"))
        return F.substr(letters, x["v"] + 1, F.lit(1))

    def filled(chars: Column) -> Column:
        new = F.transform(rounds(F.transform(F.filter(chars, lambda c: c.rlike(own)), coded)), shown)
        return let(new, lambda n: F.aggregate(
            chars,
            F.struct(F.lit("").alias("s"), F.lit(0).alias("k")),
            lambda a, c: F.when(c.rlike(own), F.struct(F.concat(a["s"], F.get(n, a["k"])).alias("s"), (a["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(a["s"], c).alias("s"), a["k"].alias("k"))),
            lambda a: a["s"],
        ))

    return let(F.filter(F.split(text, ""), lambda c: c != ""), filled)


def cased(new: Column, like: Column) -> Column:
    """new with upper case where `like`, character by character, has it."""
    return F.when(F.lower(like) == like, new).otherwise(
        F.array_join(F.zip_with(F.filter(F.split(new, ""), lambda c: c != ""), F.filter(F.split(like, ""), lambda c: c != ""), lambda x, y: F.when(y.rlike("[A-Z]"), F.upper(x)).otherwise(x)), "")
    )


def mail(key: Column, value: Column) -> Column:
    """Another mail address of the same shape; addresses that differ in case only stay so."""
    return cased(permute_text(key, "mail", F.lower(value)), value)


def secret(key: Column, value: Column) -> Column:
    """Another hexadecimal string of the same length and case."""
    new = permute_text(key, "secret", F.lower(value), "0123456789abcdef")
    return F.when(value.rlike("[A-F]"), F.upper(new)).otherwise(new)


def iban_rest(value: Column) -> Column:
    """Rest modulo 97 of an account number, read from its fifth character round to its fourth; of a valid one it is 1."""
    plain = F.regexp_replace(value, " ", "")
    turned = F.split(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4))), "")
    number = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(F.filter(turned, lambda c: c != ""), F.lit(0), lambda a, c: ((a * F.when(number(c) > 9, 100).otherwise(10) + number(c)) % 97).cast("int"))


def iban(key: Column, value: Column) -> Column:
    """Another account number of the same country and grouping, with its check digits."""
    bare = F.regexp_replace(value, " ", "")
    body = F.upper(permute_text(key, "iban", F.lower(F.substr(bare, F.lit(5)))))
    check = F.lpad((98 - iban_rest(F.concat(F.substr(value, F.lit(1), F.lit(2)), F.lit("00"), body))).cast("string"), 2, "0")
    new = F.concat(F.substr(value, F.lit(1), F.lit(2)), check, body)
    grouped = F.when(value.contains(" "), F.trim(F.regexp_replace(new, "(.{4})", "$1 "))).otherwise(new)
    return grouped


#: Days of the year as month * 100 + day, without 29 February; and those of which each way to write a date can tell.
DAYS = [m * 100 + d for m, last in enumerate((31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31), 1) for d in range(1, last + 1)]
BARE = [x for x in DAYS if x < 1000 or x % 100 < 10]
SMALL = [x for x in DAYS if x < 1000 and x % 100 < 10]
LATE = [x for x in DAYS if x % 100 > 12]
LATE_BARE = [x for x in LATE if x < 1000]


def date(key: Column, value: Column) -> Column:
    """Another date from 1900 to 2099, written alike; null if the value isn't a date.

    The year comes first or last. If last, the day comes before the month where that gives a date, else after it. Each way
    to write a date has its own strings and permutes these: both parts in two digits; none filled up and one of a single
    digit; one filled up and one of a single digit. 29 February stays one, in another leap year.
    """
    parts = F.split(value, r"[\-/.]")
    year_first = F.length(F.get(parts, 0)) == 4
    read = F.struct(
        F.when(year_first, F.get(parts, 1)).otherwise(F.get(parts, 0)).alias("x"),
        F.when(year_first, F.get(parts, 2)).otherwise(F.get(parts, 1)).alias("z"),
        F.when(year_first, F.get(parts, 0)).otherwise(F.get(parts, 2)).cast("int").alias("y"),
        year_first.alias("year_first"),
    )

    def ordered(r: Column) -> Column:
        x, z = r["x"].cast("int"), r["z"].cast("int")
        days = lambda m: F.get(F.lit([31, 28, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]), m - 1) + F.when((m == 2) & (r["y"] % 4 == 0) & (r["y"] != 1900), 1).otherwise(0)
        good = lambda m, d: (m >= 1) & (m <= 12) & (d >= 1) & F.coalesce(d <= days(m), F.lit(False))
        month_first = F.when(r["year_first"], F.lit(True)).otherwise(~good(z, x))
        m, d = F.when(month_first, x).otherwise(z), F.when(month_first, z).otherwise(x)
        zero, bare = r["x"].startswith("0") | r["z"].startswith("0"), (F.length(r["x"]) == 1) | (F.length(r["z"]) == 1)
        return F.when(
            good(m, d),
            F.struct(
                r["x"].alias("x"), r["y"].alias("y"), (m * 100 + d).alias("md"), month_first.alias("month_first"), zero.alias("zero"), bare.alias("bare"),
                F.when(month_first & ~r["year_first"], F.when(bare, F.lit(LATE_BARE)).otherwise(F.lit(LATE))).when(zero & bare, F.lit(SMALL)).when(bare, F.lit(BARE)).otherwise(F.lit(DAYS)).alias("days"),
            ),
        )

    def moved(r: Column) -> Column:
        n = F.size(r["days"])
        place = (r["y"] - 1900) * n + F.array_position(r["days"], r["md"]).cast("int") - 1
        new = permute(key, "date", place.cast("long"), F.lit(200), n.cast("long"))
        plain = let(new, lambda v: F.struct((F.floor(v / n) + 1900).cast("int").alias("y"), F.get(r["days"], (v % n).cast("int")).alias("md")))
        leap = F.struct((permute(key, "leap", F.floor((r["y"] - 1904) / 4).cast("long"), F.lit(7), F.lit(7)) * 4 + 1904).cast("int").alias("y"), r["md"].alias("md"))
        return F.when(r["md"] == 229, leap).otherwise(plain)

    def written(r: Column, new: Column) -> Column:
        sign = F.regexp_extract(value, r"[\-/.]", 0)
        m, d = F.floor(new["md"] / 100).cast("int"), new["md"] % 100
        one, two = F.when(r["month_first"], m).otherwise(d), F.when(r["month_first"], d).otherwise(m)
        wide = lambda v: F.lpad(v.cast("string"), 2, "0")
        fill_first, fill_second = ~r["bare"] | (r["zero"] & r["x"].startswith("0")), ~r["bare"] | (r["zero"] & ~r["x"].startswith("0"))
        a, b = F.when(fill_first, wide(one)).otherwise(one.cast("string")), F.when(fill_second, wide(two)).otherwise(two.cast("string"))
        return F.when(year_first, F.concat(new["y"].cast("string"), sign, a, sign, b)).otherwise(F.concat(a, sign, b, sign, new["y"].cast("string")))

    return let(let(read, ordered), lambda r: F.when(r.isNotNull(), let(moved(r), lambda new: written(r, new))))


def address(key: Column, value: Column) -> Column:
    """Another IPv4 address."""
    number = F.aggregate(F.split(value, r"\."), F.lit(0).cast("long"), lambda a, x: a * 256 + x.cast("long"))
    return let(permute(key, "ip", number, F.lit(65536), F.lit(65536)), lambda v: F.concat_ws(".", *[(F.floor(v / 256**k) % 256).cast("string") for k in (3, 2, 1, 0)]))


def pseudonym(value: Column, key: Column) -> Column:
    """The replacement of a candidate; a candidate that isn't valid stays as it is."""
    d = digits(value)
    card_body = permute_digits(key, "card", F.substr(d, F.lit(1), F.least(F.length(d) - 1, F.lit(18))))
    card = let(card_body, lambda body: refill(value, F.concat(body, ((F.lit(10) - luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))))
    # The country code of a number stays, so that it keeps its format.
    head = F.regexp_extract(value, COUNTRY, 0)
    rest = F.substr(value, F.length(head) + 1)
    phone = F.concat(head, refill(rest, permute_digits(key, "phone", digits(rest))))
    ssn = refill(value, permute_digits(key, "ssn", d))
    valid_ip = whole(value, "ip") & F.forall(F.split(value, r"\."), lambda x: (x.cast("int") <= 255) & (x.cast("int").cast("string") == x))
    return (
        F.when(value.contains("@"), mail(key, value))
        .when(whole(value, "secret") & value.rlike("[A-Fa-f]"), secret(key, value))
        .when(value.rlike("\\A[A-Z]"), F.when(iban_rest(value) == 1, iban(key, value)).otherwise(value))
        .when(value.rlike(DATE), F.coalesce(date(key, value), value))
        .when(valid_ip, address(key, value))
        .when(whole(value, "ssn"), ssn)
        .when(whole(value, "card") & F.length(d).between(13, 19), F.when(luhn_sum(d) % 10 == 0, card).otherwise(value))
        .when(whole(value, "phone"), phone)
        .otherwise(value)
    )


def fresh(name: str, taken: list[str]) -> str:
    """A column name that isn't among those taken; Spark compares names without case."""
    while name.lower() in {t.lower() for t in taken}:
        name += "_"
    return name


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """docs with its text column replaced, and n_found (candidates) and n_changed (long) appended.

    A null text stays null, with zeros. Texts without a candidate stay as they are, as do numbers that fail their check:
    cards, account numbers, dates that don't exist, IPv4 octets over 255 or with leading zeros. All other columns, whatever
    their names but n_found and n_changed, pass through; these two replace columns of that name. Equal rows give equal rows.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    k = F.sha2(F.lit(key), 256)
    plain = docs.drop("n_found", "n_changed")
    old = fresh("found", plain.columns)
    new = fresh("new", [*plain.columns, old])
    found = F.when(F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    out = plain.withColumn(old, F.coalesce(found, F.array().cast("array<string>")))
    out = out.withColumn(new, F.transform(old, lambda v: pseudonym(v, k)))
    pieces = F.split("text", PATTERN, -1)
    text = F.when(F.size(old) == 0, F.col("text")).otherwise(F.array_join(F.zip_with(pieces, F.concat(F.col(new), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""))
    changed = F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x))
    return out.select(*[text.alias("text") if c == "text" else F.col(f"`{c}`") for c in plain.columns], F.size(old).cast("long").alias("n_found"), changed.cast("long").alias("n_changed"))


def session_key(spark: SparkSession) -> str:
    """The key of the session's setting; where it is unset, a random one of this process, so that nobody can undo the mapping later."""
    return spark.conf.get(KEY_SETTING, None) or _RANDOM_KEY


def op3_feistel_pseudonyms(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark))

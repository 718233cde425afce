"""Personal data: validated numbers and dates get keyed pseudonyms of their own format by a Feistel network."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.llm.common import let

ROUNDS = 10
#: What is looked for, in this order at each place. Fixed formats. A repeated group is matched by recursion, so each has a bound
#: (a domain name has 127 labels of 63 characters at most); what may be long is a run of single characters.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"
SECRET = r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}(?![0-9A-Z])|(?i:password|passwd|secret|token|api_?key)\s{0,3}[=:]\s{0,3}[\x22']?[A-Za-z0-9+/_-]{8,})"
PHONE = r"(?<![0-9A-Za-z.+-])(?:\+?1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])"
DATE = r"(?<![0-9A-Za-z.-])[0-9]{4}(?<d>[-/.])[0-9]{2}\k<d>[0-9]{2}(?![0-9A-Za-z-])"
SSN = r"(?<![0-9A-Za-z.-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
IP = r"(?<![0-9A-Za-z.-])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\.[0-9])"
CARD = r"(?<![0-9A-Za-z.-])(?:[0-9]{13,19}|[0-9]{4}(?<c>[ -])[0-9]{4}\k<c>[0-9]{4}\k<c>[0-9]{1,7}|[0-9]{4}(?<x>[ -])[0-9]{6}\k<x>[0-9]{4,5})(?![0-9A-Za-z])"
ANY = "|".join((DATE, EMAIL, SECRET, PHONE, SSN, IP, CARD))
#: Every one of them holds one of these characters; texts without are not searched further.
SIGN = "[0-9@=:]"
#: Dates are permuted among the days of one cycle of the calendar, 27 * 5411 days from this one.
FIRST_DAY, DAYS = "1800-01-01", (27, 5411)


def digest(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *(p.cast("string") for p in parts)), 256)


def feistel(value: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of 0 to a * b - 1: alternating rounds add a digest of one half to the other, modulo its size."""
    half = lambda i, x: F.conv(F.substring(digest(key, tweak, i, x), 1, 15), 16, 10).cast("long")
    start = F.struct(F.call_function("div", value, b).alias("l"), (value % b).alias("r"))

    def step(s: Column, i: Column) -> Column:
        even = F.struct(((s["l"] + half(i, s["r"]) % a) % a).alias("l"), s["r"].alias("r"))
        odd = F.struct(s["l"].alias("l"), ((s["r"] + half(i, s["l"]) % b) % b).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["l"] * b + s["r"])


def long(x: int) -> Column:
    return F.lit(x).cast("long")


def digits_of(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def laid_out(m: Column, digits: Column) -> Column:
    """m with its digits replaced, in order."""
    chars = F.transform(F.sequence(F.lit(1), F.length(m)), lambda i: m.substr(i, F.lit(1)))
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    digit = lambda c: c.rlike("^[0-9]$")
    step = lambda s, c: F.when(digit(c), F.struct(F.concat(s["s"], digits.substr(s["k"], F.lit(1))).alias("s"), (s["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(s["s"], c).alias("s"), s["k"].alias("k")))
    return F.aggregate(chars, start, step, lambda s: s["s"])


def luhn(d: Column) -> Column:
    """The sum of the Luhn check over the digits d, the last one not doubled."""
    n = F.length(d)
    each = F.transform(F.sequence(F.lit(1), n), lambda i: let(d.substr(i, F.lit(1)).cast("int"), lambda x: F.when((n - i) % 2 == 0, x).otherwise(x * 2 - F.when(x > 4, 9).otherwise(0))))
    return F.aggregate(each, F.lit(0), lambda s, x: s + x)


def card(m: Column, key: str) -> Column:
    """Luhn-valid 13 to 19 digits: the first stays, the check digit is computed anew, the others are permuted."""

    def of(d: Column) -> Column:
        n = F.length(d) - 2
        tens = F.array(*(long(10**i) for i in range(11)))
        a, b = F.get(tens, F.call_function("div", n + 1, F.lit(2)).cast("int")), F.get(tens, F.call_function("div", n, F.lit(2)).cast("int"))
        body = F.lpad(feistel(d.substr(F.lit(2), n).cast("long"), a, b, key, F.concat(F.lit("card"), n.cast("string"), d.substr(1, 1))).cast("string"), 17, "0")
        whole = F.concat(d.substr(1, 1), F.substr(body, 18 - n, n), F.lit("0"))
        new = let(whole, lambda w: F.concat(w.substr(F.lit(1), n + 1), ((10 - luhn(w) % 10) % 10).cast("string")))
        return F.when(luhn(d) % 10 == 0, laid_out(m, new)).otherwise(m)

    return let(digits_of(m), of)


def phone(m: Column, key: str) -> Column:
    """The last ten digits are permuted; a country code stays."""

    def of(d: Column) -> Column:
        new = F.lpad(feistel(F.substring(F.right(d, F.lit(10)), 1, 10).cast("long"), long(10**5), long(10**5), key, F.lit("phone")).cast("string"), 10, "0")
        return laid_out(m, F.concat(F.substr(d, F.lit(1), F.length(d) - 10), new))

    return let(digits_of(m), of)


def ssn(m: Column, key: str) -> Column:
    """Area 001 to 899 but 666, group 01 to 99 and serial 0001 to 9999, permuted among these."""

    def of(d: Column) -> Column:
        area, group, serial = (F.substring(d, *at).cast("long") for at in ((1, 3), (4, 2), (6, 4)))
        valid = (area >= 1) & (area <= 899) & (area != 666) & (group > 0) & (serial > 0)
        value = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1

        def shown(v: Column) -> Column:
            at = F.call_function("div", v, long(99 * 9999))
            pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
            return F.concat(pad(at + F.when(at >= 665, 2).otherwise(1), 3), F.lit("-"), pad(F.call_function("div", v, long(9999)) % 99 + 1, 2), F.lit("-"), pad(v % 9999 + 1, 4))

        return F.when(valid, let(feistel(value, long(898), long(99 * 9999), key, F.lit("ssn")), shown)).otherwise(m)

    return let(digits_of(m), of)


def address(m: Column, key: str) -> Column:
    """IPv4 addresses with parts up to 255."""

    def of(p: Column) -> Column:
        value = F.aggregate(p, long(0), lambda s, x: s * 256 + x)
        shown = lambda v: F.concat_ws(".", *(F.shiftrightunsigned(v, k).bitwiseAND(long(255)).cast("string") for k in (24, 16, 8, 0)))
        return F.when(F.forall(p, lambda x: x <= 255), let(feistel(value, long(65536), long(65536), key, F.lit("ip")), shown)).otherwise(m)

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("long")), of)


def date(m: Column, key: str) -> Column:
    """Days of the calendar from 1800 to 2199, year first, with their own separator."""

    def of(day: Column) -> Column:
        value = F.datediff(day, F.lit(FIRST_DAY).cast("date")).cast("long")
        a, b = DAYS
        shown = lambda v: F.replace(F.date_add(F.lit(FIRST_DAY).cast("date"), v.cast("int")).cast("string"), F.lit("-"), m.substr(5, 1))
        return F.when(value.between(0, a * b - 1), let(feistel(value, long(a), long(b), key, F.lit("date")), shown)).otherwise(m)

    iso = F.concat_ws("-", m.substr(1, 4), m.substr(6, 2), m.substr(9, 2))
    return F.coalesce(let(iso.try_cast("date"), of), m)


def email(m: Column, key: str) -> Column:
    """No number: a keyed digest in the format of an address."""
    return let(digest(key, F.lit("email"), F.lower(m)), lambda h: F.concat(F.lit("u"), F.substring(h, 1, 16), F.lit("@x"), F.substring(h, 17, 8), F.lit(".example")))


def secret(m: Column, key: str) -> Column:
    """No number: the value becomes a keyed digest of its length (64 at most); its name stays."""
    name = F.regexp_extract(m, r"^(AKIA|.*?[=:]\s*[\x22']?)(?=[A-Za-z0-9+/_-]+$)", 1)
    value = m.substr(F.length(name) + 1, F.length(m))
    new = let(digest(key, F.lit("secret"), value), lambda h: F.substr(h, F.lit(1), F.length(value)))
    return F.concat(name, F.when(m.startswith("AKIA"), F.upper(new)).otherwise(new))


def pseudonym(m: Column, key: str) -> Column:
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (
        F.when(whole(DATE), date(m, key)).when(m.contains("@"), email(m, key)).when(whole(SECRET), secret(m, key)).when(whole(PHONE), phone(m, key))
        .when(whole(SSN), ssn(m, key)).when(whole(IP), address(m, key)).when(whole(CARD), card(m, key)).otherwise(m)
    )


def pseudonymised(text: Column, key: str) -> Column:
    """struct(text, n): text with its personal data replaced, and how many values were."""
    found = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))

    def of(s: Column) -> Column:
        new = F.transform(s["found"], lambda m: pseudonym(m, key))
        joined = lambda new: F.struct(F.array_join(F.zip_with(s["rest"], F.concat(new, F.array(F.lit(""))), lambda r, x: F.concat(r, x)), "").alias("text"), F.size(F.filter(F.zip_with(s["found"], new, lambda a, b: a != b), lambda x: x)).alias("n"))
        return let(new, joined)

    clean = F.struct(text.alias("text"), F.lit(0).alias("n"))
    return F.when(text.rlike(SIGN) & text.rlike(ANY), let(F.struct(F.split(text, ANY, -1).alias("rest"), found.alias("found")), of)).otherwise(clean)


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """docs with its texts pseudonymised, all columns kept; no shuffle, and nothing in Python.

    The same value gets the same pseudonym in every document, and different numbers or dates of a format get
    different ones, as each format's network is a permutation. Numbers that fail their check (Luhn, octets,
    calendar, area numbers) stay. Null and empty texts stay as they are.
    """
    return docs.withColumn("text", pseudonymised(F.col("text"), key)["text"])


def pii_report(docs: DataFrame, key: str) -> DataFrame:
    """doc_id, text and the number of values replaced, for each row."""
    return docs.select("doc_id", pseudonymised(F.col("text"), key).alias("r")).select("doc_id", "r.text", F.col("r.n").alias("n_replaced"))

"""Personal data: format-preserving pseudonyms by keyed Feistel networks.

Numbers are found by pattern and validated (check digits, octets, calendar dates and the like); those that aren't valid stay.
A valid number is split into two parts, and eight rounds of a Feistel network over the two parts' exact ranges permute it: the
result has the same format, is valid again, and is the same wherever the number occurs, in whatever document, however it is
punctuated. Check digits are made anew. Mail addresses get a keyed name. All of it is built-in expressions; only texts with
a digit or an @ are searched.
"""

from __future__ import annotations

import secrets

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rounds are even, so that the parts keep their ranges. The Spark setting that holds the key.
ROUNDS, SETTING = 8, "spark.colophon.pseudonymKey"

# Forms of the data kinds. Each begins where no letter, digit or the like precedes it, so that a long run of
# characters is tried once.
_MAIL = r"(?<![\p{L}\p{N}_.%+-])[\p{L}\p{N}_.%+-]++@[A-Za-z0-9][A-Za-z0-9-]*+(?:\.[A-Za-z0-9-]++)++"
_HEX = r"(?<![\w])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\w])"
_IBAN = r"(?<![\w])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\w])"
_DATE = r"(?<![\w./-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\w/-]|\.\d)"
_IP = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
_SSN = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
_PHONE = r"(?<![\w+(-])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[.-]\d{3}[.-]\d{4})(?![\w-])"
# groups of digits, 13 digits or more in all, up to a letter or to data of another kind
_CARD = rf"(?<![\w-])(?=\d(?:[ -]?\d){{12}})\d++(?!\w)(?:(?! (?:{_DATE}|{_IP}|{_SSN}|{_PHONE}))[ -]\d++(?!\w))*+"
# Fixed value: first digits and lengths of cards by issuer.
_ISSUED = r"^(?:4(?:\d{12}|\d{15}|\d{18})|5[1-5]\d{14}|2(?:22[1-9]|2[3-9]\d|[3-6]\d{2}|7[01]\d|720)\d{12}|3[47]\d{13}|3(?:0[0-5]|[689]\d)\d{11}|35\d{14}|6(?:011|5\d{2}|4[4-9]\d)\d{12}|62\d{14,17})$"
#: Lengths of cards, the likely ones first.
_LENGTHS = (16, 15, 14, 13, 19, 18, 17)
PATTERN = "|".join((_MAIL, _HEX, _IBAN, _DATE, _IP, _SSN, _PHONE, _CARD))


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def _chars(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def _long(x: Column) -> Column:
    return F.coalesce(x.try_cast("long"), F.lit(0))


def _permute(a: Column, b: Column, range_a: Column, range_b: Column, tag: str, key: str, invert: bool = False) -> Column:
    """struct(a, b): the Feistel network over [0, range_a) x [0, range_b)."""
    parts = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def f(i: Column, x: Column, m: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), F.lit(tag), range_a.cast("string"), range_b.cast("string"), i.cast("string"), x.cast("string"))
        return F.conv(F.substring(F.sha2(seed, 256), 1, 15), 16, 10).cast("long") % m

    def step(s: Column, i: Column) -> Column:
        m = F.when(i % 2 == 1, range_a).otherwise(range_b)  # the range of the part that is replaced
        if invert:
            return F.struct(F.pmod(s["b"] - f(i, s["a"], m), m).alias("a"), s["a"].alias("b"))
        return F.struct(s["b"].alias("a"), ((s["a"] + f(i, s["b"], m)) % m).alias("b"))

    order = F.sequence(F.lit(ROUNDS), F.lit(1), F.lit(-1)) if invert else F.sequence(F.lit(1), F.lit(ROUNDS))
    return F.aggregate(order, parts, step)


def _power(n: Column) -> Column:
    """10 to the n, exactly, as a long (n up to 18)."""
    return F.rpad(F.lit("1"), (n + 1).cast("int"), F.lit("0")).cast("long")


def permuted_digits(d: Column, tag: str, key: str, invert: bool = False) -> Column:
    """A string of 2 to 36 digits, permuted among strings of its length."""
    n = F.length(d)
    half = F.floor(n / 2).cast("int")
    s = _permute(_long(F.substr(d, F.lit(1), half)), _long(F.substr(d, half + 1)), _power(half), _power(n - half), tag, key, invert)
    return F.transform(F.array(s), lambda p: F.concat(F.lpad(p["a"].cast("string"), half, F.lit("0")), F.lpad(p["b"].cast("string"), n - half, F.lit("0"))))[0]


def _refill(form: Column, digits: Column) -> Column:
    """form with its digits replaced, in order, by those of the string `digits`."""
    out = F.aggregate(
        _chars(form), F.struct(F.lit("").alias("s"), F.lit(1).alias("k")),
        lambda acc, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(acc["s"], F.substr(digits, acc["k"], F.lit(1))).alias("s"), (acc["k"] + 1).alias("k"))).otherwise(F.struct(F.concat(acc["s"], c).alias("s"), acc["k"].alias("k"))),
    )
    return out["s"]


def _luhn(d: Column) -> Column:
    """The Luhn sum of a string of digits, from the right."""
    return F.aggregate(
        F.transform(F.reverse(_chars(d)), lambda c, i: F.transform(F.array(c.cast("int") * F.when(i % 2 == 1, 2).otherwise(1)), lambda v: F.when(v > 9, v - 9).otherwise(v))[0]),
        F.lit(0), lambda a, v: a + v,
    )


def _mod97(x: Column) -> Column:
    """The remainder by 97 of a string of digits and capital letters, letters counting from 10."""
    return F.aggregate(
        _chars(x), F.lit(0),
        lambda a, c: F.when(c.rlike("[0-9]"), a * 10 + c.try_cast("int")).otherwise(a * 100 + F.ascii(c) - 55) % 97,
    )


def _runs(m: Column, sep: str, least: int, most: int) -> Column:
    """head, body, tail: the parts of m from its start to a separator whose body has least to most characters without them, longest first."""
    parts = F.split(m, f"(?=[{sep}])")  # a separator begins the part after it
    join = lambda p, a, n: F.array_join(F.slice(p, a, n), "")

    def cut(p: Column) -> Column:
        n = F.size(p)
        runs = F.flatten(F.transform(F.array(F.lit(1)), lambda i: F.transform(F.sequence(i, n), lambda j: F.struct(join(p, F.lit(1), i - 1).alias("head"), join(p, i, j - i + 1).alias("body"), F.when(j < n, join(p, j + 1, n - j)).otherwise(F.lit("")).alias("tail")))))
        # a part's own separator goes to the head
        runs = F.transform(runs, lambda r: F.transform(F.array(F.regexp_extract(r["body"], f"^[{sep}]*", 0)), lambda x: F.struct(F.concat(r["head"], x).alias("head"), F.substr(r["body"], F.length(x) + 1).alias("body"), r["tail"].alias("tail")))[0])
        size = lambda r: F.length(F.regexp_replace(r["body"], f"[{sep}]", ""))
        runs = F.filter(runs, lambda r: size(r).between(least, most))
        return F.transform(F.array_sort(F.transform(runs, lambda r: F.struct((-size(r)).alias("n"), F.length(r["head"]).alias("at"), r.alias("r")))), lambda x: x["r"])

    return F.transform(F.array(parts), cut)[0]


def _best(m: Column, runs: Column, valid, new) -> tuple[Column, Column]:
    """The first valid one of the runs, replaced within m."""
    good = F.filter(runs, lambda r: valid(r["body"]))
    return F.size(good) > 0, F.transform(good, lambda r: F.concat(r["head"], new(r["body"]), r["tail"]))[0]


def _cards(m: Column, key: str) -> Column:
    """struct(shown, n): a chain of groups of digits with its cards replaced, and how many there are.

    A card is a run of whole groups of 13 to 19 digits with a right check digit. Numbers beside it (a year, a check value) don't
    hide it: from left to right, a group begins a card if a run from it is valid. Of several, runs with an issuer's first digits
    and length come first, then the likelier length; another run is taken only if no issuer's card begins inside it.
    """

    def valid(x: Column) -> Column:
        ok = lambda d: F.length(d).between(13, 19) & (_luhn(d) % 10 == 0) & ~d.rlike("^0+$")
        return F.transform(F.array(_digits(x)), ok)[0]

    def new(x: Column) -> Column:
        d = _digits(x)
        body = permuted_digits(F.substr(d, F.lit(1), F.length(d) - 1), "card", key)
        return F.transform(F.array(body), lambda b: _refill(x, F.concat(b, ((10 - _luhn(F.concat(b, F.lit("0"))) % 10) % 10).cast("string"))))[0]

    def replaced(p: Column) -> Column:
        n = F.size(p)
        body = lambda i, j: F.array_join(F.slice(p, i, j - i + 1), "")
        rank = lambda d: F.array_position(F.array(*map(F.lit, _LENGTHS)), F.length(d)).cast("int")

        def best(i: Column) -> Column:
            """struct(other, rank, end) of the run from group i that is taken, or null."""
            ends = F.filter(F.sequence(i, F.least(n, i + 18)), lambda j: valid(body(i, j)))
            return F.array_min(F.transform(ends, lambda j: F.transform(F.array(_digits(body(i, j))), lambda d: F.struct((~d.rlike(_ISSUED)).cast("int").alias("other"), rank(d).alias("rank"), j.alias("end")))[0]))

        def chosen(e: Column) -> Column:
            """For each group the end of its run, or 0."""
            hidden = lambda x, i: (x["other"] == 1) & F.exists(F.slice(e, i + 2, x["end"] - i - 1), lambda y: F.coalesce(y["other"] == 0, F.lit(False)))
            return F.transform(e, lambda x, i: F.when(x.isNull() | hidden(x, i), F.lit(0)).otherwise(x["end"]))

        def walked(e: Column) -> Column:
            # no run crosses the start of a segment, so each is walked by itself, and long chains in proportion to their length
            starts = F.filter(F.sequence(F.lit(1), n), lambda i: ~F.exists(F.slice(e, F.greatest(i - 18, F.lit(1)), F.least(i - 1, F.lit(18))), lambda x: x >= i))
            begin = F.struct(F.lit("").alias("shown"), F.lit(1).alias("next"), F.lit(0).alias("n"))

            def step(s: Column, i: Column) -> Column:
                end, first = F.element_at(e, i), F.element_at(p, i)
                sep = F.regexp_extract(first, "^[ -]", 0)
                taken = F.struct(F.concat(s["shown"], sep, new(F.substr(body(i, end), F.length(sep) + 1))).alias("shown"), (end + 1).alias("next"), (s["n"] + 1).alias("n"))
                plain = F.struct(F.concat(s["shown"], first).alias("shown"), (i + 1).alias("next"), s["n"].alias("n"))
                return F.when(i < s["next"], s).when(end > 0, taken).otherwise(plain)

            def segments(at: Column) -> Column:
                until = lambda k: F.coalesce(F.get(at, k + 1) - 1, n)
                return F.transform(at, lambda i, k: F.aggregate(F.sequence(i, until(k)), begin, step))

            return F.transform(F.array(F.transform(F.array(starts), segments)[0]), lambda x: F.struct(F.array_join(F.transform(x, lambda y: y["shown"]), "").alias("shown"), F.aggregate(x, F.lit(0), lambda a, y: a + y["n"]).alias("n")))[0]

        ends = F.transform(F.sequence(F.lit(1), n), best)
        return F.transform(F.array(F.transform(F.array(ends), chosen)[0]), walked)[0]

    return F.transform(F.array(F.split(m, "(?=[ -])")), replaced)[0]


def _iban(m: Column, key: str) -> tuple[Column, Column]:
    """A capital word after the number doesn't hide it."""

    def valid(x: Column) -> Column:
        d = F.replace(x, F.lit(" "), F.lit(""))
        body = F.substr(d, F.lit(5))
        return (_mod97(F.concat(body, F.substr(d, F.lit(1), F.lit(4)))) == 1) & (F.length(_digits(body)) >= 2)

    def new(x: Column) -> Column:
        d = F.replace(x, F.lit(" "), F.lit(""))
        body = F.substr(d, F.lit(5))
        filled = _refill(body, permuted_digits(_digits(body), "iban", key))
        check = F.transform(F.array(filled), lambda b: F.concat(F.lpad((98 - _mod97(F.concat(b, F.substr(d, F.lit(1), F.lit(2)), F.lit("00")))).cast("string"), 2, "0"), _digits(b)))[0]
        return _refill(x, check)

    return _best(m, _runs(m, " ", 15, 34), valid, new)


def _date(m: Column, key: str) -> tuple[Column, Column]:
    """Days of three eras, each permuted in itself: the years 1 to 1899 (745 x 931 days), from 1900 on (270 x 271), and the rest to
    9999 (2 x 1442647)."""
    iso, first = m.rlike("^\\d{4}-"), F.lit("1900-01-01").cast("date")
    part = lambda at, n: F.substr(m, F.lit(at), F.lit(n))
    make = lambda y, mo, d: F.concat_ws("-", y, mo, d).try_cast("date")
    day_first = make(part(7, 4), part(4, 2), part(1, 2))
    month_first = make(part(7, 4), part(1, 2), part(4, 2))
    date = F.when(iso, m.try_cast("date")).otherwise(F.coalesce(day_first, month_first))
    k = F.datediff(date, first)
    valid = date.isNotNull() & k.between(-693595, 2958463)
    era = lambda early, now, late: F.when(k < 0, F.lit(early)).when(k < 73170, F.lit(now)).otherwise(F.lit(late))
    start, ra, rb = era(-693595, 0, 73170), era(745, 270, 2), era(931, 271, 1442647)
    s = _permute(F.floor((k - start) / rb), (k - start) % rb, ra, rb, "date", key)
    new = F.transform(F.array(s), lambda p: F.date_add(first, (p["a"] * rb + p["b"] + start).cast("int")))
    sep = part(3, 1)
    shown = F.transform(new, lambda d: F.when(iso, F.date_format(d, "yyyy-MM-dd")).when(day_first.isNotNull(), F.concat(F.date_format(d, "dd"), sep, F.date_format(d, "MM"), sep, F.date_format(d, "yyyy"))).otherwise(F.concat(F.date_format(d, "MM"), sep, F.date_format(d, "dd"), sep, F.date_format(d, "yyyy"))))
    return valid, shown[0]


def _ip(m: Column, key: str) -> tuple[Column, Column]:
    o = F.transform(F.split(m, r"\."), lambda x: x.try_cast("int"))
    valid = F.forall(o, lambda x: x <= 255)
    s = _permute(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), "ip", key)
    return valid, F.transform(F.array(s), lambda p: F.concat_ws(".", F.floor(p["a"] / 256), p["a"] % 256, F.floor(p["b"] / 256), p["b"] % 256))[0]


def _ssn(m: Column, key: str) -> tuple[Column, Column]:
    """Areas 001 to 899 but 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (_long(F.split(m, "-")[k]) for k in range(3))
    valid = area.between(1, 899) & (area != 666) & (group >= 1) & (serial >= 1)
    rank = F.when(area < 666, area - 1).otherwise(area - 2)
    s = _permute(rank, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), "ssn", key)
    shown = F.transform(F.array(s), lambda p: F.concat_ws("-", F.lpad(F.when(p["a"] < 665, p["a"] + 1).otherwise(p["a"] + 2).cast("string"), 3, "0"), F.lpad((F.floor(p["b"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((p["b"] % 9999 + 1).cast("string"), 4, "0")))
    return valid, shown[0]


def _phone(m: Column, key: str) -> tuple[Column, Column]:
    """A country code after + stays."""
    d = _digits(m)
    code = F.length(F.regexp_extract(m, r"^\+(\d{1,3})", 1))
    valid = F.length(d).between(7, 15) & (F.length(d) - code >= 6)
    return valid, _refill(m, F.concat(F.substr(d, F.lit(1), code), permuted_digits(F.substr(d, code + 1), "phone", key)))


def _secret(m: Column, key: str) -> tuple[Column, Column]:
    """Hexadecimal digits; the two halves are added digit by digit, modulo 16."""
    low = F.lower(m)
    half = F.floor(F.length(low) / 2).cast("int")

    def add(x: Column, y: Column) -> Column:
        digit = lambda c: F.conv(c, 16, 10).cast("int")
        return F.array_join(F.zip_with(_chars(x), _chars(y), lambda c, d: F.lower(F.hex((digit(c) + digit(d)) % 16).substr(-1, 1))), "")

    def stream(s: Column, i: Column) -> Column:
        """Hexadecimal digits, as many as the part that is replaced has."""
        parts = F.transform(F.sequence(F.lit(0), F.floor(F.length(s["a"]) / 64).cast("int")), lambda k: F.sha2(F.concat_ws("|", F.lit(key), F.lit("secret"), F.length(low).cast("string"), i.cast("string"), k.cast("string"), s["b"]), 256))
        return F.substr(F.array_join(parts, ""), F.lit(1), F.length(s["a"]))

    def step(s: Column, i: Column) -> Column:
        return F.struct(s["b"].alias("a"), add(s["a"], stream(s, i)).alias("b"))

    s = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(F.substr(low, F.lit(1), half).alias("a"), F.substr(low, half + 1).alias("b")), step)
    new = F.concat(s["a"], s["b"])
    return m.rlike("[0-9]") & m.rlike("[a-fA-F]"), F.when(m.rlike("[A-F]"), F.upper(new)).otherwise(new)


def _mail(m: Column, key: str) -> tuple[Column, Column]:
    return F.lit(True), F.concat(F.lit("user-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("mail"), F.lower(m)), 256), 1, 16), F.lit("@mail.invalid"))


def _replaced(m: Column, key: str) -> Column:
    """struct(kind, shown, n) of a match; kind is null if it isn't valid, n counts what is replaced."""
    kinds = [("mail", _MAIL, _mail), ("secret", _HEX, _secret), ("iban", _IBAN, _iban), ("date", _DATE, _date), ("ip", _IP, _ip), ("ssn", _SSN, _ssn), ("phone", _PHONE, _phone)]
    none = F.struct(F.lit(None).cast("string").alias("kind"), m.alias("shown"), F.lit(0).alias("n"))
    cards = F.transform(F.array(_cards(m, key)), lambda c: F.struct(F.when(c["n"] > 0, F.lit("card")).alias("kind"), c["shown"].alias("shown"), c["n"].alias("n")))[0]
    out = F.when(m.rlike(f"^(?:{_CARD})$"), cards).otherwise(none)
    for kind, pattern, rule in reversed(kinds):
        valid, shown = rule(m, key)
        out = F.when(m.rlike(f"^(?:{pattern})$") & F.coalesce(valid, F.lit(False)), F.struct(F.lit(kind).alias("kind"), shown.alias("shown"), F.lit(1).alias("n"))).otherwise(out)
    return out


def key_of(spark: SparkSession) -> str:
    """The key in the Spark setting SETTING; where that is unset, a random one for this call, so that nothing can be inverted."""
    return spark.conf.get(SETTING, None) or secrets.token_hex(32)


def pseudonymise(docs: DataFrame, key: str, keep: list[str] | None = None) -> DataFrame:
    """Columns `keep` of docs (doc_id, if not given), with text (pseudonymised), n_found and kinds, for each row.

    kinds: the sorted distinct kinds found (mail, secret, iban, date, ip, ssn, card, phone). A null text stays null, with
    nothing found; texts without personal data come out as they are. The same key gives the same pseudonyms. Not found are what
    fails its check, numbers of other lengths than their standards allow, and hexadecimal runs of less than 32 digits. Texts are read whole, and in time in proportion to
    their length. Repeated rows come out as often as they go in; null ids are kept; other columns are ignored.
    """
    keep = keep or ["doc_id"]
    likely = F.col("text").rlike("[0-9@]")
    rows = docs.select(*keep, "text", F.when(likely, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("_found"))
    rows = rows.withColumn("_new", F.when(F.size("_found") > 0, F.transform("_found", lambda m: _replaced(m, key))))
    # the gaps between matches, and what stands for each match
    gaps = F.split("text", PATTERN, -1)
    filled = F.array_join(F.zip_with(gaps, F.transform("_new", lambda x: x["shown"]), lambda g, x: F.concat(g, F.coalesce(x, F.lit("")))), "")
    valid = F.filter(F.transform("_new", lambda x: x["kind"]), lambda x: x.isNotNull())
    found = F.coalesce(F.aggregate("_new", F.lit(0), lambda a, x: a + x["n"]), F.lit(0))
    return rows.select(
        *keep, F.when(F.col("_new").isNull(), F.col("text")).otherwise(filled).alias("text"), found.alias("n_found"),
        F.coalesce(F.array_sort(F.array_distinct(valid)), F.array().cast("array<string>")).alias("kinds"),
    )

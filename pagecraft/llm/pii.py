"""Format-preserving pseudonyms for personal numbers, dates and addresses.

One pass over a text finds e-mail addresses, IPv4 addresses, dates, card numbers, IBANs, social-security-like numbers and
phone numbers. What passes its kind's check (calendar, Luhn, mod 97, octets up to 255, areas and groups in use, numbering plans) is
permuted by a keyed Feistel network within its own format: the separators stay, check digits are made anew, a date becomes
a date of the same 400-year cycle, letters become letters and digits digits. The permutation depends on the key and
the value alone, so equal values stay linked across documents, also when their separators differ.

Rounds add a keyed SHA-256 of one half to the other, modulo its size; the halves may differ in size, so any product of
two sizes is a domain and no value has to be walked on.

A phone number has a plus, a country code in use and 8 to 15 digits; or, without a plus, the shape of a national plan: North American
groups and leading digits, a trunk zero with 9 to 12 digits, an area of three digits ahead of seven, or three groups and more of two
to four digits (the last up to five) with one separator and 8 to 12 digits, not all years. Country codes and trunk digits stay, and
North American numbers become such numbers. Ranges of years, decimals and version numbers have none of these shapes. An e-mail's domain
stays, as it names a provider; letters keep their case.

Defined results: a null text stays null, without findings; repeated rows each give a row with the same pseudonyms;
of overlapping findings the leftmost counts, and of kinds that fit one finding the first of RULES; what fails its check stays as it
is; long texts are worked on whole, in time that grows with their length; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagecraft.llm.common import let

KEY = "pagecraft-demo-key"
ROUNDS = 8
#: Anchored and possessive, with the lengths that names may have, so that a long run of letters is read once.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,63}"
IPV4 = r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d.]*\d)"
IBAN = r"\b[A-Z]{2}\d{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
CARD = r"(?<![\d-])\d(?:[ -]?\d){12,18}(?!\d)"
_PLUS_AREA = "|".join(rf"\d{{{c}}}[ .-]?\(\d{{{a}}}\)(?:[ .-]?\d){{{max(1, 7 - c - a)},{15 - c - a}}}" for c in (1, 2, 3) for a in (1, 2, 3, 4, 5))
_AREA = "|".join(rf"\(\d{{{a}}}\)[ .-]?\d(?:(?:[ .-](?=\d{{2}}))?\d){{{6 - a},{14 - a}}}" for a in (2, 3, 4, 5))
#: 7 to 15 digits in groups of any length: after a plus, also groups of one digit; after an area code in parentheses; or two groups at least.
PHONE = "|".join(
    [
        rf"(?<![\d+])\+(?:{_PLUS_AREA}|\d(?:[ .-]?\d){{6,14}})(?!\d)",
        rf"(?<![\d+])(?:{_AREA})(?!\d)",
        r"(?<![\d+])(?<!\d[.-])(?:1[ .-](?=\d{3}[ .-]))?(?=\d{2,}[ .-]\d{2})\d(?:(?:[ .-](?=\d{2}))?\d){6,14}(?!\d)",
    ]
)
FINDABLE = "|".join(
    [
        f"(?:{EMAIL})",
        f"(?:{IPV4})",
        f"(?:{IBAN})",
        r"(?:(?<!\d)\d{4}(?:-\d{2}-|/\d{2}/|\.\d{2}\.)\d{2}(?!\d))",
        r"(?:(?<!\d)\d{2}(?:-\d{2}-|/\d{2}/|\.\d{2}\.)\d{4}(?!\d))",
        f"(?:{SSN})",
        f"(?:{CARD})",
        f"(?:{PHONE})",
    ]
)
# The country codes in use, by zones.
COUNTRY = r"^(1|7|20|27|2[1-69]\d|3[0-469]|3[578]\d|4[013-9]|42\d|5[1-8]|5[09]\d|6[0-6]|6[7-9]\d|8[1246]|8[058]\d|9[0-58]|9[67]\d|99[2-68])"
#: Area and exchange of a North American number, and its sizes as a product.
AMERICAN = r"^[2-9]\d\d[2-9]\d{6}$"
DIGITS = "0123456789"
LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Days of the Gregorian cycle of 400 years, as a product of two sizes.
CYCLE, CYCLE_LOW = 146097, 773
UNIX_DAYS_BEFORE = 719528  # days from 0000-01-01 to 1970-01-01


def _prf(*parts: Column) -> Column:
    """52 bits of a keyed SHA-256."""
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def feistel(value: Column, high: Column, low: Column, tweak: Column, key: str = KEY, rounds: int = ROUNDS) -> Column:
    """A keyed permutation of 0..high*low-1."""
    start = F.struct(F.floor(value / low).cast("long").alias("a"), (value % low).cast("long").alias("b"))

    def step(acc: Column, r: Column) -> Column:
        onto_a = F.pmod(acc["a"] + _prf(F.lit(key), tweak, r, high, low, acc["b"]) % high, high)
        onto_b = F.pmod(acc["b"] + _prf(F.lit(key), tweak, r, high, low, acc["a"]) % low, low)
        return F.struct(F.when(r % 2 == 1, onto_a).otherwise(acc["a"]).alias("a"), F.when(r % 2 == 0, onto_b).otherwise(acc["b"]).alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, step, lambda acc: acc["a"] * low + acc["b"])


def _power(radix: int, n: Column) -> Column:
    return F.aggregate(F.array_repeat(F.lit(radix).cast("long"), n), F.lit(1).cast("long"), lambda a, x: a * x)


def permute_symbols(symbols: Column, alphabet: str, kind: str, key: str = KEY) -> Column:
    """A string over the alphabet, permuted among those of its length; 10 symbols at a time, each run tweaked by
    the runs before it."""
    radix = len(alphabet)

    def run(piece: Column, before: Column) -> Column:
        n = F.char_length(piece)
        number = F.aggregate(F.split(piece, ""), F.lit(0).cast("long"), lambda a, c: a * radix + (F.instr(F.lit(alphabet), c) - 1))
        half = F.floor(n / 2).cast("int")
        out = feistel(number, _power(radix, half), _power(radix, n - half), F.concat_ws(":", F.lit(kind), n, before), key)
        digits = F.aggregate(
            F.sequence(F.lit(1), n),
            F.struct(out.alias("left"), F.lit("").alias("text")),
            lambda a, _: F.struct(
                F.floor(a["left"] / radix).cast("long").alias("left"),
                F.concat(F.substring(F.lit(alphabet), (a["left"] % radix + 1).cast("int"), F.lit(1)), a["text"]).alias("text"),
            ),
            lambda a: a["text"],
        )
        return F.when(n > 0, digits).otherwise(F.lit(""))

    pieces = F.regexp_extract_all(symbols, F.lit(".{1,10}"), F.lit(0))
    return F.aggregate(pieces, F.struct(F.lit("").alias("seen"), F.lit("").alias("text")), lambda a, p: F.struct(F.concat(a["seen"], p).alias("seen"), F.concat(a["text"], run(p, a["seen"])).alias("text")), lambda a: a["text"])


def _refill(format_: Column, symbols: Column, pattern: str) -> Column:
    """format_ with its characters that match pattern replaced, in order, by those of symbols."""
    start = F.struct(F.lit("").alias("text"), F.lit(1).alias("i"))

    def step(acc: Column, c: Column) -> Column:
        hit = F.rlike(c, F.lit(pattern))
        return F.struct(F.concat(acc["text"], F.when(hit, F.substring(symbols, acc["i"], F.lit(1))).otherwise(c)).alias("text"), (acc["i"] + hit.cast("int")).alias("i"))

    return F.aggregate(F.split(format_, ""), start, step, lambda acc: acc["text"])


def _only(value: Column, drop: str) -> Column:
    return F.regexp_replace(value, drop, "")


def _luhn_sum(digits: Column, shift: int) -> Column:
    """The Luhn sum; shift 0: the last digit counts once, 1: it is doubled."""
    places = F.split(F.reverse(digits), "")
    twice = lambda d: F.when(d * 2 > 9, d * 2 - 9).otherwise(d * 2)
    return F.aggregate(F.transform(places, lambda c, i: F.when((i + shift) % 2 == 1, twice(c.cast("int"))).otherwise(c.cast("int"))), F.lit(0), lambda a, x: a + x)


def _mod97(text: Column) -> Column:
    """The IBAN remainder: letters count as 10..35, the first four characters move to the end."""
    moved = F.concat(F.substring(text, F.lit(5), F.char_length(text)), F.substring(text, 1, 4))
    each = F.transform(F.split(moved, ""), lambda c: F.instr(F.lit(DIGITS + LETTERS.upper()), c) - 1)
    return F.aggregate(each, F.lit(0), lambda a, x: (a * F.when(x > 9, F.lit(100)).otherwise(F.lit(10)) + x) % 97)


def _cards(value: Column) -> tuple[Column, Column]:
    digits = _only(value, "[^0-9]")
    n = F.char_length(digits)
    body = permute_symbols(F.substring(digits, F.lit(1), n - 1), DIGITS, "card")
    check = F.pmod(-_luhn_sum(body, 1), F.lit(10))
    return n.between(13, 19) & (_luhn_sum(digits, 0) % 10 == 0), _refill(value, F.concat(body, check.cast("string")), "[0-9]")


def _dates(value: Column) -> tuple[Column, Column]:
    first = F.rlike(value, F.lit(r"^\d{4}"))
    sep = F.when(first, F.substring(value, 5, 1)).otherwise(F.substring(value, 3, 1))
    year = F.when(first, F.substring(value, 1, 4)).otherwise(F.substring(value, 7, 4)).cast("int")
    a = F.when(first, F.substring(value, 6, 2)).otherwise(F.substring(value, 1, 2)).cast("int")
    b = F.when(first, F.substring(value, 9, 2)).otherwise(F.substring(value, 4, 2)).cast("int")
    # Day first unless only month first is a date; the order found is kept.
    day_first = ~first & F.try_make_timestamp(year, b, a, F.lit(0), F.lit(0), F.lit(0)).isNotNull()
    month, day = F.when(day_first, b).otherwise(a), F.when(day_first, a).otherwise(b)
    when = F.to_date(F.try_make_timestamp(year, month, day, F.lit(0), F.lit(0), F.lit(0)))
    count = F.datediff(when, F.lit("1970-01-01").cast("date")) + UNIX_DAYS_BEFORE
    cycle = F.floor(count / CYCLE)
    moved = feistel((count % CYCLE).cast("long"), F.lit(CYCLE // CYCLE_LOW).cast("long"), F.lit(CYCLE_LOW).cast("long"), F.concat(F.lit("date"), cycle))
    new = F.date_add(F.lit("1970-01-01").cast("date"), (moved + cycle * CYCLE - UNIX_DAYS_BEFORE).cast("int"))
    ymd = F.concat_ws("", F.lpad(F.year(new).cast("string"), 4, "0"), sep, F.date_format(new, "MM"), sep, F.date_format(new, "dd"))
    tail = F.lpad(F.year(new).cast("string"), 4, "0")
    dmy = F.concat(F.date_format(new, "dd"), sep, F.date_format(new, "MM"), sep, tail)
    mdy = F.concat(F.date_format(new, "MM"), sep, F.date_format(new, "dd"), sep, tail)
    return when.isNotNull() & (year > 0), F.when(first, ymd).when(day_first, dmy).otherwise(mdy)


def _octets(value: Column) -> tuple[Column, Column]:
    parts = F.transform(F.split(value, r"\."), lambda x: x.cast("long"))
    number = F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: a * 256 + x)
    out = feistel(number, F.lit(1 << 16).cast("long"), F.lit(1 << 16).cast("long"), F.lit("ip"))
    each = [F.pmod(F.shiftright(out, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    return F.forall(parts, lambda x: x <= 255), F.concat_ws(".", *each)


def _emails(value: Column) -> tuple[Column, Column]:
    local = F.substring_index(value, "@", 1)
    low = F.lower(local)
    letters = permute_symbols(_only(low, "[^a-z]"), LETTERS, "mail")
    digits = permute_symbols(_only(low, "[^0-9]"), DIGITS, "mail")
    filled = _refill(_refill(low, letters, "[a-z]"), digits, "[0-9]")
    cased = F.zip_with(F.split(filled, ""), F.split(local, ""), lambda n, o: F.when(F.rlike(o, F.lit("[A-Z]")), F.upper(n)).otherwise(n))
    return F.lit(True), F.concat(F.array_join(cased, ""), F.lit("@"), F.substring_index(value, "@", -1))


def _ibans(value: Column) -> tuple[Column, Column]:
    text = _only(value, "[^A-Z0-9]")
    digits = permute_symbols(_only(F.substring(text, F.lit(5), F.char_length(text)), "[^0-9]"), DIGITS, "iban")
    letters = F.upper(permute_symbols(F.lower(_only(F.substring(text, F.lit(5), F.char_length(text)), "[^A-Z]")), LETTERS, "iban"))
    bare = _refill(_refill(F.substring(text, F.lit(5), F.char_length(text)), letters, "[A-Z]"), digits, "[0-9]")
    check = F.lit(98) - _mod97(F.concat(F.substring(text, 1, 2), F.lit("00"), bare))
    full = F.concat(F.substring(text, 1, 2), F.lpad(check.cast("string"), 2, "0"), bare)
    return F.char_length(text).between(15, 34) & (_mod97(text) == 1), _refill(value, full, "[A-Z0-9]")


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _ssns(value: Column) -> tuple[Column, Column]:
    """Areas 001 to 899 but 666, groups from 01, serials from 0001; the pseudonym is one of these."""
    area, group, serial = (F.substring(value, at, n).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    ok = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = ((area - F.when(area > 666, 2).otherwise(1)) * 99 + group - 1) * 9999 + serial - 1

    def shown(x: Column) -> Column:
        area = F.floor(x / (99 * 9999)).cast("long")
        parts = ((area + F.when(area >= 665, 2).otherwise(1), 3), (F.floor(x / 9999).cast("long") % 99 + 1, 2), (x % 9999 + 1, 4))
        return F.concat_ws("-", *[F.lpad(n.cast("string"), size, "0") for n, size in parts])

    return ok, let(feistel(place, _long(898 * 99), _long(9999), F.lit("ssn")), shown)


def _phones(value: Column) -> tuple[Column, Column]:
    plus = value.startswith("+")

    def judged(x: Column) -> Column:
        digits, sizes, n = x["digits"], x["sizes"], F.char_length(x["digits"])
        code = F.when(plus, F.regexp_extract(digits, COUNTRY, 1)).when(digits.startswith("0"), "0").when((n == 11) & digits.startswith("1"), "1").otherwise("")
        rest = F.substring(digits, F.char_length(code) + 1, n)
        american = F.rlike(rest, F.lit(AMERICAN)) & code.isin("", "1")
        one = lambda c: F.rlike(value, F.lit(rf"^\d+(?:{c}\d+){{2,}}$"))
        years = F.forall(x["groups"], lambda g: (F.char_length(g) == 4) & g.between("1000", "2099"))
        inner, last = F.slice(sizes, F.lit(1), F.size(sizes) - 1), F.element_at(sizes, -1)
        grouped = (one("-") | one(" ") | one(r"\.")) & F.forall(inner, lambda s: s.between(2, 4)) & last.between(2, 5) & n.between(8, 12) & ~years
        decimal = F.rlike(value, F.lit(r"^\d+\.\d+$"))
        plan = (
            (american & sizes.isin(F.array(F.lit(3), F.lit(3), F.lit(4)), F.array(F.lit(1), F.lit(3), F.lit(3), F.lit(4)), F.array(F.lit(3), F.lit(7))))
            | ((code == "0") & n.between(9, 12) & ~decimal)
            | (F.rlike(value, F.lit(r"^[2-9]\d\d-\d{7}$")))
            | (~value.startswith("(") & grouped)
        )
        abroad = (code != "") & n.between(8, 15) & ((code != "1") | american)
        number = rest.cast("long")
        # Area and exchange start at 2, so the number's place among them is a product of two sizes.
        place = (F.floor(number / 10_000_000) - 200) * 8_000_000 + number % 10_000_000 - 2_000_000

        def dialled(y: Column) -> Column:
            return F.concat((F.floor(y / 8_000_000) + 200).cast("string"), (y % 8_000_000 + 2_000_000).cast("string"))

        new = F.when(american, let(feistel(place, _long(800), _long(8_000_000), F.lit("phone")), dialled)).otherwise(permute_symbols(rest, DIGITS, "phone"))
        return F.struct(F.when(plus, abroad).otherwise(plan).alias("ok"), F.concat(code, new).alias("digits"))

    groups = F.regexp_extract_all(value, F.lit(r"\d+"), F.lit(0))
    facts = F.struct(_only(value, "[^0-9]").alias("digits"), groups.alias("groups"), F.transform(groups, lambda g: F.char_length(g)).alias("sizes"))
    out = let(facts, judged)
    return out["ok"], _refill(value, out["digits"], "[0-9]")


#: Kinds whose shape is theirs alone: what fails their check is nothing else.
OWN_SHAPE = ("date", "ip", "ssn")
#: kind, the pattern that the whole finding has, its check and pseudonym. The first kind that fits decides.
RULES = (
    ("email", f"^{EMAIL}$", _emails),
    ("ip", r"^\d{1,3}(?:\.\d{1,3}){3}$", _octets),
    ("iban", r"^[A-Z]{2}\d{2}", _ibans),
    ("date", r"^(?:\d{4}([-/.])\d{2}\1\d{2}|\d{2}([-/.])\d{2}\2\d{4})$", _dates),
    ("ssn", r"^\d{3}-\d{2}-\d{4}$", _ssns),
    ("card", r"^\d(?:[ -]?\d){12,18}$", _cards),
    ("phone", r"^[+(]|^\d+[ .-]", _phones),
)


def pseudonym(found: Column) -> Column:
    """struct(kind, value) of one finding; kind is null and value unchanged if no check passes."""
    none = F.struct(F.lit(None).cast("string").alias("kind"), found.alias("value"))
    out = none
    for kind, pattern, rule in reversed(RULES):
        ok, new = rule(found)
        hit = F.struct(F.lit(kind).alias("kind"), F.coalesce(new, found).alias("value"))
        fits = F.rlike(found, F.lit(pattern))
        out = F.when(fits & ok, hit).otherwise(out) if kind not in OWN_SHAPE else F.when(fits, F.when(ok, hit).otherwise(none)).otherwise(out)
    return out


def pseudonymised(docs: DataFrame) -> DataFrame:
    """docs with text replaced, and n_pii (long) and kinds (array of strings) added as _n_pii and _kinds."""
    names = [c for c in docs.columns if c != "text"]
    text = F.col("text")
    some = F.coalesce(F.rlike(text, F.lit(r"[0-9@]")), F.lit(False))
    found = F.when(some, F.regexp_extract_all(text, F.lit(FINDABLE), F.lit(0))).otherwise(F.array().cast("array<string>"))
    rows = docs.select(*names, "text", found.alias("_found"))
    rows = rows.withColumn("_new", F.transform("_found", pseudonym))
    between = F.split(text, FINDABLE, -1)
    joined = F.array_join(F.zip_with(between, F.transform("_new", lambda x: x["value"]), lambda b, v: F.concat(b, F.coalesce(v, F.lit("")))), "")
    hits = F.filter("_new", lambda x: x["kind"].isNotNull())
    return rows.select(
        *[F.col(c) for c in names],
        F.when(F.size(hits) > 0, joined).otherwise(text).alias("text"),
        F.size(hits).cast("long").alias("_n_pii"),
        F.transform(hits, lambda x: x["kind"]).alias("_kinds"),
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, text with pseudonyms, n_pii and the count of each kind."""
    out = pseudonymised(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_kinds", lambda x: x == k)).cast("long").alias(f"n_{k}")
    return out.select("doc_id", "text", F.col("_n_pii").alias("n_pii"), *[count(k) for k, _, _ in RULES])

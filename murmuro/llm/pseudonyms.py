"""Format-preserving pseudonyms for validated numbers, dates and addresses, by a keyed Feistel network.

A value becomes an array of symbols with a radix each (digits, letters, bytes, parts of a day number). The
array is halved; in each round one half is shifted, symbol by symbol and modulo its radix, by a hash of
the key, the round and the other half. Every round can be undone with the key, so the whole is a
permutation of the values of one format: equal values stay equal in all documents, different ones different.
DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# Fixed value: the first and last day that counts as a date, a whole cycle of 400 years of 146,097 = 189 * 773 days.
_FIRST_DAY, _DAY_RADICES = "1800-01-01", (189, 773)

# Formats in order of precedence. Digits and letters around a value rule it out.
# A name is all that can be one in front of the @, at most 254 characters with a letter or digit; a domain has at most
# 128 labels. Looking for one only where such a run begins (or the last match ended), possessively, keeps the search
# linear in the text, and the bounded repeat keeps it off the stack.
_NAME = r"[A-Za-z0-9._%+\-]"
EMAIL = (
    rf"(?:(?<!{_NAME})|\G)[._%+\-]*+[A-Za-z0-9]{_NAME}{{0,253}}+@"
    r"[A-Za-z0-9](?:[A-Za-z0-9\-]*[A-Za-z0-9])?(?:\.[A-Za-z0-9\-]++){0,126}\.[A-Za-z]{2,}"
)
IBAN = r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?"
ISO_DATE = r"\d{4}-\d{2}-\d{2}"
DOT_DATE = r"\d{2}\.\d{2}\.\d{4}"
SLASH_DATE = r"\d{2}/\d{2}/\d{4}"
# Days and months of one digit too.
WIDE_ISO, WIDE_DOT, WIDE_SLASH = r"\d{4}-\d{1,2}-\d{1,2}", r"\d{1,2}\.\d{1,2}\.\d{4}", r"\d{1,2}/\d{1,2}/\d{4}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
SSN = r"\d{3}-\d{2}-\d{4}"
PHONE = r"\+1[ .\-]?(?:\(\d{3}\)|\d{3})[ .\-]?\d{3}[ .\-]?\d{4}|\(\d{3}\) ?\d{3}[ .\-]\d{4}|[2-9]\d{2}[.\-][2-9]\d{2}[.\-]\d{4}"
WORLD_PHONE = r"\+[2-9]\d{0,2}(?:[ .\-]?\(?\d{1,4}\)?){2,5}"
CARD = r"\d(?:[ \-]?\d){12,18}"
_EDGE, _END = r"(?<![\p{L}\p{N}_])(?<!\d[.\-/])", r"(?![\p{L}\p{N}_])(?![.\-/]\d)"
_ANY = f"{EMAIL}|{_EDGE}(?:{IBAN}|{PHONE}|{WORLD_PHONE}|{WIDE_ISO}|{WIDE_DOT}|{WIDE_SLASH}|{IP}|{SSN}|{CARD}){_END}"
# A day in front of a time of day.
_ANY += rf"|{_EDGE}{ISO_DATE}(?=T\d{{2}})"
# Tells texts that hold none of these at little cost.
_HINT = r"\d{2}|\d\.\d|@[A-Za-z0-9]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def feistel(symbols: Column, radices: Column, key: str, kind: Column) -> Column:
    """Permute an array of symbols, each below its radix. One symbol alone is shifted by a step that is never 0."""
    n = F.size(symbols)
    cut = F.floor(n / 2).cast("int")
    halves = lambda x: F.array(F.slice(x, F.lit(1), cut), F.slice(x, cut + 1, n - cut))
    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])

    def one(state: Column, i: Column) -> Column:
        # state: the half that moves in this round, the other half, and the radices of both in that order.
        half, other, radix, other_radix = (F.get(state, F.lit(k)) for k in range(4))
        text = F.concat_ws("|", F.lit(key), kind, n, i, F.array_join(other.cast("array<string>"), ","))
        return let(
            F.sha2(text, 256),
            # Four hex digits of the hash per symbol, over again after sixteen symbols.
            lambda hashed: F.array(
                other,
                F.transform(
                    half,
                    lambda x, j: (x + F.conv(F.substr(hashed, (j % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")) % F.get(radix, j),
                ),
                other_radix,
                radix,
            ),
        )

    start = F.concat(halves(symbols), halves(radices))
    # After an even number of rounds the halves are back in their places.
    mixed = F.aggregate(rounds, start, one, lambda s: F.concat(F.get(s, F.lit(0)), F.get(s, F.lit(1))))
    step = lambda radix: 1 + F.conv(F.left(F.sha2(F.concat_ws("|", F.lit(key), kind, n, radix), 256), F.lit(7)), 16, 10).cast("int") % (radix - 1)
    alone = F.zip_with(symbols, radices, lambda x, radix: (x + step(radix)) % radix)
    return F.when(n < 2, alone).otherwise(mixed)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_check_digit(digits: Column) -> Column:
    """The digit that makes a number of the given leading digits pass the Luhn test."""
    total = F.aggregate(
        F.reverse(F.split(digits, "")),
        F.struct(F.lit(0).alias("sum"), F.lit(2).alias("by")),
        lambda s, c: F.struct(
            (s["sum"] + (c.cast("int") * s["by"]) % 10 + F.floor(c.cast("int") * s["by"] / 10).cast("int")).alias("sum"),
            (3 - s["by"]).alias("by"),
        ),
        lambda s: s["sum"],
    )
    return ((10 - total % 10) % 10).cast("string")


def _mod97(text: Column) -> Column:
    """A string of digits and capital letters (A is 10) modulo 97, as IBANs use it."""
    return F.aggregate(
        F.split(text, ""),
        F.lit(0),
        lambda s, c: F.when(c < "A", (s * 10 + F.ascii(c) - 48) % 97).otherwise((s * 100 + F.ascii(c) - 55) % 97),
    )


def _filled(text: Column, place: str, values: Column) -> Column:
    """The text with its characters of the class `place` replaced by those of `values` in turn."""
    out = F.aggregate(
        F.split(text, ""),
        F.struct(F.lit("").alias("text"), F.lit(1).alias("next")),
        lambda s, c: F.when(
            c.rlike(place), F.struct(F.concat(s["text"], F.substr(values, s["next"], F.lit(1))).alias("text"), (s["next"] + 1).alias("next"))
        ).otherwise(F.struct(F.concat(s["text"], c).alias("text"), s["next"].alias("next"))),
        lambda s: s["text"],
    )
    return F.when(F.length(text) == 0, F.lit("")).otherwise(out)


def _days(value: Column, pattern: str) -> Column:
    """Days since the first day, or null where the value is no such date."""
    number = F.date_diff(F.try_to_date(value, pattern), F.lit(_FIRST_DAY).cast("date"))
    return F.when((number >= 0) & (number < _DAY_RADICES[0] * _DAY_RADICES[1]), number)


_DATES = ((ISO_DATE, "yyyy-MM-dd"), (DOT_DATE, "dd.MM.yyyy"), (SLASH_DATE, "MM/dd/yyyy"), (SLASH_DATE, "dd/MM/yyyy"))
_DATES += ((WIDE_ISO, "yyyy-M-d"), (WIDE_DOT, "d.M.yyyy"), (WIDE_SLASH, "M/d/yyyy"), (WIDE_SLASH, "d/M/yyyy"))


def kind_of(value: Column) -> Column:
    """What a matched value is: the format whose test it passes, or null."""
    whole = lambda p: value.rlike(f"^(?:{p})$")
    digits, plain = _digits(value), F.replace(value, F.lit(" "), F.lit(""))
    rotated = F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))
    small = F.forall(F.split(value, r"\."), lambda x: F.length(x).between(1, 3) & (F.lpad(x, 3, "0") < "256"))
    out = F.when(value.contains("@"), "email")
    out = out.when(whole(IBAN) & F.length(plain).between(15, 34) & (F.when(whole(IBAN), _mod97(rotated)) == 1), "iban")
    out = out.when(whole(PHONE), "phone")
    for i, (form, pattern) in enumerate(_DATES):
        out = out.when(whole(form) & _days(F.when(whole(form), value), pattern).isNotNull(), f"date{i}")
    out = out.when(whole(IP) & small, "ip")
    out = out.when(whole(SSN) & ~value.rlike("^(000|666|9)|-00-|-0000$"), "ssn")
    luhn = luhn_check_digit(F.left(digits, F.length(digits) - 1)) == F.right(digits, F.lit(1))
    out = out.when(whole(CARD) & F.when(whole(CARD), luhn), "card")
    return out.when(whole(WORLD_PHONE) & F.length(digits).between(8, 15), "world")


def _fixed_part(value: Column, kind: Column) -> Column:
    """Length of the beginning that stays: the country code of a phone number."""
    code = F.regexp_extract(value, r"^(\+\d{1,3}(?=[ .\-(])|\+\d{2})", 1)
    return F.when(kind == "world", F.length(code)).otherwise(0)


def _moving(value: Column, kind: Column) -> Column:
    """The characters of a value that are permuted, as a string of digits and letters."""
    digits, plain = _digits(value), F.replace(value, F.lit(" "), F.lit(""))
    return (
        F.when(kind == "email", F.regexp_replace(F.substring_index(value, "@", 1), "[^A-Za-z0-9]", ""))
        .when(kind == "iban", F.substr(plain, F.lit(5), F.length(plain)))
        .when(kind == "phone", F.right(digits, F.lit(10)))
        .when(kind == "card", F.substr(digits, F.lit(2), F.length(digits) - 2))
        .when(kind == "world", _digits(F.substr(value, _fixed_part(value, kind) + 1, F.length(value))))
        .otherwise(digits)
    )


def _lowest(c: Column) -> Column:
    return F.when(c <= "9", 48).when(c <= "Z", 65).otherwise(97)


def permuted(value: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a value of a known kind.

    Digits become digits and letters letters of their case; separators, an e-mail address's domain, a card's first
    digit, an IBAN's and a phone number's country stay; check digits are made anew; area and exchange codes
    begin with 2 to 9, or with 0 or 1 where they did; an address part is below 256; a day becomes a day of the
    same 400 years, and may have another number of digits where it is written without zeros.
    """
    days = F.coalesce(*[F.when(kind == f"date{i}", _days(F.when(kind == f"date{i}", value), p)) for i, (_, p) in enumerate(_DATES)])
    big, small = _DAY_RADICES
    characters = F.split(_moving(value, kind), "")
    code = lambda c, j: (kind == "phone") & ((j == 0) | (j == 3)) & (c >= "2")
    no_code = lambda c, j: (kind == "phone") & ((j == 0) | (j == 3)) & (c < "2")
    symbols = (
        F.when(kind.startswith("date"), let(days, lambda d: F.array(F.floor(d / small).cast("int"), (d % small).cast("int"))))
        .when(kind == "ip", F.transform(F.split(value, r"\."), lambda x: x.cast("int")))
        .otherwise(F.transform(characters, lambda c, j: F.ascii(c) - _lowest(c) - F.when(code(c, j), 2).otherwise(0)))
    )
    radices = (
        F.when(kind.startswith("date"), F.array(F.lit(big), F.lit(small)))
        .when(kind == "ip", F.array(*[F.lit(256)] * 4))
        .otherwise(F.transform(characters, lambda c, j: F.when(c <= "9", F.when(code(c, j), 8).when(no_code(c, j), 2).otherwise(10)).otherwise(26)))
    )
    domain = F.regexp_replace(kind, "[0-9]", "")
    moved = let(symbols, lambda s: let(radices, lambda r: feistel(s, r, key, domain)))

    def rebuilt(m: Column) -> Column:
        texts = F.zip_with(
            F.transform(m, lambda x, j: x + F.when(code(F.get(characters, j), j), 2).otherwise(0)), characters, lambda x, c: F.char(x + _lowest(c))
        )
        day = F.date_add(F.lit(_FIRST_DAY).cast("date"), F.get(m, F.lit(0)) * small + F.get(m, F.lit(1)))
        digits, plain = _digits(value), F.replace(value, F.lit(" "), F.lit(""))
        country = F.left(plain, F.lit(2))
        fixed = _fixed_part(value, kind)

        def written_out(t: Column) -> Column:
            lead = F.concat(F.left(digits, F.lit(1)), t)
            check = F.lpad((98 - _mod97(F.concat(t, country, F.lit("00")))).cast("string"), 2, "0")
            return (
                F.when(kind == "email", F.concat(_filled(F.substring_index(value, "@", 1), "[A-Za-z0-9]", t), F.substr(value, F.instr(value, "@"), F.length(value))))
                .when(kind == "iban", _filled(value, "[^ ]", F.concat(country, check, t)))
                .when(kind == "card", _filled(value, "[0-9]", let(lead, lambda x: F.concat(x, luhn_check_digit(x)))))
                .when(kind == "phone", _filled(value, "[0-9]", F.concat(F.left(digits, F.length(digits) - 10), t)))
                .when(kind == "world", F.concat(F.left(value, fixed), _filled(F.substr(value, fixed + 1, F.length(value)), "[0-9]", t)))
                .otherwise(_filled(value, "[0-9]", t))
            )

        out = F.when(kind == "ip", F.array_join(m.cast("array<string>"), "."))
        for i, (_, pattern) in enumerate(_DATES):
            out = out.when(kind == f"date{i}", F.date_format(day, pattern))
        return out.otherwise(let(F.array_join(texts, ""), written_out))

    return let(moved, rebuilt)


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of a matched value, or the value itself when it does not pass its format's test."""
    return let(kind_of(value), lambda kind: F.when(kind.isNull(), value).otherwise(permuted(value, kind, key)))


def pseudonymised(docs: DataFrame, key: str) -> DataFrame:
    """(doc_id, text, n_found, n_replaced): every text with its values replaced.

    `n_found` counts matches of a format, `n_replaced` those that passed the format's test (Luhn for
    cards, mod 97 for IBANs, calendar for dates, ranges for addresses and phone numbers) and whose pseudonym differs.
    A missing text stays missing with counts 0; an empty one stays empty. Rows without a doc_id and
    repeated rows each give a row, and equal values get equal pseudonyms in all of them. Other columns are
    left out. No rows give no rows.
    """
    text = F.col("text")
    holds = text.rlike(_HINT) & text.rlike(_ANY)
    found = F.when(holds, F.regexp_extract_all(text, F.lit(_ANY), 0))
    cut = docs.select("doc_id", text.cast("string").alias("text"), found.alias("found"))
    cut = cut.withColumn("gaps", F.when(F.col("found").isNotNull(), F.split("text", _ANY, -1)))
    cut = cut.withColumn("changed", F.transform("found", lambda v: pseudonym(v, key)))
    joined = F.concat(
        F.element_at("gaps", 1),
        F.array_join(F.zip_with("changed", F.slice("gaps", F.lit(2), F.size("found")), lambda v, g: F.concat(v, g)), ""),
    )
    differs = F.filter(F.zip_with("found", "changed", lambda a, b: a != b), lambda x: x)
    return cut.select(
        "doc_id",
        F.coalesce(joined, "text").alias("text"),
        F.coalesce(F.size("found"), F.lit(0)).cast("bigint").alias("n_found"),
        F.coalesce(F.size(differs), F.lit(0)).cast("bigint").alias("n_replaced"),
    )

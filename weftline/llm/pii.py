"""Format-preserving pseudonyms for personal data, with DataFrame functions alone.

E-mail addresses, phone numbers, IPv4 addresses, payment cards, bank accounts (IBAN), US
social security numbers and dates are found, validated (card and account checksums, number
ranges, calendar) and replaced by a keyed Feistel permutation of the values of their
format.  A pseudonym is a valid value of the same format; equal values get equal pseudonyms
in all documents, whatever their punctuation, and different values different ones, so links
survive.  Only who has the key can reverse it.

A value is a number in Z_a x Z_b; round by round one half is shifted by a keyed hash of the
other, which permutes the domain for any a and b.  Text around the values is untouched, and
numbers that fail validation are no personal data and stay.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: What a value looks like, in order of precedence; Java's notation, without capturing groups.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "ip": rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)",
    "date": r"(?<![\d./-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\d/-]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d.])(?:\d{13,19}|\d{4} \d{4} \d{4} \d{1,7}|\d{4}-\d{4}-\d{4}-\d{1,7}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5})(?!\d)",
    "phone": r"(?<![\w+])(?:\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\+(?!1[ .(-])\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?(?!\d{1,3}\.\d{1,3}\.\d{1,3}\.)\d{2,4}){1,4}|(?:1[ .-])?\(\d{3}\) ?\d{3}[ .-]\d{4}|(?:1[ .-])?\d{3}[.-]\d{3}[.-]\d{4})(?!\d)",
}
ROUNDS = 8
POWERS_10 = [10**k for k in range(19)]
POWERS_26 = [26**k for k in range(13)]
#: The Gregorian calendar repeats after 400 years: 146,097 = 189 * 773 days.
EPOCH, DAYS = "1800-01-01", (189, 773)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with value computed once."""
    return F.transform(F.array(value), body)[0]


def _power(table: list[int], k: Column) -> Column:
    return F.array(*[F.lit(p).cast("bigint") for p in table])[k]


def feistel(a: Column, b: Column, left: Column, right: Column, tweak: Column, key: str) -> Column:
    """A permutation of Z_a x Z_b (each up to 10**18, below the 60 bits of a shift): struct<left, right> of the permuted value."""

    def shifted(x: Column, by: Column, i: Column, size: Column) -> Column:
        digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, i.cast("string"), by.cast("string")), 256)
        return (x + F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint"), size)) % size

    def one_round(s: Column, i: Column) -> Column:
        even = i % 2 == 0
        return F.struct(
            F.when(even, shifted(s["left"], s["right"], i, a)).otherwise(s["left"]).alias("left"),
            F.when(even, s["right"]).otherwise(shifted(s["right"], s["left"], i, b)).alias("right"),
        )

    start = F.struct(left.cast("bigint").alias("left"), right.cast("bigint").alias("right"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, one_round)


def permuted_digits(digits: Column, tweak: Column, key: str) -> Column:
    """A permutation of the digit strings of each length up to 36."""

    def body(d: Column) -> Column:
        n = F.length(d)
        u = F.floor(n / 2).cast("int")
        v = n - u
        left = F.coalesce(F.nullif(F.substr(d, F.lit(1), u), F.lit("")), F.lit("0"))
        right = F.coalesce(F.nullif(F.substr(d, u + 1, v), F.lit("")), F.lit("0"))
        out = feistel(
            _power(POWERS_10, u), _power(POWERS_10, v), left, right, F.concat(tweak, F.lit(":"), n.cast("string")), key
        )
        return let(
            out,
            lambda s: F.concat(
                F.when(u > 0, F.lpad(s["left"].cast("string"), u, F.lit("0"))).otherwise(F.lit("")),
                F.when(v > 0, F.lpad(s["right"].cast("string"), v, F.lit("0"))).otherwise(F.lit(""))
            )
        )

    return let(digits, body)


def _letters(number: Column, n: Column) -> Column:
    places = F.when(n > 0, F.sequence(n - 1, F.lit(0), F.lit(-1))).otherwise(F.array().cast("array<int>"))
    return F.array_join(
        F.transform(
            places,
            lambda k: F.substr(
                F.lit("abcdefghijklmnopqrstuvwxyz"), (_div(number, _power(POWERS_26, k)) % 26 + 1).cast("int"), F.lit(1)
            )
        ),
        ""
    )


def _div(x: Column, y: Column) -> Column:
    """Whole division of bigints."""
    return ((x - x % y).cast("decimal(20,0)") / y.cast("decimal(20,0)")).cast("bigint")


def _number(letters: Column) -> Column:
    chars = F.regexp_extract_all(letters, F.lit("(?s)."), F.lit(0))
    return F.aggregate(chars, F.lit(0).cast("bigint"), lambda a, c: a * 26 + F.ascii(c) - 97)


def permuted_letters(letters: Column, tweak: Column, key: str) -> Column:
    """A permutation of the strings over a-z of each length, 24 letters at a time."""

    def chunk(x: Column, nth: Column) -> Column:
        def body(d: Column) -> Column:
            n = F.length(d)
            u = F.floor(n / 2).cast("int")
            v = n - u
            out = feistel(
                _power(POWERS_26, u), _power(POWERS_26, v), _number(F.substr(d, F.lit(1), u)),
                _number(F.substr(d, u + 1, v)),
                F.concat(tweak, F.lit(":a"), nth.cast("string"), F.lit(":"), n.cast("string")), key
            )
            return let(out, lambda s: F.concat(_letters(s["left"], u), _letters(s["right"], v)))

        return let(x, body)

    parts = F.regexp_extract_all(letters, F.lit("[a-z]{1,24}"), F.lit(0))
    return F.array_join(F.transform(parts, chunk), "")


def filled(form: Column, digits: Column, letters: Column | None = None) -> Column:
    """``form`` with its digits (and, if given, its ASCII letters, of the same case) replaced in order."""

    def step(s: Column, c: Column) -> Column:
        digit = c.rlike("^[0-9]$")
        letter = c.rlike("^[A-Za-z]$") if letters is not None else F.lit(False)
        new_letter = F.substr(letters, s["l"] + 1, F.lit(1)) if letters is not None else c
        cased = F.when(c.rlike("^[A-Z]$"), F.upper(new_letter)).otherwise(new_letter)
        return F.struct(
            F.concat(
                s["out"], F.when(digit, F.substr(digits, s["d"] + 1, F.lit(1))).when(letter, cased).otherwise(c)
            ).alias("out"),
            (s["d"] + digit.cast("int")).alias("d"),
            (s["l"] + letter.cast("int")).alias("l"),
        )

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("d"), F.lit(0).alias("l"))
    return F.aggregate(F.regexp_extract_all(form, F.lit("(?s)."), F.lit(0)), start, step, lambda s: s["out"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn_sum(digits: Column, first: int) -> Column:
    """The Luhn sum; from the right, digits at odd places (``first`` 0) or even places (1) are doubled."""
    values = F.transform(
        F.regexp_extract_all(F.reverse(digits), F.lit("[0-9]"), F.lit(0)),
        lambda c, i: let(
            c.cast("int"), lambda x: F.when((i + first) % 2 == 1, x * 2 - F.when(x > 4, 9).otherwise(0)).otherwise(x)
        )
    )
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _mod_97(account: Column) -> Column:
    def step(a: Column, c: Column) -> Column:
        return F.when(c.rlike("[0-9]"), (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.regexp_extract_all(account, F.lit("[0-9A-Z]"), F.lit(0)), F.lit(0), step)


def _email(x: Column, key: str) -> Column:
    local, domain = F.substring_index(x, "@", 1), F.substring_index(x, "@", -1)
    tweak = F.concat(F.lit("email:"), F.lower(domain))
    letters = F.regexp_replace(F.lower(local), "[^a-z]", "")
    pseudonym = let(
        F.struct(
            permuted_digits(F.substring(_digits(local), 1, 36), tweak, key).alias("d"),
            permuted_letters(letters, tweak, key).alias("l")
        ),
        lambda p: filled(local, F.concat(p["d"], F.substr(_digits(local), F.lit(37), F.lit(64))), p["l"])
    )
    return F.concat(pseudonym, F.lit("@"), domain)


def _iban(x: Column, key: str) -> Column:
    def body(plain: Column) -> Column:
        country, account = F.substring(plain, 1, 2), F.substr(plain, F.lit(5), F.lit(40))
        new = filled(account, permuted_digits(_digits(account), F.concat(F.lit("iban:"), country), key))
        whole = let(
            new, lambda a: F.concat(F.lpad((98 - _mod_97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a)
        )
        # the letters of the form stay: country and bank
        return F.when(
            _mod_97(F.concat(account, F.substring(plain, 1, 4))) == 1, filled(x, let(whole, _digits))
        ).otherwise(x)

    return let(F.replace(x, F.lit(" ")), body)


def _ip(x: Column, key: str) -> Column:
    def body(p: Column) -> Column:
        octet = [p[i].cast("bigint") for i in range(4)]
        out = feistel(
            F.lit(1 << 16).cast("bigint"), F.lit(1 << 16).cast("bigint"), octet[0] * 256 + octet[1],
            octet[2] * 256 + octet[3], F.lit("ip"), key
        )
        return let(
            out,
            lambda s: F.concat_ws(
                ".",
                *[y.cast("string") for half in ("left", "right") for y in (F.shiftright(s[half], 8), s[half] % 256)]
            )
        )

    return let(F.split(x, r"\."), body)


def _date(x: Column, key: str) -> Column:
    iso = x.rlike("^[0-9]{4}-")
    parts = F.split(x, "[-/.]")

    def body(p: Column) -> Column:
        two = lambda c: F.lpad(c, 2, "0")
        first, second = two(p[0]), two(p[1])
        as_date = lambda y, m, d: F.try_to_timestamp(
            F.concat_ws("-", y, m, d), F.lit("yyyy-MM-dd")
        ).cast("date")
        day_first = as_date(p[2], second, first)
        date = F.when(iso, as_date(p[0], p[1], p[2])).otherwise(F.coalesce(day_first, as_date(p[2], first, second)))
        number = F.datediff(date, F.lit(EPOCH).cast("date")).cast("bigint")

        def written(new: Column) -> Column:
            dd, mm, yyyy = (F.date_format(new, f) for f in ("dd", "MM", "yyyy"))
            bare = lambda c, form: F.when(F.length(form) == 1, F.regexp_replace(c, "^0", "")).otherwise(c)
            mark = F.regexp_extract(x, "([/.])", 1)
            a, b = F.when(day_first.isNotNull(), dd).otherwise(mm), F.when(day_first.isNotNull(), mm).otherwise(dd)
            return F.when(iso, F.concat_ws("-", yyyy, mm, dd)).otherwise(
                F.concat(bare(a, p[0]), mark, bare(b, p[1]), mark, yyyy)
            )

        out = feistel(
            F.lit(DAYS[0]).cast("bigint"), F.lit(DAYS[1]).cast("bigint"), _div(number, F.lit(DAYS[1]).cast("bigint")),
            number % DAYS[1], F.lit("date"), key
        )
        new = let(out, lambda s: F.date_add(F.lit(EPOCH).cast("date"), (s["left"] * DAYS[1] + s["right"]).cast("int")))
        return F.when(number.between(0, DAYS[0] * DAYS[1] - 1), let(new, written)).otherwise(x)

    return let(parts, body)


def _ssn(x: Column, key: str) -> Column:
    def body(p: Column) -> Column:
        area, group, serial = (p[i].cast("bigint") for i in range(3))
        valid = ~area.isin(0, 666) & (area < 900) & (group > 0) & (serial > 0)
        index = area - 1 - (area > 666).cast("bigint")
        out = feistel(
            F.lit(898).cast("bigint"), F.lit(99 * 9999).cast("bigint"), index, (group - 1) * 9999 + serial - 1,
            F.lit("ssn"), key
        )
        new = let(
            out,
            lambda s: F.concat_ws(
                "-", F.lpad((s["left"] + 1 + (s["left"] >= 665).cast("bigint")).cast("string"), 3, "0"),
                F.lpad((_div(s["right"], F.lit(9999).cast("bigint")) + 1).cast("string"), 2, "0"),
                F.lpad((s["right"] % 9999 + 1).cast("string"), 4, "0")
            )
        )
        return F.when(valid, new).otherwise(x)

    return let(F.split(x, "-"), body)


def _card(x: Column, key: str) -> Column:
    def body(d: Column) -> Column:
        payload = permuted_digits(F.substr(d, F.lit(1), F.length(d) - 1), F.lit("card"), key)
        new = let(payload, lambda p: F.concat(p, ((10 - luhn_sum(p, 1) % 10) % 10).cast("string")))
        return F.when((luhn_sum(d, 0) % 10 == 0) & d.rlike("[1-9]"), filled(x, new)).otherwise(x)

    return let(_digits(x), body)


#: Country calling codes of one and two digits; all others have three (fixed values).
CALLING_CODES = "1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"


def _phone(x: Column, key: str) -> Column:
    # the country code stays, found by its digits so that punctuation makes no difference
    code = F.coalesce(
        F.nullif(F.regexp_extract(x, rf"^(\+(?:{CALLING_CODES}|\d{{3}}))", 1), F.lit("")),
        F.regexp_extract(x, r"^(1[ .-])", 1)
    )

    def body(rest: Column) -> Column:
        n = F.length(_digits(rest))
        return F.when(
            (n >= 7) & (n <= 15),
            F.concat(code, filled(rest, let(permuted_digits(_digits(rest), F.lit("phone"), key), lambda d: d)))
        ).otherwise(x)

    return let(F.substr(x, F.length(code) + 1, F.length(x)), body)


_PSEUDONYMS = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(hit: Column, key: str) -> Column:
    """The pseudonym of a found value; the value itself where it fails validation."""
    whole = [(kind, hit.rlike(f"^(?:{pattern})$")) for kind, pattern in PATTERNS.items()]
    first, *rest = [(match, _PSEUDONYMS[kind](hit, key)) for kind, match in whole]
    return reduce(lambda case, x: case.when(*x), rest, F.when(*first)).otherwise(hit)


def _searched(text: Column, key: str) -> Column:
    """struct<text, n> of the new text and the number of values replaced; null where there is nothing to search."""
    search = F.lit(rf"(?s)(.*?)(?:({'|'.join(PATTERNS.values())})|\z)")
    pieces = F.arrays_zip(
        F.regexp_extract_all(text, search, F.lit(1)).alias("gap"),
        F.regexp_extract_all(text, search, F.lit(2)).alias("hit")
    )
    changed = F.transform(
        pieces,
        lambda p: F.struct(
            p["gap"].alias("gap"), p["hit"].alias("hit"),
            F.when(p["hit"] == "", "").otherwise(pseudonym(p["hit"], key)).alias("new")
        )
    )
    done = let(
        changed,
        lambda c: F.struct(
            F.array_join(F.transform(c, lambda p: F.concat(p["gap"], p["new"])), "").alias("text"),
            F.size(F.filter(c, lambda p: p["hit"] != p["new"])).alias("n")
        )
    )
    return F.when(text.rlike(r"[0-9]{2}|@|[0-9][./-][0-9]"), done)


def replaced_text(text: Column, key: str) -> Column:
    """The text with its personal data replaced by pseudonyms."""
    return F.coalesce(_searched(text, key)["text"], text)


def pseudonymised(docs: DataFrame, key: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text, n_values)`` of every row.

    n_values counts the values replaced.  Null texts stay null with 0 values, texts without
    personal data stay as they are.  Only texts with two digits or @ are searched.  Rows stay
    rows, repeated and null ids among them; an empty table gives an empty result.  Dates with
    names of months or two-digit years or outside the years 1800 to 2199, IPv6 addresses,
    phone numbers without + or separators and the domains of e-mail addresses stay.
    """
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), _searched(F.col(text), key).alias("done")
    )
    return rows.select(
        "doc_id", F.coalesce("done.text", "text").alias("text"),
        F.coalesce("done.n", F.lit(0)).cast("bigint").alias("n_values")
    )

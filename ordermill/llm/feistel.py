"""Format-preserving pseudonyms of personal data, with DataFrame functions only.

What is found, validated and replaced:

- card numbers of 13 to 19 digits, together or in groups, with a right check digit: the digits before it are permuted
  and the check digit is set anew;
- bank accounts (IBAN) with right check digits: the digits of the account are permuted, check digits set anew;
- social security numbers of valid ranges: permuted within those ranges;
- dates (year-month-day, or day and month before the year with dots or slashes) that exist: permuted within their century;
- phone numbers with country code, or of ten digits in the usual groups: digits after the country code, of one to three
  digits by the international numbering plan, are permuted;
- IPv4 addresses: permuted among all addresses;
- email addresses and hexadecimal secrets of 32, 40 or 64 digits have no small numeric domain: a keyed digest takes
  the place of the name and, in an address, of the domain.

Permutations are generalised Feistel networks over two mixed-radix halves, keyed by SHA-256 of key, kind, domain size,
round and half; the key has no default, as who knows it can undo the permutation. A value has the same pseudonym in all documents, different values of a domain have different ones, and
separators stay where they are. ``restore_digits`` inverts the permutation for who has the key. Dates and numbers that
fail validation are left alone.

Null text stays null, empty text stays empty. Repeated rows are treated alike; other columns pass through; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10

# Country codes of one and of two digits in the international numbering plan (E.164); all others have three.
ONE_DIGIT_CODES = "1 7".split()
TWO_DIGIT_CODES = (
    "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
    "81 82 84 86 90 91 92 93 94 95 98"
).split()

_WORD = r"[\p{L}\p{N}._%+-]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1?\d?\d)"
#: Kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": rf"(?<!{_WORD}){_WORD}++@[\p{{L}}\p{{N}}-]+(?:\.[\p{{L}}\p{{N}}-]+)*\.\p{{L}}{{2,24}}",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?(?![0-9A-Za-z])",
    "phone": (
        r"\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
        r"|\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{1,4}(?:[ .-]?\d{2,4}){1,4}(?!\d)"
        r"|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
    ),
    "card": (
        r"(?<![0-9A-Za-z])\d{4}(?: \d{4}){3}(?![0-9A-Za-z])|(?<![0-9A-Za-z])\d{4}(?:-\d{4}){3}(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z])\d{4}[ -]\d{6}[ -]\d{5}(?![0-9A-Za-z])"
        r"|(?<![0-9A-Za-z])\d{13,19}(?![0-9A-Za-z])"
    ),
    "ssn": r"(?<![\d-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\d-])",
    "date": r"(?<![\d.-])\d{4}-\d{2}-\d{2}(?![\d-])|(?<![\d./])\d{2}(?:\.\d{2}\.|/\d{2}/)\d{4}(?!\d)",
    "ip": rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9A-Fa-f]{64}|[0-9A-Fa-f]{40}|[0-9A-Fa-f]{32})(?![0-9A-Za-z])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
_WORTH = r"[@\d]"


def _draw(key: Column, kind: str, size: Column, turn: Column, half: Column) -> Column:
    """60 keyed bits."""
    text = F.concat_ws("|", key, F.lit(kind), size, turn, half)
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def permuted(value: Column, left: Column, right: Column, key: Column, kind: str, back: bool = False) -> Column:
    """Keyed permutation of 0 .. left * right - 1; ``back`` inverts it."""
    size = F.concat_ws("x", left, right)
    # Decimals, as a quotient of large numbers would not be exact in floating point.
    rest = F.pmod(value, right)
    quotient = (value - rest).cast("decimal(19,0)") / right.cast("decimal(10,0)")
    start = F.struct(quotient.cast("long").alias("l"), rest.alias("r"))
    sign = -1 if back else 1

    def turn(s: Column, t: Column) -> Column:
        l = F.pmod(s["l"] + sign * F.pmod(_draw(key, kind, size, t, s["r"]), left), left)
        r = F.pmod(s["r"] + sign * F.pmod(_draw(key, kind, size, t, s["l"]), right), right)
        return F.when(t % 2 == 0, F.struct(l.alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), r.alias("r")))

    turns = F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    return F.aggregate(F.reverse(turns) if back else turns, start, turn, lambda s: s["l"] * right + s["r"])


def _power(digits: Column) -> Column:
    return F.pow(F.lit(10.0), digits.cast("double")).cast("long")


def permuted_digits(digits: Column, key: Column, kind: str, back: bool = False) -> Column:
    """Text of 1 to 18 digits, permuted among all texts of that length."""
    n = F.length(digits)
    half = F.floor(n / 2).cast("int")
    return F.lpad(
        permuted(digits.cast("long"), _power(half), _power(n - half), key, kind, back).cast("string"), n, "0"
    )


def restore_digits(digits: Column, key: Column, kind: str) -> Column:
    return permuted_digits(digits, key, kind, back=True)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, r"[^0-9]", "")


def refilled(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in order."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("k"))

    def put(s: Column, c: Column) -> Column:
        is_digit = F.rlike(c, F.lit("^[0-9]$"))
        return F.struct(
            F.concat(s["out"], F.when(is_digit, F.substring(digits, s["k"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (s["k"] + F.when(is_digit, 1).otherwise(0)).alias("k"),
        )

    return F.aggregate(F.split(form, ""), start, put, lambda s: s["out"])


def _luhn_sum(digits: Column, offset: int) -> Column:
    """Luhn sum; the last digit is doubled if ``offset`` is 1."""
    def add(s: Column, i: Column) -> Column:
        d = F.substring(F.reverse(digits), i + 1, F.lit(1)).cast("int")
        d = F.when((i + offset) % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)
        return s + d

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def luhn_valid(digits: Column) -> Column:
    return _luhn_sum(digits, 0) % 10 == 0


def _card(m: Column, key: Column) -> Column:
    digits = _digits(m)
    body = permuted_digits(F.left(digits, F.length(digits) - 1), key, "card")
    check = F.pmod(10 - _luhn_sum(body, 1) % 10, F.lit(10))
    return F.when(luhn_valid(digits), refilled(m, F.concat(body, check.cast("string"))))


def _mod97(text: Column) -> Column:
    """Remainder of the number that letters (as 10 to 35) and digits spell."""
    def add(s: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(F.rlike(c, F.lit("^[0-9]$")), F.pmod(s * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(s * 100 + letter, F.lit(97)))

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def _iban(m: Column, key: Column) -> Column:
    plain = F.regexp_replace(m, " ", "")
    country, account = F.left(plain, F.lit(2)), F.substring(plain, F.lit(5), F.lit(40))
    digits = _digits(account)
    # Up to 30 digits: two parts of 18 at most, the second keyed by its place.
    first, second = F.left(digits, F.lit(18)), F.substring(digits, F.lit(19), F.lit(18))
    moved = F.concat(
        F.when(first == "", "").otherwise(permuted_digits(first, key, "iban")),
        F.when(second == "", "").otherwise(permuted_digits(second, key, "iban2")),
    )
    new = refilled(account, moved)
    check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
    # Groups of the form are kept: letters of the account stay in place, all digits are refilled in order.
    valid = _mod97(F.concat(account, F.left(plain, F.lit(4)))) == 1
    return F.when(valid, refilled(m, F.concat(check, moved)))


def _phone(m: Column, key: Column) -> Column:
    digits = _digits(m)
    code = (
        F.when(F.left(digits, F.lit(1)).isin(ONE_DIGIT_CODES), 1)
        .when(F.left(digits, F.lit(2)).isin(TWO_DIGIT_CODES), 2)
        .otherwise(3)
    )
    kept = F.when(F.startswith(m, F.lit("+")), code).otherwise(0)
    moved = F.concat(F.left(digits, kept), permuted_digits(F.substring(digits, kept + 1, F.lit(18)), key, "phone"))
    return F.when(F.length(digits).between(8, 15), refilled(m, moved))


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = (F.substring(m, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    place = area - 1 - F.when(area > 666, 1).otherwise(0)
    value = place * (99 * 9999) + (group - 1) * 9999 + serial - 1
    new = permuted(value, F.lit(898).cast("long"), F.lit(99 * 9999).cast("long"), key, "ssn")
    rest = F.pmod(new, F.lit(99 * 9999))
    place = ((new - rest) / (99 * 9999)).cast("long")
    area = place + 1 + F.when(place >= 665, 1).otherwise(0)
    serial = F.pmod(rest, F.lit(9999))
    group = ((rest - serial) / 9999).cast("long") + 1
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return F.concat_ws("-", pad(area, 3), pad(group, 2), pad(serial + 1, 4))


def _date(m: Column, key: Column) -> Column:
    iso = F.rlike(m, F.lit(r"^\d{4}-"))
    mark = F.substring(m, F.lit(3), F.lit(1))
    as_iso = lambda y, a, b: F.concat_ws("-", F.substring(m, F.lit(y), F.lit(4)), F.substring(m, F.lit(a), F.lit(2)), F.substring(m, F.lit(b), F.lit(2)))
    day_first = as_iso(7, 4, 1).try_cast("date")
    month_first = as_iso(7, 1, 4).try_cast("date")
    day = F.when(iso, m.try_cast("date")).otherwise(F.coalesce(day_first, month_first))
    century = (F.floor(F.year(day) / 100) * 100).cast("int")
    first = F.make_date(century, F.lit(1), F.lit(1))
    leap = century % 400 == 0
    # Days of a century: 36525 = 75 * 487 or 36524 = 92 * 397.
    left = F.when(leap, 75).otherwise(92).cast("long")
    right = F.when(leap, 487).otherwise(397).cast("long")
    new = F.date_add(first, permuted(F.datediff(day, first).cast("long"), left, right, key, "date").cast("int"))
    text = new.cast("string")
    year, month, dom = F.left(text, F.lit(4)), F.substring(text, F.lit(6), F.lit(2)), F.substring(text, F.lit(9), F.lit(2))
    return F.when(
        day.isNotNull() & (century > 0),
        F.when(iso, text)
        .when(day_first.isNotNull(), F.concat(dom, mark, month, mark, year))
        .otherwise(F.concat(month, mark, dom, mark, year)),
    )


def _ip(m: Column, key: Column) -> Column:
    four = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    value = F.aggregate(four, F.lit(0).cast("long"), lambda s, x: s * 256 + x)
    new = permuted(value, F.lit(65536).cast("long"), F.lit(65536).cast("long"), key, "ip")
    return F.concat_ws(".", *(F.shiftright(new, s).bitwiseAND(F.lit(255).cast("long")) for s in (24, 16, 8, 0)))


def _email(m: Column, key: Column) -> Column:
    name = F.substring_index(F.lower(m), "@", 1)
    domain = F.substring_index(F.lower(m), "@", -1)
    code = lambda x, n: F.substring(F.sha2(F.concat_ws("|", key, F.lit("email"), x), 256), 1, n)
    return F.concat(F.lit("u"), code(F.concat(name, F.lit("@"), domain), 16), F.lit("@d"), code(domain, 8), F.lit(".invalid"))


def _secret(m: Column, key: Column) -> Column:
    new = F.left(F.sha2(F.concat_ws("|", key, F.lit("secret"), F.lower(m)), 256), F.length(m))
    return F.when(F.rlike(m, F.lit("[A-F]")), F.upper(new)).otherwise(new)


_MAKERS = {"email": _email, "iban": _iban, "phone": _phone, "card": _card, "ssn": _ssn, "date": _date, "ip": _ip, "secret": _secret}


def _kind(m: Column) -> Column:
    """The first kind that fits the whole match, as the search tried them in the same order."""
    # Looks around a match have nothing to see inside it, so the patterns hold for the match alone.
    return F.coalesce(*(F.when(F.rlike(m, F.lit(rf"^(?:{p})$")), F.lit(k)) for k, p in PATTERNS.items()))


def pseudonym(m: Column, key: Column) -> Column:
    """Struct (kind, value): the pseudonym of a match, or a null kind and the match itself if it is not valid."""
    kind = _kind(m)
    new = F.lit(None).cast("string")
    for name, make in reversed(_MAKERS.items()):
        new = F.when(kind == name, make(m, key)).otherwise(new)
    return F.struct(kind.alias("kind"), m.alias("old"), new.alias("new"))


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` rewritten, and the columns ``kinds`` (kind of every replacement in order) and ``n_replaced``."""
    if not key:
        raise ValueError("pseudonyms need a key")
    text = F.col("text").cast("string")
    worth = F.coalesce(F.rlike(text, F.lit(_WORTH)), F.lit(False))
    nothing = F.array().cast("array<string>")
    found = docs.withColumn("_old", F.when(worth, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(nothing))
    found = found.withColumn("_made", F.transform("_old", lambda m: pseudonym(m, F.lit(key))))
    gaps = F.split(text, ANY, -1)
    new = F.transform("_made", lambda p: F.coalesce(p["new"], p["old"]))
    whole = F.array_join(F.flatten(F.zip_with(gaps, F.concat(new, F.array(F.lit(""))), lambda g, n: F.array(g, n))), "")
    kinds = F.transform(F.filter("_made", lambda p: p["new"].isNotNull()), lambda p: p["kind"])
    return (
        found.withColumn("text", F.when(F.size("_old") > 0, whole).otherwise(text))
        .withColumn("kinds", kinds)
        .withColumn("n_replaced", F.size("kinds").cast("long"))
        .drop("_old", "_made")
    )

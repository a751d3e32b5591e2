"""Personal data by format-preserving pseudonyms (operator 9; DataFrame only).

Candidates are found by pattern, validated, and replaced by a keyed
permutation of their own format, so equal values get equal pseudonyms in every
document and the key alone leads back (``reveal``). A value is brought to one
form before it is permuted, so it stays linked however it is written:

* e-mail addresses, in small letters: letters and digits of the local part and of
  the domain labels before the last, each within its class;
* card numbers (13 to 19 digits, or groups as on cards, that pass the Luhn
  check): the digits before the check digit, which is then computed anew;
* IBANs (valid check digits), in one piece or in groups: the account part, check
  digits computed anew;
* social security numbers (valid area, group and serial): among all valid ones;
* IPv4 addresses (octets up to 255): among all addresses. IPv6 addresses: their
  32 hexadecimal digits, written as eight groups;
* telephone numbers: the last ten digits (with ``+``, all but one if there are no
  more than ten), whatever stands between them;
* dates (valid days of 1800 to 2199 in ISO, point or slash form): among all days
  of these 400 years, which are 339 x 431 days.

The permutation is a Feistel network of ``ROUNDS`` rounds: one half of the
value is shifted by a keyed hash (SHA-256) of the other, characters within
their class, numbers within their range; backwards it is run with the rounds and
shifts reversed. Separators stay as they are. What does not validate stays as it is.

Patterns are bounded (labels and lengths of names by the limits of DNS and mail)
and possessive, so a text of any length and shape is read in one pass and without
recursion. Texts without a digit or an ``@`` are passed through. Everything
is a projection: no shuffle, no state, and the same result in any order.

Defined results: a null text stays null, with counts of 0; an empty text stays
empty; repeated rows each get their row; an empty table gives no rows; other
columns are ignored by ``pseudonymized`` and kept by ``pseudonymize``, but for
one of the name of its own new column (``kinds``), which it replaces. ``reveal`` gives the one form of a value
(an address in small letters, an IPv6 address in eight groups, a date with leading
zeros); a slash date that names the day first can't be told from one that doesn't.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROUNDS = 6
KINDS = ("email", "iban", "ip", "date", "ssn", "card", "phone")
#: The session setting that holds the key, and what is used where it is unset, as in tests.
KEY_SETTING, TEST_KEY = "spark.stepwise.pii.key", "stepwise"

# Lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_GROUPED = "|".join(f"(?:{codes.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, codes in IBAN_LENGTHS.items())

# The candidate patterns, in the order in which they are tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?=[A-Za-z0-9.-]{1,253}+(?![A-Za-z0-9.-]))[A-Za-z0-9-]{1,63}+(?:\.[A-Za-z0-9-]{1,63}+){1,126}+",
    "iban": rf"(?<![A-Za-z0-9])(?=[A-Z]{{2}}[0-9]{{2}}[ A-Z0-9])(?:(?:{_GROUPED})|[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}})(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])|(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f]{0,4}:)(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])",
    "date": r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9]|[./-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])|(?<![0-9+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])",
}
ANY = "|".join(PATTERNS.values())
FIRST_DAY, DAYS = "1800-01-01", (339, 431)
AREAS, SERIALS = 898, 99 * 9999
#: Digits of a telephone number that are permuted.
LINE = 10


def pii_key(spark: SparkSession) -> str:
    """The key of this session. It is part of plans: a cluster that logs these
    sets ``spark.sql.redaction.string.regex`` to it."""
    return spark.conf.get(KEY_SETTING, None) or TEST_KEY


def _digest(key: Column, tag: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", key, F.lit(tag), turn.cast("string"), half).cast("binary"), 256)


def _hex_number(digest: Column, at: Column, size: int) -> Column:
    return F.conv(F.substr(digest, at, F.lit(size)), 16, 10).cast("long")


def _shift_chars(text: Column, digest: Column, way: int) -> Column:
    """Every letter and digit moved within its class by a digest byte, forth or back."""

    def moved(i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        by = _hex_number(digest, F.pmod(i - 1, F.lit(32)) * 2 + 1, 2) * way

        def within(base: str, size: int) -> Column:
            return F.char(F.lit(ord(base)) + F.pmod(F.ascii(c) - F.lit(ord(base)) + by, F.lit(size)))

        return (
            F.when(c.between("0", "9"), within("0", 10))
            .when(c.between("a", "z"), within("a", 26))
            .when(c.between("A", "Z"), within("A", 26))
            .otherwise(c)
        )

    n = F.length(text)
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), moved), "")).otherwise("")


def _turns(inverse: bool) -> Column:
    return F.sequence(F.lit(ROUNDS), F.lit(1)) if inverse else F.sequence(F.lit(1), F.lit(ROUNDS))


def _feistel(text: Column, key: Column, tag: str, inverse: bool, shift: Callable[[Column, Column, int], Column]) -> Column:
    """Over the two halves of a text: ``(l, r)`` becomes ``(r, l + hash(r))``,
    and back. ``shift(text, digest, way)`` moves characters within their class."""
    half = (F.length(text) / 2).cast("int")
    # ROUNDS is even, so the halves end where they began.
    start = F.struct(F.substr(text, F.lit(1), half).alias("l"), F.substr(text, half + 1, F.length(text)).alias("r"))

    def turn(acc: Column, i: Column) -> Column:
        if inverse:
            return F.struct(shift(acc["r"], _digest(key, tag, i, acc["l"]), -1).alias("l"), acc["l"].alias("r"))
        return F.struct(acc["r"].alias("l"), shift(acc["l"], _digest(key, tag, i, acc["r"]), 1).alias("r"))

    return F.aggregate(_turns(inverse), start, turn, lambda a: F.concat(a["l"], a["r"]))


def permute_chars(text: Column, key: Column, tag: str, inverse: bool = False) -> Column:
    """Feistel over the two halves of a text, each character in its class."""
    return _feistel(text, key, tag, inverse, _shift_chars)


def _shift_hex(text: Column, digest: Column, way: int) -> Column:
    def moved(i: Column) -> Column:
        c = F.conv(F.substr(text, i, F.lit(1)), 16, 10).cast("long")
        by = _hex_number(digest, i, 1) * way
        return F.substr(F.lit("0123456789abcdef"), (F.pmod(c + by, F.lit(16)) + 1).cast("int"), F.lit(1))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(text)), moved), "")


def permute_number(number: Column, sizes: tuple[int, int], key: Column, tag: str, inverse: bool = False) -> Column:
    """Feistel over ``0 .. sizes[0] * sizes[1] - 1``."""
    m, n = (F.lit(s).cast("long") for s in sizes)
    number = number.cast("long")
    start = F.struct(F.floor(number / n).cast("long").alias("a"), F.pmod(number, n).alias("b"))
    way = -1 if inverse else 1

    def turn(acc: Column, i: Column) -> Column:
        def by(half: Column) -> Column:
            return _hex_number(_digest(key, tag, i, half.cast("string")), F.lit(1), 12) * way

        odd = F.pmod(i, F.lit(2)) == 1
        return F.struct(
            F.when(odd, F.pmod(acc["a"] + by(acc["b"]), m)).otherwise(acc["a"]).alias("a"),
            F.when(odd, acc["b"]).otherwise(F.pmod(acc["b"] + by(acc["a"]), n)).alias("b"),
        )

    return F.aggregate(_turns(inverse), start, turn, lambda a: a["a"] * n + a["b"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _in_place(shape: Column, chars: Column, but: str = "[^0-9]") -> Column:
    """``shape`` with what does not match ``but`` replaced, in order, by ``chars``."""

    def put(i: Column) -> Column:
        nth = F.length(F.regexp_replace(F.substr(shape, F.lit(1), i), but, ""))
        c = F.substr(shape, i, F.lit(1))
        return F.when(c.rlike(but), c).otherwise(F.substr(chars, nth, F.lit(1)))

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), put), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum, modulo 10, with the last digit as check digit."""
    n = F.length(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return acc + F.when(F.pmod(i, F.lit(2)) == 1, twice).otherwise(d)

    return F.pmod(F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add), F.lit(10))


def _mod97(text: Column) -> Column:
    """A text of digits and capitals (A is 10) as a number, modulo 97."""

    def add(acc: Column, i: Column) -> Column:
        c = F.substr(text, i, F.lit(1))
        letter = F.ascii(c) >= 65
        return F.pmod(
            F.when(letter, acc * 100 + F.ascii(c) - 55).otherwise(acc * 10 + F.ascii(c) - 48), F.lit(97)
        )

    return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)


def _day(m: Column) -> Column:
    """The date that a candidate names, or null."""
    iso = m.rlike("^[0-9]{4}-")
    parts = F.split(m, "[-./]")
    n = [F.get(parts, F.lit(i)).cast("int") for i in range(3)]
    year = F.when(iso, n[0]).otherwise(n[2])
    swap = _month_first(m)
    month = F.when(swap, n[0]).otherwise(n[1])
    day = F.when(iso, n[2]).when(swap, n[1]).otherwise(n[0])
    fits = year.between(1800, 2199) & month.between(1, 12) & (day >= 1)
    last = F.dayofmonth(F.last_day(F.make_date(F.when(fits, year), F.when(fits, month), F.lit(1))))
    return F.when(fits & (day <= last), F.make_date(year, month, day))


def _month_first(m: Column) -> Column:
    """Slash forms name the month first if that can be."""
    return m.contains("/") & (F.get(F.split(m, "[-./]"), F.lit(0)).cast("int") <= 12)


def _write_day(m: Column, day: Column) -> Column:
    """``day`` in the form of ``m`` (a part without leading zero stays so)."""
    iso = m.rlike("^[0-9]{4}-")
    parts = F.split(m, "[-./]")
    mark = F.when(m.contains("/"), "/").otherwise(".")
    swap = _month_first(m)
    d, mo = F.dayofmonth(day).cast("string"), F.month(day).cast("string")

    def like(part: int, value: Column) -> Column:
        return F.when(F.get(parts, F.lit(part)).rlike("^[1-9]$"), value).otherwise(F.lpad(value, 2, "0"))

    first, second = F.when(swap, mo).otherwise(d), F.when(swap, d).otherwise(mo)
    year = F.lpad(F.year(day).cast("string"), 4, "0")
    short = F.concat(like(0, first), mark, like(1, second), mark, year)
    return F.when(iso, F.concat_ws("-", year, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0"))).otherwise(short)


def _groups(m: Column) -> Column:
    """The 32 hexadecimal digits of an IPv6 address, null if it is none: eight
    groups, or fewer and one ``::``, then at least two groups and a digit (so
    that neither a time nor a scope in source text is one)."""
    sides = F.split(m, "::", -1)

    def groups(i: int) -> Column:
        side = F.coalesce(F.get(sides, F.lit(i)), F.lit(""))
        return F.when(side == "", F.array().cast("array<string>")).otherwise(F.split(side, ":", -1))

    head, tail, parted = groups(0), groups(1), F.size(sides) == 2
    n = F.size(head) + F.size(tail)
    zeros = F.array_repeat(F.lit("0"), F.greatest(F.lit(8) - n, F.lit(0)))
    whole = F.concat(head, zeros, tail)
    fits = (~parted & (n == 8)) | (parted & n.between(2, 7) & m.rlike("[0-9]"))
    fits = fits & (F.size(sides) <= 2) & ~F.exists(whole, lambda g: g == "")
    return F.when(fits, F.lower(F.array_join(F.transform(whole, lambda g: F.lpad(g, 4, "0")), "")))


def _octet(m: Column, i: int) -> Column:
    return F.get(F.split(m, r"\."), F.lit(i)).cast("long")


def _number(m: Column, start: int, size: int) -> Column:
    return F.substr(m, F.lit(start), F.lit(size)).cast("long")


def kind_of(m: Column) -> Column:
    """The kind of a candidate that validates, else null."""

    def shaped(kind: str) -> Column:
        return m.rlike(f"^(?:{PATTERNS[kind]})$")

    area = _number(m, 1, 3)
    ssn = (area != 0) & (area != 666) & (area < 900) & (_number(m, 5, 2) != 0) & (_number(m, 8, 4) != 0)
    account = F.replace(m, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(account, F.lit(5), F.length(account)), F.substr(account, F.lit(1), F.lit(4)))
    octets = F.greatest(*[_octet(m, i) for i in range(4)]) <= 255
    address = F.when(m.contains(":"), _groups(m).isNotNull()).otherwise(octets)
    return (
        F.when(m.contains("@"), "email")
        .when(shaped("iban"), F.when(_mod97(moved) == 1, "iban"))
        .when(shaped("ip"), F.when(address, "ip"))
        .when(shaped("date"), F.when(_day(m).isNotNull(), "date"))
        .when(shaped("ssn"), F.when(ssn, "ssn"))
        .when(shaped("card") & (luhn_sum(_digits(m)) == 0), "card")
        .when(shaped("phone"), "phone")
    )


def pseudonym(m: Column, kind: Column, key: Column, inverse: bool = False) -> Column:
    """The replacement of a candidate of a kind; itself if the kind is null.
    ``inverse``: what a replacement was made of."""
    small = F.lower(m)
    head = F.regexp_extract(small, r"^(.*)\.", 1)
    email = F.concat(permute_chars(head, key, "email", inverse), F.substr(small, F.length(head) + 1, F.length(m)))

    digits = _digits(m)
    payload = permute_chars(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card", inverse)
    check = F.pmod(10 - luhn_sum(F.concat(payload, F.lit("0"))), F.lit(10)).cast("string")
    card = _in_place(m, F.concat(payload, check))

    country, compact = F.substr(m, F.lit(1), F.lit(2)), F.replace(m, F.lit(" "), F.lit(""))
    account = permute_chars(F.substr(compact, F.lit(5), F.length(compact)), key, "iban", inverse)
    two = F.lpad((98 - _mod97(F.concat(account, country, F.lit("00")))).cast("string"), 2, "0")
    iban = _in_place(m, F.concat(country, two, account), " ")

    area = _number(m, 1, 3)
    place = F.when(area > 666, area - 2).otherwise(area - 1) * SERIALS + (_number(m, 5, 2) - 1) * 9999 + _number(m, 8, 4) - 1
    new = permute_number(place, (AREAS, SERIALS), key, "ssn", inverse)
    new_area, rest = F.floor(new / F.lit(SERIALS)).cast("long"), F.pmod(new, F.lit(SERIALS).cast("long"))
    ssn = F.concat_ws(
        "-",
        F.lpad((new_area + F.when(new_area >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
        F.lpad((F.floor(rest / 9999) + 1).cast("string"), 2, "0"),
        F.lpad((F.pmod(rest, F.lit(9999).cast("long")) + 1).cast("string"), 4, "0"),
    )

    whole = _octet(m, 0) * (1 << 24) + _octet(m, 1) * (1 << 16) + _octet(m, 2) * (1 << 8) + _octet(m, 3)
    address = permute_number(whole, (1 << 16, 1 << 16), key, "ip", inverse)
    ip4 = F.concat_ws(".", *[F.shiftright(address, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])
    hexed = _feistel(_groups(m), key, "ip6", inverse, _shift_hex)
    ip6 = F.concat_ws(":", *[F.substr(hexed, F.lit(at), F.lit(4)) for at in range(1, 33, 4)])
    ip = F.when(m.contains(":"), ip6).otherwise(ip4)

    n = F.length(digits)
    line = F.least(F.lit(LINE), F.when(m.startswith("+"), n - 1).otherwise(n))
    phone = _in_place(
        m, F.concat(F.substr(digits, F.lit(1), n - line), permute_chars(F.substr(digits, n - line + 1, n), key, "phone", inverse))
    )

    first = F.lit(FIRST_DAY).cast("date")
    ordinal = permute_number(F.datediff(_day(m), first), DAYS, key, "date", inverse)
    date = _write_day(m, F.date_add(first, ordinal.cast("int")))

    made: dict[str, Column] = {"email": email, "iban": iban, "ip": ip, "date": date, "ssn": ssn, "card": card, "phone": phone}
    out = F.when(kind == KINDS[0], made[KINDS[0]])
    for k in KINDS[1:]:
        out = out.when(kind == k, made[k])
    return out.otherwise(m)


def pseudonymize(docs: DataFrame, key: str, *, text: str = "text", kinds: str = "pii", inverse: bool = False) -> DataFrame:
    """``docs`` with the personal data of ``text`` replaced, and a column
    ``kinds`` of the kinds found, in order of place. (Names that begin with
    ``_pii_`` are this operator's own.)"""
    secret = F.lit(key)
    marked = docs.withColumn("_pii_any", F.col(text).rlike("[0-9@]"))
    found = marked.withColumn(
        "_pii_found",
        F.when(F.col("_pii_any"), F.regexp_extract_all(F.col(text), F.lit(ANY), F.lit(0))).otherwise(F.array().cast("array<string>")),
    )
    named = found.withColumn("_pii_kinds", F.transform("_pii_found", kind_of))
    made: Callable = lambda m, i: pseudonym(m, F.get("_pii_kinds", i), secret, inverse)
    new = named.withColumn("_pii_new", F.transform("_pii_found", made))
    between = F.split(F.col(text), ANY, -1)
    glued = F.array_join(F.zip_with(between, F.col("_pii_new"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    some = F.size(F.filter("_pii_kinds", lambda k: k.isNotNull())) > 0
    return new.withColumns({
        text: F.when(some, glued).otherwise(F.col(text)),
        kinds: F.filter("_pii_kinds", lambda k: k.isNotNull()),
    }).drop("_pii_any", "_pii_found", "_pii_kinds", "_pii_new")


def reveal(docs: DataFrame, key: str, *, text: str = "text") -> DataFrame:
    """``docs`` with the pseudonyms of ``text`` led back to their values."""
    return pseudonymize(docs, key, text=text, kinds="_pii_list", inverse=True).drop("_pii_list")


def pseudonymized(docs: DataFrame, key: str) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, text`` without personal data,
    and per kind how many values were replaced."""
    out = pseudonymize(docs.select("doc_id", "text"), key)

    def number(kind: str) -> Column:
        return F.size(F.filter("pii", lambda p: p == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", "text", *map(number, KINDS))

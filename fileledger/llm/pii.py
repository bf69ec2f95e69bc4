"""Format-preserving pseudonyms for personal data.

Validated values (card numbers, IBANs, phone and social security numbers, IPv4 addresses, dates, e-mail addresses, long
hexadecimal secrets) are permuted under a key by Feistel networks within their format: a card number becomes another
card number of that length, a date another date written in that way. The permutation depends on the value alone, so
equal values get equal pseudonyms in all documents, and different ones different ones.

Everything is a DataFrame expression. Halves of strings are shifted character by character, each within its class
(digit, small, capital or hexadecimal letter), by a key stream from SHA-256 of key, round, kind and the other half.
Numbers below ``a * b`` have one half below ``a`` and one below ``b``, each shifted in turn modulo its size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: 400 Gregorian years have 146,097 days, which is 189 times 773.
DAYS = (189, 773)
ADDRESSES = (65_536, 65_536)
#: 898 areas (1 to 899 but 666), 99 groups, 9,999 serial numbers.
SOCIAL = (898 * 99, 9_999)

_DATE = r"(?:\d{4}-\d{1,2}-\d{1,2}|\d{4}/\d{1,2}/\d{1,2}|\d{4}\.\d{1,2}\.\d{1,2}|\d{1,2}-\d{1,2}-\d{4}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})"
#: Lengths of IBANs by country, of the registry and of the countries that use the form without being in it.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FO FI GL NL SD FK", 19: "MK SI", 20: "AT BA EE KZ XK LT LU MN", 21: "HR LV LI CH", 22: "BH BG CR GE DE IE ME RS GB VA",
    23: "GI IQ IL OM SO TL AE", 24: "AD CZ MD PK RO SA SK ES SE TN VG", 25: "PT ST CV GW MZ AO LY", 26: "IS TR DZ IR", 27: "FR GR IT MR MC SM BI DJ CM CF CG GA GQ KM MG TD",
    28: "AL AZ BY CY DO SV GT HU LB NI PL BF BJ CI HN MA ML NE SN TG", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}


def _spaced(countries: str, n: int) -> str:
    """The form of a spaced IBAN of ``n`` characters: groups of four and the rest, and nothing of the words after it."""
    groups, rest = divmod(n - 4, 4)
    return f"(?:{countries.replace(' ', '|')})" + r"\d{2}(?: [A-Z0-9]{4}){%d}" % groups + (" [A-Z0-9]{%d}" % rest if rest else "") + "(?![A-Za-z0-9])"


_KNOWN = "|".join(_spaced(countries, n) for n, countries in _IBAN_LENGTHS.items())
#: Kind, and the whole form of a match; of two kinds that fit, the first holds.
FORMS = [
    ("email", r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}"),
    ("ip", r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)"),
    ("date", r"(?<![\d./-])" + _DATE + r"(?![./-]?\d)"),
    ("iban", r"(?<![A-Za-z0-9])(?:(?=[A-Z]{2}\d{2} )(?:" + _KNOWN + r")|[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9]))"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?!-?\d)"),
    ("phone", r"(?<![\d+])\+1[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"),
    ("phone", r"(?<![\d+])\+[2-9]\d{0,2}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){1,4}(?!\d)"),
    ("phone", r"(?<![\d(-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![.-]?\d)"),
    ("card", r"(?<![A-Za-z0-9])\d{13,19}(?!\d)"),
    ("card", r"(?<![\d-])\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}(?![ -]?\d{4})(?!\d)"),
    ("card", r"(?<![\d-])\d{4}[ -]\d{6}[ -]\d{4,5}(?!\d)"),
    ("secret", r"(?<![A-Za-z0-9])(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![A-Za-z0-9])"),
]
#: Calling codes: of one digit, of two, and all others of three.
_CALLING_CODE = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
ANY_FORM = "|".join(f"(?:{form})" for _, form in FORMS)

_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")


def _prf(key: str, kind: Column, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, turn.cast("string"), half.cast("string")), 256)


def _range(n: Column) -> Column:
    """1 to n; empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))


def _shift(s: Column, stream: Column, hexed: Column) -> Column:
    """Each character of ``s`` moved within its class by its part of the key stream."""

    def one(c: Column, i: Column, stream: Column, hexed: Column) -> Column:
        k = F.conv(F.substr(stream, (i + 1) * 3 % 61 + 1, F.lit(3)), 16, 10).cast("int")
        out = c
        for alphabet in reversed(_ALPHABETS):
            at = F.instr(F.lit(alphabet), c)
            out = F.when(at > 0, F.substr(F.lit(alphabet), (at - 1 + k) % len(alphabet) + 1, F.lit(1))).otherwise(out)
        for alphabet in ("0123456789ABCDEF", "0123456789abcdef"):
            at = F.instr(F.lit(alphabet), c)
            out = F.when((hexed == alphabet[-1]) & (at > 0), F.substr(F.lit(alphabet), (at - 1 + k) % 16 + 1, F.lit(1))).otherwise(out)
        return out

    # characters come from one split, since taking them by place is quadratic in long secrets
    bound = F.struct(stream.alias("stream"), hexed.alias("hexed"))
    shifted = let(bound, lambda b: F.array_join(F.transform(F.split(s, ""), lambda c, i: one(c, i, b["stream"], b["hexed"])), ""))
    return F.when(F.length(s) > 0, shifted).otherwise(F.lit(""))


def permute_string(s: Column, kind: Column, key: str, hexed: Column | None = None) -> Column:
    """``s`` permuted among the strings with the same class of character at each place. ``hexed``: 'f' or 'F' for hexadecimal digits of that case, else ''."""
    hexed = F.lit("") if hexed is None else hexed
    half = F.floor(F.length(s) / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("l"), F.substr(s, half + 1, F.length(s) - half).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda st, turn: F.struct(st["r"].alias("l"), _shift(st["l"], _prf(key, kind, turn, st["r"]), hexed).alias("r")), lambda st: F.concat(st["l"], st["r"]))


def permute_number(v: Column, sizes: tuple[int, int], kind: Column, key: str) -> Column:
    """``v``, a long from 0 to below ``sizes[0] * sizes[1]``, permuted in that range."""
    a, b = sizes
    start = F.struct(F.floor(v / b).cast("long").alias("l"), (v % b).cast("long").alias("r"))

    def turn_of(st: Column, turn: Column) -> Column:
        number = lambda half: F.conv(F.substr(_prf(key, kind, turn, half), F.lit(1), F.lit(15)), 16, 10).cast("long")
        odd = turn % 2 == 1
        return F.struct(F.when(odd, (st["l"] + number(st["r"])) % a).otherwise(st["l"]).alias("l"), F.when(~odd, (st["r"] + number(st["l"])) % b).otherwise(st["r"]).alias("r"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, turn_of, lambda st: st["l"] * b + st["r"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _letters_digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^A-Z0-9]", "")


def luhn_digit(body: Column) -> Column:
    """The check digit after a string of digits."""
    n = F.length(body)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(body, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return ((10 - F.aggregate(_range(n), F.lit(0), add) % 10) % 10).cast("string")


def mod97(s: Column) -> Column:
    """The number that digits and capitals (A is 10) write out, mod 97."""

    def add(total: Column, i: Column) -> Column:
        c = F.ascii(F.substr(s, i, F.lit(1)))
        return F.when(c >= 65, total * 100 + c - 55).otherwise(total * 10 + c - 48) % 97

    return F.aggregate(_range(F.length(s)), F.lit(0), add)


def _overlay(form: Column, fill: Column, keep: str) -> Column:
    """``form`` with its characters of the class ``keep`` replaced, in order, by those of ``fill``."""
    return F.array_join(F.transform(_range(F.length(form)), lambda i: F.when(F.substr(form, i, F.lit(1)).rlike(keep), F.substr(fill, F.length(F.regexp_replace(F.substr(form, F.lit(1), i), "[^" + keep[1:], "")), F.lit(1))).otherwise(F.substr(form, i, F.lit(1)))), "")


def _date_parts(x: Column) -> tuple[Column, Column, Column, Column, Column]:
    """Of a written date: its fields, whether the year is first, whether the day stands before the month, its day, its cycle's first day."""
    f = F.split(x, "[-/.]")
    year_first = F.length(f[0]) == 4
    day_first = ~year_first & ((F.substr(x, F.length(f[0]) + 1, F.lit(1)) == ".") | (f[0].cast("int") > 12))
    year = F.when(year_first, f[0]).otherwise(f[2]).cast("int")
    month = F.when(year_first | day_first, f[1]).otherwise(f[0])
    day = F.when(year_first, f[2]).when(day_first, f[0]).otherwise(f[1])
    written = F.concat_ws("-", F.lpad(year.cast("string"), 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0"))
    cycle = F.concat(F.lpad((F.floor(year / 400) * 400).cast("string"), 4, "0"), F.lit("-01-01"))
    return f, year_first, day_first, F.when(year > 0, written.try_cast("date")), cycle.try_cast("date")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _new_date(x: Column, key: str) -> Column:
    """The pseudonym of a date in its own writing; null if it is none."""
    f, year_first, day_first, date, cycle = _date_parts(x)

    def written(p: Column) -> Column:
        y, m, d, f = F.lpad(F.year(p["to"]).cast("string"), 4, "0"), F.month(p["to"]), F.day(p["to"]), p["f"]
        pad = lambda n, like: F.when(F.length(like) > 1, F.lpad(n.cast("string"), 2, "0")).otherwise(n.cast("string"))
        by = lambda a, b, c: F.concat(a, p["sep"], b, p["sep"], c)
        return F.when(p["y"], by(y, pad(m, f[1]), pad(d, f[2]))).when(p["d"], by(pad(d, f[0]), pad(m, f[1]), y)).otherwise(by(pad(m, f[0]), pad(d, f[1]), y))

    def move(p: Column) -> Column:
        to = F.date_add(p["cycle"], permute_number(F.datediff(p["date"], p["cycle"]).cast("long"), DAYS, F.lit("date"), key).cast("int"))
        return let(F.struct(to.alias("to"), p["f"].alias("f"), p["y"].alias("y"), p["d"].alias("d"), p["sep"].alias("sep")), written)

    parts = F.struct(f.alias("f"), year_first.alias("y"), day_first.alias("d"), date.alias("date"), cycle.alias("cycle"), F.regexp_extract(x, "[-/.]", 0).alias("sep"))
    return let(parts, lambda p: F.when(p["date"].isNotNull(), move(p)))


def _new_ip(x: Column, key: str) -> Column:
    octets = F.transform(F.split(x, r"\."), lambda o: o.cast("long"))
    moved = lambda o: permute_number(F.aggregate(o, F.lit(0).cast("long"), lambda t, b: t * 256 + b), ADDRESSES, F.lit("ip"), key)
    dotted = lambda v: F.concat_ws(".", *(F.pmod(F.floor(v / 256**i), F.lit(256)).cast("string") for i in (3, 2, 1, 0)))
    return let(octets, lambda o: F.when(F.forall(o, lambda b: b < 256), let(moved(o), dotted)))


def _new_iban(x: Column, key: str) -> Column:
    def checked(bare: Column) -> Column:
        country, own = F.substr(bare, F.lit(1), F.lit(2)), F.substr(bare, F.lit(5), F.length(bare))
        made = lambda b: F.concat(country, F.lpad((98 - mod97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0"), b)
        return F.when(mod97(F.concat(own, F.substr(bare, F.lit(1), F.lit(4)))) == 1, _overlay(x, let(permute_string(own, F.lit("iban"), key), made), "[A-Z0-9]"))

    return let(_letters_digits(x), checked)


def _new_ssn(x: Column, key: str) -> Column:
    def made(v: Column) -> Column:
        area, group, serial = F.floor(v / (99 * SOCIAL[1])) + 1, F.floor(v / SOCIAL[1]) % 99 + 1, v % SOCIAL[1] + 1
        return F.concat_ws("-", F.lpad((area + F.when(area >= 666, 1).otherwise(0)).cast("string"), 3, "0"), F.lpad(group.cast("string"), 2, "0"), F.lpad(serial.cast("string"), 4, "0"))

    def checked(p: Column) -> Column:
        area, group, serial = p[0], p[1], p[2]
        v = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1).cast("long") * SOCIAL[1] + serial - 1
        return F.when(~area.isin(0, 666) & (area < 900) & (group > 0) & (serial > 0), let(permute_number(v, SOCIAL, F.lit("ssn"), key), made))

    return let(F.transform(F.split(x, "-"), lambda t: t.cast("int")), checked)


def _new_phone(x: Column, key: str) -> Column:
    """A calling code stays, wherever the separators stand; the digits after it are permuted, so that all spellings of a number stay linked."""

    def made(digits: Column) -> Column:
        code = F.when(x.startswith("+"), F.regexp_extract(digits, _CALLING_CODE, 0)).otherwise(F.lit(""))
        whole = lambda c: _overlay(x, F.concat(c, permute_string(F.substr(digits, F.length(c) + 1, F.length(digits)), F.lit("phone"), key)), "[0-9]")
        return F.when(F.length(digits).between(8, 15), let(code, whole))

    return let(_digits(x), made)


def _new_card(x: Column, key: str) -> Column:
    def checked(digits: Column) -> Column:
        body = F.substr(digits, F.lit(1), F.length(digits) - 1)
        made = lambda b: _overlay(x, F.concat(b, luhn_digit(b)), "[0-9]")
        return F.when(F.substr(digits, F.length(digits), F.lit(1)) == luhn_digit(body), let(permute_string(body, F.lit("card"), key), made))

    return let(_digits(x), checked)


def pseudonym(x: Column, key: str) -> Column:
    """A match to ``struct(kind, text)``: its kind and pseudonym, or null and itself if it isn't valid."""
    local = F.substring_index(x, "@", 1)
    email = F.concat(permute_string(local, F.lit("email"), key), F.substr(x, F.length(local) + 1, F.length(x)))
    secret = permute_string(x, F.lit("secret"), key, F.when(x.rlike("[A-F]"), "F").otherwise("f"))
    by_kind = {"email": email, "ip": _new_ip(x, key), "date": _new_date(x, key), "iban": _new_iban(x, key), "ssn": _new_ssn(x, key), "phone": _new_phone(x, key), "card": _new_card(x, key), "secret": secret}

    def made(kind: Column) -> Column:
        text = F.lit(None).cast("string")
        for name, new in by_kind.items():
            text = F.when(kind == name, new).otherwise(text)
        return let(text, lambda t: F.struct(F.when(t.isNotNull(), kind).alias("kind"), F.coalesce(t, x).alias("text")))

    return let(kind_of(x), made)


def kind_of(x: Column) -> Column:
    """The first kind whose form a whole match has."""
    kind = F.lit(None).cast("string")
    for name, form in reversed(FORMS):
        kind = F.when(x.rlike("^(?:" + form + ")$"), name).otherwise(kind)
    return kind


def pseudonymise(docs: DataFrame, key: str) -> DataFrame:
    """``docs (doc_id, text, ...)`` to ``doc_id, text, n_replaced, kinds``: one row per row.

    ``text`` has every valid value replaced by its pseudonym, ``kinds`` names the kinds replaced, in order. Values that
    fail their check (Luhn and mod-97 digits, calendar, octets, number ranges) stay. Null text stays null with 0
    replaced, empty text stays; null ids and repeated rows stay; other columns are ignored.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    may = F.coalesce(F.col("text").rlike("[0-9@]"), F.lit(False))
    found = base.withColumn("m", F.when(may, F.regexp_extract_all("text", F.lit(ANY_FORM), 0)))
    made = found.withColumn("p", F.when(F.size("m") > 0, F.transform("m", lambda x: pseudonym(x, key))))
    parts = F.split("text", ANY_FORM, -1)
    joined = F.array_join(F.zip_with(parts, "p", lambda t, p: F.concat(t, F.coalesce(p["text"], F.lit("")))), "")
    kinds = F.coalesce(F.filter(F.transform("p", lambda p: p["kind"]), lambda k: k.isNotNull()), F.array().cast("array<string>"))
    return made.select("doc_id", F.when(F.col("p").isNull(), F.col("text")).otherwise(joined).alias("text"), F.size(kinds).alias("n_replaced"), kinds.alias("kinds"))

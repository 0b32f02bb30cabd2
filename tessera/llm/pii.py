"""Format-preserving pseudonyms for personal data (DataFrame functions only, no shuffle).

Found values are replaced by values of the same format through a keyed Feistel
network, so equal values get equal pseudonyms in every document and different
values different ones; nothing is stored, and the owner of the key can undo it.

A network of ``ROUNDS`` rounds works on a pair (l, r) of Z_a x Z_b, adding to
one half a keyed hash of the other, which is a permutation for any a and b.
The domains are the valid values of each format:

* card and account numbers (13 to 19 digits): all digits but the last; the last
  one is set so that the Luhn remainder stays, valid numbers thus stay valid;
* telephone numbers: the national digits, separators and country code stay;
* social security numbers: areas 001-899 without 666, groups 01-99, serials
  0001-9999;
* IPv4 addresses: two 16-bit halves;
* dates (y-m-d, y/m/d, d.m.y, m/d/y, or d/m/y where that is no date): the days
  of the 400-year calendar cycle, 146,097 = 189 x 773, so every pseudonym is a
  date of the same 400 years;
* IBANs, also in groups of four: the account part per character class, check
  digits set anew, spaces and dashes stay;
* e-mail names, access keys and long hexadecimal secrets: both halves of the
  characters, each shifted within its alphabet by a keyed hash of the other half.

Values that fail validation (octets above 255, impossible dates or
social security numbers, IBAN checksum) are left alone.

Defined results: a null text stays null with 0 values; texts without values
stay as they are; repeated rows get equal results; whole texts are searched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
#: first day of a 400-year window of dates
EPOCH = "1800-01-01"
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: characters of an IBAN by country: groups of four are told from the words behind them by their number
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU"}
_IBAN_GROUPS = "|".join(
    f"(?:{'|'.join(names.split())})[0-9]{{2}}(?:[ -][A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (f"[ -][A-Z0-9]{{{n % 4}}}" if n % 4 else "")
    for n, names in IBAN_LENGTHS.items())
#: country codes of two digits (+1 and +7 have one, all others three)
_TWO = "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"

# formats, tried in this order at each place
KINDS = {
    "email": r"[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+",
    "access_key": r"A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])",
    "iban": rf"(?:[A-Z]{{2}}[0-9]{{2}}[A-Z0-9]{{11,30}}|{_IBAN_GROUPS})(?![0-9A-Za-z])",
    "secret": r"(?:(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{16,}+|(?=[0-9]*[A-F])(?=[A-F]*[0-9])[0-9A-F]{16,}+)(?![0-9A-Za-z])",
    "phone": r"(?:\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
             r"|\+33[ .-]?[1-9](?:[ .-]?[0-9]{2}){4}"
             rf"|\+(?:7|{_TWO}|[2-9][0-9]{{2}})" r"[ -]?(?:\([0-9]{1,4}\)[ -]?)?[0-9]{1,4}(?:[ -]?[0-9]{2,4}){1,3}"
             r"|\([0-9]{3}\) ?[0-9]{3}[ -][0-9]{4}|[0-9]{3} [0-9]{3} [0-9]{4}|[0-9]{3}[-.][0-9]{3}[-.][0-9]{4})(?![0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
            r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9])",
    "ip": r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?![0-9A-Za-z]|\.[0-9])",
    "card": r"(?:[0-9]{13,19}|[0-9]{4} [0-9]{4} [0-9]{4} [0-9]{4}|[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}"
            r"|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{4}-[0-9]{6}-[0-9]{5})(?![0-9A-Za-z])",
}
PATTERN = r"(?<![0-9A-Za-z])(?:" + "|".join(KINDS.values()) + ")"


def _let(x: Column, use) -> Column:
    """use(x), with x evaluated once."""
    return F.transform(F.array(x), use)[0]


def _hash(key: str, tweak: str, i: Column, x: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(tweak), i.cast("string"), x.cast("string")), 256)


def _number(hex_digits: Column) -> Column:
    return F.conv(hex_digits, 16, 10).cast("bigint")


def feistel(left: Column, right: Column, a: Column, b: Column, key: str, tweak: str) -> Column:
    """Keyed permutation of Z_a x Z_b as a struct (l, r)."""
    def step(s, i):
        other = F.when(i % 2 == 1, s["r"]).otherwise(s["l"])
        f = _number(F.substring(_hash(key, tweak, i, other), 1, 15))
        return F.struct(F.when(i % 2 == 1, F.pmod(s["l"] + f, a)).otherwise(s["l"]).alias("l"),
                        F.when(i % 2 == 1, s["r"]).otherwise(F.pmod(s["r"] + f, b)).alias("r"))
    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(rounds, start, step)


def _pad(x: Column, n: Column) -> Column:
    return F.when(n == 0, F.lit("")).otherwise(F.lpad(x.cast("string"), n, F.lit("0")))


def _int(s: Column) -> Column:
    return F.concat(F.lit("0"), s).cast("bigint")


def permute_digits(d: Column, key: str, tweak: str) -> Column:
    """Permute the digit strings of each length (up to 36 digits)."""
    n = F.length(d)
    nl = F.floor(n / 2).cast("int")
    nr = n - nl
    power = lambda k: F.pow(F.lit(10.0), k).cast("bigint")
    p = feistel(_int(d.substr(F.lit(1), nl)), _int(d.substr(nl + 1, nr)), power(nl), power(nr), key, tweak)
    return _let(p, lambda s: F.concat(_pad(s["l"], nl), _pad(s["r"], nr)))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def refill(s: Column, digits: Column) -> Column:
    """s with its digits replaced, in order, by the given ones."""
    def step(acc, c):
        hit = (c >= "0") & (c <= "9")
        return F.struct(F.concat(acc["out"], F.when(hit, digits.substr(acc["k"], F.lit(1))).otherwise(c)).alias("out"),
                        F.when(hit, acc["k"] + 1).otherwise(acc["k"]).alias("k"))
    return F.aggregate(F.split(s, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), step)["out"]


def luhn(d: Column) -> Column:
    """Luhn remainder of a digit string: 0 for valid numbers."""
    def value(c, i):
        x = F.concat(F.lit("0"), c).cast("int")
        return F.when(i % 2 == 0, x).otherwise(F.when(x > 4, 2 * x - 9).otherwise(2 * x))
    v = F.transform(F.split(F.reverse(d), ""), value)
    return F.aggregate(v, F.lit(0), lambda s, x: s + x) % 10


def shift_text(s: Column, alphabets: list[str], key: str, tweak: str) -> Column:
    """Permute the strings of the same shape: each character moves within its alphabet, others stay."""
    n = F.length(s)
    half = F.floor(n / 2).cast("int")

    def move(text, by):
        def one(c, j):
            pad = _number(by.substr(F.pmod(j, F.lit(64)) * 2 + 1, F.lit(2))).cast("int")
            out = c
            for alpha in alphabets:
                at = F.call_function("instr", F.lit(alpha), c)
                out = F.when((c != "") & (at > 0),
                             F.lit(alpha).substr((at - 1 + pad) % len(alpha) + 1, F.lit(1))).otherwise(out)
            return out
        return F.array_join(F.transform(F.split(text, ""), one), "")

    def step(st, i):
        other = F.when(i % 2 == 1, st["r"]).otherwise(st["l"])
        by = F.concat(_hash(key, tweak, i, other), _hash(key, tweak + "+", i, other))
        return F.struct(F.when(i % 2 == 1, move(st["l"], by)).otherwise(st["l"]).alias("l"),
                        F.when(i % 2 == 1, st["r"]).otherwise(move(st["r"], by)).alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    start = F.struct(s.substr(F.lit(1), half).alias("l"), s.substr(half + 1, n - half).alias("r"))
    out = F.aggregate(rounds, start, step)
    return _let(out, lambda p: F.concat(p["l"], p["r"]))


# --- formats ----------------------------------------------------------------

def _card(m: Column, key: str) -> Column:
    def change(d):
        def close(body):
            # the last digit stands undoubled: it moves the remainder one for one
            last = F.pmod(luhn(d) - luhn(F.concat(body, F.lit("0"))), F.lit(10))
            return refill(m, F.concat(body, last.cast("string")))
        return _let(permute_digits(d.substr(F.lit(1), F.length(d) - 1), key, "card"), close)
    return _let(digits_of(m), change)


def _phone(m: Column, key: str) -> Column:
    d = digits_of(m)
    country = F.when(m.rlike(r"^\+[17]"), 1).when(m.rlike(rf"^\+(?:{_TWO})"), 2).when(m.startswith("+"), 3).otherwise(0)
    rest = permute_digits(d.substr(country + 1, F.length(d) - country), key, "phone")
    return _let(F.concat(d.substr(F.lit(1), country), rest), lambda x: refill(m, x))


def _ssn(m: Column, key: str) -> Column:
    d = digits_of(m)
    area, group, serial = (_int(d.substr(F.lit(a), F.lit(n))) for a, n in ((1, 3), (4, 2), (6, 4)))
    ok = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    left = F.when(area > 666, area - 2).otherwise(area - 1)                    # 898 areas
    right = (group - 1) * 9999 + serial - 1
    p = feistel(left, right, F.lit(898), F.lit(99 * 9999), key, "ssn")

    def show(s):
        a = F.when(s["l"] >= 665, s["l"] + 2).otherwise(s["l"] + 1)
        return F.concat_ws("-", _pad(a, F.lit(3)), _pad(F.floor(s["r"] / 9999) + 1, F.lit(2)), _pad(s["r"] % 9999 + 1, F.lit(4)))
    return F.when(ok, _let(p, show)).otherwise(m)


def _ip(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("bigint"))
    p = feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536), key, "ip")
    show = lambda s: F.concat_ws(".", *[x.cast("bigint").cast("string") for x in (
        F.floor(s["l"] / 256), s["l"] % 256, F.floor(s["r"] / 256), s["r"] % 256)])
    return F.when(F.exists(o, lambda x: x > 255), m).otherwise(_let(p, show))


def _date(m: Column, key: str) -> Column:
    parts = F.split(m, "[-/.]")
    iso = m.rlike("^[0-9]{4}[-/]")
    sep = F.when(m.contains("-"), "-").when(m.contains("/"), "/").otherwise(".")
    day = lambda y, mo, d: F.try_to_date(F.concat_ws("-", y, F.lpad(mo, 2, "0"), F.lpad(d, 2, "0")), "yyyy-MM-dd")
    month_first = day(parts[2], parts[0], parts[1])
    use_month = (sep == "/") & month_first.isNotNull()
    value = F.when(iso, day(parts[0], parts[1], parts[2])).when(use_month, month_first).otherwise(day(parts[2], parts[1], parts[0]))
    n = F.datediff(value, F.lit(EPOCH).cast("date")).cast("bigint")
    window = F.floor(n / 146097)
    k = F.pmod(n, F.lit(146097))
    p = feistel(F.floor(k / 773), k % 773, F.lit(189), F.lit(773), key, "date")

    def show(s):
        new = F.date_add(F.lit(EPOCH).cast("date"), (window * 146097 + s["l"] * 773 + s["r"]).cast("int"))
        y, mo, d = F.date_format(new, "yyyy"), F.month(new), F.dayofmonth(new)
        width = lambda x, old: F.when(F.length(old) == 2, F.lpad(x.cast("string"), 2, "0")).otherwise(x.cast("string"))
        return F.when(iso, F.concat(y, sep, width(mo, parts[1]), sep, width(d, parts[2]))) \
            .when(use_month, F.concat(width(mo, parts[0]), sep, width(d, parts[1]), sep, y)) \
            .otherwise(F.concat(width(d, parts[0]), sep, width(mo, parts[1]), sep, y))
    return F.coalesce(F.when(value.isNotNull(), _let(p, show)), m)


def _mod97(s: Column) -> Column:
    """Remainder of an IBAN rearranged (account, country, check), letters as 10 to 35."""
    def step(acc, c):
        digit = (c >= "0") & (c <= "9")
        v = F.when(digit, F.concat(F.lit("0"), F.when(digit, c).otherwise("0")).cast("int")).otherwise(F.ascii(c) - 55)
        return F.when(c == "", acc).otherwise((acc * F.when(digit, 10).otherwise(100) + v) % 97).cast("int")
    return F.aggregate(F.split(s, ""), F.lit(0), step)


def _iban(m: Column, key: str) -> Column:
    """Spaces and dashes stay in place; the rest is changed as in the unspaced form."""
    def fill(new):
        return F.aggregate(F.split(m, ""), F.struct(F.lit("").alias("out"), F.lit(1).alias("k")), lambda acc, c: F.struct(
            F.concat(acc["out"], F.when(c.rlike("[ -]"), c).otherwise(new.substr(acc["k"], F.lit(1)))).alias("out"),
            F.when(c.rlike("[ -]") | (c == ""), acc["k"]).otherwise(acc["k"] + 1).alias("k")))["out"]
    grouped = m.rlike("[ -]")
    # four groups of digits behind what is no IBAN may be a card
    card = F.concat(m.substr(F.lit(1), F.lit(5)), _card(m.substr(F.lit(6), F.length(m)), key))
    plain = _let(F.regexp_replace(m, "[ -]", ""), lambda s: _iban_plain(s, F.when(grouped, s).otherwise(_hex(s, key)), key))
    return F.when(~grouped, plain).otherwise(_let(plain, lambda new: F.when(new != F.regexp_replace(m, "[ -]", ""), fill(new))
        .when(m.rlike(r"^.{4}[ -][0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}$"), card).otherwise(m)))


def _hex(m: Column, key: str) -> Column:
    """A hexadecimal secret can have the shape of an IBAN."""
    return F.when(m.rlike("^[0-9A-F]{16,}$"), _secret(m, key)).otherwise(m)


def _iban_plain(m: Column, other: Column, key: str) -> Column:
    country, check, account = (m.substr(F.lit(a), F.lit(n)) for a, n in ((1, 2), (3, 2), (5, 40)))
    def show(new):
        digits = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, digits, new)
    ok = _mod97(F.concat(account, country, check)) == 1
    return F.when(ok, _let(shift_text(account, [DIGITS, UPPER], key, "iban"), show)).otherwise(other)


def _email(m: Column, key: str) -> Column:
    at = F.call_function("instr", m, F.lit("@"))
    return F.concat(shift_text(m.substr(F.lit(1), at - 1), [DIGITS, LOWER, UPPER], key, "email"), m.substr(at, F.length(m)))


def _access_key(m: Column, key: str) -> Column:
    return F.concat(m.substr(F.lit(1), F.lit(4)), shift_text(m.substr(F.lit(5), F.lit(16)), [DIGITS, UPPER], key, "access"))


def _secret(m: Column, key: str) -> Column:
    alpha = lambda a: shift_text(m, [a], key, "secret")
    return F.when(m.rlike("[a-f]"), alpha("0123456789abcdef")).otherwise(alpha("0123456789ABCDEF"))


_MAKE = {"email": _email, "access_key": _access_key, "secret": _secret, "iban": _iban, "phone": _phone, "ssn": _ssn,
         "date": _date, "ip": _ip, "card": _card}


def kind_of(m: Column) -> Column:
    """Format of a found value: the first in the order of ``KINDS`` that matches it whole."""
    return reduce(lambda c, k: c.when(m.rlike(rf"\A(?:{KINDS[k]})\z"), k), list(KINDS)[1:], F.when(m.contains("@"), "email"))


def pseudonym(m: Column, key: str) -> Column:
    """Pseudonym of one found value."""
    def by_kind(kind):
        return reduce(lambda c, k: c.when(kind == k, _MAKE[k](m, key)), list(_MAKE)[1:],
                      F.when(kind == "email", _email(m, key))).otherwise(m)
    return _let(kind_of(m), by_kind)


def pseudonymise(docs: DataFrame, key: str, *, text_col: str = "text", count_col: str | None = "n_values") -> DataFrame:
    """All columns with ``text_col`` pseudonymised; ``count_col``: number of replaced values."""
    text = F.col(f"`{text_col}`")
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    new = F.transform(found, lambda m: pseudonym(m, key))
    # the text between the values, found by the same pattern, and the values' pseudonyms, in turn
    gaps = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(gaps, new, lambda g, v: F.concat(g, F.coalesce(v, F.lit("")))), "")
    out = F.when(text.isNull(), text).otherwise(joined)
    if count_col is None:
        return docs.withColumn(text_col, out)
    changed = F.aggregate(F.zip_with(found, new, lambda a, b: (a != b).cast("long")), F.lit(0).cast("long"), lambda s, x: s + x)
    return docs.withColumns({text_col: out, count_col: F.coalesce(changed, F.lit(0).cast("long"))})

r"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Matches are found by one expression and validated: card numbers by their check
digit, bank numbers by their check digits, dates by the calendar, addresses by
their octets, social security numbers by their ranges. A valid value is permuted within its own format, so the result
is valid too, different values stay different, and equal values are linked
across documents however they are written out. What fails validation is left.

* Dates (1900 to 2099), IPv4 addresses and social security numbers are numbers
  of a fixed range a * b; two halves mod a and mod b are shifted in turn.
* Cards keep their separators; the digits before the check digit are permuted
  and the check digit is set anew. In a run of digits, single blanks and hyphens,
  13 to 19 digits between separators that pass the check are a card: first those
  grouped as on cards, then any, the longest of each start. One in ten other
  stretches passes too and is replaced.
* Phones keep their country code or trunk zero and separators; the other digits
  are permuted, so that national and international forms are linked.
* Bank numbers keep their country; behind it letters stay letters and digits
  digits, and the check digits are set anew.
* Long (version 6) addresses are expanded and permuted, and written in full.
* Dates with slashes are read month first, and day first where that is no date.
* Local parts of mail addresses, access keys, passwords, web tokens and hexadecimal
  tokens are permuted character by character: digits, capitals, small letters and
  the letters of ``LETTERS`` stay what they are, the rest stays as it is.

All of it is column arithmetic inside the document's row. The patterns start
only at the start of a run and never step back into it, so long texts take
linear time.

Cases: a null text stays null, an empty one empty; ``n_chars`` follows the text
where it is not null; other columns are kept; ``n_replaced`` is added or replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "tallyhouse-pii-1"
ROUNDS = 8

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]{1,63}+(?:\.[\p{L}\p{N}-]{1,63}+)+"
ACCESS_KEY = r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])"
#: Directly behind = or :, behind blanks and a quote or =, or behind : and a blank if it has a digit (prose has none there).
_WORD = r"""(?i:password|passwd|pwd|secret|api[_-]?key|access[_-]token|auth[_-]token)["']?"""
PASSWORD = (
    rf"""(?<=[=:])(?<={_WORD}[=:])[^\s"']++"""
    rf"""|(?<=["'])(?<={_WORD}[ \t]{{0,4}}[=:][ \t]{{0,4}}["'])[^\s"']++"""
    rf"""|(?<=[= \t])(?<={_WORD}[ \t]{{0,4}}=[ \t]{{0,4}})[^\s"']++"""
    rf"""|(?<=[ \t])(?<={_WORD}:[ \t]{{1,4}})(?=[^\s"'0-9]*+[0-9])[^\s"']++"""
)
#: Beyond 128 characters, one character repeated, up to the last, is filling and no secret.
TOKEN = r"(?<![0-9A-Za-z])(?!(?=[0-9A-Fa-f]{129})(?<hex>[0-9A-Fa-f])\k<hex>*+[0-9A-Fa-f]?(?![0-9A-Za-z]))[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"
#: Three parts of a signed web token; the first is JSON, so it begins alike.
WEB_TOKEN = r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]{5,}+\.[A-Za-z0-9_-]{5,}+"
BANK = (
    r"(?<![0-9A-Za-z])[A-Z]{2}\d{2}(?:[0-9A-Z]{11,30}+"
    r"| [0-9A-Z]{4}(?: (?=[A-Z]{0,3}\d)[0-9A-Z]{4}){1,6}(?: \d[0-9A-Z]{0,2})?)(?![0-9A-Za-z])"
)
#: Eight groups, or fewer around ``::`` and a digit among them, as names in programs have colons too.
LONG_ADDRESS = (
    r"(?<![0-9A-Za-z:])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?=[0-9A-Fa-f:]{0,38}[0-9])(?!(?:[0-9A-Fa-f]{0,4}:){8})(?:[0-9A-Fa-f]{1,4}:){1,6}(?::[0-9A-Fa-f]{1,4}){1,6})(?![0-9A-Za-z:])"
)
ADDRESS = r"(?<![0-9A-Za-z.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?!\.?[0-9A-Za-z])"
SOCIAL = r"(?<![0-9A-Za-z-])\d{3}-\d{2}-\d{4}(?!-?[0-9A-Za-z])"
ISO_DATE = r"(?<![0-9A-Za-z-])(?:19|20)\d{2}-\d{2}-\d{2}(?![0-9]|-[0-9])"
SLASH_DATE = r"(?<![0-9A-Za-z/])(?:19|20)\d{2}/\d{2}/\d{2}(?!/?[0-9A-Za-z]|/)"
DAY_DATE = r"(?<![0-9A-Za-z.])\d{2}\.\d{2}\.(?:19|20)\d{2}(?!\.?[0-9A-Za-z])"
MONTH_DATE = r"(?<![0-9A-Za-z/])\d{2}/\d{2}/(?:19|20)\d{2}(?!/?[0-9A-Za-z])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?=\+(?:[ .()-]{0,2}\d){8,15}+(?![ .-]?\d))\+\d{1,3}(?:[ .-]?\(\d{1,5}\))?(?:[ .-]?\d{1,8}){1,5}(?!-?\d)|"
    r"(?<![0-9A-Za-z+])\+\d{1,3}[ .-]?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{4}(?!-?\d)"
    r"|(?<![0-9A-Za-z+.-])\(?\d{3}\)?[ .-]\d{3}[.-]\d{4}(?!-?\d)"
    r"|(?<![0-9A-Za-z+])\+(?=(?:[ .-]?\d){8})\d{1,3}(?:[ .-]\d{2,4}){2,5}(?!-?\d)"
    r"|(?<![0-9A-Za-z+])\+\d{8,15}+(?!\d)"
    r"|(?<![0-9A-Za-z+.-])1[ .-]\(?\d{3}\)?[ .-]\d{3}[ .-]?\d{4}(?![.-]?\d)"
    r"|(?<![0-9A-Za-z])(?=\((?:[ )-]{0,2}\d){8,13}+(?!-?\d))\(0\d{1,5}\) ?\d{3,10}(?:[ -]\d{1,6}){0,2}(?!-?\d)"
    r"|(?<![0-9A-Za-z+.,/:-])(?<!\d{4} )(?=(?:[ /-]?\d){9,13}+(?![ /.:-]?\d))0\d{2,5}[ /-]\d{3,9}(?:[ -]\d{2,6}){0,2}(?![/.:-]?\d)"
)
#: A run of digit groups; it ends before a group that begins a match of another kind or runs into a letter.
OTHERS = "|".join([ADDRESS, SOCIAL, ISO_DATE, SLASH_DATE, DAY_DATE, MONTH_DATE, PHONE])
CARD = rf"(?:(?<![0-9A-Za-z])|(?<=(?i:card|visa|amex)))(?<![0-9]\.)(?=\d(?:[ -]?\d){{12}})\d++(?![A-Za-z])(?:[ -](?!{OTHERS})\d++(?![A-Za-z]))*+"
#: How cards are grouped, then any groups; the separator behind the last group is not part of the card.
CARD_SHAPES = [r"^(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{4}[ -]\d{6}[ -]\d{4,5})[ -]?$", r"^\d"]
KINDS = [EMAIL, ACCESS_KEY, WEB_TOKEN, PASSWORD, TOKEN, BANK, LONG_ADDRESS, ADDRESS, SOCIAL, ISO_DATE, SLASH_DATE, DAY_DATE, MONTH_DATE, PHONE, CARD]
ANY = "|".join(f"(?:{kind})" for kind in KINDS)

#: A country code: up to a separator, or by the plan of the world's codes; with a zero in brackets. Else a trunk digit.
COUNTRY = (
    r"^(?:\+(?:\d{1,3}(?=[ .(-])|[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})(?:[ .-]?\(0\))?"
    r"|1(?=[ .-]\(?\d{3}\)?[ .-]\d{3}[ .-]?\d{4}$)|\(?0)"
)
#: Whatever ``ANY`` matches has one of these.
SOME = r"[0-9@]|AKIA|eyJ|[A-Fa-f]{32}|(?i:password|passwd|pwd|secret|api[_-]?key|access[_-]token|auth[_-]token)"

#: 73049 days from 1900-01-01 to 2099-12-31.
FIRST_DAY, DAYS = "1900-01-01", (17, 4297)
#: Areas 001-899 without 666; groups 01-99 with serials 0001-9999.
SOCIALS = (898, 99 * 9999)
#: Ranges of letters beyond ASCII that are permuted within themselves: Latin, Greek, Cyrillic, Arabic, kana, Han, Hangul.
LETTERS = ["ÀÖ", "ØÞ", "ßö", "øÿ", "Āſ", "ΑΡ", "ΣΩ", "αω", "АЯ", "ая", "ؠغ", "في", "ぁゖ", "ァヺ", "一鿿", "가힣"]


def _digest(key: str, kind: str, step: Column, half: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), half.cast("string")), 256)


def _shift_characters(half: Column, digest: Column, wide: bool) -> Column:
    def shift(c: Column, i: Column) -> Column:
        by = F.conv(F.substr(digest, (i % 32) * 2 + 1, F.lit(2)), 16, 10).cast("int")
        moved = lambda first, size: F.char(F.lit(first) + (F.ascii(c) - first + by) % size)
        plain = F.when(c.between("0", "9"), moved(48, 10)).when(c.between("A", "Z"), moved(65, 26)).when(c.between("a", "z"), moved(97, 26))
        if not wide:
            return plain.otherwise(c)
        first = lambda r: F.ascii(F.substring(r, 1, 1))
        size = lambda r: F.ascii(F.substring(r, 2, 1)) - first(r) + 1
        letter = lambda r: F.decode(F.unhex(F.lpad(F.hex(first(r) + (F.ascii(c) - first(r) + by) % size(r)), 4, "0")), "UTF-16BE")
        ranges = F.split(F.lit(",".join(LETTERS)), ",")
        inside = F.filter(ranges, lambda r: c.between(F.substring(r, 1, 1), F.substring(r, 2, 1)))
        return plain.when(c > "\x7f", F.coalesce(F.get(F.transform(inside, letter), F.lit(0)), c)).otherwise(c)

    return F.array_join(F.transform(F.split(half, ""), shift), "")


def permute_characters(value: Column, key: str, kind: str, wide: bool = False) -> Column:
    """A balanced network over the characters; each keeps its class. Those beyond ASCII take part if ``wide``."""
    left = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), left).alias("l"), F.substr(value, left + 1, F.length(value)).alias("r"))
    step = lambda s, i: F.struct(s["r"].alias("l"), _shift_characters(s["l"], _digest(key, kind, i, s["r"]), wide).alias("r"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))


def permute_number(number: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of 0 ... a * b - 1: halves mod a and mod b, shifted by each other in turn."""
    a, b = sizes
    drawn = lambda i, half: F.conv(F.substring(_digest(key, kind, i, half), 1, 12), 16, 10).cast("long")
    start = F.struct(F.floor(number / b).cast("long").alias("x"), (number % b).cast("long").alias("y"))

    def step(s: Column, i: Column) -> Column:
        x = F.when(i % 2 == 1, (s["x"] + drawn(i, s["y"])) % a).otherwise(s["x"])
        y = F.when(i % 2 == 0, (s["y"] + drawn(i, s["x"])) % b).otherwise(s["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["x"] * b + s["y"])


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _into_format(digits: Column, like: Column) -> Column:
    """``digits`` in the places that ``like`` has digits in."""

    def put(c: Column, i: Column) -> Column:
        return F.when(c.between("0", "9"), F.substr(digits, F.length(_digits(F.substr(like, F.lit(1), i + 1))), F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.split(like, ""), put), "")


def check_digit(payload: Column) -> Column:
    """The digit that makes the number pass the check: from the right, every other digit counts twice."""

    def add(total: Column, i: Column) -> Column:
        digit = F.substr(payload, F.length(payload) + 1 - i, F.lit(1)).cast("int")
        twice = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    total = F.aggregate(F.sequence(F.lit(1), F.length(payload)), F.lit(0), add)
    return ((10 - total % 10) % 10).cast("string")


def _once(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it reads it."""
    return F.transform(F.array(value), body)[0]


def _valid_card(value: Column) -> Column:
    passes = lambda d: check_digit(F.substr(d, F.lit(1), F.length(d) - 1)) == F.substr(d, F.length(d), F.lit(1))
    return _once(_digits(value), lambda d: F.length(d).between(13, 19) & passes(d))


def _card(hit: Column, key: str) -> Column:
    payload = F.substr(_digits(hit), F.lit(1), F.length(_digits(hit)) - 1)
    # the array of one value is computed once, however often the function reads it
    moved = F.transform(F.array(permute_characters(payload, key, "card")), lambda p: F.concat(p, check_digit(p)))
    return _into_format(moved[0], hit)


def _cards(groups: Column, key: str, shapes: list[str]) -> Column:
    """The text of digit groups with the cards of the first shape replaced, and between them those of the others."""
    if not shapes:
        return F.array_join(groups, "")
    n = F.size(groups)

    def longest(i: Column) -> Column:
        text = lambda k: F.array_join(F.slice(groups, i, k), "")
        fits = F.filter(F.sequence(F.lit(1), F.least(F.lit(19), n - i + 1)), lambda k: _once(text(k), lambda t: t.rlike(shapes[0]) & _valid_card(t)))
        return F.struct(i.alias("i"), F.coalesce(F.array_max(fits), F.lit(0)).alias("k"))

    found = F.filter(F.transform(F.sequence(F.lit(1), n), longest), lambda x: x["k"] > 0)
    start = F.struct(F.lit(1).alias("upto"), F.array().cast("array<struct<from:int,i:int,k:int>>").alias("cards"))

    def take(state: Column, x: Column) -> Column:
        card = F.struct(state["upto"].alias("from"), x["i"].alias("i"), x["k"].alias("k"))
        with_it = F.struct((x["i"] + x["k"]).alias("upto"), F.concat(state["cards"], F.array(card)).alias("cards"))
        return F.when(x["i"] >= state["upto"], with_it).otherwise(state)

    def written(state: Column) -> Column:
        gap = lambda first, upto: _once(F.slice(groups, first, upto - first), lambda g: _cards(g, key, shapes[1:]))
        parts = F.transform(state["cards"], lambda c: F.concat(gap(c["from"], c["i"]), _once(F.array_join(F.slice(groups, c["i"], c["k"]), ""), lambda t: _card(t, key))))
        return F.concat(F.array_join(parts, ""), gap(state["upto"], n + 1))

    return F.when(n > 0, F.aggregate(found, start, take, written)).otherwise(F.lit(""))


def _phone(hit: Column, key: str) -> Column:
    code = F.regexp_extract(hit, COUNTRY, 0)
    rest = F.substr(hit, F.length(code) + 1, F.length(hit))
    return F.concat(code, _once(rest, lambda r: _once(permute_characters(_digits(r), key, "phone"), lambda d: _into_format(d, r))))


def _remainder(number: Column) -> Column:
    """A bank number, country and check digits last, modulo 97; letters count from 10."""

    def add(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + F.ascii(c) - 48) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(number, ""), F.lit(0), add)


def _bank(hit: Column, key: str) -> Column:
    """A bank number with or without a last group that only stands behind it."""
    bare = lambda v: F.replace(v, F.lit(" "), F.lit(""))
    part = lambda v, first, n: F.substr(v, F.lit(first), n if isinstance(n, Column) else F.lit(n))
    valid = lambda v: _once(bare(v), lambda b: (F.length(b) > 14) & (_remainder(F.concat(part(b, 5, F.length(b)), part(b, 1, 4))) == 1))

    def written(v: Column) -> Column:
        land = part(v, 1, 2)
        payload = lambda b: permute_characters(part(b, 5, F.length(b)), key, "bank")
        check = lambda p: F.lpad((F.lit(98) - _remainder(F.concat(p, land, F.lit("00")))).cast("string"), 2, "0")
        whole = lambda b: _once(payload(b), lambda p: F.concat(land, check(p), p))
        put = lambda n: F.array_join(
            F.transform(F.split(v, ""), lambda c, i: F.when(c == " ", c).otherwise(F.substr(n, F.length(bare(F.substr(v, F.lit(1), i + 1))), F.lit(1)))), ""
        )
        return _once(_once(bare(v), whole), put)

    last = F.regexp_extract(hit, r" [0-9A-Z]+$", 0)
    shorter = F.substr(hit, F.lit(1), F.length(hit) - F.length(last))
    number = F.filter(F.array(hit, shorter), valid)
    return _once(number, lambda n: F.when(F.size(n) > 0, F.concat(written(n[0]), F.when(n[0] == hit, "").otherwise(last))).otherwise(hit))


def _long_address(hit: Column, key: str) -> Column:
    groups = lambda v: F.filter(F.split(v, ":"), lambda g: g != "")
    low = F.lower(hit)
    ahead = groups(F.substring_index(low, "::", 1))
    behind = F.when(F.contains(low, F.lit("::")), groups(F.substring_index(low, "::", -1))).otherwise(F.array().cast("array<string>"))
    filling = F.array_repeat(F.lit("0"), F.lit(8) - F.size(ahead) - F.size(behind))
    number = F.array_join(F.transform(F.concat(ahead, filling, behind), lambda g: F.lpad(g, 4, "0")), "")
    value = lambda digits: F.conv(digits, 16, 10).cast("long")

    def step(s: Column, i: Column) -> Column:
        # two halves of 64 bits in four numbers, each half moved by the other
        drawn = lambda at: value(F.substring(_digest(key, "long", i, s["r"]), at, 8))
        high = (value(F.substring(s["l"], 1, 8)) + drawn(1)) % (1 << 32)
        down = (value(F.substring(s["l"], 9, 8)) + drawn(9)) % (1 << 32)
        text = lambda n: F.lower(F.lpad(F.hex(n), 8, "0"))
        return F.struct(s["r"].alias("l"), F.concat(text(high), text(down)).alias("r"))

    def written(n: Column) -> Column:
        start = F.struct(F.substring(n, 1, 16).alias("l"), F.substring(n, 17, 16).alias("r"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))

    moved = _once(_once(number, written), lambda n: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.substr(n, i * 4 + 1, F.lit(4))), ":"))
    return F.when(F.size(ahead) + F.size(behind) <= 8, moved).otherwise(hit)


def _date(hit: Column, form: str, key: str) -> Column:
    day = F.try_to_date(hit, form)
    moved = permute_number(F.date_diff(day, F.lit(FIRST_DAY).cast("date")).cast("long"), DAYS, key, "date")
    return F.coalesce(F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), moved.cast("int")), form), hit)


def _address(hit: Column, key: str) -> Column:
    octet = lambda i: F.split(hit, r"\.")[i].cast("long")
    valid = (octet(0) < 256) & (octet(1) < 256) & (octet(2) < 256) & (octet(3) < 256)
    number = ((octet(0) * 256 + octet(1)) * 256 + octet(2)) * 256 + octet(3)
    moved = F.transform(
        F.array(permute_number(number, (1 << 16, 1 << 16), key, "address")),
        lambda n: F.array_join(F.transform(F.array(*[F.lit(s) for s in (24, 16, 8, 0)]), lambda s: F.floor(n / F.pow(F.lit(2.0), s)).cast("long") % 256), "."),
    )
    return F.when(valid, moved[0]).otherwise(hit)


def _social(hit: Column, key: str) -> Column:
    part = lambda i: F.split(hit, "-")[i].cast("long")
    valid = part(0).between(1, 899) & (part(0) != 666) & (part(1) > 0) & (part(2) > 0)
    area = part(0) - 1 - F.when(part(0) > 666, 1).otherwise(0)
    number = area * SOCIALS[1] + (part(1) - 1) * 9999 + part(2) - 1

    def written(n: Column) -> Column:
        low, high = n % SOCIALS[1], F.floor(n / SOCIALS[1]).cast("long")
        first = high + 1 + F.when(high >= 665, 1).otherwise(0)
        two = [F.lpad((F.floor(low / 9999).cast("long") + 1).cast("string"), 2, "0"), F.lpad((low % 9999 + 1).cast("string"), 4, "0")]
        return F.concat_ws("-", F.lpad(first.cast("string"), 3, "0"), *two)

    return F.when(valid, F.transform(F.array(permute_number(number, SOCIALS, key, "social")), written)[0]).otherwise(hit)


def pseudonym(hit: Column, key: str = KEY) -> Column:
    """What stands for a match of ``ANY``; the match itself where it is not valid."""
    whole = lambda kind: hit.rlike(f"^(?:{kind})$")
    at = F.instr(hit, "@")
    return (
        F.when(at > 0, F.concat(permute_characters(F.substr(hit, F.lit(1), at - 1), key, "mail", wide=True), F.substr(hit, at, F.length(hit))))
        .when(whole(ACCESS_KEY), F.concat(F.lit("AKIA"), permute_characters(F.substr(hit, F.lit(5), F.lit(16)), key, "access")))
        .when(whole(WEB_TOKEN), F.concat(F.lit("eyJ"), permute_characters(F.substr(hit, F.lit(4), F.length(hit)), key, "secret")))
        .when(whole(BANK), _bank(hit, key))
        .when(whole(LONG_ADDRESS), _long_address(hit, key))
        .when(whole(ADDRESS), _address(hit, key))
        .when(whole(SOCIAL), _social(hit, key))
        .when(whole(ISO_DATE), _date(hit, "yyyy-MM-dd", key))
        .when(whole(SLASH_DATE), _date(hit, "yyyy/MM/dd", key))
        .when(whole(DAY_DATE), _date(hit, "dd.MM.yyyy", key))
        .when(whole(MONTH_DATE) & F.try_to_date(hit, "MM/dd/yyyy").isNull(), _date(hit, "dd/MM/yyyy", key))
        .when(whole(MONTH_DATE), _date(hit, "MM/dd/yyyy", key))
        .when(whole(PHONE), _phone(hit, key))
        .when(whole(TOKEN), permute_characters(hit, key, "secret"))
        .when(whole(CARD), _once(F.regexp_extract_all(hit, F.lit(r"\d+[ -]?"), F.lit(0)), lambda g: _cards(g, key, CARD_SHAPES)))
        .otherwise(permute_characters(hit, key, "secret"))
    )


def pseudonymize(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with pseudonyms in ``text``, and ``n_replaced``."""
    named = {c: F.col(f"row.`{c.replace('`', '``')}`") for c in docs.columns}
    rows = docs.select(F.struct(*[F.col(f"`{c.replace('`', '``')}`") for c in docs.columns]).alias("row"))
    text = named["text"]
    hits = F.when(text.rlike(SOME), F.regexp_extract_all(text, F.lit(ANY), F.lit(0)))
    found = rows.withColumn("hits", F.coalesce(hits, F.array().cast("array<string>")))
    moved = found.withColumn("moved", F.transform("hits", lambda h: pseudonym(h, key)))
    filled = F.array_join(F.zip_with(F.split(text, ANY, -1), "moved", lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")
    changed = F.size(F.filter(F.zip_with("hits", "moved", lambda a, b: a != b), lambda x: x)).cast("long")
    out = moved.withColumn("new_text", F.when(F.size("hits") > 0, filled).otherwise(text)).withColumn("changed", changed)
    new = {"text": F.col("new_text"), "n_replaced": F.col("changed")}
    if "n_chars" in docs.columns:
        size = F.length("new_text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(named["n_chars"].isNotNull() & (F.col("changed") > 0), size).otherwise(named["n_chars"])
    names = [*docs.columns, *({"n_replaced"} - set(docs.columns))]
    return out.select(*[new.get(c, named.get(c)).alias(c) for c in names])


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(spark.read.parquet(f"{sf_dir}/documents.parquet"))

"""Format-preserving pseudonyms for personal data (native expressions only).

Validated values are found and replaced by keyed permutations of themselves within their format:

- card numbers (13 to 19 digits in one to 19 groups, single spaces or hyphens between them, that pass the Luhn check; from
  each place the longest such row of groups counts, whatever digits stand beside it; also four groups of four with points):
  all digits but the last are permuted, the last is made the check digit again;
- dates (calendar days, four-digit years): permuted among the days of their century;
- IPv4 addresses: four numbers below 256; a number with leading zeros gets leading zeros, three digits in all;
- social security numbers: area, group and serial numbers within the ranges in use;
- telephone numbers, with + and country code (as many digits as the code has where that is fixed, else 8 to 15, up to
  where another value begins) or in the forms (999) 999-9999, 999-999-9999, 999.999.9999, and the last two behind 1- and 1.
  (country (country code 1): digits after the country code, separators stay. Where the code's length is not known, digits that follow
  behind a blank count as the number's, which hides them but does not link it. National forms of other countries stay in clear;
- e-mail addresses (local part of 64 characters at most): ASCII letters and digits of the local part and of the first
  label after the @, each within its kind. The rest of the domain stays; other letters stay.

The permutation is a Feistel network: a value is a row of numbers with a radix each, cut in two halves; in each
of ROUNDS rounds the numbers of one half move, modulo their radix, by a keyed hash of the other half. That is a
bijection whatever the hash gives, so different values keep different pseudonyms, and equal values have equal ones
in all documents and separators. The same network runs backwards for who holds the key.

Every pattern begins where its first character can begin a value and is of bounded length, so a text takes time in
proportion to its length, unbroken or not.

Defined cases: null texts stay null; numbers that fail their check stay; overlapping candidates go to the one that
starts first, card numbers are sought in what the others leave; very long texts are treated whole; repeated rows get
equal results; other columns pass through, but n_found replaces a column of that name; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, unused

ROUNDS = 8

_EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]{1,64}+@[A-Za-z0-9-]{1,63}+\.[A-Za-z0-9][A-Za-z0-9.-]{0,190}(?<![.])"
_DATE = r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4})(?![0-9/-]|\.[0-9])"
_IP = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_DOTTED = r"(?<![0-9.])[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}(?![0-9]|\.[0-9])"
# The country codes of one and of two digits; all others have three. And the digits after some codes, where
# their number is fixed.
CODES = {1: "1 7".split(), 2: "20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 81 82 84 86 90 91 92 93 94 95 98".split()}
NATIONAL = {9: "31 33 34 41 48 61".split(), 10: "1 7 44 91".split(), 11: "86".split()}

_LOCAL = r"(?:\([0-9]{3}\) ?[0-9]{3}-[0-9]{4}|(?:1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}|(?:1\.)?[0-9]{3}\.[0-9]{3}\.[0-9]{4})(?![0-9]|[.-][0-9])"
#: Where another value begins, a telephone number of unknown length ends.
_OTHER = (
    r"[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}|[0-9]{2}[./][0-9]{2}[./][0-9]{4}|[0-9]{1,3}(?:\.[0-9]{1,3}){3}|[0-9]{3}-[0-9]{2}-[0-9]{4}"
    r"|[0-9]{4}(?:[ .-][0-9]{4}){3}(?![ .-]?[0-9]{4})|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}(?![0-9])|[0-9]{13}"
)


def _steps(least: int, most: int, guard: str = "", ahead: str = "") -> str:
    """So many digits, with up to two separators before each, but not where the guards find something."""
    return rf"(?:(?:{ahead}[ .()-]{{1,2}}{guard})?[0-9]){{{least},{most}}}"


def _abroad() -> str:
    """+, country code and number: as many digits as the code has, if that is known, else 8 to 15 in all."""
    fixed = "|".join(f"(?:{'|'.join(codes)}){_steps(n, n)}" for n, codes in NATIONAL.items())
    free = _steps(7, 14, f"(?!{_OTHER}|{_LOCAL})", rf"(?![ .-]?{_LOCAL})")
    return rf"(?<![0-9+])\+(?:(?:{fixed})(?![0-9])|[0-9]{free}(?![0-9]))"


_PHONE = rf"{_abroad()}|(?<![0-9.-]){_LOCAL}"
#: In the order in which they are tried at a place; a value begins with a digit, + or ( unless it is an address.
KINDS = {"date": _DATE, "ip": _IP, "ssn": _SSN, "dotted": _DOTTED, "phone": _PHONE}
_NUMBERS = "(?=[0-9+(])(?:" + "|".join(KINDS.values()) + ")"
_ANY = _EMAIL + "|" + _NUMBERS
#: Digits, with spaces or hyphens between their groups (more than one of them end a row of groups), up to the last digit.
_RUN = r"(?<![0-9+])[0-9](?:[ -]*+[0-9])*+"
_LONG_RUN = "[0-9](?:[ -]?[0-9]){12}"
#: Stands around what is found while a text is cut.
_MARK = ""


def _draw(key: str, kind: str, turn: Column, i: Column, other: Column) -> Column:
    """A keyed 48-bit number, by HMAC-SHA-256."""
    said = F.concat_ws("|", F.lit(kind), turn.cast("string"), i.cast("string"), F.array_join(F.transform(other, lambda x: x.cast("string")), ","))
    block = key.encode() if len(key.encode()) <= 64 else hashlib.sha256(key.encode()).digest()
    inner, outer = (F.lit(bytearray(b ^ pad for b in block.ljust(64, b"\0"))) for pad in (0x36, 0x5C))
    digest = F.sha2(F.concat(outer, F.unhex(F.sha2(F.concat(inner, said.cast("binary")), 256))), 256)
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("long")


def feistel(values: Column, radices: Column, key: str, kind: str, backwards: bool = False) -> Column:
    """Permutes array<bigint> values, each below its radix, among all such arrays."""
    long = "array<bigint>"

    def run(v: Column, r: Column) -> Column:
        n = F.size(v)
        half = F.ceil(n / F.lit(2)).cast("int")
        left = lambda x: F.slice(x, F.lit(1), half)
        right = lambda x: F.slice(x, half + 1, n - half)

        def turn(state: Column, t: Column) -> Column:
            def moved(own: Column, radix: Column, other: Column) -> Column:
                step = lambda x, i: (_draw(key, kind, t, i, F.concat(F.array(n.cast("long")), other)) % F.get(radix, i))
                shift = lambda x, i: F.pmod(x - step(x, i) if backwards else x + step(x, i), F.get(radix, i))
                return F.transform(own, shift)

            odd = t % 2 == 1
            return F.struct(
                F.when(odd, moved(state["a"], left(r), state["b"])).otherwise(state["a"]).cast(long).alias("a"),
                F.when(odd, state["b"]).otherwise(moved(state["b"], right(r), state["a"])).cast(long).alias("b"),
            )

        turns = F.sequence(F.lit(ROUNDS), F.lit(1)) if backwards else F.sequence(F.lit(1), F.lit(ROUNDS))
        start = F.struct(left(v).cast(long).alias("a"), right(v).cast(long).alias("b"))
        return F.aggregate(turns, start, turn, lambda s: F.concat(s["a"], s["b"]))

    return let(values.cast(long), lambda v: let(radices.cast(long), lambda r: run(v, r)))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _numbers(digits: Column) -> Column:
    return F.transform(F.split(digits, ""), lambda c: c.cast("bigint"))


def _tens(n: Column) -> Column:
    return F.transform(n, lambda x: F.lit(10).cast("long"))


def luhn_sum(numbers: Column) -> Column:
    """The Luhn sum of digits that end with the check digit."""
    return F.aggregate(
        F.transform(F.reverse(numbers), lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, 2 * d - 9).otherwise(2 * d))), F.lit(0).cast("long"), lambda a, x: a + x
    )


def _refill(form: Column, symbols: Column, pattern: str) -> Column:
    """form with the characters that match pattern replaced, in order, by symbols."""
    chars = F.split(form, "")
    start = F.struct(F.lit("").alias("s"), F.lit(0).alias("i"))
    put = lambda a, c: F.when(c.rlike(pattern), F.struct(F.concat(a["s"], F.get(symbols, a["i"])).alias("s"), (a["i"] + 1).alias("i"))).otherwise(
        F.struct(F.concat(a["s"], c).alias("s"), a["i"].alias("i"))
    )
    return F.aggregate(chars, start, put, lambda a: a["s"])


def _strings(numbers: Column) -> Column:
    return F.transform(numbers, lambda x: x.cast("string"))


def _card(m: Column, key: str) -> Column:
    def of(n: Column) -> Column:
        body = F.slice(n, F.lit(1), F.size(n) - 1)

        def put(b: Column) -> Column:
            check = F.pmod(-luhn_sum(F.concat(b, F.array(F.lit(0).cast("long")))), F.lit(10).cast("long"))
            return _refill(m, _strings(F.concat(b, F.array(check))), "[0-9]")

        return F.when(luhn_sum(n) % 10 == 0, let(feistel(body, _tens(body), key, "card"), put)).otherwise(m)

    return let(_numbers(_digits(m)), of)


def _date(m: Column, key: str) -> Column:
    """Layouts: year first, else day before month where that is a date, else month before day."""
    d = _digits(m)
    first = m.rlike("^[0-9]{4}")
    iso = lambda y, mo, da: F.try_to_timestamp(F.concat_ws("-", F.substring(d, *y), F.substring(d, *mo), F.substring(d, *da)), F.lit("yyyy-MM-dd")).cast("date")
    ymd, dmy, mdy = iso((1, 4), (5, 2), (7, 2)), iso((5, 4), (3, 2), (1, 2)), iso((5, 4), (1, 2), (3, 2))
    layout = F.when(first, "yyyyMMdd").when(dmy.isNotNull(), "ddMMyyyy").otherwise("MMddyyyy")
    day = F.when(first, ymd).otherwise(F.coalesce(dmy, mdy))

    def of(x: Column) -> Column:
        begin = F.make_date(F.floor(F.year(x["day"]) / 100).cast("int") * 100, F.lit(1), F.lit(1))
        # A century has 36524 = 92 * 397 days, or 36525 = 75 * 487 if its first year is a leap year.
        leap = F.dayofmonth(F.last_day(F.date_add(begin, 31))) == 29
        wide = F.when(leap, F.lit(487)).otherwise(F.lit(397)).cast("long")
        tall = F.when(leap, F.lit(75)).otherwise(F.lit(92)).cast("long")
        n = F.datediff(x["day"], begin).cast("long")
        moved = feistel(F.array((n / wide).cast("long"), n % wide), F.array(tall, wide), key, "date")
        new = let(moved, lambda v: F.date_add(begin, (F.get(v, F.lit(0)) * wide + F.get(v, F.lit(1))).cast("int")))
        said = F.when(x["layout"] == "yyyyMMdd", F.date_format(new, "yyyyMMdd")).when(x["layout"] == "ddMMyyyy", F.date_format(new, "ddMMyyyy")).otherwise(F.date_format(new, "MMddyyyy"))
        return F.when(x["day"].isNull(), m).otherwise(_refill(m, F.split(said, ""), "[0-9]"))

    return let(F.struct(day.alias("day"), layout.alias("layout")), of)


def _ip(m: Column, key: str) -> Column:
    def of(n: Column) -> Column:
        same = F.transform(n, lambda x: F.lit(256).cast("long"))
        padded = F.transform(F.split(m, r"\."), lambda x: x.rlike("^0[0-9]"))
        form = lambda x, i: F.when(F.get(padded, i), F.lpad(x.cast("string"), 3, "0")).otherwise(x.cast("string"))
        return F.when(F.exists(n, lambda x: x > 255), m).otherwise(let(feistel(n, same, key, "ip"), lambda v: F.array_join(F.transform(v, form), ".")))

    return let(F.transform(F.split(m, r"\."), lambda x: x.cast("bigint")), of)


def _ssn(m: Column, key: str) -> Column:
    def of(n: Column) -> Column:
        area, group, serial = (F.get(n, F.lit(i)) for i in range(3))
        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        index = F.when(area > 666, area - 2).otherwise(area - 1)
        moved = feistel(F.array(index, group - 1, serial - 1), F.array(*(F.lit(x).cast("long") for x in (898, 99, 9999))), key, "ssn")
        back = lambda v: F.format_string("%03d-%02d-%04d", F.when(F.get(v, F.lit(0)) >= 665, F.get(v, F.lit(0)) + 2).otherwise(F.get(v, F.lit(0)) + 1), F.get(v, F.lit(1)) + 1, F.get(v, F.lit(2)) + 1)
        return F.when(valid, let(moved, back)).otherwise(m)

    return let(F.transform(F.split(m, "-"), lambda x: x.cast("bigint")), of)


def _phone(m: Column, key: str) -> Column:
    """The digits after the country code are permuted, whatever stands between them."""
    has_code = m.startswith("+") | (F.length(_digits(m)) > 10)
    digits = F.when(has_code, _digits(m)).otherwise(F.concat(F.lit("1"), _digits(m)))
    code = lambda d: F.when(F.substring(d, 1, 1).isin(CODES[1]), 1).when(F.substring(d, 1, 2).isin(CODES[2]), 2).otherwise(3)

    def of(d: Column) -> Column:
        own = _numbers(F.substr(d, code(d) + 1))
        kept = F.when(has_code, F.split(F.substring(d, F.lit(1), code(d)), "")).otherwise(F.array().cast("array<string>"))
        put = lambda v: _refill(m, F.concat(kept, _strings(v)), "[0-9]")
        return let(feistel(own, _tens(own), key, "phone"), put)

    return let(digits, of)


_ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def _email(m: Column, key: str) -> Column:
    """Letters stay letters and digits digits; capitals count as small letters, so that both are linked."""
    head = F.regexp_extract(F.lower(m), r"^[^@]+@[^.]+", 0)
    rest = F.substr(m, F.length(head) + 1)

    def of(h: Column) -> Column:
        own = F.regexp_extract_all(h, F.lit("([a-z0-9])"), F.lit(1))
        digit = lambda c: c.rlike("[0-9]")
        values = F.transform(own, lambda c: F.when(digit(c), F.ascii(c) - 48).otherwise(F.ascii(c) - 97).cast("bigint"))
        radices = F.transform(own, lambda c: F.when(digit(c), F.lit(10)).otherwise(F.lit(26)).cast("bigint"))
        # Which places hold digits is part of the format, hence of the key.
        moved = feistel(values, radices, key, "email")
        back = lambda v: F.transform(v, lambda x, i: F.when(digit(F.get(own, i)), x.cast("string")).otherwise(F.substr(F.lit(_ALPHABET), (x + 1).cast("int"), F.lit(1))))
        return F.concat(_refill(h, let(moved, back), "[a-z0-9]"), rest)

    return let(head, of)


def replaced(m: Column, key: str) -> Column:
    """The pseudonym of one match, or the match itself if it is no valid value."""
    whole = lambda k: m.rlike(f"^(?:{KINDS[k]})$")
    return F.when(m.contains("@"), _email(m, key)).when(whole("date"), _date(m, key)).when(whole("ip"), _ip(m, key)).when(whole("ssn"), _ssn(m, key)).when(whole("dotted"), _card(m, key)).otherwise(_phone(m, key))


def _in_run(run: Column, key: str) -> Column:
    """A run of digit groups with its cards replaced: t, and n, the number of cards."""

    def of(x: Column) -> Column:
        groups, seps = x["g"], x["s"]
        n = F.size(groups)
        places = F.sequence(F.lit(0), n - 1)

        def valid(i: Column, j: Column) -> Column:
            single = F.forall(F.slice(seps, i + 2, j - i), lambda s: F.length(s) == 1)
            luhn = lambda d: F.length(d).between(13, 19) & d.rlike("[1-9]") & (luhn_sum(_numbers(d)) % 10 == 0)
            return single & let(F.array_join(F.slice(groups, i + 1, j - i + 1), ""), luhn)

        def last(i: Column) -> Column:
            some = F.filter(F.sequence(i, F.least(i + 18, n - 1)), lambda j: valid(i, j))
            return F.when(F.length(F.get(groups, i)) <= 19, F.array_max(some))

        def pick(state: Column, i: Column) -> Column:
            end = F.get(x["ends"], i)
            hit = (i >= state["free"]) & end.isNotNull()
            at = F.concat(state["at"], F.array(F.struct(i.alias("i"), end.alias("j"))))
            return F.struct(F.when(hit, end + 1).otherwise(state["free"]).alias("free"), F.when(hit, at).otherwise(state["at"]).alias("at"))

        def put(picks: Column) -> Column:
            def part(k: Column) -> Column:
                mine = F.get(F.filter(picks, lambda p: p["i"] == k), F.lit(0))
                inside = F.exists(picks, lambda p: (p["i"] < k) & (k <= p["j"]))
                before = lambda j: F.concat(F.array(F.lit("")), F.slice(seps, k + 2, j - k))
                card = lambda j: F.array_join(F.zip_with(before(j), F.slice(groups, k + 1, j - k + 1), lambda s, g: F.concat(s, g)), "")
                own = F.when(mine.isNull(), F.get(groups, k)).otherwise(let(card(mine["j"]), lambda c: _card(c, key)))
                return F.when(inside, "").otherwise(F.concat(F.get(seps, k), own))

            return F.struct(F.concat(F.array_join(F.transform(places, part), ""), F.get(seps, n)).alias("t"), F.size(picks).cast("long").alias("n"))

        if "ends" not in made:
            made.append("ends")
            return let(F.transform(places, last), lambda ends: of(F.struct(groups.alias("g"), seps.alias("s"), ends.alias("ends"))))
        start = F.struct(F.lit(0).alias("free"), F.array().cast("array<struct<i:int,j:int>>").alias("at"))
        none = F.struct(run.alias("t"), F.lit(0).cast("long").alias("n"))
        return F.when(F.forall(x["ends"], lambda e: e.isNull()), none).otherwise(let(F.aggregate(places, start, pick, lambda st: st["at"]), put))

    made: list[str] = []
    return let(F.struct(F.regexp_extract_all(run, F.lit("[0-9]+"), F.lit(0)).alias("g"), F.split(run, "[0-9]+", -1).alias("s")), of)


def _cut(text: Column, pattern: str) -> Column:
    """What stands between the matches of a pattern and, at odd places, the matches."""
    marked = F.split(F.regexp_replace(text, f"(?:{pattern})", f"{_MARK}$0{_MARK}"), _MARK, -1)
    # A text that holds the mark itself is scanned twice.
    gaps, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    woven = F.flatten(F.zip_with(gaps, found, lambda g, m: F.when(m.isNull(), F.array(g)).otherwise(F.array(g, m))))
    return F.when(text.contains(_MARK), woven).otherwise(marked)


def _cards(text: Column, key: str) -> Column:
    """A text without other numbers, with its cards replaced: t and n."""
    none = F.struct(text.alias("t"), F.lit(0).cast("long").alias("n"))
    odd = lambda x, i: F.when((i % 2 == 1) & x.rlike(_LONG_RUN), _in_run(x, key)).otherwise(F.struct(x.alias("t"), F.lit(0).cast("long").alias("n")))
    return F.when(text.rlike(_LONG_RUN), let(F.transform(_cut(text, _RUN), odd), _joined)).otherwise(none)


def _joined(parts: Column) -> Column:
    return F.struct(F.array_join(F.transform(parts, lambda p: p["t"]), "").alias("t"), F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + p["n"]).alias("n"))


def pseudonymize(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """docs with pseudonyms in text, and n_found, the number of values replaced. Who holds the key can undo them."""
    t = F.col(text)

    def part(x: Column, i: Column) -> Column:
        value = let(replaced(x, key), lambda v: F.struct(v.alias("t"), F.when(v == x, 0).otherwise(1).cast("long").alias("n")))
        return F.when(i % 2 == 1, value).otherwise(_cards(x, key))

    cut = F.when(t.contains("@"), _cut(t, _ANY)).otherwise(_cut(t, _NUMBERS))
    both = F.when(t.rlike("[0-9@]"), let(F.transform(cut, part), _joined))
    own = unused(docs, "found")
    out = docs.withColumn(own, both)
    return out.withColumns({text: F.coalesce(F.col(own)["t"], t), "n_found": F.coalesce(F.col(own)["n"], F.lit(0)).cast("long")}).drop(own)

"""Khmer text normalisation: numbers, currency, dates and percentages as spoken words. Native expressions; NFC and amounts
of money are Arrow UDFs."""

from __future__ import annotations

import re
from fractions import Fraction
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import python
from .rx import SPACE, WORD, group, let, strip, sub, sub_text

# The Khmer digits and number words.
KHMER_DIGITS = "០១២៣៤៥៦៧៨៩"
ONES = ("សូន្យ", "មួយ", "ពីរ", "បី", "បួន", "ប្រាំ", "ប្រាំមួយ", "ប្រាំពីរ", "ប្រាំបី", "ប្រាំបួន")
TENS = ("", "ដប់", "ម្ភៃ", "សាមសិប", "សែសិប", "ហាសិប", "ហុកសិប", "ចិតសិប", "ប៉ែតសិប", "កៅសិប")
HUNDRED, THOUSAND, MILLION, BILLION = "រយ", "ពាន់", "លាន", "ពាន់លាន"
MINUS, POINT = "ដក", "ចុច"
DOLLAR, CENT, RIEL, PERCENT = "ដុល្លារ", "សេន", "រៀល", "ភាគរយ"
DAY, MONTH, YEAR = "ថ្ងៃទី", "ខែ", "ឆ្នាំ"
MONTHS = ("មករា", "កុម្ភៈ", "មីនា", "មេសា", "ឧសភា", "មិថុនា", "កក្កដា", "សីហា", "កញ្ញា", "តុលា", "វិច្ឆិកា", "ធ្នូ")
# Punctuation replaced in this order, and characters deleted.
PUNCTUATION = (("…", "។"), ("..", "."), ("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("–", "-"), ("—", "-"))
ZERO_WIDTH = "\u200b\u200c\u200d\ufeff"
COENG = "\u17d2"

#: What one space stands for: a lone space stays as it is, so that most of a text is passed over.
_BLANKS = r"[ \t\u00a0]{2,}|[\t\u00a0]"
_AMOUNT = r"-?(?:\p{Nd}{1,3}(?:,\p{Nd}{3})+|\p{Nd}+)"
_BEFORE, _AFTER = rf"(?<!{WORD})", rf"(?!{WORD})"
PATTERNS = {
    "dollar": rf"\${SPACE}*({_AMOUNT}(?:\.\p{{Nd}}{{1,2}})?)",
    "riel_before": rf"៛{SPACE}*({_AMOUNT}(?:\.\p{{Nd}}+)?)",
    "riel_after": rf"({_AMOUNT}(?:\.\p{{Nd}}+)?){SPACE}*៛",
    "riel_word": rf"({_AMOUNT}(?:\.\p{{Nd}}+)?){SPACE}*{RIEL}",
    "full_date": rf"{DAY}{SPACE}*([0-9០-៩]{{1,2}}){SPACE}*{MONTH}{SPACE}*([0-9០-៩]{{1,2}}|[ក-អ]+){SPACE}*{YEAR}{SPACE}*([0-9០-៩]{{4}})",
    "numeric_date": rf"(?=[0-9]){_BEFORE}([0-3]?[0-9])[/\-]([01]?[0-9])[/\-]([12][0-9]{{3}}){_AFTER}",
    "year": rf"{YEAR}{SPACE}*([0-9០-៩]{{4}})",
    "percent": rf"(-?\p{{Nd}}+(?:\.\p{{Nd}}+)?){SPACE}*%",
    "number": rf"(?=[-\p{{Nd}}])(?<![\p{{L}}\p{{N}}_.]){_AMOUNT}(?:\.\p{{Nd}}+)?{_AFTER}",
    "khmer_number": r"[០-៩]+(?:\.[០-៩]+)?",
}


def _table(words, n: Column) -> Column:
    return F.get(F.array(*map(F.lit, words)), n.cast("int"))


def _below_1000(n: Column) -> Column:
    """Words of 1 to 999; nothing for 0."""
    hundreds, rest = (n / 100).cast("int"), n % 100
    tens, ones = (rest / 10).cast("int"), rest % 10
    name = lambda d: F.when(d > 0, _table(ONES, d)).otherwise("")
    return F.concat(F.when(hundreds > 0, F.concat(_table(ONES, hundreds), F.lit(HUNDRED))).otherwise(""), _table(TENS, tens), name(ones))


def _below_billion(n: Column) -> Column:
    part = lambda x, word: F.when(x > 0, F.concat(let(x, _below_1000), F.lit(word))).otherwise("")
    return F.concat(part((n / 1_000_000).cast("int"), MILLION), part((n / 1000).cast("int") % 1000, THOUSAND), part(n % 1000, ""))


def digits_words(digits: Column) -> Column:
    """Words of a string of ASCII digits of any length: nine at a time, each group counting the billions before it."""

    def of(d: Column) -> Column:
        padded = F.lpad(d, ((F.length(d) + 8) / 9).cast("int") * 9, "0")
        groups = F.regexp_extract_all(padded, F.lit("[0-9]{9}"), F.lit(0))
        join = lambda a, g: F.concat(F.when(a != "", F.concat(a, F.lit(BILLION))).otherwise(""), let(g.cast("int"), _below_billion))
        return let(F.aggregate(groups, F.lit(""), join), lambda w: F.when(w == "", F.lit(ONES[0])).otherwise(w))

    return let(digits, of)


def arabic_digits(text: Column) -> Column:
    return F.translate(text, KHMER_DIGITS, "0123456789")


def khmer_digits(text: Column) -> Column:
    return F.translate(text, "0123456789", KHMER_DIGITS)


def number_words(number: Column) -> Column:
    """Words of a decimal numeral (sign and fraction allowed, digits of either script). Ten decimals count."""

    def of(s: Column) -> Column:
        whole = F.regexp_extract(s, "^-?([0-9]+)", 1)
        fraction = F.rtrim(F.substring(F.regexp_extract(s, r"\.([0-9]+)", 1), 1, 10), F.lit("0"))

        def said(f: Column) -> Column:
            spoken = F.array_join(F.transform(F.regexp_extract_all(f, F.lit("[0-9]"), F.lit(0)), lambda c: _table(ONES, c.cast("int"))), "")
            minus = F.when(s.startswith("-") & s.rlike("[1-9]"), F.lit(MINUS)).otherwise("")
            return F.concat(minus, digits_words(whole), F.when(f == "", F.lit("")).otherwise(F.concat(F.lit(POINT), spoken)))

        return let(fraction, said)

    return let(arabic_digits(strip(number.cast("string"))), of)


def _spoken_below_1000(n: int) -> str:
    hundreds, tens, ones = n // 100, n // 10 % 10, n % 10
    return (ONES[hundreds] + HUNDRED if hundreds else "") + TENS[tens] + (ONES[ones] if ones else "")


@lru_cache(maxsize=1 << 16)
def spoken(number: str) -> str:
    """number_words() of one numeral, for Python on executors."""
    s = number.strip().translate(_ARABIC)
    whole, fraction = re.match("-?([0-9]*)", s)[1], re.search(r"\.([0-9]+)", s)
    digits, words = whole.zfill(-(-len(whole) // 9) * 9), ""
    for i in range(0, len(digits), 9):
        words += BILLION if words else ""
        for x, word in ((int(digits[i : i + 3]), MILLION), (int(digits[i + 3 : i + 6]), THOUSAND), (int(digits[i + 6 : i + 9]), "")):
            words += _spoken_below_1000(x) + word if x else ""
    decimals = fraction[1][:10].rstrip("0") if fraction else ""
    minus = MINUS if s.startswith("-") and re.search("[1-9]", s) else ""
    return minus + (words or ONES[0]) + (POINT + "".join(ONES[int(c)] for c in decimals) if decimals else "")


_ARABIC = str.maketrans(KHMER_DIGITS, "0123456789")
_KHMER = re.compile("[០-៩]")
_NEAR = tuple((re.compile(p), signs) for p, signs in ((r"(?<=[$៛])[០-៩,.]+", "$៛"), (rf"[០-៩,.]+(?={SPACE}*៛)", "៛"), (rf"[០-៩,.]+(?={SPACE}*{RIEL})", (RIEL,))))
_SIGNS = ("$", "៛", RIEL)


def _dollars(m: re.Match) -> str:
    raw = m[1].replace(",", "").translate(_ARABIC)
    cents = re.search(r"\.([0-9]{1,2})", raw)
    cents = (cents[1] if cents else "").ljust(2, "0")
    main = spoken(re.match("-?[0-9]+|", raw)[0]) + DOLLAR
    return f"{main} {spoken(cents)}{CENT}" if "." in raw and cents != "00" else main


def _riels(m: re.Match) -> str:
    return spoken(m[1].replace(",", "")) + RIEL


_AMOUNTS = tuple(
    (re.compile(PATTERNS[name].replace(r"\p{Nd}", r"\d")), signs, of)
    for name, signs, of in (("dollar", "$", _dollars), ("riel_before", "៛", _riels), ("riel_after", "៛", _riels), ("riel_word", (RIEL,), _riels))
)


def _amounts_said(text: str | None) -> str | None:
    if text is None:
        return None
    if _KHMER.search(text):  # the Khmer digits of amounts as ASCII ones
        for pattern, signs in _NEAR:
            text = sub_text(text, pattern, lambda m: m[0].translate(_ARABIC), signs)
    for pattern, signs, of in _AMOUNTS:
        text = sub_text(text, pattern, of, signs)
    return text


def currency(text: Column) -> Column:
    """Amounts behind or before their sign as words. Only texts with such a sign are sent to Python, which takes half of the
    time of native expressions: those interpret what is nested in lambdas."""

    def run(s: pd.Series) -> pd.Series:
        return pd.Series([_amounts_said(x) for x in s], dtype=object)

    python()
    there = reduce(lambda a, b: a | b, (text.contains(sign) for sign in _SIGNS))
    return F.when(there, F.pandas_udf(run, "string")(F.when(there, text))).otherwise(text)


def _month(raw: Column, numeral: Column) -> Column:
    """The name of a month's number, else what was there."""
    return F.coalesce(F.get(F.array(*map(F.lit, MONTHS)), numeral - 1), raw)


def _date(day: Column, month: Column, year: Column) -> Column:
    return F.concat(F.lit(DAY), number_words(day), F.lit(f" {MONTH}"), month, F.lit(f" {YEAR}"), number_words(year))


def dates(text: Column) -> Column:
    full, numeric, year = (PATTERNS[n] for n in ("full_date", "numeric_date", "year"))

    def named(m: Column) -> Column:
        number = arabic_digits(group(m, full, 2)).try_cast("int")
        return _date(group(m, full, 1), F.when(number.between(1, 12), _month(group(m, full, 2), number)).otherwise(group(m, full, 2)), group(m, full, 3))

    def slashed(m: Column) -> Column:
        number = group(m, numeric, 2).cast("int")
        return _date(group(m, numeric, 1), F.when(number.between(1, 12), _month(number.cast("string"), number)).otherwise(number.cast("string")), group(m, numeric, 3))

    text = sub(text, full, named, (DAY,))
    text = sub(text, numeric, slashed, ("/1", "/2", "-1", "-2"))
    return sub(text, year, lambda m: F.concat(F.lit(YEAR), number_words(group(m, year, 1))), (YEAR,))


def percent(text: Column) -> Column:
    return sub(text, PATTERNS["percent"], lambda m: F.concat(number_words(group(m, PATTERNS["percent"], 1)), F.lit(PERCENT)), "%")


def numbers(text: Column) -> Column:
    text = sub(text, PATTERNS["number"], lambda m: number_words(F.replace(m, F.lit(","), F.lit(""))))
    return let(text, lambda t: F.when(t.rlike("[០-៩]"), sub(t, PATTERNS["khmer_number"], number_words)).otherwise(t))


def nfc(text: Column) -> Column:
    """Unicode NFC, in batches of bounded bytes. ASCII texts, and others without a character that NFC may change, still pass
    the UDF: Spark has no built-in for it, and the check would cost as much."""

    def run(s: pd.Series) -> pd.Series:
        return s.str.normalize("NFC")

    python()
    return F.pandas_udf(run, "string")(text)


def clean(text: Column, compose: bool = True) -> Column:
    """NFC, no zero-width characters, LF line ends, single spaces and line ends, stripped."""
    if compose:
        text = nfc(text)
    text = F.regexp_replace(text, f"[{ZERO_WIDTH}]+", "")
    for pattern, new in (("\r\n?", "\n"), (_BLANKS, " "), (r"\n{2,}", "\n")):
        text = F.regexp_replace(text, pattern, new)
    return strip(text)


def ordering(text: Column) -> Column:
    """One coeng for several; none before white space or the end."""
    fixed = lambda t: F.regexp_replace(F.regexp_replace(t, f"{COENG}{COENG}+", COENG), rf"{COENG}(?={SPACE}|\z)", "")
    return let(text, lambda t: F.when(t.contains(COENG), fixed(t)).otherwise(t))


def punctuation(text: Column) -> Column:
    for old, new in PUNCTUATION:
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def normalize(df: DataFrame, column: str = "text", compose: bool = True) -> DataFrame:
    """df with all rewrites of the column in their fixed order; null and empty texts stay.

    A projection a step: one expression of all would nest more lambdas than the analyzer resolves. They are
    joined to one stage when the plan is optimized.
    """
    for step in (lambda t: clean(t, compose), ordering, punctuation, currency, dates, percent, numbers, lambda t: strip(F.regexp_replace(t, _BLANKS, " "))):
        df = df.withColumn(column, step(F.col(column)))
    return df


def sentences(text: Column) -> Column:
    """array<string>: parts that end with a sentence's last mark, stripped, without empty ones."""
    return F.filter(F.transform(F.split(text, rf"(?<=[។!?]){SPACE}*"), strip), lambda s: s != "")


def _one_decimal(v: Column) -> Column:
    """A finite number with one decimal as C and Python write it: the exact binary value is rounded, halves to even. Spark's
    own format rounds the shortest decimal numeral, halves up."""

    def of(x: Column) -> Column:
        size = F.abs(x)
        whole = F.floor(size)

        def said(part: Column) -> Column:
            # How many of 1/20, 3/20 ... 19/20 the fraction is beyond; a double equal to one of these may lie on either side.
            up = lambda k: part >= k / 20 if (Fraction(k / 20), k // 2 % 2) > (Fraction(k, 20), 0) else part > k / 20
            tenths = sum((up(k).cast("long") for k in range(1, 20, 2)), F.lit(0).cast("long"))
            sign = F.when(F.signum(x) < 0, "-").otherwise("")
            return let(tenths, lambda d: F.concat(sign, (whole + F.when(d == 10, 1).otherwise(0)).cast("string"), F.lit("."), (d % 10).cast("string")))

        return let(size - whole, said)

    return let(v, of)


def human_bytes(n: Column) -> Column:
    """A size in units of 1024 with one decimal; null for null."""

    def of(x: Column) -> Column:
        out = F.concat(_one_decimal(x / F.lit(1024.0**4)), F.lit("TB"))
        for i, unit in reversed(list(enumerate(("B", "KB", "MB", "GB")))):
            out = F.when(x < F.lit(1024.0 ** (i + 1)), F.concat(_one_decimal(x / F.lit(1024.0**i)), F.lit(unit))).otherwise(out)
        return out

    return let(n, of)


def identifier(text: Column, empty: str = "unknown_speaker") -> Column:
    """Every character but letters and numbers as an underscore."""
    clean_ = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}\p{N}]", "_")
    return F.when(clean_ == "", F.lit(empty)).otherwise(clean_)


def stem(path: Column, suffix: str = ".wav") -> Column:
    """The base name with another suffix."""
    return F.concat(F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", ""), F.lit(suffix))

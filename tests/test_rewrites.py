"""Substitution in one pass, and the rewrites of numbers and whole texts over a table against a Python version."""

import os
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from tessera.functions import rx
from tessera.functions import text as T
from tessera.plans import catalog

D = "/root/testdata/sf0.001"


def test_sub_marks_matches_once(spark):
    rng = random.Random(1)
    texts = ["", "a1b22", "12", "x", None, "﷐1﷑", "﷐ no match ﷑", *("".join(rng.choice("ab12 .$\n") for _ in range(rng.randint(0, 30))) for _ in range(200))]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = df.select(rx.sub(F.col("t"), "[0-9]+", lambda m: F.concat(F.lit("<"), m, F.lit(">"))).alias("a"), rx.sub(F.col("t"), "[0-9]+", F.reverse, "12", "ab").alias("b"), rx.strip(F.col("t")).alias("s")).collect()
    for x, r in zip(texts, got, strict=True):
        if x is None:
            assert r.a is None and r.b is None
            continue
        clean = re.sub("[﷐﷑]", "", x) if re.search("[0-9]", x) else x
        assert r.a == re.sub("[0-9]+", lambda m: f"<{m[0]}>", clean)
        assert r.b == (re.sub("[0-9]+", lambda m: m[0][::-1], clean) if re.search("[12]", x) and re.search("[ab]", x) else x) and r.s == x.strip()


def said(n: int) -> str:
    if n < 10:
        return T.ONES[n]
    for size, name in ((10**9, T.BILLION), (10**6, T.MILLION), (1000, T.THOUSAND), (100, T.HUNDRED)):
        if n >= size:
            return said(n // size) + name + (said(n % size) if n % size else "")
    return T.TENS[n // 10] + (T.ONES[n % 10] if n % 10 else "")


def spoken(m: str) -> str:
    """A decimal numeral of ASCII digits as words."""
    whole, _, part = m.removeprefix("-").partition(".")
    part = part[:10].rstrip("0")
    minus = T.MINUS if m.startswith("-") and re.search("[1-9]", m) else ""
    return minus + said(int(whole)) + (T.POINT + "".join(T.ONES[int(d)] for d in part) if part else "")


AMOUNT = r"-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)"
WORDLY = "[^\\W]"


def is_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LN"


def numbers(text: str) -> str:
    """Numerals that stand alone, read aloud: not behind a word's character or a point, and not before a word's one. Tables
    hold no other digits than ASCII ones."""
    out, i = [], 0
    token = re.compile(AMOUNT + r"(?:\.[0-9]+)?")
    while i < len(text):
        m = token.match(text, i) if i == 0 or not (is_word(text[i - 1]) or text[i - 1] == ".") else None
        if m:  # the longest form that no word's character follows
            for end in range(m.end(), i, -1):
                if token.fullmatch(text, i, end) and not (end < len(text) and is_word(text[end])):
                    out.append(spoken(text[i:end].replace(",", "")))
                    i = end
                    break
            else:
                out.append(text[i])
                i += 1
        else:
            out.append(text[i])
            i += 1
    return "".join(out)


def normalized(text: str) -> str:
    for old, new in ((f"[{T.ZERO_WIDTH}]", ""), ("\r\n?", "\n"), ("[ \t ]+", " "), ("\n{2,}", "\n")):
        text = re.sub(old, new, unicodedata.normalize("NFC", text))
    text = text.strip()
    for old, new in T.PUNCTUATION:
        text = text.replace(old, new)

    def dollars(m):
        raw = m[1].replace(",", "")
        whole, _, cents = raw.partition(".")
        cents = cents[:2].ljust(2, "0") if cents else "00"
        return spoken(whole) + T.DOLLAR + (f" {spoken(cents)}{T.CENT}" if cents != "00" else "")

    text = re.sub(r"\$\s*(" + AMOUNT + r"(?:\.[0-9]{1,2})?)", dollars, text)

    def date(m):
        return f"{T.DAY}{spoken(m[1])} {T.MONTH}{T.MONTHS[int(m[2]) - 1] if 1 <= int(m[2]) <= 12 else spoken(m[2])} {T.YEAR}{spoken(m[3])}"

    free = r"(?<![^\W])([0-3]?[0-9])[/\-]([01]?[0-9])[/\-]([12][0-9]{3})(?![^\W])"
    text = re.sub(free, date, text)
    text = re.sub(r"(-?[0-9]+(?:\.[0-9]+)?)\s*%", lambda m: spoken(m[1]) + T.PERCENT, text)
    return re.sub("[ \t ]+", " ", numbers(text)).strip()


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", ["bare_number_rewrite", "normalize_text"])
def test_rewrites_of_documents(spark, name):
    docs = spark.read.parquet(f"{D}/documents.parquet").collect()
    make = {"bare_number_rewrite": lambda r: numbers(f"n 1,234 and -7.5 x9 {r.doc_id} {r.text}"), "normalize_text": lambda r: normalized(f"${r.doc_id} 25% {r.text}")}[name]
    want = {r.doc_id: make(r) for r in docs}
    got = {r.doc_id: r.said for r in catalog.QUERIES[name](spark, D).collect()}
    assert len(got) == len(want)
    wrong = [(i, got[i], want[i]) for i in want if got[i] != want[i]]
    assert not wrong, wrong[0]

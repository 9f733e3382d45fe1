import unicodedata

from pyspark.sql import functions as F

from tessera.functions import text as T

GOLDEN = [
    ("ខ្ញុំមាន $10 នៅឆ្នាំ 2026។", "ខ្ញុំមាន ដប់ដុល្លារ នៅឆ្នាំពីរពាន់ម្ភៃប្រាំមួយ។"),
    ("តម្លៃ ៛5000 សម្រាប់ម្ហូបនេះ។", "តម្លៃ ប្រាំពាន់រៀល សម្រាប់ម្ហូបនេះ។"),
    ("ថ្ងៃទី 5 ខែមករា ឆ្នាំ 2026 គឺជាថ្ងៃចាប់ផ្តើម។", "ថ្ងៃទី ប្រាំ ខែមករា ឆ្នាំពីរពាន់ម្ភៃប្រាំមួយ គឺជាថ្ងៃចាប់ផ្តើម។"),
    ("តម្លៃបញ្ចុះ 25% សម្រាប់អតិថិជនថ្មី។", "តម្លៃបញ្ចុះ ម្ភៃប្រាំភាគរយ សម្រាប់អតិថិជនថ្មី។"),
    ("ថ្ងៃនេះ អាកាសធាតុល្អណាស់។", "ថ្ងៃនេះ អាកាសធាតុល្អណាស់។"),
    ("15នាក់", "15នាក់"),
    ("....", ".."),
    ("$-0.50", "សូន្យដុល្លារ ហាសិបសេន"),
    ("1,234%", "មួយ,ពីររយសាមសិបបួនភាគរយ"),
    ("$12.05 x", "ដប់ពីរដុល្លារ ប្រាំសេន x"),
    ("05/01/2026", "ថ្ងៃទីប្រាំ ខែមករា ឆ្នាំពីរពាន់ម្ភៃប្រាំមួយ"),
    ("01/13/2026", "ថ្ងៃទីមួយ ខែដប់បី ឆ្នាំពីរពាន់ម្ភៃប្រាំមួយ"),
    ("១៥នាក់", "ដប់ប្រាំនាក់"),
    ("5000 រៀល", "ប្រាំពាន់រៀល"),
    ("a​b\r\n\r\nc  d ", "ab\nc d"),
    ("", ""),
    (None, None),
]


def test_normalize(spark):
    rows = spark.createDataFrame(list(enumerate(x for x, _ in GOLDEN)), "i int, s string")
    got = {r.i: r.n for r in T.normalize(rows.withColumnRenamed("s", "n"), "n").collect()}
    want = {i: y for i, (_, y) in enumerate(GOLDEN)}
    assert {i: (GOLDEN[i][0], got[i], want[i]) for i in got if got[i] != want[i]} == {}


def words(n: int) -> str:
    """Number words, written anew by recursion over the scales."""
    if n < 0:
        return T.MINUS + words(-n)
    if n < 10:
        return T.ONES[n]
    for size, name in ((10**9, T.BILLION), (10**6, T.MILLION), (1000, T.THOUSAND), (100, T.HUNDRED)):
        if n >= size:
            return words(n // size) + name + (words(n % size) if n % size else "")
    return T.TENS[n // 10] + (T.ONES[n % 10] if n % 10 else "")


def test_number_words(spark):
    numbers = [0, 7, 10, 21, 99, 100, 110, 999, 1000, 1500, 2026, 10**6, 1234567, 10**9, 10**12, 123456789012345678, 10**21 + 5, -42, *range(11, 3000, 37)]
    got = spark.createDataFrame([(str(n),) for n in numbers], "n string").select(T.number_words(F.col("n")).alias("w")).collect()
    assert [r.w for r in got] == [words(n) for n in numbers]
    some = {"15.5": "ដប់ប្រាំចុចប្រាំ", "-0.50": "ដកសូន្យចុចប្រាំ", "1.00": "មួយ", "១៥": "ដប់ប្រាំ", "-0": "សូន្យ"}
    got = spark.createDataFrame([(k,) for k in some], "n string").select("n", T.number_words(F.col("n")).alias("w")).collect()
    assert {r.n: r.w for r in got} == some


def test_small_functions(spark):
    row = spark.range(1).select(
        T.sentences(F.lit("a. ខ។ គ!  ឃ? ")).alias("s"), T.identifier(F.lit("a b-ខ")).alias("i"), T.identifier(F.lit("")).alias("e"), T.stem(F.lit("x/y.z/c.d.mp3")).alias("t"),
        T.human_bytes(F.lit(1536.0)).alias("h"), T.khmer_digits(F.lit("a10")).alias("k"), T.ordering(F.lit("ក្្ខ្ គ្")).alias("o"),
    ).first()
    assert row.s == ["a. ខ។", "គ!", "ឃ?"] and row.i == "a_b_ខ" and row.e == "unknown_speaker" and row.t == "c.d.wav" and row.h == "1.5KB" and row.k == "a១០" and row.o == "ក្ខ គ"
    assert unicodedata.category("្") == "Mn"


def test_human_bytes_rounds_the_exact_value(spark):
    """One decimal as C and Python write it, also where the shortest numeral ends in 5; null stays null."""

    def human(n: float) -> str:
        for unit in ("B", "KB", "MB", "GB"):
            if n < 1024:
                return f"{n:.1f}{unit}"
            n /= 1024
        return f"{n:.1f}TB"

    sizes = [x * 1024.0**i for i in range(5) for x in [1.25, 7.75, 0.25, 0.75, 1.05, 1.15, 2.35, 2.45, 0.55, 0.65, 8.85, 8.95, 1023.95, 1023.96, 1000.0, 0.05, 0.0, 3.0]]
    sizes += [float(1024 * k + j) for k in range(1, 40) for j in (256, 768, 51, 52, 972, 973)]
    rows = spark.createDataFrame([(x,) for x in [*sizes, None]], "n double").select("n", T.human_bytes(F.col("n")).alias("h")).collect()
    assert [(r.n, r.h) for r in rows if r.h != (None if r.n is None else human(r.n))] == []


def test_python_gets_batches_of_bounded_bytes(spark):
    """Long texts come to NFC in small batches."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    T.nfc(F.lit("x"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20


def test_currency_is_one_python_step(spark):
    """Amounts are said in Python, once a text, and the words are those of the native expression."""
    numerals = ["0", "7", "-12", "1000000000", "123456789012345678", "15.50", "-0.0", "១២.៥", "٣", "1.", ""]
    got = spark.createDataFrame([(n,) for n in numerals], "n string").select(T.number_words(F.col("n")).alias("w")).collect()
    assert [r.w for r in got] == [T.spoken(n) for n in numerals]
    df = spark.createDataFrame([("$១,២៣៤.5 and ៥ រៀល",), ("x",), (None,)], "t string").select(T.currency(F.col("t")).alias("c"))
    assert [r.c for r in df.collect()] == [f"{T.spoken('1234')}{T.DOLLAR} {T.spoken('50')}{T.CENT} and {T.spoken('5')}{T.RIEL}", "x", None]
    assert "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()

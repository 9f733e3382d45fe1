"""Quality rules as a bitmask ledger (native expressions only).

Every rule is evaluated once per document. The ledger keeps one failure bit a rule and the measurements
behind it, so that a policy (a named, versioned set of rules) is a bitwise AND on a stored number and the
effect of leaving a rule out is an aggregate over distinct masks; no text is read again.

Defined cases: null text has no words and fails ``few_words``; a word of any length counts; repeated rows are
judged one by one; an empty table gives an empty ledger; columns that the ledger adds replace columns of the
same names in its result, and other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, let, unused, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_dup_lines", "n_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A rule fails where its SQL predicate over the measurements holds; bit is its place in the mask."""

    name: str
    bit: int
    fails: str


#: Bits are never reused: a stored ledger stays readable when rules are added.
RULES = (
    Rule("few_words", 0, "n_words < 50"),
    Rule("repeated_windows", 1, "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", 2, "10 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", 4, "word_chars < 2 * n_words"),
    Rule("long_words", 5, "word_chars > 15 * n_words"),
    Rule("exclamations", 6, "10 * n_exclaims > n_words"),
)
BASE = ("few_words", "repeated_windows")
POLICIES = {
    "base-1": BASE,
    "prose-1": (*BASE, "symbols", "repeated_lines"),
    "prose-2": (*BASE, "symbols", "repeated_lines", "short_words", "long_words"),
    "prose-3": (*BASE, "symbols", "repeated_lines", "short_words", "long_words", "exclamations"),
}
DEFAULT_POLICY = "prose-3"


def mask_of(names) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[n] for n in names)


def _repeat_words(w: Column) -> Column:
    """Words inside 3-word windows that occur twice or more.

    One sort of primitive longs (window hash above, position below) finds the candidates in n log n; the
    candidates, usually few, are then compared as strings, so the count is exact.
    """

    def by_hash(h: Column) -> Column:
        bits = F.length(F.bin(F.size(h).cast("long")))
        low = F.expr("1L")

        def packed(mask: Column) -> Column:
            windows = F.transform(
                F.slice(h, 1, F.size(h) - 2),
                lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long")),
            )

            def near(s: Column) -> Column:
                top = lambda x: F.coalesce(x.bitwiseAND(F.bitwise_not(mask)), F.lit(None).cast("long"))
                hits = F.filter(s, lambda x, i: (top(x).eqNullSafe(top(F.get(s, i + 1)))) | (top(x).eqNullSafe(top(F.get(s, i - 1)))))
                return F.transform(hits, lambda x: x.bitwiseAND(mask).cast("int"))

            return let(F.sort_array(windows), near)

        return let(F.call_function("shiftleft", low, bits) - F.lit(1).cast("long"), packed)

    def exact(c: Column) -> Column:
        grams = F.array_sort(F.transform(c, lambda p: F.struct(F.concat_ws(" ", F.get(w, p), F.get(w, p + 1), F.get(w, p + 2)).alias("g"), p.alias("p"))))

        def covered(g: Column) -> Column:
            hits = F.filter(g, lambda x, i: x["g"].eqNullSafe(F.get(g, i + 1)["g"]) | x["g"].eqNullSafe(F.get(g, i - 1)["g"]))
            at = F.sort_array(F.transform(hits, lambda x: x["p"]))
            return let(at, lambda s: F.aggregate(F.transform(s, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(s, i + 1) - p, F.lit(3)))), F.lit(0).cast("long"), lambda a, x: a + x))

        return F.when(F.size(c) == 0, F.lit(0).cast("long")).otherwise(let(grams, covered))

    return F.when(F.size(w) < 4, F.lit(0).cast("long")).otherwise(let(let(F.transform(w, lambda x: F.xxhash64(x)), by_hash), exact))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements. word_chars counts code points in words; n_lines counts lines with a word."""
    t = F.coalesce(F.col(text), F.lit(""))

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), _repeat_words(w).alias("n_repeat_words"))

    def of_lines(a: Column) -> Column:
        return F.struct(F.size(a).cast("long").alias("n_lines"), (F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit("\t\n\x0b\x0c\r "))) > 0)
    w, r = unused(docs, "words"), unused(docs, "lines")
    out = docs.withColumns(
        {
            w: let(words(F.col(text)), of_words),
            r: let(lines, of_lines),
            "word_chars": F.length(F.regexp_replace(t, BLANK, "")).cast("long"),
            "n_symbols": F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long"),
            "n_exclaims": F.regexp_count(t, F.lit("!")).cast("long"),
        }
    )
    return out.withColumns({n: F.col(w)[n] for n in ("n_words", "n_repeat_words")} | {n: F.col(r)[n] for n in ("n_lines", "n_dup_lines")}).drop(w, r)


def ledger(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the measurements and fail_mask, the failure bits of all rules."""
    mask = F.lit(0).cast("long")
    for r in RULES:
        mask = mask + F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long")
    return measure(docs, text).withColumn("fail_mask", mask)


def verdict(policy: str = DEFAULT_POLICY, mask: str = "fail_mask") -> Column:
    """True where none of the policy's rules failed."""
    return F.col(mask).bitwiseAND(F.lit(mask_of(POLICIES[policy])).cast("long")) == 0


def apply_policy(docs: DataFrame, policy: str = DEFAULT_POLICY, text: str = "text") -> DataFrame:
    """The ledger with base_failed and kept."""
    return ledger(docs, text).withColumns({"base_failed": ~verdict("base-1"), "kept": verdict(policy)})


def ablation(ledgers: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of a policy: documents that fail it, and documents that only it rejects.

    The ledger is first reduced to one row a distinct mask (2^rules at most), so the shuffle does not grow
    with the documents.
    """
    whole = mask_of(POLICIES[policy])
    masks = ledgers.groupBy(F.col("fail_mask").bitwiseAND(F.lit(whole).cast("long")).alias("m")).agg(F.count(F.lit(1)).alias("c"))
    rules = [F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("b")) for r in RULES if r.name in POLICIES[policy]]
    return (
        masks.select("m", "c", F.explode(F.array(*rules)).alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("m").bitwiseAND(F.col("r.b")) != 0, F.col("c")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("m") == F.col("r.b"), F.col("c")).otherwise(0)).alias("n_only"),
        )
        .withColumn("policy", F.lit(policy))
    )

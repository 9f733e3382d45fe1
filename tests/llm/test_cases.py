"""Cases that every operator defines: columns of clashing names, repeated rows and ids, long texts, empty tables."""

import collections
import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, kd_search, licences, lines, mix, ngram_join, nn_descent, pseudonyms, rules, runs, tokenfiles

PATH = public_tokenizers.path("byte_bpe_50k.json")
PLAIN = "doc_id long, text string, lang string, source string, n_chars long"
CLASH = [
    "n_words", "kept", "fail_mask", "n_found", "n_lines", "n_dropped", "n_tokens", "sampled", "license", "containment", "component_id", "n_shingles", "ids", "ids_sha256", "decoded_sha256", "runs", "collapsed", "start", "__id", "__s",
    "__host", "__bad", "found", "own",
]


def rows():
    rng = random.Random(5)
    base = " ".join(f"w{rng.randint(0, 900)}" for _ in range(90))
    texts = [base, base + " more", "menu\nline one\nmenu", "menu\nline two", "menu\nx", "call +1 555 010 9999 or 4111 1111 1111 1111", "Released under the MIT License. And so on", "a b a b a b a b a b", None, "", " \n"]
    out = [(i, x, "en", f"s{i % 2}", len(x or "")) for i, x in enumerate(texts)]
    long = (base + "\n") * 600 + "x" * 30_000
    return [*out, out[0], out[2], (4, "another text of an id that is there", "de", None, 7), (None, base, None, "s0", None), (77, long, "en", "s1", len(long))]


def tokens(docs, spark, tmp):
    path = f"{tmp}/{random.random()}"
    tokenfiles.write(docs, path, PATH)
    return tokenfiles.with_checksums(spark, path)


OPERATORS = {
    "mix": (lambda d, s, t: mix.mix(d), ["doc_id", "n_tokens", "probability", "sampled"]),
    "pseudonyms": (lambda d, s, t: pseudonyms.pseudonymize(d, "k"), ["doc_id", "text", "n_found"]),
    "rules": (lambda d, s, t: rules.apply_policy(d), ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]),
    "tokenfiles": (lambda d, s, t: tokens(d, s, t), ["doc_id", "n_tokens", "ids_crc32"]),
    "licences": (lambda d, s, t: licences.scan(d), ["doc_id", "license", "containment", "n_windows"]),
    "ngram_join": (lambda d, s, t: ngram_join.near_groups(d), ["doc_id", "n_shingles", "component_id"]),
    "lines": (lambda d, s, t: lines.drop_boilerplate(d), ["doc_id", "text", "n_lines", "n_dropped"]),
    "bpe": (lambda d, s, t: bpe.digests(d, PATH), ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]),
    "runs": (lambda d, s, t: runs.periodic_runs(d), ["doc_id", "runs", "collapsed"]),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(spark, tmp_path, name):
    work, columns = OPERATORS[name]
    plain = spark.createDataFrame(rows(), PLAIN).repartition(3)
    clash = plain.withColumns({c: F.lit("clash") for c in CLASH})
    told = lambda df: collections.Counter(str(r) for r in df.select(*columns).collect())
    a, b = told(work(plain, spark, tmp_path)), told(work(clash, spark, tmp_path))
    assert a == b and (sum(a.values()) == len(rows()) or name == "licences")
    if name != "tokenfiles":  # which tells places, so a row's depends on the others
        once = {str(r) for r in work(plain.where("doc_id = 77"), spark, tmp_path).select(*columns).collect()}
        assert once <= set(a) or name in ("mix", "lines", "ngram_join")
    out = work(plain.where("false"), spark, tmp_path)
    assert out.count() == 0 and set(columns) <= set(out.columns)


@pytest.mark.parametrize("search", [nn_descent.search, kd_search.search])
def test_searches(spark, search):
    rng = random.Random(6)
    own = [(i, [float(rng.randint(-9, 9)) or 1.0 for _ in range(6)]) for i in range(120)]
    own += [own[0], own[7], (None, [1.0] * 6), (200, own[3][1])]
    plain = spark.createDataFrame(own, "vec_id long, embedding array<double>").repartition(3)
    clash = plain.withColumns({c: F.lit("clash") for c in ("q", "v", "w", "node", "ids", "score", "rank", "query_id", "cell", "best", "s", "i")})
    a, b = (sorted(tuple(r) for r in search(df, every=20).collect()) for df in (plain, clash))
    assert a == b and {r[0] for r in a} == {0, 20, 40, 60, 80, 100, 200} and all(r[0] != r[2] for r in a)
    assert collections.Counter(r[0] for r in a) == {q: max(r[1] for r in a) for q in {r[0] for r in a}}  # one row a rank

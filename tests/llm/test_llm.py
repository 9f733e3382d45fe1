import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, html_text, licences, lines, mix, ngram_join, nn_descent, pseudonyms, rules, tokenfiles
from tessera.llm.components import components

PATH = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, note string"


@pytest.fixture(scope="session")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def documents(spark, texts, source="s"):
    return spark.createDataFrame([(i, x, "en", source, len(x or ""), "extra") for i, x in enumerate(texts)], DOCS)


ODD = [None, "", " \n ", "one", "a b c d", "same text of six words here", "same text of six words here", "x" * 5000, "  two\t\tspaces  ", "<|endoftext|> a<|endoftext|>b", "漢字" * 900, "é́ ½ ¼\x85\x1c ok"]


def fuzz(n, seed=1):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "漢字", "😀", "'s", "'", "22", "!!", "...", "<|endoftext|>", "x" * 600, "ab1" * 700, "'ll", "²"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(1, 25))) for _ in range(n)]


def test_bpe_equals_the_library(spark, library):
    texts = ODD + fuzz(300)
    got = {r.doc_id: r for r in bpe.digests(documents(spark, texts), PATH).collect()}
    assert len(got) == len(texts)
    for i, x in enumerate(texts):
        ids = library.encode(x or "", add_special_tokens=False).ids
        assert (got[i].n_tokens, got[i].ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert got[i].decoded_sha256 == hashlib.sha256((x or "").encode()).hexdigest()
    assert bpe.digests(documents(spark, []), PATH).count() == 0


@pytest.mark.parametrize("leaf", [4, 16, 64])
def test_tree_concatenation(library, leaf):
    codec, rng = bpe.Codec(PATH, leaf=leaf), random.Random(leaf)
    for _ in range(200):
        word = "".join(rng.choice("etaoinshrdlucmfwypvbgké漢") for _ in range(rng.randint(1, 600)))
        assert np.frombuffer(codec.encode_batch([word])[0], "<u4").tolist() == library.encode(word, add_special_tokens=False).ids


def test_bpe_pieces(library):
    codec, rng = bpe.Codec(PATH), random.Random(7)
    parts = ["ab", "é", "ß's", "9", "漢", " ", " ", "\n", ".", "!?", "'", "'ll", "_", "@", "\u0301", "½", "²", "\t", "\x85", "\u3000", "<|endoftext|>", "\x1c", "\r\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(6000)]
    for x, ids in zip(texts, codec.encode_batch(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(x, add_special_tokens=False).ids, repr(x)


def test_token_files(spark, library, tmp_path):
    import glob

    import pyarrow.parquet as pq

    texts = ODD + fuzz(60)
    out = str(tmp_path / "t")
    docs = documents(spark, texts)
    tokenfiles.write(docs.repartition(5), out, PATH)
    at = 0
    got = {r.doc_id: r for r in tokenfiles.with_checksums(spark, out).collect()}
    for i, x in enumerate(texts):
        ids = library.encode(x or "", add_special_tokens=False).ids + [2]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert {r.doc_id: r.start for r in tokenfiles.read(spark, out).collect()} == {i: r.start for i, r in got.items()}
    group = pq.ParquetFile(glob.glob(f"{out}/*.parquet")[0]).metadata.row_group(0)
    ids = next(group.column(i) for i in range(group.num_columns) if group.column(i).path_in_schema.startswith("ids"))
    assert "DELTA_BINARY_PACKED" in ids.encodings and ids.has_offset_index
    empty = str(tmp_path / "e")
    tokenfiles.write(documents(spark, []), empty, PATH)
    assert tokenfiles.with_checksums(spark, empty).count() == 0


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = collections.defaultdict(list)
    for i in range(len(words) - 2):
        grams[tuple(words[i : i + 3])].append(i)
    repeated = {p + k for at in grams.values() if len(at) > 1 for p in at for k in range(3)}
    rows = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(rows) - len(set(rows)), len(repeated)


def test_rules(spark):
    rng = random.Random(3)
    texts = [*ODD, "a b a b a b a", "l\nl\n \nl", *(" ".join(rng.choice("abcdef") for _ in range(rng.randint(1, 120))) for _ in range(60)), "# $ % " * 30]
    out = rules.apply_policy(documents(spark, texts))
    got = {r.doc_id: r for r in out.collect()}
    for i, x in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_rules(x), x
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed) and r.note == "extra"
    for r in rules.ablation(out).collect():
        bit = 1 << next(x.bit for x in rules.RULES if x.name == r.rule)
        assert r.n_failed == sum(bool(g.fail_mask & bit) for g in got.values()) and r.n_only == sum(g.fail_mask == bit for g in got.values())
    assert rules.apply_policy(documents(spark, [])).count() == 0


def test_line_dedup(spark):
    texts = [f"menu\nline {i}\n\n menu \n" for i in range(30)] + [None, "", "menu"]
    got = {r.doc_id: r for r in lines.drop_boilerplate(documents(spark, texts)).collect()}
    assert got[3].text == "line 3\n\n" and got[3].n_dropped == 2 and got[3].n_lines == 5
    assert got[30].text is None and got[31].text == "" and got[32].text == ""
    few = lines.drop_boilerplate(documents(spark, texts[:2])).collect()
    assert all(r.n_dropped == 0 for r in few)
    assert lines.drop_boilerplate(documents(spark, [])).count() == 0
    null_host = lines.drop_boilerplate(documents(spark, texts).withColumn("source", F.lit(None).cast("string"))).where("n_dropped > 0")
    assert null_host.count() == 31


def test_mix_meets_its_targets(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["w"] * rng.randint(1, 60)), rng.choice(["en", "de"]), rng.choice(["a", "a", "a", "b"]), 0, rng.choice(["x", "y"])) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, topic string")
    targets = {"source": {"a": 0.5, "b": 0.5}, "lang": {"en": 0.7, "de": 0.3}, "topic": 1.0}
    out = mix.mix(docs, targets, rounds=12).collect()
    mass = collections.Counter()
    for r in out:
        mass["source", r.source] += r.n_tokens * r.probability
        mass["lang", r.lang] += r.n_tokens * r.probability
    total = mass["source", "a"] + mass["source", "b"]
    assert abs(mass["source", "a"] / total - 0.5) < 1e-6 and abs(mass["lang", "en"] / total - 0.7) < 1e-6
    assert abs(max(r.probability for r in out) - 1) < 1e-12
    assert abs(sum(r.sampled for r in out) - sum(r.probability for r in out)) < 50
    assert mix.mix(documents(spark, [])).count() == 0
    odd = mix.mix(documents(spark, ODD).withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(odd) == len(ODD) and all(0 <= r.probability <= 1 for r in odd)


def test_raking_ends_and_tells_gaps(spark, monkeypatch):
    rng = random.Random(6)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice("ab"), rng.choice("xy"), 0, rng.choice("pq"), "mine", "too") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, topic string, __source string, __topic string")
    targets = {"source": {"x": 0.2, "y": 0.8}, "lang": {"a": 0.5, "b": 0.5}, "topic": 0.5}
    few = {r.doc_id: r for r in mix.mix(docs, targets).collect()}
    assert all(r["__source"] == "mine" and r["__topic"] == "too" for r in few.values())
    monkeypatch.setattr(mix, "FEW", 0)
    many = {r.doc_id: r.probability for r in mix.mix(docs, targets).collect()}
    assert all(abs(few[i].probability - p) < 1e-9 for i, p in many.items())
    alone = docs.where("source = 'x' or lang = 'a'")  # nothing of source y has language b
    with pytest.warns(UserWarning, match="missed"):
        mix.mix(alone, {"source": {"x": 0.2, "y": 0.8}, "lang": {"a": 0.5, "b": 0.5}, "topic": 1.0}, rounds=20)
    cells = docs.groupBy(F.col("source").alias("__source"), F.col("lang").alias("__lang"), F.col("topic").alias("__topic")).agg(F.count(F.lit(1)).alias("tokens"))
    told = mix.marginals(mix.rake(cells, targets), targets).collect()
    assert len(told) == 6 and all(abs(r.gap) < 1e-9 for r in told)


def brute_groups(texts):
    sets = []
    for x in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), x or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def test_ngram_join(spark):
    rng = random.Random(9)
    base = [[f"w{rng.randint(0, 400)}" for _ in range(rng.randint(5, 120))] for _ in range(25)]
    texts = list(ODD)
    for _ in range(160):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(len(words))] = f"W{rng.randint(0, 400)}"
        texts.append(" ".join(words))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_groups(documents(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)
    kept = {r.doc_id for r in ngram_join.keep_one(documents(spark, texts)).collect()}
    assert kept == {c for _, c in got.values()}
    twice = documents(spark, ["a b c d e f"]).unionByName(documents(spark, ["a b c d e f"]))
    assert ngram_join.keep_one(twice).count() == 1 and ngram_join.near_groups(twice).count() == 2
    assert ngram_join.near_groups(documents(spark, [])).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect())
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))


PERSONAL = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "4111.1111.1111.1111", "378282246310005", "2024-02-29", "29/02/2024", "29.02.2024", "10.20.30.40", "078-05-1120", "+1 555 010 9999", "+15550109999",
            "+1 (555) 010-9999", "(555) 010-9999", "555-010-9999", "555.010.9999", "1-555-010-9999", "+44 20 7946 0958", "+855 12 345 678", "+49 30 901820"]


def test_no_value_hides_another(spark):
    """Every kind directly beside every other."""
    between = [" ", ", ", "\n", "; ", " ½ ", " ² ", "², ", " ៥ ", " and "]
    texts = [f"{a}{s}{b}" for a in PERSONAL for b in PERSONAL for s in between] + PERSONAL + [f"{a} 12 apples" for a in PERSONAL]
    got = [r.text for r in pseudonymize_all(spark, texts)]
    alone = dict(zip(PERSONAL, got[-2 * len(PERSONAL) : -len(PERSONAL)], strict=True))
    digits = lambda x: re.sub("[^0-9]", "", x)
    form = lambda x: re.sub("[0-9]", "9", x)
    assert all(new != old and (form(new) == form(old) or old == "10.20.30.40") for old, new in alone.items())
    assert len({digits(alone[x])[-10:] for x in PERSONAL if digits(x)[-10:] == "5550109999"}) == 1 and len({digits(alone[x]) for x in PERSONAL[:4]}) == 1
    want = [f"{alone[a]}{s}{alone[b]}" for a in PERSONAL for b in PERSONAL for s in between]
    assert [(x, g, w) for x, g, w in zip(texts, got, want, strict=False) if g != w] == []
    # Numbers of a country whose length is not known take what follows with them.
    assert all(g == f"{alone[x]} 12 apples" for x, g in zip(PERSONAL[:-2], got[-len(PERSONAL) :], strict=False))


def pseudonymize_all(spark, texts):
    return pseudonyms.pseudonymize(documents(spark, texts).repartition(8, "doc_id"), "k").orderBy("doc_id").collect()


def test_pseudonyms(spark):
    texts = ["card 4111 1111 1111 1111 and 4111111111111111, not 4111111111111112", "on 2024-02-29 or 29/02/2024, not 30/02/2024", "ip 10.0.0.1 no 300.1.1.1", "078-05-1120 666-12-3456", "+1 (555) 010-9999", "A.b9@Mail.example.com a.b9@mail.example.com"]
    got = [r.text for r in pseudonyms.pseudonymize(documents(spark, [*texts, None, ""]), "k").orderBy("doc_id").collect()]
    luhn = lambda s: sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(s)))) % 10 == 0
    a, b = re.findall(r"\d{4} \d{4} \d{4} \d{4}|\d{16}(?=, )", got[0])
    assert a.replace(" ", "") == b != "4111111111111111" and luhn(b) and got[0].endswith("4111111111111112")
    y, d = re.findall(r"\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}(?=,)", got[1])
    assert y.split("-") == d.split("/")[::-1] and y != "2024-02-29" and y.startswith("20") and got[1].endswith("30/02/2024")
    assert "10.0.0.1" not in got[2] and got[2].endswith("300.1.1.1") and got[3].endswith("666-12-3456") and not got[3].startswith("078")
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", got[4]) and got[4] != texts[4]
    one, two = got[5].split()
    assert one.lower() == two.lower() and re.fullmatch(r"[a-z]\.[a-z]\d@[a-z]{4}\.example\.com", two)
    assert got[6] is None and got[7] == ""
    space = spark.range(1000).select(pseudonyms.feistel(F.array(F.col("id") % 10, (F.col("id") / 10).cast("long") % 10, (F.col("id") / 100).cast("long")), F.array(*[F.lit(10)] * 3), "k", "t").alias("e"))
    assert space.distinct().count() == 1000
    there = spark.range(50).select("id", pseudonyms.feistel(F.array("id", F.lit(3)), F.array(F.lit(50), F.lit(7)), "k", "t").alias("e"))
    back = there.select("id", pseudonyms.feistel(F.col("e"), F.array(F.lit(50), F.lit(7)), "k", "t", backwards=True).alias("b")).collect()
    assert all(r.b == [r.id, 3] for r in back)


def pseudonyms_of(spark, texts):
    return [r.text for r in pseudonyms.pseudonymize(documents(spark, texts), "k").orderBy("doc_id").collect()]


def test_pseudonyms_link_and_keep_their_format(spark):
    same = ["+1 555 010 9999", "+15550109999", "+1 (555) 010-9999", "555-010-9999", "(555) 010-9999", "555.010.9999"]
    got = pseudonyms_of(spark, [f"call {x} now" for x in same])
    digits = [re.sub(r"\D", "", x)[-10:] for x in got]
    assert len(set(digits)) == 1 and digits[0] != "5550109999" and got[0].startswith("call +1 ") and got[1].startswith("call +1")
    a, b, c, d, e = pseudonyms_of(spark, ["5555 5555 5555 4444 12/13/2024", "22 4111111111111111 17 apples", "192.168.000.001", "192.168.0.1", "4111 1111 1111 1111 4111111111111111"])
    assert not a.startswith("5555 5555 5555 4444") and not a.endswith("12/13/2024") and re.fullmatch(r"\d{4} \d{4} \d{4} \d{4} \d\d/\d\d/\d{4}", a)
    assert re.fullmatch(r"22 \d{16} 17 apples", b) and "4111111111111111" not in b
    assert re.fullmatch(r"\d{1,3}\.\d{1,3}\.\d{3}\.\d{3}", c) and [int(x) for x in c.split(".")] == [int(x) for x in d.split(".")] != [192, 168, 0, 1]
    one, two = e[:19].replace(" ", ""), e[20:]
    assert one == two != "4111111111111111"


def test_pseudonyms_against_brute_force(spark):
    rng = random.Random(4)
    luhn = lambda s: sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(map(int, reversed(s)))) % 10 == 0

    def card():
        while not luhn(n := "".join(str(rng.randint(0, 9)) for _ in range(rng.randint(13, 19)))) or n[0] == "0":
            pass
        return n

    plants = {"card": card, "mail": lambda: f"u{rng.randint(0, 999)}.x@host{rng.randint(0, 9)}.example.org", "date": lambda: f"20{rng.randint(10, 99)}-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", "ip": lambda: ".".join(str(rng.randint(0, 255)) for _ in range(4)), "ssn": lambda: f"{rng.randint(100, 600)}-{rng.randint(10, 99)}-{rng.randint(1000, 9999)}"}
    values = {k: [f() for _ in range(12)] for k, f in plants.items()}
    rows = [[rng.choice(["lorem", "ipsum, dolor", "-", "x9y", "7", "No."]) if rng.random() < 0.6 else rng.choice(values[rng.choice(list(values))]) for _ in range(30)] for _ in range(120)]
    every = {v for x in values.values() for v in x}
    got = pseudonyms_of(spark, ["; ".join(r) for r in rows])
    new = {}
    for r, g in zip(rows, got, strict=True):
        for x, y in zip(r, g.split("; "), strict=True):
            assert (x == y) == (x not in every), (x, y)
            assert new.setdefault(x, y) == y  # equal values stay linked
    assert len(set(new.values())) == len(new)  # and different ones apart
    for x in values["card"]:
        assert luhn(new[x]) and len(new[x]) == len(x)


def test_pseudonyms_take_linear_time(spark):
    import time

    texts = ["a" * 1_000_000, "7" * 1_000_000, "a." * 300_000 + "@", "1 " * 3000, "+" * 100_000, "@" * 100_000, None, "\uf8ff\ue000 4111111111111111 \uf8ff\ue000"]
    began = time.time()
    got = pseudonyms_of(spark, texts)
    assert got[:3] == texts[:3] and got[4:7] == texts[4:7] and time.time() - began < 60
    assert got[7] != texts[7] and got[7].count("\uf8ff\ue000") == 2
    assert pseudonyms.pseudonymize(documents(spark, []), "k").count() == 0
    twice = pseudonyms.pseudonymize(documents(spark, ["10.0.0.1"]).unionByName(documents(spark, ["10.0.0.1"])).withColumns({"n_found": F.lit("x"), "__found": F.lit(1)}), "k").collect()
    assert twice[0].text == twice[1].text and [r.n_found for r in twice] == [1, 1] and twice[0]["__found"] == 1


def test_line_dedup_cases(spark, monkeypatch):
    texts = ["edge\nown %d" % i if i < 2 else "own %d" % i for i in range(40)]  # on exactly the ratio
    got = lines.drop_boilerplate(documents(spark, texts).withColumns({"__bad": F.lit(1), "__lines": F.lit("x"), "n_lines": F.lit("y")}), min_pages=1).collect()
    assert all(r.n_dropped == 0 and r["__bad"] == 1 and r["__lines"] == "x" for r in got)
    texts = [f"menu\nline {i}" for i in range(30)] + [None, "", "menu"]
    want = sorted((r.doc_id, r.text, r.n_dropped) for r in lines.drop_boilerplate(documents(spark, texts)).collect() if r.text)
    monkeypatch.setattr(lines, "SMALL", 0)  # the salted join gives the same
    salted = sorted((r.doc_id, r.text, r.n_dropped) for r in lines.drop_boilerplate(documents(spark, texts)).collect() if r.text)
    assert salted == want and want[0][2] == 1


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body class="nav-open"><nav><a>Menu</a></nav><header>Head</header>
<div class="ad">Buy</div><article><h1>Title &amp; more</h1><p>One<br>two <b>three</p><p>Four&nbsp;five<aside>side</aside><div class="cookie-notice">ok?</div><form><p>in</p></form><section class="comments"><p>me</p></section><p>six</article><footer>&copy;</footer></body></html>"""


def test_html_text(spark):
    boiler = "all rights reserved to the owners of this fine site since the year of its founding"
    bare = lambda i: f"<body><div>{boiler}</div><p>unique text number {i} with some words of its own {i * 7}</p></body>"
    rows = [(0, "http://h.com/0", PAGE), (1, "http://h.com/1", None), (2, None, "<p>a</p>b"), (3, "http://h.com/3", bare(3)), (4, "http://h.com/4", bare(4)), (5, "http://other.com/5", bare(5)), (6, "http://h.com/0", PAGE), (7, "x", "<p title='unclosed>a <!-- b")]
    got = {r.page_id: r for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0].text == "Title & more\nOne two three\nFour five\nsix" == got[6].text
    assert got[1].text == "" and got[1].n_chars == 0 and got[2].text == "a\nb"
    assert got[3].text == "unique text number 3 with some words of its own 21" and got[5].text.startswith(boiler)
    assert len(got) == 8 and all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_reads_broken_pages_in_linear_time():
    import time

    began = time.process_time()
    for x in ("<a ", "<title ", "<!--", "<p title=\"", "<p '", "<a \">\" ", "<script>", "<", "</", "<![CDATA[", "<div><p>", "</div>"):
        html_text.blocks_of(x * (1_000_000 // len(x)))
    assert time.process_time() - began < 60
    assert html_text.blocks_of("<article><p class='alert'>a\x00b<p class=x>c</p><div class='notice-board'>d</div><div class='cookie-notice'>e</div><section class='related-work'>f</section></article>")[0] == ["a\x00b", "c", "d", "f"]


def test_html_host_array_against_brute_force(spark):
    rng = random.Random(8)
    shared = [[f"s{rng.randint(0, 10**6)}" for _ in range(rng.randint(3, 30))] for _ in range(6)]
    pages = []
    for i in range(40):
        parts = [rng.choice(shared) if rng.random() < 0.5 else [f"u{i}x{rng.randint(0, 10**6)}" for _ in range(rng.randint(1, 20))] for _ in range(6)]
        pages.append([p for k in range(3) if (p := parts[2 * k] + parts[2 * k + 1])])
    pages[7] = pages[3]  # a copy of a whole page
    rows = [(i, f"http://h.com/{i}", "".join(f"<p>{' '.join(b)}</p>" for b in p)) for i, p in enumerate(pages)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    d, where = html_text.DEPTH, collections.defaultdict(set)
    for p in pages:
        for b in p:
            for k in range(max(1, len(b) - d + 1)):
                where[tuple(b[k : k + d])].add(str(p))
    for i, p in enumerate(pages):
        left = []
        for b in p:
            hit = {q for k in range(max(1, len(b) - d + 1)) if len(where[tuple(b[k : k + d])]) > 1 for q in range(k, k + d)}
            if rest := [w for k, w in enumerate(b) if k not in hit]:
                left.append(" ".join(rest))
        assert got[i] == "\n".join(left), i
    assert got[7] == got[3]


def test_licences(spark):
    filler = " ".join(f"word{i}" for i in range(300))
    texts = [*ODD, f"{filler} Released under the MIT License. {filler}", f"{filler}\nThis work is licensed under the GNU General Public License, version 3.", licences.TEMPLATES["mit-text"].upper(), "Licensed under CC BY-NC"]
    got = {(r.doc_id, r.license): r.containment for r in licences.scan(documents(spark, texts)).collect()}
    n = len(ODD)
    assert got[n, "mit"] == 1 and got[n + 1, "gpl-3.0"] == 1 and got[n + 2, "mit-text"] == 1 and not any(i == n + 3 or i < n for i, _ in got)
    assert licences.scan(documents(spark, [])).count() == 0


def test_short_licences(spark):
    rng = random.Random(5)
    around = lambda: " ".join(f"w{rng.randint(0, 10**9)}" for _ in range(rng.randint(10, 40)))
    planted = [name for name, x in licences.TEMPLATES.items() if len(x.split()) <= 12 for _ in range(300)]
    texts = [f"{around()} {licences.TEMPLATES[name]} {around()}" for name in planted]
    got = {(r.doc_id, r.license) for r in licences.scan(documents(spark, texts)).collect() if r.containment == 1}
    assert {"mit", "cc-by-nc-4.0"} <= set(planted) and not [x for x in enumerate(planted) if x not in got]


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 16)).round(6)
    x[700:760] = x[700]
    rows = [(i, v.tolist(), "extra") for i, v in enumerate(x)] + [(2000, None, ""), (2020, [0.0] * 16, ""), (2040, [float("nan")] * 16, ""), (2060, [None] * 16, ""), (None, x[0].tolist(), "")]
    got = collections.defaultdict(list)
    for r in nn_descent.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>, note string")).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    assert sorted(got) == list(range(0, 1500, 20))
    found = 0
    for q, best in got.items():
        s = x @ x[q]
        order = [i for i in np.lexsort((np.arange(1500), -s)) if i != q][:20]
        best.sort()
        assert [r for r, _, _ in best] == list(range(1, 21)) and all(abs(s[i] - c) < 1e-9 for _, i, c in best)
        found += len({i for _, i, _ in best} & set(order))
    assert found / (20 * len(got)) >= 0.9
    small = nn_descent.search(spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.5, 0.5])], "vec_id long, embedding array<double>")).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in small) == [(0, 1, 20), (0, 2, 3), (20, 1, 0), (20, 2, 3)]
    assert nn_descent.search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_nearest_neighbours_beyond_the_leaves(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "LEAF", 32)  # far below the number of vectors
    monkeypatch.setattr(nn_descent, "BEAM", 24)
    x = np.random.default_rng(3).standard_normal((4000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = [(r.query_id, r.vec_id) for r in nn_descent.search(rows, every=40).collect()]
    want = {(q, int(i)) for q in range(0, 4000, 40) for i in [i for i in np.argsort(-(x @ x[q])) if i != q][:20]}
    assert len(got) == len(want) and len(want & set(got)) / len(want) >= 0.95


@pytest.mark.parametrize("factor", [1e40, 1e-30, 1e150])
def test_nearest_neighbours_of_any_magnitude(spark, monkeypatch, factor):
    monkeypatch.setattr(nn_descent, "LEAF", 64)
    x = np.random.default_rng(8).standard_normal((600, 16))
    x[0] *= 1e-200  # one that is far smaller than the others
    rows = spark.createDataFrame([(i, (v * factor).tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in nn_descent.search(rows, every=30).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    found = 0
    for q in range(0, 600, 30):
        s = (x * factor) @ (x[q] * factor)
        best = [i for i in np.lexsort((np.arange(600), -s)) if i != q][:20]
        found += len({i for _, i, _ in got[q]} & set(best))
        assert all(abs(c - s[i]) <= 1e-12 * abs(c) for _, i, c in got[q]) and [c for _, _, c in sorted(got[q])] == sorted((c for *_, c in got[q]), reverse=True)
    assert found / (20 * 20) >= 0.95


def test_nearest_neighbours_with_hubs_and_copies(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "LEAF", 64)
    rng = np.random.default_rng(6)
    x = rng.standard_normal((3000, 32)) * rng.lognormal(0, 0.5, 3000)[:, None]  # the longest are near to all
    x[1000:2000] = x[1000]  # a third of the rows are one vector
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    hub = spark.createDataFrame([(a, b, float(a * 7 % 1000)) for a in range(500) for b in (0, 1)], "b long, a long, score double")
    top = {r.a: [(e.score, e.b) for e in r.n] for r in nn_descent._top(hub).collect()}
    assert all(top[a] == sorted(((float(b * 7 % 1000), b) for b in range(500)), reverse=True)[: nn_descent.DEGREE] for a in (0, 1))
    got = collections.defaultdict(list)
    for r in nn_descent.search(rows).collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    found = 0
    for q in range(0, 3000, 20):
        s = x @ x[q]
        found += sum(c >= np.sort(np.delete(s, q))[-20] - 1e-9 for _, _, c in got[q])
        assert len(got[q]) == 20 == len({i for _, i, _ in got[q]})
    assert found / (20 * 150) >= 0.9


def test_nearest_neighbours_over_shards(spark, monkeypatch):
    monkeypatch.setattr(nn_descent, "SHARD", 128)
    monkeypatch.setattr(nn_descent, "LEAF", 32)
    x = np.random.default_rng(4).standard_normal((2000, 32))
    x[500:600] = x[500]
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(list)
    for r in nn_descent.search(rows).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    found = 0
    for q in range(0, 2000, 20):
        s = x @ x[q]
        found += sum(c >= np.sort(np.delete(s, q))[-20] - 1e-9 for _, c in got[q])
        assert len(got[q]) == 20 == len({i for i, _ in got[q]} - {q})
    assert nn_descent.shards(1901, 32) > 8 and found / 2000 >= 0.95


def test_work_of_the_neighbour_search():
    nn = nn_descent
    # What queries meet, their number times the shards, grows as n * sqrt(n) at most; a shard stays bounded.
    assert nn.shards(0, 1) == nn.shards(1, 1) == 1
    assert all(nn.shards(4 * n, 64) <= 2 * nn.shards(n, 64) + 1 for n in (100_000, 600_000, 3_000_000))
    assert all(n / nn.shards(n, d) <= min(nn.LARGEST, max(256, nn.SIZE // d)) for n in (10**4, 10**6, 10**9) for d in (2, 64, 4096))


def test_the_neighbour_search_starts_few_jobs(spark):
    # The driver keeps a plan and its figures for every job: hundreds of them took more than its memory.
    x = np.random.default_rng(9).standard_normal((600, 16))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    spark.sparkContext.setJobGroup("few-jobs", "the neighbour search")
    try:
        assert len(nn_descent.search(rows).collect()) == 600
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("few-jobs"))
    assert 0 < jobs <= 40, jobs


def test_walks_find_clusters_without_edges_between():
    rng = np.random.default_rng(1)
    x = np.repeat(rng.standard_normal((200, 64)), 40, 0) + 0.05 * rng.standard_normal((8000, 64))
    x = (x / np.linalg.norm(x, axis=1)[:, None])[rng.permutation(8000)].astype(np.float32)
    near = nn_descent.descend(x, x, 32, 256, 3, 0.01)
    got, _ = nn_descent.walk(x[:128], x, near, 20, 41, 64, 32, 0.05)
    want = np.argsort(-(x[:128] @ x.T), 1)[:, :20]
    assert min(len(set(a[:20]) & set(b)) for a, b in zip(got, want)) >= 15


def test_vectors_of_two_lengths_are_an_error(spark):
    with pytest.raises(ValueError, match="of 2 and of 3"):
        nn_descent.search(spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0, 2.0])], "vec_id long, embedding array<double>"))


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(1)
    good = [" ".join(f"w{rng.randint(0, 3000)}" for _ in range(80)) for _ in range(40)]
    documents(spark, [*good, good[0] + " and", None, "short"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(got) <= set(range(40)) and len(got) == 40 and got[0].n_tokens > 80

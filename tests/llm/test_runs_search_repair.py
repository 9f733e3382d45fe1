"""Periodic runs, exact search and conversation repair against brute force."""

import collections
import functools
import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import conversations, kd_search, queries, runs

D = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, runs string"


def brute_runs(w, shortest=6, exponent=4):
    out = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(shortest, exponent * q):
                out.setdefault((s, i + q), q)
            i += i == s
    return sorted(((s, t - s, q) for (s, t), q in out.items()), key=lambda r: (r[0], r[2]))


def odd_words(rng):
    k, out = rng.randint(1, 3), []
    if rng.random() < 0.4:
        return [rng.randrange(k) for _ in range(rng.randint(0, 60))]
    while len(out) < rng.randint(1, 150):
        u = [rng.randrange(k + 1) for _ in range(rng.randint(1, 7))]
        out += u * rng.randint(1, 6) + u[: rng.randint(0, len(u))]
        out = out + out if rng.random() < 0.3 else out
    return out


@pytest.mark.parametrize("shortest, exponent", [(6, 4), (2, 2), (3, 3)])
def test_all_runs_are_found(shortest, exponent):
    rng = random.Random(exponent)
    for _ in range(400):
        texts = [odd_words(rng) for _ in range(rng.randint(1, 5))]
        ids, bounds = np.array([x for t in texts for x in t], np.int64), np.cumsum([0, *map(len, texts)])
        assert runs.find(ids, bounds, shortest, exponent) == [brute_runs(t, shortest, exponent) for t in texts]


def test_long_and_regular_texts():
    assert runs.find(np.zeros(100_000, np.int64), np.array([0, 100_000])) == [[(0, 100_000, 1)]]
    assert runs.find(np.tile([0, 1, 2], 30_000), np.array([0, 90_000])) == [[(0, 90_000, 3)]]
    pair = np.concatenate([np.zeros(50_000, np.int64), [1], np.zeros(50_000, np.int64)])
    assert runs.find(pair, np.array([0, len(pair)])) == [[(0, 50_000, 1), (50_001, 50_000, 1)]]


def collapsed(w, found):
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_of_documents(spark):
    rng = random.Random(4)
    texts = [None, "", " \n\t ", "one", "a\x0ba\x0ca\ra a\na", "é é é é é é é", "x y " * 9, "long " * 20_000]
    texts += [" ".join("w" + str(x) for x in odd_words(rng)) for _ in range(60)] + ["a b a b a b a b end"] * 2
    rows = [(i if i else None, x, "en", "s", 0, "clash") for i, x in enumerate(texts)]
    got = runs.periodic_runs(spark.createDataFrame(rows, DOCS).repartition(3))
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "runs", "collapsed"]
    for r in got.collect():
        w = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id or 0] or "")
        want = brute_runs(w) if len(w) < 1000 else [(0, len(w), 1)]
        assert [tuple(x) for x in r.runs] == want and r.collapsed == collapsed(w, want), r.doc_id
    one = runs.digests(runs.periodic_runs(spark.createDataFrame([(1, "a b a b a b a b end " + "z " * 8, "en", "s", 0, "")], DOCS))).first()
    assert (one.n_runs, one.start, one.length, one.period, one.exponent_milli) == (2, 0, 8, 2, 4000) and one.collapsed_sha256 == hashlib.sha256(b"a b end z").hexdigest()
    none = runs.digests(runs.periodic_runs(spark.createDataFrame(rows[:2], DOCS))).collect()
    assert all((r.n_runs, r.start, r.length, r.period, r.exponent_milli) == (0, None, None, None, None) and r.runs_sha256 == hashlib.sha256(b"").hexdigest() for r in none)
    assert runs.periodic_runs(spark.createDataFrame([], DOCS)).count() == 0
    with pytest.raises(ValueError):
        runs.periodic_runs(got, exponent=1)


def test_planted_runs(spark):
    text = " ".join(f"w{i}" for i in range(80))
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 7 != 0, text).alias("text"))
    for r in rows.select("doc_id", "text", runs.planted(F.col("doc_id"), F.col("text")).alias("new")).collect():
        w, h = (r.text or "").split(), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            assert r.new.split() == [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        else:
            assert (r.new or "") == (r.text or "")


def brute_search(rows, every, k):
    """rows (id, vector) with whole numbers, shorter ones padded."""
    rows = sorted({(i, tuple(v)) for i, v in rows}, key=lambda r: r[0])
    d = max((len(v) for _, v in rows), default=0)
    x = [[int(a) for a in v] + [0] * (d - len(v)) for _, v in rows]
    out = []
    for (i, _), q in zip(rows, x, strict=True):
        if i % every == 0:
            near = sorted((max(1 - 2**63, min(2**63 - 1, -sum(a * b for a, b in zip(q, y, strict=True)))), j) for (j, _), y in zip(rows, x, strict=True) if j != i)[:k]
            out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(near)]
    return sorted(out)


def searched(df, **o):
    return sorted(tuple(r) for r in kd_search.search(df, **o).collect())


def test_kd_search(spark, monkeypatch):
    rng = np.random.default_rng(5)
    for name, value in (("SHARD_ROWS", 64), ("LEAF", 8), ("BLOCK", 32), ("SAMPLE", 200)):
        monkeypatch.setattr(kd_search, name, value)
    centres = rng.normal(0, 40, (12, 8))
    x = np.floor(centres[rng.integers(0, 12, 900)] + rng.normal(0, 6, (900, 8)))
    x[rng.random(900) < 0.3] = x[0]  # a third are copies of one
    x[300:310], x[310] = x[5], 0
    rows = [(int(i), [float(a) for a in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame([(i, v, "extra") for i, v in rows], "vec_id long, embedding array<double>, label string").repartition(5)
    assert searched(df, every=10) == brute_search(rows, 10, 5)
    assert searched(df, every=450, k=1) == brute_search(rows, 450, 1)


def test_boxes_prune_and_bounds_hold():
    rng = np.random.default_rng(6)
    x = np.floor(np.concatenate([rng.normal(m, 3, (256, 6)) for m in (-60, 0, 60, 120)]))
    tree = kd_search.Tree(x, np.arange(len(x)), np.ones(len(x), np.int64), 16)
    q = x[::50]
    score, found, visits = tree.search(q, np.full(len(q), -np.inf), 6, True)
    s = q @ x.T
    assert all(found[i].tolist() == np.lexsort((np.arange(len(x)), -s[i]))[:6].tolist() for i in range(len(q))) and visits < 0.5 * len(q) * 64
    assert (kd_search.bounds(q, tree.low[:1], tree.high[:1])[:, 0] >= s.max(1)).all()
    packed = kd_search.Tree.unpacked(6, *tree.packed())
    assert (packed.search(q, score[:, -1], 6, True)[1] == found).all() and packed.search(q, score[:, 0] + 1, 6, True)[2] < visits


def test_kd_search_cases(spark):
    kind = "vec_id long, embedding array<double>"
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (50, [3.0]), (100, []), (1, [1.0, 2.0]), (2, [-1.0, 5.0]), (3, [0.0, 0.0])]
    bad = [(4, None), (5, [1.0, None]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    assert searched(spark.createDataFrame(rows + bad, kind)) == brute_search(rows, 50, 5)
    huge = [(0, [2.0**40, 1.0]), (1, [2.0**40, 3.0]), (2, [2.0**40, 2.0]), (3, [2.0**20, 2.0]), (50, [-(2.0**40), 9.0])]
    assert searched(spark.createDataFrame(huge, kind)) == brute_search(huge, 50, 5)
    assert kd_search.search(spark.createDataFrame([], kind)).count() == 0 and kd_search.search(spark.createDataFrame([(0, [1.0])], kind)).count() == 0
    scaled = spark.createDataFrame([([0.999, -0.001, None, float("nan"), 1e306, 1e300],)], "v array<double>").select(kd_search.scaled(F.col("v")).alias("v")).first().v
    assert scaled == [255.0, -1.0, None, None, None, 256e300]


def brute_repair(sig):
    step = {"s": {"0": "s"}, "u": {"0": "u", "s": "u", "a": "u"}, "a": {"u": "a"}}

    @functools.lru_cache(None)
    def go(i, state, inserted):
        found = [(0, "")] if i == len(sig) and state in "0a" else []

        def add(cost, letter, to, i, n=0):
            if to and (rest := go(i, to, n)):
                found.append((cost + rest[0], letter + rest[1]))

        for r in "ua" if inserted < 3 else "":
            add(2, "I", step[r].get(state), i, inserted + 1)
        if i < len(sig):
            late = sig[i].isupper()
            add(3, "D", state, i + 1)
            if sig[i] != "d":
                add(late, "K", step.get(sig[i].lower(), {}).get(state), i + 1)
                for r in "ua":
                    add(2 + late, "R", step[r].get(state), i + 1)
        return min(found, default=None)

    return go(0, "0", 0)


@pytest.mark.parametrize("part", [2, 5, 24])
def test_cheapest_audits(monkeypatch, part):
    monkeypatch.setattr(conversations, "_PART", part)
    rng = random.Random(part)
    for _ in range(1500):
        sig = "".join(rng.choice("suaxSUAXd"[: rng.choice([3, 4, 8, 9])]) for _ in range(rng.randint(0, 13)))
        assert conversations.solve(sig) == brute_repair(sig), sig
    cost, audit = conversations.solve("ua" * 40_000 + "d" + "Ua" * 10_000)
    assert cost == 3 + 10_000 and audit == "K" * 80_000 + "D" + "K" * 20_000


def brute_conversation(rows):
    """Of rows (turn, role, text) in order: counts, cost, audit, and the repaired rows."""
    seen, sig, faults, rows = set(), "", collections.Counter(), sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    for _, role, text in rows:
        body = text.strip(" \t\n\r\x0b\x0c")
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        faults[fault] += 1
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        sig += "d" if fault in ("blank", "duplicate") else initial.upper() if fault else initial
    cost, audit = brute_repair(sig)
    turns, kept, out, at = [r[0] for r in rows if r[0] is not None], len(audit) - audit.count("D"), [], 0
    for letter in audit:
        given = "assistant" if (len(out) - kept % 2) % 2 else "user"
        if letter == "I":
            out.append((given, ""))
        else:
            if letter != "D":
                out.append((rows[at][1] if letter == "K" else given, rows[at][2]))
            at += 1
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    return (gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit), out


def made_up(seed, n=60):
    rng, rows = random.Random(seed), []
    for c in [*range(n), None]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, rng.choice([t, t, t, t + 1, None]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(["Yes.", "No", " \n", "", None, "Well!\n", "same text?", f"t{t}."])))
    return rows


CONV = "conv_id long, turn long, role string, text string"


def test_conversation_repair(spark):
    rows = made_up(1)
    df = spark.createDataFrame([(*r, "extra") for r in rows], CONV + ", audit string").repartition(4)
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, " " if role is None else role, " " if text is None else text))
    audits = conversations.audits(df)
    got = {r.conv_id: tuple(r[c] for c in (*conversations.COUNTS[1:], "audit")) for r in audits.collect()}
    want = {c: brute_conversation(own) for c, own in by.items()}
    assert got == {c: w[0] for c, w in want.items()}
    out = collections.defaultdict(list)
    for r in conversations.repaired(df, audits).orderBy("conv_id", "place").collect():
        assert r.place == len(out[r.conv_id])
        out[r.conv_id].append((r.role, r.text))
    assert all(out.get(c, []) == w[1] and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in w[1])) for c, w in want.items())
    digests = {r.conv_id: r.repaired_sha256 for r in conversations.repaired_digests(df, audits).collect()}
    assert digests == {c: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in w[1]).encode()).hexdigest() for c, w in want.items()}


def test_hot_and_empty_conversations(spark, monkeypatch):
    monkeypatch.setattr(conversations, "HOT_SHARE", 4)
    rows = [(c, t, ("user", "assistant")[t % 2], f"{t}.") for c in range(40) for t in range(2)] + [(99, t, ("user", "assistant")[t % 2], f"text {t}.") for t in range(5000)] + [(7, 5, "system", "late")]
    got = {r.conv_id: r for r in conversations.audits(spark.createDataFrame(rows, CONV)).collect()}
    assert len(got) == 41 and got[99].audit == "K" * 5000 and got[3].audit == "KK" and got[7].audit == "KKD"
    none = spark.createDataFrame([], CONV)
    assert conversations.audits(none).count() == 0 and conversations.repaired_digests(none, conversations.audits(none)).count() == 0


@pytest.mark.skipif(not os.path.isdir(D), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_kd_search", "op12_conversation_repair", "op13_periodic_runs"])
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for f in os.listdir(D):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{D}/{f}'")
    want, got = con.sql(queries.ORACLES[name]), queries.QUERIES[name](spark, D)
    assert sorted(want.columns) == sorted(got.columns)
    assert sorted((tuple(r[c] for c in want.columns) for r in got.collect()), key=str) == sorted(want.fetchall(), key=str)


def test_every_original_conversation_is_told(spark, tmp_path):
    rows = [(c, t, ("user", "assistant")[t % 2], f"t{c} {t}.") for c in [*range(300), None] for t in range(c % 2 + 1 if c is not None else 3)]
    spark.createDataFrame(rows, CONV).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in queries.op12_conversation_repair(spark, str(tmp_path)).collect()}
    assert len(got) == 301
    gone = [c for c in range(0, 300, 2) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert gone and all(tuple(got[c])[1:] == (0,) * 6 + ("", hashlib.sha256(b"").hexdigest()) for c in gone)

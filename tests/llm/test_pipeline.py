"""The stages one by one on odd rows."""

import hashlib
import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

KIND = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, topic string, n_found string, component_id string, n_lines string, ids string, probability string"


def prose(rng, n=80):
    return " ".join(f"w{rng.randint(0, 3000)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    texts = [prose(rng) for _ in range(30)] + [None, "", " \n ", "short", "x" * 60_000]
    out = [(i, x, "en", "s", len(x or ""), True, "t", *["clash"] * 5) for i, x in enumerate(texts)]
    out += [(0, *out[0][1:])]  # a repeated row
    out += [(None, prose(rng), None, None, None, None, None, *[None] * 5)] * 2
    out += [(900, prose(rng, 30_000), "en", "s", 1, False, "t", *["clash"] * 5)]
    return out


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:-1], ids=lambda s: s[0])
def test_stages_keep_columns_and_rows(spark, rows, stage, tmp_path):
    docs = spark.createDataFrame(rows, KIND).repartition(3)
    got = stage[1](spark, docs, str(tmp_path))
    assert got.schema.names == docs.schema.names and [f.dataType for f in got.schema] == [f.dataType for f in docs.schema]
    kept = got.collect()
    by = {r[0]: r for r in rows}
    assert all(r.ids == by[r.doc_id][10] for r in kept) and {r.doc_id for r in kept} >= {1, 2, 3, 900}
    assert stage[1](spark, docs.where("false"), str(tmp_path)).count() == 0
    if stage[0] == "near_duplicates":
        assert sum(r.doc_id == 0 for r in kept) == 1
    if stage[0] == "quality":
        assert not {30, 31, 32, 33, 34} & {r.doc_id for r in kept}


def test_a_run_equals_its_stages(spark, rows, tmp_path):
    spark.createDataFrame(rows, KIND).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
    want, got = docs.collect(), corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, got)) == sorted(map(str, want)) and len(got) > 20
    from tokenizers import Tokenizer
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r[0]: r[1] for r in rows}
    for r in got:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        if r.doc_id is not None:
            assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_planted_copies_and_rejects(spark, tmp_path):
    rng = random.Random(9)
    clean = [prose(rng, 120) for _ in range(25)]
    near = clean[3].split()
    near[60] = "changed"
    texts = [*clean, clean[1], " ".join(near), "spam spam spam " * 40, "too short"]
    frame = spark.createDataFrame([(i, x, "en", f"s{i % 2}", len(x)) for i, x in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select(F.col("doc_id")).collect()}
    assert got <= set(range(25)) and len(got) >= 20

"""Stages of the corpus pipeline against brute force, and the pipeline as a whole."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from strongroom.llm.common import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def corpus(spark, tmp_path):
    words = {"en": "the and house with water under stone river", "fr": "le et maison avec eau sous pierre fleuve"}
    rows = []
    for k in range(60):
        lang = ("en", "fr")[k % 2]
        w = words[lang].split()
        text = " ".join(w[(k * 7 + j * (k % 5 + 1)) % 8] + ("s" * (j * k % 3)) for j in range(20 + k))
        rows.append((k, text, lang if k % 10 else None, f"s{k % 4}"))
    rows += [(100, rows[3][1], "fr", "s1"), (101, rows[3][1].upper(), "fr", "s2"), (102, None, "en", "s0"), (103, "12 34 !!", "en", "s0"), (104, "", None, None),
             (105, "the house token = abcdef123456 under water", "en", None), (None, rows[4][1], None, None), (0, rows[0][1], "en", "s0")]
    df = spark.createDataFrame([(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], SCHEMA)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    return rows, str(tmp_path)


def test_stages(spark, corpus):
    rows, sf = corpus
    docs = spark.read.parquet(f"{sf}/documents.parquet")

    first = stored(P.language_stage(spark, docs, sf), "t")
    kept = first.collect()
    assert first.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept) == sorted(str(r[0]) for r in rows if re.search("[a-zA-Z]", r[1] or ""))
    assert all(r.lang for r in kept)

    second = stored(P.dedup_stage(spark, first, sf), "t")
    left = second.collect()
    assert second.columns == docs.columns
    ids = [r.doc_id for r in left]
    assert len(ids) == len(set(ids)) and not {100, 101, None} & set(ids) and {3, 4, 0, 105} <= set(ids)

    third = stored(P.secrets_stage(spark, second, sf), "t")
    clean = {r.doc_id: r for r in third.collect()}
    assert third.columns == docs.columns and set(clean) == set(ids)
    assert clean[105].text == "the house [SECRET] under water" and clean[105].n_chars == len(clean[105].text)
    assert all(clean[r.doc_id].text == r.text for r in left if r.doc_id != 105)

    fourth = stored(P.mixing_stage(spark, third, sf), "t")
    mixed = fourth.collect()
    assert fourth.columns == docs.columns and all(r.n_chars == len(r.text) for r in mixed)
    times = {}
    for r in mixed:
        times[r.doc_id] = times.get(r.doc_id, 0) + len(r.text.split())
    assert all(n <= 3 * len(clean[i].text.split()) for i, n in times.items())
    total = sum(len(r.text.split()) for r in clean.values())
    assert abs(sum(times.values()) - total) <= 5 * 128

    packed = P.packing_stage(spark, fourth, sf).agg(F.sum("length").alias("n"), F.count(F.when(F.col("start") == 0, 1)).alias("docs")).first()
    assert packed.docs == len(mixed) and packed.n >= sum(times.values())


def test_run(spark, corpus):
    _, sf = corpus
    out = P.run(spark, sf)
    assert {"doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert [name for name, _ in P.STAGES] == ["language", "near-dedup", "secrets", "mixing", "packing"]


def test_empty(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0

"""A training-corpus pipeline over ``documents`` made of the library's operators.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strongroom.llm import language, mixing, packing, secrets, simhash
from strongroom.llm.common import crc_mod, stored
from strongroom.llm.queries import word_bpe


def measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in order, ``n_chars`` that of the present text."""
    return docs.select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in columns])


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language (no letter in the text, or no likeness to any language) go; a null ``lang`` is filled in."""
    model = language.learn(docs.where(F.coalesce(crc_mod(F.col("doc_id"), 4) != 2, F.lit(True))), "text", "lang")
    found = language.identify(docs, model, keep=tuple(docs.columns))
    kept = found.where((F.col("lang_pred") != "und") & (F.col("score") > 0))
    return kept.select(*[F.coalesce("lang", "lang_pred").alias("lang") if c == "lang" else F.col(c) for c in docs.columns])


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of smallest id stays (ids that are null last)."""
    rows = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "rows")
    key = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("_row").alias("row"))
    groups = simhash.near_duplicates(rows.select(key.alias("key"), "text"), id_col="key", shingle=3, max_bits=2)
    kept = groups.where(F.col("key.row") == F.col("component_id.row")).select(F.col("key.row").alias("_row"))
    return rows.join(kept, "_row", "left_semi").drop("_row")


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; its secrets are replaced, live-looking ones and copied examples by different marks."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    found = secrets.scan(docs, keep=others)
    return measured(found.withColumn("text", secrets.redact(F.col("text"), F.col("found"))), docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources at their target weights, as documents: whole texts for whole passes, taken words for the partial one."""
    others = tuple(c for c in docs.columns if c != "doc_id")
    documents, _ = mixing.mix(docs, keep=others)
    rest = tuple(c for c in others if c not in ("text", "source"))
    return measured(mixing.taken_texts(documents, "doc_id", "text", "source", rest), docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in packed sequences, with their token ids."""
    return packing.pack(docs, word_bpe())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language_stage),
    ("near-dedup", dedup_stage),
    ("secrets", secrets_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL can't express the stages (hyperdimensional vectors, XXH64, a tokenizer);
#: tests/llm/test_llm_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"pipeline-{name}")
    return docs

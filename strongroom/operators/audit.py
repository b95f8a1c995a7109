"""Audits (A1-A12): the data-bearing rules of the model as checks.  Each
returns the violating rows (empty on a healthy vault)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strongroom.functions.hashing import _join, hash_key, normalise_key
from strongroom.operators.checksums import differing_buckets, rows_of_buckets
from strongroom.operators.common import HOT_KEY_BUCKET, null_safe_differs, packed, previous_value, text_columns, unpacked
from strongroom.operators.specs import HASH_DIFF, LOAD_DTS, PLACE, REC_SRC


def audit_key_one_to_one(hub: DataFrame, hk: str, bk: Sequence[str]) -> DataFrame:
    """A1: hash key <-> normalised business key must be one-to-one, both ways.
    Returns (KIND, KEY, N): HK_MANY_BK (collision) or BK_MANY_HK (recipe drift)."""
    norm = _join([F.coalesce(normalise_key(c), F.lit("\\N")) for c in bk])
    base = hub.select(F.col(hk).alias("_hk"), norm.alias("_bk")).distinct()
    a = base.groupBy("_hk").agg(F.count(F.lit(1)).alias("N")).filter("N > 1")
    a = a.select(F.lit("HK_MANY_BK").alias("KIND"), F.col("_hk").alias("KEY"), "N")
    b = base.groupBy("_bk").agg(F.count(F.lit(1)).alias("N")).filter("N > 1")
    b = b.select(F.lit("BK_MANY_HK").alias("KIND"), F.col("_bk").alias("KEY"), "N")
    return a.unionByName(b)


def audit_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A2, A3, A4, A10: keys that occur more than once, with counts."""
    texts = text_columns(df, [k for k in keys if k != PLACE])
    out = packed(df.select(*keys), texts).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
    return unpacked(out.filter(F.col("occurrences") > 1), texts)


def audit_missing_parent(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is not in the parent (anti join)."""
    p = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(p, child_key, "left_anti")


def audit_stub_share(hubs: dict[str, tuple[DataFrame, str, Sequence[DataFrame]]]) -> DataFrame:
    """Per hub, keys without any satellite row and their share."""
    out = None
    for name, (hub, hk, sats) in hubs.items():
        keys = hub.select(hk).distinct()
        flagged = keys.withColumn("_bare", F.lit(True))
        for sat in sats:
            has = sat.select(hk).distinct().withColumn("_has", F.lit(True))
            flagged = flagged.join(has, hk, "left").withColumn(
                "_bare", F.col("_bare") & F.col("_has").isNull()
            ).drop("_has")
        row = flagged.agg(F.count(F.lit(1)).alias("KEYS"), F.count_if("_bare").alias("KEYS_WITHOUT_SAT"))
        row = row.select(
            F.lit(name).alias("HUB"),
            "KEYS",
            "KEYS_WITHOUT_SAT",
            (F.lit(100.0).cast("decimal(4,1)") * F.col("KEYS_WITHOUT_SAT") / F.nullif(F.col("KEYS"), F.lit(0)))
            .cast("decimal(5,2)")
            .alias("STUB_PCT"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def audit_hash_drift(hub: DataFrame, hk: str, bk: Sequence[str], algo: str = "sha256") -> DataFrame:
    """Stored hash key differs from the key recomputed with the recipe
    (null-safe: a missing key where one is expected is a drift too)."""
    expected = hub.withColumn("EXPECTED_HK", hash_key(*bk, algo=algo))
    return expected.filter(null_safe_differs(F.col(hk), F.col("EXPECTED_HK")))


def audit_consecutive_equal(sat: DataFrame, keys: Sequence[str], hot_key_bucket: str | None = HOT_KEY_BUCKET) -> DataFrame:
    """Versions whose HASH_DIFF equals the previous version of their key."""
    p = previous_value(sat, keys, LOAD_DTS, HASH_DIFF, "_prev", hot_key_bucket, tie=[HASH_DIFF])
    return p.filter(F.col("_prev") == F.col(HASH_DIFF)).drop("_prev")


def audit_insert_only(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of an earlier table state that are missing or changed now.

    Rows loaded after the earlier state's last LOAD_DTS are new by right and left
    out; the rest is compared by checksums per bucket, computed when this
    is called, and row by row only in buckets that differ (late rows differ, and
    pass).  Columns that can't be hashed (maps) must be left out."""
    cols = before.columns
    after = after.select(*cols)
    if LOAD_DTS in cols:
        last = before.agg(F.max(LOAD_DTS)).first()[0]
        if last is not None:
            after = after.filter(F.col(LOAD_DTS).isNull() | (F.col(LOAD_DTS) <= F.lit(last)))
    which = differing_buckets(before, after, cols, cols)
    return rows_of_buckets(before, cols, which).exceptAll(rows_of_buckets(after, cols, which))


def audit_audit_columns(df: DataFrame) -> DataFrame:
    """Rows with a NULL REC_SRC or LOAD_DTS."""
    return df.filter(F.col(REC_SRC).isNull() | F.col(LOAD_DTS).isNull())

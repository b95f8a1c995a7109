"""Satellite loads and reads.

``timeline`` mode (default, decision D7) makes every load idempotent and
order-free: staged rows already stored by primary key are dropped, staged
and stored rows of the touched keys are merged per key by time, and a staged
row is kept only when its HASH_DIFF differs from its predecessor.  Any
in-order split of a feed into batches, overlapping or not, gives the
one-shot result.  ``latest`` mode is the literal rule: compare each staged
row only with the latest stored row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strongroom.functions.hashing import _join, brief, diff_text, digest, digest_of_brief, hash_diff, hash_key, key_is_valid, normalise_key
from strongroom.operators.common import HOT_KEY_BUCKET, PART, carried, hash_columns, last_per_key, next_value, packed, place, previous_value, unpacked, with_parts
from strongroom.operators.specs import HASH_DIFF, LOAD_DTS, PLACE, REC_SRC, SatSpec


def parent_is_valid(spec: SatSpec) -> Column:
    """True where the parent key is one that a hub accepts (D3) and LOAD_DTS is present."""
    return key_is_valid(*(spec.parent_bk or (spec.parent_hk,))) & F.col(LOAD_DTS).isNotNull()


def stage_sat(stg: DataFrame, spec: SatSpec, key_text: bool = False, placed: bool = False) -> DataFrame:
    """Staged satellite rows: parent key, [SSQN], LOAD_DTS, HASH_DIFF, REC_SRC, payload.

    Rows whose parent key is NULL or blank are left out, as in the hub load;
    ``sat_rejects`` returns them.  A parent key or hash diff (``<name>_HD``)
    that the feed holds already (stage L2, ``stage_hashed``) is taken as it is.
    ``key_text`` gives the text that the parent key digests in its place; ``placed`` keeps PLACE."""
    if key_text:
        hk = _join([normalise_key(b) for b in spec.parent_bk]).alias(spec.parent_hk)
    elif spec.parent_bk and spec.parent_hk not in stg.columns:
        hk = hash_key(*spec.parent_bk, algo=spec.algo).alias(spec.parent_hk)
    else:
        hk = F.col(spec.parent_hk)
    cols: list[Column] = [hk]
    if spec.ssqn:
        cols.append(F.col(spec.ssqn))
    diff = hash_diff(*spec.diff_cols(), algo=spec.algo, strict=spec.strict_hashdiff)
    if f"{spec.name}_HD" in stg.columns:
        diff = F.col(f"{spec.name}_HD")
    cols += [F.col(LOAD_DTS), diff.alias(HASH_DIFF), F.col(REC_SRC)]
    cols += [F.col(p) for p in spec.payload]
    cols += [F.col(p) for p in spec.extra]
    cols += [F.col(PLACE)] if placed else []
    return stg.filter(parent_is_valid(spec)).select(*cols)


def _batch_reduce(staged: DataFrame, spec: SatSpec) -> tuple[DataFrame, DataFrame]:
    """Collapse exact duplicates of one primary key and split off ties.

    One group-by does both: equal HASH_DIFF under one PK collapses to a row;
    two HASH_DIFFs under one PK (same microsecond, two payloads, no SSQN) is
    a tie that is never picked silently but returned as rejects.
    """
    pk = spec.pk()
    rest = [c for c in staged.columns if c not in pk and c != HASH_DIFF]
    g = staged.groupBy(*pk).agg(
        F.min(HASH_DIFF).alias("_hd_min"),
        F.max(HASH_DIFF).alias("_hd_max"),
        F.min(F.struct(*[F.col(c) for c in rest])).alias("_r"),
    )
    clean = g.filter(F.col("_hd_min") == F.col("_hd_max")).select(
        *pk, F.col("_hd_min").alias(HASH_DIFF), *[F.col(f"_r.{c}").alias(c) for c in rest]
    )
    ties = g.filter(F.col("_hd_min") != F.col("_hd_max")).select(*pk)
    rejects = staged.join(ties, pk, "left_semi")
    return clean.select(*staged.columns), rejects


def load_sat(
    stg: DataFrame,
    sat: DataFrame | None,
    spec: SatSpec,
    mode: str = "timeline",
    hot_key_bucket: str | None = HOT_KEY_BUCKET,
    placed: bool = False,
) -> DataFrame:
    """Rows to append to ``sat`` (S1, S2, S4 per row, S5).

    ``stg`` is a staging feed; the hash key and hash diff are computed here
    (or were pre-computed when ``spec.parent_bk`` is empty).  A first load
    (timeline mode) runs on the short text that the hash key digests, as the hub
    and link loads do, and hashes the keys of the rows that stay.

    ``placed``: the feed is placed by the first part of the parent key.  A first load
    compares its rows where they lie, and the result is placed as well.
    """
    if placed and (sat is not None or mode != "timeline"):
        raise ValueError("only first loads in timeline mode take placed feeds")
    if sat is None and mode == "timeline" and spec.parent_bk and spec.parent_hk not in stg.columns:
        staged = stage_sat(stg, spec, key_text=True, placed=placed)
        if f"{spec.name}_HD" not in stg.columns and set(spec.diff_cols()) <= {*spec.payload, *spec.extra}:
            # The payloads are compared in brief, made after the shuffle; the rows that stay are hashed.
            parts = with_parts(staged.drop(HASH_DIFF), spec.part_keys(), LOAD_DTS, hot_key_bucket)
            parts = parts if placed else parts.repartition(F.col(PART))
            diff = brief(diff_text(*spec.diff_cols(), strict=spec.strict_hashdiff), spec.algo)
            staged = parts.withColumn(HASH_DIFF, diff).select(*staged.columns, PART)
            rows = _load_timeline(staged, None, spec, hot_key_bucket).withColumn(HASH_DIFF, digest_of_brief(F.col(HASH_DIFF), spec.algo))
        else:
            rows = _load_timeline(staged, None, spec, hot_key_bucket)
        return rows.withColumn(spec.parent_hk, digest(F.col(spec.parent_hk), spec.algo))
    staged = stage_sat(stg, spec, placed=placed)
    if mode == "latest":
        return _load_latest(staged, sat, spec)
    if mode != "timeline":
        raise ValueError(f"unknown satellite load mode {mode!r}")
    return _load_timeline(staged, sat, spec, hot_key_bucket)


def sat_rejects(stg: DataFrame, spec: SatSpec) -> DataFrame:
    """Feed rows that the load refuses, with a ``REASON``: ``KEY`` (NULL or
    blank parent key, or no LOAD_DTS), ``TIE`` (one primary key with two
    payloads).  Every other row is loaded or absorbed as a duplicate."""
    refused = stg.filter(~parent_is_valid(spec)).withColumn("REASON", F.lit("KEY"))
    # The texts that the hashes digest tell ties as well.
    hk = _join([normalise_key(b) for b in spec.parent_bk]) if spec.parent_bk else F.col(spec.parent_hk)
    diff = brief(diff_text(*spec.diff_cols(), strict=spec.strict_hashdiff), spec.algo)
    valid = stg.filter(parent_is_valid(spec)).withColumns({"_hk": hk, "_hd": diff})
    pk = ["_hk", *([spec.ssqn] if spec.ssqn else []), LOAD_DTS]
    ties = valid.groupBy(*pk).agg(F.min("_hd").alias("_lo"), F.max("_hd").alias("_hi")).filter("_lo <> _hi")
    same = F.lit(True)
    for c in pk:  # null-safe: the SSQN may be NULL
        same = same & F.col(f"v.{c}").eqNullSafe(F.col(f"t.{c}"))
    tied = valid.alias("v").join(ties.alias("t"), same, "left_semi").drop("_hk", "_hd")
    return refused.unionByName(tied.withColumn("REASON", F.lit("TIE")))


def _load_latest(staged: DataFrame, sat: DataFrame | None, spec: SatSpec) -> DataFrame:
    if sat is None:
        return staged
    keys = spec.part_keys()
    latest = last_per_key(sat.select(*keys, LOAD_DTS, HASH_DIFF), keys, [LOAD_DTS, HASH_DIFF])
    latest = latest.select(*keys, F.col(HASH_DIFF).alias("_stored_hd"))
    out = staged.join(latest, keys, "left")
    out = out.filter(F.col("_stored_hd").isNull() | (F.col("_stored_hd") != F.col(HASH_DIFF)))
    return out.drop("_stored_hd")


def _load_timeline(staged: DataFrame, sat: DataFrame | None, spec: SatSpec, bucket: str | None) -> DataFrame:
    """Timeline rule in one shuffle by parent key and time bucket.

    Stored rows of the touched keys (PK and HASH_DIFF only) are found with a
    ``left_semi`` join, which Spark broadcasts when the batch's key list is
    small, so the stored satellite is filtered where it lies.  They are
    unioned with the staged rows and two windows over the same partitioning
    and order decide:
      1. a peer window (rows of one primary key) drops staged rows whose PK
         is already stored (insert-only: the stored row wins) and ties, i.e.
         one PK with two payloads (``sat_rejects`` returns those);
      2. an ordered ``lag`` keeps a staged row only when its HASH_DIFF
         differs from its predecessor's; an exact duplicate equals its twin
         and falls out by the same rule.
    """
    keys = spec.part_keys()
    pk = spec.pk()
    cols = [c for c in staged.columns if c != PART]
    payload = [c for c in cols if c not in pk and c not in (HASH_DIFF, REC_SRC, PLACE)]
    merged = staged.withColumn("_new", F.lit(True))
    if sat is not None:
        touched = staged.select(*keys).distinct()
        hist = sat.select(*pk, HASH_DIFF).join(touched, keys, "left_semi").withColumn("_new", F.lit(False))
        merged = merged.unionByName(hist, allowMissingColumns=True)
    # The windows' shuffles carry the digests packed.
    hashes = [c for c in hash_columns(merged) if c == HASH_DIFF or (c == spec.parent_hk and PART not in merged.columns)]
    merged = packed(merged, hashes)
    if PART not in merged.columns:
        merged = with_parts(merged, keys, LOAD_DTS, bucket)
        merged = merged if place(merged) else merged.repartition(F.col(PART))
    # Both windows have the same order, so the rows are sorted once.
    tie = ["_new", REC_SRC, *payload]
    peers = Window.partitionBy(*place(merged), PART, LOAD_DTS).orderBy(*tie).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    staged_hd = F.when(F.col("_new"), F.col(HASH_DIFF))
    merged = merged.withColumns(
        {
            "_stored_pk": F.max((~F.col("_new")).cast("int")).over(peers),
            "_hd_lo": F.min(staged_hd).over(peers),
            "_hd_hi": F.max(staged_hd).over(peers),
        }
    )
    ok = ~F.col("_new") | ((F.col("_stored_pk") == 0) & (F.col("_hd_lo") == F.col("_hd_hi")))
    merged = merged.filter(ok).drop("_stored_pk", "_hd_lo", "_hd_hi")
    merged = previous_value(merged, keys, LOAD_DTS, HASH_DIFF, "_prev_hd", bucket, tie=tie)
    keep = F.col("_new") & (F.col("_prev_hd").isNull() | (F.col("_prev_hd") != F.col(HASH_DIFF)))
    return unpacked(merged.filter(keep).select(*cols), hashes)


def load_multi_active_sets(stg: DataFrame, sat: DataFrame | None, spec: SatSpec) -> DataFrame:
    """Multi-active load comparing whole sets (S4): the set of rows of a parent
    key at one LOAD_DTS is a version; a set that gains, loses or changes a
    member is stored again in full.  The set fingerprint is order-free and
    built from partial aggregates (count, xor and sum of 64-bit row hashes),
    so no set is ever collected into one row."""
    if not spec.ssqn:
        raise ValueError("whole-set load needs spec.ssqn")
    hk = spec.parent_hk
    # One row per primary key; ``sat_rejects`` returns the ties.
    staged, _ = _batch_reduce(stage_sat(stg, spec), spec)
    row_hash = F.xxhash64(F.col(spec.ssqn).cast("string"), F.col(HASH_DIFF))

    def fingerprint(df: DataFrame) -> DataFrame:
        return df.groupBy(hk, LOAD_DTS).agg(
            F.count(F.lit(1)).alias("_n"),
            F.bit_xor(row_hash).alias("_x"),
            F.sum(row_hash.cast("decimal(38,0)")).alias("_s"),
        ).select(hk, LOAD_DTS, F.concat_ws(":", "_n", "_x", "_s").alias("_set_hd"))

    new_sets = fingerprint(staged).withColumn("_new", F.lit(True))
    if sat is not None:
        # Only the touched keys' stored rows are fingerprinted.
        touched = staged.select(hk).distinct()
        stored_sets = fingerprint(sat.select(hk, spec.ssqn, LOAD_DTS, HASH_DIFF).join(touched, [hk], "left_semi"))
        new_sets = new_sets.join(stored_sets.select(hk, LOAD_DTS), [hk, LOAD_DTS], "left_anti")
        new_sets = new_sets.unionByName(stored_sets.withColumn("_new", F.lit(False)))
    changed = (
        previous_value(new_sets, [hk], LOAD_DTS, "_set_hd", "_prev")
        .filter(F.col("_new") & (F.col("_prev").isNull() | (F.col("_prev") != F.col("_set_hd"))))
        .select(hk, LOAD_DTS)
    )
    return staged.join(changed, [hk, LOAD_DTS], "left_semi")


def current(sat: DataFrame, keys: Sequence[str], order: Sequence[str] = (LOAD_DTS,)) -> DataFrame:
    """Latest row per key (S3).  A partially aggregated ``max(struct)``: no
    full shuffle of the history and no single task for a hot key."""
    return last_per_key(sat, keys, list(order) + ([HASH_DIFF] if HASH_DIFF in sat.columns else []))


def end_dated(
    sat: DataFrame, keys: Sequence[str], to_col: str = "LOAD_END_DTS", hot_key_bucket: str | None = HOT_KEY_BUCKET
) -> DataFrame:
    """``[LOAD_DTS, LOAD_END_DTS)`` per version, computed at read time."""
    return next_value(sat, keys, LOAD_DTS, LOAD_DTS, to_col, hot_key_bucket)


def as_of(sat: DataFrame, keys: Sequence[str], ts: Column | str) -> DataFrame:
    """The version in force at ``ts`` (S11): filter then latest per key."""
    t = F.lit(ts).cast("timestamp_ntz") if isinstance(ts, str) else ts
    return current(sat.filter(F.col(LOAD_DTS) <= t), keys)


def as_of_bitemporal(
    sat: DataFrame,
    keys: Sequence[str],
    load_ts: str,
    applied_ts: str,
    applied_col: str = "APPLIED_DTS",
) -> DataFrame:
    """As known at load time L for applied time A (S12): rows loaded by L and
    applied by A; the latest applied time wins, then the latest load."""
    lt = F.lit(load_ts).cast("timestamp_ntz")
    at = F.lit(applied_ts).cast("timestamp_ntz")
    known = sat.filter((F.col(LOAD_DTS) <= lt) & (F.col(applied_col) <= at))
    return last_per_key(known, keys, [applied_col, LOAD_DTS])


def split_sat(
    sat: DataFrame,
    keys: Sequence[str],
    groups: dict[str, Sequence[str]],
    algo: str = "sha256",
    hot_key_bucket: str | None = HOT_KEY_BUCKET,
) -> dict[str, DataFrame]:
    """Split a satellite by column group (S13).  Each part gets its own
    HASH_DIFF and keeps a row only where its own columns change, so the
    split loses no version of any column."""
    keys = list(keys)
    out = {}
    for name, cols in groups.items():
        cols = list(cols)
        part = sat.select(*keys, LOAD_DTS, REC_SRC, *cols).withColumn(HASH_DIFF, hash_diff(*cols, algo=algo))
        part = previous_value(part, keys, LOAD_DTS, HASH_DIFF, "_prev", hot_key_bucket)
        part = part.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(HASH_DIFF))).drop("_prev")
        out[name] = part.select(*keys, LOAD_DTS, HASH_DIFF, REC_SRC, *cols)
    return out


def merge_timelines(
    sats: Sequence[tuple[DataFrame, Sequence[str]]],
    key: str,
    algo: str = "sha256",
    hot_key_bucket: str | None = HOT_KEY_BUCKET,
) -> DataFrame:
    """Merge any number of satellite histories of one parent, each with its
    columns, without losing a version (S14): the merged timeline has a row at
    every change time of any side, each side filled as of that time; equal
    neighbours are dropped.  REC_SRC names the sources of the sides that
    changed, in the order of the sides, joined by '+' where they differ."""
    sides = [f"_v{i}" for i in range(len(sats))]
    u = None
    for side, (sat, cols) in zip(sides, sats):
        part = sat.select(key, LOAD_DTS, F.struct(*cols).alias(side), F.col(REC_SRC).alias(f"{side}_src"))
        u = part if u is None else u.unionByName(part, allowMissingColumns=True)
    # Equal times of several sides collapse into one row before filling.
    u = u.groupBy(key, LOAD_DTS).agg(
        *[F.max(c).alias(c) for c in sides],
        F.array_join(F.array_distinct(F.array_compact(F.array(*[F.max(f"{c}_src") for c in sides]))), "+").alias(REC_SRC),
    )
    u = carried(u, [key], LOAD_DTS, sides, hot_key_bucket)
    names = [c for _, cols in sats for c in cols]
    m = u.select(key, LOAD_DTS, REC_SRC, *[F.col(side)[c].alias(c) for side, (_, cols) in zip(sides, sats) for c in cols])
    m = m.withColumn(HASH_DIFF, hash_diff(*names, algo=algo))
    m = previous_value(m, [key], LOAD_DTS, HASH_DIFF, "_prev", hot_key_bucket)
    return m.filter(F.col("_prev").isNull() | (F.col("_prev") != F.col(HASH_DIFF))).drop("_prev")


def merge_sats(
    a: DataFrame,
    b: DataFrame,
    key: str,
    a_cols: Sequence[str],
    b_cols: Sequence[str],
    algo: str = "sha256",
) -> DataFrame:
    """Merge two satellite histories of one parent (S14, see merge_timelines)."""
    return merge_timelines([(a, list(a_cols)), (b, list(b_cols))], key, algo)


def change_rate(
    sat: DataFrame, keys: Sequence[str], cols: Sequence[str], hot_key_bucket: str | None = HOT_KEY_BUCKET
) -> DataFrame:
    """Versions per column (S15): for each payload column the number of rows
    where it differs from the previous row of its key (the first row of a
    key counts), the number of keys and the changes per key.  All columns are
    measured in one pass with one window and one aggregate."""
    keys = list(keys)
    rows = sat.select(*keys, LOAD_DTS, F.struct(*cols).alias("_v"))
    rows = previous_value(rows, keys, LOAD_DTS, "_v", "_prev", hot_key_bucket)  # NULL for the first row of a key
    flags = [
        F.when(F.col("_prev").isNotNull() & F.col("_prev")[c].eqNullSafe(F.col("_v")[c]), 0).otherwise(1).alias(c)
        for c in cols
    ]
    per_row = rows.select(*keys, *flags)
    agg = per_row.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.count_distinct(*keys).alias("_keys"),
        *[F.sum(c).alias(c) for c in cols],
    )
    stacked = ", ".join(f"'{c}', `{c}`" for c in cols)
    out = agg.selectExpr("_rows", "_keys", f"stack({len(cols)}, {stacked}) as (COLUMN_NAME, CHANGES)")
    return out.select(
        "COLUMN_NAME",
        F.col("CHANGES").cast("bigint").alias("CHANGES"),
        F.col("_rows").alias("ROWS"),
        F.col("_keys").alias("KEYS"),
        F.round(F.col("CHANGES") / F.col("_keys"), 4).alias("CHANGES_PER_KEY"),
    )

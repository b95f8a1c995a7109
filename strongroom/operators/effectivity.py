"""Effectivity satellites (S6-S9): the only place where ranges live.

Ranges are never updated: opening and closing a relation are two rows, a
deletion is a row with IS_DELETED = 1.  HASH_DIFF of an effectivity row is
taken over the formatted begin, end and flag, so it is stable across
engines.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strongroom.functions.hashing import _join, digest, hash_key, key_is_valid, normalise_key
from strongroom.operators.common import HOT_KEY_BUCKET, last_per_key, next_value, previous_value
from strongroom.operators.satellite import _load_timeline
from strongroom.operators.specs import HASH_DIFF, LOAD_DTS, REC_SRC, SatSpec
from strongroom.sources.io import cut_lineage

# Fixed value: timestamp text used inside effectivity hash diffs.
TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
EFF_COLS = ("BEGIN_DTS", "END_DTS", "IS_DELETED")


def eff_hash_diff(algo: str = "sha256"):
    def fmt(c):
        return F.coalesce(F.date_format(F.col(c), TS_TEXT), F.lit(""))

    text = F.concat(fmt("BEGIN_DTS"), F.lit("|"), fmt("END_DTS"), F.lit("|"), F.col("IS_DELETED").cast("string"))
    return digest(text, algo)


def driving_key_effectivity(
    df: DataFrame,
    link_hk: str,
    driving: Sequence[str],
    other: Sequence[str],
    ts: str = LOAD_DTS,
    rec_src: str = REC_SRC,
    stored: DataFrame | None = None,
    hot_key_bucket: str | None = HOT_KEY_BUCKET,
) -> DataFrame:
    """Driving-key effectivity (S7): the rows to append.

    For each driving key, ordered by ``ts``: when the non-driving part
    changes, the old relation is closed and the new one opened.  Emits an
    open row (LOAD_DTS = BEGIN_DTS, END_DTS NULL) per run and a close row
    (LOAD_DTS = END_DTS = next run's begin) for every run that ended.  A
    relation that returns later opens a new run.

    ``stored`` holds the rows of earlier loads: the runs of the driving keys
    that the batch touches are its predecessors, so a batch closes what an
    earlier one opened, and any split into batches in time order gives the
    one-shot rows.  Rows with a NULL or blank key part are left out
    (``driving_key_rejects``).  Relations at one time follow each other in the
    order of their key text, then of their source.  Batches must come in time
    order; where late relations may come, use ``driving_key_changes``.
    """
    driving, other = list(driving), list(other)
    base = df.filter(key_is_valid(*driving, *other) & F.col(ts).isNotNull())
    base = base.select(*driving, *other, F.col(ts).alias("_t"), F.col(rec_src).alias("_src"))
    if stored is not None:
        runs = stored.filter(F.col("END_DTS").isNull()).join(base.select(*driving).distinct(), driving, "left_semi")
        base = base.unionByName(runs.select(*driving, *other, F.col("BEGIN_DTS").alias("_t"), F.col(REC_SRC).alias("_src")))
    base = base.withColumn("_o", _join([normalise_key(c) for c in other]))
    base = previous_value(base, driving, "_t", "_o", "_prev_o", hot_key_bucket, tie=["_o", "_src"])
    starts = base.filter(F.col("_prev_o").isNull() | (F.col("_prev_o") != F.col("_o")))
    starts = next_value(starts, driving, "_t", "_t", "_next", hot_key_bucket, tie=["_o", "_src"])
    keyed = starts.select(
        hash_key(*driving, *other).alias(link_hk),
        hash_key(*driving).alias("DRIVING_HK"),
        *driving,
        *other,
        F.col("_t").alias("BEGIN_DTS"),
        F.col("_next"),
        F.col("_src").alias(REC_SRC),
    )
    opened = keyed.select(
        link_hk, "DRIVING_HK", *driving, *other, F.col("BEGIN_DTS").alias(LOAD_DTS), "BEGIN_DTS",
        F.lit(None).cast("timestamp_ntz").alias("END_DTS"), F.lit(0).alias("IS_DELETED"), REC_SRC,
    )
    closed = keyed.filter(F.col("_next").isNotNull()).select(
        link_hk, "DRIVING_HK", *driving, *other, F.col("_next").alias(LOAD_DTS), "BEGIN_DTS",
        F.col("_next").alias("END_DTS"), F.lit(0).alias("IS_DELETED"), REC_SRC,
    )
    new = opened.unionByName(closed)
    if stored is not None:
        same = F.lit(True)
        for c in (link_hk, LOAD_DTS, "BEGIN_DTS", "END_DTS"):
            same = same & F.col(f"n.{c}").eqNullSafe(F.col(f"s.{c}"))
        new = new.alias("n").join(stored.alias("s"), same, "left_anti")
    return new


def driving_key_rejects(df: DataFrame, driving: Sequence[str], other: Sequence[str], ts: str = LOAD_DTS) -> DataFrame:
    """Rows that ``driving_key_effectivity`` leaves out: a key part NULL or blank, or no time."""
    return df.filter(~(key_is_valid(*driving, *other) & F.col(ts).isNotNull()))


def load_effectivity(stg: DataFrame, sat: DataFrame | None, parent_hk: str, algo: str = "sha256") -> DataFrame:
    """Load effectivity rows (S6): ``stg`` carries (parent key, LOAD_DTS,
    BEGIN_DTS, END_DTS, IS_DELETED, REC_SRC); loaded with the timeline rule,
    so an unchanged re-delivery adds nothing."""
    spec = SatSpec("EFF", parent_hk, EFF_COLS)
    staged = stg.select(parent_hk, LOAD_DTS, eff_hash_diff(algo).alias(HASH_DIFF), REC_SRC, *EFF_COLS)
    staged = staged.dropDuplicates([parent_hk, LOAD_DTS, HASH_DIFF])
    return _load_timeline(staged, sat, spec, HOT_KEY_BUCKET)


def detect_deletes(
    hub: DataFrame,
    hk: str,
    full_extract: DataFrame,
    extract_hk: str,
    eff: DataFrame | None,
    load_dts: str,
    rec_src: str = "SYSGEN",
) -> DataFrame:
    """Delete detection (S8) against a full extract.

    A hub key missing from the extract gets a row IS_DELETED = 1 unless its
    latest effectivity row already says deleted; a key present again after a
    deletion gets IS_DELETED = 0.  Descriptive satellites are untouched.
    """
    t = F.lit(load_dts).cast("timestamp_ntz")
    live = full_extract.select(F.col(extract_hk).alias(hk)).distinct().withColumn("_live", F.lit(True))
    cand = hub.select(hk).distinct().join(live, hk, "left")
    cand = cand.select(hk, F.when(F.col("_live"), 0).otherwise(1).alias("IS_DELETED"))
    if eff is not None:
        latest = last_per_key(eff.select(hk, LOAD_DTS, "IS_DELETED"), [hk], [LOAD_DTS]).select(
            hk, F.col("IS_DELETED").alias("_last")
        )
        cand = cand.join(latest, hk, "left")
        cand = cand.filter(F.coalesce(F.col("_last"), F.lit(0)) != F.col("IS_DELETED")).drop("_last")
    else:
        cand = cand.filter(F.col("IS_DELETED") == 1)
    return cand.select(
        hk, t.alias(LOAD_DTS), t.alias("BEGIN_DTS"), F.lit(None).cast("timestamp_ntz").alias("END_DTS"),
        "IS_DELETED", F.lit(rec_src).alias(REC_SRC),
    )


def last_observed(history: DataFrame, hk: str, ts: str = LOAD_DTS) -> DataFrame:
    """When a key was first and last seen and how often (S9), from staged
    history, without updating any hub row (partially aggregated)."""
    return history.groupBy(hk).agg(
        F.min(ts).alias("FIRST_SEEN_DTS"),
        F.max(ts).alias("LAST_SEEN_DTS"),
        F.count(F.lit(1)).alias("OBSERVATIONS"),
    )


def observed_effectivity(history: DataFrame, hk: str, eff: DataFrame | None = None, ts: str = LOAD_DTS, rec_src: str = "SYSGEN") -> DataFrame:
    """Last observations as effectivity rows that ``load_effectivity`` takes (S9):
    one row per key of the batch, BEGIN_DTS its first and END_DTS its last
    observation, loaded at that last one.  ``eff`` holds the rows of earlier
    batches: an earlier begin or later end stays, so the current version of a key
    says when it was first and last seen.  Keys and times that are NULL say nothing."""
    seen = history.filter(F.col(hk).isNotNull() & F.col(ts).isNotNull()).groupBy(hk).agg(F.min(ts).alias("_a"), F.max(ts).alias("_b"))
    if eff is not None:
        known = eff.join(seen.select(hk), hk, "left_semi").groupBy(hk).agg(F.min("BEGIN_DTS").alias("_ka"), F.max("END_DTS").alias("_kb"))
        seen = seen.join(known, hk, "left").withColumns({"_a": F.least("_a", "_ka"), "_b": F.greatest("_b", "_kb")})
    return seen.select(
        hk, F.col("_b").alias(LOAD_DTS), F.col("_a").alias("BEGIN_DTS"), F.col("_b").alias("END_DTS"),
        F.lit(0).alias("IS_DELETED"), F.lit(rec_src).alias(REC_SRC),
    )


def _runs(base: DataFrame, driving: Sequence[str], bucket: str | None) -> DataFrame:
    """Runs of rows with driving columns, ``_t``, ``_o`` and ``_src``: the first row of each, with the next run's begin ``_next``."""
    base = previous_value(base, driving, "_t", "_o", "_prev_o", bucket, tie=["_o", "_src"])
    starts = base.filter(F.col("_prev_o").isNull() | (F.col("_prev_o") != F.col("_o"))).drop("_prev_o")
    return next_value(starts, driving, "_t", "_t", "_next", bucket, tie=["_o", "_src"])


def driving_key_changes(
    df: DataFrame,
    link_hk: str,
    driving: Sequence[str],
    other: Sequence[str],
    load_dts: str,
    history: DataFrame | None = None,
    stored: DataFrame | None = None,
    ts: str = LOAD_DTS,
    rec_src: str = REC_SRC,
    hot_key_bucket: str | None = HOT_KEY_BUCKET,
) -> DataFrame:
    """Driving-key effectivity on two time axes (S7, S12): the rows to append
    for a batch loaded at ``load_dts``, whatever the times of its relations.

    A run (link key, BEGIN_DTS, END_DTS) is stored with the load time at which
    it became known.  A late relation that splits, shortens or joins stored runs
    supersedes them: a run with another end is stored again, and a run that
    no longer begins there gets IS_DELETED = 1, both at this load time.  So the
    state as known at any load time (``runs_as_known``) is what one batch of all
    rows received by then would give.

    ``history`` holds the relation rows of earlier batches (a run does not say
    when it was observed again), ``stored`` the rows made of them.  Of a touched
    driving key only the rows since the run before the batch's first row
    are read and compared.  Rows with a NULL or blank key part are left out.
    """
    driving, other = list(driving), list(other)
    if (history is None) != (stored is None):
        raise ValueError("history and stored belong together")

    def rows(source: DataFrame) -> DataFrame:
        source = source.filter(key_is_valid(*driving, *other) & F.col(ts).isNotNull())
        source = source.select(*driving, *other, F.col(ts).alias("_t"), F.col(rec_src).alias("_src"))
        return source.withColumn("_o", _join([normalise_key(c) for c in other]))

    place = F.struct("_t", "_o")
    base, state = rows(df), None
    if stored is not None:
        known = runs_as_known(stored, link_hk).withColumn("_o", _join([normalise_key(c) for c in other]))
        first = base.groupBy(*driving).agg(F.min(place).alias("_first"))
        known = known.select(link_hk, *driving, *other, F.col("BEGIN_DTS").alias("_t"), "_o", F.col("END_DTS").alias("_end"), F.col(REC_SRC).alias("_src"))
        near = known.join(first, driving).filter(place <= F.col("_first")).groupBy(*driving).agg(F.max(place).alias("_from"))
        bound = cut_lineage(first.join(near, driving, "left").select(*driving, "_from"))
        since = F.col("_from").isNull() | (place >= F.col("_from"))
        base = base.unionByName(rows(history).join(bound, driving).filter(since).drop("_from"))
        state = known.join(bound, driving).filter(since).drop("_from")
    runs = _runs(base, driving, hot_key_bucket).withColumn(link_hk, hash_key(*driving, *other))
    runs = runs.select(link_hk, *driving, *other, "_t", F.col("_next").alias("_end"), "_src", F.lit(0).alias("IS_DELETED"))
    if state is not None:
        old = state.select(F.col(link_hk).alias("_hk"), F.col("_t").alias("_ot"), F.col("_end").alias("_oe"))
        both = runs.join(old, (F.col(link_hk) == F.col("_hk")) & (F.col("_t") == F.col("_ot")), "left")
        changed = both.filter(F.col("_hk").isNull() | ~F.col("_end").eqNullSafe(F.col("_oe"))).drop("_hk", "_ot", "_oe")
        kept = runs.select(F.col(link_hk).alias("_hk"), F.col("_t").alias("_ot"))
        gone = state.join(kept, (F.col(link_hk) == F.col("_hk")) & (F.col("_t") == F.col("_ot")), "left_anti")
        runs = changed.unionByName(gone.drop("_o").withColumn("IS_DELETED", F.lit(1)))
    return runs.select(
        link_hk, hash_key(*driving).alias("DRIVING_HK"), *driving, *other, F.lit(load_dts).cast("timestamp_ntz").alias(LOAD_DTS),
        F.col("_t").alias("BEGIN_DTS"), F.col("_end").alias("END_DTS"), "IS_DELETED", F.col("_src").alias(REC_SRC),
    )


def runs_as_known(stored: DataFrame, link_hk: str, load_ts: str | None = None) -> DataFrame:
    """The runs of ``driving_key_changes`` as known at a load time (now, if none is given)."""
    if load_ts is not None:
        stored = stored.filter(F.col(LOAD_DTS) <= F.lit(load_ts).cast("timestamp_ntz"))
    return last_per_key(stored, [link_hk, "BEGIN_DTS"], [LOAD_DTS]).filter(F.col("IS_DELETED") == 0)

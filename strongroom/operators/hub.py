"""Hub loads (H1-H4): insert business keys never seen before.

A rerun adds nothing: the batch is reduced to one row per hash key (first
seen, first source: smallest LOAD_DTS, then REC_SRC, then business key,
decision D2) and guarded by an anti join on the stored hash keys.  NULL or
blank keys never reach the hub (D3); ``hub_rejects`` returns them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strongroom.functions.hashing import _join, digest, hash_key, key_is_valid, normalise_key
from strongroom.operators.common import first_per_key, packed, text_columns, unpacked
from strongroom.operators.specs import LOAD_DTS, PLACE, REC_SRC, HubSpec


def _as_list(stg: DataFrame | Sequence[DataFrame]) -> list[DataFrame]:
    return [stg] if isinstance(stg, DataFrame) else list(stg)


def load_hub(
    stg: DataFrame | Sequence[DataFrame],
    hub: DataFrame | None,
    spec: HubSpec,
    placed: bool = False,
) -> DataFrame:
    """Rows to append to ``hub``: keys of the staged feed(s) not stored yet.

    The batch is grouped on the very text that the hash key digests (short
    strings, so one row per hash key even where a part holds the delimiter),
    partially aggregated before the shuffle, and hashed only once per
    surviving key.  Only the hash-key
    column of the stored hub is read (column pruning) for the ``left_anti``
    guard, which Spark plans as a broadcast or sort-merge anti join
    depending on the stored hub's size.

    Feeds that all hold the hash key already (stage L2, ``stage_hashed``) are
    grouped on it and nothing is hashed.

    ``placed``: the feeds are placed by the first part of this key.  They are
    reduced where they lie, and the result is placed as well.
    """
    parts, at = spec.key_parts(), [PLACE] if placed else []
    if not placed and all(spec.hk in f.columns for f in _as_list(stg)):
        return _load_prehashed(_as_list(stg), hub, spec)
    cand = None
    for f in _as_list(stg):
        c = f.filter(key_is_valid(*parts)).select(
            _join([normalise_key(p) for p in parts]).alias("_key"),
            *[F.col(b).cast("string").alias(b) for b in spec.bk],
            F.col(LOAD_DTS),
            F.col(REC_SRC),
            *at,
        )
        cand = c if cand is None else cand.unionByName(c)
    # A first pass that Spark plans as a hash aggregate leaves little to the struct's sort.
    cand = cand.groupBy(*at, "_key", *spec.bk, REC_SRC).agg(F.min(LOAD_DTS).alias(LOAD_DTS))
    first = first_per_key(cand, [*at, "_key"], [LOAD_DTS, REC_SRC, *spec.bk])
    new = first.select(digest(F.col("_key"), spec.algo).alias(spec.hk), *spec.bk, LOAD_DTS, REC_SRC, *at)
    if hub is not None:
        new = new.join(hub.select(spec.hk), spec.hk, "left_anti")
    return new


def _load_prehashed(feeds: list[DataFrame], hub: DataFrame | None, spec: HubSpec) -> DataFrame:
    cand = None
    for f in feeds:
        f = packed(f, text_columns(f, [spec.hk]))
        c = f.filter(key_is_valid(*spec.key_parts())).groupBy(spec.hk, *[F.col(b).cast("string").alias(b) for b in spec.bk], REC_SRC)
        c = c.agg(F.min(LOAD_DTS).alias(LOAD_DTS))
        cand = c if cand is None else cand.unionByName(c)
    new = first_per_key(cand, [spec.hk], [LOAD_DTS, REC_SRC, *spec.bk]).select(spec.hk, *spec.bk, LOAD_DTS, REC_SRC)
    new = unpacked(new, text_columns(feeds[0], [spec.hk]))
    return new if hub is None else new.join(hub.select(spec.hk), spec.hk, "left_anti")


def hub_rejects(stg: DataFrame | Sequence[DataFrame], spec: HubSpec) -> DataFrame:
    """Staged rows whose business key is NULL or blank."""
    feeds = _as_list(stg)
    out = None
    for f in feeds:
        r = f.filter(~key_is_valid(*spec.key_parts()))
        out = r if out is None else out.unionByName(r)
    return out


def load_hub_literal(stg: DataFrame, hub: DataFrame | None, spec: HubSpec) -> DataFrame:
    """The textbook statement: SELECT DISTINCT (HK, BK, LOAD_DTS, REC_SRC) WHERE
    NOT EXISTS.  Kept only to show, via the audits, why ``load_hub`` reduces
    to one row per key: the same key with two dates or sources gives two rows."""
    cand = stg.select(
        hash_key(*spec.key_parts(), algo=spec.algo).alias(spec.hk),
        *[F.col(b).cast("string").alias(b) for b in spec.bk],
        F.col(LOAD_DTS),
        F.col(REC_SRC),
    ).distinct()
    if hub is not None:
        cand = cand.join(hub.select(spec.hk), spec.hk, "left_anti")
    return cand

"""Snapshots (P1-P6): spine, point-in-time tables and bridges.

Snapshots are numbered 0, 1, ... from the spine's start, and all the work is
done on the numbers; a time is made of one only in the result.

PIT build (P2) without a correlated MAX and without a cross join:

1. every satellite version gets the number of the first snapshot at or after
   its LOAD_DTS (``<=`` is inclusive); one partially aggregated group-by takes
   the latest LOAD_DTS per (key, number) of all satellites, and each hub key
   adds one seed row at the number where its snapshots start;
2. a window per key carries the latest LOAD_DTS forward and finds the next
   number of the key;
3. each row is then stretched to the snapshots up to the next row (a
   ``sequence`` generator after the last shuffle).

So the shuffles and the window hold versions, not keys times snapshots, and a
hot key has one row per snapshot at most.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strongroom.functions.hashing import digest
from strongroom.operators.common import packed, place, text_columns, unpacked
from strongroom.operators.sat_store import SatStore
from strongroom.operators.specs import LOAD_DTS, PLACE, REC_SRC, SNAPSHOT_DTS

# Fixed value: PIT and bridge rows are system generated.
SYSGEN = "SYSGEN"


@dataclass(frozen=True)
class Spine:
    """Snapshots ``start, start + step, ...`` up to ``end`` (inclusive).

    ``start`` and ``end`` are Columns (literals or scalar subqueries), so a
    data-derived start never goes through the driver.  ``step`` is a Spark
    interval string such as '1 day' or '1 year'.  Day, month and year steps use
    calendar arithmetic on TIMESTAMP_NTZ (dates and time-of-day text), so the
    session time zone and daylight saving never move a version into another
    snapshot.
    """

    start: Column
    end: Column
    step: str = "1 day"

    def _unit(self) -> tuple[int, str]:
        n, unit = self.step.split()
        n, unit = int(n), unit.lower().rstrip("s")
        if unit == "year":
            n, unit = 12 * n, "month"
        if unit in ("hour", "minute"):
            n, unit = n * (3600 if unit == "hour" else 60), "second"
        if unit not in ("day", "month", "second"):
            raise ValueError(f"unsupported step {self.step!r}")
        return n, unit

    def at(self, k: Column) -> Column:
        """Time of snapshot number ``k``."""
        n, unit = self._unit()
        k = (k * F.lit(n)).cast("int") if unit != "second" else k * F.lit(n)
        if unit == "day":
            return self.start + F.make_dt_interval(days=k)
        if unit == "second":
            return F.timestamp_add("SECOND", k, self.start)
        day = self.start.cast("date")
        return F.add_months(day, k).cast("timestamp_ntz") + (self.start - day.cast("timestamp_ntz"))

    def index(self, t: Column) -> Column:
        """Number of the first snapshot at or after ``t`` (0 when ``t`` is earlier)."""
        n, unit = self._unit()
        if unit == "day":
            # Whole days from start's day to t's day, plus one when t is later in its day.
            days = F.datediff(F.to_date(t), F.to_date(self.start)) + F.when(_tod(t) > _tod(self.start), 1).otherwise(0)
            k = F.ceil(days / F.lit(n))
        elif unit == "second":
            k = F.ceil(F.timestamp_diff("MICROSECOND", self.start, t) / F.lit(n * 1_000_000))
        else:
            months = (F.year(t) - F.year(self.start)) * 12 + (F.month(t) - F.month(self.start))
            k = F.floor(months / F.lit(n)).cast("long")
            k = F.when(self.at(k) >= t, k).otherwise(k + 1)
        return F.when(t.isNotNull(), F.greatest(k.cast("long"), F.lit(0).cast("long")))

    def last(self) -> Column:
        """Number of the last snapshot, -1 when ``end`` is before ``start``."""
        k = self.index(self.end)
        return F.when(self.at(k) > self.end, k - 1).otherwise(k)

    def stretch(self, df: DataFrame, lo: Column, hi: Column) -> DataFrame:
        """Each row once per snapshot number from ``lo`` to ``hi``, with SNAPSHOT_DTS; none where lo > hi."""
        df = df.withColumns({"_lo": lo, "_hi": hi}).filter(F.col("_lo") <= F.col("_hi"))
        df = df.withColumn("_k", F.explode(F.sequence("_lo", "_hi"))).withColumn(SNAPSHOT_DTS, self.at(F.col("_k")))
        return df.drop("_lo", "_hi")


def _tod(c: Column) -> Column:
    """Time of day of a TIMESTAMP_NTZ as an interval (no time zone involved)."""
    c = c.cast("timestamp_ntz")
    return c - c.cast("date").cast("timestamp_ntz")


def spine_from_hub(hub: DataFrame, end: str | Column, step: str = "1 day", at: str = "00:00:00") -> Spine:
    """Snapshots from the day of the hub's first load to ``end``, a time or
    a Column (say ``day_after`` of a feed).

    ``at`` is the time of day shared by build and query (decision D8).  The
    start is a scalar subquery, evaluated by Spark, not collected.
    """
    first_day = hub.select(F.min(F.col(LOAD_DTS)).cast("date").alias("d")).scalar()
    start = F.to_timestamp_ntz(F.concat(first_day.cast("string"), F.lit(" " + at)))
    return Spine(start, (F.lit(end) if isinstance(end, str) else end).cast("timestamp_ntz"), step)


def day_after(feed: DataFrame, ts: str = LOAD_DTS) -> Column:
    """The midnight after the feed's last row, as a scalar subquery."""
    return F.date_add(feed.select(F.max(ts).cast("date")).scalar(), 1)


def fixed_spine(start: str, end: str, step: str = "1 day") -> Spine:
    return Spine(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz"), step)


def spine_frame(spark_df: DataFrame, spine: Spine) -> DataFrame:
    """The spine as rows (one column SNAPSHOT_DTS), generated from one row."""
    one = spark_df.sparkSession.range(1)
    return spine.stretch(one, F.lit(0).cast("long"), spine.last()).select(SNAPSHOT_DTS)


def build_pit(
    hub: DataFrame,
    key: str,
    sats: dict[str, DataFrame],
    spine: Spine,
    known_keys_only: bool = False,
    since: Column | None = None,
) -> DataFrame:
    """One row per key and snapshot with, per satellite, the LOAD_DTS
    in force (the latest LOAD_DTS <= snapshot), NULL when there is none.

    ``sats`` maps the output column name to a satellite (key, LOAD_DTS...).
    ``known_keys_only`` starts each key at its first load (D9); keys first
    loaded after the last snapshot have no rows.  ``since`` builds only
    snapshots after it, none when there is no later one, from all versions
    (``extend_pit`` reads the new ones only).  Where the hub or link and all
    satellites are placed, their rows are put together where they lie.
    """
    start = F.lit(0).cast("long")
    if since is not None:  # a NULL watermark (nothing stored) starts at 0
        start = F.greatest(start, spine.index(since + F.expr("INTERVAL 1 MICROSECOND")))
    seeds = _seeds(hub, key, list(sats), spine, start, known_keys_only, place(hub, *sats.values()))
    return _pit_rows(seeds, key, sats, spine, start)


def _seeds(
    hub: DataFrame, key: str, names: Sequence[str], spine: Spine, start: Column, known_keys_only: bool, extra: Sequence[str] = ()
) -> DataFrame:
    """One row per hub key at the number where its snapshots start, no version known."""
    none = F.lit(None).cast("timestamp_ntz")
    at = F.greatest(start, spine.index(F.col(LOAD_DTS))) if known_keys_only else start
    return hub.select(*extra, key, at.alias("_k"), F.lit(True).alias("_seed"), *[none.alias(n) for n in names])


def _pit_rows(u: DataFrame, key: str, sats: dict[str, DataFrame], spine: Spine, start: Column) -> DataFrame:
    """Seed rows and versions reduced per key and number, carried forward and stretched."""
    names, none, at = list(sats), F.lit(None).cast("timestamp_ntz"), place(u)
    texts = [key] if all(text_columns(t, [key]) for t in (u, *sats.values())) else []
    u = packed(u, texts)
    for n, sat in sats.items():
        sat = packed(sat.select(*at, key, LOAD_DTS), texts)
        cols = [F.col(LOAD_DTS).alias(n) if m == n else none.alias(m) for m in names]
        k = F.greatest(start, spine.index(F.col(LOAD_DTS)))
        v = sat.filter(F.col(LOAD_DTS) <= spine.end)
        u = u.unionByName(v.select(*at, key, k.alias("_k"), F.lit(None).cast("boolean").alias("_seed"), *cols))
    u = u.groupBy(*at, key, "_k").agg(F.max("_seed").alias("_seed"), *[F.max(n).alias(n) for n in names])
    w = Window.partitionBy(*at, key).orderBy("_k")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    u = u.select(
        key, "_k", *[F.last(n, ignorenulls=True).over(so_far).alias(n) for n in names],
        F.max("_seed").over(so_far).alias("_on"), F.lead("_k").over(w).alias("_next"),
    )  # rows before the key's seed, and keys that the hub lacks, are not on
    until = F.least(F.coalesce(F.col("_next") - 1, spine.last()), spine.last())
    u = spine.stretch(unpacked(u.filter(F.col("_on")), texts), F.col("_k"), until)
    return u.select(SNAPSHOT_DTS, key, *names, F.lit(SYSGEN).alias(REC_SRC))


def extend_pit(
    pit: DataFrame,
    hub: DataFrame,
    key: str,
    sats: dict[str, DataFrame | SatStore],
    spine: Spine,
    known_keys_only: bool = False,
    late_days: int = 0,
) -> DataFrame:
    """The rows of the snapshots after the last stored one.

    The stored PIT's last snapshot is carried forward and the satellites'
    versions after it come on top, so the history before is not read: the PIT is
    read in one snapshot (a partition filter where it is stored by
    SNAPSHOT_DTS), and a satellite stored by load date in the partitions since.
    Stored snapshots are never changed.  ``late_days``: versions may have
    been stored after the last snapshot was built though they are up to that many days
    older; they are in force in the new snapshots then.  Hub keys that
    the PIT lacks start with the first new snapshot; as a key's hub row is loaded
    no later than its versions, they have no older ones.  An empty PIT is built whole.

    The result equals ``build_pit(since=last stored snapshot)``.
    """
    last = pit.agg(F.max(SNAPSHOT_DTS)).first()[0]  # one value
    read = lambda s, since: (s.read(since) if isinstance(s, SatStore) else s)
    if last is None:
        return build_pit(hub, key, {n: read(s, None) for n, s in sats.items()}, spine, known_keys_only)
    known, names = F.lit(last), list(sats)
    start = F.greatest(F.lit(0).cast("long"), spine.index(known + F.expr("INTERVAL 1 MICROSECOND")))
    since = last - dt.timedelta(days=late_days)
    new = {n: read(s, since.date()).filter(F.col(LOAD_DTS) > F.lit(since)) for n, s in sats.items()}
    carried = pit.filter(F.col(SNAPSHOT_DTS) == known).select(key, start.alias("_k"), F.lit(None).cast("boolean").alias("_seed"), *names)
    seeds = _seeds(hub, key, names, spine, start, known_keys_only)
    return _pit_rows(seeds.unionByName(carried), key, new, spine, start)


def build_bitemporal_pit(
    hub: DataFrame, key: str, sat: DataFrame, known: Spine, applied: Spine, applied_col: str = "APPLIED_DTS"
) -> DataFrame:
    """PIT on two time axes (S12, P2): one row per key, load snapshot and
    applied snapshot with the version in force, as ``as_of_bitemporal`` gives it:
    of the versions loaded by the one and applied by the other the latest
    applied, then the latest loaded; NULL when there is none.

    A dominance sweep instead of a lookup per cell of the grid.  The versions
    are reduced to one per key and cell; along the load axis a version is
    stretched only until one that beats it in its applied column; then a
    running maximum along the applied axis carries the best one on.  So no
    step makes more rows than the result has, and all windows share one
    shuffle by key, whose rows are bounded by the grid, whatever the history.
    """
    none = F.lit(None).cast("timestamp_ntz")
    best = F.struct(F.col(applied_col).alias("a"), F.col(LOAD_DTS).alias("l"))
    v = sat.filter((F.col(LOAD_DTS) <= known.end) & (F.col(applied_col) <= applied.end))
    cells = v.select(key, known.index(F.col(LOAD_DTS)).alias("_i"), applied.index(F.col(applied_col)).alias("_j"), best.alias("_v"))
    # A cell without a version where every key's rows start.
    nothing = F.struct(none.alias("a"), none.alias("l"))
    zero = F.lit(0).cast("long")
    seeds = hub.select(key, zero.alias("_i"), zero.alias("_j"), nothing.alias("_v"), F.lit(True).alias("_seed"))
    cells = cells.withColumn("_seed", F.lit(False)).unionByName(seeds).repartition(key)
    cells = cells.groupBy(key, "_i", "_j").agg(F.max("_v").alias("_v"), F.max("_seed").alias("_seed"))
    # Along the load axis: keep what beats everything loaded before in its column.
    up = Window.partitionBy(key, "_j").orderBy("_i")
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    seeded = F.col("_seed") | F.coalesce(F.max("_seed").over(earlier), F.lit(False))
    cells = cells.withColumns({"_before": F.max("_v").over(earlier), "_seed": seeded})
    cells = cells.filter(F.col("_before").isNull() | (F.col("_v") > F.col("_before"))).drop("_before")
    cells = cells.withColumn("_until", F.coalesce(F.lead("_i").over(up) - 1, known.last())).withColumn("_until", F.least("_until", known.last()))
    lines = cells.filter("_i <= _until").withColumn("_i", F.explode(F.sequence("_i", "_until"))).drop("_until")
    # Along the applied axis: the best so far, and until where nothing else comes.
    on = Window.partitionBy(key, "_i").orderBy("_j")
    so_far = on.rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.select(
        key, "_i", "_j", F.max("_v").over(so_far).alias("_v"), F.max("_seed").over(so_far).alias("_on"),
        F.least(F.coalesce(F.lead("_j").over(on) - 1, applied.last()), applied.last()).alias("_to"),
    )
    out = applied.stretch(lines.filter("_on"), F.col("_j"), F.col("_to"))
    return out.select(
        known.at(F.col("_i")).alias("KNOWN_DTS"), SNAPSHOT_DTS, key, F.col("_v.a").alias(applied_col), F.col("_v.l").alias(LOAD_DTS), F.lit(SYSGEN).alias(REC_SRC)
    )


def pit_read(
    pit: DataFrame,
    key: str,
    sats: dict[str, tuple[DataFrame, Sequence[str]]],
    snapshot: str,
    how: str = "inner",
) -> DataFrame:
    """P5: equi-joins from the PIT to satellites at one snapshot.

    ``sats`` maps the PIT column to (satellite, payload columns).  ``inner``
    is the literal query; ``left`` keeps keys without a version (NULLs).
    The snapshot filter is a partition filter when the PIT is written
    partitioned by SNAPSHOT_DTS.
    """
    out = pit.filter(F.col(SNAPSHOT_DTS) == F.lit(snapshot).cast("timestamp_ntz")).select(SNAPSHOT_DTS, key, *sats)
    for col, (sat, payload) in sats.items():
        s = sat.select(F.col(key).alias("_k"), F.col(LOAD_DTS).alias("_l"), *payload)
        out = out.join(s, (out[key] == s["_k"]) & (out[col] == s["_l"]), how).drop("_k", "_l")
    return out


def valid_stretches(deleted: DataFrame, key: str, spine: Spine) -> DataFrame:
    """(``_dk``, ``_a``, ``_b``): the stretches of snapshot numbers in which a
    key of an effectivity table is there; one that is empty (``_b < _a``) for
    a key that is gone from the start.

    ``deleted`` has the key, LOAD_DTS and, if it has one, IS_DELETED; without it
    every row is a deletion.  A snapshot sees the latest state up to it.  Of a placed table PLACE stays."""
    at = place(deleted)
    flag = F.col("IS_DELETED") if "IS_DELETED" in deleted.columns else F.lit(1)
    d = deleted.select(*at, F.col(key).alias("_dk"), F.col(LOAD_DTS).alias("_t"), flag.cast("int").alias("_gone"))
    d = d.filter(F.col("_t") <= spine.end).withColumn("_from", spine.index(F.col("_t")))
    d = d.groupBy(*at, "_dk", "_from").agg(F.max(F.struct("_t", "_gone")).getField("_gone").alias("_gone"))
    w = Window.partitionBy(*at, "_dk").orderBy("_from")  # at most one row per snapshot
    until = F.coalesce(F.lead("_from").over(w), spine.last() + 1) - 1
    d = d.withColumns({"_until": until, "_start": F.lag("_from").over(w).isNull()})
    stretch = lambda lo, hi: F.struct(lo.cast("long").alias("_a"), hi.cast("long").alias("_b"))
    before = F.when(F.col("_start"), stretch(F.lit(0), F.col("_from") - 1))
    there = F.when(F.col("_gone") == 0, stretch(F.col("_from"), F.col("_until")))
    return d.select(*at, "_dk", F.inline(F.array_compact(F.array(before, there))))


def build_bridge(
    base_link: DataFrame,
    base_keys: Sequence[str],
    joins: Sequence[tuple[DataFrame, str, Sequence[str]]],
    spine: Spine,
    deleted: DataFrame | Sequence[tuple[DataFrame, str]] | None = None,
    deleted_key: str | None = None,
    digests: Sequence[str] = (),
    algo: str = "sha256",
) -> DataFrame:
    """Hub and link keys pre-joined per snapshot.

    A base-link row appears in every snapshot at or after its LOAD_DTS; each
    extra link joins on its key with ``left`` semantics and must itself be
    loaded by the snapshot.  The links are joined as stretches of snapshot
    numbers (before its first load, a key has a stretch of NULLs) and only
    the joined rows are stretched to snapshots, so no shuffle carries them.

    ``deleted`` holds the effectivity of the relations, as one table with its
    ``deleted_key`` or as several (table, key): one is left out of the snapshots
    at which the latest state of any of its keys says deleted, and returns with a
    later IS_DELETED = 0.  Rows are cut to the stretches in which the keys are
    there (``valid_stretches``), before they are stretched to snapshots.

    Tables that are placed as the base link is are joined where their rows lie.  Where all
    tables hold texts instead of keys, ``digests`` are the columns to hash after the joins.
    """
    last = spine.last()
    own = place(base_link)
    if isinstance(deleted, DataFrame):
        if deleted_key is None:
            raise ValueError("an effectivity table needs its deleted_key")
        deleted = [(deleted, deleted_key)]
    gone = list(deleted or ())
    # The joins' shuffles carry the keys packed, where both sides hold them as texts.
    texts = text_columns(base_link, base_keys)
    for side, on in [(link, on) for link, on, _ in joins] + [(t, on) for t, on in gone]:
        texts = [c for c in texts if c != on or text_columns(side, [on])]
    base_link = packed(base_link, texts)
    rows = base_link.filter(F.col(LOAD_DTS) <= spine.end).select(
        *own, *base_keys, spine.index(F.col(LOAD_DTS)).alias("_lo"), last.alias("_hi")
    )
    for link, on, cols in joins:
        held = text_columns(link, [c for c in cols if c not in texts and c != on])
        link = packed(link, held + [c for c in (on,) if c in texts])
        texts = texts + held
        at = place(base_link, link)
        lk = link.filter(F.col(LOAD_DTS) <= spine.end).select(
            *[F.col(c).alias("_at") for c in at], F.col(on).alias("_on"), *cols, spine.index(F.col(LOAD_DTS)).alias("_l"), last.alias("_h")
        )
        to = ["_at"] if at else []
        before = lk.groupBy(*to, "_on").agg(F.min("_l").alias("_first")).filter("_first > 0")
        nulls = [F.lit(None).cast(lk.schema[c].dataType).alias(c) for c in cols]
        lk = lk.unionByName(before.select(*to, "_on", *nulls, F.lit(0).cast("long").alias("_l"), (F.col("_first") - 1).alias("_h")))
        same = rows[on] == lk["_on"]
        rows = rows.join(lk, (rows[PLACE] == lk["_at"]) & same if at else same, "left")
        # greatest and least skip the NULLs of a base row without a match.
        rows = rows.withColumns({"_lo": F.greatest("_lo", "_l"), "_hi": F.least("_hi", "_h")}).drop("_at", "_on", "_l", "_h")
        rows = rows.filter(F.col("_lo") <= F.col("_hi"))
    names = rows.drop(*own, "_lo", "_hi").columns
    for table, on in gone:
        there = valid_stretches(packed(table, [c for c in (on,) if c in texts]), on, spine)
        if place(base_link, table):
            there = there.withColumnRenamed(PLACE, "_at")
            same = (rows[PLACE] == there["_at"]) & (rows[on] == there["_dk"])
        else:
            there = there.drop(PLACE)
            same = rows[on] == there["_dk"]
        rows = rows.join(there, same, "left")
        rows = rows.withColumns({"_lo": F.greatest("_lo", "_a"), "_hi": F.least("_hi", "_b")}).drop("_at", "_dk", "_a", "_b")
        rows = rows.filter(F.col("_lo") <= F.col("_hi"))
    rows = unpacked(rows, texts)
    rows = rows.withColumns({c: digest(F.col(c), algo) for c in digests}) if digests else rows
    rows = spine.stretch(rows, F.col("_lo"), F.col("_hi"))
    return rows.select(*names, SNAPSHOT_DTS, F.lit(SYSGEN).alias(REC_SRC))

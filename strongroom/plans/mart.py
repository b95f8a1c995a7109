"""Information mart (M1-M10): dimensions, facts and reporting tables.

All builds are lazy DataFrames (views); ``materialise`` in
``strongroom.sources.io`` turns one into a table.  Current rows come from
the partially aggregated ``current`` of each satellite, never from a
correlated TOP 1.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strongroom.operators.common import hash_columns, next_value, packed, place, text_columns, unpacked
from strongroom.operators.satellite import current, merge_timelines
from strongroom.operators.specs import HASH_DIFF, LOAD_DTS, SNAPSHOT_DTS


def dim_current(
    hub: DataFrame,
    hk: str,
    bk: Sequence[str],
    sats: Sequence[tuple[DataFrame, Sequence[str]]],
    key_name: str,
) -> DataFrame:
    """Type 1 dimension (M1, M2): hub plus the current row of each satellite."""
    out = hub.select(F.col(hk).alias(key_name), *bk)
    for sat, cols in sats:
        cur = current(sat.select(hk, LOAD_DTS, *cols), [hk]).select(F.col(hk).alias("_k"), *cols)
        out = out.join(cur, out[key_name] == cur["_k"], "left").drop("_k")
    return out


def dim_history(
    hub: DataFrame,
    hk: str,
    bk: Sequence[str],
    sats: Sequence[tuple[DataFrame, Sequence[str]]],
    key_name: str,
) -> DataFrame:
    """Type 2 dimension (M3) over a hub and any number of satellites: one row
    per combined version with ``[VALID_FROM, VALID_TO)``; VALID_TO is NULL for
    the current row.  A hub key without a version has one row, valid from its
    own LOAD_DTS, whose attributes are NULL."""
    names = [c for _, cols in sats for c in cols]
    m = next_value(merge_timelines(sats, hk), [hk], LOAD_DTS, LOAD_DTS, "VALID_TO")
    m = m.select(F.col(hk).alias("_k"), F.col(LOAD_DTS).alias("VALID_FROM"), "VALID_TO", *names)
    keys = hub.select(F.col(hk).alias(key_name), *bk, F.col(LOAD_DTS).alias("_seen"))
    out = keys.join(m, F.col(key_name) == F.col("_k"), "left")
    return out.select(key_name, *bk, F.coalesce("VALID_FROM", "_seen").alias("VALID_FROM"), "VALID_TO", *names)


def calendar(df_dates: DataFrame, col: str) -> DataFrame:
    """Date dimension (M5) over the range of dates in ``col`` of a table:
    every day from the first to the last (a ``sequence`` of one row, so no
    recursion and no numbers table)."""
    bounds = df_dates.agg(F.min(F.col(col)).cast("date").alias("_a"), F.max(F.col(col)).cast("date").alias("_b"))
    days = bounds.select(F.explode(F.sequence("_a", "_b")).alias("d"))
    return date_attributes(days, "d")


def dim_date(spark, start: str = "2020-01-01", days: int = 3650) -> DataFrame:
    """Stand-alone calendar of ``days`` days from ``start`` (the reference view)."""
    one = spark.range(1).select(F.lit(start).cast("date").alias("_a"))
    seq = F.sequence(F.col("_a"), F.date_add(F.col("_a"), days - 1))
    return date_attributes(one.select(F.explode(seq).alias("d")), "d")


def date_attributes(df: DataFrame, col: str) -> DataFrame:
    d = F.col(col)
    return df.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("DATE_KEY"),
        d.alias("CALENDAR_DATE"),
        F.date_format(d, "EEEE").alias("DAY_NAME"),
        F.date_format(d, "MMMM").alias("MONTH_NAME"),
        F.year(d).alias("YEAR"),
        F.month(d).alias("MONTH_NUMBER"),
        F.dayofmonth(d).alias("DAY_OF_MONTH"),
        F.quarter(d).alias("QUARTER"),
    )


def date_key(c) -> "F.Column":
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyyMMdd").cast("int")


def dim_time(spark) -> DataFrame:
    """Time-of-day dimension (M6): one row per minute of the day."""
    m = spark.range(1).select(F.explode(F.sequence(F.lit(0), F.lit(1439))).alias("m"))
    return time_attributes(m, "m")


def time_attributes(df: DataFrame, minute_col: str) -> DataFrame:
    m = F.col(minute_col)
    h = (m / 60).cast("int")
    return df.select(
        m.cast("int").alias("TIME_KEY"),
        h.alias("HOUR"),
        (m % 60).cast("int").alias("MINUTE"),
        F.when(h < 6, "NIGHT").when(h < 12, "MORNING").when(h < 18, "AFTERNOON").otherwise("EVENING").alias("DAY_PART"),
    )


def minute_of_day(c) -> "F.Column":
    t = F.col(c) if isinstance(c, str) else c
    return (F.hour(t) * 60 + F.minute(t)).cast("int")


def lookup(df: DataFrame, ref: DataFrame, on: Sequence[str] | str, cols: Sequence[str]) -> DataFrame:
    """Reference lookup by natural key (M7), no constraint: a left join.
    Spark broadcasts ``ref`` when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` (AQE re-checks at run time), so
    the broadcast is always size-checked."""
    on = [on] if isinstance(on, str) else list(on)
    return df.join(ref.select(*on, *cols), on, "left")


def fact(
    link: DataFrame,
    link_hk: str,
    hub: DataFrame,
    hub_hk: str,
    hub_cols: Sequence[str],
    optional_links: Sequence[tuple[DataFrame, str, str, str]],
    sat: DataFrame,
    sat_keys: Sequence[str],
    measures: Sequence[str],
    required: str,
    link_cols: Sequence[str] = (),
) -> DataFrame:
    """Fact (M8): link JOIN hub, LEFT JOIN optional links, current link
    satellite, rows without detail dropped.

    ``optional_links`` = (link, join key, column, output name).  The hub and
    the optional links join on the same key, so Spark shuffles the link once
    by that key and reuses the partitioning across the three joins; the
    satellite joins on the link key.  ``link_cols`` are further columns of the
    link; the keys it is joined by are taken in any case.  Where all tables are
    placed by the hub's key, their rows are joined where they lie.
    """
    at = place(link, hub, sat, *[olink for olink, _, _, _ in optional_links])
    if link_hk not in sat_keys:
        raise ValueError(f"the satellite's keys {list(sat_keys)} lack the link key {link_hk!r}")
    wanted = [link_hk, hub_hk, *[on for _, on, _, _ in optional_links], *link_cols, LOAD_DTS]
    missing = [c for c in wanted if c not in link.columns]
    if missing:
        raise ValueError(f"the link has no {missing}")
    # All shuffles carry the hash keys packed.
    small = lambda df: packed(df, hash_columns(df))
    out = link.select(*at, *dict.fromkeys(wanted))
    hashes = hash_columns(out)
    out = packed(out, hashes).join(small(hub.select(*at, hub_hk, *hub_cols)), [*at, hub_hk], "inner")
    hashes += [c for c in hash_columns(hub.select(*hub_cols)) if c not in hashes]
    for olink, on, col, name in optional_links:
        side = small(olink.select(*at, *dict.fromkeys([on, col])))
        out = out.join(side.select(*at, on, F.col(col).alias(name)), [*at, on], "left")
        hashes += [name] if hash_columns(olink.select(col)) else []
    held = sat.select(*at, *sat_keys, LOAD_DTS, HASH_DIFF, *measures)
    cur = current(small(held), [*at, *sat_keys])
    cur = cur.select(*at, *sat_keys, *measures)
    hashes += [c for c in hash_columns(held.select(*sat_keys, *measures)) if c not in hashes]
    out = out.join(cur, [*at, link_hk], "left").drop(*at)
    return unpacked(out.filter(F.col(required).isNotNull()), hashes)


def report(fact_df: DataFrame, dims: Sequence[tuple[DataFrame, str]], group: Sequence[str], measures: dict) -> DataFrame:
    """Reporting table (M9): star join then group-by.  The joins' shuffles carry text keys packed."""
    out = fact_df
    for dim, key in dims:
        texts = text_columns(out, [key]) if text_columns(dim, [key]) else []
        out = unpacked(packed(out, texts).join(packed(dim, texts), key, "left"), texts)
    return out.groupBy(*group).agg(*[expr.alias(name) for name, expr in measures.items()])

"""Small DataFrame helpers shared by the loaders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType
from pyspark.sql.window import Window

from strongroom.functions.hashing import pack, place_of, unpack
from strongroom.operators.specs import HASH_DIFF, PLACE


def text_columns(df: DataFrame, cols: Sequence[str]) -> list[str]:
    """Those of ``cols`` that are plain strings, which ``pack`` takes."""
    return [f.name for f in df.schema.fields if f.name in cols and f.dataType == StringType()]


def hash_columns(df: DataFrame) -> list[str]:
    """String columns that hold hash keys or hash diffs, by their suffix."""
    return text_columns(df, [c for c in df.columns if c.endswith("_HK") or c == HASH_DIFF])


def packed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df`` with string columns packed for a shuffle (see ``hashing.pack``)."""
    return df.withColumns({c: pack(F.col(c)) for c in cols}) if cols else df


def unpacked(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: unpack(F.col(c)) for c in cols}) if cols else df


def placed(df: DataFrame, first: str) -> DataFrame:
    """``df`` placed by the first part of its keys: with PLACE, and dealt out by it."""
    return df.withColumn(PLACE, place_of(first)).repartition(F.col(PLACE))


def place(*dfs: DataFrame) -> list[str]:
    """[PLACE] if all of ``dfs`` are placed."""
    return [PLACE] if all(PLACE in df.columns for df in dfs) else []


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order`` tuple.

    Written as ``min(struct(order..., rest...))`` in a group-by so Spark does a
    partial aggregation before the shuffle: a key that holds a third of the
    rows is reduced inside every map task instead of landing in one task.
    """
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    hashes = hash_columns(df)
    first = F.min(F.struct(*[F.col(c) for c in order + rest])).alias("_first")
    out = packed(df, hashes).groupBy(*keys).agg(first)
    return unpacked(out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order + rest]).select(*df.columns), hashes)


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the row with the largest ``order`` tuple (see first_per_key)."""
    keys = list(keys)
    order = list(order)
    rest = [c for c in df.columns if c not in keys and c not in order]
    hashes = hash_columns(df)
    last = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_last")
    out = packed(df, hashes).groupBy(*keys).agg(last)
    return unpacked(out.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in order + rest]).select(*df.columns), hashes)


#: Time unit into which the history of a key is cut, so that a key with a
#: third of all rows is spread over many tasks; None keeps a key in one.
HOT_KEY_BUCKET = "day"
PART = "_part"


def with_parts(df: DataFrame, keys: Sequence[str], order_col: str, bucket: str | None = HOT_KEY_BUCKET) -> DataFrame:
    """Add ``_part``, a struct of the keys and the time bucket of ``order_col``.

    As one column it is the partitioning of all windows inside the buckets.
    """
    if PART in df.columns:
        return df
    cut = [F.date_trunc(bucket, F.col(order_col)).alias("_bucket")] if bucket else []
    return df.withColumn(PART, F.struct(*[F.col(k) for k in keys], *cut))


def _flags(parts: DataFrame, order: Sequence[Column], values: dict[str, Column], w, taker: str) -> DataFrame:
    """Add ``values`` and whether a row is ``_first`` and ``_last`` of its bucket.

    Rows that tie in the order are the ``taker`` together, so that two
    evaluations of the same rows never disagree on where a row goes."""
    last = F.lead(F.lit(1)).over(w).isNull()
    if taker == "_last":
        place = F.struct(*order)
        last = place.eqNullSafe(F.last(place).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return parts.withColumns(values | {"_first": F.rank().over(w) == 1, "_last": last})


def _across(rows: DataFrame, keys: Sequence[str], order: Sequence[Column], taker: str, fill: dict) -> DataFrame:
    """Let the ``taker`` rows ('_first' or '_last') of each bucket see the
    other buckets of their key.

    Only the first and last rows of the buckets go into a window per key, two
    per bucket however many rows it has; the others stay where they are.  Both
    parts read one exchange, which Spark reuses, so the input is read once."""
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    edges = rows.filter(F.col("_first") | F.col("_last")).withColumns({c: f(w) for c, f in fill.items()}).filter(F.col(taker))
    return rows.filter(~F.col(taker)).unionByName(edges)


def _narrow(df: DataFrame, value: str | None = None, out: str | None = None) -> tuple[DataFrame, list[str]]:
    """``df`` with packed hash columns, and what to unpack after the windows.
    Rows that have ``_part`` already stay as they are, their parts hold the keys."""
    hashes = [] if PART in df.columns else hash_columns(df)
    return packed(df, hashes), hashes + ([out] if value in hashes else [])


def previous_value(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value: str,
    out: str,
    bucket: str | None = HOT_KEY_BUCKET,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = the ``value`` of the previous row of the same key by ``order_col``.

    The timeline of a key is cut into time buckets (a ``date_trunc`` unit), so
    a hot key is spread over many window partitions: ``lag`` runs inside each
    (key, bucket); the first row of a bucket takes the last value of the
    previous non-empty bucket.  ``bucket=None`` is one plain window per key.
    ``tie`` adds columns that order rows sharing one ``order_col`` value.
    """
    order = [F.col(order_col)] + [F.col(c) for c in tie]
    df, hashes = _narrow(df, value, out)
    parts = with_parts(df, keys, order_col, bucket)
    w = Window.partitionBy(*place(parts), PART).orderBy(*order)
    if not bucket:
        return unpacked(parts.withColumn(out, F.lag(value).over(w)).drop(PART), hashes)
    res = _flags(parts, order, {out: F.lag(value).over(w)}, w, "_first")
    res = _across(res, keys, order, "_first", {out: lambda w: F.lag(value).over(w)}).drop(PART, "_first", "_last")
    return unpacked(res, hashes)


def next_value(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    value: str,
    out: str,
    bucket: str | None = HOT_KEY_BUCKET,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Add ``out`` = the ``value`` of the next row of the same key (see previous_value)."""
    order = [F.col(order_col)] + [F.col(c) for c in tie]
    df, hashes = _narrow(df, value, out)
    parts = with_parts(df, keys, order_col, bucket)
    w = Window.partitionBy(*place(parts), PART).orderBy(*order)
    if not bucket:
        return unpacked(parts.withColumn(out, F.lead(value).over(w)).drop(PART), hashes)
    res = _flags(parts, order, {out: F.lead(value).over(w)}, w, "_last")
    res = _across(res, keys, order, "_last", {out: lambda w: F.lead(value).over(w)}).drop(PART, "_first", "_last")
    return unpacked(res, hashes)


def carried(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    cols: Sequence[str],
    bucket: str | None = HOT_KEY_BUCKET,
) -> DataFrame:
    """Fill NULLs of ``cols`` with the key's last value that is not NULL (see
    previous_value); there is one row per key and ``order_col``.

    Filled inside the buckets, then the buckets' first rows across them, and
    once more inside, which hands what a first row took to the rows after it."""

    def filled(w) -> dict[str, Column]:
        so_far = w.rowsBetween(Window.unboundedPreceding, 0)
        return {c: F.last(c, ignorenulls=True).over(so_far) for c in cols}

    df, hashes = _narrow(df)
    parts = with_parts(df, keys, order_col, bucket)
    w = Window.partitionBy(*place(parts), PART).orderBy(order_col)
    if not bucket:
        return unpacked(parts.withColumns(filled(w)).drop(PART), hashes)
    order = [F.col(order_col)]
    res = _flags(parts, order, filled(w), w, "_first")
    fill = {c: lambda w, c=c: F.last(c, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)) for c in cols}
    return unpacked(_across(res, keys, order, "_first", fill).withColumns(filled(w)).drop(PART, "_first", "_last"), hashes)


def null_safe_differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)

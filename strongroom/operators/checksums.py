"""Order-free checksums per bucket, so that equal tables are found equal
without moving their rows (A11, Q11.1, Q11.2).

A row's bucket and checksum come from its hash.  Both sides go into one
partially aggregated group-by of a few thousand buckets, one side counted
negatively; only rows of buckets that don't cancel out are compared.  Two
tables pass as equal although they differ with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _bucket(cols: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*cols), F.lit(buckets)).cast("int")


def differing_buckets(a: DataFrame, b: DataFrame, by: Sequence[str], cols: Sequence[str], buckets: int = BUCKETS) -> list[int]:
    """Buckets (of the hash of ``by``) in which the bags of rows ``cols`` differ, at most ``buckets`` numbers."""
    signed = lambda df, s: df.select(_bucket(by, buckets).alias("_bucket"), F.xxhash64(*cols).alias("_h"), F.xxhash64(F.lit(7), *cols).alias("_g"),
                                     F.lit(s).alias("_sign"))
    both = signed(a, 1).unionByName(signed(b, -1))
    per = both.groupBy("_bucket").agg(
        F.sum("_sign").alias("_n"), F.bit_xor("_h").alias("_x"), F.sum(F.col("_g").cast("decimal(38,0)") * F.col("_sign")).alias("_s"))
    return [r[0] for r in per.filter("_n <> 0 OR _x <> 0 OR _s <> 0").select("_bucket").collect()]


def rows_of_buckets(df: DataFrame, by: Sequence[str], which: Sequence[int], buckets: int = BUCKETS) -> DataFrame:
    return df.filter(_bucket(by, buckets).isin(list(which))) if which else df.limit(0)


def reconcile_rows(a: DataFrame, b: DataFrame, key: Sequence[str], buckets: int = BUCKETS) -> DataFrame:
    """Keys whose rows differ between two tables of the same columns: the key
    and ``side`` (``A_NOT_B``, ``B_NOT_A`` or ``DIFFERENT``).

    NULL is a key value like others; a key's rows are compared as a bag.  The
    checksums are computed when this is called; where all buckets agree, no row
    is compared.  Columns that cannot be hashed (maps) must be left out."""
    key, cols = list(key), a.columns
    which = differing_buckets(a, b.select(*cols), key, cols, buckets)

    def prints(df: DataFrame, side: int) -> DataFrame:
        return rows_of_buckets(df.select(*cols), key, which, buckets).select(*key, F.lit(side).alias("_side"), F.xxhash64(*cols).alias("_h"), F.xxhash64(F.lit(7), *cols).alias("_g"))

    side = lambda k: F.col("_side") == k
    sums = lambda k: F.struct(
        F.count_if(side(k)), F.coalesce(F.bit_xor(F.when(side(k), F.col("_h"))), F.lit(0)),
        F.sum(F.when(side(k), F.col("_g").cast("decimal(38,0)")).otherwise(0)))
    per = prints(a, 0).unionByName(prints(b, 1)).groupBy(*key).agg(
        sums(0).alias("_a"), sums(1).alias("_b"), F.count_if(side(0)).alias("_na"), F.count_if(side(1)).alias("_nb"))
    side_of = F.when(F.col("_nb") == 0, "A_NOT_B").when(F.col("_na") == 0, "B_NOT_A").otherwise("DIFFERENT")
    return per.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*key, side_of.alias("side"))

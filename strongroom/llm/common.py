"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strongroom.sources.io import scratch_path

#: ASCII white space of the contracts: space, tab, LF, VT, FF, CR.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table in the shared scratch folder and read it.

    Cuts the lineage, survives lost executors, and is computed once however
    often it is read.
    """
    return stored_at(df, name)[0]


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the table's folder, for ``discard`` once it is no longer read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch table, on whatever file system it lies."""
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def word_count(text: Column) -> Column:
    """Number of words (runs without ASCII white space); null counts as 0."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(id_col: Column, m: int) -> Column:
    """crc32 of the id as text, modulo ``m``; null where the id is null."""
    return F.crc32(id_col.cast("string").cast("binary")) % m


def running_offset(df: DataFrame, key: str, value: str, order: list[Column], n_rows: int, out: str,
                   bucket_rows: int = 512, fan_out: int = 1024) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the earlier rows of the same key.

    Rows of a key are dealt to buckets by the hash of the order columns, so a
    key with a third of all rows is spread out; a row's offset is its offset
    in the bucket plus that of its bucket, found by the same sum one and two
    levels up (``bucket_rows`` rows, then ``fan_out`` buckets at a time).
    """
    n = max(1, -(-n_rows // bucket_rows))
    b, s = F.col("_bucket"), F.col("_super")
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(n))).withColumn("_super", F.floor(b / fan_out).cast("long"))
    total = F.sum(value)
    buckets = df.groupBy(key, "_super", "_bucket").agg(total.alias("_t"))
    supers = buckets.groupBy(key, "_super").agg(F.sum("_t").alias("_st"))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    supers = supers.withColumn("_s0", before(Window.partitionBy(key).orderBy("_super"), "_st"))
    buckets = buckets.withColumn("_b0", before(Window.partitionBy(key, "_super").orderBy("_bucket"), "_t"))
    same = lambda a, c: a[key].eqNullSafe(c[key]) & (a["_super"] == c["_super"])
    starts = buckets.join(supers, same(buckets, supers)).select(
        buckets[key].alias("_k"), buckets["_bucket"].alias("_b"), (F.col("_b0") + F.col("_s0")).alias("_start"))
    inner = df.withColumn("_in", before(Window.partitionBy(key, "_bucket").orderBy(*order), value))
    joined = inner.join(starts, inner[key].eqNullSafe(F.col("_k")) & (b == F.col("_b")), "left")
    return joined.withColumn(out, F.col("_in") + F.col("_start")).drop("_bucket", "_super", "_in", "_start", "_k", "_b")

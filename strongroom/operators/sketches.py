"""Profiles from stored sketches (Q2.1, Q3.2, Q4.1) and samples of whole blocks.

A day's rows are profiled once, when they come: per column the rows, the
values that are not NULL and a HyperLogLog sketch of them.  Sketches merge, so
the profile of any range of days reads some rows per day and column and no data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLAIN = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)


def sketch_columns(df: DataFrame, day: str, cols: Sequence[str] | None = None, lg_k: int = 12) -> DataFrame:
    """One row per value of ``day`` and column: ``COLUMN_NAME``, ``ROWS``,
    ``POPULATED`` and ``SKETCH``.  Partially aggregated; a row shuffled holds
    one sketch (2^lg_k registers) per column."""
    cols = list(cols or [c for c in df.columns if c != day])
    plain = {f.name: isinstance(f.dataType, _PLAIN) for f in df.schema.fields}
    value = lambda c: F.col(f"`{c}`") if plain[c] else F.col(f"`{c}`").cast("string")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        aggs += [F.count(value(c)).alias(f"_p{i}"), F.hll_sketch_agg(value(c), F.lit(lg_k)).alias(f"_s{i}")]
    wide = df.groupBy(day).agg(*aggs)
    body = ", ".join(f"'{c}', _p{i}, _s{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"`{day}`", "_rows AS ROWS", f"stack({len(cols)}, {body}) AS (COLUMN_NAME, POPULATED, SKETCH)")


def profile_sketches(sketches: DataFrame) -> DataFrame:
    """Per column the rows, NULLs and estimated distinct values of the given
    sketch rows (filter them by day first); the relative deviation of the
    estimate is about 1.04 / sqrt(2^lg_k), 1.6 percent at 12."""
    out = sketches.groupBy(F.col("COLUMN_NAME").alias("column_name")).agg(
        F.sum("ROWS").alias("total_rows"), F.sum("POPULATED").alias("populated"), F.hll_sketch_estimate(F.hll_union_agg("SKETCH")).alias("distinct_vals"))
    return out.select("column_name", "total_rows", "populated", (F.col("total_rows") - F.col("populated")).alias("nulls"), "distinct_vals")


def block_sample(spark: SparkSession, path: str, pct: float, seed: int = 42) -> tuple[DataFrame, int, int]:
    """A sample of whole files of a Parquet table (G10): the rows, how many
    files were chosen and how many there are.  Files are chosen by a hash of
    their name, at least one; the others are not opened."""
    files = sorted(spark.read.parquet(path).inputFiles())
    place = lambda f: int(hashlib.sha256(f"{seed}:{f.rsplit('/', 1)[-1]}".encode()).hexdigest()[:12], 16)
    chosen = [f for f in files if place(f) < pct / 100 * 16**12] or sorted(files, key=place)[:1]
    return spark.read.option("basePath", path).parquet(*chosen), len(chosen), len(files)


def block_estimates(drawn: DataFrame, chosen: int, blocks: int, measures: dict[str, F.Column]) -> DataFrame:
    """Totals of the whole table from a block sample: per measure (an
    expression summed over rows; NULL counts 0) ``ESTIMATE`` and ``STD_ERROR``.

    Rows of a block are alike, so the error comes from the variance between the
    blocks' sums, with the finite population correction; it is unknown (NULL) for
    one block of several."""
    names = list(measures)
    per = drawn.groupBy(F.col("_metadata.file_path").alias("_block")).agg(*[F.coalesce(F.sum(m), F.lit(0)).cast("double").alias(n) for n, m in measures.items()])
    wide = per.agg(*[f(n).alias(f"{n}_{k}") for n in names for k, f in (("sum", F.sum), ("var", F.var_samp))])
    scale, rest = blocks / chosen, 1 - chosen / blocks
    error = lambda n: F.lit(0.0) if chosen == blocks else F.sqrt(F.lit(blocks * blocks * rest / chosen) * F.col(f"{n}_var"))
    rows = F.array(*[F.struct(F.lit(n).alias("MEASURE"), (F.col(f"{n}_sum") * scale).alias("ESTIMATE"), error(n).alias("STD_ERROR")) for n in names])
    return wide.select(F.inline(rows))

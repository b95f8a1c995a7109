"""Profiling checks (Q1.1-Q12.1, QV): each takes DataFrames and returns a
small result DataFrame.  Counts run as one aggregate per table; scalars
that feed another check (totals, mean and deviation) are scalar
subqueries, so nothing is collected to the driver and no cross join is
planned.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the toolkit.
SENTINEL_DATES = ("1900-01-01", "9999-12-31")
TOP_N = 30
NULL_LABEL = "(NULL)"


def _pct(num: Column, den: Column) -> Column:
    """CAST(100.0 * num / NULLIF(den, 0) AS DECIMAL(5,2)), half-up."""
    return (F.lit(100.0).cast("decimal(4,1)") * num / F.nullif(den, F.lit(0))).cast("decimal(5,2)")


def row_count(df: DataFrame) -> DataFrame:  # Q1.1
    return df.agg(F.count(F.lit(1)).alias("total_rows"))


def freshness(df: DataFrame, c: str, as_of: str) -> DataFrame:  # Q1.3
    t = F.lit(as_of).cast("date")
    return df.agg(F.min(c).alias("earliest"), F.max(c).alias("latest")).withColumn(
        "days_since_last_record", F.datediff(t, F.col("latest").cast("date"))
    )


def key_uniqueness(df: DataFrame, k: str) -> DataFrame:  # Q2.1
    return df.agg(F.count(F.lit(1)).alias("total_rows"), F.count_distinct(k).alias("distinct_keys")).withColumn(
        "duplicate_rows", F.col("total_rows") - F.col("distinct_keys")
    )


def duplicate_keys(df: DataFrame, *ks: str) -> DataFrame:  # Q2.2, Q2.3
    return df.groupBy(*ks).agg(F.count(F.lit(1)).alias("occurrences")).filter(F.col("occurrences") > 1)


def fan_out(df: DataFrame, k: str) -> DataFrame:  # Q2.4
    per_key = df.groupBy(k).agg(F.count(F.lit(1)).alias("occurrences"))
    return per_key.groupBy("occurrences").agg(F.count(F.lit(1)).alias("keys_with_this_many"))


def null_profile(df: DataFrame, c: str) -> DataFrame:  # Q3.1
    out = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count(c).alias("populated"))
    out = out.withColumn("nulls", F.col("total_rows") - F.col("populated"))
    return out.withColumn("null_pct", _pct(F.col("nulls"), F.col("total_rows")))


def _countable(dt: T.DataType) -> bool:
    return not isinstance(dt, (T.VariantType, T.MapType))


def profile_columns(df: DataFrame, exact: bool = True, skip: Sequence[str] = ()) -> DataFrame:  # Q3.2
    """NULL % and distinct count of every column in one pass.

    One aggregate computes populated and distinct counts of all columns
    (exact distincts are planned by Spark as one Expand, a row per column, with
    a map-side de-duplication; for key-like columns that shuffles about rows x
    columns, so use ``exact=False``, HyperLogLog sketches, there), then
    ``stack`` turns the single wide row into one row per column.  Columns
    whose values can't be compared (map, variant) have a NULL distinct count.
    """
    cols = [f for f in df.schema.fields if f.name not in skip]
    aggs = [F.count(F.lit(1)).alias("_total")]
    for i, f in enumerate(cols):
        aggs.append(F.count(F.col(f"`{f.name}`")).alias(f"_p{i}"))
        if not _countable(f.dataType):
            dist = F.max(F.lit(None).cast("bigint"))
        else:
            dist = F.count_distinct(F.col(f"`{f.name}`")) if exact else F.approx_count_distinct(F.col(f"`{f.name}`"))
        aggs.append(dist.alias(f"_d{i}"))
    wide = df.agg(*aggs)
    body = ", ".join(f"'{f.name}', _p{i}, _d{i}" for i, f in enumerate(cols))
    out = wide.selectExpr("_total", f"stack({len(cols)}, {body}) AS (column_name, populated, distinct_vals)")
    out = out.select(
        "column_name",
        F.col("_total").alias("total_rows"),
        "populated",
        (F.col("_total") - F.col("populated")).alias("nulls"),
        _pct(F.col("_total") - F.col("populated"), F.col("_total")).alias("null_pct"),
        F.col("distinct_vals").cast("bigint").alias("distinct_vals"),
    )
    return out


def cardinality(df: DataFrame, c: str) -> DataFrame:  # Q4.1
    out = df.agg(F.count_distinct(c).alias("distinct_vals"), F.count(F.lit(1)).alias("total_rows"))
    out = out.withColumn("distinct_pct", _pct(F.col("distinct_vals"), F.col("total_rows")))
    verdict = (
        F.when(F.col("distinct_vals") == F.col("total_rows"), "KEY")
        .when(F.col("distinct_vals") < 20, "CATEGORY")
        .otherwise("ATTRIBUTE")
    )
    return out.withColumn("verdict", verdict)


def _value_text(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_LABEL))


def top_values(df: DataFrame, c: str, n: int = TOP_N) -> DataFrame:  # Q5.1
    """Top ``n`` values with share.  The total is a scalar subquery and the
    top-n is a per-partition take-ordered merge: no global window, no
    single-partition sort of all values.  Ties break on the value (D16)."""
    total = df.select(F.count(F.lit(1))).scalar()
    g = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("occurrences"))
    g = g.select(_value_text("_v").alias("value"), "occurrences")
    top = g.orderBy(F.col("occurrences").desc(), F.col("value").asc()).limit(n)
    return top.withColumn("pct", _pct(F.col("occurrences"), total))


def blank_profile(df: DataFrame, c: str) -> DataFrame:  # Q5.2
    col = F.col(c)
    return df.agg(
        F.count_if(col.isNull()).alias("is_null"),
        F.count_if(F.trim(col) == "").alias("is_blank"),
        F.count_if(col.isNotNull() & (F.trim(col) != "")).alias("is_populated"),
    )


def numeric_profile(df: DataFrame, c: str, digits: int = 4) -> DataFrame:  # Q6.1
    x = F.col(c).cast("double")
    return df.agg(
        F.min(c).alias("min_val"),
        F.max(c).alias("max_val"),
        F.round(F.avg(x), digits).alias("avg_val"),
        F.round(F.stddev_samp(x), digits).alias("std_dev"),
        F.count_if(F.col(c) < 0).alias("negatives"),
        F.count_if(F.col(c) == 0).alias("zeros"),
        F.count_if(F.col(c).isNull()).alias("nulls"),
    )


def outliers(df: DataFrame, c: str, k: float = 3.0) -> DataFrame:  # Q6.2
    x = F.col(c).cast("double")
    m = df.select(F.avg(x)).scalar()
    sd = df.select(F.stddev_samp(x)).scalar()
    return df.agg(F.count_if((x > m + F.lit(k) * sd) | (x < m - F.lit(k) * sd)).alias("outlier_rows"))


def date_profile(df: DataFrame, c: str, as_of: str) -> DataFrame:  # Q7.1
    col = F.col(c)
    t = F.lit(as_of).cast("timestamp_ntz")
    sentinel = col.cast("date").isin(*[F.lit(s).cast("date") for s in SENTINEL_DATES])
    return df.agg(
        F.min(c).alias("earliest"),
        F.max(c).alias("latest"),
        F.count_if(col.isNull()).alias("null_dates"),
        F.count_if(col > t).alias("future_dates"),
        F.count_if(sentinel).alias("sentinel_dates"),
    )


def monthly_volume(df: DataFrame, c: str) -> DataFrame:  # Q7.2
    d = df.filter(F.col(c).isNotNull())
    return d.groupBy(F.year(c).alias("yr"), F.month(c).alias("mth")).agg(F.count(F.lit(1)).alias("rows"))


def length_profile(df: DataFrame, c: str, digits: int = 4) -> DataFrame:  # Q8.1
    n = F.length(F.col(c))
    d = df.filter(F.col(c).isNotNull())
    return d.agg(F.min(n).alias("min_len"), F.max(n).alias("max_len"), F.round(F.avg(n), digits).alias("avg_len"))


def whitespace(df: DataFrame, c: str) -> DataFrame:  # Q8.2
    return df.agg(F.count_if(F.col(c) != F.trim(F.col(c))).alias("rows_with_stray_whitespace"))


def casing(df: DataFrame, c: str) -> DataFrame:  # Q8.3
    return df.agg(
        F.count_distinct(c).alias("distinct_raw"),
        F.count_distinct(F.upper(F.trim(F.col(c)))).alias("distinct_normalised"),
    )


def orphans(child: DataFrame, parent: DataFrame, k: str, parent_k: str | None = None) -> DataFrame:  # Q9.1
    """Child rows whose key is missing in the parent, written as an explicit
    anti join (a LEFT JOIN + IS NULL stays an outer join in Catalyst)."""
    pk = parent_k or k
    p = parent.select(F.col(pk).alias(k)).filter(F.col(k).isNotNull())
    c = child.select(k).filter(F.col(k).isNotNull())
    return c.join(p, k, "left_anti").agg(F.count(F.lit(1)).alias("orphan_rows"))


def contradictions(df: DataFrame, rules: dict[str, str]) -> DataFrame:  # Q10.1-Q10.3
    """Count the rows breaking each rule (a SQL predicate that is TRUE for a
    violation), all rules in one pass."""
    names = list(rules)
    wide = df.agg(*[F.count_if(F.expr(rules[n])).alias(f"_r{i}") for i, n in enumerate(names)])
    body = ", ".join(f"'{n}', _r{i}" for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {body}) AS (rule, violations)")


def reconcile_counts(a: DataFrame, b: DataFrame, a_name: str = "system_a", b_name: str = "system_b") -> DataFrame:  # Q11.1
    ca = a.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(a_name).alias("source"), "rows")
    cb = b.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(b_name).alias("source"), "rows")
    return ca.unionByName(cb)


def reconcile_keys(a: DataFrame, b: DataFrame, k: str, b_k: str | None = None) -> DataFrame:  # Q11.2
    """Keys of A missing in B and the reverse (EXCEPT DISTINCT both ways): one
    partially aggregated group-by over the keys of both sides.  Two tables that
    should be equal are compared by ``checksums.reconcile_rows``."""
    side = lambda df, c, in_a: df.select(F.col(c).alias("key"), F.lit(in_a).alias("_a"), F.lit(not in_a).alias("_b"))
    both = side(a, k, True).unionByName(side(b, b_k or k, False)).groupBy("key").agg(F.max("_a").alias("_a"), F.max("_b").alias("_b"))
    return both.filter(F.col("_a") != F.col("_b")).select("key", F.when(F.col("_a"), "A_NOT_B").otherwise("B_NOT_A").alias("side"))


def dictionary(df: DataFrame, c: str) -> DataFrame:  # Q12.1
    return df.groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def verdicts(findings: DataFrame, expectations: DataFrame) -> DataFrame:  # QV
    """ASSUMED (no finding yet), CONFIRMED (finding meets the expectation)
    or VIOLATED, per expectation (check, metric, op, expected)."""
    j = expectations.join(findings, ["check", "metric"], "left")
    holds = (
        F.when(F.col("op") == "=", F.col("value") == F.col("expected"))
        .when(F.col("op") == "<=", F.col("value") <= F.col("expected"))
        .when(F.col("op") == ">=", F.col("value") >= F.col("expected"))
    )
    v = F.when(F.col("value").isNull(), "ASSUMED").when(holds, "CONFIRMED").otherwise("VIOLATED")
    return j.select("check", "metric", "op", "expected", "value", v.alias("verdict"))

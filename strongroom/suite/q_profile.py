"""Profiling queries (Q1.1-Q12.1, QV) over the test tables, with an oracle
for each check's rule.  The result column names are fixed values."""

from __future__ import annotations

from pyspark.sql import functions as F

from strongroom.operators import profiling as P
from strongroom.operators.checksums import reconcile_rows
from strongroom.operators.sketches import block_estimates, block_sample, profile_sketches, sketch_columns
from strongroom.sources import feeds
from strongroom.sources.io import append, row_count_meta, scratch_path
from strongroom.suite.registry import register

AS_OF_FRESH = "2002-01-01"
AS_OF_DATES = "2000-01-01 00:00:00"


def t(spark, d, name):
    return feeds.table(spark, d, name)


@register("profile_row_count", "SELECT count(*) AS total_rows FROM lineitem")
def q_row_count(spark, d):
    return P.row_count(t(spark, d, "lineitem"))


@register("profile_row_count_meta", "SELECT count(*) AS approx_rows FROM lineitem")
def q_row_count_meta(spark, d):
    return row_count_meta(spark, f"{d.rstrip('/')}/lineitem.parquet")


@register(
    "profile_freshness",
    f"""SELECT min(o_orderdate) AS earliest, max(o_orderdate) AS latest,
        date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{AS_OF_FRESH}') AS days_since_last_record FROM orders""",
)
def q_freshness(spark, d):
    out = P.freshness(t(spark, d, "orders"), "o_orderdate", AS_OF_FRESH)
    return out.withColumn("days_since_last_record", F.col("days_since_last_record").cast("bigint"))


@register(
    "profile_key_uniqueness",
    """SELECT count(*) AS total_rows, count(DISTINCT l_orderkey) AS distinct_keys,
        count(*) - count(DISTINCT l_orderkey) AS duplicate_rows FROM lineitem""",
)
def q_key_uniqueness(spark, d):
    return P.key_uniqueness(t(spark, d, "lineitem"), "l_orderkey")


@register(
    "profile_duplicate_keys",
    "SELECT o_custkey, count(*) AS occurrences FROM orders GROUP BY o_custkey HAVING count(*) > 1",
)
def q_duplicate_keys(spark, d):
    return P.duplicate_keys(t(spark, d, "orders"), "o_custkey")


@register(
    "profile_composite_duplicates",
    "SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def q_composite_duplicates(spark, d):
    return P.duplicate_keys(t(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@register(
    "profile_fan_out",
    """SELECT occurrences, count(*) AS keys_with_this_many FROM (
        SELECT l_orderkey, count(*) AS occurrences FROM lineitem GROUP BY l_orderkey) GROUP BY occurrences""",
)
def q_fan_out(spark, d):
    return P.fan_out(t(spark, d, "lineitem"), "l_orderkey")


@register(
    "profile_nulls",
    """SELECT count(*) AS total_rows, count(l.quality) AS populated, count(*) - count(l.quality) AS nulls,
        CAST(100.0 * (count(*) - count(l.quality)) / NULLIF(count(*), 0) AS DECIMAL(5,2)) AS null_pct
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def q_nulls(spark, d):
    docs = t(spark, d, "documents").select("doc_id")
    lab = t(spark, d, "labels").select("doc_id", "quality")
    return P.null_profile(docs.join(lab, "doc_id", "left"), "quality")


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@register(
    "profile_columns",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) AS total_rows, count({c}) AS populated, count(*) - count({c}) AS nulls,
            CAST(100.0 * (count(*) - count({c})) / NULLIF(count(*), 0) AS DECIMAL(5,2)) AS null_pct,
            count(DISTINCT {c}) AS distinct_vals FROM customer"""
        for c in CUSTOMER_COLS
    ),
)
def q_profile_columns(spark, d):
    return P.profile_columns(t(spark, d, "customer"), exact=True)


# Approximate variant (HyperLogLog): rows-only check, no oracle.
@register("profile_columns_approx")
def q_profile_columns_approx(spark, d):
    return P.profile_columns(t(spark, d, "lineitem"), exact=False)


# The sketches against the exact counts: within three relative deviations (5 percent each).
@register("profile_columns_approx_error", "SELECT column_name, true AS within_bounds FROM (DESCRIBE lineitem)")
def q_profile_columns_approx_error(spark, d):
    table = t(spark, d, "lineitem")
    exact = P.profile_columns(table, exact=True).select("column_name", F.col("distinct_vals").alias("_exact"))
    found = P.profile_columns(table, exact=False).join(exact, "column_name")
    return found.select("column_name", (F.abs(F.col("distinct_vals") - F.col("_exact")) <= 0.15 * F.col("_exact")).alias("within_bounds"))


@register(
    "profile_cardinality",
    """SELECT count(DISTINCT o_orderpriority) AS distinct_vals, count(*) AS total_rows,
        CAST(100.0 * count(DISTINCT o_orderpriority) / NULLIF(count(*), 0) AS DECIMAL(5,2)) AS distinct_pct,
        CASE WHEN count(DISTINCT o_orderpriority) = count(*) THEN 'KEY'
             WHEN count(DISTINCT o_orderpriority) < 20 THEN 'CATEGORY' ELSE 'ATTRIBUTE' END AS verdict
    FROM orders""",
)
def q_cardinality(spark, d):
    return P.cardinality(t(spark, d, "orders"), "o_orderpriority")


@register(
    "profile_top_values",
    """SELECT coalesce(substr(CAST(l_partkey AS VARCHAR), 1, 100), '(NULL)') AS value, count(*) AS occurrences,
        CAST(100.0 * count(*) / (SELECT count(*) FROM lineitem) AS DECIMAL(5,2)) AS pct
    FROM lineitem GROUP BY l_partkey ORDER BY occurrences DESC, value ASC LIMIT 30""",
)
def q_top_values(spark, d):
    return P.top_values(t(spark, d, "lineitem"), "l_partkey", 30)


@register(
    "profile_blanks",
    """SELECT CAST(count_if(text IS NULL) AS BIGINT) AS is_null, CAST(count_if(trim(text) = '') AS BIGINT) AS is_blank,
        CAST(count_if(text IS NOT NULL AND trim(text) <> '') AS BIGINT) AS is_populated FROM documents""",
)
def q_blanks(spark, d):
    return P.blank_profile(t(spark, d, "documents"), "text")


@register(
    "profile_numeric",
    """SELECT min(c_acctbal) AS min_val, max(c_acctbal) AS max_val, round(avg(c_acctbal), 4) AS avg_val,
        round(stddev_samp(c_acctbal), 4) AS std_dev, CAST(count_if(c_acctbal < 0) AS BIGINT) AS negatives,
        CAST(count_if(c_acctbal = 0) AS BIGINT) AS zeros, CAST(count_if(c_acctbal IS NULL) AS BIGINT) AS nulls FROM customer""",
)
def q_numeric(spark, d):
    return P.numeric_profile(t(spark, d, "customer"), "c_acctbal")


@register(
    "profile_outliers",
    """SELECT count(*) AS outlier_rows FROM (
        SELECT x - sum(x) OVER () / count(x) OVER () AS off, var_samp(x) OVER () AS spread
        FROM (SELECT CAST(l_extendedprice AS DOUBLE) AS x FROM lineitem)) WHERE off * off > 9 * spread""",
)
def q_outliers(spark, d):
    return P.outliers(t(spark, d, "lineitem"), "l_extendedprice", 3.0)


@register(
    "profile_dates",
    f"""SELECT min(o_orderdate) AS earliest, max(o_orderdate) AS latest, CAST(count_if(o_orderdate IS NULL) AS BIGINT) AS null_dates,
        CAST(count_if(o_orderdate > TIMESTAMP '{AS_OF_DATES}') AS BIGINT) AS future_dates,
        CAST(count_if(CAST(o_orderdate AS DATE) IN (DATE '1900-01-01', DATE '9999-12-31')) AS BIGINT) AS sentinel_dates FROM orders""",
)
def q_dates(spark, d):
    return P.date_profile(t(spark, d, "orders"), "o_orderdate", AS_OF_DATES)


@register(
    "profile_monthly",
    """SELECT CAST(year(ts) AS INTEGER) AS yr, CAST(month(ts) AS INTEGER) AS mth, count(*) AS rows
    FROM events WHERE ts IS NOT NULL GROUP BY 1, 2""",
)
def q_monthly(spark, d):
    return P.monthly_volume(t(spark, d, "events"), "ts")


@register(
    "profile_lengths",
    """SELECT CAST(min(length(text)) AS INTEGER) AS min_len, CAST(max(length(text)) AS INTEGER) AS max_len,
        round(avg(length(text)), 4) AS avg_len FROM documents WHERE text IS NOT NULL""",
)
def q_lengths(spark, d):
    return P.length_profile(t(spark, d, "documents"), "text")


@register(
    "profile_whitespace",
    "SELECT count(*) AS rows_with_stray_whitespace FROM documents WHERE text <> trim(text)",
)
def q_whitespace(spark, d):
    return P.whitespace(t(spark, d, "documents"), "text")


@register(
    "profile_casing",
    "SELECT count(DISTINCT p_name) AS distinct_raw, count(DISTINCT upper(trim(p_name))) AS distinct_normalised FROM part",
)
def q_casing(spark, d):
    return P.casing(t(spark, d, "part"), "p_name")


@register(
    "profile_orphans",
    """SELECT count(*) AS orphan_rows FROM documents
    WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels WHERE labels.doc_id = documents.doc_id)""",
)
def q_orphans(spark, d):
    return P.orphans(t(spark, d, "documents"), t(spark, d, "labels"), "doc_id")


@register(
    "profile_contradictions",
    """WITH c AS (SELECT l_orderkey, max(l_shipdate) AS closure_date FROM lineitem GROUP BY 1),
    o AS (SELECT o.*, c.closure_date FROM orders o LEFT JOIN c ON c.l_orderkey = o.o_orderkey)
    SELECT 'OPEN_WITH_CLOSURE' AS rule, CAST(count_if(o_orderstatus = 'O' AND closure_date IS NOT NULL) AS BIGINT) AS violations FROM o
    UNION ALL SELECT 'END_BEFORE_START', CAST(count_if(closure_date < o_orderdate) AS BIGINT) FROM o""",
)
def q_contradictions(spark, d):
    c = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").alias("closure_date"))
    o = t(spark, d, "orders").join(c, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return P.contradictions(
        o,
        {
            "OPEN_WITH_CLOSURE": "o_orderstatus = 'O' AND closure_date IS NOT NULL",
            "END_BEFORE_START": "closure_date < o_orderdate",
        },
    )


@register(
    "profile_exclusive_flags",
    "SELECT 'QUALITY_AND_TOXIC' AS rule, CAST(count_if(quality = 1 AND toxic = 1) AS BIGINT) AS violations FROM labels",
)
def q_exclusive_flags(spark, d):
    return P.contradictions(t(spark, d, "labels"), {"QUALITY_AND_TOXIC": "quality = 1 AND toxic = 1"})


@register(
    "profile_reconcile_counts",
    """SELECT 'orders' AS source, count(*) AS rows FROM orders
    UNION ALL SELECT 'lineitem_orders', count(*) FROM (SELECT DISTINCT l_orderkey FROM lineitem)""",
)
def q_reconcile_counts(spark, d):
    lo = t(spark, d, "lineitem").select("l_orderkey").distinct()
    return P.reconcile_counts(t(spark, d, "orders"), lo, "orders", "lineitem_orders")


@register(
    "profile_reconcile_keys",
    """SELECT key, 'A_NOT_B' AS side FROM (SELECT o_orderkey AS key FROM orders EXCEPT SELECT l_orderkey FROM lineitem)
    UNION ALL SELECT key, 'B_NOT_A' FROM (SELECT l_orderkey AS key FROM lineitem EXCEPT SELECT o_orderkey FROM orders)""",
)
def q_reconcile_keys(spark, d):
    return P.reconcile_keys(t(spark, d, "orders"), t(spark, d, "lineitem"), "o_orderkey", "l_orderkey")


@register(
    "profile_dictionary",
    "SELECT o_orderpriority AS value, count(*) AS rows FROM orders GROUP BY o_orderpriority",
)
def q_dictionary(spark, d):
    return P.dictionary(t(spark, d, "orders"), "o_orderpriority")


# QV: findings of several checks against recorded expectations.
EXPECTATIONS = [
    ("orders.o_orderkey", "duplicate_rows", "=", 0),
    ("lineitem.l_orderkey+l_linenumber", "duplicate_keys", "=", 0),
    ("lineitem->orders", "orphan_rows", "=", 0),
    ("documents->labels", "orphan_rows", "=", 0),
    ("events->customer", "orphan_rows", "=", 0),
]


@register(
    "profile_verdicts",
    """WITH f AS (
        SELECT 'orders.o_orderkey' AS "check", 'duplicate_rows' AS metric, count(*) - count(DISTINCT o_orderkey) AS value FROM orders
        UNION ALL SELECT 'lineitem.l_orderkey+l_linenumber', 'duplicate_keys', count(*) FROM
            (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
        UNION ALL SELECT 'lineitem->orders', 'orphan_rows', count(*) FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
        UNION ALL SELECT 'documents->labels', 'orphan_rows', count(*) FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)),
    e AS (SELECT * FROM (VALUES ('orders.o_orderkey', 'duplicate_rows', '=', 0), ('lineitem.l_orderkey+l_linenumber', 'duplicate_keys', '=', 0),
            ('lineitem->orders', 'orphan_rows', '=', 0), ('documents->labels', 'orphan_rows', '=', 0), ('events->customer', 'orphan_rows', '=', 0))
          AS v("check", metric, op, expected))
    SELECT e."check", e.metric, e.op, CAST(e.expected AS BIGINT) AS expected, CAST(f.value AS BIGINT) AS value,
        CASE WHEN f.value IS NULL THEN 'ASSUMED' WHEN f.value = e.expected THEN 'CONFIRMED' ELSE 'VIOLATED' END AS verdict
    FROM e LEFT JOIN f ON f."check" = e."check" AND f.metric = e.metric""",
)
def q_verdicts(spark, d):
    orders = t(spark, d, "orders")
    li = t(spark, d, "lineitem")
    docs = t(spark, d, "documents")
    labels = t(spark, d, "labels")

    def finding(check, metric, df, col):
        return df.select(F.lit(check).alias("check"), F.lit(metric).alias("metric"), F.col(col).cast("bigint").alias("value"))

    f = finding("orders.o_orderkey", "duplicate_rows", P.key_uniqueness(orders, "o_orderkey"), "duplicate_rows")
    dup = P.duplicate_keys(li, "l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n"))
    f = f.unionByName(finding("lineitem.l_orderkey+l_linenumber", "duplicate_keys", dup, "n"))
    f = f.unionByName(finding("lineitem->orders", "orphan_rows", P.orphans(li, orders, "l_orderkey", "o_orderkey"), "orphan_rows"))
    f = f.unionByName(finding("documents->labels", "orphan_rows", P.orphans(docs, labels, "doc_id"), "orphan_rows"))
    exp = spark.createDataFrame(EXPECTATIONS, "check string, metric string, op string, expected bigint")
    return P.verdicts(f, exp)


# Q11.2 row by row: orders against a copy with some missing, some added and some changed.
@register(
    "profile_reconcile_rows",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 101 = 0 THEN 'A_NOT_B' WHEN o_orderkey % 97 = 0 THEN 'B_NOT_A' ELSE 'DIFFERENT' END AS side
    FROM orders WHERE o_orderkey % 101 = 0 OR o_orderkey % 97 = 0 OR o_orderkey % 89 = 0""",
)
def q_reconcile_rows(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    k = F.col("o_orderkey")
    a = o.filter((k % 97 != 0) | (k % 101 == 0))
    price = F.when((k % 89 == 0) & (k % 97 != 0), F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return reconcile_rows(a, o.filter(k % 101 != 0).withColumn("o_totalprice", price), ["o_orderkey"])


# Q3.2 from sketches: made per day as the events come, stored by day; the profile of a range of
# days reads the sketches only.  Exact counts, estimates within six relative deviations.
@register(
    "profile_sketched",
    """SELECT column_name, total_rows, populated, nulls, true AS within_bounds FROM (
        SELECT unnest(['event_id', 'user_id', 'event_type', 'value']) AS column_name, count(*) AS total_rows,
               unnest([count(event_id), count(user_id), count(event_type), count(value)]) AS populated,
               unnest([count(*) - count(event_id), count(*) - count(user_id), count(*) - count(event_type), count(*) - count(value)]) AS nulls
        FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-21')""",
)
def q_profile_sketched(spark, d):
    cols = ["event_id", "user_id", "event_type", "value"]
    events = t(spark, d, "events").select(F.col("ts").cast("date").alias("DAY"), *cols)
    path = scratch_path(spark, "event_sketches")
    append(sketch_columns(events, "DAY", cols), path, ["DAY"])
    days = F.col("DAY").between(F.lit("2024-01-05").cast("date"), F.lit("2024-01-20").cast("date"))
    found = profile_sketches(spark.read.parquet(path).filter(days))
    exact = P.profile_columns(events.filter(days).select(*cols)).select("column_name", F.col("distinct_vals").alias("_exact"))
    near = F.abs(F.col("distinct_vals") - F.col("_exact")) <= 6 * 1.04 / 64 * F.col("_exact") + 1
    return found.join(exact, "column_name").select("column_name", "total_rows", "populated", "nulls", near.alias("within_bounds"))


# G10 by blocks: a quarter of the files of a table, totals with their error; the true totals lie within five of it.
@register("sample_blocks", "SELECT unnest(['ROWS', 'QUANTITY']) AS MEASURE, true AS WITHIN_BOUNDS, true AS FEWER_FILES")
def q_sample_blocks(spark, d):
    path = scratch_path(spark, "lineitem_blocks")
    append(t(spark, d, "lineitem").select("l_orderkey", "l_quantity").repartition(40, "l_orderkey"), path)
    drawn, chosen, blocks = block_sample(spark, path, 25.0, seed=7)
    found = block_estimates(drawn, chosen, blocks, {"ROWS": F.lit(1), "QUANTITY": F.col("l_quantity")})
    true = t(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("ROWS"), F.sum("l_quantity").alias("QUANTITY"))
    true = true.select(F.inline(F.array(*[F.struct(F.lit(n).alias("MEASURE"), F.col(n).cast("double").alias("_true")) for n in ("ROWS", "QUANTITY")])))
    near = F.abs(F.col("ESTIMATE") - F.col("_true")) <= 5 * F.col("STD_ERROR")
    return found.join(true, "MEASURE").select("MEASURE", near.alias("WITHIN_BOUNDS"), F.lit(chosen < blocks).alias("FEWER_FILES"))

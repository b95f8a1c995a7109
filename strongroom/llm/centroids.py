"""Centroid clustering of integer vectors by an incremental distance matrix.

Every vector keeps its exact integer dot products with all centroids.  When
the centroids move, a vector's products are not computed anew: only the
components of a centroid that changed are multiplied, by how much they
changed, and added.  A squared distance differs between centroids only by
``|c|^2 - 2 x.c``, so the nearest centroid is an argmin over the kept products.

The state (vector, products, cluster) is one table per round in the shared
scratch folder; a round reads the one before and that one is then removed.
Only centroids and the clusters' component sums, both bounded by clusters
times components, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strongroom.llm.common import discard, stored_at
from strongroom.llm.vectors import int_matrix, is_finite, quantised

Centroids = list[list[int]]


def moved(old: Centroids | None, new: Centroids) -> list[tuple[list[int], list[int]]]:
    """Per centroid the components that changed and by how much; before the first round all are zero."""
    out = []
    for j, c in enumerate(new):
        steps = [v - (old[j][i] if old else 0) for i, v in enumerate(c)]
        at = [i for i, s in enumerate(steps) if s]
        out.append((at, [steps[i] for i in at]))
    return out


def assign(state: DataFrame, old: Centroids | None, new: Centroids) -> DataFrame:
    """The state after the centroids went from ``old`` to ``new``: products
    brought up to date by the changed components, nearest centroid (ties: the
    smaller number) and squared distance."""
    width, steps = len(new[0]), moved(old, new)
    keep = T.StructType([f for f in state.schema.fields if f.name not in ("dots", "cluster", "distance")])
    schema = T.StructType([*keep.fields, T.StructField("dots", T.ArrayType(T.LongType())), T.StructField("cluster", T.IntegerType()),
                           T.StructField("distance", T.LongType())])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        norms = np.array([sum(v * v for v in c) for c in new], np.int64)
        biggest = max((abs(v) for _, by in steps for v in by), default=0)
        for batch in batches:
            if not batch.num_rows:
                continue
            col = lambda name: batch.column(batch.schema.get_field_index(name))
            x = int_matrix(col("x"), width)
            dots = int_matrix(col("dots"), len(new)).copy() if old else np.zeros((len(x), len(new)), np.int64)
            # Products of doubles are exact below 2^53 and faster; else 64-bit integers.
            exact = float(np.abs(x).max(initial=0)) * biggest * width < 2.0**53
            y = x.astype(np.float64) if exact else x
            for j, (at, by) in enumerate(steps):
                if at:
                    dots[:, j] += (y[:, at] @ np.array(by, y.dtype)).astype(np.int64)
            score = norms - 2 * dots
            best = score.argmin(axis=1)  # the first of equal ones
            distance = (x * x).sum(axis=1) + score[np.arange(len(x)), best]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(new)), pa.array(dots.ravel()))
            made = [lists, pa.array(best.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays([*[col(f.name) for f in keep], *made], schema=arrow)

    return state.mapInArrow(run, schema)


def means(state: DataFrame, old: Centroids) -> Centroids:
    """Componentwise floor of the mean of each cluster's vectors; an empty cluster keeps its centroid.

    The sums are partial aggregates, so a cluster with most of the rows is no
    single task's work."""
    width = len(old[0])
    sums = state.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.get("x", F.lit(i))) for i in range(width)]).alias("s"))
    out = list(old)
    for r in sums.collect():  # at most as many rows as centroids
        out[r["cluster"]] = [s // r["n"] for s in r["s"]]
    return out


def seeds(vectors: DataFrame, id_col: str, k: int, seed: str) -> Centroids:
    """The ``k`` vectors whose ``<seed>:<id>`` has the smallest SHA-256, in that
    order (null ids last; equal ids by their vectors)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    first = vectors.select(key.alias("_h"), "x").orderBy(F.col("_h").asc_nulls_last(), "x").limit(k)
    return [r["x"] for r in first.collect()]


def digest(centroid: Sequence[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    seed: str = "2",
) -> DataFrame:
    """``rounds`` rounds of assignment and update, then a last assignment.

    One row per vector of exactly ``width`` components, none null or
    non-finite: the id, ``cluster``, ``distance`` (squared, of the integer
    vectors), ``cluster_inertia``, ``inertia``, ``centroid`` (final, as integers)
    and ``centroid_sha256``.  Other rows are not clustered and have none.

    Null ids take part and can only be seeds where fewer than ``k`` others
    are; repeated rows are rows of their own, and may be equal centroids, of
    which the smaller number gets the vectors.  Ties go to the smaller number.
    With fewer vectors than ``k`` each is a seed; an empty table gives an empty
    result.  A component beyond the range of exact arithmetic is an error.
    """
    limit = float(int((2.0**60 / max(width, 1)) ** 0.5))  # squared distances stay below 2^62
    fits = is_finite(F.col(vector_col)) & (F.size(vector_col) == width)
    vectors = df.where(fits).select(F.col(id_col).alias("_id"), quantised(F.col(vector_col), scale, limit).alias("x"))
    centroids = seeds(vectors, "_id", k, seed) if width else []
    if not centroids:
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid array<bigint>, centroid_sha256 string"
        return df.sparkSession.createDataFrame([], T.StructType([df.schema[id_col]] + T._parse_datatype_string(empty).fields))
    state, path = stored_at(assign(vectors, None, centroids), "clusters")
    for _ in range(rounds):
        new = means(state, centroids)
        (state, written), used = stored_at(assign(state, centroids, new), "clusters"), path
        discard(df.sparkSession, used)
        centroids, path = new, written
    # One row per cluster: bounded by k.
    per = {r["cluster"]: r["d"] for r in state.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}
    at = lambda values: F.get(F.array(*[F.lit(v) for v in values]), F.col("cluster"))
    return state.select(
        F.col("_id").alias(id_col), "cluster", "distance",
        at([per.get(j, 0) for j in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("long").alias("inertia"),
        at([",".join(map(str, c)) for c in centroids]).alias("_c"),
        at([digest(c) for c in centroids]).alias("centroid_sha256"),
    ).select(id_col, "cluster", "distance", "cluster_inertia", "inertia", F.split("_c", ",").cast("array<bigint>").alias("centroid"), "centroid_sha256")

"""Exact top-k search: impact-ordered score-at-a-time index.

Vectors are dealt to shards; a shard's index holds, for every dimension, its
rows ordered by their value, cut into posting segments of equal quantised
impact.  A query ranks all segments of a shard by their largest contribution
above the dimension's lowest, and adds them up in descending order of that
impact.  It stops only on proof: when the k-th best score so far, counted
with nothing but what was added, is beaten by no other row's score so far
plus the most that its remaining dimensions can bring.  The rows that could
still be members are scored exactly.  Shards' answers merge in one top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strongroom.llm.common import stored


def whole_vectors(df: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec, x): floor(scale * component) of every vector that takes part."""
    x = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.select(F.col(id_col).alias("vec"), F.when(~F.coalesce(bad, F.lit(True)), x).alias("x")).where("x is not null and vec is not null")
    return rows.select("vec", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("x"))


class Index:
    """Posting segments of one shard, by impact."""

    def __init__(self, x, level: int) -> None:
        import numpy as np

        self.x = x
        n, dims = x.shape
        rows, dim, first, last, low, high = [], [], [], [], [], []
        for d in range(dims):
            order = np.argsort(x[:, d], kind="stable")
            values = x[order, d]
            starts = np.flatnonzero(np.r_[True, np.diff(values // level) != 0])
            ends = np.r_[starts[1:], n]
            rows.append(order.astype(np.int32))
            dim.append(np.full(len(starts), d))
            first.append(starts + d * n)
            last.append(ends + d * n)
            low.append(values[starts])
            high.append(values[ends - 1])
        self.rows = np.concatenate(rows).astype(np.int64)
        dims_of = np.repeat(np.arange(dims), n)
        self.values = x[self.rows, dims_of].astype(np.float64)  # whole numbers, exact as doubles
        self.cells = dims_of * n + self.rows
        self.dim, self.first, self.last = np.concatenate(dim), np.concatenate(first), np.concatenate(last)
        self.low, self.high = np.concatenate(low), np.concatenate(high)
        self.segments = np.bincount(self.dim, minlength=dims)  # of each dimension, in order of value
        self.begin = np.cumsum(self.segments) - self.segments
        self.least, self.most = x.min(axis=0), x.max(axis=0)

    def search(self, q, k: int, known: float = float("-inf"), rounds: int = 4, enough: float = 0.5):
        """Rows that may be among the k best of query ``q`` and their exact scores.

        ``known`` is the k-th best score that other rows have.  A share
        ``enough`` of possible rows ends the rounds: scoring those exactly is
        cheaper than more postings.
        """
        import numpy as np

        n, dims = self.x.shape
        if n <= k:
            return np.arange(n), self.x @ q
        w = q[self.dim]
        floor = np.where(q >= 0, q * self.least, q * self.most)  # of a dimension's contributions
        impact = np.where(w >= 0, w * self.high, w * self.low) - floor[self.dim]
        order = np.argsort(-impact, kind="stable")
        dim, impact, size = self.dim[order], impact[order], (self.last - self.first)[order]
        done = np.cumsum(size)
        cuts = np.unique(np.searchsorted(done, done[-1] * np.arange(1, rounds + 1) / rounds) + 1)
        score, seen, at = np.zeros(n), np.zeros((dims, n), dtype=np.float32), 0
        taken = np.zeros(dims, dtype=np.int64)
        for cut in cuts:  # rounds of about equal postings, in descending impact
            # A dimension's impacts fall from one end of its values, so a round's segments of it lie side by side.
            more = np.bincount(dim[at:cut], minlength=dims)
            low = self.begin + np.where(q > 0, self.segments - taken - more, taken)
            taken += more
            runs = [(d, slice(self.first[low[d]], self.last[low[d] + more[d] - 1])) for d in np.flatnonzero(more)]
            weights = np.concatenate([self.values[run] * q[d] for d, run in runs])
            score += np.bincount(np.concatenate([self.rows[run] for _, run in runs]), weights=weights, minlength=n)
            seen.ravel()[np.concatenate([self.cells[run] for _, run in runs])] = 1
            at = cut
            left = np.zeros(dims)  # the most that a dimension can still bring: its next segment's, the last one written here
            left[dim[at:][::-1]] = impact[at:][::-1]
            lost = np.stack([floor, floor + left]).astype(np.float32) @ seen
            slack = 1 + 1e-5 * (np.abs(floor).sum() + left.sum())  # more than single precision can lose
            bar = max(np.partition(score - lost[0], n - k)[n - k] - slack, known - floor.sum())
            possible = np.flatnonzero(score + (left.sum() + slack) - lost[1] >= bar)
            if len(possible) <= max(4 * k, n * enough):
                break
        return possible, self.x[possible] @ q


def top_k(df: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 5, scale: int = 256,
          level: int = 16, shard_rows: int = 16_384, index_rows: int = 4096, query_rows: int = 256) -> DataFrame:
    """(query_id, rank, vector id, score): the k largest integer inner products of every query row with all other rows.

    Components are floor(``scale`` * x).  Vectors that are null or hold null or
    non-finite components, null ids, empty vectors, and vectors of another
    length than the query take no part.  Ties go to the smaller id; a query never finds rows of
    its own id; repeated rows are found as often as they occur; a repeated
    query row answers once.  Fewer than k other rows are all returned; an empty
    table gives none.  Queries and shards meet in blocks, each a bounded task.
    """
    rows = stored(whole_vectors(df, id_col, vector_col, scale), "vectors")
    asked = stored(whole_vectors(queries, id_col, vector_col, scale).dropDuplicates(["vec"]), "queries")
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // query_rows))
    h = F.xxhash64("vec", "x")
    data = rows.withColumn("shard", F.pmod(h, F.lit(shards)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asks = asked.withColumn("block", F.pmod(h, F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    vid = rows.schema["vec"].dataType
    schema = T.StructType([T.StructField("query_id", vid), T.StructField("vec", vid), T.StructField("score", T.LongType())])

    def run(key, found, wanted):
        import numpy as np
        import pandas as pd

        out = []
        if len(found) and len(wanted):
            found_length, wanted_length = found.x.map(len), wanted.x.map(len)
            for width in set(found_length) & set(wanted_length) - {0}:
                here, ask = found[found_length == width], wanted[wanted_length == width]
                data = np.array(here.x.tolist(), dtype=np.int64).reshape(len(here), width)
                indexes = [(start, Index(data[start : start + index_rows], level)) for start in range(0, len(data), index_rows)]
                ids = here.vec.to_numpy()
                for vec, x in zip(ask.vec, ask.x):
                    q, own = np.asarray(x, dtype=np.int64), int((ids == vec).sum())
                    rows, scores = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
                    for start, index in indexes:
                        known = np.partition(scores, len(scores) - k)[len(scores) - k] if len(scores) >= k else float("-inf")
                        at, score = index.search(q, k + own, known)
                        new = (ids[at + start] != vec) & (score >= known)
                        rows, scores = np.r_[rows, at[new] + start], np.r_[scores, score[new]]
                    best = np.lexsort((ids[rows], -scores))[:k]
                    out += zip([vec] * len(best), ids[rows][best], scores[best])
        return pd.DataFrame(out, columns=["query_id", "vec", "score"])

    pairs = data.groupBy("shard", "block").cogroup(asks.groupBy("shard", "block")).applyInPandas(run, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec")
    return pairs.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", F.col("vec").alias(id_col), "score")

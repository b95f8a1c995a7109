"""Quality classifier: a sparse ensemble of rules over text statistics.

Statistics of a text are Spark columns.  Shallow trees are grown on labelled
rows; every path from a root to a node is a rule, a conjunction of bounds on
statistics.  A lasso logistic regression over the rules keeps few of them, and
the kept ones are compiled to one Spark column expression, so scoring is a
projection of the scan.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strongroom.llm.common import stored, word_count

Bound = tuple[str, str, float]  # statistic, "<=" or ">", threshold


@dataclass(frozen=True)
class RuleModel:
    """Rules with their weights; ``score`` is the logistic of the sum."""

    intercept: float
    rules: tuple[tuple[tuple[Bound, ...], float], ...] = field(default=())

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for bounds, weight in self.rules:
            total = total + F.when(rule(bounds), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def rule(bounds: tuple[Bound, ...]) -> Column:
    out = F.lit(True)
    for name, sign, value in bounds:
        out = out & (F.col(name) <= value if sign == "<=" else F.col(name) > value)
    return out


def statistics(df: DataFrame, text_col: str, keep: list[Column]) -> tuple[DataFrame, list[str]]:
    """``keep`` and the statistics of the whole text; a null text counts as empty."""
    t, w, n = F.col("_t"), F.col("_w"), F.col("_n")
    base = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    base = base.withColumn("_w", F.split(F.trim(F.regexp_replace("_t", r"[\x20\x09-\x0D]+", " ")), " ")).withColumn("_n", word_count(t).cast("double"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    chars = F.length(t).cast("double")
    count = lambda p: F.regexp_count(t, F.lit(p)).cast("double")
    lines = F.split(t, "\n")
    stats = {
        "s_words": F.log1p(n),
        "s_word_length": ratio(chars, n),
        "s_upper": ratio(count(r"\p{Lu}"), chars),
        "s_symbols": ratio(count(r"[^\p{L}\p{N}\s.,;:!?'\"()-]"), n),
        "s_marks": ratio(count("[!?]"), n),
        "s_bars": ratio(count(r"\|"), n),
        "s_digits": ratio(count(r"\p{Nd}"), chars),
        "s_stops": ratio(count(r"\."), n),
        "s_commas": ratio(count(","), n),
        "s_distinct": ratio(F.size(F.array_distinct(w)).cast("double"), n),
        "s_line_words": ratio(n, F.size(lines).cast("double")),
        "s_distinct_lines": ratio(F.size(F.array_distinct(lines)).cast("double"), F.size(lines).cast("double")),
        "s_short": ratio(count(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]{1,3}(?![^\x20\x09-\x0D])"), n),
        "s_longest": F.log1p(F.coalesce(F.array_max(F.transform(w, F.length)), F.lit(0)).cast("double")),
    }
    held = [c for c in base.columns if c not in ("_t", "_w", "_n")]
    return base.select(*held, *[c.alias(name) for name, c in stats.items()]), list(stats)


def paths(debug: str, names: list[str]) -> set[tuple[Bound, ...]]:
    """Rules of one tree: the bounds on the way to each of its nodes, from the tree's printed form."""
    out: set[tuple[Bound, ...]] = set()
    here: list[Bound] = []
    for line in debug.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            depth = len(found[1])
            here = [b for b in here if b[3] < depth] + [(names[int(found[2])], found[3], float(found[4]), depth)]  # type: ignore[misc]
            out.add(tidy([b[:3] for b in here]))
    return out


def tidy(bounds: list[Bound]) -> tuple[Bound, ...]:
    """The tightest bound for each statistic and side, in order."""
    best: dict[tuple[str, str], float] = {}
    for name, sign, value in bounds:
        old = best.get((name, sign), value)
        best[name, sign] = min(old, value) if sign == "<=" else max(old, value)
    return tuple((name, sign, value) for (name, sign), value in sorted(best.items()))


def train(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          max_train_rows: int = 20_000, trees: int = 20, depth: int = 3, penalty: float = 0.002, seed: int = 11) -> RuleModel:
    """Learn rules and weights from labelled rows.

    Labels are 0 or 1; a document labelled more than once counts with its
    smallest label; null labels and ids are left out.  At most
    ``max_train_rows`` labelled ids, those of smallest hash, are used (and so
    their table may be broadcast).  Without labels the score is 0.5, with one
    class alone it is that class's smoothed share.
    """
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).cast("double").alias("_label"))
    known = known.where(F.col("_label").isin(0.0, 1.0))
    share = min(1.0, 2.0 * max_train_rows / max(1, known.count()))
    known = known.withColumn("_h", F.xxhash64("_id")).where(F.pmod("_h", F.lit(1 << 20)) < int(share * (1 << 20)))
    known = stored(known.orderBy("_h", "_id").limit(max_train_rows).select("_id", "_label"), "labels")
    docs = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    stats, names = statistics(docs, "_text", [F.col("_id"), F.col("_label")])
    rows = stored(stats, "statistics").coalesce(4)
    found = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(found.values())
    if len(found) < 2:
        rate = (found.get(1.0, 0) + 0.5) / (total + 1)
        return RuleModel(math.log(rate / (1 - rate)))
    vectors = VectorAssembler(inputCols=names, outputCol="features").transform(rows.orderBy("_id", *names)).select("_label", "features", *names)
    forest = RandomForestClassifier(labelCol="_label", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird", minInstancesPerNode=5).fit(vectors)
    rules = sorted(set().union(*[paths(t.toDebugString, names) for t in forest.trees]))
    if not rules:
        return RuleModel(math.log(found[1.0] / found[0.0]))
    flags = VectorAssembler(inputCols=[f"_r{k}" for k in range(len(rules))], outputCol="fired").transform(
        vectors.select("_label", *[rule(r).cast("double").alias(f"_r{k}") for k, r in enumerate(rules)])).select("_label", "fired")
    fit = LogisticRegression(featuresCol="fired", labelCol="_label", elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(flags)
    kept = [(r, float(w)) for r, w in zip(rules, fit.coefficients.toArray()) if abs(w) > 1e-6]
    return RuleModel(float(fit.intercept), tuple(kept))


def score(df: DataFrame, model: RuleModel, id_col: str = "doc_id", text_col: str = "text", out: str = "score") -> DataFrame:
    """The id column and the score of every row, 0 to 1, higher for good texts.

    Null texts score as empty ones; repeated rows give repeated results and an
    empty table none; null ids are carried along.
    """
    stats, _ = statistics(df.select(F.col(id_col), F.col(text_col).alias("_text")), "_text", [F.col(id_col)])
    return stats.select(id_col, model.score().alias(out))

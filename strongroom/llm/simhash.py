"""SimHash near-dedup: segment popcounts as a lower bound of the bit distance.

A 64-bit fingerprint is cut into segments; the vector of the segments' bit
counts is its place in a small integer space.  If two fingerprints differ in
at most r bits, their places differ by at most r under Manhattan distance.
The grid of that space is range-joined: each side covers the cells around its
place (half of r each), so every pair within r meets in some cell.  Pairs that
meet are verified by their bit distance.

A cell with more than ``cell_rows`` fingerprints is not paired off.  Its
members cover, half of r each, the fingerprints around them instead.  Those
that share a covered fingerprint are within r by the triangle inequality, and
any two within r share one, so a star of links to the smallest of them is
exact as to who is connected, and linear in the members.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strongroom.llm.common import stored
from strongroom.llm.components import components


def fingerprint(text: str | None, shingle: int, seed: int = 42, part: int = 1 << 16) -> int:
    """SimHash of the whole text; bit i is set if over half of the shingles' hashes have it."""
    import numpy as np
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # of bytes: ASCII letters and white space alone
    if not words:
        return 0
    width = min(shingle, len(words))
    n, ones = len(words) - width + 1, np.zeros(64, dtype=np.int64)
    for k in range(0, n, part):
        here = words[k : k + part + width - 1]
        rows = [xxh64_intdigest(b" ".join(s), seed) for s in zip(*[here[i:] for i in range(width)])]
        ones += np.unpackbits(np.array(rows, dtype=">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int("".join("1" if 2 * c > n else "0" for c in ones), 2)


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """The id column and ``fp``, the fingerprint as a signed long."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("fp", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out.view(np.int64))], names=schema.names)

    return df.select(F.col(id_col), F.col(text_col).alias("_text")).mapInArrow(run, schema)


def place(fp: Column, segments: int) -> list[Column]:
    """Bit counts of the segments."""
    bits = 64 // segments
    return [F.bit_count(F.shiftrightunsigned(fp, i * bits).bitwiseAND(F.lit((1 << bits) - 1))).cast("long") for i in range(segments)]


def around(radius: int, segments: int) -> list[tuple[tuple[int, int], ...]]:
    """Steps (segment, change) to all places within the radius under Manhattan distance."""
    steps: list[dict[int, int]] = [{}]
    for _ in range(radius):
        steps += [s | {i: s.get(i, 0) + d} for s in steps for i in range(segments) for d in (-1, 1)]
    found = {tuple(sorted((i, d) for i, d in s.items() if d)) for s in steps}
    return sorted(found, key=lambda s: (len(s), s))


def cells(fp: Column, radius: int, segments: int) -> Column:
    """Array of the cells that a fingerprint covers, each cell a hash of its coordinates."""
    counts = place(fp, segments)
    # A cell's number is a weighted sum of its coordinates: equal cells have equal numbers, and two
    # cells that happen to share one only meet for nothing, as pairs are verified.
    weights = [pow(0x9E3779B97F4A7C15, 2 * i + 1, 1 << 55) for i in range(segments)]
    base = sum((c * F.lit(w) for c, w in zip(counts[1:], weights[1:])), counts[0] * F.lit(weights[0]))
    return F.transform(F.array(*[F.lit(sum(weights[i] * d for i, d in s)) for s in around(radius, segments)]), lambda d: base + d)


def flips(fp: Column, radius: int) -> Column:
    """Array of all fingerprints within ``radius`` bits."""
    masks = [sum(1 << b for b in c) for k in range(radius + 1) for c in combinations(range(64), k)]
    return F.transform(F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks]), lambda m: fp.bitwiseXOR(m))


def links(fps: DataFrame, max_bits: int, segments: int, cell_rows: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that connect all pairs within ``max_bits`` bits."""
    left, right = (max_bits + 1) // 2, max_bits // 2
    spread = lambda r, name: fps.select(F.col("fp").alias(name), F.explode(cells(F.col("fp"), r, segments)).alias("cell"))
    full = stored(spread(left, "a").groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > cell_rows).select("cell"), "cells")
    if full.isEmpty():
        crowd = None
        a, b = spread(left, "a"), spread(right, "b")
    else:
        a, b = (spread(r, c).join(full, "cell", "left_anti") for r, c in ((left, "a"), (right, "b")))
        crowd = spread(left, "a").join(full, "cell", "left_semi").select(F.col("a").alias("fp")).distinct()
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    once = F.col("a") < F.col("b") if left == right else F.col("a") != F.col("b")
    # Exploded rows are many more than Spark's estimate, so none of them may be broadcast.
    pairs = a.hint("merge").join(b.hint("merge"), "cell").where(once & near)
    out = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    if crowd is not None:
        cover = lambda r: crowd.select("fp", F.explode(flips(F.col("fp"), r)).alias("key"))
        if left == right:
            both = cover(left)
            star = stored(both.groupBy("key").agg(F.min("fp").alias("a")), "stars")
            out = out.unionByName(both.hint("merge").join(star, "key").where("fp <> a").select("a", F.col("fp").alias("b")).distinct())
        else:  # an odd limit: the shared fingerprint is within the smaller half of one of the two
            star = stored(cover(right).groupBy("key").agg(F.min("fp").alias("a")), "stars")
            out = out.unionByName(cover(left).hint("merge").join(star, "key").where("fp <> a").select("a", F.col("fp").alias("b")).distinct())
    return out


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, max_bits: int = 2,
                    segments: int = 16, cell_rows: int = 64) -> DataFrame:
    """The id column, ``fingerprint`` (hex) and ``component_id`` of every row.

    Words are runs without ASCII white space after A-Z become lower case;
    shingles count as often as they occur; a text of fewer words is one
    shingle; null texts and texts without words have fingerprint zero, linked
    like any other.  Rows of equal fingerprint are one node, so copies are
    never paired.  The component's number is its smallest id that is not null.
    Repeated rows give repeated results; an empty table gives none.
    """
    if 64 % segments:
        raise ValueError("segments must divide 64")
    rows = stored(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min(id_col).alias("least")), "nodes")
    found = components(links(nodes.select("fp"), max_bits, segments, cell_rows), "a", "b")
    member = stored(nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("group")), "members")
    group = stored(member.groupBy("group").agg(F.min("least").alias("component_id")), "groups")
    named = stored(member.join(group, "group").select("fp", "component_id"), "named")
    return rows.join(named, "fp").select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

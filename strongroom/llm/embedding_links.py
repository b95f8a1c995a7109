"""Embedding near-dedup: sorted projection passes.

A pass hashes every vector by the signs of random projections, concatenates
the bits, and orders the vectors of a label lexicographically by them (a range
partitioning, sorted).  Each vector is compared with a bounded window of the
vectors before it; the first vectors of a partition also with the last ones of
the partition before.  Pairs are verified by their cosine in double precision,
and the verified pairs of all passes are united into components.  A window
hands on a spanning forest of its pairs, not the pairs.

Windows may miss pairs, so all vectors of a label are then compared exactly,
block against block.  That counts the links of each vector and unites the
components that the windows left apart.  It costs the square of a label's
size, whatever the windows found.  Equal vectors of a label are one node with
a count, so copies never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strongroom.llm.common import stored
from strongroom.llm.components import components


def usable(vector: str, label: str):
    """Label not null; vector not null, not zero, without null or non-finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(label).isNotNull() & F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def matrix(column, width: int):
    """Rows of a column of lists as a matrix of doubles; -0.0 as 0.0."""
    import numpy as np

    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, width) + 0.0


def cosines(a, b):
    """Cosines in double precision of all rows with all rows."""
    import numpy as np

    # By powers of two, which round nothing, so that squares neither overflow nor vanish.
    big = lambda x: np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    a, b = big(a), big(b)
    return (a @ b.T) / np.sqrt((a * a).sum(axis=1))[:, None] / np.sqrt((b * b).sum(axis=1))[None, :]


def forest(n: int, rows, cols) -> list[tuple[int, int]]:
    """A spanning forest of the pairs, each tree a star around its smallest member."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(rows.tolist(), cols.tolist()):
        a, b = root(x), root(y)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return [(x, root(x)) for x in {*rows.tolist(), *cols.tolist()} if root(x) != x]


def pass_keys(vectors: DataFrame, width: int, passes: int, bits: int, seed: int) -> DataFrame:
    """``pass``, ``key`` (concatenated sign bits) and the vector's columns, for each pass."""
    schema = T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("key", T.LongType()), *vectors.schema.fields])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa

        planes = np.random.default_rng(seed).standard_normal((width, passes * bits))
        weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            signs = (matrix(batch.column(batch.schema.get_field_index("v")), width) @ planes > 0).reshape(-1, passes, bits)
            keys = signs.astype(np.int64) @ weights
            for p in range(passes):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, p, np.int32)), pa.array(np.ascontiguousarray(keys[:, p])), *batch.columns], names=schema.names)

    return vectors.mapInArrow(run, schema)


def window_links(sorted_rows: DataFrame, width: int, threshold: float, window: int, chunk: int = 256) -> DataFrame:
    """Rows in order to links (a, b) and, as border rows, the first and last ``window`` of each partition.

    ``border`` is null for a link; else it numbers the border, and ``late``
    tells the partition's first rows from the last rows of the one before.
    """
    vid = sorted_rows.schema["node"].dataType
    label = sorted_rows.schema["label"].dataType
    schema = T.StructType([T.StructField("a", vid), T.StructField("b", vid), T.StructField("border", T.IntegerType()), T.StructField("late", T.BooleanType()),
                           T.StructField("label", label), T.StructField("pass", T.IntegerType()), T.StructField("v", sorted_rows.schema["v"].dataType)])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        here, arrow = TaskContext.get().partitionId(), to_arrow_schema(schema)
        before = None  # the last ``window`` rows
        first = 0

        def out(n, **columns):
            return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in arrow], schema=arrow)

        def border(rows, number, late):
            n = rows.num_rows
            return out(n, a=rows["node"].combine_chunks(), border=pa.array([number] * n, pa.int32()), late=pa.array([late] * n), label=rows["label"].combine_chunks(),
                       v=rows["v"].combine_chunks(), **{"pass": rows["pass"].combine_chunks()})

        for batch in batches:
            for k in range(0, batch.num_rows, chunk):
                rows = pa.Table.from_batches([batch.slice(k, chunk)])
                if first < window:
                    yield border(rows.slice(0, window - first), here, True)
                    first += rows.num_rows
                both = rows if before is None else pa.concat_tables([before, rows])
                skip = both.num_rows - rows.num_rows
                m = matrix(both["v"].combine_chunks(), width)
                group = np.array(list(zip(both["pass"].to_pylist(), both["label"].to_pylist())), dtype=object)
                codes = np.unique([f"{p}\0{g}" for p, g in group], return_inverse=True)[1]
                near = (cosines(m[skip:], m) >= threshold) & (codes[skip:, None] == codes[None, :])
                i, j = np.nonzero(near)
                keep = (j < i + skip) & (i + skip - j <= window)
                star = forest(len(m), i[keep] + skip, j[keep])
                if star:
                    node = both["node"].combine_chunks()
                    yield out(len(star), a=node.take(pa.array([x for x, _ in star])), b=node.take(pa.array([y for _, y in star])))
                before = both.slice(max(0, both.num_rows - window))
        if before is not None:
            yield border(before, here + 1, False)

    return sorted_rows.mapInArrow(run, schema)


def border_links(rows: DataFrame, width: int, threshold: float) -> DataFrame:
    """Links between the first rows of a partition and the last of the one before."""
    vid = rows.schema["a"].dataType

    def run(pdf):
        import numpy as np
        import pandas as pd

        out = []
        for _, part in pdf.groupby(["pass", "label"]):
            old, new = part[~part.late], part[part.late]
            if len(old) and len(new):
                i, j = np.nonzero(cosines(np.array(new.v.tolist(), dtype=float) + 0.0, np.array(old.v.tolist(), dtype=float) + 0.0) >= threshold)
                nodes = [*new.a, *old.a]
                out += [(nodes[x], nodes[y]) for x, y in forest(len(nodes), i, j + len(new))]
        return pd.DataFrame(out, columns=["a", "b"])

    return rows.groupBy("border").applyInPandas(run, T.StructType([T.StructField("a", vid), T.StructField("b", vid)]))


def near_rows(a, b, threshold: float, chunk: int = 256):
    """(first row, matrix) for chunks of rows of ``a``: whose cosine with which rows of ``b`` is at least the threshold.

    Single precision decides but near the threshold, by more than its error
    bound; there the cosine is computed in double precision.
    """
    import numpy as np

    big = lambda x: np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    a, b = big(a), big(b)
    na, nb = np.sqrt((a * a).sum(axis=1)), np.sqrt((b * b).sum(axis=1))
    fa, fb = (a / na[:, None]).astype(np.float32), (b / nb[:, None]).astype(np.float32).T
    slack = (a.shape[1] + 4) * 1.2e-7
    for k in range(0, len(a), chunk):
        rough = fa[k : k + chunk] @ fb
        near = rough >= threshold + slack
        i, j = np.nonzero((rough >= threshold - slack) & ~near)
        for c in range(0, len(i), 1 << 15):
            x, y = i[c : c + (1 << 15)], j[c : c + (1 << 15)]
            near[x, y] = (a[k + x] * b[y]).sum(axis=1) / na[k + x] / nb[y] >= threshold
        yield k, near


def every_link(nodes: DataFrame, width: int, threshold: float, block: int) -> DataFrame:
    """All pairs of a label, block against block: rows (node, other, n).

    With ``other`` null: with how many other vectors of the pair of blocks the
    node links, its own copies aside.  Else a link between components that the
    windows left apart, both by name.

    A label is cut into blocks of about ``block`` nodes, from 24 blocks on of
    up to eight times as many, as a node is sent once for each block; each
    pair of blocks is one small group of rows, so a large label is spread out.
    """
    sizes = stored(nodes.groupBy("label").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "sizes")
    few, many = F.ceil(F.col("size") / block), F.ceil(F.col("size") / (8 * block))
    rows = nodes.join(sizes, "label").withColumn("blocks", F.greatest(F.least(few, F.lit(24)), many).cast("int"))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = rows.select("label", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "copies", "v")
    # By range, so that the many small groups of a large label are dealt out evenly.
    n = max(1, int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = pairs.repartitionByRange(n, "label", "i", "j").sortWithinPartitions("label", "i", "j")
    name = nodes.schema["node"].dataType
    schema = T.StructType([T.StructField("node", name), T.StructField("other", name), T.StructField("n", T.LongType())])

    def run(batches: Iterator):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def compared(table):
            own, first, second = (table[c].to_numpy() for c in ("own", "i", "j"))
            m, copies = matrix(table["v"].combine_chunks(), width), table["copies"].to_numpy()
            names = table["component"].combine_chunks().dictionary_encode()
            comp, total = names.indices.to_numpy().astype(np.int64), len(names.dictionary)
            left = np.flatnonzero(own == first)
            right = left if first[0] == second[0] else np.flatnonzero(own == second)
            counts, links = np.zeros(len(m), np.int64), []
            for k, near in near_rows(m[left], m[right], threshold):
                rows = left[k : k + len(near)]
                if right is left:
                    near[np.arange(len(near)), np.arange(k, k + len(near))] = False
                else:
                    counts[right] += copies[rows] @ near
                counts[rows] += near @ copies[right]
                x, y = np.nonzero(near & (comp[rows][:, None] != comp[right][None, :]))
                apart = np.unique(comp[rows][x] * total + comp[right][y])
                links += forest(total, apart // total, apart % total)
            yield pa.RecordBatch.from_arrays([table["node"].combine_chunks(), pa.nulls(len(m), pa.string()), pa.array(counts)], names=schema.names)
            if links:
                links = sorted(set(links))
                ends = [names.dictionary.take(pa.array([link[e] for link in links])) for e in (0, 1)]
                yield pa.RecordBatch.from_arrays([*ends, pa.nulls(len(links), pa.int64())], names=schema.names)

        def starts(table):
            """Where groups start, but the first."""
            new = np.zeros(table.num_rows - 1, bool)
            for c in ("label", "i", "j"):
                column = table[c].combine_chunks()
                new |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
            return (np.flatnonzero(new) + 1).tolist()

        held = None
        for batch in batches:
            if batch.num_rows:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
                cuts = [0, *starts(held)]  # all but the last group is whole
                for x, y in zip(cuts, cuts[1:]):
                    yield from compared(held.slice(x, y - x))
                held = held.slice(cuts[-1])
        if held is not None:
            yield from compared(held)

    return pairs.mapInArrow(run, schema)


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", threshold: float = 0.98,
                    passes: int = 12, bits: int = 48, window: int = 128, seed: int = 5, block: int = 1024) -> DataFrame:
    """Per vector: the id column, ``n_links``, ``component_id`` and ``kept``.

    Vectors link if their labels are equal and their cosine is at least
    ``threshold``.  Null, zero or non-finite vectors, vectors with null
    components and null labels link with nothing: their component is their own
    id.  Vectors of different lengths don't link.  A repeated row is a vector
    of its own that links with its copies.  Rows with a null id count as
    links, never name a component, and are not kept.  An empty table gives
    none.
    """
    rows = stored(df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.when(usable(vector_col, label_col), F.transform(F.col(vector_col).cast("array<double>"), lambda x: x + F.lit(0.0))).alias("v")), "vectors")
    same = rows.where("v is not null").groupBy("label", F.size("v").alias("w"), "v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("least"))
    node = F.xxhash64("label", "w", "v")
    # Nodes are named by two hashes of label and vector; equal names of unequal vectors are as good as impossible.
    nodes = stored(same.withColumn("node", F.concat(F.lpad(F.hex(node), 16, "0"), F.lpad(F.hex(F.xxhash64(F.lit("again"), "v", "label")), 16, "0"))), "nodes")
    found = []
    for (width,) in nodes.select("w").distinct().collect():  # lengths of vectors: a few
        some = nodes.where(F.col("w") == width)
        n = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        keyed = pass_keys(some.select("node", "label", "v"), width, passes, bits, seed)
        in_order = keyed.repartitionByRange(n, "pass", "label", "key", "node").sortWithinPartitions("pass", "label", "key", "node")
        both = stored(window_links(in_order, width, threshold, window), "windows")
        pairs = both.where("border is null").select("a", "b").unionByName(border_links(both.where("border is not null"), width, threshold))
        groups = stored(components(pairs, "a", "b"), "groups")
        some = some.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        members = stored(some.select("node", "label", "component", "copies", "least", "v"), "members")
        exact = stored(every_link(members.select("node", "label", "component", "copies", "v"), width, threshold, block), "links")
        # What the windows left apart: components whose vectors link.
        united = stored(components(exact.where("other is not null"), "node", "other"), "united")
        members = members.join(united.select(F.col("node").alias("component"), F.col("component").alias("whole")), "component", "left")
        members = members.select("node", F.coalesce("whole", "component").alias("component"), "least")
        least = stored(members.groupBy("component").agg(F.min("least").alias("component_id")), "least")
        links = exact.where("other is null").groupBy("node").agg(F.sum("n").alias("n"))
        named = members.select("node", "component").join(least, "component").join(links, "node", "left")
        found.append(named.select("node", "component_id", F.coalesce("n", F.lit(0)).alias("n")))
    linked = nodes
    if found:
        every = found[0]
        for other in found[1:]:
            every = every.unionByName(other)
        linked = linked.join(stored(every, "found"), "node", "left")
    else:
        linked = linked.withColumns({"component_id": F.col("least"), "n": F.lit(0)})
    linked = stored(linked.select(F.col("label").alias("_l"), F.col("v").alias("_v"), F.xxhash64("v").alias("_h"), F.coalesce("component_id", "least").alias("c"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n")), "linked")
    joined = rows.withColumn("h", F.xxhash64("v")).join(linked, (F.col("label") == F.col("_l")) & (F.col("h") == F.col("_h")) & (F.col("v") == F.col("_v")), "left")
    comp = F.coalesce("c", "id")
    return joined.select(F.col("id").alias(id_col), F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), comp.alias("component_id"), F.coalesce(F.col("id") == comp, F.lit(False)).alias("kept"))

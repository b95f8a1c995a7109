"""Link loads (L1-L8): insert key combinations never seen before.

The link key is the hash of all business keys in a fixed order; each hub
key is hashed with the same recipe as the hub load, so link and hub keys
join without lookups.  Hierarchical (L2), same-as (L3) and transaction
(L7) links are ordinary specs; the functions below add the variants that
behave differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strongroom.functions.hashing import _join, digest, hash_key, key_is_valid, normalise_key, pack, unpack
from strongroom.operators.common import first_per_key, packed, place, text_columns, unpacked
from strongroom.operators.specs import LOAD_DTS, PLACE, REC_SRC, LinkSpec
from strongroom.sources.io import cut_lineage


def link_candidates(stg: DataFrame | Sequence[DataFrame], spec: LinkSpec) -> DataFrame:
    feeds = [stg] if isinstance(stg, DataFrame) else list(stg)
    parts = []
    for f in feeds:
        cols = [hash_key(*spec.key_parts(), algo=spec.algo).alias(spec.hk)]
        for hk_col, bks in spec.refs:
            cols.append(hash_key(*bks, algo=spec.algo).alias(hk_col))
        cols += [F.col(LOAD_DTS), F.col(REC_SRC)]
        cols += [F.col(p) for p in spec.payload]
        cols.append(key_is_valid(*spec.key_parts()).alias("_valid"))
        parts.append(f.select(*cols))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def load_link(
    stg: DataFrame | Sequence[DataFrame], link: DataFrame | None, spec: LinkSpec, placed: bool = False, hashed: bool = True
) -> DataFrame:
    """Rows to append: one per new link key, first seen and first source.

    Grouped on the text that the link key digests (as the hub load), so there
    is one row per link key even where a part holds the delimiter, and the
    shuffle carries short keys instead of one 64-character hash per hub;
    the link key and the hub keys are hashed once per surviving row.

    Feeds that all hold the link key and the hub keys already (stage L2,
    ``stage_hashed``) are grouped on the link key and nothing is hashed.

    ``placed``: the feeds are placed by the first part of this key.  They are
    reduced where they lie, and the result is placed as well.  ``hashed=False`` gives the
    texts that the keys digest in their columns, for plans that hash last.
    """
    parts, at = spec.key_parts(), [PLACE] if placed else []
    if link is not None and not hashed:
        raise ValueError("stored links hold hashes")
    hashes = [spec.hk, *[hk for hk, _ in spec.refs]]
    staged = [stg] if isinstance(stg, DataFrame) else list(stg)
    if hashed and all(c in f.columns for f in staged for c in hashes):
        cand = None
        for f in staged:
            c = f.filter(key_is_valid(*parts)).select(*at, *hashes, LOAD_DTS, REC_SRC, *spec.payload)
            cand = c if cand is None else cand.unionByName(c)
        new = first_per_key(packed(cand, held := text_columns(cand, hashes)), [*at, spec.hk], [LOAD_DTS, REC_SRC, *hashes[1:]])
        if link is not None:
            on = [*(place(link) if placed else []), spec.hk]
            new = new.join(packed(link.select(*on), [spec.hk]), on, "left_anti")
        return unpacked(new, held).select(*hashes, LOAD_DTS, REC_SRC, *spec.payload, *at)
    # Of the hub keys' texts only the lengths go with the key text: of one key text, texts and lengths sort alike.
    ends = [f"_n{i}" for i in range(len(spec.refs) - 1)]
    cand = None
    for f in staged:
        texts = _ref_texts(spec)
        c = f.filter(key_is_valid(*parts)).select(
            *at,
            _join(texts).alias("_key"),
            *[F.length(t).alias(n) for t, n in zip(texts, ends)],
            F.col(LOAD_DTS),
            F.col(REC_SRC),
            *[F.col(p) for p in spec.payload],
        )
        cand = c if cand is None else cand.unionByName(c)
    new = first_per_key(cand, [*at, "_key"], [LOAD_DTS, REC_SRC, *ends])
    if link is not None:
        # Hashed again below: the join carries the key text and one packed hash.
        new = new.withColumn("_hk", pack(digest(F.col("_key"), spec.algo)))
        on = place(link) if placed else []
        new = new.join(link.select(*on, pack(spec.hk).alias("_hk")), [*on, "_hk"], "left_anti")
    made = (lambda text: digest(text, spec.algo)) if hashed else (lambda text: text)
    cols, begin = [made(F.col("_key")).alias(spec.hk)], F.lit(1)
    for (hk_col, _), n in zip(spec.refs, [*ends, None]):
        text = F.substring(F.col("_key"), begin, F.col(n) if n else F.length("_key"))
        cols.append(made(text).alias(hk_col))
        begin = begin + F.col(n) + 1 if n else begin
    return new.select(*cols, F.col(LOAD_DTS), F.col(REC_SRC), *[F.col(p) for p in spec.payload], *at)


def _ref_texts(spec: LinkSpec) -> list[Column]:
    """The text that each hub key of the link digests; joined, they are the link key's."""
    return [_join([normalise_key(b) for b in bks]) for _, bks in spec.refs]


def link_rejects(stg: DataFrame | Sequence[DataFrame], spec: LinkSpec) -> DataFrame:
    """Staged rows with a key part that is NULL or blank."""
    out = None
    for f in [stg] if isinstance(stg, DataFrame) else stg:
        r = f.filter(~key_is_valid(*spec.key_parts()))
        out = r if out is None else out.unionByName(r)
    return out


def load_nh_link(stg: DataFrame, link: DataFrame | None, spec: LinkSpec) -> DataFrame:
    """Non-historised link (L5): immutable facts with payload.  The payload of
    the first delivery is kept; a re-delivery of a stored key adds nothing."""
    return load_link(stg, link, spec)


def load_link_literal(stg: DataFrame, link: DataFrame | None, spec: LinkSpec) -> DataFrame:
    """SELECT DISTINCT of (keys, LOAD_DTS, REC_SRC) WHERE NOT EXISTS; for the audits."""
    refs = [hk for hk, _ in spec.refs]
    texts = [t.alias(hk) for t, hk in zip(_ref_texts(spec), refs)]
    # Made distinct on the texts that the keys digest, and hashed after.
    cand = stg.select(*texts, LOAD_DTS, REC_SRC, *spec.payload).distinct()
    cand = cand.select(
        digest(_join([F.col(hk) for hk in refs]), spec.algo).alias(spec.hk), *[digest(F.col(hk), spec.algo).alias(hk) for hk in refs],
        LOAD_DTS, REC_SRC, *spec.payload)
    if link is not None:
        cand = cand.join(link.select(spec.hk), spec.hk, "left_anti")
    return cand


def same_as_masters(sal: DataFrame, synonym: str, master: str) -> DataFrame:
    """One row per synonym of a same-as link with its last master (L4):
    ``synonym``, ``master`` and whether the chain ends in a ``CYCLE``.

    A chain a -> b -> c gives c for both.  By pointer jumping: each round
    replaces a synonym's master by that one's master, so a chain of n links
    takes about log2(n) rounds of one join.  A synonym with several masters takes
    the first loaded one.  A chain that runs into a cycle has no last master; its
    synonyms all get the smallest key of the cycle.  Links of a key with
    itself say nothing and are left out.
    """
    one = first_per_key(sal.select(synonym, master, LOAD_DTS).filter(F.col(synonym).isNotNull() & F.col(master).isNotNull()),
                        [synonym], [LOAD_DTS, master]).filter(F.col(synonym) != F.col(master))
    texts = text_columns(one, [synonym, master])
    one = packed(one, texts if len(texts) == 2 else [])
    state = cut_lineage(one.select(F.col(synonym).alias("_s"), F.col(master).alias("_m"), F.col(master).alias("_least")))
    n, reach = state.count(), 1
    # Merged, never broadcast: a checkpoint's size is guessed from the compressed files it came from.
    step = lambda: state.alias("a").join(state.alias("b").hint("merge"), F.col("a._m") == F.col("b._s"), "left")
    # _m is ``reach`` links on, _least the smallest key on the way.
    while reach <= 2 * n and not step().filter(F.col("b._s").isNotNull()).isEmpty():
        state = cut_lineage(step().select("a._s", F.coalesce("b._m", "a._m").alias("_m"), F.least("a._least", "b._least").alias("_least")))
        reach *= 2
    # Whoever still points at a synonym points into a cycle, all of which that one has passed.
    cycle = F.col("b._s").isNotNull()
    out = step().select(F.col("a._s").alias(synonym), F.when(cycle, F.col("b._least")).otherwise(F.col("a._m")).alias(master), cycle.alias("CYCLE"))
    return unpacked(out, texts if len(texts) == 2 else [])


def resolve_same_as(df: DataFrame, sal: DataFrame, key: str, synonym: str, master: str) -> DataFrame:
    """Replace a synonym hash key by its last master key (L4, see
    ``same_as_masters``); unknown keys stay.  There is one master per synonym,
    so the join can never multiply rows."""
    m = same_as_masters(sal, synonym, master).select(F.col(synonym).alias("_syn"), F.col(master).alias("_master"))
    texts = [key] if text_columns(df, [key]) and len(text_columns(m, m.columns)) == 2 else []
    df, m = packed(df, texts), packed(m, ["_syn", "_master"] if texts else [])
    out = df.join(m.hint("merge"), F.col(key) == F.col("_syn"), "left")
    return unpacked(out.withColumn(key, F.coalesce(F.col("_master"), F.col(key))).drop("_syn", "_master"), texts)


def ancestors(link: DataFrame, child: str, parent: str) -> DataFrame:
    """Closure of a hierarchical link (L2): every (``child``, ``parent``) pair
    of a key and one above it, with the ``DEPTH`` of the shortest way.

    Found by doubling: the pairs at exactly the greatest depth known are joined
    with all pairs, so n levels take about log2(n) rounds.  Children may have
    several parents.  A key that is its own ancestor stands in a cycle
    (``hierarchy_cycles``); the closure ends all the same.
    """
    edges = link.select(F.col(child).alias("_c"), F.col(parent).alias("_a")).filter("_c IS NOT NULL AND _a IS NOT NULL").distinct()
    texts = text_columns(edges, ["_c", "_a"])
    texts = texts if len(texts) == 2 else []
    # Packed, and merged, never broadcast: a checkpoint's size is guessed from the compressed files it came from.
    pairs, depth = cut_lineage(packed(edges, texts).withColumn("_d", F.lit(1).cast("long"))), 1
    while True:
        near = pairs.select(F.col("_c").alias("_nc"), F.col("_a").alias("_na"), F.col("_d").alias("_nd"))
        more = pairs.filter(F.col("_d") == depth).join(near.hint("merge"), F.col("_a") == F.col("_nc"))
        more = more.groupBy("_c", "_na").agg(F.min(F.col("_d") + F.col("_nd")).alias("_nd"))
        known = pairs.select(F.col("_c").alias("_kc"), F.col("_a").alias("_ka"))
        more = more.join(known.hint("merge"), (F.col("_c") == F.col("_kc")) & (F.col("_na") == F.col("_ka")), "left_anti")
        more = more.select("_c", F.col("_na").alias("_a"), F.col("_nd").alias("_d"))
        more = cut_lineage(more)
        if more.isEmpty():
            break
        pairs, depth = cut_lineage(pairs.unionByName(more)), 2 * depth
    pairs = unpacked(pairs, texts)
    return pairs.select(F.col("_c").alias(child), F.col("_a").alias(parent), F.col("_d").alias("DEPTH"))


def hierarchy_cycles(closure: DataFrame, child: str, parent: str) -> DataFrame:
    """Keys that are above themselves, from the result of ``ancestors``."""
    return closure.filter(F.col(child) == F.col(parent))


def exploration_link(df: DataFrame, hk: str, keys: Sequence[str], algo: str = "sha256") -> DataFrame:
    """Disposable relation (L6): key combinations of any query result, first
    seen and first source kept, as in every link.  ``keys`` are hash-key
    columns; the link key hashes them in order."""
    keys = list(keys)
    return coarsen(df.filter(key_is_valid(*keys) & F.col(LOAD_DTS).isNotNull()), hk, keys, algo)


def coarsen(link: DataFrame, hk: str, keys: Sequence[str], algo: str = "sha256") -> DataFrame:
    """Relation at fewer hub keys from the finest link (L8): one row per
    combination of ``keys``, first seen and first source kept."""
    keys = list(keys)
    base = link.select(*keys, LOAD_DTS, REC_SRC)
    first = first_per_key(base, keys, [LOAD_DTS, REC_SRC])
    return first.select(hash_key(*keys, algo=algo).alias(hk), *keys, LOAD_DTS, REC_SRC)

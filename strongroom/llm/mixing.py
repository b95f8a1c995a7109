"""Mixing sources to target weights: token blocks drawn by pseudorandom index permutations.

Native: every step is a DataFrame or SQL function.  The words of a source, one
document after the other, are a stream that is packed into blocks of fixed
length.  A source's target is its weight's share of all words, at most
``most_times`` its own size.  The mix is a sequence of slots, dealt to output
shards; every shard's counts by source are a multinomial draw, made so that
the counts of all shards together come to the targets.  A source's slots take
its blocks through a pseudorandom permutation of the block numbers (a new one
for each pass over the source).  The slots are stored; what each document gives
is added up from them, joined by source and block.

Permutations are swap-or-not shuffles, rounds of x -> (key - x) mod n taken or
not by a bit that both ends share, so they need neither a sort nor a table
and work for any n.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strongroom.llm.common import running_offset, stored, word_count

PRIME = (1 << 31) - 1


def round_keys(seed: int, rounds: int) -> list[tuple[int, int, int]]:
    """Three numbers below 2^31 for each round."""
    out = []
    for k in range(rounds):
        digest = hashlib.sha256(f"{seed}:{k}".encode()).digest()
        a, b, c = (int.from_bytes(digest[i : i + 8], "big") % (PRIME - 1) + 1 for i in (0, 8, 16))
        out.append((a, b, c))
    return out


def permuted(x: Column, n: Column, salt: Column, seed: int, rounds: int, inverse: bool = False) -> Column:
    """The pseudorandom permutation of 0 .. n-1 that (salt, seed) choose, at x; n below 2^61.

    salt is a whole number from 0 to 2^20.  Every round is its own inverse, so
    the rounds in reverse order give the ``inverse``.
    """
    whole = lambda v: F.lit(v).cast("long")
    prime, salt, n = whole(PRIME), salt.cast("long"), n.cast("long")
    keys = F.array(*[F.struct(whole(a).alias("a"), whole(b).alias("b"), whole(c).alias("c")) for a, b, c in round_keys(seed, rounds)[:: -1 if inverse else 1]])

    def step(at: Column, k: Column) -> Column:
        turn = F.pmod(k["a"] * (salt + 1) + k["b"], prime) * prime + F.pmod(k["c"] * (salt + 1), prime)
        other = F.pmod(F.pmod(turn, n) + n - at, n)
        high = F.greatest(at, other)  # the same seen from either end
        mixed = F.pmod(F.pmod(high, prime) * k["a"] + F.shiftright(high, 31) + k["b"] + salt, prime)
        mixed = F.pmod(mixed * k["c"], prime)
        return F.when(F.shiftright(mixed, 10).bitwiseAND(F.lit(1)) == 1, other).otherwise(at)

    return F.aggregate(keys, x.cast("long"), step)


def targets(rows: DataFrame, weights: tuple[float, ...], most_times: int) -> DataFrame:
    """Per source: ``source_size``, its number and its ``target`` words.

    Sources in code point order, null last, take the weights in turn.  All
    words are shared out by weight; a target stops at ``most_times`` its
    source's size and the excess is shared again.  That makes every target the
    smaller of its cap and weight times one level, found by sorting sources by
    cap to weight.  One row for each source.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    sizes = sizes.withColumn("number", place.cast("long"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    sizes = sizes.withColumn("weight", weight).withColumn("cap", (F.col("source_size") * most_times).cast("double"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "number")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    sizes = sizes.withColumn("capped", F.coalesce(F.sum("cap").over(before), F.lit(0.0))).withColumn("rest", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
    sizes = sizes.withColumn("level", (F.sum("source_size").over(whole) - F.col("capped")) / F.col("rest"))
    # The level is right at the first source that it doesn't fill.
    level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct((F.col("cap") / F.col("weight")).alias("r"), "number", "level"))).over(whole)["level"]
    return sizes.withColumn("target", F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))).select("source", "number", "source_size", "target")


def mix(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep: tuple[str, ...] = (),
        weights: tuple[float, ...] = (5, 2, 1), most_times: int = 3, block_words: int = 128, shard_slots: int = 4096,
        rounds: int = 24, seed: int = 3) -> tuple[DataFrame, DataFrame]:
    """The mix of all documents: (documents, slots).

    documents: the id, the ``keep`` columns, ``size`` (words), ``source_size``,
    ``target``, ``passes`` (how often the whole document is taken), ``ranges``
    (word ranges [from, to) that the last, partial pass takes) and ``taken``.

    slots: ``shard``, ``slot``, ``source``, ``pass``, ``block`` and ``length``
    of every slot of the mix; a block is the words [block * block_words, ...)
    of its source's stream.

    Null texts and texts without words have size 0 and nothing taken; a null
    source is a source of its own; repeated rows are documents of their own;
    reruns agree; an empty table gives none.
    """
    held = [F.col(c).alias(f"_keep_{c}") for c in keep]
    rows = df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), *held, F.col(source_col).cast("string").alias("source"),
                     word_count(F.col(text_col)).alias("size"), F.xxhash64(text_col).alias("h"))
    rows = stored(rows, "sizes")  # the texts, if kept, stay here until the ranges are known
    plan = targets(rows, weights, most_times).withColumn("blocks", F.ceil(F.col("source_size") / block_words).cast("long"))
    words = F.round("target").cast("long")
    plan = plan.withColumn("passes", F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("rest", words - F.col("passes") * F.col("source_size"))
    plan = stored(plan, "targets")

    # The draw: what documents give is what its slots say, added up for each block.
    dealt = stored(slots(plan, block_words, shard_slots, rounds, seed), "slots")
    last = F.col("pass") == F.col("of")
    part = dealt.join(plan.select(F.col("source").alias("_s"), F.col("passes").alias("of")), F.col("source").eqNullSafe(F.col("_s")))
    part = part.groupBy("source", "block").agg(F.sum(F.when(last, 0).otherwise(1)).alias("whole"), F.sum(F.when(last, F.col("length"))).alias("length"))

    spots = running_offset(rows.select("row", "id", "source", "size", "h"), "source", "size", [F.col("id"), F.col("h"), F.col("size")], rows.count(), "at")
    each = spots.where("size > 0").select("row", "source", "at", "size", F.explode(F.sequence(F.floor(F.col("at") / block_words).cast("long"), F.floor((F.col("at") + F.col("size") - 1) / block_words).cast("long"))).alias("block"))
    same = (each["source"].eqNullSafe(part["source"])) & (each["block"] == part["block"])
    low = F.greatest(F.col("at"), each["block"] * block_words) - F.col("at")
    high = F.least(F.col("at") + F.col("size"), each["block"] * block_words + F.col("length")) - F.col("at")
    high = F.when(F.col("length").isNotNull(), high)
    end = F.least(F.col("at") + F.col("size"), (each["block"] + 1) * block_words) - F.col("at")
    # Exploded rows are many more than Spark's estimate, so neither side may be broadcast.
    hit = each.hint("merge").join(part.hint("merge"), same, "left").select("row", F.coalesce("whole", F.lit(0)).alias("whole"), low.alias("low"), high.alias("high"), end.alias("end"))
    some = F.greatest(F.coalesce(F.col("high") - F.col("low"), F.lit(0)), F.lit(0))
    ranges = hit.groupBy("row").agg(F.min("whole").alias("drawn"), F.sum(F.col("whole") * (F.col("end") - F.col("low")) + some).alias("some"),
                                    F.array_sort(F.collect_list(F.when(some > 0, F.struct("low", "high")))).alias("ranges"))
    ranges = ranges.withColumn("ranges", F.when(F.size("ranges") > 0, F.col("ranges")))
    # Targets have one row for each source; sizes of sources decide whether Spark sends them to every task.
    known = plan.select(F.col("source").alias("_s"), "source_size", "target", F.col("passes").alias("most"))
    docs = rows.join(known, F.col("source").eqNullSafe(F.col("_s")), "left").join(ranges, "row", "left")
    documents = docs.select(
        F.col("id").alias(id_col), *[F.col(f"_keep_{c}").alias(c) for c in keep], "size", "source_size", "target", F.coalesce("drawn", "most").alias("passes"), "ranges",
        F.coalesce("some", F.lit(0)).cast("long").alias("taken"))
    return documents, dealt


def numbered(rows: DataFrame, chunk: int = 4096) -> DataFrame:
    """Each row ``n`` times, with ``k`` from 0; made in chunks that are dealt out to all tasks.

    The number of tasks is given, as Spark would join the short chunk rows,
    whose size says nothing of what they are about to make, into few tasks.
    """
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    last = lambda n: F.floor((n - 1) / chunk).cast("long")
    zero = F.lit(0).cast("long")
    chunks = rows.where("n > 0").withColumn("_c", F.explode(F.sequence(zero, last(F.col("n"))))).repartition(tasks, "number", "_c")
    first = F.col("_c") * chunk
    return chunks.withColumn("k", F.explode(F.sequence(first, F.least(first + chunk, F.col("n")) - 1))).drop("_c", "n")


def slots(plan: DataFrame, block_words: int, shard_slots: int, rounds: int, seed: int) -> DataFrame:
    """Every slot of the mix, dealt to shards by a permutation of all slots.

    Dealing all sources' slots through one permutation gives each shard a
    multinomial draw of source counts, given the totals.

    A source's last block may be short, and the partial pass may meet it before
    its end.  Its slot there is found by the inverse permutation, so the pass
    has the slots that hold the words it needs, and its last slot has the rest
    of them: sources come to their rounded targets exactly.
    """
    some = F.greatest("blocks", F.lit(1))
    salt = lambda turn: F.pmod(F.col("number") * 4 + turn, F.lit(1 << 20))
    counts = plan.withColumn("missing", F.col("blocks") * block_words - F.col("source_size"))  # words, in the last block
    counts = counts.withColumn("short", permuted(some - 1, some, salt(F.col("passes")), seed, rounds, inverse=True))
    # A rest that ends within the short block needs no slot after it.
    beyond = F.greatest(F.col("short") + 1, F.ceil((F.col("rest") + F.col("missing")) / block_words))
    partial = F.when(F.col("rest") > F.col("short") * block_words, beyond).otherwise(F.ceil(F.col("rest") / block_words))
    counts = counts.withColumn("own", F.col("passes") * F.col("blocks") + partial.cast("long"))
    before = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = counts.withColumn("first", F.coalesce(F.sum("own").over(before), F.lit(0))).withColumn("total", F.sum("own").over(whole)).where("own > 0")
    each = numbered(counts.withColumn("n", F.col("own")))
    turn = F.floor(F.col("k") / F.col("blocks")).cast("long")
    block = permuted(F.col("k") % F.col("blocks"), F.col("blocks"), salt(turn), seed, rounds)
    slot = permuted(F.col("first") + F.col("k"), F.col("total"), F.lit(0), seed + 1, rounds)
    stop = F.least(F.col("source_size"), (F.col("b") + 1) * block_words)
    place = F.pmod("k", "blocks")
    earlier = place * block_words - F.when(place > F.col("short"), F.col("missing")).otherwise(0)
    cut = F.when(F.col("pass") == F.col("passes"), F.col("rest") - earlier).otherwise(F.lit(block_words))
    out = each.withColumn("pass", turn).withColumn("b", block).withColumn("slot", slot)
    return out.select(F.floor(F.col("slot") / shard_slots).cast("long").alias("shard"), "slot", "source", "pass", F.col("b").alias("block"),
                      F.least(stop - F.col("b") * block_words, cut).cast("long").alias("length"))


def taken_texts(documents: DataFrame, id_col: str, text_col: str, source_col: str, others: tuple[str, ...]) -> DataFrame:
    """The mix as documents again: each whole text once for every pass, and the words of the partial pass, in order.

    ``documents`` comes from :func:`mix` with the text, source and other
    columns kept.  A document of which nothing is taken goes.
    """
    words = F.regexp_extract_all(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    some = F.array_join(F.flatten(F.transform("ranges", lambda r: F.slice(words, (r["low"] + 1).cast("int"), (r["high"] - r["low"]).cast("int")))), " ")
    whole = F.array_repeat(F.col(text_col), F.col("passes").cast("int"))
    partly = F.when(F.size(F.coalesce("ranges", F.array().cast("array<struct<low:bigint,high:bigint>>"))) > 0, F.array(some)).otherwise(F.array().cast("array<string>"))
    texts = F.when(F.col("size") > 0, F.concat(whole, partly)).otherwise(F.array().cast("array<string>"))
    return documents.select(id_col, F.explode(texts).alias(text_col), source_col, *others)

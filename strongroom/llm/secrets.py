"""Secret scans: spans by pattern and corpus-wide ownership frequency.

Native: every step is a DataFrame or SQL function.  Base spans come from three
patterns.  The method then looks at every candidate value of the corpus, those
of the base spans and other long mixed tokens, by its hash: in how many
distinct repositories and for how many distinct owners it occurs.  A value that many
owners share, or many repositories of one, is a widely copied example; one that
belongs to a single owner and few of its repositories looks like a live
credential.  Such long mixed tokens are added as spans of kind ``token`` if
they look drawn at random: no words, as paths and slugs have, and no few
characters over and over.  Base spans always stay.

Places are running sums over the pieces of a text, each a row of its own, so
the work grows in proportion to the matches of a text, however many it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strongroom.llm.common import stored

#: The patterns of the kinds, in the order in which ties are listed.
KINDS = {
    "assign": r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]+",
}
#: Fewest characters: of the assigned value, or of the match.
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Runs that may hold what the method adds; its token mixes capitals, small letters and digits.
TOKEN, TOKEN_LEAST = r"[A-Za-z0-9+/_=-]+", 32
#: Patterns whose longest matches are the matches of enough characters, found at once.
LONG = {"access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}", "token": r"[A-Za-z0-9+/_=-]{32,}"}
RANK = {"assign": 0, "access": 1, "hex": 2, "token": 3}
PIECE = "array<struct<rank:int,kind:string,gap:int,n:int,value:string>>"
#: Runs of one class, a capital before small letters counted in; random tokens have short ones, words longer ones.
RUN = "[A-Z]?[a-z]+|[A-Z]+|[0-9]+"
#: Fewest bits of collision entropy, as a power of two: n * n >= RANDOM * (sum of the squared counts of characters).
RANDOM = 8


def pieces(text: Column, kind: str) -> Column:
    """Leftmost matches that don't overlap, in order, as structs: code points before each since the last one (gap), its own (n), and its value."""
    pattern = LONG.get(kind, KINDS.get(kind))
    parts, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else hits
    both = F.slice(F.arrays_zip(parts.alias("gap"), hits.alias("hit"), values.alias("value")), 1, F.size(hits))
    each = F.transform(both, lambda x: F.struct(
        F.lit(RANK[kind]).alias("rank"), F.lit(kind).alias("kind"), F.length(x["gap"]).alias("gap"), F.length(x["hit"]).alias("n"), x["value"].alias("value")))
    return F.when(F.regexp_like(text, F.lit(pattern)), each).otherwise(F.array().cast(PIECE))


def listed(spans: Column) -> Column:
    """kind:start:end, by start and then kind, joined by commas."""
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def mixed(value: Column) -> Column:
    return value.rlike("[A-Z]") & value.rlike("[a-z]") & value.rlike("[0-9]")


def drawn(value: Column) -> Column:
    """Does the value look drawn at random: runs of one class shorter than 2.6 characters on average, and many different characters?"""
    short = 5 * F.length(F.regexp_replace(value, "[^A-Za-z0-9]", "")) < 13 * F.regexp_count(value, F.lit(RUN))
    square = lambda c: F.pow(F.length(value) - F.length(F.replace(value, c, F.lit(""))), F.lit(2))
    same = F.aggregate(F.array_distinct(F.split(value, "")), F.lit(0.0), lambda total, c: total + F.when(c == "", 0.0).otherwise(square(c)))
    return short & (same * RANDOM <= F.pow(F.length(value), F.lit(2)))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_cols: tuple[str, ...] = ("source", "lang"),
         owner_col: str = "source", most_owners: int = 1, most_repos: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """Spans of every whole text and what ownership says about them.

    A repository is a combination of ``repo_cols``, an owner a value of
    ``owner_col`` (null is one of each).  Returns the id, the ``keep`` columns,
    ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans``,
    ``n_live`` (spans whose value has at most ``most_owners`` owners and
    ``most_repos`` repositories of each), ``n_example`` (all others), and
    ``found``: the spans as structs with ``live``, and for :func:`redact` with
    ``first`` (does no earlier span reach into it), and ``upto`` and
    ``any_live`` of the spans that overlap from there.  A null text is empty
    and has no spans; repeated rows give repeated results; null ids are carried
    along; an empty table gives none.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    owner = F.coalesce(F.concat(F.lit("="), F.col(owner_col).cast("string")), F.lit("-"))
    repo = F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in repo_cols])
    carried = [f"_keep_{c}" for c in keep]
    kept = [F.col(c).alias(f"_keep_{c}") for c in keep]
    rows = df.select(F.col(id_col).alias("_id"), *kept, owner.alias("_owner"), repo.alias("_repo"), text.alias("_text"))
    rows = rows.withColumn("_pieces", F.concat(*[pieces(F.col("_text"), kind) for kind in RANK])).drop("_text")
    rows = stored(rows.withColumn("_row", F.when(F.size("_pieces") > 0, F.monotonically_increasing_id())), "spans")

    # One exchange by row; all windows below keep to it.
    each = rows.where("_row is not null").select("_row", "_owner", "_repo", F.posexplode("_pieces").alias("_at", "s")).select("_row", "_owner", "_repo", "_at", "s.*").repartition("_row")
    upto = Window.partitionBy("_row", "rank").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    each = each.withColumn("end", F.sum(F.col("gap") + F.col("n")).over(upto)).withColumn("start", F.col("end") - F.col("n"))
    token = F.col("kind") == "token"
    each = each.where(F.when(token, mixed(F.col("value")) & drawn(F.col("value"))).when(F.col("kind") == "assign", F.length("value") >= LEAST["assign"]).otherwise(True))
    # A token that meets a base span is that span's already: one that starts before it and ends in it, or starts in it.
    place = Window.partitionBy("_row")
    before = place.orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = place.orderBy(F.col("start").desc(), F.col("rank").desc()).rowsBetween(Window.unboundedPreceding, -1)
    each = each.withColumn("reach", F.max(F.when(~token, F.col("end"))).over(before)).withColumn("next", F.min(F.when(~token, F.col("start"))).over(after))
    meets = (F.coalesce("reach", F.lit(0)) > F.col("start")) | F.coalesce(F.col("next") < F.col("end"), F.lit(False))
    each = stored(each.where(~(token & meets)).select("_row", "_owner", "_repo", "rank", "kind", "start", "end", F.sha2("value", 256).alias("_hash")), "candidates")

    # Distinct owners and repositories of a hash by two partial aggregates each, so a value in a third of all rows stays small.
    by_repo = each.groupBy("_hash", "_owner", "_repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("_hash", "_owner").agg(F.count(F.lit(1)).alias("repos"))
    owned = stored(by_owner.groupBy("_hash").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"), F.max("repos").alias("most")), "ownership")
    live = (F.col("owners") <= most_owners) & (F.col("most") <= most_repos)
    marked = each.join(owned, "_hash").withColumn("live", live).where(~token | F.col("live")).drop("_hash", "_owner", "_repo")
    marked = stored(marked, "marked").repartition("_row")
    marked = marked.withColumn("first", F.coalesce(F.max("end").over(before) <= F.col("start"), F.lit(True)))
    group = F.sum(F.col("first").cast("int")).over(place.orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = Window.partitionBy("_row", "_group")
    marked = marked.withColumn("_group", group).withColumn("upto", F.max("end").over(whole)).withColumn("any_live", F.max("live").over(whole))
    span = F.struct(*[F.col(c).cast("int").alias(c) for c in ("start", "rank", "end")], "kind", "live", "owners", "repos", "first", F.col("upto").cast("int").alias("upto"), "any_live")
    marked = marked.groupBy("_row").agg(F.array_sort(F.collect_list(span)).alias("found"))
    few = rows.where("_row is not null").drop("_pieces").join(marked, "_row", "left")
    none = rows.where("_row is null").drop("_pieces").withColumn("found", F.lit(None).cast(few.schema["found"].dataType))
    out = few.unionByName(none).withColumn("found", F.coalesce("found", F.array().cast(few.schema["found"].dataType)))
    number = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return out.select(
        F.col("_id").alias(id_col), *[F.col(k).alias(c) for k, c in zip(carried, keep)], *[number(k) for k in KINDS],
        F.sha2(listed(F.filter("found", lambda s: s["kind"] != "token")), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"),
        F.size(F.filter("found", lambda s: s["live"])).cast("long").alias("n_live"),
        F.size(F.filter("found", lambda s: ~s["live"])).cast("long").alias("n_example"), "found")


def redact(text: Column, found: Column, live: str = "[SECRET]", example: str = "[EXAMPLE]", chunk: int = 1024) -> Column:
    """The text with every span of :func:`scan` replaced; spans that overlap are one, live if any of them is.

    The text is cut into chunks once, and each stretch between spans comes
    from the chunks that hold it, so the work is in proportion to the length
    of the text and the number of spans.
    """
    def between(x: Column, a: Column, b: Column) -> Column:
        low = F.floor(a / chunk).cast("int")
        held = F.array_join(F.slice(x["chunks"], low + 1, F.floor(b / chunk).cast("int") - low + 1), "")
        return F.substring(held, a - low * chunk + 1, b - a)

    def made(x: Column) -> Column:
        def piece(s: Column, k: Column) -> Column:
            a = F.when(k == 0, F.lit(0)).otherwise(F.get(x["spans"], k - 1)["upto"])
            return F.concat(between(x, a, s["start"]), F.when(s["any_live"], F.lit(live)).otherwise(F.lit(example)))

        last = F.element_at(x["spans"], -1)["upto"]
        return F.concat(F.array_join(F.transform(x["spans"], piece), ""), between(x, last, x["length"]))

    chunks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    # A lambda's argument is found once for each row.
    held = F.array(F.struct(chunks.alias("chunks"), F.filter(found, lambda s: s["first"]).alias("spans"), F.length(text).alias("length")))
    return F.when(F.size(found) > 0, F.element_at(F.transform(held, made), 1)).otherwise(text)

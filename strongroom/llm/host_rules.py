"""Quality rules of hosts.

Every text gets counts and is held against rules of its own.  The rule
failures are added up by host (domain), each host's failure rate is shrunk
towards the corpus rate with a beta prior fitted to all hosts, and the verdict
on the host is joined back to its documents.  Everything is a Spark column,
join or aggregate; a document's words never leave its row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strongroom.llm.common import stored

#: White space of the contract besides the space: tab, LF, VT, FF, CR.
BLANKS = "\t\n\x0b\f\r"
SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: A rule is true where a document fails it; the counts are those of ``statistics``.
BASE_RULES: Mapping[str, Column | str] = {
    "short": "n_words < 50",
    "repeats": "100 * n_repeat_words > 50 * n_words",
}
HOST_RULES: Mapping[str, Column | str] = {
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "n_dup_lines > 5 AND 5 * n_dup_lines > n_lines",
    "word_length": "word_chars < 3 * n_words OR word_chars > 12 * n_words",
}


def domain(col: Column) -> Column:
    """Host of a URL in lower case without ``www.``; other text as it is, null where blank."""
    host = F.coalesce(F.try_parse_url(col, F.lit("HOST")), col)
    host = F.regexp_replace(F.lower(F.trim(host)), r"^www\.", "")
    return F.when(host != "", host)


def statistics(df: DataFrame, text_col: str, keep: Sequence[Column], window: int = 3) -> DataFrame:
    """``keep`` and the counts of the whole text (null: empty):

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_lines`` (lines with a
    word), ``n_dup_lines`` (such lines equal to an earlier one) and
    ``n_repeat_words`` (words in windows of ``window`` words that occur twice or
    more in the text, the first occurrence included).

    Windows are hashed.  Only where a hash occurs twice in the text are its
    windows sorted, and those of equal hash are then compared as text, so the
    counts are exact and the work is about in proportion to the text.
    """
    t, w = F.col("_t"), F.col("_w")
    width = lambda c: F.size(c).cast("long")
    out = df.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    names = out.columns[:-1]
    blank = F.lit(" " + BLANKS)
    out = out.select(
        *names,
        F.split(t, SPACE).alias("_w"),
        F.filter(F.split(t, "\n"), lambda x: F.ltrim(x, blank) != "").alias("_lines"),
        (F.size(F.split(t, SYMBOLS)) - 1).cast("long").alias("n_symbols"),
    )
    # A text that starts or ends with white space has an empty piece there.
    first, last = F.when(F.get(w, F.lit(0)) == "", 1).otherwise(0), F.when(F.element_at(w, -1) == "", 1).otherwise(0)
    out = out.withColumn("_w", F.slice(w, first + 1, F.greatest(F.size(w) - first - last, F.lit(0))))
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    words = lambda i: [F.get(w, i + k) for k in range(window)]
    out = out.select(
        *names,
        width(w).alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        "n_symbols",
        width("_lines").alias("n_lines"),
        (width("_lines") - width(F.array_distinct("_lines"))).alias("n_dup_lines"),
        "_w",
        F.when(F.size(w) > window, F.transform(F.sequence(F.lit(0), F.size(w) - window), lambda i: F.xxhash64(*words(i)))).alias("_hash"),
    )
    hashes, found = F.col("_hash"), F.size(F.array_distinct("_hash")) < F.size("_hash")
    numbered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("x"), i.alias("i"))))
    out = out.select(*names, *counts, F.when(found, w).alias("_w"), F.when(found, numbered).alias("_seq"))
    seq, starts = F.col("_seq"), F.col("_starts")

    def repeated(s: Column, i: Column) -> Column:
        same = lambda other: F.coalesce(F.get(seq, other)["x"] == s["x"], F.lit(False))
        return same(i - 1) | same(i + 1)

    likely = F.transform(F.filter(seq, repeated), lambda s: F.struct(F.concat_ws(" ", *words(s["i"])).alias("x"), s["i"].alias("i")))
    out = out.select(*names, *counts, F.sort_array(likely).alias("_seq"))
    out = out.select(*names, *counts, F.sort_array(F.transform(F.filter(seq, repeated), lambda s: s["i"])).alias("_starts"))
    # A window covers its words up to the next repeated window's start.
    covered = F.transform(starts, lambda p, i: F.least(F.lit(window), F.coalesce(F.get(starts, i + 1) - p, F.lit(window))))
    total = F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)
    return out.select(*names, *counts, F.coalesce(total, F.lit(0).cast("long")).alias("n_repeat_words"))


def beta_prior(docs: float, failures: float, hosts: float, squares: float, spread: float, least: float = 0.0) -> tuple[float, float]:
    """Beta prior (alpha, beta) of host failure rates by moments.

    ``squares`` is the sum of n^2 and ``spread`` that of f^2 / n over the
    hosts (n documents, f failures).  The prior's mean is the corpus rate; its
    strength follows from how far the host rates lie apart beyond what
    binomial chance gives.  Where hosts differ no more than that (or there is
    one host only), the prior is as strong as it can be, and all
    hosts get nearly the corpus rate.  It counts as ``least`` documents at least.
    """
    rate = failures / docs if docs else 0.0
    noise = rate * (1 - rate)
    room = noise * (docs - squares / docs - (hosts - 1)) if docs else 0.0
    excess = spread - docs * rate * rate - noise * (hosts - 1)
    rho = min(max(excess / room, 1e-6), 1 - 1e-6) if room > 0 else 1e-6
    strength = max((1 - rho) / rho, least)
    return rate * strength, (1 - rate) * strength


def host_verdicts(
    checked: DataFrame, host: str, rules: Sequence[str], limit: float = 0.8, least: float = 10.0
) -> DataFrame:
    """One row per host that is not null: ``host``, ``n_docs``, and per rule
    ``<rule>_rate`` (shrunk failure rate) and whether the host ``host_failed``:
    some rule's shrunk rate exceeds ``limit``.  The prior counts as ``least``
    documents at least, so that a host of one or two is not condemned by them.

    ``checked`` holds the host and one boolean per rule (true: failed; null
    counts as passed).  Failures are added up map-side, so a host with a third
    of all rows is no single task's work; the prior needs one row of sums.
    """
    failed = {r: F.count_if(F.coalesce(F.col(r), F.lit(False))).alias(r) for r in rules}
    hosts = checked.where(F.col(host).isNotNull()).groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("n_docs"), *failed.values())
    n = F.col("n_docs").cast("double")
    sums = [F.sum(n), F.count(F.lit(1)), F.sum(n * n)]
    for r in rules:
        sums += [F.sum(r), F.sum(F.col(r) * F.col(r) / n)]
    docs, count, squares, *rest = [float(x or 0) for x in hosts.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()]
    rates = {}
    for k, r in enumerate(rules):
        alpha, beta = beta_prior(docs, rest[2 * k], count, squares, rest[2 * k + 1], least)
        rates[r] = (F.col(r) + F.lit(alpha)) / (n + F.lit(alpha + beta))
    over = F.lit(False)
    for rate in rates.values():
        over = over | (rate > limit)
    return hosts.select("host", "n_docs", *[rate.alias(f"{r}_rate") for r, rate in rates.items()], over.alias("host_failed"))


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    base_rules: Mapping[str, Column | str] = BASE_RULES,
    host_rules: Mapping[str, Column | str] = HOST_RULES,
    limit: float = 0.8,
    keep: Sequence[str] = (),
) -> DataFrame:
    """The id, ``keep``, the counts of ``statistics``, ``base_failed``, ``host_failed`` and ``kept``.

    ``base_failed``: the document itself fails a base rule.  ``host_failed``:
    its host does (see ``host_verdicts``).  ``kept``: neither.

    One row for every input row, whatever its id (null and repeated ids too).
    A null text counts as empty, so it has no words and fails as short.  A
    document whose host is null or blank has no host verdict.  Ties do not
    arise: equal texts have equal counts.  An empty table gives an empty result.
    The counts are stored once; hosts are joined by Spark's own choice of join
    (broadcast only below its size limit, else a sort-merge join whose hot
    hosts adaptive execution splits), and only failing hosts are joined.
    """
    expr = lambda c: F.expr(c) if isinstance(c, str) else c
    both = {f"base_{k}": expr(v) for k, v in base_rules.items()} | {f"host_{k}": expr(v) for k, v in host_rules.items()}
    kept = [F.col(id_col).alias("_id"), F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)] or [F.lit(0)]).alias("_keep"),
            domain(F.col(host_col).cast("string")).alias("_host")]
    checked = stored(statistics(docs, text_col, kept).withColumns(both), "host-rules")
    bad = host_verdicts(checked, "_host", [f"host_{k}" for k in host_rules], limit).where("host_failed").select(F.col("host").alias("_bad"))
    joined = checked.join(bad, F.col("_host") == F.col("_bad"), "left")
    base = F.lit(False)
    for k in base_rules:
        base = base | F.coalesce(F.col(f"base_{k}"), F.lit(False))
    host = F.col("_bad").isNotNull()
    return joined.select(
        F.col("_id").alias(id_col), *[F.col("_keep")[f"k{i}"].alias(c) for i, c in enumerate(keep)],
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), host.alias("host_failed"), (~base & ~host).alias("kept"),
    )

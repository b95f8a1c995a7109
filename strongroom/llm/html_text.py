"""HTML extraction: main text by text-to-tag ratio.

The standard library's parser streams events.  Block borders cut the page
into lines; each line has a text-to-tag ratio (characters for each tag met in
it).  The ratios are smoothed with a Gaussian over neighbouring lines and
split in two clusters by a threshold (one-dimensional two-means); the upper
cluster is content, but for lines that are mostly links.  The regions are then
widened to the element that holds them: the ``article`` or ``main`` elements
with content, else the deepest element that holds most of the content
characters.  An ``article`` or ``main`` element says itself what belongs to it:
only blocks of links before or after its prose go, paragraphs aside.  In other regions, lines of
the lower cluster go, but for headings, paragraphs beside content and other
lines between content.

Lines inside boilerplate elements never count.  Forms and elements with
boilerplate words count if most of the page's content lies in those that the
same word marks.  A boilerplate word is a whole class name, or one of a
compound that holds nothing but such words and words of layout: ``cookie-notice``
and ``ad-slot`` are boilerplate, ``share-price`` and ``safety-notice`` aren't.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset({"article", "main"})
#: Elements that never hold main text.
SKIP = frozenset(
    "aside audio button canvas datalist dialog fieldset footer head iframe input label menu nav noscript object option "
    "script select style svg template textarea title video".split())
#: Words of class, id and role that mark boilerplate.
MARKS = frozenset(
    "ad ads adsbygoogle adsense advert advertisement adverts advertising banner breadcrumb breadcrumbs comment commentlist comments consent contentinfo "
    "cookie cookies copyright disclaimer disqus footer form gdpr login masthead menu modal nav navbar navigation newsletter "
    "notice notices pagination pager popup promo promotion recommended related reply replies search share sharing sidebar "
    "signup social sponsor sponsored subscribe subscription toolbar widget widgets".split())
#: Start tags that end an open element of the same kind.
CLOSES = {"p": BLOCK - {"body", "html"}, "li": frozenset({"li"}), "option": frozenset({"option", "optgroup"}), "td": frozenset({"td", "th", "tr"}),
          "th": frozenset({"td", "th", "tr"}), "tr": frozenset({"tr", "tbody", "tfoot"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"})}
#: Words that no amount of text overrules.
ALWAYS = frozenset("comment comments commentlist consent cookie cookies disqus gdpr replies reply".split())
#: What a head may hold; anything else ends it.
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
#: Elements whose short lines are text, beside or between content lines.
PARAGRAPH = frozenset("blockquote p pre".split())
BETWEEN = PARAGRAPH | frozenset("address caption dd dt figcaption li summary td th".split())
#: Words of layout, which say nothing of what an element holds.
LAYOUT = frozenset(
    "aside area articles bar block body bottom box btn button buttons col column container content desktop fixed global google group "
    "header icons inner item items layer leaderboard left legal lg link links list main mobile module outer overlay page pages panel posts primary "
    "rail right row secondary section sidebar site slot sm sticky stories top unit wrap wrapper".split())
words_of = re.compile("[A-Z]?[a-z]+|[A-Z]+").findall


def marks(attrs: list[tuple[str, str | None]]) -> frozenset[str]:
    """The boilerplate words that the attributes hold; a name with any other word, as in "has-sidebar", holds none."""
    out: set[str] = set()
    for name, value in attrs:
        for token in (value or "").split() if name in ("class", "id", "role") else ():
            words = {w.lower() for w in words_of(token)}
            if words <= MARKS | LAYOUT:
                out |= words & MARKS
    return frozenset(out)


def hidden(attrs: list[tuple[str, str | None]]) -> bool:
    """Do the attributes mark an element that isn't shown?"""
    for name, value in attrs:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value or "", re.I):
            return True
    return False


class Lines(HTMLParser):
    """Collects (parts, tags, path of enclosing blocks) for each line; a part is its text, the boilerplate words above it, and whether it is a link."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool, frozenset[str]]] = []  # tag, number, boilerplate here or above, words here or above
        self.lines: list[tuple[list[tuple[str, frozenset[str], bool]], int, tuple[int, ...]]] = []
        self.kind: dict[int, str] = {}
        self.parts: list[tuple[str, frozenset[str], bool]] = []
        self.tags = self.count = 0

    def end_line(self) -> None:
        if any(text.strip() for text, _, _ in self.parts):
            self.lines.append((self.parts, self.tags, tuple(n for t, n, _, _ in self.open if t in BLOCK)))
            self.tags = 0
        self.parts = []

    def skipping(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    def words(self) -> frozenset[str]:
        return self.open[-1][3] if self.open else frozenset()

    def pop_to(self, k: int) -> None:
        del self.open[k:]

    def end_head(self) -> None:
        """Body content has started: a head without an end tag ends here."""
        tags = [t for t, _, _, _ in self.open]
        if "head" in tags and not {"noscript", "template"}.intersection(tags):
            self.pop_to(tags.index("head"))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD:
            self.end_head()
        if tag == "br":
            self.parts.append((" ", self.words(), False))
        if tag in BLOCK:
            self.end_line()
            for k in range(len(self.open) - 1, -1, -1):
                if tag in CLOSES.get(self.open[k][0], ()):
                    self.pop_to(k)
                    break
                if self.open[k][0] in BLOCK:
                    break
        self.tags += 1
        if tag in VOID:
            return
        inside = [t for t, _, _, _ in self.open]
        plain = tag in ("html", "body", "article", "main")
        skip = self.skipping() or tag in SKIP or not plain and hidden(attrs)
        words = self.words() | (frozenset() if plain else marks(attrs)) | ({"form"} if tag == "form" else set())
        if "header" in inside or tag == "header":  # of an article, headings alone
            held = CONTENT.intersection(inside)
            skip = skip or not held or tag not in HEADING and not HEADING.intersection(inside) and tag != "header"
        self.count += 1
        self.kind[self.count] = tag
        self.open.append((tag, self.count, skip, words))

    def parse_comment(self, i: int, report: bool = True) -> int:
        """A comment that nothing closes goes on to the page's end."""
        end = super().parse_comment(i, report)
        return end if end >= 0 else len(self.rawdata)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.end_line()
        self.tags += 1
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.pop_to(k)
                return
            if tag not in BLOCK and self.open[k][0] in BLOCK:
                return  # an inline end tag closes nothing outside its block

    def handle_data(self, data: str) -> None:
        if data.strip() and self.open and self.open[-1][0] == "head":
            self.end_head()
        if not self.skipping() and not (self.open and self.open[-1][0] == "header"):
            self.parts.append((data, self.words(), any(t == "a" for t, _, _, _ in self.open)))


def content_lines(ratios: list[float], sigma: float) -> list[bool]:
    """Smooth the ratios and tell the upper of two clusters; all, if there is one."""
    import numpy as np

    x = np.asarray(ratios)
    r = int(3 * sigma)
    w = np.exp(-(np.arange(-r, r + 1) ** 2) / (2 * sigma * sigma))
    smooth = np.convolve(np.pad(x, r, mode="edge"), w / w.sum(), mode="valid")
    low, high = smooth.min(), smooth.max()
    for _ in range(50):
        cut = (low + high) / 2
        upper = smooth >= cut
        if upper.all():
            break
        new = smooth[~upper].mean(), smooth[upper].mean()
        if new == (low, high):
            break
        low, high = new
    return [bool(v) for v in smooth >= (low + high) / 2]


def joined(raw: list, allowed: frozenset[str] | None) -> list[tuple[str, int, tuple[int, ...], bool]]:
    """(text, tags, path, mostly links) of lines with text, without parts under other words than the allowed ones (None: any)."""
    out, before = [], 0
    for parts, tags, path in raw:
        before += tags
        here = [(t, link) for t, words, link in parts if allowed is None or words <= allowed]
        text = " ".join("".join(t for t, _ in here).split())
        if text:
            linked = len(" ".join("".join(t for t, link in here if link).split()))
            out.append((text, before, path, 2 * linked > len(text)))
            before = 0
    return out


def content_of(lines: list, sigma: float) -> list[bool]:
    upper = content_lines([len(text) / max(1, tags) for text, tags, _, _ in lines], sigma)
    return [yes and not links for yes, (_, _, _, links) in zip(upper, lines)]


def overruled(raw: list, sigma: float, most: float, least_words: int = 25) -> frozenset[str]:
    """Boilerplate words under which most of the page's content lies."""
    if not any(words for parts, _, _ in raw for _, words, _ in parts):
        return frozenset()
    filled = [r for r in raw if joined([r], None)]
    lines = joined(filled, None)
    held: dict[str, int] = {}
    total = 0
    for (parts, _, _), yes in zip(filled, content_of(lines, sigma)):
        for text, words, _ in parts if yes else ():
            n = len(text.split())
            total += n
            for w in words:
                held[w] = held.get(w, 0) + n
    return frozenset(w for w, n in held.items() if n >= max(most * total, least_words) and w not in ALWAYS)


def main_text(html: str, sigma: float = 1.0, most: float = 0.6) -> str:
    parser = Lines()
    last = html.rfind("<")
    if last > html.rfind(">") and re.match("<[A-Za-z/!?]", html[last:]) and not re.search(r"</?(script|style)\b[^<]*$", html[:last], re.I):
        html = html[:last]  # a tag that the page's end cut off
    parser.feed(html)
    parser.close()
    parser.end_line()
    kind = parser.kind
    lines = joined(parser.lines, overruled(parser.lines, sigma, most))
    if not lines:
        return ""
    content = content_of(lines, sigma)
    held: dict[int, int] = {}
    for (text, _, path, _), yes in zip(lines, content):
        for n in path if yes else ():
            held[n] = held.get(n, 0) + len(text)
    total = max([sum(len(t) for (t, _, _, _), yes in zip(lines, content) if yes), 1])
    regions = {n for n in held if kind[n] in CONTENT} or {n for n in kind if kind[n] in CONTENT and any(n in p for _, _, p, _ in lines)}
    named = bool(regions)
    if not regions:
        wide = [n for n, c in held.items() if c >= most * total and kind[n] not in ("p", "li", "td", *HEADING)]
        regions = {max(wide)} if wide else set()
    inside = [(line, yes) for line, yes in zip(lines, content) if not regions or regions.intersection(line[2])]
    kept = outside_link_lists(inside, kind) if named else kept_lines(inside, kind)
    return "\n\n".join(line[0] for (line, _), yes in zip(inside, kept) if yes)


def outside_link_lists(inside: list, kind: dict[int, str]) -> list[bool]:
    """Which lines of article or main elements stay: all but blocks of links before or after the prose that aren't paragraphs or headings."""
    tags = [kind[line[2][-1]] for line, _ in inside]
    text = PARAGRAPH | HEADING | CONTENT
    prose = [k for k, ((_, _, _, links), yes) in enumerate(inside) if yes or tags[k] in PARAGRAPH and not links]
    return [not (links and prose and tags[k] not in text and not prose[0] < k < prose[-1]) for k, ((_, _, _, links), _) in enumerate(inside)]


def kept_lines(inside: list, kind: dict[int, str]) -> list[bool]:
    """Which lines of a region stay that no article or main element names."""
    tags = [kind[line[2][-1]] if line[2] else "" for line, _ in inside]
    above = [line[2][:-1] for line, _ in inside]
    content = [k for k, (_, yes) in enumerate(inside) if yes]
    first, last = (content[0], content[-1]) if content else (len(inside), -1)
    beside = {above[k] for k in content}
    size: dict[str, int] = {}
    for k in content:
        size[tags[k]] = size.get(tags[k], 0) + len(inside[k][0][0])
    # Pages may write their paragraphs in other elements.
    usual = {t for t, n in size.items() if 2 * n >= sum(size.values())}
    kept = []
    for k, ((_, _, _, links), yes) in enumerate(inside):
        between = first < k < last
        if tags[k] in PARAGRAPH:
            short = not links and above[k] in beside or between and above[k] in beside
        elif tags[k] in BETWEEN:
            short = not links and between
        else:
            short = not links and between and tags[k] in usual and above[k] in beside
        kept.append(yes or short)
    follows = False  # a heading stays if what it heads does
    for k in range(len(inside) - 1, -1, -1):
        if tags[k] in HEADING:
            kept[k] = kept[k] or follows
        else:
            follows = kept[k]
    return kept


def extract(df: DataFrame, id_cols: tuple[str, ...] = ("page_id", "url"), html_col: str = "html", sigma: float = 1.0) -> DataFrame:
    """Main text of each page: the id columns, ``text`` and ``n_chars``.

    Whole pages; a block's white space becomes single spaces and blocks are
    joined by an empty line.  Null and empty pages, and pages without main
    text, give an empty string; repeated rows give repeated results; an empty
    table gives none.  Other columns are not read.
    """
    ids = [T.StructField(c, df.schema[c].dataType) for c in id_cols]
    schema = T.StructType(ids + [T.StructField("text", T.StringType())])

    def run(batches: Iterator):
        import pyarrow as pa

        for batch in batches:
            texts = pa.array([main_text(h or "", sigma) for h in batch.column(len(id_cols)).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], texts], names=[*id_cols, "text"])

    out = df.select(*[F.col(c) for c in id_cols], F.col(html_col).alias("_html")).mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast("long"))

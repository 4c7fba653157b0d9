"""Main text of web pages: blocks by structure, all of them judged by a suffix array for each host.

A page is scanned once from left to right (raw-text elements and comments are skipped whole) and
cut into blocks at block-level tags. Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms, reader comments and the like are boilerplate by their element, role or class. If a
page has text in ``article`` or ``main`` elements, that is its text; their own headings
stay. What stands outside them, and all text of pages without them, is open.

The host's suffix arrays judge every block: the streams of all text outside articles (marked or
not, so that a menu without marks meets the same menu with marks) of a host's pages are joined, and so are
those of all text inside them. Strings of at least ``SHARED`` bytes that occur on two or more distinct pages are
found (anchors bring them together, two-stage sorted arrays compare them, see ``suffix``), and a block that
these strings cover by nine tenths counts as shared.

Structure is asked after that. An open block that is shared is dropped as boilerplate, others are the text of pages
without an article. Blocks inside articles stay even if shared, as articles quote passages that other pages of the host
have too; ``n_shared`` tells how much of the text these are. Marked blocks go even if unique: each page's comments and
notices may be its own. Pages with an article keep no open block.

Classes are read by their words. A word counts as a mark unless its name says that it describes something else
(``has-sidebar``, ``category-legal``, ``article-header``); marks on ``main`` are not read, and on ``article`` those of
comments, adverts and teasers alone.

Defined results: null and empty html give the empty text; copies of a page (equal open text on one host)
count as one page, so that a copied page keeps its text; near copies without an article count as two; pages without a
host share one group; repeated rows give one row each; markup that never closes runs to the end of the page (an
attribute's quotation mark: to the next ``>``); an article inside an article that has text already is a comment;
several articles side by side are all text; an ``article`` or ``main`` without text is as none.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import suffix
from .storage import discard, realigned, written

#: Bytes of a string that counts as shared between pages, and of the anchors by which such strings are found.
SHARED = 96
ANCHOR = 32

_NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
_VALUE_OR_END = re.compile(r"=\s*([\"'])|>")
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

#: Elements whose content is no text of the page.
RAW = frozenset("script style noscript template svg math iframe object canvas textarea select title".split())
_RAW_END = {n: re.compile(rf"</{n}(?=[\s/>]|\Z)", re.I) for n in RAW}
_HEAD_END = re.compile(r"</head(?=[\s/>]|\Z)|(?=<body[\s/>])", re.I)
#: Elements that start and end a block.
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements without content.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that are never main text.
DROPPED = frozenset("nav footer aside form button menu dialog header".split())
#: Words in class, id or role that mark an element as boilerplate.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner menu nav navbar navigation breadcrumb breadcrumbs header masthead "
    "footer foot sidebar side aside widget related recommended share sharing social comment comments disqus reply replies respond cookie cookies consent gdpr notice "
    "notices alert popup modal overlay newsletter subscribe subscription signup login search toolbar pagination pager skip copyright legal disclaimer complementary contentinfo dialog".split()
)
#: Those that mark an ``article`` element.
ARTICLE_MARKS = frozenset("ad ads advert advertisement sponsored promo widget related recommended comment comments reply replies".split())
#: Words by which a name describes a state, a kind or a layout: it marks nothing.
DESCRIBING = frozenset("with without has no by category tag type format".split())
#: Words of what the main text itself is called; its own header stays.
OWN = frozenset("article entry post story content page title".split())
_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+")
_SPACE = re.compile(r"\s+")


def _names(name: str, marks: frozenset) -> bool:
    """Whether a class, id or role marks boilerplate."""
    parts = {p.lower() for p in _PARTS.findall(name)}
    found = parts & marks
    if parts & OWN:
        found -= {"header", "head", "banner"}
    return bool(found) and not parts & DESCRIBING


def _marked(attributes: str, marks: frozenset = MARKS) -> bool:
    """Whether an element's attributes say that it is boilerplate or hidden."""
    for name, a, b, c in _ATTR.findall(attributes):
        name, value = name.lower(), a or b or c
        if name in ("class", "id", "role"):
            if any(_names(word, marks) for word in value.split()):
                return True
        elif name == "style" and "display:none" in value.replace(" ", "").lower() or name == "aria-hidden" and value.lower() == "true":
            return True
    return bool(re.search(r"(?:^|\s)hidden(?:\s|$|=)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attributes)))


def _tag_end(page: str, at: int, last: dict[str, int]) -> int:
    """Index of the ``>`` that ends a tag, or the page's length. ``last``: last place of each quotation mark."""
    while m := _VALUE_OR_END.search(page, at):
        quote = m[1]
        if not quote:
            return m.start()
        at = page.index(quote, m.end()) + 1 if last[quote] >= m.end() else m.end()
    return len(page)


def scan(page: str):
    """Text (as ``(None, text, False)``) and tags (``(name, attributes, closing)``) of a page, in one pass."""
    at, size = 0, len(page)
    last = {q: page.rfind(q) for q in "\"'"}

    def after(what: str, start: int) -> int:
        end = page.find(what, start)
        return size if end < 0 else end + len(what)

    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            tag = size
        if tag > at:
            yield None, page[at:tag], False
        if tag == size:
            return
        if page.startswith("<!--", tag):
            at = after("-->", tag + 4)
        elif page.startswith("<![CDATA[", tag):
            at = after("]]>", tag + 9)
        elif page.startswith(("<!", "<?"), tag):
            at = after(">", tag + 2)
        elif m := _NAME.match(page, tag + 1):
            end, name = _tag_end(page, m.end(), last), m[2].lower()
            at = min(end + 1, size)
            if not m[1] and name in RAW:
                close = _RAW_END[name].search(page, at)
                at = after(">", close.end()) if close else size
            elif not m[1] and name == "head":
                if close := _HEAD_END.search(page, at):
                    at = after(">", close.end()) if close[0] else close.start()
            else:
                yield name, page[m.end() : end], bool(m[1])
        else:
            yield None, "<", False
            at = tag + 1


def blocks_of(page: str | None) -> tuple[list[str], list[str], list[str], bool]:
    """Blocks inside articles, open blocks, marked blocks, and whether the page has text in an article."""
    inside: list[str] = []
    outside: list[str] = []
    marked: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # element, dropped, in article
    opened: dict[str, int] = {}
    dropped = article = False
    held: list[str] = []

    def end_block() -> None:
        if held:
            text = "".join(held)
            held.clear()
            text = _SPACE.sub(" ", entities.unescape(text) if "&" in text else text).strip()
            if text:
                (marked if dropped else inside if article else outside).append(text)

    def push(name: str) -> None:
        stack.append((name, dropped, article))
        opened[name] = opened.get(name, 0) + 1

    def pop() -> tuple[bool, bool]:
        name, was_dropped, was_article = stack.pop()
        opened[name] -= 1
        return was_dropped, was_article

    for name, attributes, closing in scan(page or ""):
        if name is None:
            held.append(attributes)
        elif name not in BLOCK and name not in DROPPED:
            if name == "br":
                held.append(" ")
            elif closing:
                if stack and stack[-1][0] == name:
                    end_block()
                    dropped, article = pop()
            elif name not in VOID and name != "a" and "=" in attributes and not attributes.endswith("/") and _marked(attributes):
                end_block()
                push(name)
                dropped = True
        elif closing:
            end_block()
            while opened.get(name):
                found = stack[-1][0] == name
                dropped, article = pop()
                if found:
                    break
        else:
            end_block()
            if name in VOID:
                continue
            if name in ("p", "li") and stack and stack[-1][0] == name:
                dropped, article = pop()
            push(name)
            if name == "main" or name == "article":
                if dropped:
                    continue
                comment = name == "article" and article and opened["article"] > 1 and inside
                dropped = bool(comment) or bool(attributes) and _marked(attributes, ARTICLE_MARKS if name == "article" else frozenset())
                article = article or not dropped
            elif name in DROPPED and not (name == "header" and article) or name not in ("html", "body") and attributes and _marked(attributes):
                dropped = True
    end_block()
    return inside, outside, marked, bool(inside)


def host_of(url: str | None) -> str:
    m = re.match(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def parsed(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url") -> DataFrame:
    """``_id``, ``url``, ``host``, and ``inside``, ``open`` and ``marked`` (arrays of blocks) of every page."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches):
        lists = pa.list_(pa.string())
        for b in batches:
            rows = [blocks_of(t) for t in b.column(2).to_pylist()]
            links = b.column(1).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([host_of(u) for u in links], pa.string()), *(pa.array([r[i] for r in rows], lists) for i in range(3))],
                ["_id", "url", "host", "inside", "open", "marked"],
            )

    return pages.select(F.col(key).alias("_id"), F.col(url).alias("url"), F.col(html).alias("_html")).mapInArrow(run, f"_id {kind}, url string, host string, inside array<string>, open array<string>, marked array<string>")


def host_boilerplate(streams: DataFrame, shared: int = SHARED) -> DataFrame:
    """``_k`` (stream), covered byte ``runs``: strings that two streams of one host share.

    ``streams``: ``stream`` (long, distinct), ``host``, ``text`` (a page's blocks, joined).
    """
    _, runs = suffix.repeated_runs(streams, shared, "text", "stream", group="host", across=True, anchor=ANCHOR, rescan=True)
    return runs.select("_k", "runs")


def shared_blocks(blocks: list[str], runs) -> list[bool]:
    """Which blocks of a stream the shared strings cover by nine tenths."""
    spans, out, at = suffix.merged([(r["a"], r["b"]) for r in runs or ()]), [], 0
    for block in blocks:
        end = at + len(block.encode("utf-8", "surrogatepass"))
        covered = sum(max(0, min(b, end) - max(a, at)) for a, b in spans)
        out.append(covered * 10 >= 9 * (end - at))
        at = end + 1
    return out


def settled(inside: list[str], inside_runs, open_: list[str], open_runs) -> tuple[str, int]:
    """A page's text and how many of its code points stand in blocks that the array found shared.

    The array judges every block. Structure is asked after it: text of articles stays, shared or not, and beside it no
    open block does.
    """
    if inside:
        return "\n".join(inside), sum(len(b) for b, is_shared in zip(inside, shared_blocks(inside, inside_runs)) if is_shared)
    return "\n".join(b for b, is_shared in zip(open_, shared_blocks(open_, open_runs)) if not is_shared), 0


def main_text(pages: DataFrame, html: str = "html", key: str = "page_id", url: str = "url", shared: int = SHARED) -> DataFrame:
    """One row per row of ``pages``: ``key``, ``url``, ``text``, ``n_chars``, ``n_shared``."""
    kind = pages.schema[key].dataType.simpleString()
    numbered = parsed(pages, html, key, url).withColumn("_row", F.monotonically_increasing_id())
    # Blocks hold no line breaks. Articles are compared with articles: a quotation makes no boilerplate of an open block.
    # What stands outside them is one stream, open blocks first.
    article, apart = F.array_join("inside", "\n"), F.concat("host", F.lit("\n"))
    outside = F.array_join(F.concat("open", "marked"), "\n")
    of = lambda group, text: F.unhex(F.substring(F.sha2(F.concat_ws("\n", group, text), 256), 1, 32))
    rows = written(numbered.withColumns({"_of": of("host", outside), "_art": of(apart, article)}), "pages")
    sides = rows.select((F.col("_row") * 2).alias("_side"), "_of", "host", outside.alias("text"))
    sides = sides.unionByName(rows.select((F.col("_row") * 2 + 1).alias("_side"), F.col("_art").alias("_of"), apart.alias("host"), article.alias("text"))).where("text <> ''")
    # Copies of a page on one host are one stream, named by a row of it.
    names = written(sides.groupBy("_of").agg(F.min("_side").alias("_stream"), F.count("*").alias("_n")), "streams")
    # Texts are shuffled only where a copy may have to go, and below where a page has a verdict.
    again = written(suffix.bit_words(names.where("_n > 1").select(F.xxhash64("_of").alias("h"))), "copied")
    copied, single = suffix.parted(sides, F.xxhash64("_of"), again)
    copied = written(copied.join(realigned(names.select(F.col("_stream").alias("_side")), "_side"), "_side"), "copied-streams")
    streams = single.unionByName(copied.select(single.columns)).select(F.col("_side").alias("stream"), "host", "text")
    runs = written(names.join(realigned(host_boilerplate(streams, shared), "_k"), F.col("_stream") == F.col("_k")).select("_of", "runs"), "runs")
    discard(names, again, copied)
    # Pages with an article keep no open block, so that only what the arrays found inside is asked for.
    asked = rows.select("_row", F.when(F.size("inside") > 0, F.col("_art")).otherwise(F.col("_of")).alias("_of"))
    verdicts = written(asked.join(realigned(runs, "_of"), "_of").select("_row", "runs"), "verdicts")
    found = written(suffix.bit_words(verdicts.select(F.xxhash64("_row").alias("h"))), "judged")
    held, free = suffix.parted(rows.select("_row", "_id", "url", "inside", "open"), F.xxhash64("_row"), found)
    judged = held.join(realigned(verdicts, "_row"), "_row", "left").select("_id", "url", "inside", "open", "runs")
    judged = judged.unionByName(free.select("_id", "url", "inside", "open", F.lit(None).cast(verdicts.schema["runs"].dataType).alias("runs")))
    names = [key, "url", "text", "n_chars", "n_shared"]

    def run(batches):
        for b in batches:
            found = [settled(inside, r, open_, r) for inside, open_, r in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
            texts = [t for t, _ in found]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64()), pa.array([n for _, n in found], pa.int64())], names)

    return judged.mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long, n_shared long")

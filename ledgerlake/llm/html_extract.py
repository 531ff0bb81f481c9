"""Main text of web pages by removal of site templates.

Every element's subtree is hashed bottom-up while a page is parsed. Spark counts, per host, on how many
different pages each subtree stands; subtrees that recur across many of them are the site's template
and are deleted, whatever their tags say. Pages with equal main text count as one, so an
article that was copied many times is not taken for a template. What a page itself declares not to be
article text (navigation, forms, scripts, adverts, comments ...) goes as well.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import load, map_arrow, materialize, pick

#: A subtree is template if at least MIN_PAGES different pages of its host and SHARE of them have it.
MIN_PAGES, SHARE = 10, 0.5

# Element names of HTML by their kind.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noframes"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li",
         "main", "menu", "nav", "ol", "option", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"}
#: A start tag of the first kind ends an open element of the second, up to a boundary.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}

# What pages declare: tags, roles, and words in class or id that are no article text.
NOT_TEXT = {"head", "nav", "footer", "aside", "form", "noscript", "template", "object", "svg", "canvas", "button", "select", "dialog",
            "menu", "datalist", "audio", "video", "map"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}
WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "sidebar", "menu", "navbar",
         "nav", "navigation", "breadcrumb", "breadcrumbs", "footer", "cookie", "cookies", "consent", "notice", "popup", "modal",
         "newsletter", "subscribe", "share", "sharing", "social", "related", "recommended", "comment", "comments", "replies", "reply",
         "disqus", "login", "signup", "pagination", "skip", "banner", "masthead"}
#: Not article text only outside an article.
OUTSIDE = {"header"}

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*(?:"|\Z)|'[^']*(?:'|\Z))*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([a-z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I | re.S)
_SEED, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1


class Element:
    """An open or closed element; ``mark`` ends up as the hash of its subtree, ``within`` has the containers
    (article, main) that it stands in or is."""

    __slots__ = ("tag", "mark", "dropped", "within", "parent", "gone")

    def __init__(self, tag: str, dropped: bool, within: frozenset[str], parent: Element | None):
        self.tag, self.dropped, self.within, self.parent = tag, dropped, within, parent
        self.mark = xxhash.xxh64_intdigest(tag)
        self.gone: bool | None = None

    def add(self, value: int) -> None:
        self.mark = ((self.mark ^ value) * _SEED + 1 & _MASK) ^ self.mark >> 29


def _declared(tag: str, attributes: str, inside: bool) -> bool:
    """Whether a start tag says that its element is no article text."""
    if tag in NOT_TEXT or tag in OUTSIDE and not inside:
        return True
    if not attributes.strip():
        return False
    for name, *value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(value).lower()
        if name in ("class", "id") and tag not in ("html", "body", "article", "main"):
            words = set(re.split(r"[^a-z0-9]+", value))
            if words & WORDS or not inside and words & OUTSIDE:
                return True
        elif name in ("class", "id") and tag == "article" and set(re.split(r"[^a-z0-9]+", value)) & {"comment", "comments", "reply", "ad", "advert"}:
            return True
        elif name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def blocks(page: str) -> list[tuple[str, Element]]:
    """(text, innermost element) of each text block of a page's article, in page order. The article is
    what stands in ``article`` elements, else in ``main``, else in the body. An element of a long page costs
    its own tag and, if it ends others, those."""
    found: list[tuple[str, Element]] = []
    root = Element("", False, frozenset(), None)
    stack, text = [root], []
    counts: dict[str, int] = {}

    def flush() -> None:
        if text:
            joined = " ".join("".join(text).split())
            if joined:
                found.append((joined, stack[-1]))
            text.clear()

    def close(to: int) -> None:
        while len(stack) > to:
            done = stack.pop()
            counts[done.tag] -= 1
            stack[-1].add(done.mark)

    def innermost(tags: set[str], bounds: set[str]) -> int:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return i
            if stack[i].tag in bounds:
                break
        return 0

    def say(piece: str) -> None:
        if piece:
            top = stack[-1]
            if not piece.isspace():
                top.add(xxhash.xxh64_intdigest(" ".join(piece.split())))
            if not top.dropped:
                text.append(html.unescape(piece) if "&" in piece else piece)

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        if not m:
            break
        say(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in BLOCK:
                flush()
            if counts.get(tag):
                close(innermost({tag}, set()))
            continue
        if tag == "br":
            say(" ")
            continue
        if tag in RAW:
            stack[-1].add(xxhash.xxh64_intdigest(tag))
            end = re.compile(rf"</{tag}\s*(?:>|\Z)", re.I).search(page, at)
            at = end.end() if end else n
            continue
        if tag in BLOCK:
            flush()
            if counts.get("p") and (i := innermost({"p"}, {"table", "td", "th", "button"})):
                close(i)
            if tag in ENDS and (i := innermost(*ENDS[tag])):
                close(i)
        if tag in VOID or m[3].endswith("/"):
            stack[-1].add(xxhash.xxh64_intdigest(tag))
            continue
        top = stack[-1]
        within = top.within | {tag} if tag in ("article", "main") else top.within
        stack.append(Element(tag, top.dropped or _declared(tag, m[3], bool(top.within)), within, top))
        counts[tag] = counts.get(tag, 0) + 1
    say(page[at:])
    flush()
    close(1)
    for container in ("article", "main"):
        within = [(t, e) for t, e in found if container in e.within]
        if within:
            return within
    return found


def _marks(found: list[tuple[str, Element]]) -> set[int]:
    """Subtree hashes of all elements that hold a block."""
    out, seen = set(), set()
    for _, e in found:
        while e.parent is not None and id(e) not in seen:
            seen.add(id(e))
            out.add(_signed(e.mark))
            e = e.parent
    return out


def _deleted(element: Element, drop: set[int]) -> bool:
    """Whether the element or one around it is a template subtree."""
    chain = []
    while element.parent is not None and element.gone is None:
        chain.append(element)
        element = element.parent
    gone = bool(element.gone)
    for e in reversed(chain):
        gone = e.gone = gone or _signed(e.mark) in drop
    return gone


def _signed(mark: int) -> int:
    return mark - (1 << 64) if mark >> 63 else mark


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(host, marks array<long>): hashes of the subtrees that recur on that host's pages. ``pages``: (host, html).
    Distinct (host, subtree, page) rows and their counts are combined before each shuffle; a host of any
    size is spread over its subtrees."""
    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, seen, whole = [], [], []
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = blocks(page)
                own = _marks(found)
                hosts += [host] * (len(own) + 1)
                seen += [*own, 0]
                whole += [_signed(xxhash.xxh64_intdigest("\n".join(t for t, _ in found)))] * (len(own) + 1)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(seen, pa.int64()), pa.array(whole, pa.int64())],
                                             names=["host", "mark", "page"])

    # Mark 0 stands for the page itself.
    counts = (map_arrow(pages, marks, "host string, mark long, page long").distinct()
              .groupBy("host", "mark").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_pages))
    counts = materialize(counts, "op6-counts")
    total = counts.filter("mark = 0").select("host", F.col("n").alias("total"))
    return (counts.filter("mark != 0").join(total, "host").filter(F.col("n") >= share * F.col("total"))
            .groupBy("host").agg(F.collect_set("mark").alias("marks")))


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """(page_id, url, text) per row of ``pages``: the text blocks of the article, white space as one space, joined
    by two newlines.

    Null and empty pages have an empty text; pages without a host share one; ids may be null; repeated rows
    each give their own row; only page_id, url and html are read. A host's list of template subtrees
    holds at most 1 / share times the subtrees of a page.
    """
    slim = pick(pages, "page_id", "url", "html").select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
        F.coalesce(F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")).alias("host"))
    site = materialize(templates(slim.select("host", "html"), min_pages, share), "op6-templates").withColumnRenamed("host", "_host")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, marks in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                drop = set(marks or ())
                texts.append("\n\n".join(t for t, e in blocks(page) if not drop or not _deleted(e, drop)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = dict(slim.dtypes)["page_id"]
    paired = slim.join(site, F.col("host") == F.col("_host"), "left").select("page_id", "url", "html", "marks")
    return map_arrow(paired, keep, f"page_id {kind}, url string, text string")


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract(load(spark, sf_dir, "pages"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

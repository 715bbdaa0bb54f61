"""Main text of web pages by site-template removal.

Pass 1 parses every page, hashes the subtree of each block element (tag, class, id and
content) and counts in Spark with how many distinct articles of a host each hash occurs, so
copies of one article count once.  A hash with n of a host's m articles is template

* on pages without an ``article`` (or ``main``) element if n > 1 + sqrt(m): all of three, four of five;
* inside an article if n >= ``INSIDE`` + ``INSIDE_SHARE`` * m, whatever the size of the host: a sentence that
  many articles happen to share stays, a notice in half of them goes.  Where that has more than half of an
  article's text, the article is taken for an edited copy, and only what recurs with
  n >= ``COPIES`` + ``COPY_SHARE`` * m articles is deleted from it.

Pass 2 parses again and deletes template subtrees.  Of the rest it keeps the article: the ``article``
(else ``main``, else ``body``) elements without menus, headers, footers, sidebars, notices,
adverts, forms, scripts, styles and reader comments, which differ from page to page or stand on
hosts of a few articles.  What holds the article is never deleted.

The template table is written first, so Spark broadcasts it only when it is small and
otherwise joins by host, where a hot host's partition is split.

Edge cases: null or empty html gives an empty text; a null url has an empty host; broken
markup (unclosed tags, stray ends, cut-off entities) is read as browsers mostly do; white
space inside a block is one space; repeated rows stay rows; an empty table gives none.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import byte_slices, materialize, table
from lodestone.llm.urlrules import url_parts

INSIDE, INSIDE_SHARE = 4, 0.4
COPIES, COPY_SHARE = 8, 0.6

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']*+(?:"[^"<]*+"|'[^'<]*+'))*+[^>"']*+|[^>]*+)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""(?:^|\s)(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.IGNORECASE)

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
_RAW = frozenset("script style textarea title noscript iframe xmp".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_DROPPED = frozenset("head script style textarea title noscript iframe xmp nav header footer aside form template svg math button select datalist dialog menu object canvas audio video".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
_CLASSES = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banners?|cookies?|consent|gdpr|notices?|popup|modal|overlay|sidebar|menus?|nav|navbar|navigation|breadcrumbs?|masthead|header|footer"
    r"|comments?|disqus|replies|respond|share|sharing|social|related|newsletter|subscribe|subscription|signup|login|widgets?|toolbar|pager|pagination)(?=$|[\s_-])",
    re.IGNORECASE,
)
_COMMENTS = re.compile(r"(?:^|[\s_-])(?:comments?|disqus|replies|respond)(?=$|[\s_-])", re.IGNORECASE)
#: A start tag of the key closes an open element of the values.
_CLOSES = {
    **{t: frozenset({"p"}) for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul".split()},
    "li": frozenset({"li", "p"}),
    "dt": frozenset({"dt", "dd", "p"}),
    "dd": frozenset({"dt", "dd", "p"}),
    "tr": frozenset({"tr", "td", "th", "p"}),
    "td": frozenset({"td", "th", "p"}),
    "th": frozenset({"td", "th", "p"}),
    "thead": frozenset({"tr", "td", "th", "p"}),
    "tbody": frozenset({"thead", "tr", "td", "th", "p"}),
    "option": frozenset({"option"}),
}
_SCOPES = frozenset("html body table article main section div ul ol dl nav aside header footer form blockquote".split())


class Node:
    """An element: ``children`` are strings and nodes."""

    __slots__ = ("tag", "mark", "dropped", "comments", "children", "hash")

    def __init__(self, tag: str, attributes: str):
        self.tag, self.children, self.hash, self.comments = tag, [], 0, False
        self.mark, self.dropped = "", tag in _DROPPED
        if attributes:
            known = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            if known:
                named = f"{known.get('class', '')} {known.get('id', '')}"
                self.mark = f"{named} {known.get('role', '')}"
                self.comments = tag not in ("body", "html") and bool(_COMMENTS.search(named))
                hidden = "hidden" in known or known.get("aria-hidden", "").lower() == "true"
                self.dropped |= hidden or known.get("role", "").lower() in _ROLES or (tag not in ("body", "html", "article", "main") and bool(_CLASSES.search(named))) or self.comments


def parse(page: str) -> Node:
    """Tree of a page; ends are implied as browsers imply them, and never fail."""
    root = Node("#root", "")
    stack, at, n = [root], 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            stack[-1].children.append(page[at:])
            break
        if m.start() > at:
            stack[-1].children.append(page[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if tag in ("article", "main"):  # an unclosed menu or advert before the article doesn't hold it
            k = next((k for k, x in enumerate(stack) if x.dropped and x.tag not in ("article", "main")), None)
            if k is not None and not any(x.comments for x in stack):
                del stack[k:]
        closes = _CLOSES.get(tag)
        if closes:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in closes:
                    del stack[k:]
                    break
                if stack[k].tag in _SCOPES:
                    break
        node = Node(tag, m[3])
        stack[-1].children.append(node)
        if tag in _VOID:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}\b[^>]*>", re.IGNORECASE).search(page, at)
            node.children.append(page[at : end.start() if end else n])
            at = end.end() if end else n
            continue
        if not m[3].rstrip().endswith("/") or tag in _INLINE or tag in _SCOPES or tag == "p":
            stack.append(node)
    return root


def _walk(root: Node) -> Iterator[tuple[Node, bool]]:
    """(node, leaving) in document order."""
    todo: list[tuple[Node, bool]] = [(root, False)]
    while todo:
        node, leaving = todo.pop()
        yield node, leaving
        if not leaving:
            todo.append((node, True))
            todo.extend((c, False) for c in reversed(node.children) if not isinstance(c, str))


def hash_subtrees(root: Node) -> None:
    """Set ``hash`` of every node, from the leaves up."""
    import xxhash

    for node, leaving in _walk(root):
        if leaving:
            parts = [node.tag, node.mark, *(" ".join(c.split()) if isinstance(c, str) else f"<{c.hash}>" for c in node.children)]
            node.hash = xxhash.xxh64_intdigest("\x00".join(p for p in parts if p)) >> 1


def block_hashes(root: Node) -> set[int]:
    """Hashes of the block elements that hold anything."""
    return {x.hash for x, leaving in _walk(root) if not leaving and x.children and x.tag not in _INLINE and x.tag not in ("#root", "html", "head", "body")}


Hashes = frozenset[int] | set[int]


def main_text(root: Node, template: Hashes = frozenset(), inside: Hashes = frozenset(), strong: Hashes = frozenset()) -> str:
    """Blocks of the article joined by line ends; the templates are those of pages without one, of articles, and of edited copies."""
    tags = {x.tag for x, leaving in _walk(root) if not leaving and not x.dropped}
    main = next((t for t in ("article", "main") if t in tags), None)
    text, deleted = _text_without(root, main, inside if main else template)
    if main and deleted:
        whole, _ = _text_without(root, main, strong)
        if 2 * len(text) < len(whole):
            return whole
    return text


def _text_without(root: Node, main: str | None, template: Hashes) -> tuple[str, bool]:
    """Text of the ``main`` elements (None: of the page) without the template, and whether any was deleted."""
    deleted = False
    blocks: list[str] = []
    inline: list[str] = []

    def flush() -> None:
        text = " ".join(_html.unescape("".join(inline)).split())
        if text:
            blocks.append(text)
        inline.clear()

    # (node or text, inside the article)
    todo: list[tuple[Node | str | None, bool]] = [(root, main is None)]
    while todo:
        x, inside = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            if inside:
                inline.append(x)
        elif x.dropped:
            if x.tag not in _INLINE:
                flush()
        elif x.tag == "br":
            inline.append(" ")
        elif inside and x.hash in template and (main or x.tag not in ("body", "html")):
            deleted = True
            flush()
        else:
            block = x.tag not in _INLINE
            if block:
                flush()
                todo.append((None, False))
            within = inside or x.tag == main
            todo.extend((c, within) for c in reversed(x.children))
    flush()
    return "\n".join(blocks), deleted


def count_subtrees(pages: DataFrame) -> DataFrame:
    """(host, hash, n): distinct article texts of the host that have the subtree; hash -1 counts the host's article texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in byte_slices(batches, "html"):
            seen: set[tuple[str, int, int]] = set()
            for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                root = parse(page)
                hash_subtrees(root)
                article = xxhash.xxh64_intdigest(main_text(root)) >> 1
                seen.update((host, h, article) for h in block_hashes(root))
                seen.add((host, -1, article))
            hosts, hashes, articles = zip(*seen, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64()), pa.array(articles, pa.int64())], ["host", "hash", "article"])

    return pages.select("host", "html").mapInArrow(run, "host string, hash long, article long").groupBy("host", "hash").agg(F.count_distinct("article").alias("n"))


_SETS = ("template", "inside", "strong")


def site_templates(counts: DataFrame) -> DataFrame:
    """(host, template, inside, strong), each an array<long>."""
    sizes = counts.where("hash = -1").select("host", F.col("n").alias("articles"))
    at_least = lambda least, share: F.col("n") >= least + share * F.col("articles")
    rules = (F.col("n") > 1 + F.sqrt("articles"), at_least(INSIDE, INSIDE_SHARE), at_least(COPIES, COPY_SHARE))
    many = counts.where("hash >= 0").join(sizes, "host").where(rules[0] | rules[1])
    # A host's lists grow with the root of its articles: each entry is with more than sqrt(articles) of them.
    return many.groupBy("host").agg(*(F.collect_list(F.when(r, F.col("hash"))).alias(c) for c, r in zip(_SETS, rules, strict=True)))


def extract(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    host, _ = url_parts(F.col("url"))
    rows = pages.select("page_id", "url", F.coalesce(host, F.lit("")).alias("host"), F.coalesce("html", F.lit("")).alias("html"))
    # No template has fewer than three articles.
    counts = materialize(count_subtrees(rows).where("n > 2 OR hash = -1"), "subtrees")
    templates = materialize(site_templates(counts), "templates")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[set[int]]] = {}
        for b in byte_slices(batches, "html"):
            texts = []
            hosts = b.column("host").to_pylist()
            for k, page in enumerate(b.column("html").to_pylist()):
                if hosts[k] not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[hosts[k]] = [set(b.column(c)[k].as_py() or ()) for c in _SETS]
                root = parse(page)
                hash_subtrees(root)
                texts.append(main_text(root, *known[hosts[k]]))
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    joined = rows.join(templates, "host", "left").select("page_id", "url", "host", "html", *_SETS)
    out = joined.mapInArrow(run, f"page_id {kind}, url string, text string")
    return out.withColumn("n_chars", F.length("text").cast("long"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))

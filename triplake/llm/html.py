"""Main text of web pages, without what a site repeats on its pages.

Every page is parsed into a tree, and each element's subtree is hashed. Spark
counts the hashes per host; a subtree that recurs on many different pages of its
host belongs to the site's template and is deleted. Elements that are boilerplate
by their kind or name (menus, footers, adverts ...) go on any page, since a host
may have one page only. What is left of the article, or of the body where there
is none, is read block by block.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from triplake.llm.common import other_columns, per_row, stored, text_digest, unused

#: A template subtree stands on at least so many different pages of its host.
TEMPLATE_PAGES = 5

# Kinds of elements.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold a text of their own; an article's are never taken for a template.
TEXT_BLOCK = frozenset(
    "p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th tr tbody table figcaption caption".split()
)
GONE = frozenset(
    "head script style noscript template iframe svg canvas object embed nav footer aside form "
    "button select option textarea input dialog menu audio video map noembed noframes xmp "
    "title".split()
)
#: Opening one of these ends an open paragraph.
ENDS_P = BLOCK - frozenset("body html caption tbody td tfoot th thead tr legend summary".split())
#: Opening the first ends an open one of the second, up to the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
GONE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu "
    "menubar toolbar".split()
)
#: What an element is called that is no part of an article.
GONE_NAMES = frozenset(
    "nav navbar navigation menu menus submenu sidebar sidebars footer header masthead topbar "
    "toolbar ad ads advert adverts advertisement advertising adsense adsbygoogle banner cookie "
    "cookies consent gdpr notice notices popup modal overlay promo promotion sponsor sponsored "
    "sponsors newsletter subscribe subscription signup login comment comments commentlist "
    "respond disqus replies discussion share sharing social related recommended breadcrumb "
    "breadcrumbs pagination pager widget widgets skip copyright".split()
)
#: Of these, the words that an article uses for parts of its own.
ARTICLE_NAMES = frozenset("header masthead discussion respond overlay skip copyright".split())
COMMENT_NAMES = frozenset("comment comments commentlist disqus replies".split())
#: Words that say nothing of what an element holds, beside those above.
FILLERS = frozenset(
    "area article bar block bottom box button buttons col column container content entry feed "
    "form group holder icons inner item items left link links list main outer page panel post "
    "posts primary right row secondary section site slot text the this thread top unit wrap "
    "wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

_TAG = re.compile(
    r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_ATTRIBUTE = re.compile(
    r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?"
)
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    attributes: dict[str, str]
    parent: Element | None
    children: list = field(default_factory=list)  # elements and strings
    holds_main: bool = False
    digest: int = 0


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        value = next((v for v in m.groups()[1:] if v is not None), "")
        out.setdefault(m[1].lower(), html.unescape(value))
    return out


def parse(page: str) -> Element:
    """The tree of a page, however its tags are nested; depth has no limit."""
    root = top = Element("#root", {}, None)
    at, size = 0, len(page)

    def close(names: set[str], until: set[str]) -> None:
        """End the nearest open element of these names, and all within it."""
        nonlocal top
        node = top
        while node.parent is not None and node.tag not in until:
            if node.tag in names:
                top = node.parent
                return
            node = node.parent

    while at < size:
        begin = page.find("<", at)
        if begin < 0:
            begin = size
        if begin > at:
            top.children.append(html.unescape(page[at:begin]))
        if begin >= size:
            break
        if page.startswith("<!--", begin):
            end = page.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        following = page[begin + 1 : begin + 2]
        if following in ("!", "?") or page.startswith("</", begin) and not page[begin + 2 : begin + 3].isalpha():
            end = page.find(">", begin)
            at = size if end < 0 else end + 1
            continue
        if not (following == "/" or following.isascii() and following.isalpha()):
            top.children.append("<")
            at = begin + 1
            continue
        m = _TAG.match(page, begin) or _LOOSE_TAG.match(page, begin)
        if m is None:
            break  # a tag that never ends
        at, tag = m.end(), m[2].lower()
        if m[1]:
            if tag == "br":
                top.children.append(" ")
            else:
                close({tag}, set())
            continue
        if tag in ENDS_P:
            close({"p"}, {"table", "button"})
        if tag in ENDS:
            close(*ENDS[tag])
        node = Element(tag, _attributes(m[3]), top)
        top.children.append(node)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            node.children.append(page[at : end.start() if end else size])
            at = end.end() if end else size
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in BLOCK - VOID:
            top = node
    return root


def _says(name: str, wanted: frozenset[str]) -> bool:
    """Whether a whole class or id says that an element is of a wanted kind: it has
    such a word, and beside it only others of ``GONE_NAMES`` and fillers."""
    parts = [p.lower() for p in _NAME_PARTS.findall(name) if len(p) > 1]
    return any(p in wanted for p in parts) and all(p in GONE_NAMES or p in FILLERS for p in parts)


def _named_gone(node: Element, in_main: bool) -> bool:
    """Whether class or id say that an element goes.

    They count as a whole (``comment-list``, not ``share-price``). Ids are often
    made from headings, so within the article, and for paragraphs and the like,
    only ids of comments count, and headings' ids never.
    """
    wanted = GONE_NAMES - ARTICLE_NAMES if in_main else GONE_NAMES
    if any(_says(name, wanted) for name in node.attributes.get("class", "").split()):
        return True
    if node.tag in HEADINGS:
        return False
    wanted = COMMENT_NAMES if in_main or node.tag in TEXT_BLOCK else GONE_NAMES
    return any(_says(name, wanted) for name in node.attributes.get("id", "").split())


def _unseen(node: Element) -> bool:
    """Whether role or style say that an element is no part of what a page says."""
    return (
        node.attributes.get("role", "").lower() in GONE_ROLES
        or "hidden" in node.attributes
        or node.attributes.get("aria-hidden") == "true"
        or "display:none" in node.attributes.get("style", "").replace(" ", "").lower()
    )


def _is_of_comments(node: Element) -> bool:
    names = node.attributes.get("class", "").split() + node.attributes.get("id", "").split()
    return any(_says(name, COMMENT_NAMES) for name in names)


def is_boilerplate(node: Element, in_main: bool) -> bool:
    """Whether an element goes by its kind or name. What holds the article, or most
    of a page without one, stays, and so does the heading of an article."""
    if node.holds_main or node.tag in ("html", "body", "#root"):
        return False
    if node.tag in GONE:
        return True
    if node.tag == "header":
        return not in_main
    if not node.attributes:
        return False
    return _unseen(node) or _named_gone(node, in_main)


def _mark(root: Element) -> list[Element]:
    """Mark articles and all around them; without an article, elements that hold
    most of the page's text. Returns all elements, parents first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Element)]
    for node in order:
        main = node.tag in ("article", "main") or node.attributes.get("role") == "main"
        if main and not (node.attributes and (_unseen(node) or _named_gone(node, True))):
            _holds(node)
    if not root.holds_main:
        for node in _wrappers(order):
            _holds(node)
    return order


def _holds(node: Element | None) -> None:
    while node is not None and not node.holds_main:
        node.holds_main = True
        node = node.parent


def _wrappers(order: list[Element]) -> list[Element]:
    """Forms and named elements around more than half of a page's text, which so
    are its layout; comments may be longer than what they are about."""
    named = [
        n for n in order
        if n.tag == "form" or n.tag not in GONE and n.attributes and _named_gone(n, False)
    ]
    if not named:
        return []
    sizes: dict[Element, int] = {}
    for node in reversed(order):
        gone = node.tag in GONE and node.tag != "form"
        if gone or node.attributes and (_unseen(node) or _is_of_comments(node)):
            sizes[node] = 0
            continue
        sizes[node] = sum(
            sizes[c] if isinstance(c, Element) else len("".join(c.split())) for c in node.children
        )
    return [n for n in named if 2 * sizes[n] > sizes[order[0]]]


def _hash(order: list[Element]) -> None:
    """Digest of each subtree: tag, class, words and children; spacing aside."""
    for node in reversed(order):
        state = xxhash.xxh3_64(f"{node.tag} {node.attributes.get('class', '')}")
        for child in node.children:
            if isinstance(child, Element):
                state.update(child.digest.to_bytes(8, "little"))
            else:
                words = " ".join(child.split())
                if words:
                    state.update(words)
        node.digest = state.intdigest()


def _signed(number: int) -> int:
    return number - (1 << 64) if number >= 1 << 63 else number


def _content(root: Element) -> list[Element]:
    """Main elements, or else the outermost articles, or else the whole page."""
    for wanted in ("main", "article"):
        found, stack = [], [(root, False)]
        while stack:
            node, inside = stack.pop()
            if node is not root and is_boilerplate(node, inside):
                continue
            main = node.tag == wanted or wanted == "main" and node.attributes.get("role") == "main"
            if main and node.holds_main:
                found.append(node)
                continue
            stack += [(c, inside) for c in reversed(node.children) if isinstance(c, Element)]
        if found:
            return found
    return [root]


def _blocks(start: Element, template: set[int], in_main: bool) -> list[str]:
    """Texts between block edges, in page order, white space made single."""
    blocks, words = [], []

    def flush() -> None:
        text = " ".join("".join(words).split())
        if text:
            blocks.append(text)
        words.clear()

    stack: list = [start]
    while stack:
        node = stack.pop()
        if node is None:
            flush()
        elif isinstance(node, str):
            words.append(node)
        else:
            if node is not start:
                if is_boilerplate(node, in_main):
                    continue
                if _signed(node.digest) in template and deletable(node, in_main):
                    continue
            if node.tag == "br":
                words.append(" ")
            elif node.tag in BLOCK:
                flush()
                stack.append(None)
            stack += reversed(node.children)
    flush()
    return blocks


def deletable(node: Element, in_main: bool) -> bool:
    """Elements that may be a template: blocks that do not hold the article, and
    within the article only those that are more than a text of it."""
    if node.tag not in BLOCK or node.holds_main or node.tag in ("html", "body"):
        return False
    return not (in_main and node.tag in TEXT_BLOCK)


def subtrees(page: str | None) -> tuple[int, list[int]]:
    """Digest of the longest block of the article, and of each subtree that may
    be a template."""
    root = parse(page or "")
    _hash(_mark(root))
    blocks = [b for start in _content(root) for b in _blocks(start, set(), start.tag != "#root")]
    found, stack = set(), [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.tag in ("article", "main") and node.holds_main
        if deletable(node, inside):
            found.add(_signed(node.digest))
        stack += [(c, inside) for c in node.children if isinstance(c, Element)]
    longest = max(blocks, key=len, default="")
    return _signed(xxhash.xxh3_64_intdigest(longest)), sorted(found)


def main_text(page: str | None, template: set[int]) -> tuple[str, int]:
    """Blocks of the article, joined by an empty line, and deleted subtrees."""
    root = parse(page or "")
    order = _mark(root)
    if template:
        _hash(order)
    blocks: list[str] = []
    for start in _content(root):
        blocks += _blocks(start, template, start.tag != "#root")
    hit = sum(_signed(n.digest) in template for n in order) if template else 0
    return "\n\n".join(blocks), hit


def template_subtrees(pages: DataFrame) -> DataFrame:
    """host, digest of the subtrees that recur on many pages of a host.

    ``pages`` has host, main (digest of the article's longest block) and subtrees. Pages with
    the same longest block count once, so copies of an article do not make it a
    template. Counting falls together before it is shuffled.
    """
    return (
        pages.filter(F.col("host") != "").select("host", "main", F.explode("subtrees").alias("digest"))
        .groupBy("host", "digest", "main").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("host", "digest").agg(F.count(F.lit(1)).alias("pages"))
        .filter(F.col("pages") >= TEMPLATE_PAGES)
        .select("host", "digest")
    )


def extract(
    df: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    text_col: str = "text",
    removed_col: str = "n_template",
) -> DataFrame:
    """Add the main text and how many template subtrees the page has.

    The host is taken from the URL; pages without one have no template. NULL and
    empty html give an empty text. Other columns stay apart from the html; rows
    alike in id, URL and html get the same text. Nothing else is dropped.
    """
    rest = other_columns(df, [html_col, text_col, removed_col])
    row = unused("row", df.columns)
    host = F.lower(
        F.regexp_extract(
            F.coalesce(F.col(f"`{url_col}`"), F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1
        )
    )
    pages = df.select(
        F.struct(*[F.col(f"`{c}`") for c in rest]).alias(row), host.alias("host"),
        F.col(f"`{html_col}`").alias("page"),
    ).withColumns(dict(zip(("p1", "p2"), text_digest(F.col("page")))))
    fields = [
        T.StructField("main", T.LongType(), False),
        T.StructField("subtrees", T.ArrayType(T.LongType(), False), False),
    ]
    found = stored(
        per_row(
            pages.select("host", "p1", "p2", "page"), ["page"], fields,
            lambda: lambda rows: [subtrees(p) for (p,) in rows], keep=["host", "p1", "p2"],
        ),
        "page-subtrees",
    )
    template = stored(template_subtrees(found), "template-subtrees")
    # Pages with the same html on the same host share one row of deletions.
    hits = (
        found.dropDuplicates(["host", "p1", "p2"])
        .select("host", "p1", "p2", F.explode("subtrees").alias("digest"))
        .join(template, ["host", "digest"])
        .groupBy("host", "p1", "p2").agg(F.collect_set("digest").alias("template"))
    )
    hits = stored(hits, "page-templates")
    joined = pages.join(hits, ["host", "p1", "p2"], "left").select(row, "page", "template")
    out = per_row(
        joined, ["page", "template"],
        [T.StructField(text_col, T.StringType(), False), T.StructField(removed_col, T.IntegerType(), False)],
        lambda: lambda rows: [main_text(p, set(t or ())) for p, t in rows], keep=[row],
    )
    return out.select(*[F.col(f"{row}.`{c}`").alias(c) for c in rest], text_col, removed_col)

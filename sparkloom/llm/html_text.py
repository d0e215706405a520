"""HTML extraction by composite text density.

A page is parsed into a tree of elements. Elements that never hold the main
text are left out by tag, role, class or id. For every element that is left the
composite text density is its characters per tag, adjusted by the share of
link characters and link tags within it and in the body. The element whose
children's densities have the greatest sum is the core of the main text, and the
smallest density on its path to the body is the threshold. The core is kept
whole. Blocks beside the path are kept, each cut down in the same way, where they
meet the threshold, with the headings before them.
"""

from __future__ import annotations

import html as _html
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import values

#: Elements by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ITEMS = {"li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select datalist")}
NEVER = frozenset("script style noscript template iframe object embed svg canvas audio video map nav header footer aside menu button select option input textarea label dialog head title".split())
NEVER_ROLE = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NEVER_NAME = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation menu menubar header masthead footer sidebar aside breadcrumb breadcrumbs cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe signup login share sharing social related recommended comment comments reply replies respond discussion disqus widget toolbar pagination pager skip hidden".split()
)
#: Words of place that a name may have beside those.
PLACES = frozenset("site main page left right top bottom box bar list links".split())
KEPT = frozenset("html body article main".split())
#: Elements that may wrap a whole page.
WRAPS = frozenset("form fieldset".split())
#: Elements that stand at the main text.
MARKS = frozenset("article main h1".split())

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/]|\Z)""", re.I)
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "up", "inside", "out", "named", "chars", "tags", "link_chars", "link_tags", "density", "total", "best")

    def __init__(self, tag: str, up, out: bool = False, named: bool = False):
        self.tag, self.up, self.out, self.named, self.inside = tag, up, out, named, []


def _left_out(tag: str, attributes: str) -> bool:
    if tag in NEVER:
        return True
    if not attributes:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "role" and value in NEVER_ROLE:
            return True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
            return True
    return False


def _named(tag: str, attributes: str) -> bool:
    """If it is a form, or a whole name of its class or id says that it is not main text: ``site-footer``, but not ``no-footer``."""
    if tag in WRAPS:
        return True
    if not attributes or tag in KEPT:
        return False
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id"):
            for token in "".join(values).lower().split():
                parts = {w for w in re.split(r"[^a-z]+", token) if w}
                if parts & NEVER_NAME and parts <= NEVER_NAME | PLACES:
                    return True
    return False


def _leave_out_named(root: Node) -> None:
    """Leave out the named elements, but none that holds most of the text beside links and all that marks the main text."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        if not x.out:
            order.append(x)
            stack += [c for c in x.inside if isinstance(c, Node)]
    held = {}
    for x in reversed(order):
        chars, marks = 0, int(x.tag in MARKS)
        for c in x.inside:
            if not isinstance(c, Node):
                chars += len(_SPACE.sub("", c))
            elif not c.out:
                chars, marks = chars + held[c][0], marks + held[c][1]
        held[x] = (0 if x.tag == "a" else chars, marks)
    most, marks = held[root]
    for x in order:
        if x.up is not None and x.up.out:
            x.out = True
        elif x.named and (2 * held[x][0] <= most or held[x][1] < marks):
            x.out = True


def parse(page: str) -> Node:
    """The tree of a page; what it does not close is closed as HTML's rules imply."""
    root = Node("html", None)
    at, here, open_ = 0, root, [root]
    n = len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        if not m:
            here.inside.append(page[at:])
            break
        if m.start() > at:
            here.inside.append(page[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if m[1]:
            if tag in VOID:
                continue
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == tag:
                    del open_[i:]
                    break
                if tag in INLINE and open_[i].tag not in INLINE:
                    break  # the end of an inline element does not close a block
            here = open_[-1]
            continue
        if tag in ("html", "body") and any(x.tag == tag for x in open_):
            continue
        closes, within = ("p", "") if tag in CLOSES_P else ITEMS.get(tag, ("", ""))
        if tag in HEADINGS and here.tag in HEADINGS:
            open_.pop()
        if closes:
            limit = within.split() if within else ["td", "th", "button", "table", "object", "body", "html"]
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag in closes.split():
                    del open_[i:]
                    break
                if open_[i].tag in limit or (not within and open_[i].tag not in INLINE and open_[i].tag != "p"):
                    break
        here = open_[-1]
        # The header of an article holds its title; that of a page does not.
        titled = tag == "header" and any(x.tag == "article" for x in open_)
        new = Node(tag, here, here.out or _left_out("div" if titled else tag, m[3]), _named(tag, m[3]))
        here.inside.append(new)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}[\s/>]|\Z", re.I).search(page, at)
            if end.start() > at:
                new.inside.append(page[at : end.start()])
            close = page.find(">", end.start())
            at = n if close < 0 else close + 1
        elif tag not in VOID and not m[3].rstrip().endswith("/") or tag in ("p", "div", "span", "b", "a"):
            open_.append(new)
            here = new
    _leave_out_named(root)
    return root


def _measure(root: Node) -> list[Node]:
    """Characters and tags of every element that is not left out; returns them, an element after its children."""
    order, stack = [], [root]
    while stack:
        x = stack.pop()
        if not x.out:
            order.append(x)
            stack += [c for c in x.inside if isinstance(c, Node)]
    order.reverse()
    for x in order:
        x.chars = x.tags = x.link_chars = x.link_tags = 0
        for c in x.inside:
            if not isinstance(c, Node):
                x.chars += len(_SPACE.sub("", c))
            elif not c.out:
                x.chars += c.chars
                x.tags += c.tags + 1
                x.link_chars += c.link_chars
                x.link_tags += c.link_tags + (c.tag == "a")
        if x.tag == "a":
            x.link_chars = x.chars
    return order


def _density(x: Node, body: Node) -> float:
    """Composite text density: characters per tag, less where links prevail."""
    if not x.chars:
        return 0.0
    tags, links, link_tags = max(1, x.tags), max(1, x.link_chars), max(1, x.link_tags)
    base = math.log(x.chars / max(1, x.chars - x.link_chars) * x.link_chars + body.link_chars / max(1, body.chars) * x.chars + math.e)
    return x.chars / tags * max(0.0, math.log(max(1.0, x.chars / links * tags / link_tags), max(base, 1.0 + 1e-9)))


def _path(top: Node) -> list[Node]:
    """From the core of ``top`` up to it. An element that holds no block is a paragraph; what holds it is the core."""
    core = top.best
    while core is not top and not any(isinstance(c, Node) and not c.out and c.tag not in INLINE for c in core.inside):
        core = core.up
    path = [core]
    while path[-1] is not top:
        path.append(path[-1].up)
    return path


def main_element(root: Node) -> Node:
    """The body, in which all blocks that are not of the main text are now left out."""
    order = _measure(root)
    body = next((x for x in order if x.tag == "body"), root)
    for x in order:
        x.density = _density(x, body)
        inner = [c for c in x.inside if isinstance(c, Node) and not c.out]
        x.total = sum(c.density for c in inner)
        x.best = max([c.best for c in inner] + [x] * (x.tag not in INLINE), key=lambda c: c.total, default=x)
    if not body.best.total:
        return body
    threshold = min(x.density for x in _path(body))
    todo = [body]
    while todo:
        path = _path(todo.pop())
        for inner, x in zip(path, path[1:]):
            headed = False
            for c in reversed(x.inside):
                if not isinstance(c, Node) or c.out or c.tag in INLINE or c.tag in VOID:
                    continue
                if c is inner:
                    headed = True
                elif c.tag in HEADINGS:
                    c.out = not headed
                elif c.density >= threshold and c.chars > 2 * c.link_chars:
                    headed = True
                    todo.append(c)
                else:
                    headed, c.out = False, True
    return body


def main_text(page: str) -> str:
    """The blocks of the main text, one line each."""
    if not page:
        return ""
    top = main_element(parse(page))
    blocks, words = [], []

    def end():
        text = _SPACE.sub(" ", _html.unescape("".join(words))).strip()
        if text:
            blocks.append(text)
        words.clear()

    stack: list = [top]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif not isinstance(x, Node):
            words.append(x)
        elif x.out:
            continue
        elif x.tag in ("br", "hr"):
            words.append(" ")
        else:
            block = x.tag not in INLINE
            if block:
                end()
                stack.append(None)
            stack += reversed(x.inside)
    end()
    return "\n".join(blocks)


def extract_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, from its whole html.

    Character references are decoded, white space inside a block is one space,
    blocks come in page order with a line feed between. Null or empty html, or a
    page without main text: empty text, 0 characters. Null ids and repeated rows
    stay. Empty table: no rows. Other columns are ignored. A long page takes
    memory in proportion to it and no more; pages do not move between tasks.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).alias("html"))

    def extract(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(h) for h in values(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(extract, "page_id long, url string, text string, n_chars long")

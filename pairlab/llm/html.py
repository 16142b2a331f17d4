"""Main text of web pages by scoring a tree of elements."""

from __future__ import annotations

import html as references
import re

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairlab.llm.arrow import batch_of, map_batches

# Fixed values of the HTML standard and of usual page design.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
BLOCKS = {
    "address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "dialog", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr",
    "html", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
    "tfoot", "th", "thead", "tr", "ul",
}
CLOSES_P = BLOCKS - {"caption", "td", "th", "tr", "tbody", "thead", "tfoot", "body", "html"}
UNWANTED = {
    "nav", "header", "footer", "aside", "form", "button", "select", "input", "label", "fieldset", "dialog", "menu",
    "svg", "canvas", "object", "audio", "video", "head", "search",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
SECTIONS = {"div", "section"}
PARAGRAPHS = {"p", "pre", "td", "blockquote", "li", "dd", "h1", "h2", "h3", "h4", "h5", "h6", "#text"}
UNWANTED_NAMES = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|adbox|adslot|banner|sponsor\w*|promo\w*|popup|modal|cookies?|consent|gdpr|notices?|"
    r"alert|sidebar|side|menu|nav|navbar|navigation|breadcrumbs?|header|masthead|footer|comments?|commentlist|replies|reply|"
    r"disqus|respond|discussion|share|sharing|social|related|recommended|recommendations|newsletter|subscribe|signup|login|"
    r"search|pagination|pager|widget|toolbar|skip|hidden)(?:$|[\s_-])",
    re.I,
)
# Names that only say what the page has beside the element, or which builder made it.
BESIDE = re.compile(r"(?<![^\s_-])(?:has|no|without|with|elementor)-[\w-]+|(?<![^\s_])[\w]+-(?:open|closed)(?!\S)", re.I)
UNWANTED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "menu", "form"}
MARK = re.compile(r"<(?:!--|[!?]|(/?)([a-zA-Z][^\s/>]*))")
BETWEEN = re.compile(r"[\s/]*")
NAME = re.compile(r"=?[^\s/>=]*")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s>]*")
SPACES = re.compile(r"\s+")
# Elements that a start tag of the same kind ends, unless one of the second set stands between. Fixed values.
SCOPES = (
    ({"p"}, {"td", "th", "button", "object"}),
    ({"li"}, {"ul", "ol", "menu"}),
    ({"dt", "dd"}, {"dl"}),
    ({"td", "th"}, {"tr", "table"}),
    ({"tr"}, {"table"}),
)
SCOPED = set().union(*(names | fence for names, fence in SCOPES))
Attributes = list[tuple[str, str]]


def attributes_at(page: str, at: int) -> tuple[Attributes, int, bool]:
    """(attributes, place after the tag, whether it ends in a slash) of a tag whose name ends at ``at``. Quotes count only after
    an equals sign; one that is never closed is an ordinary character."""
    found: Attributes = []
    while True:
        begin = at
        at = BETWEEN.match(page, at).end()
        if at >= len(page) or page[at] == ">":
            return found, min(at + 1, len(page)), at > begin and page[at - 1] == "/"
        name = NAME.match(page, at)
        at = name.end()
        value, equals = "", EQUALS.match(page, at)
        if equals:
            at = equals.end()
            quote = page[at : at + 1]
            close = page.find(quote, at + 1) if quote in ('"', "'") else -1
            if close >= 0:
                value, at = page[at + 1 : close], close + 1
            else:
                value = BARE.match(page, at)[0]
                at += len(value)
        found.append((name[0].lower(), value))


class Node:
    __slots__ = (
        "name", "attributes", "parent", "children", "points", "score", "unwanted", "doubtful", "length", "linked", "holders",
    )

    def __init__(self, name: str, attributes: Attributes, parent: Node | None):
        self.name, self.attributes, self.parent = name, attributes, parent
        self.children: list[Node | str] = []
        self.points, self.score, self.length, self.linked = (0.0, 0.0, 0.0), 0.0, 0, 0
        # The innermost open element of each scope; shared with the parent where nothing changes.
        self.holders: tuple[Node | None, ...] = parent.holders if parent else (None,) * len(SCOPES)
        if name in SCOPED:
            self.holders = tuple(
                self if name in names else None if name in fence else held
                for (names, fence), held in zip(SCOPES, self.holders)
            )
        self.unwanted = name in UNWANTED or name in RAW
        self.doubtful = name == "form"  # unwanted, unless the page's text stands in it
        if attributes and (self.doubtful or not self.unwanted) and name not in ("html", "body", "article", "main"):
            if _unwanted_attributes(attributes):
                self.unwanted, self.doubtful = True, False
            elif not self.unwanted and _unwanted_names(attributes):
                self.unwanted = self.doubtful = True


def _unwanted_names(attributes: Attributes) -> bool:
    return any(name in ("class", "id") and UNWANTED_NAMES.search(BESIDE.sub(" ", value)) for name, value in attributes)


def _unwanted_attributes(attributes: Attributes) -> bool:
    for name, value in attributes:
        if name == "hidden" or (name == "role" and value.lower() in UNWANTED_ROLES):
            return True
        if (name == "aria-hidden" and value == "true") or (name == "style" and re.search(r"display\s*:\s*none", value)):
            return True
    return False


def parse(page: str) -> Node:
    """Tree of a page; end tags that open nothing are skipped, open elements end with their parents. Every character is
    looked at a bounded number of times."""
    root = node = Node("#root", [], None)
    at, end, opened = 0, len(page), {}
    while at < end:
        mark = MARK.search(page, at)
        if mark is None:
            node.children.append(page[at:])
            break
        if mark.start() > at:
            node.children.append(page[at : mark.start()])
        if mark[2] is None:
            sign = "-->" if mark[0] == "<!--" else ">"
            close = page.find(sign, mark.end())
            at = end if close < 0 else close + len(sign)
            continue
        name = mark[2].lower()
        attributes, at, closed = attributes_at(page, mark.end())
        if mark[1]:
            if name == "p" and not opened.get("p"):
                node.children.append(Node("p", [], node))
            elif opened.get(name):
                while node.name != name:
                    opened[node.name] -= 1
                    node = node.parent
                opened[name] -= 1
                node = node.parent
            continue
        if name in CLOSES_P:
            node = _leave(node, 0, opened)
        for k in (1, 2, 3, 4):
            if name in SCOPES[k][0]:
                node = _leave(node, k, opened)
        child = Node(name, attributes, node)
        node.children.append(child)
        if name in RAW:
            close = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = close.end() if close else end
        elif name not in VOID and not closed:
            opened[name] = opened.get(name, 0) + 1
            node = child
    return root


def _leave(node: Node, scope: int, opened: dict[str, int]) -> Node:
    """The parent of the innermost open element of a scope; all below it end."""
    target = node.holders[scope]
    if target is None:
        return node
    while node is not target:
        opened[node.name] -= 1
        node = node.parent
    opened[node.name] -= 1
    return node.parent


def _clear(root: Node) -> None:
    """Containers of the page's text are wanted, whatever their names: those with most of its paragraph text outside
    other doubtful elements, or with an article or main and more of it than all that stands in no doubtful element.
    Where an article or main stands in none, only containers of most of the text with another one are."""
    order, stack = [], [(root, False)]
    while stack:
        node, inside = stack.pop()
        if node.unwanted and not node.doubtful:
            continue
        order.append((node, inside))
        inside = inside or node.unwanted
        stack.extend((c, inside) for c in node.children if isinstance(c, Node))
    if not any(node.doubtful and node.unwanted for node, _ in order):
        return
    text, holds, outside, whole, beside = {}, set(), 0, 0, False
    for node, inside in reversed(order):
        linked = node.name == "a"
        own = 0 if linked else sum(len(c.strip()) for c in node.children if isinstance(c, str))
        own = own if node.name in PARAGRAPHS or own >= 25 else 0
        below = [c for c in node.children if isinstance(c, Node) and c in text and not c.unwanted]
        text[node] = own + sum(text[c] for c in below)
        whole += own
        outside += 0 if inside or node.unwanted else own
        if node.name in ("article", "main") and text[node] and not _unwanted_names(node.attributes):
            holds.add(node)
            beside |= not inside
        elif any(c in holds for c in node.children if isinstance(c, Node)):
            holds.add(node)
    cleared: set[Node] = set()
    for node, _ in reversed(order):
        if not node.unwanted:
            continue
        below = sum(text[c] for c in node.children if isinstance(c, Node) and c in text and not c.unwanted)
        kept = max(text[node], below)
        most = 2 * kept > whole
        if (most and (node in holds or not beside)) or (node in holds and not beside and kept > outside):
            at = node
            while at is not None and at not in cleared:
                at.unwanted = at.unwanted and not at.doubtful
                cleared.add(at)
                at = at.parent


def _walk(root: Node) -> list[Node]:
    """Wanted elements in page order, without recursion: pages can be nested deeply."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.unwanted:
            continue
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node))
    return order


def main_node(root: Node) -> list[Node]:
    """The best container and those of its siblings that belong to it, in page order.

    Each paragraph gives 1 point, 1 for each comma and 1 for each 100 characters up to 3; its parent takes them whole,
    its grandparent half, the next ancestor a sixth, and each further one two thirds of what the one below it takes. A
    container's points are discounted by the share of its text that stands in links.
    """
    _clear(root)
    order = _walk(root)
    for node in reversed(order):
        for child in node.children:
            if isinstance(child, str):
                node.length += len(child)
            elif not child.unwanted:
                node.length += child.length
                node.linked += child.length if child.name == "a" else child.linked
    for node in order:
        own = sum(len(c) for c in node.children if isinstance(c, str) and not c.isspace())
        text = own if node.name not in PARAGRAPHS else node.length
        if not text or (node.name not in PARAGRAPHS and own < 25):
            continue
        density = node.linked / node.length if node.length else 0
        commas = sum(c.count(",") for c in node.children if isinstance(c, str))
        points = (1 + commas + min(text / 100, 3)) * (1 - density)
        taker = node.parent if node.name in PARAGRAPHS else node
        if taker is not None:
            own, upper, rest = taker.points
            taker.points = own + points, upper, rest
    # One sweep from the leaves up: points of paragraphs right below, one further down, and all others.
    for node in reversed(order):
        own, upper, rest = node.points
        node.score = own + upper / 2 + rest
        if node.parent is not None:
            mine, second, others = node.parent.points
            node.parent.points = mine, second + own, others + upper / 6 + rest * 2 / 3
    best, most = root, -1.0
    for node in order:
        value = node.score * (1 - (node.linked / node.length if node.length else 0))
        value *= 1.5 if node.name in ("article", "main") else 1
        if value > most and node.name not in PARAGRAPHS:
            best, most = node, value
    at = best
    while at is not None and at.name not in ("article", "main"):
        at = at.parent
    if at is not None:
        best = at
    if best.parent is None:
        return [best]
    kept = []
    for sibling in best.parent.children:
        if not isinstance(sibling, Node) or sibling.unwanted:
            continue
        density = sibling.linked / sibling.length if sibling.length else 0
        if sibling is best or sibling.score * (1 - density) >= max(10, 0.2 * most) or (
            best.name not in ("article", "main") and (sibling.name in PARAGRAPHS or sibling.name in SECTIONS and sibling.score)
            and sibling.length > 80 and density < 0.25
        ) or (best.name not in ("article", "main") and sibling.name in HEADINGS and sibling.length):
            kept.append(sibling)
    return kept


def _blocks(nodes: list[Node]) -> list[str]:
    blocks: list[str] = []
    words: list[str] = []

    def close() -> None:
        line = SPACES.sub(" ", references.unescape("".join(words))).strip()
        words.clear()
        if line:
            blocks.append(line)

    for top in nodes:
        stack: list = [top]
        while stack:
            item = stack.pop()
            if isinstance(item, str):
                words.append(item)
            elif item is None:
                close()
            elif not item.unwanted:
                if item.name == "br":
                    words.append(" ")
                if item.name in BLOCKS:
                    close()
                    stack.append(None)
                stack.extend(reversed(item.children))
        close()
    return blocks


def main_text(page: str) -> str:
    return "\n".join(_blocks(main_node(parse(page)))) if page else ""


def extract_text(df: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """(id, url, text, n_chars) per page: the main text, blocks joined by one line end.

    A null or empty page, and one without text, gives the empty text. Null and repeated ids and urls are kept, one row
    per input row; an empty table gives an empty table; other columns are not read. A page is one row's work, whatever
    its length; broken markup never raises.
    """
    kinds = [df.schema[c].dataType.simpleString() for c in (id_column, url_column)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(p) for p in batch.column(2).to_pylist()]
        rest = batch_of({"text": pa.string(), "n_chars": pa.int64()}, texts, [len(t) for t in texts])
        return pa.RecordBatch.from_arrays([*batch.columns[:2], *rest.columns], names=[id_column, url_column, "text", "n_chars"])

    pages = df.select(id_column, url_column, F.coalesce(F.col(html_column).cast("string"), F.lit("")).alias("page"))
    return map_batches(pages, work, f"`{id_column}` {kinds[0]}, `{url_column}` {kinds[1]}, text string, n_chars long")

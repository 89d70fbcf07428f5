"""Main text of web pages by tree scoring.

Pages are parsed into a tree of block elements. Elements that are never content (menus, headers and footers of
the page, sidebars, notices, adverts, forms, scripts, comments; by tag, role, class or id) are left out. Every other
paragraph passes points to its ancestors: one, one per comma, and up to three for its length; its parent gets all, the next
half, further ones less. Points are discounted by the share of the container's text that is links. The container with
the most points is kept, with those siblings that score well or are long paragraphs without many links.

Text inside a block has its white space turned into single spaces; blocks follow in page order, one per line.

Pages are independent: one pass, no shuffle. Defined cases: null and empty pages, and pages without
text outside left-out elements, give an empty text. Unclosed and stray tags are tolerated, a page that breaks off
is read as far as it goes. Depth and length of pages are not limited.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Element names of HTML, by what they mean here.
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset(
    "nav footer aside form button select option datalist dialog menu head svg math canvas audio video object map "
    "fieldset label input legend script style noscript template textarea title iframe".split()
)
BLOCKS = frozenset(
    "html body main article section div header hgroup p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre figure "
    "figcaption table caption thead tbody tfoot tr td th address details summary center search".split()
) | (LEFT_OUT - {"button", "label", "option", "input", "svg", "math"})
ENDS_PARAGRAPH = BLOCKS - {"option"}
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"},
}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"},
          "option": {"select"}, "thead": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CORE = frozenset("html body main article".split())
UNLIKELY = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promoted promotion nav "
    "navbar navigation menu menubar submenu breadcrumb breadcrumbs header masthead footer foot sidebar side rail aside widget widgets "
    "comment comments disqus discussion replies respond reply notice notices cookie cookies consent gdpr popup modal overlay "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations pagination "
    "pager toolbar skip skyscraper alert toc tags adsbygoogle adbox adslot adunit commentlist topbar sidenav subnav mainnav "
    "sitenav pagenav siteheader sitefooter userbar".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu menubar toolbar".split())
NEGATED = frozenset("has with no without".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+>?)",
    re.S,
)
ATTRIBUTE = re.compile(r"""(?:^|[\s/])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]*))?(?=[\s/>]|\Z)""", re.I)
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Node:
    __slots__ = ("tag", "parent", "depth", "out", "inside", "points", "chars", "linked")

    def __init__(self, tag: str, parent: "Node | None", out: bool):
        self.tag, self.parent, self.out = tag, parent, out
        self.depth = parent.depth + 1 if parent else 0
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.points, self.chars, self.linked = 0.0, 0, 0


def _unlikely(tag: str, attributes: str, parent: Node) -> bool:
    """Whether an element is left out for its name, role, class or id, or because it is hidden."""
    if tag in LEFT_OUT:
        return True
    if tag == "header" and not parent.inside:
        return True
    # Inside an article a header holds its title.
    unlikely = UNLIKELY - {"header"} if parent.inside else UNLIKELY
    if not attributes or "=" not in attributes and "hidden" not in attributes.lower():
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), html.unescape(value.strip("\"'"))
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return tag not in CORE
        if name == "style" and HIDDEN.search(value):
            return tag not in CORE
        if name == "role" and value.lower() in ROLES:
            return tag not in CORE
        if name in ("class", "id") and tag not in CORE:
            for one in value.split():
                parts = [p.lower() for p in PART.findall(one)]
                if NEGATED & set(parts):
                    continue
                if unlikely & set(parts):
                    return True
    return False


def blocks(page: str) -> tuple[list[tuple[Node, str, int]], Node]:
    """Text blocks in page order (container, text, characters inside links), and the root."""
    root = Node("html", None, False)
    stack, found = [root], []
    parts: list[str] = []
    linked, in_link, at = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text and not stack[-1].out:
            found.append((stack[-1], text, min(linked, len(text))))
        linked = 0

    def add(raw: str) -> None:
        nonlocal linked
        if raw and not stack[-1].out:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if in_link:
                linked += len(text.strip())

    def pop(index: int) -> None:
        nonlocal in_link
        flush()
        del stack[index:]
        in_link = 0

    while at < len(page):
        match = TOKEN.search(page, at)
        if match is None:
            add(page[at:])
            break
        add(page[at : match.start()])
        at = match.end()
        name = match.group(2)
        if name is None:
            if match.group().startswith("<![CDATA["):
                continue
            continue
        name = name.lower()
        if match.group(1):  # end tag
            if name == "a":
                in_link = max(0, in_link - 1)
            elif name in BLOCKS or name in LEFT_OUT:
                index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == name), 0)
                if index:
                    pop(index)
                elif name in BLOCKS:
                    flush()
            continue
        attributes = match.group(3)
        if name in RAW:
            end = re.compile(rf"</{name}\s*[^>]*>?", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name == "br" or name == "hr" or name == "wbr" or name == "img":
            if name == "hr":
                flush()
            elif name == "br":
                add(" ")
            continue
        if name in VOID:
            continue
        if name == "a":
            in_link = 1
            continue
        out = _unlikely(name, attributes, stack[-1])
        if name not in BLOCKS and name not in LEFT_OUT:
            # Inline elements matter only where they are left out.
            if out and name in ("span", "i", "em", "small", "b", "strong", "ins", "del") and not attributes.rstrip(">").endswith("/"):
                end = _inline_end(page, at, name)
                at = end
            continue
        if name in ENDS_PARAGRAPH:
            index = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].tag == "p"), 0)
            if index and all(n.tag not in BLOCKS - {"p"} for n in stack[index + 1 :]):
                pop(index)
            else:
                flush()
        if name in CLOSES:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in SCOPES[name]:
                    break
                if stack[i].tag in CLOSES[name]:
                    pop(i)
        if name in ("html", "body") and any(n.tag == name for n in stack):
            continue
        if attributes.rstrip(">").endswith("/") and name not in BLOCKS:
            continue
        stack.append(Node(name, stack[-1], stack[-1].out or out))
    flush()
    return found, root


def _inline_end(page: str, at: int, name: str) -> int:
    """Behind the end tag that closes an inline element opened just before ``at``."""
    depth = 1
    for match in re.compile(rf"<(/?){name}(?=[\s>/])[^>]*>", re.I).finditer(page, at):
        depth += -1 if match.group(1) else 1
        if depth == 0:
            return match.end()
    return at


def _container(node: Node) -> Node:
    """Paragraph-like blocks pass their points on to what holds them."""
    return node.parent if node.tag in ("p", "pre", "td", "th", "li", "dd", "dt", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "figcaption", "summary", "caption", "address") and node.parent else node


def main_text(page: str) -> str:
    found, root = blocks(page)
    nodes: dict[int, Node] = {}
    for node, text, linked in found:
        worth = 1 + text.count(",") + min(len(text) / 100, 3)
        if node.tag in HEADINGS:
            worth = 0.1
        holder, level = _container(node), 0
        while holder is not None:
            nodes[id(holder)] = holder
            holder.points += worth / (1 if level == 0 else 2 if level == 1 else 3 * level)
            holder.chars += len(text)
            holder.linked += linked
            holder, level = holder.parent, level + 1
    if not nodes:
        return ""

    def score(node: Node) -> float:
        return node.points * (1 - node.linked / max(node.chars, 1)) * (1.25 if node.tag in ("article", "main") else 1)

    best = max(nodes.values(), key=lambda n: (score(n), n.depth))
    # A container inside an article, or else the main element, speaks for all of it.
    above, up = {}, best
    while up is not None:
        above.setdefault(up.tag, up)
        up = up.parent
    best = above.get("article") or above.get("main") or best
    keep = {id(best)}
    siblings = max(2.0, 0.2 * score(best))
    lines = []
    for node, text, linked in found:
        inside, branch = node, None
        while inside is not None and id(inside) not in keep:
            branch, inside = inside, inside.parent
        if inside is None and best.parent is not None:
            branch = node
            while branch is not None and branch.parent is not best.parent:
                branch = branch.parent
            if branch is None:
                continue
            same = score(branch) >= siblings and branch.linked <= 0.3 * branch.chars if id(branch) in nodes else False
            paragraph = branch.tag == "p" and len(text) > 80 and linked < 0.25 * len(text)
            title = branch.tag in HEADINGS or branch.tag in ("header", "hgroup") and node.tag in HEADINGS
            if not (same or paragraph or title):
                continue
        elif inside is None:
            continue
        elif _link_list(node):
            continue
        lines.append(text)
    return "\n".join(lines)


def _link_list(node: Node) -> bool:
    """Whether a block stands in a list that is nearly all links."""
    while node is not None:
        if node.tag in ("ul", "ol", "dl", "table"):
            return node.linked > 0.8 * node.chars
        node = node.parent
    return False


def extract(pages: DataFrame) -> DataFrame:
    """The pages with ``text`` and ``n_chars`` (code points) in place of ``html``."""
    chosen = pages.drop("text", "n_chars")
    at = chosen.columns.index("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p or "") for p in batch.column(at).to_pylist()]
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            names = [c for c in batch.schema.names if c != "html"]
            yield pa.record_batch(
                [*columns, pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    kept = [f for f in chosen.schema.fields if f.name != "html"]
    schema = T.StructType([*kept, T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return chosen.mapInArrow(run, schema)


def report(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html")).select("page_id", "url", F.col("text"), "n_chars")

"""Main text of HTML pages by scores on the element tree."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import slices

# Fixed values of HTML
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# what an opening tag ends, up to the nearest element that holds it
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
P_ENDS_BEFORE = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "legend"}

# Choices: elements that are never main text, by tag, by role, and by words in class or id
DROPPED = RAW | frozenset("head nav footer aside form button select input label svg math canvas audio video object embed menu dialog search".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
UNLIKELY = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|adv|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|"
    r"header|masthead|footer|foot|sidebar|side|aside|widget|related|recommended|comment|comments|disqus|respond|replies|reply|discussion|cookie|cookies|consent|gdpr|"
    r"notice|notices|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|form|search|copyright|disclaimer|pagination|pager|skip|hidden|tags|toolbar|alert|tracking)(?:$|[^a-z])"
)
# words that an article's own parts carry too: there such a part goes only when it is short or full of links
DOUBTFUL = frozenset("share sharing social related recommended tags skip side foot promo promotion discussion notice notices disclaimer copyright alert".split())
NOTICES = frozenset("notice notices disclaimer copyright alert".split())
LONG_PART, LONG_PARAGRAPH = 200, 40  # characters
KEEPS = frozenset({"html", "body", "article", "main"})
LAYOUT = re.compile(r"(?:no|has|with|without|left|right|one|two)[-_ ]?(?:sidebar|header|footer|nav|banner|menu)s?")
HEADING = re.compile(r"(?:^|[^a-z])(?:header|masthead)(?=$|[^a-z])")

TAG = re.compile(r"<!--.*?(?:-->|$)|<![^>]*>?|<\?[^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "parent", "parts", "dropped", "score", "chars", "link_chars", "label", "doubt")

    def __init__(self, tag: str, parent: Node | None, dropped: bool, label: str = "", doubt: int = 0):
        self.tag, self.parent, self.dropped, self.label, self.doubt = tag, parent, dropped, label, doubt
        self.parts: list[Node | str] = []
        self.score = 0.0
        self.chars = self.link_chars = 0


def tree(html: str, by_label: bool = True) -> Node:
    """Elements and texts of a page; missing end tags of paragraphs, list items and cells are put in.

    ``by_label``: leave out elements whose class or id says that they are no main text.
    """
    root = Node("html", None, False)
    open_ = [root]
    at = 0

    def close(stop: int) -> None:
        del open_[stop:]

    def put(raw: str) -> None:
        if raw and not open_[-1].dropped:
            open_[-1].parts.append(unescape(raw))

    while at < len(html):
        lt = html.find("<", at)
        if lt < 0:
            put(html[at:])
            break
        m = TAG.match(html, lt)
        if m is None:  # a sign in the text, or a tag that the page breaks off in
            if re.match(r"</?[a-zA-Z]", html[lt : lt + 3]) and html.find(">", lt) < 0:
                put(html[at:lt])
                break
            put(html[at : lt + 1])
            at = lt + 1
            continue
        put(html[at:lt])
        at = m.end()
        if not m[2]:
            continue
        tag = m[2].lower()
        if m[1]:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == tag:
                    close(k)
                    break
                if open_[k].tag in ("td", "th", "table", "article", "main", "body") and tag not in BLOCKS:
                    break
            continue
        if tag in ("html", "body", "head") and tag != "head":
            continue
        if tag in P_ENDS_BEFORE:
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag == "p":
                    close(k)
                    break
                if open_[k].tag in BLOCKS:
                    break
        if tag in ENDS:
            ended, held = ENDS[tag]
            for k in range(len(open_) - 1, 0, -1):
                if open_[k].tag in held:
                    break
                if open_[k].tag in ended:
                    close(k)
                    if tag != "tr":
                        break
        parent = open_[-1]
        if tag in VOID:
            if not parent.dropped:
                parent.parts.append("\n" if tag == "br" else Node(tag, parent, True) if tag == "hr" else "")
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            at = len(html) if end is None else end.start()
            if end is not None:
                close_at = html.find(">", end.end())
                at = len(html) if close_at < 0 else close_at + 1
            continue
        attributes = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(m[3])} if "=" in m[3] else {}
        label = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().strip()
        out = parent.dropped or _dropped(tag, attributes, m[3], open_)
        doubt = 0
        if by_label and not out and label and tag not in KEEPS:
            out, doubt = _unlikely(tag, label, open_)
        node = Node(tag, parent, out, label, doubt)
        if not out:
            parent.parts.append(node)
        if not m[3].rstrip().endswith("/") or tag in BLOCKS:
            open_.append(node)
    return root


def _dropped(tag: str, attributes: dict[str, str], raw: str, above: list[Node]) -> bool:
    if tag in DROPPED or attributes.get("role", "").lower() in DROPPED_ROLES or attributes.get("aria-hidden") == "true":
        return True
    if tag == "header" and not any(n.tag in ("article", "main") for n in above):
        return True
    return "hidden" in raw.lower().split() or "display:none" in attributes.get("style", "").replace(" ", "").lower()


def _unlikely(tag: str, label: str, above: list[Node]) -> tuple[bool, int]:
    """Whether the label tells that an element is no main text; how many characters it must have where that is in doubt."""
    label = LAYOUT.sub(" ", label.replace("_", " "))
    within = any(n.tag in ("article", "main") for n in above)
    if within:  # an article's own heading
        label = HEADING.sub(" ", label)
    if not UNLIKELY.search(label):
        return False, 0
    words = {w for w in re.findall("[a-z]+", label) if UNLIKELY.search(w)}
    if not within or words - DOUBTFUL:
        return True, 0
    return False, LONG_PARAGRAPH if tag in ("p", "blockquote") and not words & NOTICES else LONG_PART


def _settle(root: Node) -> None:
    """Take elements in doubt out that are short or of which a quarter is links."""
    doubtful = [n for n in _measure(root) if n.doubt]
    for node in doubtful:
        if node.chars < node.doubt or link_density(node) >= 0.25:
            node.parts, node.dropped = [], True


def _measure(root: Node) -> list[Node]:
    """Characters and link characters under every node; the nodes, outermost first."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.chars = node.link_chars = 0
        order.append(node)
        stack += [p for p in node.parts if isinstance(p, Node)]
    for node in reversed(order):
        for p in node.parts:
            if isinstance(p, Node):
                node.chars += p.chars
                node.link_chars += p.chars if p.tag == "a" else p.link_chars
            else:
                node.chars += len(p.strip())
    return order


def link_density(node: Node) -> float:
    return node.link_chars / node.chars if node.chars else 0.0


def _own_text(node: Node) -> str:
    """Text of a node outside the blocks in it."""
    out, stack = [], list(reversed(node.parts))
    while stack:
        p = stack.pop()
        if isinstance(p, str):
            out.append(p)
        elif p.tag not in BLOCKS:
            stack += reversed(p.parts)
    return " ".join(out)


def container(root: Node) -> list[Node]:
    """The best-scored element and the siblings that belong to it, in page order.

    A block of text gives one point, one for each comma, and one for each 100 characters up to three, to the
    element around it, half as much to the next, and a third to the third. An element's points are discounted by
    the share of its characters that are links; article and main elements start with more.
    """
    _settle(root)
    order = _measure(root)
    scored: dict[int, Node] = {}
    for node in order:
        if node.tag in ("p", "pre", "td", "blockquote", "li", "div", "section", "h1", "h2", "h3", "h4", "h5", "h6", "dd"):
            text = _own_text(node).strip()
            if not text:
                continue
            points = 1 + text.count(",") + min(len(text) // 100, 3)
            if node.tag[0] == "h" or node.tag == "li":
                points *= 0.5
            above = node if node.tag in ("div", "section") else node.parent
            for share in (1, 2, 3):
                if above is None:
                    break
                if id(above) not in scored:
                    above.score = {"article": 10.0, "main": 8.0}.get(above.tag, 0.0)
                    scored[id(above)] = above
                above.score += points / share
                above = above.parent
    if not scored:
        return [root]
    for node in scored.values():
        node.score *= 1 - link_density(node)
    best = max(scored.values(), key=lambda n: n.score)
    # an article or main element above the best holds the page's text whole
    up = best
    while up is not None:
        if up.tag in ("article", "main"):
            best = up
            break
        up = up.parent
    if best.parent is None or best.tag in ("article", "main"):
        same = best.parent
        if same is None or best.tag == "main":
            return [best]
        return [s for s in same.parts if isinstance(s, Node) and (s is best or s.tag == "article" and s.chars and link_density(s) < 0.5)]
    limit = max(10.0, best.score * 0.2)
    kept: list[Node] = []
    for s in best.parent.parts:
        if isinstance(s, Node):
            text = s.chars
            likely = s.score + (best.score * 0.2 if s.label and s.label == best.label else 0.0) >= limit
            para = s.tag in ("p", "pre", "blockquote", "h1", "h2", "h3") and (text > 80 and link_density(s) < 0.25 or 0 < text <= 80 and s.link_chars == 0)
            if s is best or likely or para:
                kept.append(s)
    return kept


def blocks(nodes: list[Node]) -> list[str]:
    """Texts of the blocks in page order, white space run together; lists of links only are left out, but for an article's own."""
    out: list[str] = []
    run: list[str] = []

    def end() -> None:
        text = SPACE.sub(" ", "".join(run)).strip()
        if text:
            out.append(text)
        run.clear()

    up = nodes[0] if nodes else None
    while up is not None and up.tag != "article":
        up = up.parent
    own = up is not None
    stack: list[Node | str | None] = []
    for n in reversed(nodes):
        stack += [None, n]
    while stack:
        p = stack.pop()
        if p is None:
            end()
        elif isinstance(p, str):
            run.append(p)
        elif p.tag in BLOCKS:
            end()
            if not own and p.tag in ("ul", "ol", "menu") and link_density(p) > 0.8:
                continue
            stack.append(None)
            stack += reversed(p.parts)
        else:
            stack += reversed(p.parts)
    end()
    return out


def main_text(html: str | None) -> str:
    """The article of a page: its blocks joined by one line end; empty for null, empty or textless pages.

    Inside an article or main element a part whose label may be the article's own (``share-intro``, ``notice``) stays
    when it is long (40 characters for a paragraph, 200 for other parts and for notices) and less than a quarter
    links; elsewhere, and for labels of adverts, menus, forms and comments, the label decides.
    """
    if not html:
        return ""
    found = blocks(container(tree(html))) or blocks(container(tree(html, by_label=False)))
    return "\n".join(found)


def _extract(names: list[str], html_col: str, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, html_col):
            texts = [main_text(h) for h in batch.column(html_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], [*names, text_col, "n_chars"])

    return run


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` (code points) of every page. No shuffle: each page by itself.

    Null, empty and textless pages have an empty text. Null ids and repeated rows are rows like others; other
    columns are not read. Ties between elements go to the first in the page. A page of any length is worked on
    whole; nesting is kept on a list, so depth is no limit.
    """
    rows = pages.select(*keep, F.col(html_col).alias("__html"))
    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in keep)
    return rows.mapInArrow(_extract(list(keep), "__html", "text"), f"{kinds}, text string, n_chars bigint")

"""Main text of HTML pages by tree scoring.

Every paragraph passes points, for being one, for its commas and for its length, to its
parent, half of them to the grandparent and less further up. A container's points are
discounted by the share of its text that stands in links. The best container is kept, and of
its siblings those that score well or are solid paragraphs.

Elements are left out before that by kind, by attributes, and by what their names promise. Names
and forms may mislead: where such an element holds most of the page's points it is taken back.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightmill.llm.common import scratch_names

VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
#: Elements that are never part of an article's text.
DROPPED = frozenset(
    "script style noscript template nav aside footer form button select option textarea input "
    "iframe object embed svg canvas audio video map dialog menu head title xmp noembed "
    "noframes".split()
)
#: Elements that start and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPH = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6".split())
CONTAINER_BONUS = {"article": 25, "main": 20, "section": 5, "div": 5, "td": 3, "body": 0}
#: Start tags that close an open element of the named kinds, up to the nearest boundary.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
P_ENDERS = BLOCK - {"br", "body", "html", "caption", "tbody", "td", "th", "thead", "tfoot", "tr"}
INLINE = frozenset(
    "a abbr b bdi bdo big cite code em font i ins kbd label mark q s samp small span strike "
    "strong sub sup tt u var".split()
)

UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|breadcrumbs?|combx|comments?|community|consent|"
    r"cookies?|disqus|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|"
    r"notice|outbrain|pager|pagination|popup|promo\w*|related|replies|reply|respond|rss|"
    r"share\w*|sharing|shoutbox|sidebar|skyscraper|social|sponsor\w*|subscribe|taboola|toolbar|"
    r"tweet|widget)(?=$|[\s_-])",
    re.I,
)
LIKELY = re.compile(
    r"(?:^|[\s_-])(?:article|body|content|entry|main|page|post|story|text|blog)(?=$|[\s_-])", re.I
)
#: Names of reader comments, which no other word in a name makes text of the article.
COMMENTS = re.compile(
    r"(?:^|[\s_-])(?:comments?|comment(?:s?list|s?area|s?section|thread|s?wrap(?:per)?|body|text|"
    r"form)|combx|disqus|respond|replies|shoutbox)(?=$|[\s_-])",
    re.I,
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
UNLIKELY_ROLE = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "form".split()
)

MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:-->|--!>|\Z))|<[!?][^>]*(?:>|\Z)|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
#: One attribute with its whole value, so that values are never read as names.
ATTRIBUTE = re.compile(
    r"([^\s/>=\"'][^\s/>=]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?"
)
READ = frozenset("class id role hidden aria-hidden style".split())
GAPS = re.compile(r"[\s]+")


#: Why an element is left out: FIRM for good, SOFT as long as the text is elsewhere.
SOFT, FIRM = 1, 2
#: Points that text beside a soft element must have to be a page's text of its own.
BESIDE = 3


class Node:
    __slots__ = ("tag", "parent", "children", "names", "dropped", "score", "length", "linked")

    def __init__(self, tag: str, parent: Node | None, names: str = "", dropped: int = 0):
        self.tag, self.parent, self.names, self.dropped = tag, parent, names, dropped
        self.children: list[Node | str] = []
        self.score = 0.0
        self.length = self.linked = 0


def _attributes(source: str) -> dict[str, str]:
    if not source or source.isspace():
        return {}
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(source):
        if (name := m[1].lower()) in READ and name not in found:  # the first one counts
            found[name] = html_lib.unescape(m[2] or m[3] or m[4] or "")
    return found


def _dropped(tag: str, found: dict[str, str], in_article: bool) -> int:
    """SOFT, FIRM, or 0 for an element that stays."""
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return FIRM
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return FIRM
    role = found.get("role", "").lower()
    if tag in DROPPED and tag != "form" or role in UNLIKELY_ROLE and role != "form":
        return FIRM
    if tag == "header":
        # The heading of an article belongs to it, a page's header does not.
        return 0 if in_article else FIRM
    if tag == "form" or role == "form":
        return SOFT
    if tag in ("body", "html", "main"):
        return 0
    names = f"{found.get('class', '')} {found.get('id', '')}"
    if COMMENTS.search(names):
        return SOFT
    if tag == "article":
        return 0
    return SOFT if UNLIKELY.search(names) and not LIKELY.search(names) else 0


class _Path:
    """The open elements, and how many there are of each kind.

    The counts say whether a search upwards can find anything and when it has found everything,
    so that deep pages are not searched to their root again and again.
    """

    def __init__(self, root: Node):
        self.root = self.here = root
        self.count: Counter[str] = Counter()

    def enter(self, node: Node) -> None:
        self.here = node
        self.count[node.tag] += 1

    def leave(self, node: Node) -> None:
        """Close ``node``, an open element, and everything inside it."""
        above = node.parent
        while self.here is not above:
            self.count[self.here.tag] -= 1
            self.here = self.here.parent

    def paragraph(self) -> Node | None:
        return _open(self.here, "p") if self.count["p"] else None

    def ended_by(self, tag: str) -> Node | None:
        """The open element that an end tag closes; None where it is to be ignored."""
        if not self.count[tag]:
            return None
        node = self.here
        while node.tag != tag:
            # An inline end tag does not reach out of its block.
            if tag in INLINE and node.tag in BLOCK:
                return None
            node = node.parent
        return node

    def closed_by(self, tag: str) -> Node | None:
        """The outermost element that a start tag closes, up to its boundary."""
        ends, stops = CLOSES[tag]
        left = sum(self.count[end] for end in ends)
        node, outer = self.here, None
        while left and node.tag not in stops:
            if node.tag in ends:
                outer, left = node, left - 1
            node = node.parent
        return outer


def parse(source: str) -> Node:
    """Tolerant tree: unknown end tags are ignored, open elements end where HTML says so."""
    root = Node("#root", None)
    path, at = _Path(root), 0
    for match in iter_markup(source):
        if match.start() > at:
            path.here.children.append(html_lib.unescape(source[at : match.start()]))
        at = match.end()
        name = match[2] or match[5]
        if name is None:
            continue
        tag, closing = name.lower(), match[1] or match[4]
        if closing:
            if tag == "p" and not path.paragraph():
                path.here.children.append(Node("br", path.here))
            elif node := path.ended_by(tag):
                path.leave(node)
            continue
        if tag in P_ENDERS and (p := path.paragraph()):
            path.leave(p)
        if tag in CLOSES and (node := path.closed_by(tag)):
            path.leave(node)
        found = _attributes(match[3] or match[6] or "")
        names = f"{found.get('class', '')} {found.get('id', '')}" if found else ""
        node = Node(tag, path.here, names, _dropped(tag, found, path.count["article"] > 0))
        path.here.children.append(node)
        if tag not in VOID and tag not in RAW:
            path.enter(node)
    if at < len(source):
        path.here.children.append(html_lib.unescape(source[at:]))
    return root


def iter_markup(source: str) -> Iterator[re.Match]:
    """Markup in order; the text of script, style and the like is skipped as a whole."""
    at = 0
    while match := MARKUP.search(source, at):
        yield match
        at = match.end()
        name = match[2] or match[5]
        if name and not (match[1] or match[4]) and (tag := name.lower()) in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, at)
            # The hidden text goes with a comment-like match up to its end tag.
            stop = end.end() if end else len(source)
            yield _Skipped(at, stop)
            at = stop


class _Skipped:
    """Stands for a skipped stretch of the source."""

    def __init__(self, start: int, stop: int):
        self._span = (start, stop)

    def start(self) -> int:
        return self._span[0]

    def end(self) -> int:
        return self._span[1]

    def __getitem__(self, group: int) -> None:
        return None


def _open(node: Node, tag: str) -> Node | None:
    """The nearest open ``tag`` not shut off by a table cell, button or the like."""
    while node is not None and node.tag not in ("td", "th", "table", "button", "caption", "#root"):
        if node.tag == tag:
            return node
        node = node.parent
    return None


def _walk(root: Node, least: int = SOFT) -> Iterator[Node]:
    """Elements that are not dropped by ``least`` or more, parents first, without recursion."""
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        stack.extend(
            c for c in reversed(node.children) if isinstance(c, Node) and c.dropped < least
        )


def _measure(nodes: list[Node], least: int = SOFT) -> None:
    """Text length of each element, and how much of it stands in links."""
    for node in reversed(nodes):
        own = sum(len(c.strip()) for c in node.children if isinstance(c, str))
        kept = [c for c in node.children if isinstance(c, Node) and c.dropped < least]
        node.length = own + sum(c.length for c in kept)
        node.linked = node.length if node.tag == "a" else sum(c.linked for c in kept)


def _paragraph_text(node: Node) -> str:
    """Text of a paragraph without that of blocks inside it."""
    parts, stack = [], list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            parts.append(child)
        elif not child.dropped and child.tag not in BLOCK:
            stack.extend(reversed(child.children))
    return "".join(parts)


def _is_loose(node: Node) -> bool:
    """Whether a container holds text outside of paragraphs."""
    return node.tag in CONTAINER_BONUS and any(
        isinstance(c, str) and not c.isspace() for c in node.children
    )


def _points(node: Node) -> float:
    """Points of a paragraph's or container's own text; 0 without any."""
    text = _paragraph_text(node).strip()
    return 1 + text.count(",") + min(len(text) / 100, 3) if text else 0.0


def _take_back(root: Node) -> None:
    """Lift soft drops of elements with most of the page's points and no other text beside.

    A form around the page or a wrapper named after its sidebar is taken back, comments that
    are longer than their article are not. Points count by the share that is not in links.
    """
    nodes = list(_walk(root, FIRM))
    if not any(node.dropped for node in nodes):
        return
    _measure(nodes, FIRM)
    points = dict.fromkeys(nodes, 0.0)
    for node in reversed(nodes):
        if node.tag in PARAGRAPH or _is_loose(node):
            points[node] += _points(node) * (1 - node.linked / max(node.length, 1))
        if node.parent is not None:
            points[node.parent] += points[node]
    # Such elements lie in each other, so what has been looked at need not be again.
    top = root
    for node in nodes:
        if node.dropped and 2 * points[node] > points[root]:
            around, above = {top}, node.parent
            while above is not None and above is not top:
                around.add(above)
                above = above.parent
            if any(
                points[other] >= BESIDE and other not in around and _is_text(other)
                for other in _walk(top)
            ):
                return
            node.dropped, top = 0, node


def _is_text(node: Node) -> bool:
    """Whether an element's kind or name promises the page's text."""
    return node.tag in ("article", "main") or (
        node.tag in CONTAINER_BONUS and bool(LIKELY.search(node.names))
    )


def _score(nodes: list[Node]) -> list[Node]:
    """Let paragraphs pass their points upwards; returns the candidates, discounted."""
    scored: dict[Node, None] = {}
    for node in nodes:
        loose = _is_loose(node)
        if node.tag not in PARAGRAPH and not loose:
            continue
        points = _points(node)
        if not points:
            continue
        target, level = node if loose else node.parent, 0
        while target is not None and target.tag != "#root" and level < 4:
            if target not in scored:
                scored[target] = None
                target.score += CONTAINER_BONUS.get(target.tag, 0)
                target.score += 25 * bool(LIKELY.search(target.names))
            target.score += points / (1, 2, 6, 9)[level]
            target, level = target.parent, level + 1
    for node in scored:
        node.score *= 1 - node.linked / max(node.length, 1)
    return list(scored)


def _is_headline(node: Node | str) -> bool:
    """A heading, or an article's header with one in it, that is more than links to elsewhere."""
    if not isinstance(node, Node) or node.dropped or not node.length:
        return False
    if node.tag in ("h1", "h2"):
        return True
    if 2 * node.linked >= node.length:
        return False
    return node.tag in HEADINGS or (
        node.tag in ("header", "hgroup") and any(n.tag in HEADINGS for n in _walk(node))
    )


def _headlines(best: Node) -> list[Node]:
    """Headlines before the best container inside the same article, outermost first.

    Where there is no article or main element, the element around the container counts if its
    name promises text.
    """
    path, node = [], best
    while node.parent is not None and node.tag not in ("article", "main"):
        path.append(node)
        node = node.parent
    if node.tag not in ("article", "main"):
        named = best.parent is not None and best.parent.tag != "body"
        path = [best] if named and LIKELY.search(best.parent.names) else []
    found = []
    for inner in reversed(path):
        for child in inner.parent.children:
            if child is inner:
                break
            if _is_headline(child):
                found.append(child)
    return found


def _article(root: Node) -> list[Node]:
    """The best container, the headlines above it and the siblings that belong to it, in page
    order."""
    nodes = list(_walk(root))
    _measure(nodes)
    scored = _score(nodes)
    if not scored:
        return [root]
    best = max(scored, key=lambda n: n.score)
    # A paragraph-like winner stands for the container around it.
    while best.tag in INLINE or best.tag in PARAGRAPH - {"td"}:
        if best.parent is None or best.parent.tag == "#root":
            break
        best = best.parent
    parent = best.parent
    if parent is None or best.tag == "body":
        return [best]
    bar = max(10.0, best.score * 0.2)
    headlines = _headlines(best)
    chosen = [node for node in headlines if node.parent is not parent]
    for child in parent.children:
        if child is best or child in headlines:
            chosen.append(child)
        elif isinstance(child, Node) and not child.dropped and child.length:
            density = child.linked / child.length
            bonus = best.score * 0.2 if child.names.strip() and child.names == best.names else 0
            solid = child.tag == "p" and (
                (child.length > 80 and density < 0.25) or (density == 0 and child.length > 20)
            )
            if child.score + bonus >= bar or solid:
                chosen.append(child)
    return chosen


def main_text(source: str | None) -> str:
    """Blocks of the article in page order, one on each line; empty if there is no text."""
    if not source:
        return ""
    root = parse(source)
    _take_back(root)
    blocks = _blocks(root)
    if not blocks and (soft := [n for n in _walk(root, FIRM) if n.dropped]):
        for node in soft:
            node.dropped = 0
        for node in _walk(root):
            node.score = 0.0
        blocks = _blocks(root)
    return "\n".join(blocks)


def _blocks(root: Node) -> list[str]:
    blocks: list[str] = []
    run: list[str] = []

    def end_block() -> None:
        if run:
            text = GAPS.sub(" ", "".join(run)).strip()
            if text:
                blocks.append(text)
            run.clear()

    for top in _article(root):
        stack: list[Node | str | None] = [None, top]  # None ends a block
        while stack:
            item = stack.pop()
            if item is None:
                end_block()
            elif isinstance(item, str):
                run.append(item)
            elif not item.dropped:
                if item.tag in BLOCK:
                    end_block()
                    stack.append(None)
                stack.extend(reversed(item.children))
        end_block()
    return blocks


def extract_main_text(
    pages: DataFrame, html: str = "html", keep: list[str] | None = None
) -> DataFrame:
    """Rows of ``pages`` (columns ``keep``, default all) with text and n_chars (code points).

    NULL and empty pages, and pages without text, give an empty text. Broken markup is read
    as far as it goes. White space inside a block becomes one space. Nothing is cut or
    capped. Columns named like a result are replaced. One narrow pass, page by page.
    """
    results = ["text", "n_chars"]
    kept = [c for c in (keep or pages.columns) if c not in results]
    (hidden,) = scratch_names(pages, "html")
    source = pages.select(F.col(f"`{html}`").cast("string").alias(hidden), *[f"`{c}`" for c in kept])
    schema = T.StructType(
        [pages.schema[c] for c in kept]
        + [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    )

    def extract(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = [main_text(page) for page in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string())]
                + [pa.array([len(t) for t in texts], pa.int64())],
                names=[*kept, *results],
            )

    return source.mapInArrow(extract, schema)

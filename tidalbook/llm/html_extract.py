"""Main text of web pages by a minimum cut.

A page is cut into blocks: runs of text between block-level tags. Each block
has two costs from a linear classifier over its words, links and place in the
DOM: the cost of calling it boilerplate and the cost of calling it content.
How much an element around a block speaks for boilerplate is graded: navigation
and the like speak fully, class and id names by the place of the telling word in
them (``share-buttons`` more than ``story-share-top``, ``page-with-sidebar`` not
at all), and a form or a name hardly where the element holds an article or most
of the page's text, as it then wraps the page.
They are the capacities of its edges from the source and to the sink.
Neighbouring blocks are joined by edges whose capacity grows with DOM
proximity (how many of the nearest ancestors they share): cutting between
close blocks costs more. A maximum flow then gives the labelling of least
total cost; blocks still reachable from the source are the content.

Scripts, styles, comments and markup are no text and make no blocks. Each page
is handled by itself in map-only tasks; nothing is shuffled.
"""

from __future__ import annotations

import html
import re
from collections import Counter, deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidalbook.llm._shared import row_slices

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(?P<broken>/?[a-zA-Z])[^>]*(?:>|\Z)",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

#: Elements whose content is no text of the page.
HIDDEN = frozenset("head iframe math noembed noframes noscript object script style svg template title".split())
#: Of these, those in which no tag counts but the closing one.
RAW = frozenset("iframe noembed noframes noscript script style template title textarea".split())
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: An opening tag of these ends an open paragraph.
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
#: Elements that are read as forms or headings of whatever they hold, so that what they hold can speak against them.
SOFT = frozenset("fieldset form header label legend".split())
CHROME = frozenset("aside button dialog fieldset footer form header input label legend menu nav option select textarea".split())
CHROME_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
CHROME_NAMES = frozenset(
    "ad ads advert advertisement adverts alert author banner bio breadcrumb breadcrumbs callout comment commentlist comments consent cookie cookies copyright disclaimer discussion disqus footer form gdpr "
    "header login masthead menu modal nav navbar navigation newsletter notice pager pagination popup promo promoted promotion recommendation recommendations recommended related reply replies "
    "respond search share sharing sidebar sidenav signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words of a name that tells a state or a layout and not what the element is.
STATE_NAMES = frozenset("disabled enabled has is layout no with without".split())
CONTENT = frozenset("article main".split())
CONTENT_NAMES = frozenset("article body content entry main post story text".split())

#: How much a name says by whether its telling word is all of it, at an end, or inside.
WHOLE_NAME, END_OF_NAME, IN_NAME, BESIDE_CONTENT_NAME = 1.0, 0.9, 0.5, 0.2
#: Shares of a page's text from which an element counts as its article, as its wrapper, or as a form around it, and what is left of its say then.
ARTICLE_SHARE, WRAPPER_SHARE, FORM_SHARE = 0.3, 0.6, 0.5
#: Share of a page's text up to which what stands under no telling name is no article, and that from which the elements of one name are how the page is built.
BARE_SHARE, BUILT_SHARE = 0.15, 0.4
AROUND_ARTICLE, AROUND_TEXT, FORM_AROUND_TEXT = 0.1, 0.3, 0.2

SMOOTH = 0.6
NEAR_PARENT, NEAR_GRANDPARENT, FAR = 1.0, 0.5, 0.2
#: Weights of the classifier, in log odds of being content.
W_BIAS, W_CHROME, W_CONTENT, W_CONTENT_NAME, W_LINKS, W_WORDS, W_STOP, W_HEADING = -0.6, -9.0, 4.5, 2.0, -3.0, 0.45, 0.8, 0.4


@dataclass
class Block:
    text: str
    linked: int
    path: tuple[int, ...]  # its element and the next two above it, inline ones left out
    chrome: float  # from 0 to 1: how much the elements around it speak for boilerplate
    content: bool
    named: bool
    heading: bool


@dataclass
class _Element:
    name: str
    number: int
    parent: int  # its number; -1: none
    chrome: float  # what this element says itself
    soft: bool  # what it holds can speak against that
    is_content: bool
    content: bool
    named: bool
    telling: tuple[str, ...] = ()  # class and id names that speak for boilerplate
    chars: int = 0  # of text that is no link, below it
    around_article: bool = False


def _name_says(names: list[str]) -> tuple[float, bool, tuple[str, ...]]:
    """(how much class and id names speak for boilerplate, whether one is a content name, the names that speak)."""
    says, named, heard = 0.0, False, []
    for name in names:
        words = [w.lower() for w in NAME_WORD.findall(name)]
        telling = [w in CHROME_NAMES for w in words]
        for k, pair in enumerate(a + b for a, b in pairwise(words)):  # call-out, side-bar
            if pair in CHROME_NAMES:
                telling[k] = telling[k + 1] = True
        if not any(telling):
            named = named or not CONTENT_NAMES.isdisjoint(words)
        elif STATE_NAMES.isdisjoint(words):
            heard.append(name)
            says = max(says, WHOLE_NAME if all(telling) else END_OF_NAME if telling[0] or telling[-1] else IN_NAME)
    return says * (BESIDE_CONTENT_NAME if named and says < WHOLE_NAME else 1.0), named, tuple(heard)


def _element(name: str, rest: str, number: int, parent: _Element | None) -> _Element:
    names: list[str] = []
    role = ""
    for key, a, b, c in ATTRIBUTE.findall(rest) if "=" in rest else ():
        value = a or b or c
        if key.lower() in ("class", "id"):
            names += value.split()
        elif key.lower() == "role":
            role = value.strip().lower()
    body = name in ("html", "body")
    content = name in CONTENT or role in ("main", "article")
    says, named, heard = (0.0, False, ()) if body else _name_says(names)
    hard = not content and not body and (name in CHROME - SOFT or role in CHROME_ROLES)
    chrome = 0.0 if body or content else 1.0 if hard or name in SOFT else says
    up = -1 if parent is None else parent.number
    return _Element(name, number, up, chrome, not hard, content, content or bool(parent and parent.content), named or bool(parent and parent.named), heard)


def _built_of(elements: list[_Element], total: int) -> set[str]:
    """Names that most of the page's text stands under, if next to none stands under no telling element.

    Chars of elements are with all below them; nested elements of one name count once.
    """
    if total <= 0:
        return set()
    below: list[bool] = []
    bare, of_name = total, Counter()
    under: list[frozenset[str]] = []
    for e in elements:
        inside = e.parent >= 0 and below[e.parent]
        around = under[e.parent] if e.parent >= 0 else frozenset()
        new = [name for name in e.telling if name not in around] if e.telling and e.chrome < WHOLE_NAME else []
        under.append(around.union(new) if new else around)
        for name in new:
            of_name[name] += e.chars
        if e.chrome >= IN_NAME and not inside:
            bare -= e.chars
        below.append(inside or e.chrome >= IN_NAME)
    return {name for name, chars in of_name.items() if chars >= BUILT_SHARE * total} if bare <= BARE_SHARE * total else set()


def _weigh(elements: list[_Element]) -> list[float]:
    """For each element how much it and those around it speak for boilerplate; parents stand before children."""
    total = 0
    for e in reversed(elements):
        if e.parent >= 0:
            elements[e.parent].chars += e.chars
        else:
            total += e.chars
    for e in reversed(elements):
        if e.parent >= 0 and (e.around_article or (e.is_content and e.chars >= ARTICLE_SHARE * total > 0)):
            elements[e.parent].around_article = True
    built = _built_of(elements, total)
    out: list[float] = []
    for e in elements:
        says = e.chrome
        if e.soft and says:
            if e.around_article or (e.name not in SOFT and says < WHOLE_NAME and e.telling and built.issuperset(e.telling)):
                says *= AROUND_ARTICLE
            elif e.name == "form" and e.chars >= FORM_SHARE * total > 0:
                says *= FORM_AROUND_TEXT
            elif e.name not in SOFT and says < WHOLE_NAME and e.chars >= WRAPPER_SHARE * total > 0:
                says *= AROUND_TEXT
        out.append(max(says, out[e.parent]) if e.parent >= 0 else says)
    return out


def blocks(page: str) -> list[Block]:
    """Blocks of text in page order, each with what the classifier looks at."""
    out: list[Block] = []
    stack: list[_Element] = []
    outer: list[int] = []  # numbers of those on the stack that are not inline
    elements: list[_Element] = []
    texts: list[str] = []
    linked: list[str] = []
    where: list[int] = []  # the innermost element of each block
    open_names: Counter[str] = Counter()

    def flush() -> None:
        if texts:
            words = " ".join(html.unescape("".join(texts)).split())
            if words:
                top = stack[-1] if stack else None
                in_links = len("".join("".join(linked).split()))
                heading = any(open_names[h] for h in HEADINGS)
                out.append(Block(words, in_links, tuple(outer[:-4:-1]), 0.0, bool(top and top.content), bool(top and top.named), heading))
                where.append(top.number if top else -1)
                if top:
                    top.chars += max(0, len(words) - in_links)
            texts.clear()
            linked.clear()

    def pop(to: int) -> None:
        nonlocal hidden
        for e in stack[to:]:
            open_names[e.name] -= 1
            hidden -= e.name in HIDDEN
            if e.name not in INLINE:
                outer.pop()
        del stack[to:]

    at, size, hidden = 0, len(page), 0
    while at < size:
        found = TOKEN.search(page, at)
        start = found.start() if found else size
        if start > at and not hidden:
            texts.append(page[at:start])
            if open_names["a"]:
                linked.append(page[at:start])
        if not found:
            break
        at = found.end()
        name = (found["name"] or "").lower()
        if not name:
            continue
        if name == "body" and hidden and not found["close"]:  # the head was not closed
            pop(0)
        if name not in INLINE:
            flush()
        if found["close"]:
            if open_names[name]:
                pop(next(k for k in range(len(stack) - 1, -1, -1) if stack[k].name == name))
            continue
        if name in VOID:
            continue
        ends = "li" if name == "li" else "p"
        if (name in ENDS_P or name == "li") and open_names[ends]:
            for place in range(len(stack) - 1, -1, -1):
                if stack[place].name == ends:
                    pop(place)
                    break
                if stack[place].name not in INLINE:
                    break
        if found["rest"].endswith("/") and name in ("svg", "math", "path"):
            continue
        elements.append(_element(name, found["rest"], len(elements), stack[-1] if stack else None))
        stack.append(elements[-1])
        if name not in INLINE:
            outer.append(elements[-1].number)
        open_names[name] += 1
        hidden += name in HIDDEN
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.IGNORECASE).search(page, at)
            at = end.end() if end else size
            pop(len(stack) - 1)
    flush()
    says = _weigh(elements)
    for block, at in zip(out, where, strict=True):
        block.chrome = says[at] if at >= 0 else 0.0
    return out


def evidence(block: Block) -> float:
    """Log odds that the block is content."""
    words = block.text.count(" ") + 1
    odds = W_BIAS + W_WORDS * min(words, 20) ** 0.5
    odds += W_CHROME * block.chrome + W_CONTENT * block.content + W_CONTENT_NAME * block.named
    odds += W_LINKS * min(1.0, block.linked / max(1, len(block.text) - words + 1))
    odds += W_STOP * (block.text[-1] in ".!?…。！？") + W_HEADING * block.heading
    return odds


def proximity(a: Block, b: Block) -> float:
    """How close two blocks are in the DOM."""
    if a.path[1:] == b.path[1:]:  # the same element, or children of the same one
        return NEAR_PARENT
    up = min((max(i, j) for i, x in enumerate(a.path) for j, y in enumerate(b.path) if x == y), default=3)
    return NEAR_PARENT if up <= 1 else NEAR_GRANDPARENT if up == 2 else FAR


def min_cut(to_source: list[float], to_sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for nodes on the source's side of a minimum cut; edges hold both ways.

    Dinic's algorithm on the nodes, a source and a sink. Nodes that no residual
    path joins to the source are on the sink's side.
    """
    n = len(to_source)
    source, sink = n, n + 1
    head: list[list[int]] = [[] for _ in range(n + 2)]
    to: list[int] = []
    capacity: list[float] = []

    def join(a: int, b: int, forth: float, back: float) -> None:
        head[a].append(len(to))
        to.append(b)
        capacity.append(forth)
        head[b].append(len(to))
        to.append(a)
        capacity.append(back)

    for k in range(n):
        through = min(to_source[k], to_sink[k])  # flows straight from source to sink
        if to_source[k] > through:
            join(source, k, to_source[k] - through, 0.0)
        if to_sink[k] > through:
            join(k, sink, to_sink[k] - through, 0.0)
    for a, b, weight in edges:
        join(a, b, weight, weight)

    def levels() -> list[int]:
        depth = [-1] * (n + 2)
        depth[source] = 0
        todo = deque([source])
        while todo:
            node = todo.popleft()
            for e in head[node]:
                if capacity[e] > 1e-9 and depth[to[e]] < 0:
                    depth[to[e]] = depth[node] + 1
                    todo.append(to[e])
        return depth

    while True:
        depth = levels()
        if depth[sink] < 0:
            return [depth[k] >= 0 for k in range(n)]
        tried = [0] * (n + 2)
        path: list[int] = []
        node = source
        while True:
            if node == sink:
                flow = min(capacity[e] for e in path)
                for e in path:
                    capacity[e] -= flow
                    capacity[e ^ 1] += flow
                path, node = [], source
                continue
            while tried[node] < len(head[node]):
                e = head[node][tried[node]]
                if capacity[e] > 1e-9 and depth[to[e]] == depth[node] + 1:
                    break
                tried[node] += 1
            if tried[node] < len(head[node]):
                path.append(e)
                node = to[e]
            elif not path:
                break
            else:
                tried_edge = path.pop()
                node = to[tried_edge ^ 1]
                tried[node] += 1


def label(found: list[Block], smooth: float = SMOOTH) -> list[bool]:
    """True for content: the labelling of least cost."""
    odds = [evidence(b) for b in found]
    edges = [(k, k + 1, smooth * proximity(found[k], found[k + 1])) for k in range(len(found) - 1)]
    last: dict[tuple[int, ...], int] = {}
    for k, block in enumerate(found):  # the nearest earlier child of the same parent, if others lie between
        parent = block.path[1:2]
        if last.get(parent, k) < k - 1:
            edges.append((last[parent], k, smooth * FAR))
        last[parent] = k
    return min_cut([max(o, 0.0) for o in odds], [max(-o, 0.0) for o in odds], edges)


def main_text(page: str | None) -> str:
    """The content blocks' texts, joined by one space."""
    found = blocks(page or "")
    return " ".join(b.text for b, kept in zip(found, label(found), strict=True) if kept)


def extract_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html).

    Null and empty html, and pages without content, give the empty string.
    page_id and url may be null and are passed on; repeated rows each keep a row.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_slices(batches):
            texts = [main_text(page) for page in part.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")

"""Main text of web pages by scoring the containers of paragraphs.

Every paragraph gives points for its length and its commas to its parent, and half of them to
its grandparent. A container's points are discounted by the share of its text that stands in
links. The best container is the article; its siblings are kept if they score well, too, or
read like running text.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

from tallybook.llm.shared import per_batch, require_columns

# Names of elements, and words in class, id and role that mark what is no article.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noframes noembed iframe xmp".split())
DROPPED = frozenset(
    "head nav footer aside form script style noscript iframe object embed svg button select "
    "option textarea template dialog menu canvas audio video map title noframes noembed xmp "
    "fieldset label input annotation annotation-xml".split()
)
BLOCKS = frozenset(
    "address article blockquote body caption center dd details div dl dt fieldset figcaption "
    "figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre td blockquote li dd h1 h2 h3 h4 h5 h6 figcaption".split())
CLOSES_P = BLOCKS - {"caption", "tbody", "td", "tfoot", "th", "thead", "tr", "html", "body"}
SAME_KIND = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
BARRIERS = DROPPED | set("math ul ol dl table body article section div main td th header".split())
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|sidebar|side-bar|menu|"
    r"nav\w*|breadcrumbs?|footer|masthead|site-header|page-header|cookies?|consent|gdpr|notices?|"
    r"alert|popup|pop-up|modal|overlay|newsletter|subscri\w+|signup|login|share|sharing|social|"
    r"related|recommend\w*|comments?|commentlist|disqus|replies|reply|respond|discussion|"
    r"pagination|pager|toolbar|widget|skip-link|copyright|legal|disclaimer|search)(?:$|[\s_-])",
    re.IGNORECASE,
)
# What a wrapper has or lacks says nothing of its own content.
LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:no|has|with|without)[_-]\S*", re.IGNORECASE)
# Names of what readers write, which may be longer than the article.
READERS = re.compile(r"comment|disqus|repl(?:y|ies)|respond", re.IGNORECASE)
# Names that a part of an article may have as well: its text decides.
TOPICAL = re.compile(
    r"(?:^|[\s_-])(?:related|recommend\w*|discussion|legal|disclaimer|search|copyright|notices?|"
    r"alert|share|sharing|social|nav\w*|menu|banner|overlay|pager|login|signup)(?:$|[\s_-])",
    re.IGNORECASE,
)
# What an article says is never dropped for its name alone.
SPOKEN = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 figure figcaption table dl li".split())
UNLIKELY_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
    "toolbar form".split()
)
LIKELY = re.compile(r"article|body|content|entry|main|page|post|story|text", re.IGNORECASE)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    # A quote opens a value behind an equals sign only.
    r"""|<([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*+(?:"[^"]*"|'[^']*')?)*+)>"""
    r"|<[a-zA-Z][^>]*(?:>|\Z)",
    re.DOTALL,
)
MARKS = re.compile(
    r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""",
    re.IGNORECASE,
)
COMMAS = re.compile(r"[,،、，]")


@dataclass(slots=True)
class Node:
    """An element; its content is text and elements in page order."""

    name: str
    parent: Node | None
    marks: dict[str, str]
    content: list = field(default_factory=list)
    score: float = 0.0
    scored: bool = False


def parse(page: str) -> Node:
    """A tree of the elements, with the end tags that authors may leave out put in."""
    root = node = Node("#root", None, {})
    at, size = 0, len(page)
    while at < size:
        match = TOKEN.search(page, at)
        if match is None:
            node.content.append(page[at:])
            break
        if match.start() > at:
            node.content.append(page[at : match.start()])
        at = match.end()
        if closing := match[1]:
            node = _closed(node, closing.lower())
        elif match[2]:
            name, attributes = match[2].lower(), match[3]
            node = _before(node, name)
            child = Node(name, node, _marks(attributes))
            node.content.append(child)
            if name in RAW:
                end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE).search(page, at)
                stop = end.start() if end else size
                child.content.append(page[at:stop])
                at = stop
                node = child
            elif name not in VOID:
                node = child
    return root


def _marks(attributes: str) -> dict[str, str]:
    if not attributes:
        return {}
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in MARKS.finditer(attributes)}


def _before(node: Node, name: str) -> Node:
    """Where a new element goes, after the elements that it ends."""
    if name in CLOSES_P:
        above = node
        while above.parent and above.name not in BARRIERS:
            if above.name == "p":
                node = above.parent
                break
            above = above.parent
    if same := SAME_KIND.get(name):
        above = node
        while above.parent and (above.name in same or above.name not in BARRIERS - same):
            if above.name in same:
                node = above.parent
            above = above.parent
    return node


def _closed(node: Node, name: str) -> Node:
    above = node
    while above.parent:
        if above.name == name:
            return above.parent
        above = above.parent
    return node


def _unlikely(node: Node) -> bool:
    return any(UNLIKELY.search(LAYOUT.sub("", node.marks.get(key, ""))) for key in ("class", "id"))


def _hidden(node: Node) -> bool:
    return "hidden" in node.marks or node.marks.get("aria-hidden") == "true"


def _wrapped(root: Node) -> tuple[dict[int, int], dict[int, int], set[int]]:
    """Of each element its text outside links and controls, and its text in links; those that
    hold a main or an article."""
    order, stack = [], [(root, False)]
    while stack:
        node, nested = stack.pop()
        order.append((node, nested))
        nested = nested or node.name == "article"
        stack += [(x, nested) for x in node.content if not isinstance(x, str)]
    plain: dict[int, int] = {}
    linked: dict[int, int] = {}
    holders: set[int] = set()
    for node, nested in reversed(order):
        size = links = 0
        for x in node.content:
            if isinstance(x, str):
                size += len(x.strip())
            else:
                size, links = size + plain[id(x)], links + linked[id(x)]
        if node.name in DROPPED and node.name != "form" or _hidden(node):
            size = links = 0
        elif node.name == "a":
            size, links = 0, size + links
        plain[id(node)], linked[id(node)] = size, links
        # An article in an article is a comment on it.
        own = node.name == "main" or node.marks.get("role") == "main" or (
            node.name == "article" and not nested and not _unlikely(node)
        )
        if node.parent and (id(node) in holders or own and size):
            holders.add(id(node.parent))
    return plain, linked, holders


def _speaks(node: Node, plain: dict[int, int], linked: dict[int, int]) -> bool:
    """An element inside an article that reads like a part of it, whatever its name."""
    names = " ".join(node.marks.get(key, "") for key in ("class", "id"))
    if not plain[id(node)] or linked[id(node)] > plain[id(node)] / 2:
        return False
    if node.name in SPOKEN:
        return not READERS.search(names) or node.name[0] == "h"
    # Of its names none may be one that no part of an article has.
    return node.name == "section" and not UNLIKELY.search(TOPICAL.sub(" ", LAYOUT.sub("", names)))


def _dropped(
    node: Node, inside: bool, plain: dict[int, int], linked: dict[int, int], holders: set[int], total: int
) -> bool:
    if node.name in DROPPED and node.name != "form":
        return True
    if node.name == "header":
        return not inside
    if _hidden(node):
        return True
    named = node.name not in ("html", "body", "article", "main") and _unlikely(node)
    role = node.marks.get("role", "").lower()
    if not named and node.name != "form" and role not in UNLIKELY_ROLES:
        return False
    if inside and named and role not in UNLIKELY_ROLES and _speaks(node, plain, linked):
        return False
    # A wrapper of the article is judged by its score, not by its name.
    if role == "main" or id(node) in holders:
        return False
    by_readers = any(READERS.search(node.marks.get(key, "")) for key in ("class", "id"))
    most = 0.9 if inside or by_readers else 0.5
    return plain[id(node)] <= most * total


def _pruned(root: Node) -> None:
    """Take out the elements that are no article."""
    plain, linked, holders = _wrapped(root)
    total = plain[id(root)]
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        inside = inside or node.name in ("article", "main")
        node.content = [
            x for x in node.content
            if isinstance(x, str) or not _dropped(x, inside, plain, linked, holders, total)
        ]
        stack += [(x, inside) for x in node.content if not isinstance(x, str)]


def _measured(root: Node) -> tuple[list[Node], dict[int, tuple[int, int, int]]]:
    """Elements in page order; of each, its text length, that in links, and its commas."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [x for x in reversed(node.content) if not isinstance(x, str)]
    sizes: dict[int, tuple[int, int, int]] = {}
    for node in reversed(order):
        length = linked = commas = 0
        for x in node.content:
            if isinstance(x, str):
                length += len(x) - x.count(" ") // 2 if x.strip() else 0
                commas += len(COMMAS.findall(x))
            else:
                a, b, c = sizes[id(x)]
                length, linked, commas = length + a, linked + b, commas + c
        sizes[id(node)] = (length, length if node.name == "a" else linked, commas)
    return order, sizes


def _scored(order: list[Node], sizes: dict[int, tuple[int, int, int]]) -> Node | None:
    """The best container."""
    for node in order:
        length, linked, commas = sizes[id(node)]
        if not length or node.parent is None:
            continue
        text_of_its_own = node.name in ("div", "section", "article", "main", "body") and any(
            isinstance(x, str) and x.strip() for x in node.content
        )
        if node.name not in PARAGRAPHS and not text_of_its_own:
            continue
        points = (1 + commas + min(length / 100, 3.0)) * (1 - linked / length)
        holder = node if text_of_its_own else node.parent
        for above, share in ((holder, 1.0), (holder.parent, 0.5)):
            if above is not None:
                above.score += points * share
                above.scored = True
    best, most = None, 0.0
    for node in order:
        if not node.scored:
            continue
        length, linked, _ = sizes[id(node)]
        score = node.score * (1 - linked / max(length, 1))
        if node.name in ("article", "main") or node.marks.get("role") == "main":
            score = score * 3 + 1
        elif any(LIKELY.search(node.marks.get(key, "")) for key in ("class", "id")):
            score = score * 1.5
        elif node.name in ("body", "html", "#root"):
            score *= 0.75
        if score > most:
            best, most = node, score
    return best


def _kept_siblings(best: Node, sizes: dict[int, tuple[int, int, int]]) -> list[Node | str]:
    """The best container and those of its siblings that belong to it, in page order.

    Some belong by themselves: headings of the page, paragraphs that read like running text, and
    what scores well. Between the first and the last of these every text does, however short. In
    a container that is not the whole page, so do paragraphs, lists, lower headings and elements
    of the same name, unless links make up much of them.
    """
    if best.parent is None or best.name in ("body", "html"):
        return [best]
    least = max(10.0, best.score * 0.2)
    page = best.parent.name in ("body", "html", "#root")
    sure: list[bool] = []
    texts: list[bool] = []
    for x in best.parent.content:
        if isinstance(x, str):
            sure.append(False)
            texts.append(bool(x.strip()))
            continue
        length, linked, commas = sizes[id(x)]
        density = linked / length if length else 1.0
        like_text = x.name == "p" and (
            length > 80 and density < 0.25 or 0 < length <= 80 and not linked and commas
        )
        title = x.name in ("h1", "h2") and 0 < length and not linked
        beside = not page and density < 0.25 and (x.name in SPOKEN | {"ul", "ol"} or x.name == best.name == "section")
        sure.append(x is best or title or like_text or beside or x.score * (1 - density) >= least)
        texts.append(density < 0.25 and x.name not in ("div", "span", "a"))
    first, last = sure.index(True), len(sure) - 1 - sure[::-1].index(True)
    return [
        x
        for i, x in enumerate(best.parent.content)
        if sure[i] or first < i < last and texts[i]
    ]


def _blocks(kept: list[Node | str]) -> list[str]:
    """The text of every block, in page order."""
    blocks: list[str] = []
    run: list[str] = []

    def end() -> None:
        if text := " ".join(html.unescape("".join(run)).split()):
            blocks.append(text)
        run.clear()

    stack: list = list(reversed(kept))
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            run.append(x)
        elif x.name == "br":
            run.append("\n")
        else:
            block = x.name in BLOCKS
            if block:
                end()
                stack.append(None)
            stack += reversed(x.content)
    end()
    return blocks


def main_text(page: str | None) -> str:
    """The article of a page, its blocks joined by an empty line; "" if there is none."""
    if not page:
        return ""
    root = parse(page)
    _pruned(root)
    order, sizes = _measured(root)
    best = _scored(order, sizes)
    if best is None:
        # No paragraph at all: what is left of the page is its text.
        return "\n\n".join(_blocks([root]))
    return "\n\n".join(_blocks(_kept_siblings(best, sizes)))


def _extract_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    # Half of a surrogate pair that a character reference gave is no text.
    texts = [
        main_text(page).encode("utf-8", "replace").decode()
        for page in batch.column("html").to_pylist()
    ]
    return pa.RecordBatch.from_arrays(
        [
            batch.column("page_id"),
            batch.column("url"),
            pa.array(texts, pa.string()),
            pa.array([len(text) for text in texts], pa.int64()),
        ],
        names=["page_id", "url", "text", "n_chars"],
    )


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    Pages are parsed where they are read; nothing is shuffled. A null or empty page has an
    empty text, as has one without an article; null and repeated ids and repeated rows give a
    row each, an empty table gives no rows, and other columns are ignored. ``n_chars`` counts
    code points.
    """
    require_columns(pages, "page_id", "url", "html")
    types = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(
        per_batch(_extract_batch),
        f"page_id {types['page_id']}, url {types['url']}, text string, n_chars bigint",
    )

"""Main text of HTML pages by tree scoring.

A page becomes a tree of elements and texts. Paragraphs pass points to their ancestors: one, one for
each comma, and one for each hundred characters up to three; the parent gets them whole, the grand-
parent half, those above a part falling with the distance. A container's score is discounted by its
link density, the share of its characters that are in links. The best container and those of its
siblings that score like it, or that read like prose, are kept; of these, all blocks that aren't
page furniture make up the text.

The tree needs no well-formed markup: unclosed paragraphs, list items and cells are closed by what
follows them, stray end tags are passed over, and a page cut off anywhere ends there.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of HTML: elements without content, with raw text, and that start a block of their own.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe noembed noframes xmp template svg math select".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead tr ul".split()
)
# A start tag of the key ends an open element of the value, unless one of the barriers lies between.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "thead": {"tr", "td", "th", "thead", "tbody", "tfoot"}, "tbody": {"tr", "td", "th", "thead", "tbody", "tfoot"},
    "tfoot": {"tr", "td", "th", "thead", "tbody", "tfoot"}, "option": {"option"}, "body": {"head"},
}
BARRIERS = frozenset("ul ol dl table menu td th div section article main aside body html form nav header footer blockquote".split())
OWN_BARRIERS = {"td": frozenset({"table", "tr"}), "th": frozenset({"table", "tr"}), "tr": frozenset({"table"}), "thead": frozenset({"table"}),
                "tbody": frozenset({"table"}), "tfoot": frozenset({"table"}), "body": frozenset()}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

# Furniture: never part of the main text.
FURNITURE = frozenset(
    "head nav footer aside form button fieldset dialog object audio video canvas map menu input label optgroup option search "
    "applet embed datalist output meter progress".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar tablist status note".split())
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|adbox|adslot|banner|sponsor\w*|promo\w*|breadcrumbs?|comments?|comment-?list|disqus|respon[ds]\w*|repl(?:y|ies)|"
    r"cookies?|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|sign-up|login|paywall|"
    r"menu|nav|navbar|navigation|topnav|subnav|footer|foot|header|masthead|topbar|toolbar|sidebar|side-?bar|side|rail|aside|widget\w*|"
    r"related|recommend\w*|more-?stories|trending|popular|share|sharing|social|follow|tags?|tag-?cloud|pagination|pager|paging|"
    r"legal|copyright|disclaimer|skip-?link|skip|hidden|sr-only|visually-hidden|print-?only|feedback|rating|reviews?|author-?box|byline-?box)(?:$|[\s_-])"
)
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text|page|hentry|prose)(?:$|[\s_-])")
# Inside an article a name counts only if all of its parts are furniture words or say no more than what kind of box it is.
BOX = (
    r"box|list|section|container|area|wrapper|wrap|block|bar|links?|form|inner|items?|posts?|articles?|stories|buttons?|icons?|panel|content|title|"
    r"thread|body|meta|author|count|unit|slot|module|group|row|cell|col|card|teaser|site|page|main|global|top|bottom|left|right|media|js|wp|\d+"
)
COMMENT = re.compile(r"(?:^|[\s_-])(?:comments?|comment-?list|disqus|respon[ds]\w*|repl(?:y|ies))(?:$|[\s_-])")
# Words that as an id may as well name a section of the article.
WEAK = frozenset("legal follow side rail popular alert notice notices tags tag rating feedback review reviews header foot skip share social related notes disclaimer copyright".split())
CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*?)(?:>|\Z)", re.S)
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
WHITE = re.compile(r"[\s\x00]+")

# A sibling is kept from this share of the best score on, or at this length with few links.
SHARE, FLOOR, PROSE, FEW_LINKS = 0.2, 10.0, 80, 0.25


class Node:
    """An element: its children are nodes and texts, in page order."""

    __slots__ = ("tag", "parent", "children", "furniture", "inside", "score", "chars", "linked", "order")

    def __init__(self, tag: str, parent: Node | None, furniture: bool = False):
        self.tag, self.parent, self.furniture = tag, parent, furniture
        # Whether it lies in an article or main, or is one.
        self.inside = False
        self.children: list[Node | str] = []
        self.score, self.chars, self.linked, self.order = 0.0, 0, 0, 0


WORDS = UNLIKELY.pattern.removeprefix(r"(?:^|[\s_-])").removesuffix(r"(?:$|[\s_-])")
WHOLE = re.compile(rf"(?:(?:{BOX})[_-])*{WORDS}(?:[_-](?:{WORDS}|{BOX}))*")


def named_furniture(classes: str, name: str) -> bool:
    """Whether the names of an element inside an article say that it is furniture: a class or an id as a whole."""
    if COMMENT.search(f"{classes} {name}") and any(WHOLE.fullmatch(w) for w in f"{classes} {name}".split()):
        return True
    return any(WHOLE.fullmatch(w) for w in classes.split()) or any(WHOLE.fullmatch(w) and w not in WEAK for w in name.split())


def is_furniture(tag: str, raw: str, inside: bool = False) -> bool:
    """Whether an element is page furniture by its name, role, class or id; ``inside`` an article more is asked of names."""
    if tag in FURNITURE:
        return True
    if not raw or raw.isspace():
        return False
    found = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(raw)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or HIDDEN.search(found.get("style", "")):
        return True
    if found.get("role", "").lower() in ROLES:
        return True
    if tag in ("html", "body", "main") or tag in HEADINGS:
        return False
    classes, name = (CAMEL.sub("-", found.get(k, "")).lower() for k in ("class", "id"))
    if tag == "article":
        # Reader comments are often marked up as articles.
        return bool(COMMENT.search(f"{classes} {name}")) and named_furniture(classes, name)
    if inside:
        return named_furniture(classes, name)
    named = CAMEL.sub("-", f"{found.get('class', '')} {found.get('id', '')}").lower()
    return bool(UNLIKELY.search(named)) and not (LIKELY.search(named) and tag in ("section", "div") and "comment" not in named and not re.search(r"(?:^|\s)(?:ads?|sidebar|footer|header|nav)(?:$|\s)", named))


def parse(page: str) -> Node:
    """Tree of a page, whatever its markup."""
    root = Node("#root", None)
    open_, forms = root, False
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            open_.children.append(page[at:])
            break
        if lt > at:
            open_.children.append(page[at:lt])
        found = TOKEN.match(page, lt) or LOOSE.match(page, lt)
        if not found:
            open_.children.append("<")
            at = lt + 1
            continue
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            node = open_
            while node is not root and node.tag != tag:
                node = node.parent
            if node is not root:
                open_ = node.parent
            elif tag == "p":
                open_.children.append(Node("p", open_))
            continue
        if tag in BLOCK:
            node, barred = open_, False
            # A block ends an open paragraph, with whatever is open inside it.
            while node is not root and node.tag not in BLOCK:
                node = node.parent
            if node is not root and node.tag == "p" and tag not in ("html", "body"):
                open_ = node.parent
        if tag in CLOSES:
            barriers, node = OWN_BARRIERS.get(tag, BARRIERS), open_
            closed = None
            while node is not root and node.tag not in barriers:
                if node.tag in CLOSES[tag]:
                    closed = node
                node = node.parent
            if closed:
                open_ = closed.parent
        raw = found[3]
        if tag in ("svg", "math") and raw.rstrip().endswith("/"):
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if tag == "plaintext":
            open_.children.append(page[at:])
            break
        node = Node(tag, open_, is_furniture(tag, raw, open_.inside))
        node.inside = open_.inside or tag in ("article", "main")
        forms = forms or tag == "form"
        open_.children.append(node)
        if tag not in VOID and not raw.rstrip().endswith("/") or tag in BLOCK and tag not in VOID:
            open_ = node
    if forms:
        forms_as_containers(root)
    return root


def forms_as_containers(root: Node) -> None:
    """A form around an article, or around most of the page's text, is no furniture."""
    chars: dict[int, int] = {}
    holds: dict[int, bool] = {}
    stack: list[tuple[Node, bool]] = [(root, False)]
    forms = []
    while stack:
        node, done = stack.pop()
        if not done:
            stack.append((node, True))
            stack += [(c, False) for c in node.children if isinstance(c, Node)]
            continue
        inner = [c for c in node.children if isinstance(c, Node)]
        chars[id(node)] = sum(len(c.strip()) for c in node.children if isinstance(c, str)) + sum(chars[id(c)] for c in inner if not c.furniture or c.tag == "form")
        holds[id(node)] = any(holds[id(c)] or c.tag in ("article", "main") and not c.furniture for c in inner)
        if node.tag == "form" and node.furniture:
            forms.append(node)
    for form in forms:
        if holds[id(form)] or chars[id(form)] >= PROSE and 2 * chars[id(form)] > chars[id(root)]:
            form.furniture = False


def squeezed(parts: list[str]) -> str:
    """Texts joined, character references decoded, white space turned into single spaces, trimmed."""
    return WHITE.sub(" ", html.unescape("".join(parts))).strip()


def paragraphs(root: Node) -> tuple[list[tuple[Node, str, int]], list[Node]]:
    """Blocks of text outside furniture, as (element, text, characters in links), and all elements with a place in page order."""
    blocks: list[tuple[Node, str, int]] = []
    nodes: list[Node] = []
    parts: list[str] = []
    links: list[str] = []

    def end(owner: Node) -> None:
        if parts:
            text = squeezed(parts)
            if text:
                blocks.append((owner, text, min(len(text), len(squeezed(links)))))
            parts.clear()
            links.clear()

    def owner_of(node: Node) -> Node:
        while node.parent is not None and node.tag not in BLOCK:
            node = node.parent
        return node

    # (element, place of the next child, open links); no recursion, pages nest as deep as they like.
    stack: list[list] = [[root, 0, 0]]
    while stack:
        top = stack[-1]
        node, k, linked = top
        if k == 0:
            node.order = len(nodes)
            nodes.append(node)
        if k == len(node.children):
            stack.pop()
            if node.tag in BLOCK or node.tag == "#root":
                end(node)
            continue
        top[1] += 1
        child = node.children[k]
        if isinstance(child, str):
            parts.append(child)
            if linked:
                links.append(child)
        elif child.tag == "br":
            parts.append(" ")
        elif child.furniture:
            if child.tag in BLOCK:
                end(owner_of(node))
        else:
            if child.tag in BLOCK:
                end(owner_of(node))
            if child.children or child.tag in BLOCK:
                stack.append([child, 0, linked + (child.tag == "a")])
    return blocks, nodes


def containers(blocks: list[tuple[Node, str, int]], nodes: list[Node]) -> list[Node]:
    """The best container and its siblings that belong to it."""
    for owner, text, linked in blocks:
        node = owner
        while node is not None:
            node.chars += len(text)
            node.linked += linked
            node = node.parent
        if owner.tag in HEADINGS or len(text) < 25 and not text.count(","):
            points = 0.25
        else:
            points = 1 + text.count(",") + min(len(text) / 100, 3)
        points *= 1 - linked / len(text)
        # Text that lies in a container itself counts for that container.
        node, level = (owner.parent or owner, 0) if owner.tag in ("p", "pre", "td", "th", "li", "dd", "dt", "blockquote") or owner.tag in HEADINGS else (owner, 0)
        while node is not None:
            node.score += points / (1 if level == 0 else 2 if level == 1 else 3 * level)
            node, level = node.parent, level + 1
    scored = [n for n in nodes if n.score > 0]
    if not scored:
        return []
    value = {id(n): n.score * (1 - n.linked / n.chars) for n in scored if n.chars}
    bonus = {"article": 1.5, "main": 1.3, "body": 0.9, "html": 0.8, "#root": 0.8}
    best = max((n for n in scored if id(n) in value), key=lambda n: (value[id(n)] * bonus.get(n.tag, 1), -n.order), default=None)
    if best is None:
        return []
    # A main or article around it holds the whole article.
    node = best
    while node is not None:
        if node.tag in ("article", "main"):
            best = node
            break
        node = node.parent
    best = shared_main(best, nodes, value)
    if best.parent is None:
        return [best]
    least, kept = max(FLOOR, value.get(id(best), 0) * SHARE), []
    for child in best.parent.children:
        if child is best:
            kept.append(child)
        elif isinstance(child, Node) and not child.furniture and child.chars:
            density = child.linked / child.chars
            if value.get(id(child), 0) * (1 - density) >= least and density < 0.5:
                kept.append(child)
            elif child.tag in HEADINGS and density < 0.5:
                kept.append(child)
            elif child.tag in ("div", "section", "p", "pre", "blockquote", "ul", "ol", "dl", "table", "figure") and best.tag not in ("article", "main"):
                if density < FEW_LINKS and (child.chars >= PROSE or density == 0):
                    kept.append(child)
    return kept


def shared_main(best: Node, nodes: list[Node], value: dict[int, float]) -> Node:
    """The main element around the best article if it holds several articles of prose, else the best."""
    main = best
    while main is not None and main.tag != "main":
        main = main.parent
    if best.tag != "article" or main is None:
        return best
    least, found = value.get(id(best), 0) * SHARE, 0
    for node in nodes:
        if node.tag == "article" and node.chars >= PROSE and node.linked / node.chars < FEW_LINKS and value.get(id(node), 0) >= least:
            above = node.parent
            while above is not None and above is not main and above.tag != "article":
                above = above.parent
            found += above is main
    return main if found > 1 else best


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in page order, one to a line; empty if there is none."""
    if not page:
        return ""
    blocks, nodes = paragraphs(parse(page))
    kept = {id(n) for n in containers(blocks, nodes)}
    found = []
    for owner, text, _ in blocks:
        node = owner
        while node is not None and id(node) not in kept:
            node = node.parent
        if node is not None:
            found.append(text)
    return "\n".join(found)


def extract(page: Column) -> Column:
    """Main text of a page; null and empty pages give the empty text."""

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return of(page)


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """One row per page: (page_id, url, text, n_chars).

    Ids and addresses come back as they are, nulls too; a null, empty or textless page has an empty
    text of 0 characters. Repeated rows give repeated rows, an empty table none; other columns play
    no part.
    """
    return pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), extract(F.col(page)).alias("text")).withColumn(
        "n_chars", F.length("text").cast("long")
    )

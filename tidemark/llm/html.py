"""Main text of web pages by scoring the tree.

Paragraphs pass points for their length and commas on to their ancestors, discounted by link density; the best container
and siblings like it are kept. Menus, forms and the like are left out by element before that, and by class or id if their text
fails as well.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, unused_name

# fixed values of the markup language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol option p pre search section summary table"
    " tbody td tfoot th thead tr ul".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
CLOSES_PARAGRAPH = BLOCKS - {"caption", "option", "tbody", "td", "tfoot", "th", "thead", "tr", "legend", "html", "body"}
# an opening tag ends these open elements, up to the nearest element of the second set
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
PARAGRAPH_LIKE = frozenset("p pre blockquote li td dd dt h1 h2 h3 h4 h5 h6 figcaption summary caption th".split())
CONTENT = frozenset(("article", "main"))

UNWANTED = frozenset(
    "nav aside footer dialog menu button select option object canvas svg template head search audio video"
    " datalist map label legend output progress meter".split()
) | RAW
# left out like clutter, but pages of some servers stand in one form whole
FORMS = frozenset(("form", "fieldset"))
UNWANTED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation"
    " menu breadcrumb breadcrumbs sidebar rail footer masthead header cookie cookies consent gdpr notice notices alert"
    " popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended"
    " comment comments disqus reply replies respond pagination pager toolbar widget copyright disclaimer skip hidden"
    " toc".split()
)
# names of layout as much as of clutter: a block so named stays if it reads like text
LAYOUT_NAMES = frozenset(
    "widget header masthead banner rail overlay modal popup notice notices alert hidden skip toc toolbar share sharing".split()
)
NOT_UNWANTED_STARTS = ("commentar", "commentat")
UNWANTED_STARTS = ("comment", "advert", "sponsor", "breadcrumb", "sidebar", "newsletter")
# classes such as "has-sidebar" say what stands beside an element, not what it is
BESIDE = ("has", "no", "with", "without", "is", "not")
UNWANTED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
COMMAS = re.compile("[,،、，]")


@dataclass
class _Node:
    tag: str
    parent: int
    unwanted: bool
    link: bool
    content: bool
    named: int = 0  # 1: its class or id is a name of layout, 2: of clutter; 3: it is a form
    score: float = 0.0
    chars: int = 0
    link_chars: int = 0


@dataclass
class _Page:
    nodes: list[_Node] = field(default_factory=list)
    blocks: list[tuple[int, str, int]] = field(default_factory=list)  # owner, text, characters in links


def _named(word: str) -> int:
    """What a class or id says of its element, see ``_Node.named``."""
    parts = [part.lower() for part in NAME_PART.findall(word)]
    if parts and parts[0] in BESIDE:
        return 0
    found = [
        part for part in parts
        if part in UNWANTED_NAMES or part.startswith(UNWANTED_STARTS) and not part.startswith(NOT_UNWANTED_STARTS)
    ]
    return 0 if not found else 1 if all(part in LAYOUT_NAMES for part in found) else 2


def _unwanted(tag: str, attributes: str, in_content: bool) -> tuple[bool, int]:
    """Whether an element is left out whatever it holds, and what its names say."""
    if tag in UNWANTED or tag == "header" and not in_content:
        return True, 0
    if tag in FORMS:
        return False, 3
    if not attributes or tag in ("html", "body", *CONTENT):
        return False, 0
    named = 0
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            named = max([named, *map(_named, value.split())])
        elif name == "role" and value.lower() in UNWANTED_ROLES:
            return True, 0
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, 0
        elif name == "style" and "display:none" in value.replace(" ", "").lower():
            return True, 0
    return False, named


def parse(html: str, by_name: bool = True) -> _Page:
    """The elements in page order and the text blocks outside unwanted elements; tags that do not fit are put up with.

    Blocks are not left out for their class or id here, but inline elements are, unless ``by_name`` is false.
    """
    page = _Page([_Node("html", -1, False, False, False)])
    nodes, stack = page.nodes, [0]
    buffer: list[tuple[str, bool]] = []

    def flush() -> None:
        if not buffer:
            return
        text = " ".join(entities.unescape("".join(t for t, _ in buffer)).split())
        if text:
            owner = next(n for n in reversed(stack) if nodes[n].tag in BLOCKS)
            linked = sum(len(" ".join(t.split())) for t, in_link in buffer if in_link)
            page.blocks.append((owner, text, min(linked, len(text))))
        buffer.clear()

    def text(part: str) -> None:
        top = nodes[stack[-1]]
        if part and not top.unwanted:
            buffer.append((part, top.link))

    def close(down_to: int) -> None:
        if any(nodes[n].tag in BLOCKS for n in stack[down_to:]):
            flush()
        del stack[down_to:]

    at, size = 0, len(html)
    while at < size:
        m = TOKEN.search(html, at)
        if m is None:
            rest = html[at:]
            # a tag that the page breaks off in
            broken = re.search(r"<[a-zA-Z/!?][^<>]*\Z", rest)
            text(rest[: broken.start()] if broken else rest)
            break
        text(html[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            continue
        tag = tag.lower()
        attributes = m[3] or m[6] or ""
        if m[1] or m[4]:
            if tag == "br" or tag == "p" and not any(nodes[n].tag == "p" for n in stack):
                text(" ")
                continue
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag == tag:
                    close(depth)
                    break
                # an inline end tag does not reach out of its block
                if tag not in BLOCKS and open_tag in BLOCKS:
                    break
            continue
        if tag in ("html", "body"):
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == "head":
                    close(depth)
            if tag == "html":
                continue
        if tag in VOID:
            if tag in ("br", "hr", "img"):
                text(" ")
                if tag == "hr":
                    flush()
            continue
        if tag in CLOSES_PARAGRAPH:
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag == "p":
                    close(depth)
                    break
                if open_tag in BLOCKS:
                    break
        if tag in ENDS:
            ended, limit = ENDS[tag]
            for depth in range(len(stack) - 1, 0, -1):
                open_tag = nodes[stack[depth]].tag
                if open_tag in limit:
                    break
                if open_tag in ended:
                    close(depth)
                    if tag != "tr":
                        break
        if tag in BLOCKS:
            flush()
        top = nodes[stack[-1]]
        content = top.content or tag in CONTENT
        unwanted, named = _unwanted(tag, attributes, top.content)
        if named and by_name and tag not in BLOCKS:
            unwanted = True
        nodes.append(
            _Node(tag, stack[-1], top.unwanted or unwanted, top.link or tag == "a", content, named if by_name or named == 3 else 0)
        )
        if tag in RAW:
            end = re.compile(rf"</{tag}\s*(?:/?\s*)>", re.IGNORECASE).search(html, at)
            at = end.end() if end else size
            continue
        if not attributes.rstrip().endswith("/") or tag in BLOCKS or tag == "a":
            stack.append(len(nodes) - 1)
    flush()
    return page


def _points(text: str, linked: int) -> float:
    return (len(COMMAS.findall(text)) + min(len(text) / 100, 3) + (len(text) >= 25)) * (1 - linked / len(text))


def _wanted_blocks(page: _Page) -> list[tuple[int, str, int]]:
    """The blocks outside elements that both their names and their text speak against.

    An element stays if it has most of the page's points, a form only if these come from a text of some length; one with a
    name of layout also if it holds the headline, or a text of some length with commas and few links.
    """
    nodes = page.nodes
    if not any(node.named for node in nodes):
        return page.blocks
    points, chars, links, commas, headline = ([0] * len(nodes) for _ in range(5))
    total = 0.0
    for owner, text, linked in page.blocks:
        own = _points(text, linked)
        total += own
        at, level_one = owner, nodes[owner].tag == "h1"
        while at >= 0:
            points[at] += own
            chars[at] += len(text)
            links[at] += linked
            commas[at] += len(COMMAS.findall(text))
            headline[at] += level_one
            at = nodes[at].parent
    gone = [False] * len(nodes)
    for n, node in enumerate(nodes):
        if node.named and chars[n]:
            few_links = links[n] < 0.3 * chars[n]
            reads = few_links and (headline[n] or chars[n] >= 140 and commas[n] >= 1 + chars[n] // 1000)
            most = few_links and points[n] > total / 2 and (node.named < 3 or chars[n] >= 400 and commas[n] >= 2)
            stays = most or node.named == 1 and reads
            gone[n] = not stays
        gone[n] = gone[n] or node.parent >= 0 and gone[node.parent]
    return [block for block in page.blocks if not gone[block[0]]]


def main_text(html: str | None) -> str:
    """The blocks of the best container and its like siblings, one per line.

    If leaving out by names leaves next to nothing of the page's text, names do not count.
    """
    page = parse(html or "")
    text = _best_text(page, _wanted_blocks(page))
    if len(text) < 200 and any(node.named in (1, 2) for node in page.nodes):
        plain = parse(html or "", by_name=False)
        whole = _best_text(plain, _wanted_blocks(plain))
        if 4 * len(text) < len(whole):
            return whole
    return text


def _best_text(page: _Page, blocks: list[tuple[int, str, int]]) -> str:
    nodes = page.nodes
    if not blocks:
        return ""
    for owner, text, linked in blocks:
        own = nodes[owner]
        points = _points(text, linked)
        # a paragraph's points go to its container, then to those above, less with every level
        at, level = (own.parent, 1) if own.tag in PARAGRAPH_LIKE and own.parent >= 0 else (owner, 1)
        while at >= 0:
            nodes[at].score += points if level == 1 else points / 2 if level == 2 else points / (3 * (level - 1))
            at, level = nodes[at].parent, level + 1
        at = owner
        while at >= 0:
            nodes[at].chars += len(text)
            nodes[at].link_chars += linked
            at = nodes[at].parent

    def final(n: int) -> float:
        return nodes[n].score * (1 - nodes[n].link_chars / nodes[n].chars) if nodes[n].chars else 0.0

    best = max((n for n in range(len(nodes)) if nodes[n].tag in BLOCKS), key=lambda n: (final(n), -n))
    # an article or main element around the best container is the container the author named
    at = best
    named = [n for n in _ancestors(nodes, best) if nodes[n].tag in CONTENT]
    if named:
        best = named[-1]
    kept = {best}
    for n, node in enumerate(nodes):
        if node.parent == nodes[best].parent and n != best and node.chars and node.tag in BLOCKS:
            density = node.link_chars / node.chars
            like = final(n) >= max(0.2 * final(best), 3.0) and density < 0.5
            paragraph = node.tag == "p" and density < 0.25 and node.chars >= 80 and not named
            if like or paragraph:
                kept.add(n)
    inside = [False] * len(nodes)
    for n, node in enumerate(nodes):
        inside[n] = n in kept or node.parent >= 0 and inside[node.parent]
    return "\n".join(text for owner, text, _ in blocks if inside[owner])


def _ancestors(nodes: list[_Node], n: int) -> Iterator[int]:
    while n >= 0:
        yield n
        n = nodes[n].parent


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """The columns of ``keep`` (all but ``html`` by default), ``text`` and ``n_chars`` (code points).

    Null and empty pages, and pages without text outside unwanted elements, have an empty text. Repeated rows stay,
    other columns pass through unread. New columns whose names are taken get underscores in front.
    """
    kept = [c for c in pages.columns if c != html] if keep is None else keep
    rest = pages.select(*[f"`{c}`" for c in kept])

    def run(htmls: list) -> Iterator[tuple]:
        for h in htmls:
            text = main_text(h)
            yield text, len(text)

    schema = f"`{unused_name(rest, 'text')}` string, `{unused_name(rest, 'n_chars')}` long"
    return map_rows(pages, [html], run, schema, keep=kept, batch=500)

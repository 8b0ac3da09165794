"""A tolerant reader of HTML: text blocks with the branch they stand in."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

import xxhash

_TOKEN = re.compile(
    r"<!--(?:-?>|.*?(?:-->|\Z))|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_SEPARATOR = re.compile(r"[-_0-9]+")

# fixed values: HTML element groups
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
_RAW_END = {tag: re.compile("</" + tag, re.I | re.A) for tag in RAW}  # on the page itself: lower() can change its length
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul".split()
)
# an opening tag of the key ends open elements of the values, up to a boundary
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"),
    "td": ("td", "th"), "th": ("td", "th"), "body": ("head",),
}
BOUNDARY = frozenset("ul ol menu dl table select article section div body html main".split())
# elements and words in class, id or role of what is not main text
SIDE_TAGS = frozenset(
    "nav header footer aside form button select option input label menu dialog svg canvas object video audio head "
    "fieldset search".split()
)
SIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "popup modal newsletter subscribe signup menu nav navbar navigation breadcrumb breadcrumbs sidebar footer header "
    "masthead comment comments disqus reply replies share sharing social related recommended widget toolbar pagination "
    "pager login search complementary contentinfo".split()
)
# names of what holds articles beside the page's own
OTHERS = frozenset("comment comments disqus reply replies related recommended".split())
HEAD_TAGS = frozenset("base basefont bgsound head link meta noframes noscript script style template title".split())
UNNAMED = frozenset("html body h1 h2 h3 h4 h5 h6".split())  # side by their tag at most
MAIN_TAGS = frozenset(("article", "main"))
WHOLE = frozenset(("#", "html", "body"))  # hold all of a page, so are no branch to remove
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
# names in a branch; what is nested deeper belongs to the branch of that depth
MAX_DEPTH = 256


@dataclass
class Element:
    tag: str
    key: int  # the branch: a hash of the names from the root down
    side: bool
    main: int  # number of the outermost article or main around it, or 0
    number: int = 0
    named: frozenset[str] = frozenset()  # its names of a side element, its tag if that is one
    heading: bool = False  # in the header of an article, whose headings are main text
    children: list[str] = field(default_factory=list)


@dataclass
class Block:
    text: str
    chain: tuple[int, ...]  # keys of the elements around it, outermost first; not of the whole page's
    side: bool
    main: int


def read(page: str, holders: frozenset[int] = frozenset()) -> tuple[list[Block], list[tuple[int, int]]]:
    """Blocks of text in page order, and for each element its branch and a hash
    of its children's names (its presentation). A name makes a side element only
    as a whole, and neither a name nor a tag does of an element that holds an
    article or main (the numbers ``holders``): pages stand in forms, and headers
    are left open. If the page has an article or main elsewhere, what is called
    comments or related, or is a side element by its tag, stays one. Headings in
    the header of an article are main text. Time is linear in the page, whatever
    its markup."""
    stack = [Element("#", 0, False, 0)]
    blocks: list[Block] = []
    styles: list[tuple[int, int]] = []
    pieces: list[str] = []
    held: dict[int, frozenset[str]] = {}  # named side elements around an article or main
    number, outside = 0, False
    places: dict[str, list[int]] = {}  # of open elements in the stack, by tag
    bounds: list[int] = []

    def flush() -> None:
        if pieces:
            text = " ".join(html.unescape("".join(pieces)).split())
            pieces.clear()
            if text:
                top = stack[-1]
                inner = [e.key for e in stack[:MAX_DEPTH] if e.tag not in WHOLE]
                blocks.append(Block(text, tuple(inner) or (top.key,), top.side, top.main))

    def close(n: int) -> None:
        """Close elements until ``n`` are open."""
        while len(stack) > n:
            top = stack[-1]
            if top.tag in BLOCK:
                flush()
            styles.append((top.key, xxhash.xxh64_intdigest("/".join(top.children)) >> 1))
            stack.pop()
            places[top.tag].pop()
            if top.tag in BOUNDARY:
                bounds.pop()

    def imply_ends(tag: str) -> None:
        """A block ends an open paragraph, an item the item before it, unless a
        boundary lies between."""
        for ended in (("p",), CLOSES.get(tag, ())):
            last = max((places[t][-1] for t in ended if places.get(t)), default=-1)
            if last > (bounds[-1] if bounds else 0):
                close(last)

    at, open_comment = 0, False
    stop = page.rfind(">") + 1  # no tag ends behind it
    for m in _TOKEN.finditer(page, 0, stop):
        if m.start() < at:
            continue
        if m.start() > at:
            if stack[-1].tag == "head" and page[at : m.start()].strip():
                close(len(stack) - 1)
            pieces.append(page[at : m.start()])
        at = m.end()
        tag = m[2] or m[5]
        if not tag:
            open_comment = at == stop and m[0].startswith("<!--") and not m[0].endswith(("-->", "<!-->", "<!--->"))
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if places.get(tag):
                close(places[tag][-1])
            elif tag in BLOCK:
                flush()
            continue
        if stack[-1].tag == "head" and tag not in HEAD_TAGS:
            close(len(stack) - 1)
        if tag in BLOCK:
            flush()
            if tag != "html":
                imply_ends(tag)
        top = stack[-1]
        names = _names(m[3] or m[6] or "")
        label = tag + "".join("." + x for x in names)
        top.children.append(tag) if not top.children or top.children[-1] != tag else None
        if tag in VOID:
            if tag == "br":
                pieces.append(" ")
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(page, at)
            at = end.start() if end else len(page)
            continue
        key = xxhash.xxh64_intdigest(label, seed=top.key & 0xFFFFFFFF) >> 1
        number += 1
        named = frozenset()
        if number not in holders and tag not in MAIN_TAGS and tag not in UNNAMED:
            named = _side_names(names) | ({tag} & SIDE_TAGS)
        heading = (not top.side and tag == "header" and top.main > 0) or (top.heading and not named)
        side = (top.side and not (heading and tag in HEADINGS)) or bool(named)
        if tag in MAIN_TAGS:
            outside |= not side
            held.update((e.number, e.named) for e in stack if e.named)
        places.setdefault(tag, []).append(len(stack))
        if tag in BOUNDARY:
            bounds.append(len(stack))
        stack.append(Element(tag, key, side, top.main or number * (tag in MAIN_TAGS), number, named, heading))
    if open_comment:
        at = len(page)
    comment = page.find("<!--", max(at, stop))
    page = page[: max(comment, at)] if comment >= 0 else page  # one that nothing ends
    if at < len(page):
        if stack[-1].tag == "head" and page[at:].strip():
            close(len(stack) - 1)
        pieces.append(page[at:])
    flush()
    close(1)
    found = frozenset(n for n, names in held.items() if not (outside and names <= OTHERS | SIDE_TAGS))
    return read(page, holders | found) if found else (blocks, styles)


def _side_names(names: list[str]) -> frozenset[str]:
    """Pieces of the names that say in all their pieces that they are no main text."""
    out: set[str] = set()
    for name in names:
        pieces = {x for x in _SEPARATOR.split(name) if x}
        out |= pieces if pieces <= SIDE_NAMES else set()
    return frozenset(out)


def _names(attributes: str) -> list[str]:
    if "=" not in attributes:
        return []
    found = [(a or b or c).lower() for _, a, b, c in _ATTRIBUTE.findall(attributes)]
    return sorted({x for value in found for x in value.split()})

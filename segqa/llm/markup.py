"""HTML as a tree of block elements and text, read in one pass that never fails."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import xxhash

DEPTH = 100  # elements nested deeper hang there side by side

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?>[^>"']++|"[^"]*+"|'[^']*+'|["'])*+)(?:>|\Z)""",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_RAW = {"script", "style", "title", "textarea", "iframe", "xmp", "noembed", "noframes"}
_VOID = {
    "area", "base", "basefont", "bgsound", "col", "embed", "frame", "hr", "img", "input", "keygen",
    "link", "meta", "param", "source", "track",
}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "nobr", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
_HEAD = {"base", "link", "meta", "script", "style", "title", "noscript", "template"}
# what an opening element closes, and the elements that shield what is open further out
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
_SHIELD = {"td", "th", "caption", "object", "button", "template"}

_OTHER_TAGS = {
    "head", "nav", "footer", "aside", "form", "button", "select", "noscript", "template", "svg",
    "math", "canvas", "object", "audio", "video", "dialog", "menu", "map", "datalist",
}
_OTHER_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored",
    "promo", "promotion", "banner", "nav", "navbar", "navigation", "navigational", "menu", "menubar",
    "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "aside", "complementary",
    "footer", "contentinfo", "cookie", "cookies", "consent", "gdpr", "notice", "notices",
    "notification", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "subscription",
    "signup", "login", "form", "search", "comment", "comments", "commentlist", "discussion",
    "disqus", "replies", "respond", "share", "sharing", "social", "related", "recommended",
    "widget", "toolbar", "skip",
}
_HEADER_WORDS = {"header", "masthead", "topbar"}


_ROLES: dict[str, str] = {}  # of keys met before


def role_of(key: str) -> str:
    """``content``, ``other`` (no main text in it), ``header`` (other unless in content) or ``""``."""
    if key not in _ROLES:
        if len(_ROLES) > 1 << 14:
            _ROLES.clear()
        _ROLES[key] = _role(key)
    return _ROLES[key]


def _role(key: str) -> str:
    tag, *names = key.split(".")
    words = {w for n in names for w in re.split(r"[-_:]+|(?<=[a-z])(?=[A-Z])", n)}
    words = {w.lower() for w in words}
    if tag in _OTHER_TAGS or words & _OTHER_WORDS:
        return "other"
    if tag in ("article", "main") or names and names[0] in ("@main", "@article"):
        return "content"
    if tag == "header" or words & _HEADER_WORDS:
        return "header"
    return ""


class Node:
    """An element, a repeated group of elements, or a text slot (key ``#``).

    ``texts`` of a slot: pages with it, characters, characters in links, and a hash of its text (0
    once texts differ). ``runs`` are the places of its texts in a page.
    """

    __slots__ = ("key", "pages", "optional", "repeated", "children", "texts", "runs", "main")

    def __init__(self, key: str, children: list[Node] | None = None):
        self.key, self.pages, self.optional, self.repeated = key, 1, False, False
        self.children = [] if children is None else children
        self.texts: list[int] | None = None
        self.runs: list[int] = []
        self.main = False


def _key(tag: str, attributes: str) -> str:
    """Tag, role and names without digits, which count things rather than name them."""
    found = _NAMED.findall(attributes) if "=" in attributes else ()
    names, role = set(), []
    for kind, value in found:
        value = value.strip("\"'")
        if kind.lower() == "role":
            role = ["@" + value.lower()]
        names.update(n for n in value.split() if not any(map(str.isdigit, n)) and "." not in n)
    return ".".join([tag, *role, *sorted(names)])


def parse(html: str) -> tuple[Node, list[str]]:
    """The page's tree and its texts, one per block, in page order.

    Character references are decoded and white space turned into one blank; inline elements belong to
    the text around them, comments, scripts, styles and titles to none.
    """
    root = Node("page")
    stack, tags = [root], ["page"]
    inline: list[tuple[str, bool]] = []
    texts: list[str] = []
    buffer: list[str] = []
    links = 0  # open links
    linked = 0  # characters of the buffer in links

    def flush() -> None:
        nonlocal linked
        if buffer:
            text = " ".join("".join(buffer).split())
            if text:
                slot = Node("#")
                digest = xxhash.xxh3_64_intdigest(text) >> 2 or 1
                slot.texts = [1, len(text), min(linked, len(text)), digest]
                slot.runs.append(len(texts))
                texts.append(text)
                stack[-1].children.append(slot)
            buffer.clear()
            linked = 0

    def close(depth: int) -> None:
        flush()
        del stack[depth:], tags[depth:]

    def close_open(wanted: set[str], shields: set[str]) -> None:
        for depth in range(len(tags) - 1, 0, -1):
            if tags[depth] in wanted:
                close(depth)
            elif tags[depth] in shields:
                return

    def add(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            buffer.append(text)
            if links:
                linked += len(text)

    at, end = 0, len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        if token is None:
            add(html[at:])
            break
        add(html[at : token.start()])
        at = token.end()
        closing, tag, attributes = token.groups()
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "wbr":
            buffer.append(" " if tag == "br" else "")
        elif closing:
            if tag in _INLINE:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        if inline.pop(k)[1]:
                            close_open({tag}, set())
                        break
                if tag == "a":
                    links = max(links - 1, 0)
            elif tag in tags:
                close(len(tags) - 1 - tags[::-1].index(tag))
        elif tag in _RAW:
            found = re.compile(f"</{tag}(?=[\\s/>]|\\Z)", re.I).search(html, at)
            at = found.start() if found else end
        elif tag in _VOID:
            if tag == "hr":
                flush()
        else:
            key = _key(tag, attributes)
            if tag in _INLINE:
                if tag == "a":
                    links += 1
                apart = role_of(key) == "other"
                inline.append((tag, apart))
                if not apart:
                    continue
                flush()
            else:
                flush()
                if "head" in tags and tag not in _HEAD and tag != "head":
                    close_open({"head"}, set())
                if tag in ("html", "body") and tag in tags:
                    continue
                close_open({"p"}, _SHIELD)
                if tag in _CLOSES:
                    close_open(*_CLOSES[tag])
                links = 0
            node = Node(key)
            stack[-1].children.append(node)
            if len(stack) < DEPTH:
                stack.append(node)
                tags.append(tag)
    flush()
    return root, texts


def leaves(node: Node) -> Iterator[Node]:
    if node.texts is not None:
        yield node
    for child in node.children:
        yield from leaves(child)

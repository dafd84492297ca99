"""The blocks of an HTML page in page order, each with the zone it stands in: one walk over the tags with a stack of open elements.

The walk is linear in the page. It follows browsers where markup is broken: an open paragraph ends where a block starts, an item
ends where the next one starts, an end tag without a start is nothing, an unclosed comment or script reaches to the end.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

OPEN, ARTICLE, CHROME = 0, 1, 2

# Element names of HTML, by what they do to the text in them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
IN_HEAD = frozenset("base link meta noscript script style template title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table "
    "tbody td tfoot th thead tr ul".split()
)
CHROME_TAGS = frozenset("aside button dialog footer form head menu nav noscript object search select svg template".split())
# A start of the key ends an open element of the values, looked for up to an element of ENDS_AT.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "body": {"head"},
}
ENDS_AT = frozenset("article aside body div dl footer form header html main nav ol section table ul".split())

# Words in class, id and role that name parts of a page beside its text.
CHROME_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts alert aside banner breadcrumb breadcrumbs comment commentlist "
    "comments complementary consent contentinfo cookie cookies dialog disqus footer gdpr hidden login masthead menu menubar "
    "menus modal nav navbar navigation newsletter notice notices notification outbrain pager pagination paywall popup promo "
    "promoted promotion recommended related replies reply respond search share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription taboola toolbar widget widgets".split()
)
# In text the same words mark comments of code, search terms and the like, so there only these count.
ADVERT_WORDS = frozenset(["ad", "ads", "advert", "advertisement", "sponsored"])
CONTAINERS = BLOCK - frozenset("dd dt h1 h2 h3 h4 h5 h6 p pre td th tr tbody thead tfoot blockquote".split())
HEADER_WORDS = frozenset(["header", "topbar"])
ARTICLE_WORDS = frozenset(["article", "entry", "post", "story"])
ARTICLE_NAMES = frozenset(
    "article articlebody article-body article-content article-text content-body entry-content main maincontent main-content "
    "main-text post-body post-content post-text postbody story story-body".split()
)
NOT_NAMES = frozenset(["has", "with", "no", "without", "is", "not"])

_TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
_NAMING = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|[\s"'/])(?:hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
_HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
_APART = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    text: str
    zone: int
    heading: bool
    linked: bool


def _attribute_zone(tag: str, attributes: str, zone: int) -> int:
    if _HIDDEN.search(attributes):
        return CHROME
    found, in_text = OPEN, tag not in BLOCK
    for attribute, double, single, bare in _NAMING.findall(attributes):
        # Ids of headings and paragraphs are anchors, named after what the text is about.
        if attribute.lower() == "id" and tag not in CONTAINERS:
            continue
        chrome = ADVERT_WORDS if in_text else CHROME_WORDS
        for name in (double or single or bare).split():
            words = [w for w in _APART.split(_HUMP.sub("-", name).lower()) if w]
            if not words or words[0] in NOT_NAMES:
                continue
            if words[0] in chrome or words[-1] in chrome:
                return CHROME
            if in_text:
                continue
            if words[-1] in HEADER_WORDS and words[0] not in ARTICLE_WORDS and zone != ARTICLE:
                return CHROME
            if "-".join(words) in ARTICLE_NAMES:
                found = ARTICLE
    return found


@lru_cache(4096)
def _own_zone(tag: str, attributes: str, zone: int) -> int:
    """The zone of an element that stands in `zone`. Nothing in chrome is text, but for the text of a page that is one form."""
    named = _attribute_zone(tag, attributes, zone) if attributes and tag not in ("html", "body", "main") else OPEN
    if named == CHROME or zone == CHROME:
        return CHROME
    if tag in CHROME_TAGS or (tag == "header" and zone != ARTICLE):
        return CHROME
    if tag in ("article", "main") or named == ARTICLE:
        return ARTICLE
    return zone


class _Walk:
    def __init__(self) -> None:
        self.blocks: list[Block] = []
        self.stack: list[tuple[str, int, int]] = []
        self.buffer: list[str] = []
        self.opened: Counter[str] = Counter()
        self.inside_links = self.outside_links = 0

    @property
    def zone(self) -> int:
        return self.stack[-1][1] if self.stack else OPEN

    def text(self, data: str) -> None:
        if not data:
            return
        data = unescape(data) if "&" in data else data
        blank = data.isspace()
        if self.stack and self.stack[-1][0] == "head" and not blank:
            self.close_to({"head"})
        self.buffer.append(data)
        if not blank:
            if self.opened["a"]:
                self.inside_links += 1
            else:
                self.outside_links += 1

    def flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            if text:
                self.blocks.append(Block(text, self.zone, self.opened["h1"] > 0, self.inside_links > 0 and not self.outside_links))
            self.buffer = []
            self.inside_links = self.outside_links = 0

    def pop(self) -> None:
        tag, zone, first = self.stack.pop()
        self.opened[tag] -= 1
        # A list outside an article in which every item is a link is a menu.
        if tag in ("ul", "ol") and zone == OPEN:
            listed = self.blocks[first:]
            if len(listed) > 1 and all(b.linked for b in listed):
                for b in listed:
                    b.zone = CHROME

    def close_to(self, names, ends_at=frozenset()) -> None:
        """End the innermost open element of `names`, with all in it, unless one of `ends_at` lies between."""
        if not any(self.opened[name] for name in names):
            return
        for k in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[k][0]
            if tag in names:
                self.flush()
                while len(self.stack) > k:
                    self.pop()
                return
            if tag in ends_at:
                return

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.buffer.append(" ")
            return
        if self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD:
            self.close_to({"head"})
        if tag in BLOCK:
            self.close_to({"p"}, ENDS_AT)
            self.flush()
        if tag in ENDS:
            self.close_to(ENDS[tag], ENDS_AT - ENDS[tag])
        if tag in VOID:
            return
        zone = self.zone
        # A form around the whole text is not a form in it.
        if tag in ("article", "main") and zone == CHROME and self._only_a_form():
            zone = OPEN
        own = (_own_zone if len(attributes) < 500 else _own_zone.__wrapped__)(tag, attributes, zone)
        if own != self.zone:
            self.flush()
        self.stack.append((tag, own, len(self.blocks)))
        self.opened[tag] += 1

    def _only_a_form(self) -> bool:
        first = next(k for k, entry in enumerate(self.stack) if entry[1] == CHROME)
        return self.stack[first][0] == "form" and all(tag in ("form", "div", "section") for tag, _, _ in self.stack[first:])

    def end(self, tag: str) -> None:
        if tag in VOID:
            return
        if tag in BLOCK:
            self.flush()
        if not self.opened[tag]:
            return
        k = len(self.stack) - 1
        while k >= 0 and self.stack[k][0] != tag and not (tag not in BLOCK and self.stack[k][0] in BLOCK):
            k -= 1
        if k >= 0 and self.stack[k][0] == tag:
            if (self.stack[k - 1][1] if k else OPEN) != self.zone:
                self.flush()
            while len(self.stack) > k:
                self.pop()


def blocks_of(html: str | None) -> list[Block]:
    """All blocks with text. NULL and empty pages have none."""
    walk, at, size = _Walk(), 0, len(html or "")
    while at < size:
        lt = html.find("<", at)
        if lt < 0:
            walk.text(html[at:])
            break
        walk.text(html[at:lt])
        mark = html[lt + 1 : lt + 2]
        if html.startswith("<!--", lt):
            at = html.find("-->", lt + 4) + 3
            if at < 3:
                break
        elif mark in ("!", "?"):
            at = html.find(">", lt) + 1
            if not at:
                break
        elif mark.isascii() and (mark.isalpha() or mark == "/"):
            found = _TAG.match(html, lt) or _LOOSE_TAG.match(html, lt)
            if not found:
                if mark == "/" and not html[lt + 2 : lt + 3].isalpha():
                    at = html.find(">", lt) + 1
                    if at:
                        continue
                break
            end, tag, attributes = found.group(1), found.group(2).lower(), found.group(3)
            at = found.end()
            if end:
                walk.end(tag)
            elif tag in RAW:
                closing = _raw_end(tag).search(html, at)
                at = closing.end() if closing else size
            else:
                walk.start(tag, attributes)
                if attributes.endswith("/") and tag == "svg":
                    walk.end(tag)
        else:
            walk.text("<")
            at = lt + 1
    walk.flush()
    while walk.stack:
        walk.pop()
    return walk.blocks


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I)

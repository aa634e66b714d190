"""Blocks of a web page: what stands in the declared article, what is page furniture, and the rest."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

ARTICLE, OPEN, FURNITURE = "article", "open", "furniture"

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
SKIPPED = frozenset(
    "script style title textarea xmp iframe noembed noframes noscript template head nav header footer aside form "
    "button select option dialog menu svg canvas object audio video map datalist".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rp rt s samp small "
    "span strike strong sub sup time tt u var wbr img nobr".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
NAMED = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside ad ads advert adverts "
    "advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice popup modal "
    "newsletter subscribe subscription signup login share sharing social related recommended comment comments "
    "disqus respond replies reply pagination pager widget".split()
)
NEGATED = frozenset("has no with without not".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>[^>\"']*+(?:(?:\"[^\"]*+\"|'[^']*+')[^>\"']*+)*+)>"
    r"|<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<rest2>[^>]*+)>"
    r"|<[!?][^>]*+>"
    r"|<[/a-zA-Z][^<>]*+\Z",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_BLANK = re.compile(r"\s+")


@dataclass
class Page:
    """Blocks in page order: (zone, text)."""

    blocks: list[tuple[str, str]] = field(default_factory=list)

    def article(self) -> list[str]:
        return [text for zone, text in self.blocks if zone == ARTICLE]


def _attributes(rest: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        found.setdefault(name.lower(), html.unescape(next((v for v in values if v), "")))
    return found


def _is_furniture(name: str, rest: str) -> bool:
    """Whether an element's role, class or id says that it is not part of the text."""
    attributes = _attributes(rest)
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if set(attributes.get("role", "").lower().split()) & ROLES:
        return True
    if re.search(r"display\s*:\s*none", attributes.get("style", ""), re.IGNORECASE):
        return True
    if name in ("html", "body", "main"):
        return False
    for label in f"{attributes.get('class', '')} {attributes.get('id', '')}".split():
        parts = [p.lower() for p in _PARTS.findall(label)]
        # the first or the last part of a label says what it is: ad-slot, left-sidebar
        if parts and not NEGATED & set(parts) and (parts[0] in NAMED or parts[-1] in NAMED):
            return True
    return False


def read(text: str | None) -> Page:
    """The blocks of a page. Unclosed elements end with their parent, stray end tags are passed over."""
    page = Page()
    if not text:
        return page
    stack: list[tuple[str, str]] = []  # open elements with their zone
    zone = OPEN
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            block = _BLANK.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if block:
                page.blocks.append((zone, block))

    at, size = 0, len(text)
    while at < size:
        tag = text.find("<", at)
        if tag < 0:
            pieces.append(text[at:])
            break
        if tag > at:
            pieces.append(text[at:tag])
        match = _TAG.match(text, tag)
        if match is None:
            pieces.append("&lt;")  # a sign in the text
            at = tag + 1
            continue
        at = match.end()
        name = match["name"] or match["name2"]
        if name is None:
            continue
        name = name.lower()
        closing, rest = match["close"] or match["close2"], match["rest"] or match["rest2"] or ""
        if closing:
            if name == "br":
                pieces.append(" ")
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    if name not in INLINE or stack[k][1] != (stack[k - 1][1] if k else OPEN):
                        flush()
                    # what was left open inside ends here as well
                    elif any(s[0] not in INLINE for s in stack[k + 1 :]):
                        flush()
                    del stack[k:]
                    zone = stack[-1][1] if stack else OPEN
                    break
            else:
                if name == "p":
                    flush()
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in VOID:
            if name == "hr":
                flush()
            continue
        if name in RAW:
            if name not in ("script", "style"):
                flush()  # a box on the page, though its content is no text
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.IGNORECASE).search(text, at)
            at = end.end() if end else size
            continue
        inner = zone
        if zone != FURNITURE:
            if name in SKIPPED or rest.strip() and _is_furniture(name, rest):
                inner = FURNITURE
            elif name in ("article", "main") or "articlebody" in rest.lower():
                inner = ARTICLE
        if name not in INLINE or inner != zone:
            flush()
        if rest.endswith("/") and name in ("svg", "path", "use"):
            continue
        stack.append((name, inner))
        zone = inner
    flush()
    return page

"""HTML to text blocks with their place in the document tree.

One pass over a page's tokens. Block-level elements, and inline ones whose
marks say what they are (an advert, a hidden part), start and end blocks;
other inline elements leave no trace. Scripts, styles and controls are
skipped. The work is linear in the length of the page.

What a page's own markup says of a block (``evidence``) comes from the
innermost telling element around it: semantic elements, and the words of
``class``, ``id`` and ``role``. Elements that hold no article whatever they
contain (navigation, comments, adverts) also cover elements that would
otherwise speak for an article.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=\"']|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(>|\Z)|<[!?/][^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")

# Element and mark names.
SKIPPED = frozenset("script style template noscript title textarea iframe object embed svg math select datalist button canvas audio video head xmp noembed noframes".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre figcaption caption summary".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
KINDS = {**dict.fromkeys("h1 h2 h3 h4 h5 h6 caption summary".split(), 0), **dict.fromkeys("p pre blockquote figcaption".split(), 1), **dict.fromkeys("li dt dd".split(), 2), **dict.fromkeys("td th".split(), 3)}
NEVER_TAGS = frozenset("nav footer aside dialog menu".split())
NEVER_WORDS = frozenset("ad ads advert adverts advertisement advertising advertorial adsbygoogle breadcrumb breadcrumbs comment comments copyright disqus footer menu nav navbar navigation pager pagination popular recommendations recommended related replies reply respond share sharing sidebar social sponsor sponsored trending".split())
AGAINST_TAGS = frozenset("form search fieldset".split())
AGAINST_WORDS = frozenset("alert banner consent cookie cookies disclaimer form gdpr legal login masthead modal newsletter notice notices notification notifications overlay paywall popup promo promotion register search signup subscribe subscription tags toolbar topbar widget".split())
ROLES_AGAINST = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
FOR_WORDS = frozenset("article body content entry main maintext post story text".split())
NEGATIONS = frozenset("has no with without hide show is".split())

#: Evidence in nats; a page that marks its article says a little against the rest.
STRONG, MARKED, OUTSIDE = 6, 2, -3
LINKS, WORDS, ENDS = 5, 12, 2
CELLS = len(set(KINDS.values()) | {4}) * LINKS * WORDS * ENDS


@dataclass
class Page:
    texts: list[str] = field(default_factory=list)
    cells: list[int] = field(default_factory=list)  # the classifier's features, one number
    evidence: list[int] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)  # container of each block
    ups: list[int] = field(default_factory=list)  # container of each container, -1 at the top


@dataclass
class _Open:
    tag: str
    strict: int
    soft: int
    never: int  # holds no article: 1 by its class, 2 whatever the page says
    inside: bool  # an article
    container: int = -1


def _marks(attributes: str) -> tuple[set[str], set[str], bool]:
    """Words of class and id, roles, and whether the element is hidden."""
    words: set[str] = set()
    roles: set[str] = set()
    hidden = False
    for name, value in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id"):
            for one in value.split():
                found = [w.lower() for w in _WORD.findall(one)]
                words.update(w for k, w in enumerate(found) if not (k and found[k - 1] in NEGATIONS))
                words.add(one.lower())
        elif name == "role":
            roles.update(value.lower().split())
        elif name == "itemprop" and value.lower() == "articlebody":
            roles.add("article")
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true") or (name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            hidden = True
    return words, roles, hidden


def _opened(tag: str, attributes: str, up: _Open) -> _Open:
    strict, soft, never, inside = up.strict, up.soft, up.never, up.inside
    words, roles, hidden = _marks(attributes) if attributes and not attributes.isspace() else (set(), set(), False)
    if tag in ("html", "body"):
        return _Open(tag, strict, soft, never, inside)
    speaks_for = words & FOR_WORDS
    if hidden or tag in NEVER_TAGS or words & NEVER_WORDS or roles & {"navigation", "complementary", "contentinfo"}:
        hard = hidden or tag in NEVER_TAGS or words & {"comment", "comments", "reply", "replies"}
        strict, never, inside = -STRONG, 2 if hard else max(never, 1), False
        soft = -STRONG if hard else soft
    elif tag == "main" or "main" in roles:
        strict = soft = STRONG
        never, inside = 0, True
    elif tag == "article" or "article" in roles:
        soft = STRONG if never < 2 else soft
        if not never:
            strict, inside = STRONG, True
    elif tag in AGAINST_TAGS or words & AGAINST_WORDS or roles & ROLES_AGAINST or ((tag == "header" or "header" in words) and not inside and not speaks_for):
        strict = soft = -STRONG
        inside = False
    elif speaks_for and not never and strict == 0:
        strict = soft = MARKED
    return _Open(tag, strict, soft, never, inside)


def _cell(text: str, linked: int, kind: int) -> int:
    words = min(WORDS - 1, (text.count(" ") + 1).bit_length() - 1)
    link = min(LINKS - 1, int(linked * (LINKS - 1) / max(len(text), 1) + 0.5))
    ends = text.rstrip("\"'”’»)]")[-1:] in (".", "!", "?", "…", ":", "。")
    return ((kind * LINKS + link) * WORDS + words) * ENDS + ends


def parse(html: str) -> Page:
    page, soft = Page(), []
    stack = [_Open("", 0, 0, 0, False)]
    count: dict[str, int] = {}
    parts: list[str] = []
    linked = links = 0  # characters inside links; whether a link is open
    skip, depth = "", 0  # an element that is skipped, and how often it is open

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split()) if parts else ""
        parts.clear()
        if text:
            here = len(stack) - 1
            kind = next((KINDS[o.tag] for o in reversed(stack[-3:]) if o.tag in KINDS), 4)
            while here and stack[here].tag in LEAVES:
                here -= 1
            chain = here
            while chain and stack[chain].container < 0:
                chain -= 1
            if stack[chain].container < 0:
                stack[chain].container = len(page.ups)
                page.ups.append(-1)
            for k in range(chain + 1, here + 1):
                stack[k].container = len(page.ups)
                page.ups.append(stack[k - 1].container)
            page.texts.append(text)
            page.cells.append(_cell(text, linked, kind))
            page.evidence.append(stack[-1].strict)
            soft.append(stack[-1].soft)
            page.parents.append(stack[here].container)
        linked = 0

    def say(text: str) -> None:
        nonlocal linked
        if text:
            text = unescape(text) if "&" in text else text
            parts.append(text)
            if links:
                linked += len(text)

    def close(at: int) -> None:
        for o in stack[at:]:
            count[o.tag] -= 1
        del stack[at:]

    at, end = 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        if m is None:
            if not skip:
                say(html[at:])
            break
        if not skip:
            say(html[at : m.start()])
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), m[1]
        if not m[4]:  # the page ends inside a tag
            break
        if skip:
            if tag == skip:
                depth += -1 if closing else 0 if m[3].endswith("/") else 1
                skip = skip if depth else ""
            continue
        if tag == "body" and not closing:
            continue
        if tag in SKIPPED:
            if tag in RAW and not closing:
                stop = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?|</{tag}\Z", re.I).search(html, at)
                at = stop.end() if stop else end
            elif not closing and tag not in VOID and not m[3].endswith("/"):
                skip, depth = tag, 1
            if tag not in ("script", "style", "noscript", "template"):
                parts.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag in ("br", "img", "input", "wbr"):
            if tag != "wbr":
                parts.append(" ")
            continue
        if tag not in BLOCKS and not closing:
            if m[3] and tag not in VOID:
                new = _opened(tag, m[3], stack[-1])
                if new.strict != stack[-1].strict and new.strict < 0:
                    flush()
                    count[tag] = count.get(tag, 0) + 1
                    stack.append(new)
            elif count.get(tag) and tag not in VOID:  # the same tag inside a marked one
                stack.append(_Open(tag, *(getattr(stack[-1], f) for f in ("strict", "soft", "never", "inside"))))
                count[tag] += 1
            continue
        if closing:
            if count.get(tag):
                flush()
                k = len(stack) - 1
                while stack[k].tag != tag:
                    k -= 1
                close(k)
            elif tag in BLOCKS:
                flush()
            if tag in BLOCKS:
                links = 0 if tag != "p" else links
            continue
        flush()
        if count.get("p"):  # a block element ends an open paragraph
            k = len(stack) - 1
            while k and stack[k].tag not in BLOCKS:
                k -= 1
            if stack[k].tag == "p":
                close(k)
        if tag in SIBLINGS:
            same, stops = SIBLINGS[tag]
            if any(count.get(t) for t in same):
                k = len(stack) - 1
                while k and stack[k].tag not in same and stack[k].tag not in stops:
                    k -= 1
                if stack[k].tag in same:
                    close(k)
        if tag != "hr":
            stack.append(_opened(tag, m[3], stack[-1]))
            count[tag] = count.get(tag, 0) + 1
    flush()
    if max(page.evidence, default=0) <= 0 and STRONG in soft:
        page.evidence = soft
    if STRONG in page.evidence:
        page.evidence = [OUTSIDE if e == 0 else e for e in page.evidence]
    return page

"""One HTML page as blocks of text, each with the style path that leads to it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

from xxhash import xxh64_intdigest

#: Elements that begin a block of their own.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Elements whose content is not text, up to their end tag.
RAW = frozenset("script style noscript iframe textarea title noembed noframes xmp".split())
#: Elements whose content is not shown, up to their end tag or the end of the element that they are in.
UNSEEN = frozenset("template svg object canvas video audio annotation annotation-xml".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are not the article, wherever they are.
ASIDE = frozenset("nav aside footer form menu dialog head button select input label fieldset search".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: An open element of these kinds ends where another of them begins.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "thead": {"thead", "tbody", "tfoot"}, "tbody": {"thead", "tbody", "tfoot"}, "tfoot": {"thead", "tbody", "tfoot"},
}
#: They keep an inner element from ending an outer one.
SCOPES = frozenset("table ul ol dl body html article section div td th".split())
#: Words of class, id and role that name what is not the article, and words that may stand beside them in one name.
_NAMES = (
    r"(?:nav|navbar|navigation|menu|menubar|breadcrumbs?|banner|masthead|site-?header|page-?header|topbar|footer|colophon|"
    r"sidebar|side-?bar|aside|complementary|widgets?|ads?|advert|adverts?|advertisement|adsense|sponsor(?:ed)?|promo(?:tion)?|"
    r"cookies?|consent|gdpr|notice|notification|alert|popup|pop-?up|modal|overlay|dialog|newsletter|subscribe|subscription|signup|"
    r"login|search|form|share|sharing|social|related|recommended|pagination|pager|comments?|commentlist|respond|reply|replies|"
    r"disqus|discussion|contentinfo|skip-?link)"
)
_BESIDE = (
    r"(?:site|page|main|post|posts|entry|articles?|stories|top|bottom|left|right|primary|secondary|global|box|bar|list|links?|area|"
    r"section|wrap|wrapper|container|block|inner|outer|unit|slot|thread|icons?|buttons?|media|item|items|content|policy|message|[0-9]+)"
)
NOT_ARTICLE = re.compile(rf"(?:{_BESIDE}[_-]+)*{_NAMES}(?:[_-]+(?:{_NAMES}|{_BESIDE}))*", re.I)
#: Ids that name readers' comments, also where other ids are only places to link to.
COMMENTS = re.compile(r"comments?|comment-?list|comments?[_-](?:area|list|section)|disqus(?:[_-]thread)?|respond", re.I)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
_NAMED = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I | re.S)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)


@dataclass
class Node:
    tag: str
    style: int  # hash of the tags and classes from the root
    aside: bool  # not the article
    inside: bool  # in an article or main element
    shown: list[str] = field(default_factory=list)  # kinds of its children, repeats as one


@dataclass
class Page:
    blocks: list[tuple[int, bool, str]]  # style path, inside an article element, text
    styles: list[tuple[int, int]]  # style path, hash of how its children are laid out


def _attributes(text: str) -> tuple[str, str, str]:
    """The classes of an element as they stand, its class and role names, and its id."""
    if not text or text.isspace():
        return "", "", ""
    found = [(m[1].lower(), m[2] or m[3] or m[4] or "") for m in _NAMED.finditer(text)]
    style = ".".join(v for k, v in found if k == "class")
    return style, " ".join(v for k, v in found if k != "id"), " ".join(v for k, v in found if k == "id")


def _named_aside(tag: str, names: str, own: str, inside: bool) -> bool:
    """Does a whole class, role or id name what is not the article? Ids of headings, sections and parts of a marked article are
    places to link to and count only where they name comments (those of headings never)."""
    if any(NOT_ARTICLE.fullmatch(name) for name in names.split()):
        return True
    if tag in HEADINGS:
        return False
    return bool((COMMENTS if inside or tag == "section" else NOT_ARTICLE).fullmatch(own.strip()))


def _end_of_unseen(html: str, at: int, tag: str, around: set[str]) -> int:
    """Where an element whose content is not shown ends: behind its end tag, or before that of an element around it."""
    inner: dict[str, int] = {}
    for token in _TOKEN.finditer(html, at):
        name = (token[2] or "").lower()
        if not name:
            continue
        if not token[1]:
            if name not in VOID and not token[3].endswith("/"):
                inner[name] = inner.get(name, 0) + 1
        elif inner.get(name):
            inner[name] -= 1
        elif name == tag:
            return token.end()
        elif name in around:
            return token.start()
    return len(html)


def parse(html: str | None) -> Page:
    """Blocks in page order, without what elements and their names say is not the article."""
    html = html or ""
    blocks: list[tuple[int, bool, str]] = []
    styles: list[tuple[int, int]] = []
    stack = [Node("", 0, False, False)]
    text: list[str] = []

    def end_block() -> None:
        node = stack[-1]
        if text:
            words = " ".join(unescape("".join(text)).split())
            text.clear()
            if words and not node.aside:
                blocks.append((node.style, node.inside, words))

    def close() -> None:
        node = stack.pop()
        if not node.aside and node.tag in BLOCKS:
            styles.append((node.style, xxh64_intdigest(",".join(node.shown)) >> 1))

    at, size = 0, len(html)
    while at < size:
        token = _TOKEN.search(html, at)
        if token is None:
            text.append(html[at:])
            break
        if token.start() > at:
            text.append(html[at : token.start()])
        at = token.end()
        tag = (token[2] or "").lower()
        if not tag:
            continue
        if token[1]:
            if tag == "br":
                text.append(" ")
            elif any(node.tag == tag for node in stack):
                if tag in BLOCKS:
                    end_block()
                while stack[-1].tag != tag:
                    close()
                close()
            continue
        if tag in RAW:
            ends = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(html, at) if not token[3].endswith("/") else None
            at = ends.end() if ends else at if token[3].endswith("/") else size
            continue
        if tag in UNSEEN:
            if not token[3].endswith("/"):
                at = _end_of_unseen(html, at, tag, {node.tag for node in stack})
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in BLOCKS and tag not in ASIDE:
            continue
        end_block()
        if tag in BLOCKS and stack[-1].tag == "p":
            close()
        ends = CLOSES.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in ends:
                while len(stack) > depth:
                    close()
                break
            if stack[depth].tag in SCOPES:
                break
        if tag in VOID:
            continue
        over = stack[-1]
        style, names, own = _attributes(token[3])
        named = tag not in ("html", "body", "article", "main") and (
            _named_aside(tag, names, own, over.inside) or bool(_HIDDEN.search(token[3]))
        )
        outside = tag == "header" and not over.inside
        comment = tag in ("article", "main") and bool(re.search(r"comment|reply", f"{names} {own}", re.I))
        aside = over.aside or tag in ASIDE or named or outside or comment
        if not over.shown or over.shown[-1] != tag:
            over.shown.append(tag)
        here = xxh64_intdigest(f"{over.style:x}/{tag}.{style}") >> 1
        stack.append(Node(tag, here, aside, over.inside or (tag in ("article", "main") and not aside)))
    end_block()
    while len(stack) > 1:
        close()
    return Page(blocks, styles)

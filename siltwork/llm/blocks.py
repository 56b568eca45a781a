"""A page's blocks of text with what its markup says of each.

A forgiving reader of HTML: tags, comments and quoted attributes by pattern, elements by a stack with the usual implied
ends, so pages may leave elements open or end anywhere. Block elements part blocks; inline ones and line breaks don't.
What a browser does not show as text of the page (scripts, styles, templates, form controls) is no block.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import cache

# Fixed values of HTML.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup p pre search section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes noscript template".split())
UNSEEN = frozenset("button select datalist svg math canvas video audio object map applet rp rt".split())
#: What an opening tag ends if it is the innermost open block (or below inline elements only).
ENDS = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tbody": {"tr", "td", "th", "tbody", "thead", "tfoot", "p"}, "tfoot": {"tr", "td", "th", "tbody", "thead", "p"}, "body": {"head"}}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements, roles and words of class and id that stand around the article or in it.
AROUND = frozenset("nav footer aside form menu dialog search".split())
ROLES_AROUND = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar tablist".split())
WORDS_AROUND = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense adslot banner banners breadcrumb breadcrumbs captcha carousel comment comments commentlist commentary consent cookie cookies copyright disclaimer disqus donate donation feedback foot footer footnav gdpr header hidden legal links login masthead menu menus menubar modal nav navbar navigation navlinks newsletter notice notices overlay pager pagination paywall popular popup print promo promos promoted promotion rail recommended recommendations register related reply replies respond respondents responses search share sharing shares sidebar sidebars side signup skip social sponsor sponsored sponsors subnav subscribe subscription survey tags tagcloud teaser teasers toc toolbar topbar trending warning widget widgets".split()
)
WORDS_IN = frozenset("article articlebody body content entry main page post postbody prose story text".split())
#: Words that also name parts of an article when a word of WORDS_IN stands beside them.
WEAK = frozenset("header tags side links print legal notice warning".split())
#: Words after which the next one tells of another part of the page.
NOT_SELF = frozenset("has with no without js is hide".split())
#: How a heading opens what follows the article.
HEADS_AROUND = re.compile(r"(?:\d+ )?(?:reader |user )?(?:comments?|responses|leave a (?:reply|comment)|related (?:articles|posts|stories)|kommentare?|commentaires?|comentarios?|advertisement|anzeige|publicité|publicidad)\b[^.!?]{0,20}$", re.I)

_TAG = re.compile(r"""<(?:!--(?:>|->|(.*?)(?:--!?>|$))|(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)|[!?/][^>]*(?:>|$))""", re.S)
_ATTRIBUTE = re.compile(r"""(?<![^\s"'/])(class|id|role|itemprop|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?(?=[\s/>"']|$)""", re.I)
_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*")
_HIDE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


@cache
def _closing(name: str) -> re.Pattern[str]:
    return re.compile(rf"</{name}(?=[\s/>])[^>]*>?", re.I)


@dataclass(slots=True)
class Element:
    name: str
    node: int = -1
    around: bool = False
    inside: bool = False
    hidden: bool = False
    depth: int = 0
    link: bool = False


@dataclass(slots=True)
class Block:
    text: str
    tag: str
    node: int
    depth: int
    linked: int
    around: bool
    inside: bool
    hidden: bool


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    #: The container of each container, -1 for the outermost.
    parents: list[int] = field(default_factory=list)


def cues(words: str) -> tuple[bool, bool]:
    """Whether the words of a class or an id name something around an article, or the article."""
    around = inside = weak = False
    for token in words.split():
        parts = [x.lower() for x in _PARTS.findall(token)]
        skip = False
        for x in [*parts, "".join(parts)]:
            if not skip:
                weak = weak or x in WEAK
                around = around or (x in WORDS_AROUND and x not in WEAK)
                inside = inside or x in WORDS_IN
            skip = x in NOT_SELF
    return around or (weak and not inside), inside and not around


def read(page: str) -> Page:
    """The page's blocks in order."""
    out = Page()
    root = Element("", node=0)
    out.parents.append(-1)
    stack, parts, linked = [root], [], 0
    block_of = [root]  # open block elements, so that the innermost is at hand
    headed: set[int] = set()  # containers that a heading of HEADS_AROUND opened

    def flush() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        size, linked = linked, 0
        if not text:
            return
        e = block_of[-1]
        # A paragraph or heading is no container: what is beside it hangs on the same one.
        around = e.around or e.node in headed
        if len(text) < 60 and (e.name in HEADINGS or e.name in ("p", "div", "legend", "summary", "dt")) and HEADS_AROUND.match(text):
            around = True
            if e.name in HEADINGS:
                headed.add(e.node)
        out.blocks.append(Block(text, e.name, e.node, e.depth, min(size, len(text)), around, e.inside, e.hidden))

    def close(upto: int) -> None:
        flush()
        del stack[upto:]
        while block_of[-1].depth >= upto and len(block_of) > 1:
            block_of.pop()

    def add_text(raw: str) -> None:
        nonlocal linked
        if not raw:
            return
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if stack[-1].link:
            linked += len(" ".join(text.split()))

    at, end = 0, len(page)
    while at < end:
        m = _TAG.search(page, at)
        if m is None:
            add_text(page[at:])
            break
        add_text(page[at : m.start()])
        at = m.end()
        slash, name, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
        if not name:
            continue
        name = name.lower()
        if slash:
            if name == "br":
                parts.append(" ")
                continue
            k = len(stack) - 1
            # An end tag ends no block outside the innermost one of its kind, and an inline one none at all.
            while k > 0 and stack[k].name != name:
                if name not in BLOCK and stack[k].name in BLOCK:
                    k = 0
                    break
                k -= 1
            if k:
                if name in BLOCK:
                    close(k)
                else:
                    del stack[k:]
            elif name in BLOCK:
                flush()
            continue
        if name == "br" or name in VOID:
            if name in BLOCK:
                flush()
            elif name in ("br", "input", "wbr"):
                parts.append("" if name == "wbr" else " ")
            continue
        if name in RAW or name in UNSEEN:
            found = _closing(name).search(page, at)
            if found:
                at = found.end()
            elif name in RAW:
                at = end
            if name in UNSEEN:
                parts.append(" ")
            continue
        parent = stack[-1]
        if name in BLOCK:
            flush()
            gone = ENDS.get(name, {"p"})
            # The innermost open block that this one ends; inline elements in it end too.
            while block_of[-1].name in gone and len(block_of) > 1:
                close(block_of[-1].depth)
            if name in HEADINGS and block_of[-1].name in HEADINGS:
                close(block_of[-1].depth)
            parent = block_of[-1]
        e = Element(name, parent.node, parent.around, parent.inside, parent.hidden, len(stack), parent.link or name == "a")
        if name in BLOCK:
            e.link = stack[-1].link and stack[-1].depth > 0 and parent.link
            around = name in AROUND or (name == "header" and not parent.inside)
            inside = name in ("article", "main")
            if rest.strip() and name not in ("html", "body"):
                for a in _ATTRIBUTE.finditer(rest):
                    key, value = a[1].lower(), a[2] or a[3] or a[4] or ""
                    if key in ("class", "id"):
                        one, two = cues(value)
                        around, inside = around or one, inside or two
                    elif key == "role":
                        around = around or value.lower() in ROLES_AROUND
                        inside = inside or value.lower() in ("main", "article")
                    elif key == "itemprop":
                        inside = inside or value == "articleBody"
                        around = around or value == "comment"
                    elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and _HIDE.search(value)):
                        e.hidden = True
            e.around, e.inside = e.around or around, e.inside or inside
            if name not in ("p", *HEADINGS):
                e.node = len(out.parents)
                out.parents.append(parent.node)
            block_of.append(e)
        stack.append(e)
    flush()
    return out

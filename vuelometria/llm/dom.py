"""A small tree of an HTML page, for the wrapper induction."""

from __future__ import annotations

import html
import re
from collections.abc import Set
from dataclasses import dataclass, field

# Element names by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe svg object".split())
BLOCK = set(
    "address article blockquote body caption center dd details dialog div dl dt fieldset figcaption figure form h1 h2 h3 h4 h5 h6 "
    "hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CLOSES_P = BLOCK | set("nav header footer aside".split())
LEFT_OUT = RAW | set("head nav header footer aside form button select input menu dialog".split())
# Words of class, id and role that mark what does not belong to an article.
MARKS = set(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs header footer cookie cookies consent notice notification alert popup modal overlay "
    "newsletter subscribe subscription comment comments disqus respond replies share sharing social related recommended widget "
    "login signup search toolbar pagination pager skip".split()
)
NEVER_MARKED = ("html", "body", "article", "main")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>",
    re.S,
)
_MARK = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)


@dataclass(eq=False)
class Element:
    tag: str
    marks: frozenset[str] = frozenset()
    #: elements and pieces of text in page order
    inner: list[Element | str] = field(default_factory=list)

    @property
    def label(self) -> str:
        """Tag and marks; words with a digit are left out, as ids count posts."""
        return ".".join([self.tag, *sorted(w for w in self.marks if w.isalpha())])

    @property
    def children(self) -> list[Element]:
        return [x for x in self.inner if isinstance(x, Element)]

    def left_out(self) -> bool:
        return self.tag in LEFT_OUT or (self.tag not in NEVER_MARKED and not self.marks.isdisjoint(MARKS))


def parse(page: str) -> Element:
    """The tree of a page; ends of p, li and others are implied as browsers do, stray end tags are passed over."""
    top = Element("")
    open_ = [top]
    at = 0
    while at < len(page):
        token = _TOKEN.search(page, at)
        text = page[at : token.start() if token else len(page)]
        if text:
            open_[-1].inner.append(html.unescape(text))
        if token is None:
            break
        at = token.end()
        tag = (token["tag"] or "").lower()
        if not tag:
            continue
        if token["close"]:
            for i in range(len(open_) - 1, 0, -1):
                if open_[i].tag == tag:
                    del open_[i:]
                    break
            continue
        _imply_ends(open_, tag)
        words = (w for m in _MARK.finditer(token["rest"]) for w in re.split(r"[^a-z0-9]+", m[1].lower()))
        element = Element(tag, frozenset(w for w in words if w))
        open_[-1].inner.append(element)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?![^\s/>])[^>]*>", re.I).search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not token["rest"].endswith("/"):
            open_.append(element)
    return top


def _imply_ends(open_: list[Element], tag: str) -> None:
    """Ends an open p before a block, and an open item of a list or table before the next."""
    ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
            "option": ("option",)}.get(tag, ())
    stops = ("ul", "ol", "dl", "table")
    for i in range(len(open_) - 1, 0, -1):
        name = open_[i].tag
        if name in ends or (name == "p" and tag in CLOSES_P):
            del open_[i:]
            return
        if name in stops or (name in BLOCK and name != "p" and not ends):
            return


def blocks(root: Element, without: Set[int] = frozenset()) -> list[str]:
    """The texts of the blocks below an element, without what does not belong to an article.

    ``without`` holds the ``id`` of elements that are left out as well.
    """
    done: list[str] = []
    piece: list[str] = []

    def end() -> None:
        text = " ".join("".join(piece).split())
        if text:
            done.append(text)
        piece.clear()

    stack: list[Element | str | None] = [root]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif isinstance(x, str):
            piece.append(x)
        elif x.tag == "br":
            piece.append(" ")
        elif x is root or not (x.left_out() or id(x) in without):
            if x.tag in BLOCK:
                end()
                stack.append(None)
            stack += reversed(x.inner)
        elif x.tag in CLOSES_P or x.tag in BLOCK:
            end()
        else:
            piece.append(" ")
    end()
    return done

"""Text blocks of an HTML page with what tells content from boilerplate. Plain functions."""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass, field
from html import unescape

#: Words of HTML; fixed values.
MATH = frozenset(
    "math maction annotation menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom "
    "mprescripts mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder "
    "munderover semantics".split()
)
INLINE = MATH | frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text goes on to their end tag, whatever is in it, and is dropped.
RAW = "script|style|textarea|title"
#: Elements whose text is dropped; an unclosed one ends with its parent.
DROPPED = frozenset("noscript template iframe svg select button head".split())
#: Of these, the ones that stand within a line of text.
IN_LINE = frozenset(("svg", "button"))
#: Any other element in an open head ends the head, and these end an open svg.
IN_HEAD = frozenset("base basefont bgsound head link meta noframes noscript template".split())
BREAKS_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 hr i img li menu meta "
    "nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Elements that never hold article text, whatever is around them.
NEVER = frozenset("nav footer aside form dialog menu fieldset legend".split())
#: Words in class, id and role that mark boilerplate.
MARKERS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline comment "
    "comments commentlist consent contentinfo cookie cookies copyright dialog disclaimer disqus footer "
    "gdpr header hidden login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification notifications overlay pager pagination popup promo promoted promotion related replies "
    "reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags toc toolbar tooltip topbar widget widgets warning alert".split()
)
#: Of these, the ones that an article inside does not cancel.
DISCUSSION = frozenset("comment comments commentlist disqus replies reply respond".split())
CONTENT_MARKERS = frozenset("article articlebody content entry main post story text body".split())

TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    rf"|<(?P<raw>{RAW})(?=[\s/>])(?P<rawattributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-z][^\s/>]*)(?P<attributes>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|</?[a-z][^>]*(?:>|\Z)|</[^>]*(?:>|\Z)",
    re.DOTALL | re.IGNORECASE,
)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
HIDDEN = re.compile(r"\bhidden\b(?!\s*=\s*[\"']?false)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.IGNORECASE)
#: A new element of the first kind ends an open one of the second, up to a border.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}


@dataclass(slots=True, eq=False)
class Element:
    tag: str
    #: 0 unknown, 1 article, 2 marked as boilerplate, 3 boilerplate whatever is inside
    kind: int
    content: bool
    link: bool
    drop: bool = False
    #: The innermost element that is not within a line of text: this one or one around it.
    outer: Element | None = None
    #: Of such an element: the next one around it, and how many there are with it.
    parent: Element | None = None
    depth: int = 0


@dataclass(slots=True, eq=False)
class Block:
    text: str
    tag: str
    kind: int
    content: bool
    linked: int  # characters in links
    outer: Element | None  # the element around it that is not within a line of text

    def parent(self) -> Element | None:
        return self.outer.parent if self.outer else None


def apart(a: Element | None, b: Element | None) -> int:
    """Steps in the tree from one element to the other; None is the page."""
    steps = 0
    while a is not b:
        if (a.depth if a else 0) >= (b.depth if b else 0):
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


@dataclass
class _Walk:
    """Open elements, with the places of each tag among them, so that no step searches all."""

    blocks: list[Block] = field(default_factory=list)
    open: list[Element] = field(default_factory=list)
    at: dict[str, list[int]] = field(default_factory=dict)
    #: Places of elements that are not within a line, and of those that are no paragraph.
    solid: list[int] = field(default_factory=list)
    firm: list[int] = field(default_factory=list)
    first_drop: int | None = None
    texts: list[str] = field(default_factory=list)
    linked: int = 0

    def push(self, element: Element) -> None:
        place, tag = len(self.open), element.tag
        self.open.append(element)
        self.at.setdefault(tag, []).append(place)
        if tag not in INLINE:
            self.solid.append(place)
            if tag != "p":
                self.firm.append(place)
        if element.drop and self.first_drop is None:
            self.first_drop = place

    def close(self, place: int) -> None:
        """End the element at this place, with all in it."""
        for element in reversed(self.open[place:]):
            self.at[element.tag].pop()
        del self.open[place:]
        for places in (self.solid, self.firm):
            while places and places[-1] >= place:
                places.pop()
        if self.first_drop is not None and self.first_drop >= place:
            self.first_drop = None

    def last(self, tag: str) -> int:
        """The place of the innermost open element of this tag, or -1."""
        places = self.at.get(tag)
        return places[-1] if places else -1

    def dropping(self) -> bool:
        return self.first_drop is not None

    def undrop(self) -> None:
        """End the outermost element whose text is dropped, with all in it."""
        self.close(self.first_drop)

    def foreign(self) -> bool:
        """Whether an svg is open, in which elements close themselves."""
        return self.dropping() and self.last("svg") >= 0

    def text(self, raw: str) -> None:
        if self.dropping():
            if self.open[-1].tag != "head" or raw.isspace():
                return
            self.undrop()  # a head holds no text
        self.texts.append(raw)
        if self.open and self.open[-1].link:
            self.linked += len(raw)

    def flush(self) -> None:
        if not self.texts:
            return
        text = " ".join(unescape("".join(self.texts)).split())
        if text:
            shown = len(self.open) if self.first_drop is None else self.first_drop
            last = self.open[shown - 1] if shown else None
            outer = last.outer if last else None
            self.blocks.append(
                Block(
                    text,
                    outer.tag if outer else "",
                    last.kind if last else 0,
                    bool(last and last.content),
                    min(self.linked, len(text)),
                    outer,
                )
            )
        self.texts, self.linked = [], 0

    def start_dropped(self, tag: str, attributes: str) -> bool:
        """Whether the element belongs to what is dropped; else that has ended."""
        top = self.open[-1].tag
        if top == "head" and tag not in IN_HEAD:
            self.undrop()
            return False
        if tag in BREAKS_SVG and self.foreign() and self.last("foreignobject") < 0 and self.last("desc") < 0:
            self.close(self.at["svg"][0])
            return self.dropping() and self.start_dropped(tag, attributes)
        if tag in ("select", "button") and self.last(tag) >= 0:
            self.close(self.at[tag][0])
            if not self.dropping():
                return False
        empty = attributes.endswith("/") and (tag == "svg" or self.foreign())
        if tag not in VOID and not empty:
            self.push(Element(tag, 0, False, False, True))
        return True

    def end_siblings(self, tag: str) -> None:
        """End paragraphs, and elements that one of this tag ends, up to a border."""
        kinds, border = CLOSES.get(tag, ((), ()))
        up_to = max(map(self.last, border)) if kinds else self.firm[-1] if self.firm else -1
        found = len(self.open)
        for kind in (*kinds, "p"):
            places = self.at.get(kind, ())
            first = bisect_right(places, up_to)
            if first < len(places):
                found = min(found, places[first])
        if found < len(self.open):
            self.close(found)

    def start(self, tag: str, attributes: str) -> None:
        if self.dropping() and self.start_dropped(tag, attributes):
            return
        if tag in DROPPED:
            if tag not in IN_LINE:
                self.flush()
            if tag != "svg" or not attributes.endswith("/"):
                self.push(Element(tag, 0, False, False, True))
            return
        if tag in MATH and attributes.endswith("/"):
            return
        inline = tag in INLINE
        if not inline:
            self.flush()
            self.end_siblings(tag)
        if tag in VOID:
            return
        above = self.open[-1] if self.open else Element("", 0, False, False)
        kind, content = above.kind, above.content
        words: set[str] = set()
        if attributes and tag not in ("body", "html") and not attributes.isspace():
            for values in NAMES.findall(attributes):
                words.update(w.lower() for w in WORD.findall("".join(values)))
        if kind < 3:
            if tag in NEVER or words & DISCUSSION or (tag == "header" and kind != 1):
                kind = 3
            elif tag in ("article", "main"):
                kind = 1
            elif words & MARKERS or (attributes and HIDDEN.search(attributes)):
                kind = 2
        content = content or tag in ("article", "main") or bool(words & CONTENT_MARKERS)
        element = Element(tag, kind, content, above.link or tag == "a", outer=above.outer)
        if not inline:
            element.outer, element.parent = element, above.outer
            element.depth = (above.outer.depth if above.outer else 0) + 1
        self.push(element)

    def end(self, tag: str) -> None:
        place = self.last(tag)
        if self.dropping():
            if place < 0:
                return
            if self.open[place].drop:
                self.close(place)
                return
            self.undrop()  # it ends with its parent
        if tag not in INLINE and tag not in IN_LINE:
            self.flush()
        if place >= 0 and (tag not in INLINE or not self.solid or place > self.solid[-1]):
            self.close(place)


def blocks(html: str) -> list[Block]:
    """The text blocks of a page, in order."""
    walk, at = _Walk(), 0
    while token := TOKEN.search(html, at):
        if token.start() > at:
            walk.text(html[at : token.start()])
        at = token.end()
        if token["raw"]:
            if token["rawattributes"].endswith("/") and walk.foreign():
                at = token.end("rawattributes") + 1
            elif not walk.dropping():
                walk.flush()
        elif token["tag"]:
            tag = token["tag"].lower()
            if token["end"]:
                walk.end(tag)
            else:
                walk.start(tag, token["attributes"])
    if at < len(html):
        walk.text(html[at:])
    walk.flush()
    return walk.blocks

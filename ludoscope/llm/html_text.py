"""Main text of web pages by two passes over their blocks: rules on each block alone, then undecided ones follow their neighbours."""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from ludoscope.llm.frames import ready

#: Thresholds of the first pass.
SHORT, LONG = 70, 200
LINKS_HIGH, LINKS_LOW = 0.5, 0.2
STOPS_HIGH, STOPS_LOW = 0.15, 0.08
#: Characters of running text from which a page has text of its own beside comments and adverts.
LEAST_OWN = 40

# Frequent function words of four languages.
STOP_WORDS = frozenset(
    """
    the of and to in a is that for it as was with be by on not he his but at are this have from or had an they which
    you were her all she there would their we him been has when who will more no if out so said what its about than into
    der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass
    sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch
    de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec elle aux son mais
    comme ou si leur y dont nous vous ces cette été être fait sans
    que el en los se del las por con no una su para es al lo como más pero sus le ha me sin sobre este ya entre cuando
    todo esta ser son dos también fue había era muy hasta desde
    """.split()
)
# Elements, class words and roles that hold no article text.
SKIPPED = frozenset("nav footer aside button select textarea label legend datalist noscript iframe template dialog menu head svg math object canvas audio video".split())
RAW = "script|style|title"
SKIPPED_WORDS = frozenset(
    """
    ad ads advert adverts advertisement advertisements advertising adsense banner sponsor sponsored sponsors promo promos promotion
    sidebar sidebars widget widgets menu menus nav navbar navigation navi breadcrumb breadcrumbs pagination pager paging
    cookie cookies consent gdpr notice notices notification notifications alert alerts popup modal overlay
    newsletter subscribe subscription signup login signin register search searchbox share sharing social follow
    related recommended recommendations popular trending teaser teasers
    comment comments commentlist disqus reply replies respond discussion
    toolbar copyright disclaimer legal footer footnav masthead topbar bottombar skip hidden print
    """.split()
)
#: Of these, the words for what readers, advertisers and the site put beside an article: such an element is not weighed against it.
FOREIGN_WORDS = frozenset(
    """
    ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo promos promotion
    cookie cookies consent gdpr newsletter subscribe subscription signup login signin register
    comment comments commentlist disqus reply replies respond discussion
    """.split()
)
#: A class that has one of these as well says something about the element's layout or state: has-comments, comments-open.
STATE_WORDS = frozenset("has with without no open closed enabled disabled allow allowed is show hide".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul
    head button select textarea noscript iframe template svg math object canvas audio video
    """.split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that the start of another block ends.
_SHORT_LIVED = frozenset("p h1 h2 h3 h4 h5 h6 dt dd li option".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)>|<[!?/][^>]*+>",
    re.S | re.I,
)
_ATTR = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[^\W\d_]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


@dataclass
class Block:
    """A stretch of text between block elements."""

    #: Text, whether it is a link, whether an inline element's class speaks against it.
    parts: list[tuple[str, bool, bool]] = field(default_factory=list)
    links: int = 0
    skipped: bool = False
    #: The elements around it whose class or id speaks against them; whether one of them is foreign to an article.
    marks: tuple[int, ...] = ()
    foreign: bool = False
    article: bool = False
    heading: bool = False
    text: str = ""
    _stops: float | None = None

    @property
    def density(self) -> float:
        """The share of links in its text."""
        return self.links / max(1, len(self.text) - self.text.count(" "))

    @property
    def stops(self) -> float:
        """The share of stop words among its words."""
        if self._stops is None:
            words = _WORD.findall(self.text.lower())
            self._stops = sum(w in STOP_WORDS for w in words) / max(1, len(words))
        return self._stops


@dataclass(slots=True)
class _Open:
    name: str
    skipped: bool
    article: bool
    marks: tuple[int, ...] = ()
    foreign: bool = False


#: What speaks against an element: nothing, its class or id or that it is a form (weighed against what it holds), a class for what is
#: foreign to an article (certain while there is other text), or its name, role, or that it is not shown.
_NONE, _CLASS, _FOREIGN, _SURE = 0, 1, 2, 3


def _against(name: str, attrs: str, inside: _Open) -> int:
    """What speaks against an element holding article text."""
    if inside.skipped or name in SKIPPED:
        return _SURE
    if name == "header" and not inside.article:
        return _SURE
    form = _CLASS if name == "form" else _NONE
    if not attrs or attrs.isspace() or name in ("html", "body", "main"):
        return form
    found = form
    for key, *values in _ATTR.findall(attrs):
        key, value = key.lower(), next((v for v in values if v), "")
        if key in ("class", "id"):
            for one in value.split():
                words = {w.lower() for w in _PARTS.findall(one)}
                if words & FOREIGN_WORDS and not words & STATE_WORDS:
                    found = _FOREIGN
                elif words & SKIPPED_WORDS or ("header" in words and not inside.article and name != "article"):
                    found = max(found, _CLASS)
        elif key == "role" and value.lower() == "form":
            found = max(found, _CLASS)
        elif key == "role" and value.lower() in SKIPPED_ROLES:
            return _SURE
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true"):
            return _SURE
        elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return _SURE
    return found


def blocks(page: str) -> list[Block]:
    """The page's blocks with text, in order. Unclosed and stray tags are put up with."""
    found: list[Block] = []
    base = _Open("", False, False)
    stack: list[_Open] = [base]
    link, breaks, n_marks = 0, 0, 0
    current = Block()

    def close() -> None:
        nonlocal current, n_marks
        # Inside a paragraph a class alone takes nothing away but links; a block all in such elements is marked as a whole.
        plain = any(not soft and not text.isspace() for text, _, soft in current.parts)
        parts = [(text, linked) for text, linked, soft in current.parts if not (plain and soft and linked)]
        text = " ".join("".join(t for t, _ in parts).split())
        if text:
            current.text = text
            current.links = sum(len("".join(t.split())) for t, linked in parts if linked)
            if not plain:
                n_marks += 1
                current.marks = (*current.marks, n_marks)
            found.append(current)
        top = stack[-1]
        current = Block(skipped=top.skipped, article=top.article, heading=top.name in HEADINGS, marks=top.marks, foreign=top.foreign)

    def put(raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        if hidden[_SURE]:
            return
        current.parts.append((text, bool(link), bool(hidden[_CLASS] or hidden[_FOREIGN])))

    at = 0
    inline: list[tuple[str, int]] = []
    hidden = [0, 0, 0, 0]
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            raw = page[at : m.start()]
            put(raw)
            if not raw.isspace():
                breaks = 0
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if not name:
            continue
        end, attrs = bool(m["end"] or m["end2"]), m["attrs"] or m["attrs2"] or ""
        if name == "br":
            breaks += 1
            if breaks > 1:
                close()
            else:
                current.parts.append((" ", False, False))
            continue
        if name not in BLOCKS:
            if name in VOID or attrs.endswith("/"):
                continue
            if name == "a":
                link = 0 if end else 1
            if end:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == name:
                        for _, gone in inline[k:]:
                            hidden[gone] -= 1
                        del inline[k:]
                        break
            else:
                gone = _against(name, attrs, stack[-1]) if (attrs or name in SKIPPED) and not stack[-1].skipped else _NONE
                inline.append((name, gone))
                hidden[gone] += 1
            continue
        breaks = 0
        close()
        # A block ends inline elements that were left open.
        inline.clear()
        link, hidden = 0, [0, 0, 0, 0]
        if end:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
        elif name not in VOID:
            if name == "body":
                del stack[1:]
            if name in ("li", "dt", "dd", "option"):
                same = ("dt", "dd") if name in ("dt", "dd") else (name,)
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name in same:
                        del stack[k:]
                        break
                    if stack[k].name not in ("p",):
                        break
            while stack[-1].name == "p" or stack[-1].name in HEADINGS:
                stack.pop()
            top = stack[-1]
            gone = _against(name, attrs, top)
            n_marks += gone == _CLASS
            marks = (*top.marks, n_marks) if gone == _CLASS else top.marks
            inside = gone != _SURE and (top.article or name in ("article", "main"))
            stack.append(_Open(name, gone == _SURE, inside, marks, top.foreign or gone == _FOREIGN))
        top = stack[-1]
        current = Block(skipped=top.skipped, article=top.article, heading=top.name in HEADINGS, marks=top.marks, foreign=top.foreign)
    if at < len(page):
        put(page[at:])
    close()
    return found


def judge(block: Block, known: bool = True) -> bool | None:
    """First pass: good, bad, or undecided (None), from the block alone. Where the stop words are not ``known``, by length and links."""
    if block.skipped:
        return False
    n = len(block.text)
    links = block.density
    if links > LINKS_HIGH or "©" in block.text and n < LONG:
        return False
    if block.heading:
        return None
    if n < SHORT:
        return False if links > LINKS_LOW else None
    if links > LINKS_LOW:
        return None if block.article and block.stops >= STOPS_HIGH else False
    if not known:
        return True
    if block.stops >= STOPS_HIGH:
        return True if n > LONG or block.article else None if block.stops < 2 * STOPS_HIGH else True
    return True if block.article and block.stops >= STOPS_LOW and n > LONG else None


def weigh(found: list[Block]) -> tuple[bool, list[int]]:
    """Whether the page's language is one of the stop words', and how much running text each block has.

    It is one of theirs if half of the long link-poor text has enough of them. Running text is link-poor and has enough stop words, if
    these are known. Comments, adverts and the like go while there is other text, however long they are. Another class, or being a form,
    speaks against an element unless it holds most of the page's running text, or none is left elsewhere.
    """
    poor = [not b.skipped and b.density <= LINKS_LOW for b in found]
    long = [b for b, x in zip(found, poor) if x and len(b.text) >= SHORT]
    known = 2 * sum(len(b.text) for b in long if b.stops >= STOPS_HIGH) >= sum(len(b.text) for b in long)
    mass = [len(b.text) if x and (not known or b.stops >= STOPS_HIGH) else 0 for b, x in zip(found, poor)]
    # What is foreign to an article is the page's text only if there is nothing else.
    if any(b.article and not b.skipped and not b.foreign for b in found) or sum(n for b, n in zip(found, mass) if not b.foreign) >= LEAST_OWN:
        for k, b in enumerate(found):
            if b.foreign:
                b.skipped, mass[k] = True, 0
    if any(b.marks for b in found):
        inside: dict[int, int] = {}
        for b, n in zip(found, mass):
            for mark in b.marks:
                inside[mark] = inside.get(mark, 0) + n
        # Against an article without such a class, a line or two do not count.
        least = LONG if any(b.article and not b.skipped and not b.marks for b in found) else SHORT
        most = {mark for mark, n in inside.items() if n >= least and 2 * n > sum(mass)}
        if not any(n for b, n in zip(found, mass) if most.issuperset(b.marks)):
            most = {mark for mark, n in inside.items() if n >= least}
        for k, b in enumerate(found):
            if not most.issuperset(b.marks):
                b.skipped, mass[k] = True, 0
    return known, mass


def settle(found: list[Block]) -> list[bool]:
    """Second pass: undecided blocks take the label of the nearest decided one in the same region, the good one in a tie.

    Skipped blocks part regions. Where articles hold half of the running text, a block outside of them is good only by itself. A region
    without any decided block is good inside an article, or where articles do not hold half; elsewhere it is bad.
    """
    known, mass = weigh(found)
    whole = any(b.article and not b.skipped for b in found) and 2 * sum(n for b, n in zip(found, mass) if b.article) >= sum(mass)
    first = [judge(b, known) for b in found]
    if whole:
        first = [x if b.article else x is True and (known or len(b.text) > LONG) for b, x in zip(found, first)]
    out = [bool(x) for x in first]
    begin = 0
    while begin < len(found):
        stop = begin
        while stop < len(found) and found[stop].skipped == found[begin].skipped:
            stop += 1
        if not found[begin].skipped:
            # From the left and from the right, how far away the last decided block is, and its label.
            near: list[tuple[int, bool]] = []
            last = None
            for i in range(begin, stop):
                last = i if first[i] is not None else last
                near.append((i - last, bool(first[last])) if last is not None else (len(found), False))
            last = None
            for i in range(stop - 1, begin - 1, -1):
                last = i if first[i] is not None else last
                if first[i] is None:
                    away, good = near[i - begin]
                    if last is not None and (last - i, not first[last]) < (away, not good):
                        away, good = last - i, bool(first[last])
                    out[i] = good if away < len(found) else found[i].article or not whole
        begin = stop
    return out


def main_text(page: str | None) -> str:
    """The article's blocks, joined by line feeds; empty if there is none."""
    if not page:
        return ""
    found = blocks(page)
    return "\n".join(b.text for b, keep in zip(found, settle(found)) if keep)


def extract_text(pages: DataFrame) -> DataFrame:
    """``pages`` without html, with text (the article) and n_chars (its code points).

    Character references are decoded, white space inside a block is one space, blocks are joined by one line feed; nothing else is
    dropped or cut. A null, empty or textless page has an empty text. All columns are kept but html and those named like a
    result; every row gets one row.
    """
    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    plain = ready(pages).select(*kept, "html")
    schema = StructType([plain.schema[c] for c in kept]).add("text", "string").add("n_chars", "long")

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 512):
                part = batch.slice(low, 512)
                texts = [main_text(page) for page in part.column("html").to_pylist()]
                extra = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept), *extra], names=[*kept, "text", "n_chars"])

    return plain.mapInArrow(work, schema)

"""Main text of web pages by block rules in two passes.

A page is cut into blocks at its block-level tags. The first pass looks at each block
alone: where it stands, how much of it is link text, how long it is and how many of its
words are stop words. It decides the clear cases. In the second pass a block that is too
short or too mixed to tell takes the label of the nearest decided blocks around it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from html import unescape
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import _text

# Fixed values of HTML: elements that begin and end a block, and whose content is no text.
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main"
    " menu nav ol optgroup option p pre search section summary table tbody td tfoot th"
    " thead tr ul".split()
)
HIDDEN = frozenset(
    "audio button canvas datalist head iframe math noscript object select svg template"
    " textarea title video".split()
)
#: Elements whose content is not parsed, up to their own end tag.
RAW = frozenset("iframe noembed noframes script style textarea title".split())
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag of these ends by itself, within the nearest of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}

#: Elements, ARIA roles and words of class names and ids that mark what is no article.
ASIDE_TAGS = frozenset("aside dialog footer form menu nav search".split())
ASIDE_ROLES = frozenset(
    "alert alertdialog banner complementary contentinfo dialog form menu menubar"
    " navigation search toolbar".split()
)
ASIDE_WORDS = frozenset(
    "ad ads adsense advert advertisement advertising adverts banner breadcrumb breadcrumbs"
    " comment comments consent cookie cookies copyright discussion disqus footer form gdpr"
    " header login masthead menu menus modal nav navbar navigation newsletter notice notices"
    " pager pagination popup promo promoted promotion reader recommendations recommended"
    " related replies reply respond responses search share sharing sidebar sidebars signup"
    " skip social sponsor sponsored subscribe subscription toolbar widget widgets".split()
)
#: Names that only say what else a page has, such as ``has-sidebar``.
ABOUT_WORDS = frozenset("closed has is no open with without".split())

#: Frequent words of English, French, German and Spanish.
STOP_WORDS = frozenset(
    "a about all an and are as at be been but by for from had has have he her his i if in is"
    " it its not of on or our she so than that the their them there they this to was we were"
    " what when which who will with would you"
    " au aux avec ce ces dans de des du elle en est et il ils je la le les leur lui mais ne"
    " nous ou par pas plus pour que qui sa se ses son sont sur un une vous"
    " aber als am auch auf aus bei das dem den der des die ein eine einer er es für hat ich"
    " im ist mit nach nicht noch nur oder sich sie sind und von vor war wie wir wird zu zum"
    " al como con del el ella entre era esta este fue ha hay la las lo los más muy no o"
    " para pero por se sin sobre su sus también un una y ya".split()
)

#: Comments, declarations, elements with raw content, tags, what is left of a tag.
_ATTRIBUTES = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+'|["'])*+"""
_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<[!?][^>]*+>?"
    rf"|<(?P<raw>{'|'.join(sorted(RAW))})(?=[\s/>]){_ATTRIBUTES}>"
    rf"|<(?P<end>/?)(?P<tag>[a-z][^\s/<>]*+)(?P<attrs>{_ATTRIBUTES})>"
    r"|</[^>]*+>|<[a-z/][^<>]*+\Z",
    re.I | re.S,
)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I) for tag in RAW}
_ATTRIBUTE = re.compile(r"""([a-z][\w:-]*)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_WORDS = re.compile(r"[^\W\d_]+")

#: Whether an element holds no article: not so, unless an article begins in it, at all.
_NO, _UNLESS_ARTICLE, _FIRMLY = range(3)


@dataclass(frozen=True)
class Rules:
    """``short``, ``long``: characters; the others are shares of words or characters."""

    short: int = 40
    long: int = 200
    stop_high: float = 0.30
    stop_low: float = 0.10
    links: float = 0.5
    stop_words: frozenset[str] = STOP_WORDS


@dataclass
class Block:
    """``region``: number of the article it stands in, 0 for none. ``label``: True for main
    text, False for anything else, None while open; ``placed``: decided by its place."""

    text: str
    link_chars: int
    heading: bool
    region: int
    placed: bool
    label: bool | None = None


class _Element(NamedTuple):
    tag: str
    region: int
    aside: int
    hidden: bool


class _Page:
    """The blocks of a page, while it is read tag by tag."""

    def __init__(self) -> None:
        self.stack = [_Element("", 0, _NO, False)]
        self.open: Counter[str] = Counter()
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.links: list[str] = []
        self.in_link = self.heading = False
        self.regions = 0

    def add(self, text: str) -> None:
        if not self.stack[-1].hidden:
            self.pieces.append(text)
            if self.in_link:
                self.links.append(text)

    def close_block(self) -> None:
        """End the block that is open; one without text is none."""
        if text := _joined(self.pieces):
            within = self.stack[-1]
            placed = within.aside != _NO
            links = len(_joined(self.links))
            self.blocks.append(Block(text, links, self.heading, within.region, placed))
        self.pieces, self.links = [], []

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.add(" ")
        elif tag == "a":
            self.in_link = True
        elif tag in BLOCKS:
            self.close_block()
            self.in_link = False
            if tag not in VOID:
                self._end_implied(tag)
                self.heading = tag in HEADINGS
                self._enter(tag, attributes)
        elif tag in HIDDEN:
            self._enter(tag, attributes)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
            return
        if tag in BLOCKS:
            self.close_block()
            self.in_link = self.heading = False
        if self.open[tag]:
            self._leave(max(i for i, e in enumerate(self.stack) if e.tag == tag))

    def _enter(self, tag: str, attributes: str) -> None:
        _, region, aside, hidden = self.stack[-1]
        names, role, unseen = _told(attributes)
        if tag in ("article", "main"):
            # It ends what a page forgot to close, and a form around everything.
            aside = _NO if aside == _UNLESS_ARTICLE else aside
            if not region and not aside:
                self.regions += 1
                region = self.regions
        if tag in ASIDE_TAGS or role in ASIDE_ROLES:
            aside = max(aside, _FIRMLY if tag in ("aside", "dialog", "footer") else _UNLESS_ARTICLE)
        elif (tag == "header" or role == "banner") and not region:
            aside = max(aside, _UNLESS_ARTICLE)
        if tag not in ("html", "body", "main") and any(_is_aside(n, region > 0) for n in names):
            aside = _FIRMLY
        self.stack.append(_Element(tag, region, aside, hidden or unseen or tag in HIDDEN))
        self.open[tag] += 1

    def _leave(self, at: int) -> None:
        for element in self.stack[at:]:
            self.open[element.tag] -= 1
        del self.stack[at:]

    def _end_implied(self, tag: str) -> None:
        if self.stack[-1].tag == "p":
            self._leave(len(self.stack) - 1)
        ended, within = IMPLIED.get(tag, ((), ()))
        if not any(self.open[t] for t in ended):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag in within:
                return
            if self.stack[i].tag in ended:
                return self._leave(i)


def _joined(pieces: Iterable[str]) -> str:
    return " ".join("".join(pieces).split())


def _told(attributes: str) -> tuple[list[str], str, bool]:
    """Class names and id, role, and whether the element is not shown."""
    names: list[str] = []
    role, unseen = "", False
    if not attributes.strip(" /"):
        return names, role, unseen
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = unescape("".join(values))
        match name.lower():
            case "class" | "id":
                names += value.split()
            case "role":
                role = value.strip().lower()
            case "style":
                unseen |= "display:none" in "".join(value.lower().split())
            case "aria-hidden":
                unseen |= value.strip().lower() == "true"
    alone = _ATTRIBUTE.sub(" ", attributes).lower().split()
    return names, role, unseen or "hidden" in alone


def _is_aside(name: str, in_article: bool) -> bool:
    """Whether the first or last word of a class name or id marks what is no article."""
    words = [w.lower() for w in _NAME_WORDS.findall(name)]
    if not words or ABOUT_WORDS.intersection(words):
        return False
    ends = {words[0], words[-1]} - ({"header"} if in_article else set())
    return not ends.isdisjoint(ASIDE_WORDS)


def blocks(html: str) -> list[Block]:
    """Blocks of a page in its order, without labels.

    Markup that is cut off or not closed is read as far as it goes.
    """
    page, at = _Page(), 0
    while found := _MARKUP.search(html, at):
        if found.start() > at:
            page.add(unescape(html[at : found.start()]))
        at = found.end()
        if found["raw"]:
            closing = _RAW_END[found["raw"].lower()].search(html, at)
            at = closing.end() if closing else len(html)
        elif found["tag"]:
            if found["end"]:
                page.end(found["tag"].lower())
            else:
                page.start(found["tag"].lower(), found["attrs"])
    page.add(unescape(html[at:]))
    page.close_block()
    return page.blocks


def first_pass(found: Sequence[Block], rules: Rules) -> None:
    """Label the blocks that are clear by themselves.

    What stands beside the article by tag, role or name, and what is mostly link text, is
    none of it. Long blocks and those rich in stop words are; a long block poor in them is
    not, unless it is in an article. Headings and short blocks stay open.
    """
    for block in found:
        n = len(block.text)
        if block.placed or block.link_chars > rules.links * n and not block.heading:
            block.label = False
        elif "\N{COPYRIGHT SIGN}" in block.text and n < rules.long and not block.region:
            block.label = False
        elif n >= rules.short and not block.heading:
            words = _WORDS.findall(block.text.lower())
            stop = sum(map(rules.stop_words.__contains__, words)) / max(1, len(words))
            if stop >= rules.stop_high or n >= rules.long and stop >= rules.stop_low:
                block.label = True
            elif n >= rules.long and not block.region:
                block.label = False


def second_pass(found: Sequence[Block]) -> None:
    """Label the open blocks by the nearest decided ones of their article, or, outside of
    articles, of the rest of the page.

    Within an article one neighbour that is main text is enough, and a block without
    neighbours is main text. Elsewhere the nearer neighbour decides; of two equally near
    a heading follows the later one, and any other block is main text if both are. What
    was decided by its place says nothing about blocks beside that place. A page with one
    article has no main text outside of it; with several, the longer of both stays.
    """
    for region in {b.region for b in found}:
        own = [b for b in found if b.region == region and not b.placed]
        before = _last_decided(own)
        after = _last_decided(own[::-1])[::-1]
        for block, one, other in zip(own, before, after, strict=True):
            if block.label is not None:
                continue
            near = sorted((x for x in (one, other) if x), key=lambda x: x[0])
            if region:
                block.label = not near or any(label for _, label in near)
            elif block.heading and other:
                block.label = other[1]
            elif len(near) == 2 and near[0][0] == near[1][0]:
                block.label = near[0][1] and near[1][1]
            else:
                block.label = bool(near) and near[0][1]
    inside, outside = (
        sum(len(b.text) for b in found if b.label and (b.region > 0) == where)
        for where in (True, False)
    )
    if inside and (inside >= outside or len({b.region for b in found} - {0}) == 1):
        for block in found:
            block.label = block.label and block.region > 0


def _last_decided(own: Sequence[Block]) -> list[tuple[int, bool] | None]:
    """For each block how far before it the last decided one is, and its label."""
    out: list[tuple[int, bool] | None] = []
    at, label = -1, None
    for i, block in enumerate(own):
        out.append(None if label is None else (i - at, label))
        if block.label is not None:
            at, label = i, block.label
    return out


def main_text(html: str, rules: Rules = Rules()) -> str:
    """Main text of one page: its blocks joined by one space, each without line breaks."""
    found = blocks(html)
    first_pass(found, rules)
    second_pass(found)
    return " ".join(b.text for b in found if b.label)


def extract(
    df: DataFrame, html: str, rules: Rules = Rules(), column: str = "text"
) -> DataFrame:
    """``df`` with the main text of each page in ``column``.

    A null or empty page and one without main text has an empty one. Pages are read whole
    and one by one; nothing is shuffled and no row is dropped. A column named like the
    new one is replaced, unless it is the page itself.
    """
    if column == html:
        raise ValueError("the page and its text need different columns")
    own = [c for c in df.columns if c != column]
    rows = df.select(*[df[c] for c in own], df[html].alias("__html"))
    schema = T.StructType([*df.select(*own).schema, T.StructField(column, T.StringType())])
    n_own = len(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, _ in _text.slices(batch, "__html"):
                texts = [main_text(page.as_py() or "", rules) for page in part.column(n_own)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:n_own], pa.array(texts, pa.string())], [*own, column]
                )

    return rows.mapInArrow(run, schema)

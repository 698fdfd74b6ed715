"""Main text of web pages by two passes of block rules.

The first pass decides blocks on their own: by the element they stand in, their share of
link text, their length and their share of stop words. Short blocks and those with few
stop words stay ambiguous; in the second pass they take the label of the nearest decided
neighbour, first among the blocks of the same region of the page.

Markup weighs, it does not decide alone: a page is limited to its articles if they hold most
of its text, and a class or form marks nothing on a page without other text. A class marks
what it holds if it has a marking word and otherwise words for places and containers only;
one with other words counts outside of articles, unless it holds most of the text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from medstrata.llm.common import column

GOOD, BAD, OPEN = "good", "bad", "ambiguous"

SHORT = 70  #: characters; a shorter block does not decide itself
STOP_WORDS = 0.2  #: share of words from which a longer block is text
LINKS = 0.5  #: share of characters in links from which a block is a menu
FEW_LINKS = 0.2  #: share of characters in links up to which a longer block can be text of a language without stop words

#: Common words of the languages the pages are in.
WORDS = frozenset(
    """
    a an and are as at be by for from has have he her his in is it its not of on or that the this to was were which will with you
    au aux avec ce cette dans de des du elle en est et il la le les leur ne ou par pas plus pour qui se son sur un une
    als auch auf aus bei bis das dem den der des die ein eine er es für im ist mit nicht noch sich sie und von war wird zu
    al como con del el en es esta la las lo los más no para pero por que se sin su sus un una y
    """.split()
)

_BLOCKS = frozenset(
    """
    address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody
    td tfoot th thead tr ul
    """.split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is not markup; none of it is text of the page, or only where scripts are off.
_RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_MAIN = frozenset(("article", "main"))
#: Elements that never hold the article, and the roles that say the same.
_OUTSIDE = frozenset("aside audio button canvas datalist dialog fieldset footer form head menu nav object select svg video".split())
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
_COMMENTS = frozenset("comment comments disqus replies".split())
#: Classes and ids that mark what is not the article, wherever it stands ...
_MARKS = frozenset(
    """
    ad ads advert advertisement adverts advertorial banner breadcrumb breadcrumbs comment comments consent cookie cookies
    disqus gdpr login menu modal nav navbar navigation newsletter notice notices pager pagination popup promo promoted promotion
    recommended related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription
    toolbar widget
    """.split()
)
#: ... and outside an article only.
_LAYOUT_MARKS = frozenset("alert bottom copyright disclaimer footer header legal masthead overlay rail side tags top topbar".split())
#: Words that say where or in what something stands, and leave it to the others what it is.
_NEUTRAL = frozenset(
    """
    aligned area articles banner bar block blocks body bottom box boxes card cards center col column container content desktop entries
    entry feed foot frame global group head holder inline inner item items js large layer layout left line link links list lists main
    mobile module news outer page panel part post posts primary region right row secondary section sections single site slot small
    sticky stories story strip tab tabs tertiary text title top unit view web wrap wrapper zone
    """.split()
)
#: Of these an element that starts anew closes the open one, up to the element that holds them.
_SAME = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(
    r"""<!--(?:>|->|.*?(?:--!?>|\Z))"""
    r"""|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>"']|"[^"]*"|'[^']*')*+)>"""
    r"""|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<rest2>[^>]*)>"""
    r"""|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'=<>`]+)))?""")
_MARK = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    """A run of text without block elements inside."""

    text: str
    linked: int  #: characters in links
    heading: bool
    paragraph: bool  #: in a p element
    outside: bool  #: in an element that does not hold the article
    region: int  #: the article or main element it stands in, 0 for none
    leaning: bool = False  #: in an element with a marking word in its class
    label: str = OPEN

    def own(self) -> int:
        return max(len(self.text) - self.linked, 0)

    def link_density(self) -> float:
        return self.linked / max(len(self.text), 1)

    def stop_density(self) -> float:
        words = re.findall(r"\w+", self.text.lower())
        return sum(w in WORDS for w in words) / max(len(words), 1)


@dataclass
class _Element:
    name: str
    marks: tuple[tuple[int, str], ...]  #: numbers and kinds of the elements around that mark it
    region: int


@dataclass
class _Page:
    stack: list[_Element] = field(default_factory=lambda: [_Element("", (), 0)])
    blocks: list[Block] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    open: dict[str, int] = field(default_factory=dict)
    regions: int = 0
    numbers: int = 0
    marks: list[tuple[tuple[int, str], ...]] = field(default_factory=list)  #: of each block

    def text(self, raw: str) -> None:
        self.parts.append((html.unescape(raw), bool(self.open.get("a"))))

    def flush(self) -> None:
        text = " ".join("".join(p for p, _ in self.parts).split())
        if text:
            top = self.stack[-1]
            linked = sum(len(" ".join(p.split())) for p, link in self.parts if link)
            heading = any(self.open.get(h) for h in _HEADINGS)
            self.blocks.append(Block(text, linked, heading, bool(self.open.get("p")), False, top.region))
            self.marks.append(top.marks)
        self.parts = []

    def start(self, name: str, rest: str) -> None:
        if name in _BLOCKS:
            self.flush()
            if self.open.get("p") and name not in ("html", "body"):
                self.close("p", ())
        if name in _SAME:
            self.close(name, _SAME[name])
        if name == "body":
            self.close("head", ())
        if name in _VOID:
            if name == "br":
                self.parts.append((" ", False))
            return
        top = self.stack[-1]
        marks, region = top.marks, top.region
        if found := _mark(name, rest, bool(region)):
            self.numbers += 1
            marks = (*marks, (self.numbers, found))
        if name in _MAIN:
            marks = tuple(m for m in marks if m[1] not in ("soft", "header", "leaning"))
            if not region:
                self.regions += 1
                region = self.regions
        self.stack.append(_Element(name, marks, region))
        self.open[name] = self.open.get(name, 0) + 1

    def close(self, name: str, limits: tuple[str, ...]) -> None:
        """Closes the innermost open ``name`` and what is open inside, unless one of ``limits`` lies between."""
        if not self.open.get(name):
            return
        at = len(self.stack) - 1
        while self.stack[at].name != name:
            if self.stack[at].name in limits:
                return
            at -= 1
        if any(e.name in _BLOCKS for e in self.stack[at:]):
            self.flush()
        for element in self.stack[at:]:
            self.open[element.name] -= 1
        del self.stack[at:]


def _mark(name: str, rest: str, in_article: bool) -> str:
    """How an element marks what it holds: "", "firm", "form", "comments", "soft" (an article inside still counts), "leaning"."""
    if name in _OUTSIDE:
        return "form" if name in ("form", "fieldset") else "firm"
    if name in ("html", "body"):
        return ""
    around = "header" if name == "header" and not in_article else ""
    if not rest or rest.isspace():
        return around
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
    if values.get("role", "").lower() in _ROLES or "hidden" in values or values.get("aria-hidden") == "true":
        return "firm"
    if re.search(r"display\s*:\s*none", values.get("style", "")):
        return "firm"
    tokens = [[w.lower() for w in _MARK.findall(t)] for t in f"{values.get('class', '')} {values.get('id', '')}".split()]
    marking = _MARKS if in_article else _MARKS | _LAYOUT_MARKS
    whole = [t for t in tokens if any(w in marking for w in t) and all(w in marking or w in _NEUTRAL for w in t)]
    if any(w in _COMMENTS for t in whole for w in t):
        return "comments"
    if name in _MAIN:
        return ""
    if around or whole:
        return around or "soft"
    return "leaning" if not in_article and any(w in marking for t in tokens for w in t) else ""


def _weighed(blocks: list[Block], marks: list[tuple[tuple[int, str], ...]]) -> None:
    """Blocks are outside by marks, unless what bears the mark is all the text that the page has.

    An element that only leans marks nothing either if it holds most of the text of a page
    without an article.
    """
    everything, held, kinds = 0, {}, {}
    text = [b.own() if not any(kind in ("firm", "header") for _, kind in some) else 0 for b, some in zip(blocks, marks)]
    for own, some in zip(text, marks):
        everything += own
        for number, kind in some:
            held[number], kinds[number] = held.get(number, 0) + own, kind
    leaning = {n for n, kind in kinds.items() if kind == "leaning"}
    article = any(b.region and not some and _stands(b) for b, some in zip(blocks, marks))
    void = {n for n in leaning if 2 * held[n] > everything and not article}
    plain = [not any(n not in void for n, _ in some) for some in marks]
    if not any(_stands(b) for b, p in zip(blocks, plain) if p):
        void |= leaning | {n for n, own in held.items() if 2 * own > everything and kinds[n] not in ("firm", "header")}
    for b, some in zip(blocks, marks):
        left = {kind for number, kind in some if number not in void}
        b.leaning = "leaning" in left
        b.outside = bool(left - {"leaning"})


def _stands(b: Block) -> bool:
    """Whether a block is text that a page may be about."""
    return not b.heading and b.link_density() <= LINKS and (len(b.text) >= SHORT or bool(b.region))


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in order, without labels; no markup makes this fail."""
    out, at = _Page(), 0
    while found := _TOKEN.search(page, at):
        if found.start() > at:
            out.text(page[at : found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            continue
        if found["end"] or found["end2"]:
            if name == "p" and not out.open.get("p"):
                out.flush()
            out.close(name, ())
        elif name in _RAW:
            end = re.compile(f"</{name}(?=[\\s/>])[^>]*>?", re.IGNORECASE).search(page, at)
            at = end.end() if end else len(page)
        else:
            out.start(name, found["rest"] or found["rest2"] or "")
    out.text(page[at:])
    out.flush()
    _weighed(out.blocks, out.marks)
    return out.blocks


def classify(blocks: list[Block]) -> list[Block]:
    """Labels the blocks of a page in two passes."""
    for b in blocks:
        b.label = _decided(b)
    unknown = [b for b in blocks if b.label == OPEN and not b.heading and len(b.text) >= SHORT and b.link_density() <= FEW_LINKS]
    if sum(b.own() for b in unknown) > _good(blocks):  # the page's language is none of those with stop words
        for b in unknown:
            b.label = GOOD
    for b in blocks:
        if b.leaning:
            b.label = BAD
    inside = [b for b in blocks if b.region and not b.outside]
    if inside and 2 * _good(inside) >= _good(blocks):
        for b in blocks:
            if not b.region:
                b.label = BAD
    by_region: dict[int, list[Block]] = {}
    for b in blocks:
        by_region.setdefault(b.region, []).append(b)
    for region, near in by_region.items():
        _inherit([b for b in near if not b.outside], GOOD if region else OPEN)
    _inherit(blocks, GOOD)
    return blocks


def _good(blocks: list[Block]) -> int:
    return sum(b.own() for b in blocks if b.label == GOOD)


def _decided(b: Block) -> str:
    if b.outside:
        return BAD
    if b.link_density() > LINKS:
        return OPEN if b.region and b.paragraph else BAD  # a linked paragraph is as the text around it
    if b.heading or len(b.text) < SHORT:
        return OPEN
    if b.stop_density() >= STOP_WORDS:
        return GOOD
    return OPEN


def _inherit(blocks: list[Block], otherwise: str) -> None:
    """Ambiguous blocks take the nearest decided label on either side; of two as near, text wins."""
    decided = [b.label != OPEN for b in blocks]
    before, last = [], None
    for i, d in enumerate(decided):
        last = i if d else last
        before.append(last)
    after, last = [None] * len(blocks), None
    for i in range(len(blocks) - 1, -1, -1):
        last = i if decided[i] else last
        after[i] = last
    labels = [b.label for b in blocks]
    for i, b in enumerate(blocks):
        if not decided[i]:
            near = [(abs(i - j), labels[j] != GOOD, labels[j]) for j in (before[i], after[i]) if j is not None]
            b.label = min(near)[2] if near else otherwise


def main_text(page: str) -> str:
    return "\n".join(b.text for b in classify(blocks_of(page)) if b.label == GOOD)


def extract(pages: DataFrame, html_column: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep``, then ``text, n_chars``: main text of each page and its code points.

    A null page is empty and has an empty text, as have pages without main text; repeated
    rows are extracted each; an empty table gives an empty one; other columns are ignored.
    """
    rows = pages.select(*[column(c) for c in keep], F.coalesce(column(html_column), F.lit("")).alias("text"))
    schema = rows.select("*", F.lit(0).cast("long").alias("n_chars")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p) for p in batch.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names
            )

    return rows.mapInArrow(run, schema)


BLOCKS = "page_id long, block_no int, text string, label string, link_density double, stop_density double, heading boolean"


def labelled_blocks(pages: DataFrame, html_column: str = "html", page_id: str = "page_id") -> DataFrame:
    """Every block of every page with its label and what the label came from."""
    rows = pages.select(column(page_id).cast("long"), F.coalesce(column(html_column), F.lit("")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [
                (number, i, b.text, b.label, b.link_density(), b.stop_density(), b.heading)
                for number, page in zip(*(c.to_pylist() for c in batch.columns))
                for i, b in enumerate(classify(blocks_of(page)))
            ]
            types = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.bool_())
            columns = list(zip(*out)) or [()] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[c.split()[0] for c in BLOCKS.split(", ")])

    return rows.mapInArrow(run, BLOCKS)


def op3_query(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))

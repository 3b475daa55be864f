"""Main text of web pages by two passes of block rules.

The page is read tag by tag; block-level tags part it into blocks. Scripts, styles, controls and the like
are never text; what a form holds is text only when the form holds most of the page's unlinked text. A block is classified by its link density, length and stop-word density, and by the
page element around it: blocks in menus, headers, footers, asides and the like are boilerplate. The
second pass decides the ambiguous short blocks from their nearest decided neighbours, in the same article
where the page marks one: both good, or the only one good, makes it good; between a good and a bad
one, a nearly good block is good, and a heading when good text follows it close by. Without decided
neighbours a block counts when it is nearly good or in an article.

Stop words decide only where they know the page's language: when all its paragraphs together do not
reach the share that makes a block good, blocks are classified by length and link density alone.

Class and id names mark boilerplate word by word; in a word as ``layout-with-sidebar`` what follows has,
with, without, no or non does not count. A mark on what holds most of the page's unlinked text is
ignored. That of comments and the like, and a name of nothing but marking words (``sidebar``), is
ignored only when no long paragraphs are left without it.

Edge cases: a null or empty page has an empty text. Broken markup is read as far as it goes: an open
tag at the page's end is dropped, an unclosed script hides the rest, stray end tags are ignored.
Character references are decoded, also those without a semicolon. Pages of any length are read whole.
Repeated rows stay; other columns pass through unless named text.
"""

from __future__ import annotations

import html
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from celluloid.llm.common import ship
from celluloid.llm.stopwords import BY_WORD

MAX_LINK_DENSITY = 0.2
SHORT_CHARS, LONG_CHARS = 70, 200
LOW_STOP_WORDS, HIGH_STOP_WORDS = 0.15, 0.25  # of a block's words; languages differ, so the low one is mild
HEADING_REACH = 200  # characters between a heading and the good text that it heads
FORM_SHARE = 3  # a form holds the page when it has more than so many times the text outside
WIDE_CHARS = 3  # characters of a letter script that one of Han or Kana stands for

# HTML element names by what they are.
HIDDEN = frozenset(
    "script style noscript template head title iframe object embed applet svg math canvas audio video "
    "button select option optgroup textarea input label datalist map".split()
)
FORMS = frozenset("form fieldset".split())
BOILERPLATE = frozenset("nav header footer aside menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Parts of class and id names that mark boilerplate.
MARKING = (
    r"(?:ads?|advert\w*|banner|breadcrumbs?|byline|comments?|cookies?|consent|disclaimer|disqus|discussion|footer|header|masthead|menu|modal|nav\w*|"
    r"newsletter|notices?|popup|promo\w*|related|repl(?:y|ies)|respond|responses|share|sharing|sidebar|side-?bar|social|sponsor\w*|subscribe|"
    r"toolbar|widgets?)"
)
MARKED = regex.compile(rf"(?:^|[^a-z]){MARKING}(?:$|[^a-z])")
WHOLE = regex.compile(rf"[^a-z]*(?:{MARKING}(?:[^a-z]+|$))+")
DISCUSSION = regex.compile(r"(?:^|[^a-z])(?:comments?|disqus|discussion|repl(?:y|ies)|respond|responses)(?:$|[^a-z])")
ABOUT = regex.compile(r"(?:^|[^a-z])(?:has|with|without|no|non)[^a-z].*", regex.DOTALL)  # says what the element has or lacks
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert menu menubar form".split())

# what marks an element as boilerplate: that it is a form; a part of its class or id; all of it, or its role; its name
FORM, PART, NAME, ELEMENT = 0, 1, 2, 3

TAG = regex.compile(r"<(?:!--.*?(?:-->|$)|!\[CDATA\[.*?(?:\]\]>|$)|[!?][^>]*(?:>|$)|(?<end>/?)(?<name>[a-zA-Z][^\s/>]*)(?<rest>(?:=\s*+(?:\"[^\"]*+(?:\"|$)|'[^']*+(?:'|$))|[^>])*+)(?:>|$))", regex.DOTALL)
ATTRIBUTE = regex.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", regex.IGNORECASE)
SPACES = regex.compile(r"\s+")
WORDS = regex.compile(r"[\p{L}\p{M}\p{N}]+")
WIDE = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}]")


@dataclass
class Block:
    text: str
    linked: int  # characters inside links
    boilerplate: bool
    heading: bool
    article: int = 0  # number of the article it is in; 0: none

    @cached_property
    def words(self) -> tuple[int, int]:
        """Words, and stop words among them."""
        found = WORDS.findall(self.text.lower())
        return len(found), sum(w in BY_WORD for w in found)


@lru_cache(maxsize=4096)
def _named(names: str) -> int:
    """PART or NAME when a class or id marks boilerplate, otherwise 0."""
    mark = 0
    for name in names.replace("_", "-").split():
        name = ABOUT.sub("", name)
        if MARKED.search(name):
            mark = max(mark, NAME if WHOLE.fullmatch(name) or DISCUSSION.search(name) else PART)
    return mark


def _marked(rest: str) -> tuple[int, bool]:
    """(boilerplate, hidden) by a tag's attributes."""
    boilerplate, hidden = 0, False
    if "=" in rest or "hidden" in rest:
        for name, *values in ATTRIBUTE.findall(rest):
            name, value = name.lower(), "".join(values).lower()
            if name in ("class", "id"):
                boilerplate = max(boilerplate, _named(value))
            elif name == "role":
                boilerplate = max(boilerplate, NAME if value in ROLES else 0)
            elif name == "style":
                hidden |= "display:none" in value.replace(" ", "")
            elif name == "hidden" or value == "true":
                hidden = True
    return boilerplate, hidden


class Reader:
    """Blocks of a page, in page order."""

    def __init__(self):
        self.blocks: list[Block] = []
        self.open: list[tuple[str, int, bool, int]] = []  # element, place of its mark in marks, hidden, article
        self.names: Counter[str] = Counter()  # of open elements
        self.hidden = 0  # open elements that hide their text
        self.headings = 0  # and those that are headings
        self.inside: list[int] = []  # places of open elements that are articles
        self.marked: list[int] = []  # and of those that have a mark
        self.now: tuple[int, ...] | None = ()  # marks that text is under here; None: not worked out yet
        self.marks: list[int] = [FORM]  # kind of each mark; the first is none
        self.under: list[tuple[int, ...]] = []  # marks that each block is under
        self.articles = 0
        self.parts: list[str] = []
        self.links: list[str] = []
        self.heading = False

    def flush(self) -> None:
        text = SPACES.sub(" ", html.unescape("".join(self.parts))).strip()
        if text:
            linked = len(SPACES.sub(" ", html.unescape(" ".join(self.links))).strip())
            inside = self.inside[-1] if self.inside else 0
            if self.now is None:
                # a marked wrapper around the article does not count; menus, asides and the like do anywhere
                self.now = tuple(m for k, m in ((k, self.open[k][1]) for k in self.marked) if k >= inside or self.marks[m] == ELEMENT)
            self.blocks.append(Block(text, linked, bool(self.now), self.heading, self.open[inside][3] if self.inside else 0))
            self.under.append(self.now)
        self.parts, self.links, self.heading = [], [], False

    def text(self, piece: str) -> None:
        if piece and not self.hidden:
            self.parts.append(piece)
            if self.names["a"]:
                self.links.append(piece)
            if self.headings:
                self.heading = True

    def _push(self, name: str, mark: int, hidden: bool, article: int) -> None:
        self.names[name] += 1
        self.hidden += hidden
        self.headings += name in HEADINGS
        if article:
            self.inside.append(len(self.open))
        if mark:
            self.marked.append(len(self.open))
        if article or mark:
            self.now = None
        self.open.append((name, mark, hidden, article))

    def _close(self, place: int) -> None:
        """Ends the element at the place and all inside it."""
        for name, mark, hidden, article in self.open[place:]:
            self.names[name] -= 1
            self.hidden -= hidden
            self.headings -= name in HEADINGS
            if article or mark:
                self.now = None
        del self.open[place:]
        for places in (self.inside, self.marked):
            while places and places[-1] >= place:
                places.pop()

    def start(self, name: str, rest: str) -> None:
        if name in BLOCKS:
            self.flush()
            if name in ("p", "li", "dt", "dd", "tr", "td", "th", "option", *HEADINGS):
                self._close_implied(name)
        elif name == "br":
            self.text(" ")
        if name in VOID or (rest.endswith("/") and name not in BLOCKS):
            return
        boilerplate, hidden = _marked(rest)
        article = 0
        if name in ("article", "main"):
            article = self.articles = self.articles + 1
        kind = boilerplate if name not in ("html", "body", "main", "article") else 0
        if name in BOILERPLATE and not self._in_article(name):
            kind = ELEMENT
        if kind or name in FORMS:
            self.marks.append(kind if kind == ELEMENT or name not in FORMS else FORM)
        self._push(name, len(self.marks) - 1 if kind or name in FORMS else 0, hidden or name in HIDDEN, article)

    def _in_article(self, name: str) -> bool:
        """A header inside an article is the article's own."""
        return name == "header" and bool(self.inside)

    def _close_implied(self, name: str) -> None:
        """An element that its next sibling, or any block for a paragraph, ends."""
        ended = {"li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}
        ends = ended.get(name, {"p", *(HEADINGS if name in HEADINGS else ())})
        barrier = {"ul", "ol", "dl", "table", "div", "article", "section", "body", "td", "th", "li", "dd", "blockquote", "main"} - ends
        for place in range(len(self.open) - 1, -1, -1):
            element = self.open[place][0]
            if element in barrier:
                return
            if element in ends:
                self._close(place)

    def end(self, name: str) -> None:
        if name in BLOCKS:
            self.flush()
        if not self.names[name]:
            return
        for place in range(len(self.open) - 1, -1, -1):
            if self.open[place][0] == name:
                self._close(place)
                return
            if name not in BLOCKS and self.open[place][0] in BLOCKS:
                return

    def read(self, page: str) -> list[Block]:
        at = 0
        while at < len(page):
            found = TAG.search(page, at)
            if found is None:
                self.text(page[at:])
                break
            self.text(page[at : found.start()])
            at = found.end()
            name = found["name"]
            if name is None:
                continue
            name = name.lower()
            if found["end"]:
                self.end(name)
                continue
            self.start(name, found["rest"].rstrip())
            if name in RAW:  # no tags inside; the text ends with its own end tag only
                close = regex.compile(rf"</{regex.escape(name)}(?=[\s/>]|$)", regex.IGNORECASE).search(page, at)
                self.text(page[at : close.start()] if close else page[at:])
                at = close.start() if close else len(page)
        self.flush()
        self._ignore_wrappers()
        return self.blocks

    def _ignore_wrappers(self) -> None:
        """Lifts the marks that hold most of the unlinked text outside of other boilerplate, larger ones first. A form
        may hold the whole page; what is left under other forms goes."""
        lifted = {0}
        size, rest, paragraphs, left = [0] * len(self.marks), 0, 0, [len(marks) for marks in self.under]
        held: list[list[int]] = [[] for _ in self.marks]
        for number, (block, marks) in enumerate(zip(self.blocks, self.under)):
            text = max(0, len(block.text) - block.linked)
            rest += 0 if marks else text
            paragraphs += 0 if marks or len(block.text) < SHORT_CHARS else text
            if not any(self.marks[m] == ELEMENT for m in marks):
                for mark in marks:
                    size[mark] += text
                    held[mark].append(number)
        for mark in sorted((m for m in range(1, len(size)) if size[m]), key=lambda m: (self.marks[m], -size[m], m)):  # forms first
            if size[mark] <= rest * (FORM_SHARE if self.marks[mark] == FORM else 1) or self.marks[mark] == NAME and paragraphs >= LONG_CHARS:
                continue
            lifted.add(mark)
            for number in held[mark]:
                left[number] -= 1
                if not left[number]:
                    block = self.blocks[number]
                    block.boilerplate, text = False, max(0, len(block.text) - block.linked)
                    rest += text
                    paragraphs += text if len(block.text) >= SHORT_CHARS else 0
        self.blocks = [b for b, marks in zip(self.blocks, self.under) if all(self.marks[m] != FORM or m in lifted for m in marks)]


def _linked(block: Block) -> bool:
    return block.linked > MAX_LINK_DENSITY * len(block.text)


def known_language(blocks: list[Block]) -> bool:
    """Whether the page's paragraphs have as many stop words as a good block."""
    counts = [b.words for b in blocks if len(b.text) >= SHORT_CHARS and not b.boilerplate and not _linked(b)]
    return sum(stop for _, stop in counts) >= HIGH_STOP_WORDS * sum(n for n, _ in counts)


def classify(block: Block, known: bool = True) -> str:
    """good, near (nearly good), short or bad, by the block alone; known: whether stop words know its language."""
    size = len(block.text)
    if block.boilerplate or _linked(block):
        return "bad"
    if block.text[0] in "©\xa9" or "©" in block.text[:60] and size < LONG_CHARS:
        return "bad"
    n_words, n_stop = block.words
    if not n_words:
        return "short"
    if not known:
        size += (WIDE_CHARS - 1) * len(WIDE.findall(block.text))
        return "good" if size > LONG_CHARS else "near" if size >= SHORT_CHARS else "short"
    stop = n_stop / n_words
    if size < SHORT_CHARS:
        return "short"
    if stop >= HIGH_STOP_WORDS:
        return "good" if size > LONG_CHARS else "near"
    if stop >= LOW_STOP_WORDS:
        return "near"
    return "bad" if block.linked else "short"


def decide(blocks: list[Block]) -> list[bool]:
    """Second pass: blocks without a decision take it from the nearest decided neighbours, those in the
    same article if there is one."""
    known = known_language(blocks)
    kinds = [classify(b, known) for b in blocks]
    before, after = _nearest(blocks, kinds), _nearest(blocks[::-1], kinds[::-1])[::-1]
    kept = []
    for number, kind in enumerate(kinds):
        if kind in ("good", "bad"):
            kept.append(kind == "good")
            continue
        sides = {before[number], after[number]} - {""}
        if not sides:
            kept.append(kind == "near" or blocks[number].article > 0)
        elif len(sides) == 1:
            kept.append(sides == {"good"})
        else:
            kept.append(kind == "near" or blocks[number].heading and _heads(blocks, kinds, number))
    return kept


def _nearest(blocks: list[Block], kinds: list[str]) -> list[str]:
    """Kind of the nearest decided block before each, in the same article."""
    found, last = [], {}
    for block, kind in zip(blocks, kinds):
        found.append(last.get(block.article, ""))
        if kind in ("good", "bad"):
            last[block.article] = kind
    return found


def _heads(blocks: list[Block], kinds: list[str], number: int) -> bool:
    distance = 0
    for following in range(number + 1, len(blocks)):
        if kinds[following] in ("good", "near"):
            return True
        distance += len(blocks[following].text)
        if kinds[following] == "bad" or distance > HEADING_REACH:
            return False
    return False


def main_text(page: str | None) -> str:
    if not page:
        return ""
    blocks = Reader().read(page)
    return "\n".join(b.text for b, keep in zip(blocks, decide(blocks)) if keep)


def extract(pages: DataFrame) -> DataFrame:
    """The page rows with text, the main text of the html."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages_of in batches:
            yield pd.Series([main_text(p) for p in pages_of], dtype="object")

    return pages.withColumn("text", F.pandas_udf(run, "string").asNondeterministic()("html"))

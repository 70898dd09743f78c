"""Main text of web pages: the maximum-scoring subsequence of words and tags.

A page is a sequence of runs of words and of tags. Words score by the log odds that words in the
same place (the kinds of elements around them, the nearest block, inside a link or not) are main
text; tags always score below zero, the more so the less often that place holds main text. A
linear scan finds the contiguous region with the highest sum, and its text is the main text,
without the parts of it that are menus, forms, comments and the like.

The weights are fitted on labelled pages: those whose authors marked the main text with a single
`article` or `main` element. About SAMPLE_PAGES of them, chosen by a hash of the row, are counted
by Spark tasks; what is fitted has one row for each kind of element in the sample. Known names
start with prior counts, so pages without any label can still be read. Extraction covers every
page, whole.

Blocks are cut where HTML starts a new block or line. Character references are decoded, white
space (as Unicode has it) inside a block becomes one space, empty blocks vanish and the others are
joined by one space. Parsing is linear in the length of the page.

Defined cases: a null or empty page, and one without a region above zero, has the empty text. A
page without markup is one block. Unclosed elements end with the element around them, stray end
tags are ignored, and a tag or comment that the end of the page cuts off is dropped. Of two regions
with equal sums the earlier one counts. Rows that repeat are extracted alike; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: About this many labelled pages are fitted on.
SAMPLE_PAGES = 5000
#: Pages read between two results.
ROWS = 64
#: Labelled words are scaled to this many inside and outside the main text; PRIOR is how many a
#: known name starts with; no single kind weighs more than CLIP, and no word more than REACH.
EVIDENCE = 1000.0
PRIOR = 50.0
CLIP = 4.0
REACH = 6.0

# Names of HTML elements, in the groups that parsing needs.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TEXT = frozenset("script style textarea title xmp iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
#: Elements that never hold main text.
LEFT_OUT = frozenset(
    "script style textarea title xmp iframe noembed noframes head template noscript nav aside footer form fieldset button select "
    "option datalist object canvas audio video svg dialog menu".split()
)
#: Elements that mark the main text, and words of class or id attributes that do so.
MARKED = frozenset("article main".split())
CONTENT_WORDS = frozenset("article content entry main post story text body".split())
#: Words of class, id and role attributes that name something other than main text.
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies discussion disqus footer form gdpr hidden menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo promotion promoted related replies respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe toolbar topbar widget".split()
)
#: These name the top of a page, unless the main text has begun.
HEADER_WORDS = frozenset("header masthead".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_PLAIN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Element:
    """An open element. `kinds` are the features that its words take from the elements around them."""

    name: str
    kinds: tuple[str, ...]
    left_out: bool
    in_form: bool
    marked: bool
    in_link: bool
    block: str
    weight: float = 0.0


@dataclass
class Weights:
    """Log odds of main text by kind."""

    of: dict[str, float] = field(default_factory=dict)

    def __getitem__(self, kind: str) -> float:
        found = self.of.get(kind)
        return _log_odds(kind, 0.0, 0.0) if found is None else found


def _log_odds(kind: str, inside: float, outside: float) -> float:
    """Clipped log odds from scaled counts and what is known of the name beforehand."""
    place, _, name = kind.partition(":")
    for_main, against = 1.0, 1.0
    if place == "in":
        if name in LEFT_OUT or name in OTHER_WORDS or name in HEADER_WORDS:
            against = PRIOR
        elif name in CONTENT_WORDS:
            for_main = PRIOR
    elif name in ("p", "h1", "h2", "h3", "blockquote", "pre", "none"):
        for_main = 4.0
    elif kind == "link:yes":
        against = 4.0
    return max(-CLIP, min(CLIP, math.log((inside + for_main) / (outside + against))))


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


def _words_of(attributes: dict[str, str]) -> list[str]:
    named = " ".join(attributes[a] for a in ("class", "id", "role") if a in attributes)
    return [w.lower() for w in _NAME_WORD.findall(named)] if named else []


class Page:
    """Reads a page into a sequence of (tag, element) and (words, element) items.

    `items` has a tuple for each: the number of words (0 for a tag), the score of one word or of
    the tag, the element around it, the text, and the number of its block.
    """

    def __init__(self, source: str, weights: Weights) -> None:
        self.weights = weights
        self.items: list[tuple[int, float, Element, str, int]] = []
        self.marks = 0
        root = Element("", (), False, False, False, False, "none")
        self.stack = [root]
        self.open: Counter[str] = Counter()
        self.block = 0
        self._read(source)

    def _read(self, source: str) -> None:
        at, size, tag = 0, len(source), _TAG
        while at < size:
            start = source.find("<", at)
            if start < 0:
                return self._text(source[at:])
            follows = source[start + 1 : start + 2]
            if not (follows.isascii() and follows.isalpha()) and follows not in ("/", "!", "?"):
                # A lone bracket is text; it goes with what follows.
                end = source.find("<", start + 1)
                self._text(source[at : end if end >= 0 else size])
                at = end if end >= 0 else size
                continue
            if start > at:
                self._text(source[at:start])
            if source.startswith("<!--", start):
                end = source.find("-->", start + 2)
                at = end + 3 if end >= 0 else size
                continue
            found = tag.match(source, start)
            if found is None and tag is _TAG and follows not in ("!", "?"):
                # An open quote to the end of the page: brackets end tags from here on.
                found = _PLAIN_TAG.match(source, start)
                if found is not None:
                    tag = _PLAIN_TAG
            if found is None:
                end = source.find(">", start)
                at = end + 1 if end >= 0 else size
                continue
            at = found.end()
            name = found[2].lower()
            if found[1]:
                self._close(name)
            else:
                self._open(name, found[3])
                if name in RAW_TEXT:
                    closing = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.IGNORECASE).search(source, at)
                    at = closing.start() if closing else size

    def _text(self, text: str) -> None:
        if text.isspace():
            words = 0
        else:
            words = len(text.split())
        if text:
            element = self.stack[-1]
            self.items.append((words, self._odds(element), element, text, self.block))

    def _odds(self, element: Element) -> float:
        """Log odds of main text for the words of an element."""
        if element.left_out:
            return -REACH
        weight = element.weight + self.weights["block:" + element.block] + self.weights["link:yes" if element.in_link else "link:no"]
        return max(-REACH, min(REACH, weight))

    def _tag(self) -> None:
        odds = self._odds(self.stack[-1])
        self.items.append((0, -math.log1p(math.exp(-odds)), self.stack[-1], "", self.block))

    def _open(self, name: str, rest: str) -> None:
        inline = name in INLINE
        if not inline:
            self.block += 1
            if self.open["p"]:
                self._pop_to("p")
        if name in VOID:
            return self._tag()
        around = self.stack[-1]
        attributes = _attributes(rest)
        words = _words_of(attributes)
        marked = name in MARKED or attributes.get("role") in MARKED
        other = any(w in OTHER_WORDS for w in words) or "hidden" in rest.split() or attributes.get("aria-hidden") == "true"
        top = not around.marked and (name == "header" or any(w in HEADER_WORDS for w in words)) and name not in ("html", "body")
        # Main text inside a form that holds the whole page is main text still.
        form = name == "form" or (around.in_form and not (marked and not other))
        whole = name in ("html", "body") or marked and not any(w in OTHER_WORDS for w in words)
        lifted = marked and around.in_form and not form
        left_out = (around.left_out and not lifted) or name in LEFT_OUT or top or (other and not whole)
        kinds = {k for k in ([name] if name in LEFT_OUT or name in MARKED or name in ("header", "section") else []) + words}
        own = tuple("in:" + k for k in sorted(kinds) if "in:" + k not in around.kinds)
        element = Element(
            name, around.kinds + own, left_out, form, around.marked or (marked and not left_out), around.in_link or name == "a",
            around.block if inline else name, around.weight + sum(self.weights[k] for k in own),
        )
        self.marks += marked and not around.marked and not left_out
        self.stack.append(element)
        self.open[name] += 1
        self._tag()

    def _close(self, name: str) -> None:
        if name not in INLINE:
            self.block += 1
        if self.open[name]:
            self._tag()
            self._pop_to(name)

    def _pop_to(self, name: str) -> None:
        while True:
            closed = self.stack.pop()
            self.open[closed.name] -= 1
            if closed.name == name:
                return

    def region(self) -> tuple[int, int]:
        """First and last item (exclusive) of the region with the highest sum; equal if there is none."""
        best, begin, end = 0.0, 0, 0
        total, first = 0.0, 0
        for at, (words, score, *_) in enumerate(self.items):
            total += score * words if words else (0.0 if self.items[at][3] else score)
            if total <= 0:
                total, first = 0.0, at + 1
            elif total > best:
                best, begin, end = total, first, at + 1
        return begin, end

    def text(self) -> str:
        begin, end = self.region()
        if begin == end:
            return ""
        # Whole blocks: a region may begin or end inside one, at a link.
        while begin and self.items[begin - 1][4] == self.items[begin][4]:
            begin -= 1
        while end < len(self.items) and self.items[end][4] == self.items[end - 1][4]:
            end += 1
        blocks: list[str] = []
        own: list[str] = []
        number = self.items[begin][4]
        for _, _, element, text, block in self.items[begin:end]:
            if block != number:
                blocks.append("".join(own))
                own, number = [], block
            if text and not element.left_out:
                own.append(text)
        blocks.append("".join(own))
        # References are decoded per block: one can't reach over a tag.
        folded = (" ".join(html.unescape(b).split()) for b in blocks)
        return " ".join(b for b in folded if b)


def _clean(text: str) -> str:
    """Lone surrogates, which references can't make but could once be read, have no UTF-8 form."""
    return text.encode("utf-8", "replace").decode() if not text.isascii() else text


def main_text(source: str | None, weights: Weights) -> str:
    return _clean(Page(source, weights).text()) if source else ""


_EVEN = Weights()


def _count_labelled(batches):
    """kind, inside, outside: words of labelled pages in places of that kind."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for source in batch.column("html").to_pylist():
            page = Page(source or "", _EVEN)
            if page.marks != 1:
                continue
            for words, _, element, _, _ in page.items:
                if words and "in:head" not in element.kinds:
                    place = 0 if element.marked and not element.left_out else 1
                    for kind in (*element.kinds, "block:" + element.block, "link:yes" if element.in_link else "link:no", "all"):
                        counts.setdefault(kind, [0, 0])[place] += words
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(list(counts), pa.string()),
            pa.array([c[0] for c in counts.values()], pa.int64()),
            pa.array([c[1] for c in counts.values()], pa.int64()),
        ],
        names=["kind", "inside", "outside"],
    )


def fit(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE_PAGES) -> Weights:
    """Weights from about `sample` of the pages that mark their main text."""
    rows = pages.select(F.col(f"`{html_column}`").alias("html")).where(F.col("html").rlike("(?i)<(article|main)[\\s>]"))
    n = rows.count()
    place = F.pmod(F.xxhash64("html"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = rows if n <= sample else rows.where(place < sample / n)
    counts = chosen.mapInArrow(_count_labelled, "kind string, inside bigint, outside bigint")
    # One row for each kind of element in the sample.
    found = counts.groupBy("kind").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    totals = {r.kind: r for r in found}
    if "all" not in totals:
        return Weights()
    inside, outside = (max(1, v) for v in (totals["all"].inside, totals["all"].outside))
    return Weights(
        {r.kind: _log_odds(r.kind, r.inside * EVIDENCE / inside, r.outside * EVIDENCE / outside) for r in found if r.kind != "all"}
    )


def extract(pages: DataFrame, weights: Weights, html_column: str = "html") -> DataFrame:
    """All rows of `pages`, the html replaced by its main `text` and n_chars, its code points."""
    schema = pages.drop(html_column).schema
    passed = [f.name for f in schema]
    shared = pages.sparkSession.sparkContext.broadcast(weights.of)

    def extracted(batches):
        own = Weights(shared.value)
        for batch in batches:
            for begin in range(0, batch.num_rows, ROWS):
                rows = batch.slice(begin, ROWS)
                texts = [main_text(source, own) for source in rows.column(html_column).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(c) for c in passed] + [pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                    names=[*passed, "text", "n_chars"],
                )

    return pages.mapInArrow(extracted, schema.add("text", "string").add("n_chars", "long"))

"""HTML extraction: the maximum-scoring subsequence of a page's words and tags.

A page is a sequence of words and tags. Words score by where they stand (the nearest container elements, by tag,
class and id), tags by their name and class; weights are log odds of content against the rest in labelled pages.
Words of content score positive, tags never do. One linear scan finds the contiguous region with the greatest sum;
what an element in the region marks as something else (a menu, an advert, a form) is left out of its text, nothing
else is. Text of a page's own article or main element is always taken.

What an element is beside the content follows from its tag or from a class, id or role that names nothing else, and
never for an element around an article, a main element or, where there is neither, most of the page's words.

Pages with exactly one article or main element label themselves: what is inside is content, unless an element in it
says by its name that it is not. Weights are fitted on a bounded sample of them. Every site
has one vote on a kind of item, however many of the pages are its own.

At scale: one pass over all pages without a shuffle; the model is a small dictionary.
"""

from __future__ import annotations

import html
import math
import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from snapgrid.llm import textkit as tk
from snapgrid.llm.frames import bounded_sample, tidy

#: Pages that a fit reads, about.
SAMPLE = 2_000
_LABELLED = re.compile("<(article|main)[ >]", re.IGNORECASE)

# Element names of HTML by what they do to text.
SILENT = frozenset("script style noscript template svg math iframe object select textarea canvas audio video head title".split())
RAW = frozenset("script style textarea title noscript iframe xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rt rp s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
CONTENT = ("article", "main")
APART = frozenset("nav header footer aside form button dialog menu fieldset".split())
# Words of class, id and role names that mark something beside the content.
ASIDE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar side menu nav navbar "
    "navigation breadcrumb breadcrumbs cookie cookies consent notice notices alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended recommendations comment comments disqus replies reply respond "
    "footer header masthead toolbar widget pagination pager copyright legal disclaimer search complementary contentinfo".split()
)
# Words that say where or what shape an element is, not what it is about. A name marks an element only if
# it has a word of the above and nothing but these beside it: ``comment-list`` does, ``comments-open`` does not.
SHAPE_WORDS = frozenset(
    "area bar block body bottom box button buttons center col column container entry fixed form global group header icon icons id inner item "
    "items js left link links list lower main module mobile outer page panel post posts primary right row secondary section site "
    "slot small sticky tertiary text title top unit upper wrap wrapper".split()
)
# Names on an article element that say it is no article of the page's own.
REPLY_WORDS = frozenset("comment comments reply replies respond disqus related recommended recommendations ad ads advert".split())
# Fixed values of HTML: start tags that end an open paragraph, and elements that hold their own paragraphs and list items.
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre search section summary table ul".split()
)
SCOPES = frozenset(
    "table td th caption button object template ul ol menu dl select article section aside main nav header footer form fieldset "
    "blockquote figure details dialog".split()
)
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "optgroup": ("option",)}
ROWS = {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "tbody": ("tr", "tbody", "thead"), "tfoot": ("tr", "tbody", "thead")}
#: Elements that may wrap a whole page although they usually stand beside its content.
WRAPPING = ("form", "fieldset")

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.DOTALL
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_HIDDEN = re.compile(r"""(?:\s|^)hidden(?:[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.IGNORECASE)
_PARTS = re.compile(r"[a-z0-9]+")


@dataclass
class Item:
    """A tag or a run of text, in page order."""

    kind: str  # name of the weight
    text: str = ""
    words: int = 0
    aside: bool = False  # an element around it says that it is no content
    within: bool = False  # inside the page's article elements, or its main element if it has no article
    block: bool = False  # a tag that ends a block
    name: str = ""  # of a tag


def _marks(names: list[str], words: frozenset[str]) -> bool:
    """Whether a class, id or role names something beside the content, in whole."""
    for name in names:
        for word in name.split():
            parts = [p.rstrip("0123456789") for p in _PARTS.findall(word)]
            if any(p in words for p in parts) and all(not p or p in words or p in SHAPE_WORDS for p in parts):
                return True
    return False


@dataclass
class _Open:
    """An open element, and what is open within it."""

    tag: str
    near: str  # the nearest label around what it holds
    silent: bool
    element: int  # its place in the list of elements
    inline: dict[str, int]  # open inline elements of the block it belongs to
    scope: dict[str, int]  # open paragraphs and list items of the scope it belongs to


@dataclass
class _Element:
    """What is known of an element after the page has been read."""

    tag: str
    start: int  # first item
    end: int  # behind the last item
    named: bool  # by its class, id or role it is beside the content
    apart: bool  # by its tag it is


def items(page: str) -> list[Item]:
    """Tags and text runs; comments, scripts and other silent elements are left out.

    Open paragraphs, list items and table cells end where HTML ends them. Linear in the page: what is open is counted,
    and what a close ends is taken off once.
    """
    out: list[Item] = []
    elements: list[_Element] = []
    stack: list[_Open] = []
    opened: Counter = Counter()
    silent = 0
    root = ({}, {})
    at, n = 0, len(page)

    def pop() -> None:
        nonlocal silent
        o = stack.pop()
        opened[o.tag] -= 1
        silent -= o.silent
        elements[o.element].end = len(out)
        inline, scope = (stack[-1].inline, stack[-1].scope) if stack else root
        if o.tag in INLINE:
            inline[o.tag] -= 1
        if o.tag in scope:
            scope[o.tag] -= 1

    def end(tags: tuple[str, ...]) -> None:
        while stack:
            tag = stack[-1].tag
            pop()
            if tag in tags:
                return

    def text(raw: str) -> None:
        if raw and not silent:
            plain = html.unescape(raw) if "&" in raw else raw
            out.append(Item(f"words in {stack[-1].near if stack else 'page'}", plain, len(plain.split())))

    while at < n:
        m = _TOKEN.search(page, at)
        if m is None:
            text(page[at:])
            break
        text(page[at : m.start()])
        at = m.end()
        tag = (m.group(2) or "").lower()
        if not tag:
            if m.group().startswith("<![CDATA["):
                text(m.group()[9:-3].replace("&", "&amp;"))
            continue
        if m.group(1):
            # A close of an inline element ends nothing beyond its block.
            held = (stack[-1].inline if stack else root[0]) if tag in INLINE else opened
            if held.get(tag, 0) > 0:
                end((tag,))
            out.append(Item(f"/{tag} in {stack[-1].near if stack else 'page'}", block=tag not in INLINE, name=f"/{tag}"))
            continue
        attributes = m.group(3)
        names = [(x or y or z).lower() for _, x, y, z in _NAMED.findall(attributes)] if "=" in attributes else []
        scope = stack[-1].scope if stack else root[1]
        if tag in ENDS_P and scope.get("p", 0) > 0:
            end(("p",))
        elif tag in ENDS and any(scope.get(t, 0) > 0 for t in ENDS[tag]):
            end(ENDS[tag])
        elif tag in ROWS and any(opened[t] > 0 for t in ROWS[tag]):
            for o in reversed(stack):
                if o.tag == "table":
                    break
                if o.tag in ROWS[tag]:
                    end(ROWS[tag])
                    break
        kind = " ".join([tag, *names])
        near = stack[-1].near if stack else "page"
        out.append(Item(f"{kind} in {near}", block=tag not in INLINE, name=tag))
        if tag in VOID:
            continue
        named = bool(names) and tag not in ("html", "body") and _marks(names, REPLY_WORDS if tag in CONTENT else ASIDE_WORDS)
        hidden = bool(attributes) and _HIDDEN.search(attributes) is not None
        plain = tag in INLINE or tag in ("p", "li", "ul", "ol", "tr", "tbody") and not names
        inline, scope = (stack[-1].inline, stack[-1].scope) if stack else root
        if tag in INLINE:
            inline[tag] = inline.get(tag, 0) + 1
        if tag in ("p", "li", "dt", "dd", "option"):
            scope[tag] = scope.get(tag, 0) + 1
        elements.append(_Element(tag, len(out) - 1, n, named, tag in APART))
        stack.append(
            _Open(
                tag, near if plain else kind, tag in SILENT or hidden, len(elements) - 1,
                inline if tag in INLINE else {}, {} if tag in SCOPES else scope,
            )
        )
        opened[tag] += 1
        silent += stack[-1].silent
        if tag in RAW:
            close = re.compile(rf"</{tag}[\s/>]", re.IGNORECASE).search(page, at)
            at = close.start() if close else n
    while stack:
        pop()
    _place(out, elements)
    return out


def _covered(n: int, spans: list[tuple[int, int]]) -> list[bool]:
    """Which of so many items lie in any span."""
    change = [0] * (n + 1)
    for a, b in spans:
        change[a] += 1
        change[b] -= 1
    out, open_ = [], 0
    for c in change[:n]:
        open_ += c
        out.append(open_ > 0)
    return out


def _place(out: list[Item], elements: list[_Element]) -> None:
    """Say of every item whether it is within the page's article, and whether it is beside the content.

    An element that holds an article or main element is never beside the content, whatever its name or tag, nor is one
    with most of the words of a page that has neither. Names never take an article's whole text.
    """
    n = len(out)
    content = [e for e in elements if e.tag in CONTENT]
    own = [e for e in content if not e.named] or content
    starts, words = [0] * (n + 1), [0] * (n + 1)
    for e in own:
        starts[e.start + 1] += 1
    for i, x in enumerate(out):
        words[i + 1] = words[i] + x.words
        starts[i + 1] += starts[i]

    def wraps(e: _Element) -> bool:
        held = starts[e.end] - starts[e.start + 1]  # below the element itself
        most = not own and (e.named and not e.apart or e.tag in WRAPPING) and 2 * (words[e.end] - words[e.start]) >= words[n]
        return held > 0 or most

    kept = {id(e) for e in own}
    hard = [(e.start, e.end) for e in elements if e.apart and not wraps(e)]
    soft = [(e.start, e.end) for e in elements if e.named and not e.apart and id(e) not in kept and not wraps(e)]
    apart, beside = _covered(n, hard), _covered(n, hard + soft)
    for tag in CONTENT:
        within = _covered(n, [(e.start, e.end) for e in own if e.tag == tag])
        if any(a and not b for a, b in zip(within, apart)):
            break
    if not any(a and not b and x.words for a, b, x in zip(within, beside, out)):
        beside = [a if w else b for a, b, w in zip(apart, beside, within)]
    for x, a, b in zip(out, within, beside):
        x.within, x.aside = a, b


@dataclass
class Model:
    """Log odds of content by kind of item, from counts inside and outside of labelled content, by site."""

    sites: dict[str, tuple[Counter, Counter]] = field(default_factory=dict)
    inside: Counter = field(default_factory=Counter)
    outside: Counter = field(default_factory=Counter)

    def learn(self, page: str, site: str = "") -> bool:
        found = items(page)
        if sum(i.name in CONTENT for i in found) != 1:
            return False
        inside, outside = self.sites.setdefault(site, (Counter(), Counter()))
        for i in found:
            weight = 1 if i.name else i.words
            (inside if i.within and not i.aside else outside)[i.kind] += weight
        self.inside.clear()
        self.outside.clear()
        return True

    def balance(self) -> None:
        """Counts of every kind, divided as the mean of the sites' own shares."""
        total, share, votes = Counter(), Counter(), Counter()
        for inside, outside in self.sites.values():
            for kind in inside.keys() | outside.keys():
                n = inside[kind] + outside[kind]
                if n:
                    total[kind] += n
                    share[kind] += inside[kind] / n
                    votes[kind] += 1
        for kind, n in total.items():
            self.inside[kind] = n * share[kind] / votes[kind]
            self.outside[kind] = n - self.inside[kind]

    def weight(self, item: Item) -> float:
        """Of one word, or of a tag. Kinds that no labelled page has go by the element names around them."""
        if item.aside and item.within:
            return 0.0  # left out of the text, but no border of the content
        if self.sites and not self.inside and not self.outside:
            self.balance()
        a, b = self.inside[item.kind], self.outside[item.kind]
        odds = math.log((a + 0.5) / (b + 0.5)) if a + b else (-2.0 if item.aside else 0.5)
        if item.aside:
            odds = min(odds, -1.0)
        return max(-3.0, min(-0.001 if item.name else 3.0, odds))


def region(scores: list[float]) -> tuple[int, int]:
    """Borders of the contiguous run with the greatest sum; the first and longest of equal ones, empty if none is positive."""
    best, low, high = 0.0, 0, 0
    total, start = 0.0, 0
    for i, s in enumerate(scores):
        total += s
        if total <= 0:
            total, start = 0.0, i + 1
        elif total >= best:
            if total > best or start == low:
                low, high = start, i + 1
            best = total
    return low, high


def main_text(page: str | None, model: Model) -> str:
    """Text of the best region and of the page's own article: white space as single spaces, blocks joined by one space.

    Where no run scores above zero, all text that nothing marks as something else is taken.
    """
    if not page:
        return ""
    found = items(page)
    marked = [i for i, x in enumerate(found) if x.within and x.words and not x.aside]
    scores = []
    for x in found:
        w = model.weight(x)
        scores.append(w if x.name else w * x.words)
    low, high = region(scores)
    if marked and not any(low <= i < high for i in marked):
        low, high = marked[0], marked[-1] + 1  # a marked article that is shorter than what surrounds it
    if low == high:
        low, high = 0, len(found)
    pieces = []
    for i, x in enumerate(found):
        if not x.name:
            if not x.aside and (x.within or low <= i < high):
                pieces.append(x.text)
        elif x.block:
            pieces.append(" ")
    return " ".join("".join(pieces).split())


def train(pages: DataFrame, html_column: str = "html", sample: int = SAMPLE) -> Model:
    """Counts over the labelled ones among about ``sample`` pages at random."""
    keys = [c for c in ("page_id", "url", html_column) if c in pages.columns]
    site = F.regexp_extract(F.col("url").cast("string"), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)", 1) if "url" in keys else F.lit("")
    rows = bounded_sample(pages, sample, keys)
    rows = rows.select(F.col(html_column).cast("string").alias("html"), F.coalesce(F.lower(site), F.lit("")).alias("site"))
    rows = rows.where("html is not null")

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model()
        for batch in batches:
            for page, site in zip(batch.column("html").to_pylist(), batch.column("site").to_pylist()):
                if _LABELLED.search(page):
                    model.learn(page, site)
        model.balance()
        model.sites.clear()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    found = rows.mapInArrow(tidy(learn), "model binary").collect()
    return pickle.loads(found[0].model) if found else Model()


def extracted(pages: DataFrame, model: Model, page_id: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    A null or empty page, and one without content, has an empty text. Pages may be of any length, the time is linear in
    it. Null ids and urls stay null; repeated rows get equal results, of equally good regions the first and longest one
    counts; an empty table gives an empty one; other columns are not read.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tk.slices(batch, "html"):
                texts = [main_text(p, shared.value) for p in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    ["page_id", "url", "text", "n_chars"],
                )

    source = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html_column).cast("string").alias("html")
    )
    return source.mapInArrow(tidy(extract), "page_id long, url string, text string, n_chars long")

"""Main text of web pages: text-to-tag ratios per line, smoothed and clustered.

The standard library's parser streams tags and text of a page. Block tags cut
the page into lines; a line knows the elements that it lies in, how many
characters it has outside and inside links, and how many tags. Three steps:

1. Lines of elements that are no article text by their kind (menus, headers,
   footers, sidebars, forms, scripts, styles), by their role or by a word of
   their class or id (notices, adverts, comments) are left out. An element
   that holds the article after all, as an unclosed menu or a form round the
   whole page does, is not.
2. A line's ratio is its characters outside links by its tags. Ratios are smoothed
   by a Gaussian along the lines, and those at or above a threshold (their
   standard deviation) are content lines.
3. Content lines select a region: the innermost article that holds half of
   their characters, or else the innermost container that holds four fifths and
   leaves no heading out. All lines of the region that step 1 kept are its text,
   the short ones too; of a page without such a container, the lines from the
   first to the last that is a content line by its own ratio too, and the
   headings before them.

Each page is one row and one call; nothing is shuffled. A page's memory is a
small multiple of its html.

Edge cases: NULL or empty html has no text; pages cut off at any place give what
they hold; references are decoded, also unclosed ones as HTML has them; a page
without content lines by ratio (links only) has no text unless its article has;
repeated rows are alike; further columns stay, and one named as the result is
replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewater.llm.common import released, table

#: Standard deviation of the Gaussian, in lines.
SIGMA = 2.0
#: Share of the content characters that an article must hold to be the region; that another container must hold.
ARTICLE_SHARE, CONTAINER_SHARE = 0.5, 0.8
#: Open elements; a deeper one takes the place of the innermost.
DEPTH = 500
# Fixed values of HTML: elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure
footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot
thead tr ul""".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTAINERS = frozenset("article body center div html main section table tbody td tr".split())
#: Elements without article text.
LEFT_OUT = frozenset("""aside button canvas datalist dialog fieldset footer form head header iframe input label legend menu nav
noscript object option script select style svg template textarea title""".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
#: Words of class and id names of what is no article text; words after which such a word says that something lacks or has it.
NAMES = frozenset("""ad ads adsense advert adverts advertisement advertising banner breadcrumb breadcrumbs captcha comment comments
consent cookie cookies copyright disclaimer discussion disqus footer gdpr header login masthead menu modal nav navbar navigation
newsletter notice notices pager pagination paywall popup popups promo promos promotion related replies reply respond share sharing
sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
COMMENTS = frozenset("comment comments replies reply".split())
LACKS = frozenset("has no with without".split())
#: What a new element closes, and how far out it looks for that.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr", "table"), "td": ("td th", "table tr"),
          "th": ("td th", "table tr"), "option": ("option", "select"), "a": ("a", "table td")}
CLOSES = {tag: (frozenset(of.split()), frozenset(upto.split())) for tag, (of, upto) in CLOSES.items()}
CLOSES_P = (frozenset(["p"]), frozenset("button caption object td th".split()))
CLOSES_NOTHING = (frozenset(), frozenset())
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class Element:
    __slots__ = ("tag", "parent", "out", "article", "comment", "header")

    def __init__(self, tag: str, parent: Element | None, attrs: dict[str, str]):
        self.tag, self.parent = tag, parent
        if not attrs:
            self.article, self.comment, self.header = tag in ("article", "main"), False, tag == "header"
            self.out = tag in LEFT_OUT
            return
        names = {w.lower() for w in _NAME.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")}
        named = names & NAMES if names.isdisjoint(LACKS) else frozenset()
        role, style = attrs.get("role", ""), attrs.get("style", "").replace(" ", "").lower()
        self.comment = not named.isdisjoint(COMMENTS)
        self.article = (tag in ("article", "main") or role in ("article", "main")) and not self.comment
        self.header = (tag == "header" or named == {"header"}) and named <= {"header"}
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in style
        self.out = tag not in ("html", "body") and not self.article and bool(tag in LEFT_OUT or named or hidden or role in ROLES)

    def path(self) -> Iterator[Element]:
        """The element and those around it, from the inside out."""
        e = self
        while e is not None:
            yield e
            e = e.parent


class Line:
    __slots__ = ("text", "path", "tags", "linked")

    def __init__(self):
        self.text: str | list[str] = []
        self.path: list[Element] = []
        self.tags = self.linked = 0

    def kept(self) -> bool:
        """Whether no element of the line is left out. Of an article's header its headings stay."""
        heading = in_article = False
        for e in reversed(self.path):
            in_article = in_article or e.article
            heading = heading or e.header and in_article and any(h.tag in HEADINGS for h in self.path)
            if e.out and not (e.header and heading):
                return False
        return True

    def is_heading(self) -> bool:
        return any(e.tag in HEADINGS for e in self.path)


class Lines(HTMLParser):
    """Reads a page's lines with their elements."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.lines = [Line()]
        self.links = 0

    def updatepos(self, i, j):
        return j  # nobody asks for line numbers

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)  # as HTML has it, where the library may raise an error

    def _cut(self) -> None:
        if self.lines[-1].text:
            self.lines.append(Line())

    def _close(self, at: int) -> None:
        """Closes the elements from place ``at`` of the stack on."""
        for e in self.stack[at:]:
            if e.tag in BLOCKS:
                self._cut()
            elif e.tag == "a":
                self.links -= 1
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        closes, upto = CLOSES.get(tag, CLOSES_P if tag in BLOCKS else CLOSES_NOTHING)
        if closes:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].tag in closes:
                    self._close(i)
                    break
                if self.stack[i].tag in upto:
                    break
        if tag in BLOCKS:
            self._cut()
        elif tag in ("br", "td", "th") and self.lines[-1].text:
            self.lines[-1].text.append(" ")
        self.lines[-1].tags += 1
        if tag in VOID:
            return
        if len(self.stack) == DEPTH:
            self._close(DEPTH - 1)
        e = Element(tag, self.stack[-1] if self.stack else None, {k: v or "" for k, v in attrs} if attrs else {})
        self.stack.append(e)
        self.links += tag == "a"
        if (e.article or tag == "h1") and not any(x.comment for x in e.path()):
            for x in e.path():  # what is open round an article is not left out, nor a form round a title
                if e.article or x.tag == "form":
                    x.out = False

    def handle_endtag(self, tag):
        self.lines[-1].tags += 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag == tag:
                if tag not in BLOCKS and any(e.tag in BLOCKS for e in self.stack[i:]):
                    self.links -= tag == "a"
                    del self.stack[i]  # an inline element closed late does not end the blocks in it
                else:
                    self._close(i)
                return
            if self.stack[i].article and tag not in ("article", "body", "html", "main"):
                return  # an end tag without its start does not end the article
        if tag == "p":
            self._cut()

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # the slash means nothing in HTML

    def handle_data(self, data):
        line = self.lines[-1]
        if not line.text:
            if data.isspace():
                return
            line.path = list(self.stack[-1].path()) if self.stack else []
        line.text.append(data)
        if self.links:
            line.linked += len(data.strip())


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Weighted means of neighbours, weights by a Gaussian; the ends have fewer."""
    reach = math.ceil(3 * sigma)
    kernel = np.exp(-np.arange(-reach, reach + 1) ** 2 / (2 * sigma * sigma))
    whole = np.convolve(ratios, kernel)[reach:reach + len(ratios)]
    return whole / np.convolve(np.ones(len(ratios)), kernel)[reach:reach + len(ratios)]


def content_lines(ratios: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each line belongs to the cluster of high smoothed ratios, and whether
    it would by its own ratio too."""
    s = smoothed(ratios)
    threshold = min(float(s.std()), float(s.max()))
    content = (s >= threshold) & (s > 0)
    return content, content & (ratios >= threshold) & (ratios > 0)


def _article(lines: list[Line], weights: np.ndarray) -> Element | None:
    """The innermost article that holds enough of the content characters."""
    held: dict[Element, int] = {}
    for line, w in zip(lines, weights):
        for e in line.path:
            if e.article:
                held[e] = held.get(e, 0) + w
    enough = [e for e, w in held.items() if w > 0 and w >= ARTICLE_SHARE * weights.sum()]
    return max(enough, key=lambda e: len(list(e.path())), default=None)


def _container(lines: list[Line], weights: np.ndarray) -> Element | None:
    """The innermost container that holds nearly all of the content characters and
    leaves no heading before it out; None if that is the page."""
    inside, found, depth = list(range(len(lines))), None, 0
    paths = [[e for e in reversed(x.path) if e.tag in CONTAINERS] for x in lines]
    while True:
        held: dict[Element, int] = {}
        for i in inside:
            if len(paths[i]) > depth:
                held[paths[i][depth]] = held.get(paths[i][depth], 0) + weights[i]
        best = max(held, key=held.get, default=None)
        if best is None or held[best] < CONTAINER_SHARE * weights[inside].sum():
            break
        within = [i for i in inside if len(paths[i]) > depth and paths[i][depth] is best]
        if any(lines[i].is_heading() for i in inside if i < within[0]):
            break
        inside, found, depth = within, best, depth + 1
    return None if found is None or found.tag in ("html", "body") else found


def main_text(html: str) -> str:
    """The blocks of a page's article, one a line."""
    parser = Lines()
    parser.feed(html)
    parser.close()
    lines = []
    for line in parser.lines:
        line.text = " ".join("".join(line.text).split())
        if line.text and line.kept():
            lines.append(line)
    if not lines:
        return ""
    plain = np.array([max(len(x.text) - x.linked, 0) for x in lines])
    content, own = content_lines(plain / np.array([max(x.tags, 1) for x in lines]))
    if not content.any():  # links only: an article, if the page names one
        plain, content = np.array([len(x.text) for x in lines]), np.array([any(e.article for e in x.path) for x in lines])
        own = content
    weights = np.where(content, plain, 0)
    if not weights.any():
        return ""
    region = _article(lines, weights) or _container(lines, weights)
    if region is not None:
        return "\n".join(x.text for x in lines if region in x.path)
    first, last = np.flatnonzero(own if own.any() else content)[[0, -1]]
    while first and lines[first - 1].is_heading():
        first -= 1
    return "\n".join(x.text for x in lines[first:last + 1])


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the main text of the column ``html`` as the column ``text``."""
    kept = [c for c in pages.columns if c != text]
    schema = T.StructType([f for f in pages.schema.fields if f.name != text] + [T.StructField(text, T.StringType())])

    def run(batches):
        for b in batches:
            found = [main_text(h or "") for h in b.column("__html").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), pa.array(found, pa.string())], names=[*kept, text])
    return pages.select(*kept, F.col(html).alias("__html")).mapInArrow(released(run), schema)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))

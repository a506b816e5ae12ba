"""Main text of web pages by the distribution of text over blocks of lines.

1. **Lines.** Markup is stripped: every block element is a line, its white space one
   space, its character references decoded. What is never content (scripts, styles,
   navigation, footers, asides, forms, hidden parts, and elements whose class, id or role
   calls them an advert, sidebar, notice, menu or reader comment) leaves blank lines, and so
   do the borders of containers, so the page's structure shows as gaps between lines.
2. **Line blocks.** A line weighs its characters outside links. The weights of ``window``
   lines in a row are summed at every line.
3. **Surge and dive.** Where the sum leaves zero is a surge, where it returns to zero a dive.
   The text from a surge to its dive is kept if the sum between them comes near the page's
   highest. In a page that marks its article (``article``, else ``main``) only those lines
   weigh, with their links, and each stretch of theirs is kept.

Defined results: a null, empty or markup-free empty page gives an empty text; a page without any
markup is one block; ties of equal sums are all kept; repeated rows give equal results; broken
markup (unclosed or stray tags, a page cut inside a tag, comment or reference) is read as
browsers do, as far as they recover text; bytes that are no UTF-8 become U+FFFD; a page is read
whole, in time linear in its length, by one task.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ID, TEXT, ship, utf8

# fixed values: element names of HTML, words that sites use in class and id
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p "
    "pre search section summary table tbody td tfoot th thead tr ul".split())
CONTAINERS = frozenset("article aside body details div dl fieldset footer form header main nav ol search section "
                       "table ul".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())     # no markup inside
STRIPPED = frozenset("nav footer aside form noscript template button select dialog menu svg math canvas object "
                     "audio video search datalist".split())
CLOSES_ITSELF = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"),
                 "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adsense sponsor sponsored sponsors promo "
    "promotion banner sidebar widget widgets nav navbar navigation menu breadcrumb breadcrumbs pagination pager "
    "footer masthead topbar toolbar cookie cookies consent gdpr notice notices notification alert popup modal "
    "newsletter subscribe subscription signup login share sharing social related recommended recommendations "
    "copyright disclaimer".split())
COMMENT_HINTS = frozenset("comment comments commentlist disqus reply replies respond".split())
HEADER_HINTS = frozenset("header head".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
NEGATED = frozenset("has with no without is not".split())

TAG = re.compile(r"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![a-zA-Z])[^>]*+(?:>|\Z)"
                 r"|<(/?)([a-zA-Z][^\s/>]*+)((?>=\s*\"[^\"]*+\"|=\s*'[^']*+'|[^>])*+)(>|\Z)", re.S)
ATTRIBUTE = re.compile(r"(class|id|role|hidden|aria-hidden|style|itemprop)(?![\w-])"
                       r"(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
SMALL_PRINT = re.compile(r"^(?:©|\(c\)\s|copyright\b)|\ball rights reserved\b", re.I)


def attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if "=" in text \
        or "hidden" in text else {}


def hinted(found: dict[str, str], inside: bool) -> str:
    """What an element's attributes say of it: 'comment', 'extra' or nothing."""
    if ("hidden" in found and found["hidden"] != "until-found" or found.get("aria-hidden") == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower()
            or found.get("role", "").lower() in ROLES):
        return "extra"
    kind = ""
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = [w.lower() for w in WORDS.findall(name)]
        if not words or words[0] in NEGATED:
            continue
        if not COMMENT_HINTS.isdisjoint(words):
            return "comment"
        if not HINTS.isdisjoint(words) or not inside and not HEADER_HINTS.isdisjoint(words):
            kind = "extra"
    return kind


class PageLines:
    """The lines of one page. ``texts[i]`` is empty for a blank line; ``links[i]`` counts the
    characters of links in it; ``article[i]`` and ``main[i]`` number the part it lies in."""

    def __init__(self, html: str, window: int, use_hints: bool = True):
        self.window, self.use_hints = window, use_hints
        self.texts: list[str] = []
        self.links: list[int] = []
        self.article: list[int] = []
        self.main: list[int] = []
        self.pieces: list[str] = []
        self.linked = 0
        self.in_link = False
        # open blocks: name, first line, what strips it, article number, main number, holds (article, main, h1)
        self.open: list[list] = [["", 0, "", 0, 0, set()]]
        self.parts = 0
        self.read(html)

    def line(self, blanks: int = 0) -> None:
        """End the line that is being read; put blank lines after it."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.put(text, min(self.linked, len(text)))
            self.pieces, self.linked = [], 0
        for _ in range(blanks):
            self.put("", 0)

    def put(self, text: str, links: int) -> None:
        top = self.open[-1]
        self.texts.append(text)
        self.links.append(links)
        self.article.append(top[3])
        self.main.append(top[4])

    def read(self, html: str) -> None:
        at = 0
        while True:
            m = TAG.search(html, at)
            text = html[at:m.start() if m else len(html)]
            if text:
                text = unescape(text) if "&" in text else text
                self.pieces.append(text)
                if self.in_link:
                    self.linked += len(text.strip())
            if not m:
                break
            at = m.end()
            if not m[2] or not m[4]:                 # a comment, or a tag that the page's end cuts
                continue
            name = m[2].lower()
            if m[1]:
                self.end(name)
                continue
            if name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])", re.I).search(html, at)
                at = close.start() if close else len(html)
                continue
            self.start(name, m[3])
        while len(self.open) > 1:
            self.close()
        self.line()

    def start(self, name: str, rest: str) -> None:
        if name == "br":
            self.pieces.append(" ")
            return
        if name == "a":
            self.in_link = "href" in rest.lower()
            return
        found = attributes(rest) if name in BLOCKS or "=" in rest else {}
        top = self.open[-1]
        kind = "extra" if name in STRIPPED or name == "header" and not (top[3] or top[4]) else ""
        if self.use_hints and found and name not in ("html", "body", "main"):
            hint = hinted(found, bool(top[3] or top[4]))
            kind = hint if hint == "comment" or hint and name != "article" else kind
        if name not in BLOCKS and not kind or name in VOID:
            if name in BLOCKS:
                self.line()
            return
        for outer in CLOSES_ITSELF.get(name, ()):
            if self.open[-1][0] == outer:
                self.close()
        if name in BLOCKS:
            self.in_link = False
            if self.open[-1][0] == "p" and not kind:
                self.close()
        self.line(self.window if kind else 1 if name in CONTAINERS else 0)
        top = self.open[-1]
        article, main = top[3], top[4]
        if kind != "comment":
            if not article and (name == "article" or "articleBody" in found.get("itemprop", "")):
                self.parts += 1
                article = self.parts
            if not main and (name == "main" or found.get("role", "").lower() == "main"):
                self.parts += 1
                main = self.parts
        holds = {"article"} if article != top[3] else {"main"} if main != top[4] else set()
        self.open.append([name, len(self.texts), kind, article, main, holds])
        if name == "h1":
            top[5].add("h1")

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] == name:
                while len(self.open) > depth:
                    self.close()
                return
            if self.open[depth][0] in ("article", "main", "body"):
                break                                # a stray end tag does not end the article
        if name in BLOCKS:
            self.line()

    def close(self) -> None:
        """The innermost open block ends: if it is stripped, its lines become a gap."""
        self.line()
        name, first, kind, _, _, holds = self.open[-1]
        # a wrapper of the article is no extra, whatever its name says
        wraps = ("main" in holds if kind == "comment" else "article" in holds or "main" in holds
                 or name in ("form", "div", "section") and "h1" in holds)
        self.open.pop()
        self.open[-1][5] |= holds
        if kind and not wraps:
            for column in (self.texts, self.links, self.article, self.main):
                del column[first:]
            self.line(self.window)
        elif kind or name in CONTAINERS:
            self.line(1)


def line_blocks(weights: list[int], window: int) -> Iterator[tuple[int, int, int]]:
    """(surge, dive, peak) of every stretch: its first and last weighing line, and its highest sum
    of ``window`` lines in a row. The sum slides: one addition and one subtraction a line."""
    total = peak = last = 0
    surge = -1
    for i, weight in enumerate([*weights, *[0] * window]):
        total += weight - (weights[i - window] if window <= i else 0)
        if weight:
            last = i
            if surge < 0:
                surge = i
        peak = max(peak, total)
        if surge >= 0 and not total:
            yield surge, last, peak
            surge, peak = -1, 0


def main_text(html: str, window: int = 3, share: float = 0.25) -> str:
    """The text between the surges and dives of one page's lines.

    A stretch is kept if its highest sum is at least ``share`` of the page's highest."""
    for use_hints in (True, False):          # a page whose names strip all of it is read without them
        lines = PageLines(html, window, use_hints)
        marked = next((mark for mark in (lines.article, lines.main)
                       if any(m and t for m, t in zip(mark, lines.texts))), None)
        if marked:
            parts = {m for m, t in zip(marked, lines.texts) if m and t}
            weights = [len(t) if m else 0 for m, t in zip(marked, lines.texts)]
        else:
            weights = [max(0, len(t) - n) for t, n in zip(lines.texts, lines.links)]
        found = list(line_blocks(weights, window))
        if found:
            break
    else:
        return ""
    need = 0 if marked and len(parts) == 1 else share * max(peak for _, _, peak in found)
    out = []
    for surge, dive, peak in found:
        if peak < need:
            continue
        kept = [t for t, m in zip(lines.texts[surge:dive + 1], (marked or lines.article)[surge:dive + 1])
                if t and (m or not marked)]
        while not marked and len(kept) > 1 and SMALL_PRINT.search(kept[-1]):
            kept.pop()
        out += kept
    return "\n".join(out)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            window: int = 3, share: float = 0.25) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.decode("utf-8", "replace"), window, share) for page in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], [ID, "__url", "text", "n_chars"])

    rows = pages.select(F.col(f"`{id_col}`").alias(ID), F.col(f"`{url_col}`").alias("__url"),
                        F.col(f"`{html_col}`").cast("string").alias(TEXT))
    kinds = [rows.schema[c].dataType.simpleString() for c in (ID, "__url")]
    return (rows.mapInArrow(run, f"{ID} {kinds[0]}, __url {kinds[1]}, text string, n_chars long")
            .toDF(id_col, url_col, "text", "n_chars"))

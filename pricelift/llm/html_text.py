"""Main text of HTML pages: streamed parser events, text-to-tag ratios, smoothing and clustering."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements whose text is never shown, or is a control.  Fixed values.
SILENT = frozenset("script style noscript template svg math head title iframe object embed select textarea button form option datalist canvas audio video map".split())
#: Elements that hold what stands around an article.  Fixed values.
AROUND = frozenset("nav footer aside menu dialog header".split())
#: Elements without content.  Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a block of text.  Fixed values.
BLOCK = frozenset(
    "address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Words of class, id or role that mark what stands around an article.  Fixed values.
AROUND_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer disqus footer"
    " masthead menu modal nav navbar navigation newsletter notice popup promo promoted related reply replies respond share sharing"
    " sidebar signup social sponsor sponsored subscribe toolbar widget complementary contentinfo search".split()
)
#: Elements that a paragraph ends at, if it is still open.  Fixed values.
ENDS_PARAGRAPH = BLOCK - frozenset("html body td th tr tbody thead tfoot legend summary".split())

SMOOTHING = 1.0
#: Share of the mean smoothed ratio that a line must reach to be content.
CONTENT_SHARE = 0.5
#: Share of that threshold that the unsmoothed ratio of the first and the last content line must reach.
EDGE_SHARE = 0.2
#: In an article, a line with less text per tag outside links than this, and than the edge share, is low.
ARTICLE_LEAST = 1.0
#: Low lines in a row that an article may hold, such as a linked headline; a longer run is a list of links.
LOW_RUN = 2
#: Text outside articles counts if it is this many times the text of the articles: a page of teasers.
ARTICLE_PRIOR = 2


Line = tuple[str, int, int, bool, int, int]


class Lines(HTMLParser):
    """The page as lines, one to a block: text, text and tag counts, and where it stands.

    A line is (text, characters, tags, around, main, linked): ``around`` if an enclosing element is not part
    of an article, ``main`` the number of the outermost article or 0, ``linked`` the characters in links.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.open: list[tuple[str, bool, bool, int, bool]] = []  # tag, silent, around, main, linked
        self.held: Counter[str] = Counter()  # open elements by tag
        self.parts: list[str] = []
        self.tags = self.linked = self.articles = 0

    def end_line(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        silent, around, main, _ = self.open[-1][1:] if self.open else (False, False, 0, False)
        if text and not silent:
            self.lines.append((text, len(text), self.tags, around, main, self.linked))
            self.tags = 0
        self.linked = 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ENDS_PARAGRAPH or tag == "p":
            self.close_open("p", ENDS_PARAGRAPH - {"p"})
        if tag == "li":
            self.close_open("li", frozenset(("ul", "ol", "menu")))
        if tag in BLOCK:
            self.end_line()
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        silent, around, main, linked = self.open[-1][1:] if self.open else (False, False, 0, False)
        # the header of an article that holds its headline belongs to it
        named = tag in AROUND and not (tag == "header" and main)
        for name, value in attrs:
            if name in ("class", "id", "role") and value and not named and tag not in ("html", "body", "article", "main"):
                words = value.lower().replace("-", " ").replace("_", " ").split()
                named = not AROUND_WORDS.isdisjoint(words) or ("header" in words and not main)
            elif name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and "display:none" in value.lower().replace(" ", "")):
                silent = True
        # inside a block, what does not belong to the article is left out of its line
        silent = silent or tag in SILENT or (named and tag not in BLOCK)
        if not main and tag in ("article", "main"):
            self.articles += 1
            main = self.articles
        # a link that is never closed does not reach into the blocks behind it
        linked = tag not in BLOCK and (linked or (tag == "a" and any(name == "href" for name, _ in attrs)))
        self.open.append((tag, silent, around or named, main, linked))
        self.held[tag] += 1

    def leave(self, at: int) -> None:
        """Close the element at this place and all inside it."""
        for element in self.open[at:]:
            self.held[element[0]] -= 1
        del self.open[at:]

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag == "br":
            self.parts.append(" ")
            return
        if tag in BLOCK:
            self.end_line()
        # an end without a beginning closes nothing; looking for one would take the depth of the page each time
        if not self.held[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self.leave(at)
                return

    def close_open(self, tag: str, until: frozenset[str]) -> None:
        """End an element whose end tag may be left out."""
        if not self.held[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                self.end_line()
                self.leave(at)
                return
            if name in until:
                return

    def handle_data(self, data: str) -> None:
        if not (self.open and self.open[-1][1]):
            self.parts.append(data)
            if self.open and self.open[-1][4]:
                self.linked += len(" ".join(data.split()))


def smooth(values: np.ndarray, sigma: float = SMOOTHING) -> np.ndarray:
    """Gaussian smoothing that renormalises at both ends."""
    reach = max(1, math.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(values)), kernel)[reach : reach + len(values)]
    return np.convolve(values, kernel)[reach : reach + len(values)] / weight


def runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of every run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    yield from zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def article_lines(lines: list[Line], least: float) -> np.ndarray:
    """Which lines of one article are content: all but long runs of lines without text outside links.

    The article speaks for its lines, so short paragraphs and items stay; an article without a line of
    the cluster has none.
    """
    raw = text_to_tag(lines)
    if not (smooth(raw) >= least).any():
        return np.zeros(len(lines), bool)
    unlinked = np.array([max(0, line[1] - line[5]) / max(1, line[2]) for line in lines])
    keep = np.ones(len(lines), bool)
    for begin, end in runs(unlinked < min(ARTICLE_LEAST, EDGE_SHARE * least)):
        if end - begin > LOW_RUN:
            keep[begin:end] = False
    return keep


def other_lines(lines: list[Line]) -> np.ndarray:
    """Which lines that no article names are content: from the first to the last line of the cluster."""
    raw = text_to_tag(lines)
    ratios = smooth(raw)
    least = CONTENT_SHARE * ratios.mean()
    # smoothing lifts a list of links next to long paragraphs; it cannot begin or end the region
    chosen = np.flatnonzero((ratios >= least) & (raw >= EDGE_SHARE * least))
    keep = np.zeros(len(lines), bool)
    if len(chosen):
        keep[chosen[0] : chosen[-1] + 1] = True
    return keep


def text_to_tag(lines: list[Line]) -> np.ndarray:
    return np.array([line[1] / max(1, line[2]) for line in lines])


def content_lines(lines: list[Line]) -> list[str]:
    """Texts of the lines of the content cluster, in page order.

    Text-to-tag ratios are smoothed over neighbouring lines of an article, or of what stands outside articles,
    and cut at a share of their mean; lines that stand in an element around the article never count.  Naming
    an article is a prior: inside it only runs of lines without text outside links are cut, and lines
    outside count only where their cluster holds several times its text.
    """
    regions: dict[int, list[int]] = {}
    for n, line in enumerate(lines):
        if not line[3]:
            regions.setdefault(line[4], []).append(n)

    def chosen(region: int, keep: np.ndarray) -> list[int]:
        return [n for n, yes in zip(regions[region], keep, strict=True) if yes]

    def articles(of: list[int]) -> list[int]:
        """Content of articles under the threshold that these regions give."""
        ratios = [smooth(text_to_tag([lines[n] for n in regions[region]])) for region in of]
        least = CONTENT_SHARE * np.concatenate(ratios).mean()
        return [n for region in of if region for n in chosen(region, article_lines([lines[n] for n in regions[region]], least))]

    named = [region for region in regions if region]
    found = articles(named) if named else []
    if 0 in regions:
        others = chosen(0, other_lines([lines[n] for n in regions[0]]))
        if sum(lines[n][1] for n in others) > ARTICLE_PRIOR * sum(lines[n][1] for n in found):
            found = others + (articles(list(regions)) if named else [])
    return [lines[n][0] for n in sorted(found)]


def main_text(html: str | None) -> str:
    """The article of a page, a block to a line; '' without one."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    return "\n".join(content_lines(parser.lines))


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its length in code points for every page.

    A null or empty page has an empty text.  Unclosed elements end with the page; marks that are not tags are text.
    Equal rows give equal rows; an empty table stays empty; further columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    chosen = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return chosen.mapInArrow(run, "page_id long, url string, text string, n_chars long")

"""Main text of web pages: the maximum-scoring run of a page's words and tags.

A page is read as words and tags, without comments and elements that hold no article text.
Words score up to 1, tags cost something, by weights counted on labelled pages; one linear scan
finds the contiguous run of the highest total, whose blocks are the text.

A labelled page has exactly one ``article`` element: what is inside is content, what is outside
is not. A tag costs the odds against meeting it inside, in words; a word scores between -1 and 1 by
how often words of its place are content. Pages with other layouts share the weights of
tags they have in common; tags and places that no labelled page has get the fixed ``NEW_`` scores.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shardweave.staging import stage

#: Labelled pages that weights are counted on: the distinct ones of least hash.
FIT_PAGES = 1000
#: The most words that a tag can cost.
BARRIER = 1000.0

# Names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
    figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup
    option p pre search section summary table tbody td tfoot th thead tr ul""".split())
#: Elements that hold no article text, wherever they are.
NO_TEXT = frozenset("""applet aside button canvas datalist dialog embed footer form frameset head menu nav noscript
    object select svg template video audio""".split()) | RAW
#: Words of class, id or role that mark the same.
NO_TEXT_WORDS = frozenset("""ad ads advert advertisement advertising adverts alert banner breadcrumb breadcrumbs
    comment comments consent contentinfo cookie cookies dialog disqus footer form gdpr login masthead menu modal nav
    navbar navigation newsletter notice notices notification overlay pagination popup promo promotion recommended
    related replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe
    subscription toolbar widget""".split())
#: Starts of such words.
NO_TEXT_STARTS = ("advert", "breadcrumb", "comment", "cookie", "newsletter", "sidebar", "sponsor")
#: A header is part of the article if it is in it, or if its class says so.
HEADER, OF_ARTICLE = "header", frozenset("article content entry headline main page post story title".split())
ARTICLES = frozenset(("article", "main"))
WORDS = "#"
#: Scores of what labelled pages do not have: words, words beside an article, tags, tags that part a page.
NEW_WORD, NEW_WORD_OUTSIDE, NEW_TAG, NEW_PART = 1.0, -1.0, -0.1, -1.0
PARTS = frozenset("article body div header html main section".split())

_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_STOP = re.compile(r""">|=\s*["']""")
_MARKS = re.compile(r"""(?:^|[\s"'/])(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_LETTERS = re.compile("[a-z]+")


def _tag_end(page: str, at: int) -> int:
    """Place of the ``>`` that ends a tag; quoted values may hold others. -1: the page ends first."""
    while True:
        stop = _STOP.search(page, at)
        if stop is None:
            return -1
        if stop[0] == ">":
            return stop.start()
        close = page.find(stop[0][-1], stop.end())
        if close < 0:  # a quote never closed; this can happen once for each kind of quote
            return page.find(">", stop.end())
        at = close + 1


def _raw_end(page: str, at: int, name: str) -> int:
    close = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(page, at)
    return close.start() if close else len(page)


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, content): ``text`` with its text, ``open`` with its attributes, or ``close``.

    Comments, declarations and the inside of scripts and the like are left out. As browsers do,
    an unclosed comment or script runs to the end, and a ``<`` before anything but a name is text.
    """
    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            yield "text", "", page[at:]
            return
        if start > at:
            yield "text", "", page[at:start]
        after = page[start + 1:start + 2]
        if after in "!?" and after or after == "/" and not page[start + 2:start + 3].isalpha():
            if page.startswith("<!--", start):
                end = start + 4 if page.startswith((">", "->"), start + 4) else page.find("-->", start + 4)
                end = page.find(">", end) if end >= 0 else end
            else:
                end = page.find(">", start)
            at = len(page) if end < 0 else end + 1
            continue
        closing = after == "/"
        name = _NAME.match(page, start + 1 + closing)
        if name is None:
            yield "text", "", "<"
            at = start + 1
            continue
        end = _tag_end(page, name.end())
        if end < 0:
            return
        word = name[0].lower()
        yield ("close" if closing else "open"), word, page[name.end():end]
        at = end + 1
        if word in RAW and not closing:
            at = _raw_end(page, at, word)


def marks(attributes: str) -> set[str]:
    """Words of the class, id and role attributes."""
    if "=" not in attributes:
        return set()
    return {w for value in _MARKS.findall(attributes) for w in _LETTERS.findall(value.lower())}


def elements(page: str) -> tuple[list[tuple[str, str, str]], list[int], list[bool]]:
    """Tokens of a page, and for each opening one the place past its element (0 for others) and whether it is closed."""
    tokens = list(scan(page))
    past, closed = [0] * len(tokens), [False] * len(tokens)
    stack: list[tuple[str, int]] = []
    open_names: Counter = Counter()
    for i, (kind, name, _) in enumerate(tokens):
        if kind == "open" and name not in VOID:
            stack.append((name, i))
            open_names[name] += 1
        elif kind == "close" and open_names[name]:
            while True:
                top, opened = stack.pop()
                open_names[top] -= 1
                closed[opened] = top == name
                past[opened] = i + closed[opened]
                if closed[opened]:
                    break
    for _, opened in stack:
        past[opened] = len(tokens)
    return tokens, past, closed


def _holds_no_text(name: str, attributes: str, place: str) -> bool:
    found = marks(attributes)
    if found & NO_TEXT_WORDS or any(w.startswith(NO_TEXT_STARTS) for w in found):
        return True
    return (name == HEADER or HEADER in found) and place != "article" and not found & OF_ARTICLE


def sequence(page: str) -> list[tuple[str, str, str]]:
    """(feature, name, text) of the tags and texts that may belong to an article, in page order.

    A feature is the place, ``article``, ``main``, ``outer`` (beside those) or ``page`` (there are
    none), and the tag's name, or ``#`` for text. Elements that hold no article text go as a whole. Those that
    hold an article, or are never closed or only marked by a word and hold over half of the page's
    words where no article is, stay.
    """
    tokens, past, closed = elements(page)
    sizes = [0]
    holders = [0]
    for kind, name, content in tokens:
        sizes.append(sizes[-1] + (len(content.split()) if kind == "text" else 0))
        holders.append(holders[-1] + (kind == "open" and name in ARTICLES))
    root = "outer" if holders[-1] else "page"
    out, places, i = [], [(root, len(tokens))], 0
    while i < len(tokens):
        while len(places) > 1 and i >= places[-1][1]:
            places.pop()
        kind, name, content = tokens[i]
        place = places[-1][0]
        if kind == "open":
            if past[i] and name not in ("html", "body"):
                never = name in NO_TEXT
                if never or _holds_no_text(name, content, place):
                    most = 2 * (sizes[past[i]] - sizes[i]) > sizes[-1]
                    sure = closed[i] and (holders[-1] or never and name != "form")
                    if name in RAW or holders[past[i]] == holders[i + 1] and (sure or not most):
                        i = past[i]
                        continue
            out.append((f"{place}/{name}", name, ""))
            if name in ARTICLES and past[i]:
                places.append((name, past[i]))
        elif kind == "close":
            outside = places[-2][0] if len(places) > 1 and places[-1][1] == i + 1 else place
            out.append((f"{outside}/{name}", name, ""))
        else:
            out.append((f"{place}/{WORDS}", "", content))
        i += 1
    return out


def label_counts(page: str) -> Counter | None:
    """(feature, inside) of a page's tags and words; None unless it has exactly one article."""
    tokens = sequence(page)
    if sum(name == "article" and feature.endswith("/article") and not text for feature, name, text in tokens) > 2 \
            or not any(feature.startswith("article/") for feature, _, _ in tokens):
        return None
    counts: Counter = Counter()
    for feature, name, text in tokens:
        inside = feature.startswith("article/")
        n = len(text.split()) if not name else 1
        if n and name not in ("html", "body"):
            counts[feature, inside] += n
            if name:
                counts[name, inside] += n
    return counts


def weights_of(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    """A word's score or a tag's cost, by feature."""
    weights = {}
    for feature in {f for f, _ in counts}:
        share = (counts.get((feature, True), 0) + 0.5) / (
            counts.get((feature, True), 0) + counts.get((feature, False), 0) + 1)
        weights[feature] = 2 * share - 1 if feature.endswith("/" + WORDS) else -min(BARRIER, (1 - share) / share)
    return weights


def best_run(tokens: list[tuple[str, str, str]], weights: dict[str, float]) -> tuple[int, int]:
    """First and past-last token of the run with the highest total, the earliest of equal ones."""
    best, first, past, total, start = 0.0, 0, 0, 0.0, 0
    for i, (feature, name, text) in enumerate(tokens):
        if name in ("html", "body"):
            continue
        if name:
            total += weights.get(feature, weights.get(name, NEW_PART if name in PARTS else NEW_TAG))
        else:
            new = NEW_WORD_OUTSIDE if feature.startswith("outer/") else NEW_WORD
            total += len(text.split()) * weights.get(feature, new)
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, first, past = total, start, i + 1
    return first, past


def main_text(page: str, weights: dict[str, float]) -> str:
    """Blocks of the best run, a line each; the run reaches to the ends of the parts of the page it ends in."""
    tokens = sequence(page)
    first, past = best_run(tokens, weights)
    if past:  # short blocks at its ends belong to the same part of the page
        while first and tokens[first - 1][1] not in PARTS:
            first -= 1
        while past < len(tokens) and tokens[past][1] not in PARTS:
            past += 1
    lines: list[str] = []
    block: list[str] = []

    def close() -> None:
        line = " ".join("".join(block).split())
        if line:
            lines.append(line)
        block.clear()

    for _, name, text in tokens[first:past]:
        if not name:
            block.append(html.unescape(text))
        elif name in BLOCKS:
            close()
        elif name == "br":
            block.append(" ")
    close()
    return "\n".join(lines)


def fit(pages: DataFrame, fit_pages: int = FIT_PAGES) -> dict[str, float]:
    """Weights counted on labelled pages: the ``fit_pages`` distinct ones of least hash."""
    labelled = pages.select(F.col("html").cast("string").alias("html")).filter(
        F.regexp_count("html", F.lit(r"(?i)<article[\s>]")) == 1).withColumn("hash", F.xxhash64("html"))
    last = labelled.select("hash").distinct().orderBy("hash").limit(fit_pages).agg(F.max("hash")).first()[0]
    if last is None:
        return {}
    sample = stage(labelled.filter(F.col("hash") <= last).groupBy("hash").agg(F.first("html").alias("html")), "sample")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for page in batch.column(0).to_pylist():
                total.update(label_counts(page) or {})
            yield pa.record_batch([pa.array([f for f, _ in total], pa.string()), pa.array([i for _, i in total], pa.bool_()),
                                   pa.array(list(total.values()), pa.int64())], names=["feature", "inside", "n"])

    rows = sample.select("html").mapInArrow(run, "feature string, inside boolean, n long").groupBy(
        "feature", "inside").agg(F.sum("n").alias("n")).collect()  # bounded by the sample
    return weights_of({(r.feature, r.inside): r.n for r in rows})


def extract(pages: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row; ``weights`` are fitted on the pages if not given.

    Without labelled pages the fixed scores hold. Character references are decoded, white space in a
    block becomes one space, blocks are joined by line ends; ``br`` is white space. A null or empty page, or one without any text, has an empty text. Broken pages are
    read as far as they go, whole pages of any length; repeated rows give repeated rows. Columns
    other than page_id, url and html are not read, whatever their names.
    """
    if weights is None:
        weights = fit(pages)
    kind = pages.schema["page_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page, weights) if page else "" for page in batch.column(2).to_pylist()]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return pages.select("page_id", F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
                        ).mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")

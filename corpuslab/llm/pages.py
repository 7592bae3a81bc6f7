"""Main text of web pages by nearest-URL page differencing.

Pages are sorted by host and URL path; every page is paired with the nearest pages of its host in that order. The text
lines (blocks) of both are aligned by their longest common subsequence, and shared lines are deleted: what neighbours
on a site have in common is its frame, not the article.

Pages of one site also share article text (copies, quoted passages), which must stay, so markup decides what may be
deleted at all. Lines inside elements that are never article text (navigation, footers, forms, scripts, adverts,
notices, reader comments and so on) go without asking a neighbour. On a page that declares its article (``article``,
``main``, an element named like one) the other lines inside it stay unless they are shared and consist of links only, lines outside go. On a page
that declares none, every shared line goes. A pair that shares nearly everything is a pair of copies and says nothing.

Only 64-bit line hashes and lengths are shuffled for the differencing; a site of any size is cut into stretches of
``STRETCH`` neighbours that overlap, so no host meets in one task. Texts stay where they are unless lines of their page
are deleted and those are too many to broadcast.

Edge cases: null html or a page without article text gives an empty text; pages without URL form a host of their own;
pages that repeat are aligned once and share the result; unclosed and crossed tags, cut pages and bare ``<`` are read as
far as they make sense; very long pages are aligned block by block; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpuslab.session import written_table

STRETCH = 64
REACH = 2  # neighbours on each side
COPY_SHARE = 0.9
CELLS = 1 << 28  # lines x lines aligned at once

# Element and attribute names of HTML and of common page frames.
TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>")
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr", "param"}
FRAME = {
    "nav", "footer", "aside", "form", "button", "select", "option", "datalist", "fieldset", "dialog", "menu", "svg", "math",
    "canvas", "object", "audio", "video", "head", "label", "search",
}
MAIN = {"article", "main"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu", "menubar",
    "form", "toolbar", "tablist", "status",
}
FRAME_NAMES = {
    "ad", "ads", "advert", "adverts", "advertisement", "adsbygoogle", "sponsor", "sponsored", "promo", "promotion", "nav",
    "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "aside", "footer", "cookie", "cookies", "consent",
    "gdpr", "notice", "newsletter", "subscribe", "signup", "popup", "modal", "overlay", "comment", "comments", "disqus",
    "respond", "replies", "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "pagination", "pager",
    "login", "search", "masthead", "topbar", "banner", "skip", "hidden",
}
OUTER_NAMES = {"header", "head"}  # frame outside of the article only, unless the name speaks of the article
ARTICLE_PARTS = {"article", "post", "entry", "story", "content"}
MAIN_LABELS = {
    "article", "article-body", "article-content", "article-text", "post", "post-body", "post-content", "post-text", "entry",
    "entry-content", "entry-body", "story", "story-body", "content", "content-body", "main", "main-content", "page-content",
}
NEGATING = {"no", "has", "with", "without", "not"}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl", "dt",
    "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li",
    "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "option",
}
CLOSES_P = BLOCK - {"br", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html", "option"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"ul", "ol", "dl", "table", "article", "main", "section", "div", "body", "nav", "aside", "footer", "header", "form", "select"}

Line = tuple[str, bool, bool, bool]  # text, in the frame, in the article, links only


def is_frame(name: str, attributes: str, inside: bool) -> bool:
    """Whether an element never holds article text. ``inside``: it stands in a declared article."""
    if name in MAIN or name in ("body", "html"):
        return False
    if name in FRAME or (name == "header" and not inside):
        return True
    if not attributes:
        return False
    for found in ATTRIBUTE.finditer(attributes):
        key = found[1].lower()
        value = (found[2] or found[3] or found[4] or "").lower()
        if key == "hidden" or (key == "aria-hidden" and value == "true") or (key == "role" and value in ROLES):
            return True
        if key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id"):
            for label in value.split():
                parts = [p for p in re.split(r"[-_]+", label) if p]
                if NEGATING & set(parts):
                    continue
                outer = not inside and OUTER_NAMES & set(parts) and not ARTICLE_PARTS & set(parts)
                if outer or FRAME_NAMES & set(parts):
                    return True
    return False


def is_article(name: str, attributes: str) -> bool:
    """Whether an element declares that it holds the article."""
    if name in MAIN:
        return True
    if not attributes or name not in BLOCK or name in ("body", "html"):
        return False
    for found in ATTRIBUTE.finditer(attributes):
        key, value = found[1].lower(), (found[2] or found[3] or found[4] or "").lower()
        if key == "role" and value == "main" or key == "itemprop" and value == "articlebody":
            return True
        if key in ("class", "id") and any(re.sub("_+", "-", label) in MAIN_LABELS for label in value.split()):
            return True
    return False


def lines_of(page: str) -> list[Line]:
    """Text blocks of a page in order, white space folded, with where they stand."""
    lines: list[Line] = []
    stack: list[tuple[str, bool, bool]] = []  # element, frame, article (each with its ancestors)
    parts: list[str] = []
    linked = plain = links = at = 0

    def flush() -> None:
        nonlocal linked, plain
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                frame, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                lines.append((text, frame, inside, linked > 0 and plain == 0))
            parts.clear()
        linked = plain = 0

    def pop_to(index: int) -> None:
        nonlocal links
        links -= sum(1 for e in stack[index:] if e[0] == "a")
        del stack[index:]

    def close_open(names: set[str]) -> None:
        for index in range(len(stack) - 1, -1, -1):
            if stack[index][0] in names:
                pop_to(index)
                return
            if stack[index][0] in SCOPE:
                return

    while at < len(page):
        start = page.find("<", at)
        piece = page[at:] if start < 0 else page[at:start]
        if piece:
            text = entities.unescape(piece)
            parts.append(text)
            size = len(text.strip())
            if links:
                linked += size
            else:
                plain += size
        if start < 0:
            break
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = len(page) if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), start):
            end = page.find(">", start)
            at = len(page) if end < 0 else end + 1
            continue
        tag = TAG.match(page, start) or LOOSE_TAG.match(page, start)
        if not tag:
            if re.match(r"</?[A-Za-z]", page[start:start + 3]):  # a tag that the end of the page cuts
                break
            parts.append("<")
            at = start + 1
            continue
        at = tag.end()
        closing, name, attributes = tag[1], tag[2].lower(), tag[3]
        if closing:
            open_at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            if name in BLOCK:
                flush()
            elif open_at >= 0 and stack[open_at][1] and not (open_at and stack[open_at - 1][1]):
                flush()  # an inline frame element ends
            if open_at >= 0:
                pop_to(open_at)
            continue
        if name in BLOCK:
            flush()
            if name in CLOSES_P:
                close_open({"p"})
            if name in SELF_CLOSING:
                close_open(SELF_CLOSING[name])
        if name in VOID:
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}", re.I).search(page, at)
            if not end:
                break
            close = page.find(">", end.end())
            at = len(page) if close < 0 else close + 1
            continue
        frame, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        mine = frame or is_frame(name, attributes, inside)
        if mine and not frame:
            flush()
        if attributes.rstrip().endswith("/") and name not in BLOCK and name not in ("a", "b", "i", "em", "strong", "span"):
            continue
        stack.append((name, mine, inside or not mine and is_article(name, attributes)))
        links += name == "a"
    flush()
    return lines


# -- alignment ---------------------------------------------------------------------------------------------------

def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Bit-parallel rows of the LCS table: bit j of row i is 0 where line j of ``b`` adds to the length."""
    places: dict[int, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row = full
    for line in a:
        hit = row & places.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def shared_lines(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Matched line numbers of one longest common subsequence."""
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    high = 0
    while high < min(len(a), len(b)) - low and a[-1 - high] == b[-1 - high]:
        high += 1
    head = [(i, i) for i in range(low)]
    tail = [(len(a) - high + i, len(b) - high + i) for i in range(high)]
    a, b = a[low:len(a) - high], b[low:len(b) - high]
    return head + [(i + low, j + low) for i, j in _middle(a, b)] + tail


def _middle(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    if not a or not b:
        return []
    if len(a) * len(b) > CELLS and len(a) > 1:  # halve a where the two parts' lengths add up best
        half = len(a) // 2
        *_, left = _rows(a[:half], b)
        *_, right = _rows(a[half:][::-1], b[::-1])
        zeros = lambda row: np.concatenate(([0], np.cumsum([c == "0" for c in f"{row:0{len(b)}b}"[::-1]])))
        cut = int(np.argmax(zeros(left) + zeros(right)[::-1]))
        return _middle(a[:half], b[:cut]) + [(i + half, j + cut) for i, j in _middle(a[half:], b[cut:])]
    rows, out = list(_rows(a, b)), []
    i, j = len(a), len(b)
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
            continue
        i -= 1
        if not i or rows[i - 1] >> (j - 1) & 1:
            j -= 1
            out.append((i, j))
    return out[::-1]


def deletions(stretch: list[tuple[str, list[int], list[int]]]) -> list[set[int]]:
    """Shared lines of each of a few neighbours in URL order: ``(host, line hashes, line lengths)`` each."""
    gone: list[set[int]] = [set() for _ in stretch]
    for x, (host, lines, sizes) in enumerate(stretch):
        for y in range(x + 1, min(x + REACH, len(stretch) - 1) + 1):
            other, theirs, their_sizes = stretch[y]
            if other != host:
                break
            pairs = shared_lines(lines, theirs)
            common = sum(sizes[i] for i, _ in pairs)
            if common and common < COPY_SHARE * min(sum(sizes), sum(their_sizes)):
                gone[x].update(i for i, _ in pairs)
                gone[y].update(j for _, j in pairs)
    return gone


# -- Spark side --------------------------------------------------------------------------------------------------

def candidates(lines: list[Line]) -> list[Line]:
    """Lines that are compared: all but the frame's."""
    return [line for line in lines if not line[1]]


def main_text(lines: list[Line], gone: set[int]) -> str:
    """Main text after the shared lines ``gone`` (numbers among the candidates) are deleted; see the module text."""
    kept = candidates(lines)
    declared = any(line[2] for line in kept)
    out = []
    for number, (text, _, inside, links_only) in enumerate(kept):
        if declared and (not inside or (number in gone and links_only)) or not declared and number in gone:
            continue
        out.append(text)
    return " ".join(out)


def line_table(pages: DataFrame) -> DataFrame:
    """``key, host, path, lines, sizes, ask``: hashed lines; ``ask``: a shared line could be deleted."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lines, sizes, ask = batch.column(0), [], [], []
            for page in batch.column(1).to_pylist():
                found = candidates(lines_of(page))
                declared = any(line[2] for line in found)
                ask.append(any(not declared or line[2] and line[3] for line in found))
                lines.append([xxhash.xxh64_intdigest(line[0]) - (1 << 63) for line in found])
                sizes.append([len(line[0]) for line in found])
            yield pa.RecordBatch.from_arrays(
                [keys, batch.column(2), batch.column(3), pa.array(lines, pa.list_(pa.int64())),
                 pa.array(sizes, pa.list_(pa.int32())), pa.array(ask, pa.bool_())],
                ["key", "host", "path", "lines", "sizes", "ask"])

    url = F.coalesce(F.col("url"), F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    rows = pages.select("key", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"), path.alias("path"))
    return rows.mapInArrow(hashed, "key long, host string, path string, lines array<long>, sizes array<int>, ask boolean")


def deleted_lines(pages: DataFrame) -> DataFrame:
    """``key, gone``: numbers of the shared lines of every page that has any; ``pages``: ``key, url, html``."""
    order = ["host", "path", "key"]
    # URL order over all sites: range partitions, then the place inside the partition
    rows = line_table(pages).dropDuplicates(["key"]).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("_at", F.monotonically_increasing_id())
    rows = written_table(rows.withColumn("_part", F.shiftright("_at", 33)), "page-lines")
    parts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    rank = F.col("_before") + F.col("_at") - F.col("_first")
    ranked = rows.join(parts, "_part").withColumn("rank", rank).drop("_part", "_first", "_before", "_at")
    # each stretch also gets the neighbours just outside it
    stretch = F.floor(F.col("rank") / STRETCH)
    near = F.array_distinct(F.array(
        stretch, F.floor((F.col("rank") - REACH) / STRETCH), F.floor((F.col("rank") + REACH) / STRETCH)))
    spread = ranked.withColumn("stretch", F.explode(near)).filter("stretch >= 0")

    def compare(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rank")
        gone = deletions([(h, list(x), list(s)) for h, x, s in zip(part["host"], part["lines"], part["sizes"])])
        own = (part["rank"] // STRETCH == part["stretch"]).to_numpy() & part["ask"].to_numpy()
        rows = [(k, sorted(g)) for k, g, mine in zip(part["key"], gone, own) if mine and g]
        return pd.DataFrame({"key": pd.Series([k for k, _ in rows], dtype="int64"), "gone": pd.Series([g for _, g in rows], dtype=object)})

    return spread.groupBy("stretch").applyInPandas(compare, "key long, gone array<int>")


def extract_text(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """``<key>, url, text, n_chars`` of every page."""
    keyed = pages.select(key, "url", "html").withColumn("key", F.xxhash64(key, "url", "html"))
    gone = written_table(deleted_lines(keyed.select("key", "url", "html")), "page-deletions")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages_, gones = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            texts = [main_text(lines_of(p), set(g or ())) if p else "" for p, g in zip(pages_, gones)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                [key, "url", "text", "n_chars"])

    kind = dict(keyed.dtypes)[key]
    both = keyed.join(gone, "key", "left").select(key, "url", "html", "gone")
    return both.mapInArrow(extract, f"{key} {kind}, url string, text string, n_chars long")

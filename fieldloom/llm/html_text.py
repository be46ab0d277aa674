"""Main text of web pages by text-to-tag ratios.

The parser of the standard library streams events; every block of text becomes a line
with the number of its characters and tags. The ratio of text to tags along the page is
smoothed by a Gaussian, and lines above a threshold form clusters. Elements whose role or
name speaks of menus, forms, adverts and the like are left out only where the clusters
agree: one that holds most of the clusters' text is no boilerplate, whatever its name.
The innermost container that holds all clusters, without what lies before the first and
behind the last of them in containers of its own, or all articles that hold clusters
together, is the content region, whose lines are all kept, however short.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Width of the Gaussian, in lines, and the share of the ratios' deviation that content
#: has to reach.
SIGMA, SHARE = 1.5, 0.5

# Elements by their role in a page.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_SKIPPED = frozenset(
    "script style noscript template head title button select option textarea label iframe "
    "object svg math canvas audio video dialog menu nav footer aside".split()
)
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
_CONTAINERS = frozenset("html body main article section div table td center".split())
_ARTICLES = frozenset(["article", "main"])
# Words in a class, an id or a role that name what is no main text.
_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion "
    "banner cookie cookies consent gdpr notice notices alert popup modal overlay newsletter "
    "subscribe subscription signup login sidebar menu nav navbar navigation breadcrumb "
    "breadcrumbs pagination pager footer masthead comment comments commentlist disqus reply "
    "replies respond related recommended share sharing social widget toolbar skip search "
    "contentinfo complementary hidden".split()
)
_READERS = frozenset("comment comments commentlist disqus reply replies respond".split())
_HEADERS = frozenset(["header", "topbar", "site-header", "page-header"])
_SPLIT = re.compile(r"[^a-z0-9]+")
_HIDDEN = re.compile(r"(display\s*:\s*none|visibility\s*:\s*hidden)", re.I)

# What an element may be left out as: readers' comments, by its role or name, as the
# header of something that is named in front of it; _GONE is left out in any case.
_COMMENTS, _NAMED, _HEAD, _GONE = range(4)


def _role(tag: str, attributes, in_article: bool) -> int | None:
    if tag in _SKIPPED or (tag == "header" and not in_article):
        return _GONE
    role = _NAMED if tag == "form" else None
    if tag in ("html", "body"):
        return None
    for name, value in attributes:
        if name == "hidden":
            return _GONE
        if not value:
            continue
        if name == "aria-hidden" and value.lower() == "true":
            return _GONE
        if name == "style" and _HIDDEN.search(value):
            return _GONE
        if name in ("class", "id", "role"):
            value = value.lower()
            words = set(_SPLIT.split(value))
            if words & _READERS:
                return _COMMENTS
            if tag in _ARTICLES:
                continue
            if words & _WORDS or (not in_article and (words | set(value.split())) & _HEADERS):
                if words & _WORDS or set(value.split()) & _HEADERS:
                    role = _NAMED
                elif role is None:
                    role = _HEAD
    return role


class Line(NamedTuple):
    text: str
    tags: int
    path: tuple[int, ...]  # of containers around it
    roles: tuple[int, ...]  # of elements around it that may be left out
    title: bool


class PageLines(HTMLParser):
    """Lines of a page, with the containers and the elements of a role around each."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.stack: list[str] = []
        self.open: Counter[str] = Counter()  # elements of the stack by name
        self.skipped_at = 0  # depth of the outermost skipped element, 0 for none
        self.path: list[int] = []
        self.depths: list[int] = []
        self.articles: set[int] = set()
        self.open_articles = 0
        self.containers: list[str] = [""]  # names by number, from 1 on
        self.kinds: list[int] = []  # of all elements with a role
        self.places: list[tuple[int, ...]] = []  # the containers around each of them
        self.roles: list[int] = []
        self.role_depths: list[tuple[int, int]] = []  # and tags before
        self.parts: list[str] = []
        self.tags = 0

    def handle_starttag(self, tag, attributes):
        if tag in _VOID:
            if not self.skipped_at:
                self.tags += 1
                if tag == "hr":
                    self._flush()
                elif tag == "br":
                    self.parts.append(" ")
            return
        if tag == "p" and self.stack and self.stack[-1] == "p":
            self._pop(len(self.stack) - 1)
        self.stack.append(tag)
        self.open[tag] += 1
        if self.skipped_at:
            return
        if tag in _BLOCKS:
            self._flush(len(self.stack) - 1)
        self.tags += 1
        role = _role(tag, attributes, self.open_articles > 0)
        if role is not None:
            if role == _GONE or tag not in _BLOCKS:
                self.skipped_at = len(self.stack)
                return
            self.roles.append(len(self.kinds))
            self.role_depths.append((len(self.stack), self.tags))
            self.kinds.append(role)
            self.places.append(tuple(self.path))
        if tag in _CONTAINERS:
            self.path.append(len(self.containers))
            self.containers.append(tag)
            self.depths.append(len(self.stack))
            if tag in _ARTICLES:
                self.articles.add(self.path[-1])
                self.open_articles += 1

    def handle_startendtag(self, tag, attributes):
        self.handle_starttag(tag, attributes)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in _VOID:
            return
        # An end tag that nothing is open for closes nothing.
        if self.open[tag]:
            depth = len(self.stack) - 1
            while self.stack[depth] != tag:
                depth -= 1
            self._pop(depth)
        if not self.skipped_at and tag in _BLOCKS:
            self._flush()

    def _pop(self, depth: int):
        """Close all elements from ``depth`` on."""
        if self.skipped_at and self.skipped_at > depth:
            self.skipped_at = 0
        elif not self.skipped_at and any(t in _BLOCKS for t in self.stack[depth:]):
            self._flush()
        for tag in self.stack[depth:]:
            self.open[tag] -= 1
        del self.stack[depth:]
        while self.role_depths and self.role_depths[-1][0] > depth:
            self.roles.pop()
            # Tags inside do not count for what comes behind.
            self.tags = self.role_depths.pop()[1]
        while self.depths and self.depths[-1] > depth:
            self.depths.pop()
            if self.path.pop() in self.articles:
                self.open_articles -= 1

    def handle_data(self, data):
        if not self.skipped_at:
            self.parts.append(data)

    def _flush(self, depth: int | None = None):
        """End a line; ``depth``: of the elements it lies in, if not all those now open."""
        text = " ".join("".join(self.parts).split())
        if text:
            title = self.open["h1"] > 0 and "h1" in self.stack[:depth]
            self.lines.append(Line(text, max(1, self.tags), tuple(self.path), tuple(self.roles), title))
            self.tags = 0
        self.parts = []

    def finish(self) -> list[Line]:
        self.close()
        if not self.skipped_at:
            self._flush()
        return self.lines


def smoothed(values: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """``values`` under a Gaussian kernel, ends continued by their mirror image."""
    reach = int(np.ceil(2 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    kernel /= kernel.sum()
    mirrored = np.pad(values, reach, mode="symmetric" if len(values) >= reach else "edge")
    return np.convolve(mirrored, kernel, mode="valid")


def _clusters(lines: list[Line]) -> np.ndarray:
    """Which lines are in clusters: runs with a smoothed ratio of text to tags above the
    threshold, without lines at their ends that only smoothing has lifted above it."""
    ratio = np.array([len(line.text) / line.tags for line in lines], float)
    smooth = smoothed(ratio)
    least = SHARE * smooth.std()
    content, own = smooth >= least, ratio >= least
    edges = np.flatnonzero(np.diff(np.concatenate([[False], content, [False]]).astype(np.int8)))
    for first, last in zip(edges[::2], edges[1::2]):
        inside = np.flatnonzero(own[first:last])
        if len(inside):
            content[first : first + inside[0]] = False
            content[first + inside[-1] + 1 : last] = False
    return content


def _left_out(parser: PageLines, lines: list[Line]) -> set[int]:
    """The elements of a role that are no part of the text, by the clusters inside them."""
    content = _clusters(lines)
    inside = np.zeros(len(parser.kinds))
    total = 0
    for line, cluster in zip(lines, content):
        if cluster and not any(parser.kinds[r] == _COMMENTS for r in line.roles):
            total += len(line.text)
            for r in line.roles:
                inside[r] += len(line.text)
    out = {
        r for r, kind in enumerate(parser.kinds) if kind == _COMMENTS or 2 * inside[r] <= total
    }
    free = sum(len(line.text) for line, c in zip(lines, content) if c and not out.intersection(line.roles))
    if 10 * free < total:
        # Nearly all the text lies in elements of a role, as where a layout names them so.
        out = {r for r in out if not inside[r]}
    if not total:
        # No clusters but in comments: then these are the page's text.
        out = {r for r in out if parser.kinds[r] != _COMMENTS}
    # The header of a text, by its title and its place beside the clusters.
    kept = [line.path for line, c in zip(lines, content) if c and not out.intersection(line.roles)]
    region = os.path.commonprefix(kept) if kept else ()
    for line in lines:
        for r in line.roles:
            place = parser.places[r]
            inner = bool(place) and parser.containers[place[-1]] not in ("html", "body")
            if line.title and parser.kinds[r] == _HEAD and inner and region[: len(place)] == place:
                out.discard(r)
    return out


def main_text(html: str | None) -> str:
    """Blocks of the main text of one page, joined by newlines; '' if there are none."""
    if not html:
        return ""
    parser = PageLines()
    parser.feed(html)
    lines = parser.finish()
    if not lines:
        return ""
    if parser.kinds:
        out = _left_out(parser, lines)
        lines = [line for line in lines if not out.intersection(line.roles)]
        if not lines:
            return ""
    content = _clusters(lines)
    articles = {a for line, c in zip(lines, content) if c for a in parser.articles.intersection(line.path)}
    if articles:
        # All articles that hold clusters together.
        return "\n".join(line.text for line in lines if articles.intersection(line.path))
    # A title belongs to the text, however short.
    part = [i for i, line in enumerate(lines) if content[i] or line.title]
    region = os.path.commonprefix([lines[i].path for i in part])
    depth = len(region)
    # Containers of the region that hold clusters, and the first and last of those.
    held = {lines[i].path[: depth + 1] for i in part}
    first, last = part[0], part[-1]
    kept = []
    for i, line in enumerate(lines):
        beside = len(line.path) > depth and line.path[: depth + 1] not in held
        if line.path[:depth] == region and (first <= i <= last or not beside):
            kept.append(line.text)
    return "\n".join(kept)


def extract(pages: DataFrame, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with ``html`` replaced by its main text in the column ``out``.

    Null and empty pages, and pages without text, give ''. A column named ``out`` is
    replaced; all other columns and repeated rows stay.
    """
    kept = [f for f in pages.schema.fields if f.name not in (html, out)]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField(out, T.StringType())])

    def run(batches):
        for batch in slices(batches, html):
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            texts = [main_text(page) for page in column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*map(column, names), pa.array(texts, pa.string())], names=schema.names
            )

    return pages.select(*names, html).mapInArrow(run, schema)


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every page."""
    found = extract(pages.select("page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))

"""Text and links of HTML pages. Parsing is a small Arrow step with the standard library; all else is columns."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from firmlens.functions import fixed, urls
from firmlens.functions.text import clean_lines
from firmlens.shared import find_package

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MAX_BANNER = 1500
SHORT_BANNER = 300
#: Bytes of pages that are parsed at a time.
HTML_BYTES = 1 << 20


class _Page(HTMLParser):
    """Text pieces outside script and style, the spans of elements whose attributes speak of cookies, and the links."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.pieces: list[str] = []
        self.open: list[tuple[str, int, bool]] = []
        self.banners: list[tuple[int, int]] = []
        self.links: list[list[str]] = []
        self.muted = 0
        self.link = False

    def handle_starttag(self, tag, attrs):
        values = {k: v or "" for k, v in attrs}
        if tag in ("script", "style"):
            self.muted += 1
        marks = " ".join(values.get(k, "") for k in ("id", "class", "aria-label", "data-testid", "data-test", "data-cy", "role")).lower()
        if tag not in VOID:
            self.open.append((tag, len(self.pieces), any(m in marks for m in fixed.COOKIE_ATTRIBUTES)))
        if tag == "a" and values.get("href", "").strip():
            self.links.append([values["href"].strip(), ""])
            self.link = True

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.muted = max(0, self.muted - 1)
        if tag == "a":
            self.link = False
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] == tag), None)
        if at is not None:
            self.banners += [(start, len(self.pieces)) for _, start, cookie in self.open[at:] if cookie]
            del self.open[at:]

    def handle_data(self, data):
        if self.muted:
            return
        if self.link:
            self.links[-1][1] += data
        if data.strip():
            self.pieces.append(data.strip())

    def text(self) -> str:
        import re

        gone = set()
        for a, b in [*self.banners, *((start, len(self.pieces)) for _, start, cookie in self.open if cookie)]:
            said = re.sub(r"\s+", " ", " ".join(self.pieces[a:b])).strip().lower()
            if not said or len(said) > MAX_BANNER or re.search(fixed.PHONE_OR_EMAIL, said):
                continue
            strong = any(m in said for m in fixed.COOKIE_MARKERS if " " in m)
            if strong or (("cookie" in said or "consent" in said) and len(said) <= SHORT_BANNER):
                gone.update(range(a, b))
        return "\n".join(p for i, p in enumerate(self.pieces) if i not in gone)


def parse(html: str | None) -> tuple[str, list[list[str]]]:
    page = _Page()
    page.feed(html or "")
    page.close()
    return page.text(), page.links


def slices(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of pages in slices of about HTML_BYTES, at least a page each: a batch's texts and links aren't held at once."""
    for frame in frames:
        ends = pc.cumulative_sum(pc.fill_null(pc.binary_length(frame.column(2)), 0).cast(pa.int64())).to_numpy()
        start = 0
        while start < frame.num_rows:
            done = int(ends[start - 1]) if start else 0
            end = max(start + 1, int(ends.searchsorted(done + HTML_BYTES, side="right")))
            yield frame.slice(start, end - start)
            start = end


def _parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, raw text (a line per text node) and links (href, text) of pages(page_id, url, html)."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("href", pa.string()), ("text", pa.string())]))
        for frame in slices(frames):
            got = [parse(h) for h in frame.column(2).to_pylist()]
            links = pa.array([[{"href": h, "text": t} for h, t in ls] for _, ls in got], kind)
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array([t for t, _ in got], pa.string()), links], names=["page_id", "url", "raw", "links"])

    find_package(pages.sparkSession)
    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, raw string, links array<struct<href:string,text:string>>")


def page_text(pages: DataFrame) -> DataFrame:
    """page_id, url and the page's text: no scripts, no cookie banners or lines, each line once."""
    return _parsed(pages).select("page_id", "url", clean_lines(F.col("raw")).alias("text"))


def page_links(pages: DataFrame, *, exclude: tuple[str, ...] = (), **keywords) -> DataFrame:
    """(page_id, url, link, score, position): the links of each page that stay on its host, both addresses normalized, in the
    page's order. keywords: those of urls.link_score. Links without a target keyword and links whose path holds one of
    `exclude` are left out. Null html: no links."""

    def join(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            target = [urljoin(b or "", h) if h else None for b, h in zip(frame.column(1).to_pylist(), frame.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([frame.column(0), frame.column(1), pa.array(target, pa.string()), *frame.columns[3:]], names=["page_id", "url", "target", "text", "position"])

    links = _parsed(pages).select("page_id", "url", F.posexplode("links").alias("position", "l")).select("page_id", "url", F.col("l.href").alias("href"), F.col("l.text").alias("text"), "position")
    links = links.mapInArrow(join, "page_id long, url string, target string, text string, position int")
    links = links.where(urls.scheme(F.col("target")).isin("http", "https") & (urls.host(F.col("target")) == urls.host(F.col("url"))))
    links = links.where(~urls.excluded(F.col("target"), exclude) & urls.is_target_link(urls.normalize(F.col("target")), F.col("text"), **keywords))
    link = urls.normalize(F.col("target"))
    return links.select("page_id", urls.normalize(F.col("url")).alias("url"), link.alias("link"), urls.link_score(link, F.col("text"), **keywords).alias("score"), "position")


def top_links(pages: DataFrame, *, most: int = 3, least: int = 0, exclude: tuple[str, ...] = (), **keywords) -> DataFrame:
    """The best links of each page within its host, by score, then address.

    Links and keywords: those of page_links. Null html: no links; repeated rows of a page count once; an empty table gives
    no rows; further columns are not read.
    """
    links = page_links(pages, exclude=exclude, **keywords).groupBy("page_id", "link").agg(F.max("score").alias("score"))
    w = Window.partitionBy("page_id").orderBy(F.desc("score"), "link")
    return links.where(F.col("score") >= least).withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)

"""Postings in HTML pages: list items, and cards read by position.

A page frame has ``page_id`` (a whole number giving the order) and ``html``.  A
page is read once, in an Arrow batch: each card is found by its opening tag, ends
at the closing tag that matches, and gives all its fields at once.  Pages with
irregular markup can go through :func:`extract_with` instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftline.operators.dedup import keep_first
from siftline.sources import markup as M
from siftline.sources.common import as_postings, document_seq

# Words that mark an experience label or a location label.
EXPERIENCE_WORDS = ("경력", "신입")
REGION_WORDS = ("서울", "경기", "부산", "대구", "인천", "전국", "대전", "광주", "울산", "세종")

_LINK = r"<a\b[^>]*>.*?</a>"
_SPAN = r"<span\b[^>]*>(.*?)</span>"


def _tag(name: str, token: str) -> str:
    """Opening tag with ``token`` among its classes."""
    return rf"""<{name}\b[^>]*\bclass\s*=\s*["'](?:[^"']*\s)?{token}(?:\s[^"']*)?["'][^>]*>"""


@dataclass(frozen=True)
class ListLayout:
    """Where a list page keeps its parts, as regular expressions for opening tags (see ``markup.pattern``).

    A part left ``None`` is not looked for, except that a missing ``title_box``
    means the title link may stand anywhere in the item.
    """

    host: str
    item: str
    container: str | None = None
    title_box: str | None = None
    company_box: str | None = None
    company_link: str | None = None
    label: str | None = None
    date_box: str | None = None
    id_pattern: str = r"job=(\d+)"


# The list page of one source.
LIST_PAGE = ListLayout(
    host="https://job.incruit.com",
    container=_tag("div", "cBbslist_contenst"),
    item=_tag("li", "c_col"),
    title_box=_tag("div", "cell_mid"),
    company_box=_tag("div", "cell_first"),
    company_link=_tag("a", "cpname"),
    label=_tag("span", "cl_md"),
    date_box=_tag("div", "cell_last"),
)

# The card page of another.
CARD_HOST = "https://www.jobkorea.co.kr"
CARD_OPEN = r"""<div\b[^>]*\bclass\s*=\s*["'][^"']*shadow-list[^"']*["'][^>]*>"""
CARD_LINK_MARK = "GI_Read"
CARD_ID = r"GI_Read/(\d+)"
MIN_TITLE, MIN_COMPANY = 5, 1


CARD_FIELDS = ("source_id", "url", "title", "company", "location", "experience_required", "posted_date")
_ROWS = "page_id long, position long, " + ", ".join(f"{c} string" for c in CARD_FIELDS) + ", complete boolean"

# Fields of a card by name, and whether it is a posting.
Card = tuple[dict[str, str], bool]


def absolute_url(href: str, host: str) -> str:
    return href if href.startswith("http") else host + href


def _read_cards(pages: DataFrame, cards: Callable[[str], Iterator[Card]]) -> DataFrame:
    """One row per card of each page, as ``cards`` reads them, with the place on its page from 1."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (page, position, *[fields.get(c, "") for c in CARD_FIELDS], complete)
                for page, html in zip(batch.column("page_id").to_pylist(), batch.column("html"), strict=True)
                for position, (fields, complete) in enumerate(cards(html.as_py() or ""), 1)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * (len(CARD_FIELDS) + 3)
            kinds = [pa.int64(), pa.int64(), *[pa.string()] * len(CARD_FIELDS), pa.bool_()]
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["page_id", "position", *CARD_FIELDS, "complete"],
            )

    numbered = pages.select(F.col("page_id").cast("long").alias("page_id"), "html")
    return numbered.mapInArrow(read, _ROWS).withColumn("seq", document_seq(F.col("page_id"), F.col("position")))


def list_cards(html: str, layout: ListLayout) -> Iterator[Card]:
    """The items of a list page."""
    if layout.container:
        html = M.first_element(html, layout.container) or ""
    for card in M.elements(html, layout.item):
        box = card
        if layout.title_box:
            box = M.first_element(card, layout.title_box) or ""
        found = M.pattern(_LINK).search(box)
        link = found[0] if found else ""
        href, title = M.attribute(link, "href"), M.inner_text(link)
        fields = {"url": absolute_url(href, layout.host), "title": title}
        number = M.pattern(layout.id_pattern).search(href)
        fields["source_id"] = number[1] if number else href
        if layout.company_link:
            around = M.first_element(card, layout.company_box) or "" if layout.company_box else card
            company = M.pattern(f"{layout.company_link}(.*?)</a>").search(around)
            fields["company"] = M.inner_text(company[1]) if company else ""
        if layout.label:
            labels = [M.inner_text(x[1]) for x in M.pattern(f"{layout.label}(.*?)</span>").finditer(box)]
            fields["experience_required"] = M.first_with(labels, EXPERIENCE_WORDS)
        if layout.date_box:
            fields["posted_date"] = M.inner_text(M.first_element(card, layout.date_box) or "")
        yield fields, bool(href and title)


def position_cards(html: str) -> Iterator[Card]:
    """The cards of a page whose parts are told apart by length and position."""
    for card in M.elements(html, CARD_OPEN):
        links = []
        for link in M.pattern(_LINK).finditer(card):
            href = M.attribute(link[0], "href")
            if CARD_LINK_MARK in href:
                links.append((href, M.inner_text(link[0])))
        number = next((x for x in (M.pattern(CARD_ID).search(href) for href, _ in links) if x), None)
        title_at = next((i for i, (_, text) in enumerate(links) if len(text) > MIN_TITLE), None)
        complete = number is not None and title_at is not None
        spans = [M.inner_text(x[1]) for x in M.pattern(_SPAN).finditer(card)]
        after = [] if title_at is None else [text for _, text in links[title_at + 1 :] if len(text) > MIN_COMPANY]
        fields = {
            # Only a complete card takes its id; the others share the blank one.
            "source_id": number[1] if complete else "",
            "url": absolute_url(number.string, CARD_HOST) if number else "",
            "title": links[title_at][1] if title_at is not None else "",
            "company": after[0] if after else "",
            "location": M.first_with(spans, REGION_WORDS),
            "experience_required": M.first_with(spans, EXPERIENCE_WORDS),
        }
        yield fields, complete


def html_list_postings(
    pages: DataFrame,
    as_of: datetime | str | Column,
    source: str = "incruit",
    layout: ListLayout = LIST_PAGE,
) -> DataFrame:
    """One posting per list item that has a link with an address and a text.

    The id is the number in the address, else the address itself.  It counts as
    taken even when its item turns out to have no title.
    """
    rows = _read_cards(pages, lambda html: list_cards(html, layout))
    return as_postings(keep_first(rows, key="source_id").where("complete"), source, as_of)


def html_card_postings(
    pages: DataFrame, as_of: datetime | str | Column, source: str = "jobkorea"
) -> DataFrame:
    """One posting per card, its parts told apart by length and position.

    Of the links to the posting, the first text longer than 5 is the title and
    the next one longer than 1 the company.
    """
    rows = _read_cards(pages, position_cards)
    return as_postings(keep_first(rows, key="source_id").where("complete"), source, as_of)


def extract_with(
    pages: DataFrame,
    extractor: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: str,
) -> DataFrame:
    """Rows from a user's own page reader, over Arrow batches of ``page_id, html``."""
    return pages.select("page_id", "html").mapInPandas(extractor, schema)

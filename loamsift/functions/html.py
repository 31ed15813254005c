"""HTML: detection by built-in functions, extraction of plain text by an Arrow function."""

from __future__ import annotations

import codecs
import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from loamsift.functions import patterns as P
from loamsift.functions.text import strip


def html_type(text: Column) -> Column:
    """empty, full_html, xml, partial_html, generic_tags or plain_text, by the first 2000 and 5000 characters."""
    head, more = F.lower(F.substring(text, 1, 2000)), F.substring(text, 1, 5000)
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "empty")
        .when(head.contains("<!doctype html") | head.contains("<html"), "full_html")
        .when(strip(head).startswith("<?xml"), "xml")
        .when(more.rlike("(?iU)" + P.PARTIAL_TAG), "partial_html")
        .when(more.rlike("(?sU)" + P.GENERIC_TAG), "generic_tags")
        .otherwise("plain_text")
    )


def is_html(text: Column) -> Column:
    return ~html_type(text).isin("empty", "plain_text")


_DROPPED = {"script", "style", "head", "title", "noscript", "template", "iframe", "object", "svg", "select"}
_BLOCKS = {"address", "article", "aside", "blockquote", "body", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "main", "nav", "ol", "p", "pre", "section", "table", "ul"}
_LINES = {"li", "tr", "br"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Reader(HTMLParser):
    """Blocks are parted by an empty line, rows and items by a line break; items have a bullet."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.line = ""
        self.bullet = False
        self.gap = 0
        self.hidden: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if self.hidden:
            if tag in _DROPPED and tag not in _VOID:
                self.hidden.append(tag)
            elif tag == "body":  # a head that was never closed
                self.hidden.clear()
            return
        if tag in _DROPPED:
            self.hidden.append(tag)
        elif tag in _BLOCKS:
            self._end(2)
        elif tag in _LINES:
            self._end(1)
            self.bullet = self.bullet or tag == "li"
        elif tag in ("td", "th"):
            self.line += "\t"

    def handle_endtag(self, tag: str) -> None:
        if self.hidden:
            if tag in self.hidden:
                while self.hidden.pop() != tag:
                    pass
            return
        if tag in _BLOCKS:
            self._end(2)
        elif tag in ("li", "tr"):
            self._end(1)
            self.bullet = False

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.line += data

    def _end(self, gap: int) -> None:
        text = re.sub(r"[ \t\r\n\f]+", " ", self.line).strip(" ")
        self.line = ""
        if text:
            if self.out:
                self.out.append("\n" * max(1, self.gap))
            self.out.append(("  • " if self.bullet else "") + text)
            self.bullet, self.gap = False, 0
        self.gap = max(self.gap, gap)

    def text(self) -> str:
        self._end(0)
        return "".join(self.out)


def decode(page: bytes) -> str:
    """UTF-8, else what a byte-order mark or a meta tag names, else Latin-1."""
    try:
        return page.decode("utf-8")
    except UnicodeDecodeError:
        pass
    marks = ((codecs.BOM_UTF16_LE, "utf-16"), (codecs.BOM_UTF16_BE, "utf-16"))
    named = re.search(rb"charset=[\"']?([A-Za-z0-9_-]+)", page[:2048])
    for name in [n for m, n in marks if page.startswith(m)] + ([named[1].decode()] if named else []):
        try:
            return page.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return page.decode("latin-1")


def extract_text(page: str | bytes | None) -> str | None:
    """Plain text of a page; None for none or no bytes."""
    if not page:
        return None
    reader = _Reader()
    reader.feed(page if isinstance(page, str) else decode(page))
    reader.close()
    return reader.text()


@F.pandas_udf(StringType())
def _extracted(pages: pd.Series) -> pd.Series:
    return pages.map(extract_text, na_action="ignore")


def extract(page: Column) -> Column:
    """extract_text as a column over strings or binaries; evaluated once, whatever filters follow."""
    return _extracted.asNondeterministic()(page)


def extracted_or_original(text: Column) -> Column:
    return F.coalesce(extract(text), text)

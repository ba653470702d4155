"""Links, titles and error pages by native patterns, where no tree is needed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import absolute, collapse, none_if_blank, unescape

_FILE = r"""(?i)<a\b[^>]*?href=["']([^"']*filestream\.ashx\?DocumentId=\d+[^"']*)"""
_ANY = r"""(?i)(?:href|src)=["']([^"']*filestream\.ashx\?DocumentId=\d+[^"']*)"""
_MEETING = r"""(?i)<a\b[^>]*?href=["']([^"']*Meeting\.aspx\?[^"']+)"""
#: What an error page says.
MISSING = ("this meeting is not available", "the published report was not found")


def page_title(html: Column) -> Column:
    return none_if_blank(collapse(unescape(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))))


def page_links(html: Column) -> Column:
    """Anchors' targets, distinct, in order."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)<a\b[^>]*?href=["']([^"']+)["']""")), unescape))


def _found(html: Column, pattern: str, base: str) -> Column:
    return F.transform(F.regexp_extract_all(html, F.lit(pattern)), lambda u: absolute(unescape(u), base))


def document_links(html: Column, base: str) -> Column:
    """Linked files, then meetings: absolute, distinct, in order."""
    return F.array_distinct(F.concat(_found(html, _FILE, base), _found(html, _MEETING, base)))


def asset_links(html: Column, base: str) -> Column:
    """Files a page loads but doesn't link: its style sheets and images."""
    return F.array_except(F.array_distinct(_found(html, _ANY, base)), _found(html, _FILE, base))


def meeting_pages(calendar: Column, base: str) -> Column:
    """Detail pages of the meetings in a calendar's JSON that have an agenda."""
    meetings = F.from_json(calendar, "d array<struct<ID string, HasAgenda boolean>>").d
    good = F.filter(meetings, lambda m: m.HasAgenda & m.ID.isNotNull() & (m.ID != ""))
    return F.transform(good, lambda m: F.concat(F.lit(f"{base}Meeting.aspx?Id="), m.ID, F.lit("&Agenda=Agenda&lang=English")))


def is_error_page(html: Column) -> Column:
    text = F.lower(F.coalesce(html, F.lit("")))
    said = F.lit(False)
    for marker in MISSING:
        said = said | text.contains(marker)
    return said

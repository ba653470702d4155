"""Identifiers: document numbers, call numbers, event ids, agency references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, none_if_blank

#: Junk that survives as ten digits.
NOT_DOCUMENTS = ("1111111111", "0000000000", "1234567890")


def document_number(raw: Column) -> Column:
    """Ten digits once all else is gone, and none of the known junk; else null."""
    digits = F.regexp_replace(raw.cast("string"), "[^0-9]", "")
    return F.when((F.length(digits) == 10) & ~digits.isin(*NOT_DOCUMENTS), digits)


def bridged_document_number(external: Column, title: Column) -> Column:
    """From the external id, else from a Doc and ten digits in the title, no eleventh after them."""
    named = none_if_blank(F.regexp_extract(title, r"Doc(\d{10})(?!\d)", 1))
    return F.coalesce(document_number(external), document_number(named))


def zip_document_number(name: Column) -> Column:
    return bridged_document_number(F.lit(None).cast("string"), name)


def call_number(raw: Column) -> Column:
    """The first core of a known shape, division-year-sequence before number-year; any dash,
    spaced or not, is a hyphen."""
    text = F.regexp_replace(raw, "[‐-―−]", "-")
    text = F.regexp_replace(text, r"[ \t]*-[ \t]*", "-")
    return none_if_blank(F.regexp_extract(text, r"(?U)\b(\d{4}-\d{2}-\d{4}|\d{1,4}-(?:19|20)\d{2})\b", 1))


def rfx_id(link: Column) -> Column:
    return none_if_blank(F.regexp_extract(link, r"/RfxEvent/preview/(\d+)", 1))


def award_document_number(title: Column) -> Column:
    """The ten digits an award item names as its document."""
    return none_if_blank(F.regexp_extract(title, r"(?iU)(?:Ariba\s+)?Doc(?:ument)?(?:\s*Number)?\s*[:#]?\s*(\d{10})", 1))


def contract_number(text: Column) -> Column:
    """A construction contract number such as 25ECS-MI-02SW in a project's name."""
    return none_if_blank(F.regexp_extract(text, r"(?U)\b(\d{2}[A-Z]{2,4}(?:-[A-Z0-9]+){1,3})\b", 1))


def native_ref(*candidates: Column) -> Column:
    """The first that isn't blank, white space collapsed, upper case."""
    return F.upper(F.coalesce(*(none_if_blank(collapse(c)) for c in candidates)))


def meeting_date(text: Column) -> Column:
    """'Meeting Date: Wednesday, May 3, 2017' as a date; any weekday's date failing that."""
    named = F.regexp_extract(text, r"(?iU)Meeting Date:\s*(?:<[^>]*>\s*)*\w+day,\s*(\w+ \d{1,2}, \d{4})", 1)
    other = F.regexp_extract(text, r"(?iU)\w+day,\s*(\w+ \d{1,2}, \d{4})", 1)
    return F.try_to_timestamp(F.coalesce(none_if_blank(named), none_if_blank(other)), F.lit("MMMM d, yyyy")).cast("date")

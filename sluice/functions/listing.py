"""File listings: which labels are documents, where a row stands, in what order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import none_if_blank

#: Extensions of documents.
EXTENSIONS = "7z bmp csv dgn docx? dwf dwg dxf eml gif gz jpe?g kmz msg odt pdf png pptx? rar rtf tar tiff? txt xlsm xlsx? xml zip"


def _flat(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "), "^ | $", "")


def is_document_name(name: Column) -> Column:
    """A label with a document's extension that is no URL."""
    text = _flat(name)
    return ~F.lower(text).rlike(r"^(https?://|www\.)") & text.rlike(rf"(?i)\.({EXTENSIONS.replace(' ', '|')})(?![A-Za-z0-9])")


def outline(row: Column) -> Column:
    """A row's leading outline number, or null."""
    return none_if_blank(F.regexp_extract(_flat(row), r"^(\d+(?:\.\d+)*)(?:\s|$)", 1))


def row_identity(row: Column) -> Column:
    return F.coalesce(outline(row), _flat(row))


def anchor_key(row: Column, ordinal: Column, name: Column) -> Column:
    return F.concat_ws("#", row_identity(row), F.coalesce(ordinal.try_cast("int"), F.lit(0)).cast("string"), _flat(name))


def anchor_kind(role: Column, bh: Column, css: Column) -> Column:
    item = (F.lower(F.trim(F.coalesce(role, F.lit("")))) == "menuitem") | (F.upper(F.trim(F.coalesce(bh, F.lit("")))) == "PMI") | F.lower(F.coalesce(css, F.lit(""))).contains("w-pmi-item")
    return F.when(item, "menu-item").otherwise("tree-link")


def listing_order(row: Column, ordinal: Column) -> list[Column]:
    """Outline rows first, by number and not by text; then the others by text; then ordinals."""
    number = outline(row)
    parts = F.transform(F.split(number, r"\."), lambda p: p.cast("long"))
    return [number.isNull(), F.coalesce(parts, F.array().cast("array<long>")), F.when(number.isNull(), _flat(row)).otherwise(""), ordinal]

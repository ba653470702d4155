"""Published amounts. Anything that isn't plainly one amount in Canadian dollars is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How an amount is written.
_AMOUNT = r"(?U)^\s*\$?\s*(\d{1,3}(?:,\d{3})+|\d+)(\.\d+)?\s*([A-Za-z]{3})?\s*$"
#: The footnote markers that ride on prices and names.
MARKERS = "*^+†‡§"


def parse_amount(raw: Column) -> Column:
    """A double: grouped or plain digits, at most one decimal point with digits after it, an
    optional dollar sign, an optional three-letter code that must be CAD. A number is its own amount."""
    text = raw.cast("string")
    code = F.upper(F.regexp_extract(text, _AMOUNT, 3))
    number = F.concat(F.replace(F.regexp_extract(text, _AMOUNT, 1), F.lit(","), F.lit("")), F.regexp_extract(text, _AMOUNT, 2))
    is_number = F.typeof(raw).rlike("int$|^float$|^double$|^decimal")
    return F.when(is_number, raw.try_cast("double")).when(text.rlike(_AMOUNT) & code.isin("", "CAD"), number.try_cast("double"))


def parse_bid_price(raw: Column) -> Column:
    """parse_amount without a trailing run of footnote markers."""
    return parse_amount(F.regexp_replace(raw, rf"(?U)[\s{MARKERS}]+$", ""))


def hst_basis(header: Column) -> Column:
    """Whether a price column's heading says taxes are in; 'including' is asked first."""
    taxes = r"\w*\.?\s*(all applicable taxes|h\.?s\.?t)"
    return F.when(header.rlike(rf"(?iU)\bincl{taxes}"), "including").when(header.rlike(rf"(?iU)\bexcl{taxes}"), "excluding")


def clean_bidder(name: Column) -> Column:
    """Markers off both ends, then a row number, then markers again."""
    ends = rf"(?U)^[\s{MARKERS}]+|[\s{MARKERS}]+$"
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(name, ends, ""), r"(?U)^\s*\d+[.)]\s+", ""), ends, "")

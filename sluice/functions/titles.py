"""Titles, and the placeholders that aren't."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse

#: Words of reference scaffolding, never subject matter.
NOISE_WORDS = "doc docs summary notice ariba no nbr number tender tenders rfq rfp nrfp rfi rfsq noip call"


def is_placeholder_title(title: Column) -> Column:
    """True if no word of two letters is left without digits, punctuation and scaffolding.
    Digits go first, so that a word glued to a number stands free."""
    words = F.regexp_replace(title, r"(?U)[\d\W_]+", " ")
    words = F.regexp_replace(words, rf"(?iU)\b({NOISE_WORDS.replace(' ', '|')})\b", " ")
    return F.coalesce(~words.rlike(r"(?U)\S{2,}"), F.lit(True))


def clean_title(title: Column) -> Column:
    """The title with its white space collapsed, null for a placeholder."""
    return F.when(~is_placeholder_title(title), collapse(title))

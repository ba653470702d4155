"""Cleaning published strings, as native columns.

White space is Unicode white space (``(?U)``), a dot stops at ``\\n`` only (``(?d)``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body over a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without leading and trailing white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def collapse(c: Column) -> Column:
    """Stripped, every run of white space as one space."""
    return strip(F.regexp_replace(c, r"(?U)\s+", " "))


def none_if_blank(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def clean_portal(c: Column) -> Column:
    """Datastore strings: stripped; blank and the word None are null."""
    s = strip(c.cast("string"))
    return F.when(s.isin("", "None"), F.lit(None)).otherwise(s)


def clean_feed(c: Column) -> Column:
    """Feed strings: stripped, blank is null."""
    return none_if_blank(strip(c.cast("string")))


def clean_feed_list(c: Column) -> Column:
    """A feed's list field: its first element, cleaned; an empty list is null."""
    return clean_feed(F.get(c, F.lit(0)))


def fold(c: Column) -> Column:
    """Names as compared in scoring: lower case, white space collapsed."""
    return collapse(F.lower(c))


def basename(url: Column) -> Column:
    return F.substring_index(url, "/", -1)


def extension(name: Column) -> Column:
    """The leaf's lower-case extension; null without a dot, empty after a trailing dot."""
    leaf = basename(name)
    return F.when(F.instr(leaf, ".") > 0, F.lower(F.substring_index(leaf, ".", -1)))


def absolute(url: Column, base: str) -> Column:
    joined = F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(url, "^/+", ""))
    return F.when(url.startswith("http"), url).otherwise(joined)


#: The entities that occur in archived pages.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    """Named entities of ENTITIES; the ampersand last, so that nothing is unescaped twice."""
    for entity, char in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(char))
    return c


def pdf_kind(url: Column) -> Column:
    """The path segment a report is filed under."""
    return F.when(url.contains("/bgrd/"), "bgrd").when(url.contains("/comm/"), "comm").otherwise("other")


def version_stamp(prompt: Column) -> Column:
    return F.substring(F.sha2(prompt, 256), 1, 12)


def crc_hex(c: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.crc32(c))), 8, "0")


def elapsed(seconds: Column) -> Column:
    """'58 m 04 s', '1 h 02 m'; under a minute '12 s'."""
    s = seconds.cast("long")
    hours, minutes = F.floor(s / 3600), F.floor(s % 3600 / 60)
    return F.when(s >= 3600, F.format_string("%d h %02d m", hours, minutes)).when(s >= 60, F.format_string("%d m %02d s", minutes, s % 60)).otherwise(F.format_string("%d s", s))


def signed(n: Column) -> Column:
    """A delta with its sign and thousands separators."""
    return F.concat(F.when(n < 0, "-").otherwise("+"), F.format_number(F.abs(n), 0))

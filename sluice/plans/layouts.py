"""Pages of several layouts, chosen by their id: what each gives differs in number, names and values."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.amounts import parse_amount
from ..session import table
from ..sources import html_tables
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles


def _pages(spark, sf_dir, html: str, **more: str):
    """pages with the page that a SQL expression over page_id makes."""
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", F.expr(html).alias("html"), *(F.expr(e).alias(n) for n, e in more.items()))


def _each(piece: str, upto: str = "page_id % 4 + 1", start: str = "1") -> str:
    """A piece of a page for each i of a range."""
    return f"array_join(transform(sequence({start}, {upto}), i -> concat({piece})), '')"


_NAME = "'Firm ', page_id, '-', i, ' Ltd'"
_PRICE = "'$', page_id * 10 + i, '.00'"
_LINES = f"concat('<tr><td>', {_each(f"'<p>', {_NAME}, '</p>'")}, '</td><td>', {_each(f"'<p>', {_PRICE}, '</p>'")}, '</td></tr>')"
_BROKEN = f"concat('<tr><td>', {_each(f"{_NAME}, '<br>'", 'page_id % 4 + 1 + page_id % 4 + 1', 'page_id % 4 + 2')}, '</td><td>', {_each(f"{_PRICE}, '<br>'", 'page_id % 4 + 1 + page_id % 4 + 1', 'page_id % 4 + 2')}, '</td></tr>')"
_UNEQUAL = f"concat('<tr><td>', {_each(f"'<p>', {_NAME}, '</p>'")}, '</td><td>', {_each(f"'<p>', {_PRICE}, '</p>'", 'page_id % 4 + 2')}, '</td></tr>')"
#: Rows, columns of lines, rows shifted by their numbers, columns in two blocks, columns that don't pair up, rows without a price.
_BIDS = f"""concat('<h3>BA7.', page_id % 9 + 1, ' - Award of ', CASE WHEN page_id % 5 = 0 THEN 'Works' ELSE concat('Document ', 3230000000 + page_id) END, '</h3><table>', CASE page_id % 6
 WHEN 0 THEN concat('<tr><th>Suppliers</th><th>Bid Price (Incl. HST)</th></tr>', {_each(f"'<tr><td>', if(i = 1, '**', ''), {_NAME}, '</td><td>', {_PRICE}, '</td></tr>'")})
 WHEN 1 THEN concat('<tr><td rowspan=2>Number of Bids:</td><td>Firm Name</td><td>Bid Price excluding HST</td></tr>', {_LINES})
 WHEN 2 THEN concat('<tr><th>Bidder Name</th><th>Quotation</th></tr>', {_each(f"'<tr><td>', i, '.</td><td>', {_NAME}, '</td><td>', {_PRICE}, '</td></tr>'")})
 WHEN 3 THEN concat('<tr><td rowspan=3>Bids</td><td>Contractors:</td><td>Bid Amount including all applicable taxes</td></tr>', {_LINES}, {_BROKEN})
 WHEN 4 THEN concat('<tr><td rowspan=2>Bids</td><td>Firm Name</td><td>Bid Price</td></tr>', {_UNEQUAL})
 ELSE concat('<tr><th>Vendor</th><th>Location</th></tr>', {_each(f"'<tr><td>', {_NAME}, '</td><td>Town</td></tr>'")}) END, '</table><table><tr><td>Cost centre</td><td>Price</td></tr><tr><td>W</td><td>$5.00</td></tr></table>')"""


@query("bid_tables_by_layout", """
WITH p AS (SELECT page_id, page_id % 6 AS layout, (page_id % 4 + 1) * CASE page_id % 6 WHEN 3 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS n FROM pages)
SELECT page_id, '2017.BA7.' || (page_id % 9 + 1) AS reference, CASE WHEN page_id % 5 <> 0 THEN (3230000000 + page_id)::VARCHAR END AS document_number, 'Firm ' || page_id || '-' || i || ' Ltd' AS bidder_name_raw,
  CASE WHEN layout <> 5 THEN '$' || (page_id * 10 + i) || '.00' END AS bid_price, CASE layout WHEN 0 THEN 'including' WHEN 1 THEN 'excluding' WHEN 3 THEN 'including' END AS hst_basis
FROM p, range(1, 9) r(i) WHERE i <= n""")
def bid_tables_by_layout(spark, sf_dir):
    rows = _pages(spark, sf_dir, _BIDS).lateralJoin(html_tables.BidTables(F.col("html").outer(), F.lit("2017.BA7")))
    return rows.select("page_id", "reference", "document_number", "bidder_name_raw", "bid_price", "hst_basis")


_ITEM = """CASE page_id % 4
 WHEN 0 THEN concat('<h1>Item ', page_id, '</h1><h2>Committee Decision</h2><p>That</p><ul><li>be approved ', page_id, '</li></ul><h2>Files</h2><a href="a', page_id, '.pdf">A</a><a href="b.PDF">B</a><a href="a', page_id, '.pdf">A</a><a href="c.html">C</a>')
 WHEN 1 THEN concat('<h2>Item ', page_id, '</h2><h3>Background</h3><p>Text</p><a href="x.pdf">x</a>')
 WHEN 2 THEN concat('<h1>Item&nbsp;', page_id, ' &amp; more</h1>', array_join(transform(sequence(0, page_id % 3), i -> concat('<h3>Decision ', i, '</h3><p>Part ', i, '</p><div>aside</div>')), ''))
 ELSE '<p>This page is empty</p>' END"""


@query("item_pages_by_layout", """
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'Item ' || page_id WHEN 1 THEN 'Item ' || page_id WHEN 2 THEN 'Item ' || page_id || ' & more' END AS title,
  CASE page_id % 4 WHEN 0 THEN 'That be approved ' || page_id WHEN 2 THEN (SELECT string_agg('Part ' || i, ' ' ORDER BY i) FROM range(0, 3) r(i) WHERE i <= page_id % 3) END AS decision_text,
  CASE page_id % 4 WHEN 0 THEN 'a' || page_id || '.pdf|b.PDF' WHEN 1 THEN 'x.pdf' ELSE '' END AS pdfs FROM pages""")
def item_pages_by_layout(spark, sf_dir):
    rows = _pages(spark, sf_dir, _ITEM).lateralJoin(html_tables.CouncilItem(F.col("html").outer()))
    return rows.select("page_id", "title", "decision_text", F.array_join("pdfs", "|").alias("pdfs"))


_REGISTRY = f"""CASE page_id % 3
 WHEN 0 THEN concat('<p>Firms</p><table><tr><th>Authority</th><th>Supplier Name</th></tr>', {_each("'<tr><td>GM', i, '</td><td>Firm ', page_id, '-', i, '</td></tr>'")}, '</table><table><tr><th>Supplier Name</th></tr><tr><td>second table</td></tr></table>')
 WHEN 1 THEN concat('<table><thead><tr><td>Supplier Name</td><td>Status</td><td>Authority</td></tr></thead><tbody>', {_each("'<tr><td><b>Firm</b> ', page_id, '-', i, '</td><td>Active</td><td>GM', i, '</td></tr>'")}, '</tbody></table>')
 ELSE '<p>No firm is suspended.</p>' END"""


@query("registries_by_layout", "SELECT page_id, 'Firm ' || page_id || '-' || i AS supplier_name, 'GM' || i AS authority FROM pages, range(1, 5) r(i) WHERE i <= page_id % 4 + 1 AND page_id % 3 < 2")
def registries_by_layout(spark, sf_dir):
    rows = _pages(spark, sf_dir, _REGISTRY).lateralJoin(html_tables.Registry(F.col("html").outer()))
    return rows.select("page_id", F.col("cells")["Supplier Name"].alias("supplier_name"), F.col("cells")["Authority"].alias("authority"))


_REPORTS = """CASE page_id % 4
 WHEN 0 THEN concat('<ul>', array_join(transform(sequence(0, 3), i -> concat('<li>Doc ', 100 * page_id + i, ' <a href="backgroundfile-', page_id, '-', i, '.pdf">r</a></li>')), ''), '</ul>')
 WHEN 1 THEN concat('<p><a href="backgroundfile-', page_id, '.pdf">only</a> <a href="other.pdf">o</a></p>')
 WHEN 2 THEN '<p><a href="backgroundfile-1.pdf">a</a></p><p><a href="backgroundfile-2.pdf">b</a></p>'
 ELSE '<p>none</p>' END"""


@query("reports_by_layout", "SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'backgroundfile-' || page_id || '-' || (page_id % 3 + 1) || '.pdf' WHEN 1 THEN 'backgroundfile-' || page_id || '.pdf' END AS url FROM pages")
def reports_by_layout(spark, sf_dir):
    """The link beside the number, else the only one, else none."""
    p = _pages(spark, sf_dir, _REPORTS, wanted="concat('Doc ', 100 * page_id + page_id % 3 + 1)")
    return p.lateralJoin(html_tables.ReportLink(F.col("html").outer(), F.col("wanted").outer())).select("page_id", "url")


_AWARDS = f"""concat('<p>', {_each("'BA3.', i, ' - Award of Call ', page_id, CASE WHEN i = 2 THEN ' 1234567899' ELSE '' END, ' to Big ', i, ' Co. for Works is ', CASE WHEN i = 3 THEN 'unknown' ELSE concat('$', format_number(page_id * 1000 + 100 + i, 0), '.50') END, ' net of all applicable taxes. '")}, '</p>')"""


@query("awards_by_layout", "SELECT page_id, '2016.BA3.' || i AS reference, 'Big ' || i || ' Co.' AS winner_raw, (page_id::VARCHAR || (100 + i) || '.50')::DOUBLE AS award_value FROM pages, range(1, 5) r(i) WHERE i <= page_id % 4 + 1 AND i NOT IN (2, 3)")
def awards_by_layout(spark, sf_dir):
    """Items before there were numbers: one that has a number and one without a value aren't among them."""
    rows = _pages(spark, sf_dir, _AWARDS).lateralJoin(html_tables.PreNumberAwards(F.col("html").outer(), F.lit("2016.BA3")))
    return rows.select("page_id", "reference", "winner_raw", parse_amount(F.col("value_raw")).alias("award_value"))

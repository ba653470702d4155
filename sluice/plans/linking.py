"""Nesting, bridging, matching and entity resolution over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import keys, suppliers
from ..operators import dimension, match, nest
from ..session import table
from . import scalars
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles


def _orphaned_orders(spark, sf_dir):
    """orders of which some name a customer that isn't there, or none."""
    k = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").withColumn("o_custkey", F.when(k % 11 == 0, None).when(k % 13 == 0, -k).otherwise(F.col("o_custkey")))


_ORPHANED = "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN -o_orderkey ELSE o_custkey END AS o_custkey, o_totalprice FROM orders"


def customer_documents(spark, sf_dir):
    """customers with their orders, those with their lines: the nested document."""
    orders = _orphaned_orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    nested = nest.nest(orders, lines, "o_orderkey", "l_orderkey", "lines", ["l_linenumber", "l_partkey"])
    return nest.nest(table(spark, sf_dir, "customer").select("c_custkey", "c_name"), nested, "c_custkey", "o_custkey", "orders", ["o_orderkey"])


@query("nested_orders_document", f"""
WITH o AS ({_ORPHANED}), l AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT c_custkey, c_name, count(o_orderkey) AS n_orders, CAST(coalesce(sum(l.n), 0) AS BIGINT) AS n_lines, min(o_orderkey) AS first_order
FROM customer LEFT JOIN o ON c_custkey = o_custkey LEFT JOIN l ON l_orderkey = o_orderkey GROUP BY 1, 2""")
def nested_orders_document(spark, sf_dir):
    d = customer_documents(spark, sf_dir)
    lines = F.aggregate("orders", F.lit(0).cast("long"), lambda acc, o: acc + F.size(o["lines"]))
    return d.select("c_custkey", "c_name", F.size("orders").cast("long").alias("n_orders"), lines.alias("n_lines"), F.get("orders", F.lit(0))["o_orderkey"].alias("first_order"))


@query("unlinked_children", f"SELECT o_orderkey, o_custkey FROM ({_ORPHANED}) WHERE o_custkey IS NULL OR o_custkey NOT IN (SELECT c_custkey FROM customer)")
def unlinked_children(spark, sf_dir):
    return nest.unlinked(_orphaned_orders(spark, sf_dir), table(spark, sf_dir, "customer"), "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query("nest_reconciliation", "SELECT CAST(0 AS BIGINT) AS lost")
def nest_reconciliation(spark, sf_dir):
    """Nested and unlinked children make all children: nothing is lost."""
    nested = customer_documents(spark, sf_dir).agg(F.sum(F.size("orders")).alias("n"))
    rest = unlinked_children(spark, sf_dir).agg(F.count("*").alias("n"))
    total = table(spark, sf_dir, "orders").agg(F.count("*").alias("total"))
    return nested.unionByName(rest).agg(F.sum("n").alias("n")).join(total).select((F.col("total") - F.col("n")).alias("lost"))


def _bids(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    ref, doc = F.concat(F.lit("R"), F.col("l_orderkey") % 50), F.concat(F.lit("D"), F.col("l_partkey") % 40)
    return line.select("l_orderkey", "l_linenumber", "l_partkey", F.when(F.col("l_linenumber") != 3, ref).alias("reference"), F.when(F.col("l_linenumber") == 1, doc).alias("document_number"))


_BIDS = "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_linenumber <> 3 THEN concat('R', l_orderkey % 50) END AS reference, CASE WHEN l_linenumber = 1 THEN concat('D', l_partkey % 40) END AS document_number FROM lineitem"
_LINKS = "SELECT concat('R', n) AS reference, concat('L', n) AS document_number FROM range(0, 70) t(n)"


def _links(spark):
    return spark.range(70).select(F.concat(F.lit("R"), "id").alias("reference"), F.concat(F.lit("L"), "id").alias("document_number"))


_BRIDGE = f"SELECT reference, coalesce(own, document_number) AS document_number FROM (SELECT reference, max(document_number) AS own FROM ({_BIDS}) WHERE reference IS NOT NULL AND document_number IS NOT NULL GROUP BY 1) FULL JOIN ({_LINKS}) USING (reference)"


@query("bridge_priority", _BRIDGE)
def bridge_priority(spark, sf_dir):
    return nest.bridge_of(_bids(spark, sf_dir), _links(spark))


@query("bid_routing", f"""
WITH bridge AS ({_BRIDGE}), b AS (SELECT b.*, coalesce(b.document_number, g.document_number) AS bridged FROM ({_BIDS}) b LEFT JOIN bridge g ON b.reference = g.reference),
p AS (SELECT CASE WHEN bridged IN (SELECT concat('D', n) FROM range(0, 20) t(n)) THEN 'solicitation' WHEN reference IN (SELECT concat('R', n) FROM range(0, 30) t(n)) THEN 'council_item' ELSE 'unlinked' END AS placed FROM b)
SELECT placed, count(*) AS bids FROM p GROUP BY 1""")
def bid_routing(spark, sf_dir):
    bids = _bids(spark, sf_dir)
    spine = spark.range(20).select(F.concat(F.lit("D"), "id").alias("document_number"))
    items = spark.range(30).select(F.concat(F.lit("R"), "id").alias("reference"))
    return nest.route(bids, nest.bridge_of(bids, _links(spark)), items, spine).groupBy("placed").agg(F.count("*").alias("bids"))


@query("buyer_children", """
SELECT n_nationkey AS buyer_id, n_name AS slug, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) AS customers, (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS suppliers FROM nation""")
def buyer_children(spark, sf_dir):
    """A parent with several child tables: grouped left joins, not a query a parent."""
    buyers = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("buyer_id"), F.col("n_name").alias("slug"))
    full = nest.nest(buyers, table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey"), "buyer_id", "c_nationkey", "customers", ["c_custkey"])
    full = nest.nest(full, table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey"), "buyer_id", "s_nationkey", "suppliers", ["s_suppkey"])
    return full.select("buyer_id", "slug", F.size("customers").cast("long").alias("customers"), F.size("suppliers").cast("long").alias("suppliers"))


def _dimension(spark, sf_dir):
    s = scalars.raw_suppliers(spark, sf_dir).filter("origin = 'supplier'")
    c = scalars.raw_suppliers(spark, sf_dir).filter("origin = 'customer'")
    return dimension.build(dimension.names_of({"supplier": (s, "k", "raw"), "customer": (c, "k", "raw")}))


@query("supplier_dimension", scalars.keyed_sql("SELECT supplier_key, min(raw) AS display_name, count(DISTINCT raw) AS n_variants, array_to_string(list_sort(list(DISTINCT raw)), '|') AS variants FROM keyed WHERE supplier_key <> '' GROUP BY 1"))
def supplier_dimension(spark, sf_dir):
    return _dimension(spark, sf_dir).select("supplier_key", "display_name", F.size("variants").cast("long").alias("n_variants"), F.array_join("variants", "|").alias("variants"))


@query("supplier_fk_backfill", scalars.keyed_sql("SELECT origin, k, nullif(supplier_key, '') AS supplier_key FROM keyed"))
def supplier_fk_backfill(spark, sf_dir):
    rows, d = scalars.raw_suppliers(spark, sf_dir), _dimension(spark, sf_dir)
    filled = dimension.backfill(rows.withColumn("supplier_id", F.lit(-1)), "raw", d)
    return filled.join(d.select("supplier_id", "supplier_key"), "supplier_id", "left").select("origin", "k", "supplier_key")


@query("supplier_orphans", "SELECT CAST(0 AS BIGINT) AS orphans")
def supplier_orphans(spark, sf_dir):
    """Dimension rows that no source names: none after a rebuild."""
    rows, d = scalars.raw_suppliers(spark, sf_dir), _dimension(spark, sf_dir)
    named = dimension.keyed(rows).select("supplier_key").distinct()
    return d.join(named, "supplier_key", "left_anti").agg(F.count("*").alias("orphans"))


def _matches(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.concat(F.lit("The "), F.lit("firm"), (F.col("o_orderkey") % 5).cast("string"), F.lit(" Paving Ltd")).alias("winner"))
    awards = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("doc"), (F.round(F.col("o_totalprice") / 500) * 500).alias("value"), F.concat(F.lit("firm"), (F.col("o_orderkey") % 5).cast("string"), F.lit(" Works Inc.")).alias("firm"))
    value = F.round(F.col("o_totalprice") / 500) * 500
    return match.value_token_matches(items, "o_orderkey", value, suppliers.supplier_tokens(F.col("winner")), awards, "doc", F.col("value"), suppliers.supplier_tokens(F.col("firm")))


_MATCHES = """
WITH items AS (SELECT o_orderkey, round(o_totalprice / 500) * 500 AS v, o_orderkey % 5 AS firm FROM orders),
awards AS (SELECT o_orderkey AS doc, round(o_totalprice / 500) * 500 AS v, o_orderkey % 5 AS firm FROM orders),
m AS (SELECT i.o_orderkey, min(doc) AS document, max(doc) AS last_document FROM items i JOIN awards a ON i.v = a.v AND i.firm = a.firm GROUP BY 1)
"""


@query("match_value_token_unique", _MATCHES + "SELECT o_orderkey, document FROM m WHERE document = last_document")
def match_value_token_unique(spark, sf_dir):
    return match.unique_matches(_matches(spark, sf_dir))


@query("match_value_ambiguous_refused", _MATCHES + "SELECT o_orderkey, document AS first_document, last_document FROM m WHERE document < last_document")
def match_value_ambiguous_refused(spark, sf_dir):
    return match.ambiguous_matches(_matches(spark, sf_dir))


@query("half_even_join_key", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CASE WHEN (l_quantity / 2) - floor(l_quantity / 2) = 0.5 THEN 2 * round(floor(l_quantity / 2) / 2 + 0.25) ELSE round(l_quantity / 2) END AS BIGINT) AS k FROM lineitem")
def half_even_join_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.bround(F.col("l_quantity") / 2).cast("long").alias("k"))


def _award_items(spark, sf_dir):
    """Orders as items without a document number, and as awards of their customer's document."""
    o = table(spark, sf_dir, "orders")
    k, value = F.col("o_orderkey"), F.round(F.col("o_totalprice") / 500) * 500
    firm = F.concat(F.lit("firm"), (k % 5).cast("string"))
    items = o.select(F.concat(F.lit("2017.BA1."), (k % 997).cast("string")).alias("reference"), F.concat(F.lit("Works "), F.lpad(k.cast("string"), 12, "0")).alias("title"), F.concat(F.lit("The "), firm, F.lit(" Paving Ltd")).alias("winner_raw"), value.alias("award_value"))
    awards = o.select(_customer_document("o_custkey").alias("document_number"), F.concat(firm, F.lit(" Roads Inc.")).alias("supplier_name_raw"), value.alias("award_amount_numeric"))
    return items.withColumn("place", match.chronological(F.col("reference"))), awards


def _customer_document(column: str):
    return (F.col(column) + F.lit(2243000000).cast("long")).cast("string")


_ITEMS = """
WITH items AS (SELECT o_orderkey AS k, round(o_totalprice / 500) * 500 AS v, o_orderkey % 5 AS firm FROM orders),
awards AS (SELECT DISTINCT o_custkey AS c, round(o_totalprice / 500) * 500 AS v, o_orderkey % 5 AS firm FROM orders),
"""


@query("solicitation_links", _ITEMS + """m AS (SELECT k, min(c) AS c, max(c) AS z FROM items JOIN awards USING (v, firm) GROUP BY 1)
SELECT concat('2017.BA1.', k % 997) AS reference, CAST(2243000000 + max(c) AS VARCHAR) AS document_number, 'council_match' AS method FROM m WHERE c = z GROUP BY k % 997""")
def solicitation_links(spark, sf_dir):
    """References to the one document that their value and winner fit."""
    return match.item_links(*_award_items(spark, sf_dir), "council_match")


@query("title_passes", _ITEMS + """spine AS (SELECT c_custkey AS c, CASE WHEN c_custkey % 4 <> 0 THEN c_name END AS title, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'council' ELSE 'feed' END AS title_source FROM customer),
m AS (SELECT k, min(c) AS c, max(c) AS z FROM items JOIN awards USING (v, firm) WHERE c IN (SELECT c FROM spine WHERE title IS NULL) GROUP BY 1),
named AS (SELECT c, arg_min(k, (k % 997) * 1000000000000 + k) AS k FROM m WHERE c = z GROUP BY 1),
archived AS (SELECT page_id + 1 AS c, concat('Page ', page_id) AS page FROM pages WHERE page_id % 2 = 0)
SELECT CAST(2243000000 + c AS VARCHAR) AS document_number,
  CASE WHEN title IS NULL AND k IS NOT NULL THEN concat('Works ', lpad(CAST(k AS VARCHAR), 12, '0')) WHEN page IS NOT NULL AND (title IS NULL OR title_source = 'council') THEN page ELSE title END AS title,
  CASE WHEN title IS NULL AND k IS NOT NULL THEN 'council_match' WHEN page IS NOT NULL AND (title IS NULL OR title_source = 'council') THEN 'legacy_page' ELSE title_source END AS title_source
FROM spine LEFT JOIN named USING (c) LEFT JOIN archived USING (c)""")
def title_passes(spark, sf_dir):
    """Titles by matched awards, then by a posting's own page, over those of items but not of the feed."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    spine = c.select(_customer_document("c_custkey").alias("document_number"), F.when(k % 4 != 0, F.col("c_name")).alias("title"), F.when(k % 4 == 1, "council").when(k % 4 != 0, "feed").alias("title_source"))
    items, awards = _award_items(spark, sf_dir)
    named = match.name_rows(spine, match.matched_titles(items, awards, spine), "council_match")
    p = table(spark, sf_dir, "pages")
    folder = F.concat(F.lit("Doc-"), (F.col("page_id") + F.lit(2243000001).cast("long")).cast("string"))
    pages = p.select(folder.alias("folder"), F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("Page "), F.col("page_id").cast("string"))).alias("title"), "page_id")
    return match.name_rows(named, match.folder_titles(pages, "page_id"), "legacy_page", ("council",))


def _title_spine(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    return p.select("p_partkey", F.when(k % 4 != 0, F.col("p_name")).alias("title"), F.when(k % 4 == 1, "feed").when(k % 4 == 2, "council").when(k % 4 == 3, "council_match").alias("title_source"))


@query("title_fill_precedence", """
WITH s AS (SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS title, CASE p_partkey % 4 WHEN 1 THEN 'feed' WHEN 2 THEN 'council' WHEN 3 THEN 'council_match' END AS title_source FROM part),
c AS (SELECT l_partkey AS p_partkey, concat('t', l_orderkey, '-', l_linenumber) AS title, CASE WHEN l_linenumber % 2 = 0 THEN 'legacy_page' ELSE 'council' END AS title_source, CASE WHEN l_linenumber % 2 = 0 THEN 2 ELSE 3 END AS r, l_orderkey * 10 + l_linenumber AS place FROM lineitem),
b AS (SELECT p_partkey, arg_min(title, CAST(r AS BIGINT) * 1000000000000 + place) AS t, arg_min(title_source, CAST(r AS BIGINT) * 1000000000000 + place) AS ts, min(r) AS r FROM c GROUP BY 1),
j AS (SELECT s.*, t, ts, r, CASE WHEN title IS NULL THEN 100 ELSE CASE title_source WHEN 'feed' THEN 1 WHEN 'legacy_page' THEN 2 WHEN 'council' THEN 3 ELSE 4 END END AS mine FROM s LEFT JOIN b USING (p_partkey))
SELECT p_partkey, CASE WHEN r < mine THEN t ELSE title END AS title, CASE WHEN r < mine THEN ts ELSE title_source END AS title_source FROM j""")
def title_fill_precedence(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    found = line.select(F.col("l_partkey").alias("p_partkey"), F.concat(F.lit("t"), "l_orderkey", F.lit("-"), "l_linenumber").alias("title"), F.when(F.col("l_linenumber") % 2 == 0, "legacy_page").otherwise("council").alias("title_source"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("place"))
    return match.fill_titles(_title_spine(spark, sf_dir), found, "p_partkey")


@query("titles_from_items", """
WITH items AS (SELECT concat('Award ', 2243000000 + p_partkey, ' and ', 2243000000 + p_partkey + 1, ' for ', p_name) AS title, p_partkey AS place FROM part),
n AS (SELECT unnest(regexp_extract_all(title, '\\d{10}')) AS document_number, title, place FROM items)
SELECT document_number, arg_min(title, place) AS title FROM n WHERE CAST(document_number AS BIGINT) % 2 = 0 AND CAST(document_number AS BIGINT) - 2243000000 IN (SELECT p_partkey FROM part) GROUP BY 1""")
def titles_from_items(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    number = (F.col("p_partkey") + F.lit(2243000000).cast("long")).cast("string")
    nxt = (F.col("p_partkey") + F.lit(2243000001).cast("long")).cast("string")
    items = p.select(F.concat(F.lit("Award "), number, F.lit(" and "), nxt, F.lit(" for "), "p_name").alias("title"), F.col("p_partkey").alias("place"))
    spine = p.select(number.alias("document_number"), F.when(F.col("p_partkey") % 2 == 1, F.col("p_name")).alias("title"))
    return match.fill_from_titles(items, spine, "place")


@query("rfx_link_bridge", """
WITH spine AS (SELECT page_id, concat('https://x/RfxEvent/preview/', page_id % 40, '?a=1') AS link, concat('D', page_id) AS document_number FROM pages WHERE page_id % 3 = 0),
ids AS (SELECT nullif(regexp_extract(link, '/RfxEvent/preview/(\\d+)', 1), '') AS rfx, document_number, page_id FROM spine),
f AS (SELECT rfx, arg_min(document_number, page_id) AS d FROM ids GROUP BY 1),
p AS (SELECT CAST(page_id AS VARCHAR) AS rfx_id, CASE WHEN page_id % 5 = 0 THEN 'own' END AS document_number FROM pages)
SELECT rfx_id, coalesce(document_number, d) AS document_number, document_number IS NULL AND d IS NOT NULL AS bridged FROM p LEFT JOIN f ON rfx_id = rfx""")
def rfx_link_bridge(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    spine = pages.filter("page_id % 3 = 0").select("page_id", F.concat(F.lit("https://x/RfxEvent/preview/"), (F.col("page_id") % 40).cast("string"), F.lit("?a=1")).alias("link"), F.concat(F.lit("D"), "page_id").alias("document_number"))
    postings = pages.select(F.col("page_id").cast("string").alias("rfx_id"), F.when(F.col("page_id") % 5 == 0, "own").alias("document_number"))
    return match.fill_postings(postings, spine, keys.rfx_id(F.col("link")), "page_id")


@query("label_broadcast", """
WITH l AS (SELECT * FROM (VALUES ('1-URGENT', 'amount', 100.0::DOUBLE), ('2-HIGH', 'not_an_award', NULL), ('5-LOW', 'unknown', NULL)) t(raw, verdict, value))
SELECT o_orderkey, verdict, value AS labelled FROM orders LEFT JOIN l ON raw = o_orderpriority""")
def label_broadcast(spark, sf_dir):
    labels = spark.createDataFrame([("1-URGENT", "amount", 100.0), ("2-HIGH", "not_an_award", None), ("5-LOW", "unknown", None)], "raw string, verdict string, labelled double")
    return table(spark, sf_dir, "orders").join(labels, F.col("o_orderpriority") == F.col("raw"), "left").select("o_orderkey", "verdict", "labelled")


@query("pending_work_anti_join", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def pending_work_anti_join(spark, sf_dir):
    have = table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return table(spark, sf_dir, "orders").select("o_orderkey").join(have, "o_orderkey", "left_anti")


@query("semi_spine_without_bids", "SELECT o_orderkey FROM orders o WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = 5)")
def semi_spine_without_bids(spark, sf_dir):
    spine = table(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    bids = table(spark, sf_dir, "lineitem").filter("l_linenumber = 5").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, sf_dir, "orders").join(spine, "o_custkey", "left_semi").join(bids, "o_orderkey", "left_anti").select("o_orderkey")


@query("url_case_join", "SELECT a.page_id, b.page_id AS held FROM pages a JOIN (SELECT page_id, CASE WHEN page_id % 2 = 0 THEN upper(url) ELSE url END AS u FROM pages WHERE page_id % 3 = 0) b ON lower(a.url) = lower(b.u)")
def url_case_join(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    held = pages.filter("page_id % 3 = 0").select(F.col("page_id").alias("held"), F.lower(F.when(F.col("page_id") % 2 == 0, F.upper("url")).otherwise(F.col("url"))).alias("u"))
    return pages.join(held, F.lower("url") == F.col("u")).select("page_id", "held")


@query("case_insensitive_corpus", "SELECT page_id FROM pages WHERE url ILIKE '%EXAMPLE.ORG/EN/%'")
def case_insensitive_corpus(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(F.col("url").ilike("%EXAMPLE.ORG/EN/%")).select("page_id")

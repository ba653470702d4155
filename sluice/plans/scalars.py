"""Scalar functions over strings derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import amounts, keys, listing, suppliers, text, titles
from ..session import table
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles

#: The ways an amount is published, by order key, in both dialects.
AMOUNT_VARIANTS = """
CASE o_orderkey % 12
  WHEN 0 THEN concat('$', {cents})
  WHEN 1 THEN concat({cents}, ' CAD')
  WHEN 2 THEN concat('$ 1,', lpad(CAST(o_orderkey % 1000 AS VARCHAR(20)), 3, '0'), '.50')
  WHEN 3 THEN concat({cents}, ' USD')
  WHEN 4 THEN '1,23'
  WHEN 5 THEN concat(CAST(o_orderkey AS VARCHAR(20)), '.')
  WHEN 6 THEN 'kj'
  WHEN 7 THEN NULL
  WHEN 8 THEN concat('  ', CAST(o_orderkey AS VARCHAR(20)), ' cad ')
  WHEN 9 THEN '$45.10 per hour'
  WHEN 10 THEN '0'
  ELSE {cents} END
"""
_CENTS = "concat(CAST(o_orderkey AS VARCHAR(20)), '.', lpad(CAST(o_orderkey % 100 AS VARCHAR(20)), 2, '0'))"


def raw_amounts(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", F.expr(AMOUNT_VARIANTS.format(cents=_CENTS)).alias("raw"))


RAW_AMOUNTS_SQL = f"SELECT o_orderkey, o_custkey, o_orderstatus, {AMOUNT_VARIANTS.format(cents=_CENTS)} AS raw FROM orders"
#: parse_amount in the oracle's dialect.
AMOUNT_SQL = r"""CASE WHEN regexp_full_match({c}, '\s*\$?\s*(\d{{1,3}}(,\d{{3}})+|\d+)(\.\d+)?\s*([Cc][Aa][Dd])?\s*')
  THEN CAST(regexp_replace({c}, '[^0-9.]', '', 'g') AS DOUBLE) END"""


@query("parse_amount_matrix", f"SELECT o_orderkey, raw, {AMOUNT_SQL.format(c='raw')} AS amount FROM ({RAW_AMOUNTS_SQL})")
def parse_amount_matrix(spark, sf_dir):
    return raw_amounts(spark, sf_dir).select("o_orderkey", "raw", amounts.parse_amount(F.col("raw")).alias("amount"))


_PRICES = """CASE o_orderkey % 5 WHEN 0 THEN raw || '*' WHEN 1 THEN raw || ' **' WHEN 2 THEN raw || '§†'
  WHEN 3 THEN 'Non-Compliant' ELSE raw END"""


@query("parse_bid_price_markers", f"WITH p AS (SELECT o_orderkey, {_PRICES} AS price FROM ({RAW_AMOUNTS_SQL})), s AS (SELECT *, regexp_replace(price, '[\\s*^+†‡§]+$', '') AS bare FROM p) SELECT o_orderkey, price, {AMOUNT_SQL.format(c='bare')} AS amount FROM s")
def parse_bid_price_markers(spark, sf_dir):
    prices = raw_amounts(spark, sf_dir).select("o_orderkey", F.expr(_PRICES).alias("price"))
    return prices.withColumn("amount", amounts.parse_bid_price(F.col("price")))


_TITLES = """CASE p_partkey % 6 WHEN 0 THEN concat('Doc-Ariba Doc No. ', 2243000000 + p_partkey, ' RFP NO. 91')
  WHEN 1 THEN concat('Doc', 2922000000 + p_partkey) WHEN 2 THEN concat('  Supply of ', p_name, '   units ')
  WHEN 3 THEN '' WHEN 4 THEN p_name ELSE concat('Tender Call No. ', p_partkey, '-2011') END"""
_PLACEHOLDER_SQL = r"""NOT regexp_matches(regexp_replace(regexp_replace(coalesce({c}, ''), '[\d\W_]+', ' ', 'g'),
  '(?i)\b(doc|docs|summary|notice|ariba|no|nbr|number|tender|tenders|rfq|rfp|nrfp|rfi|rfsq|noip|call)\b', ' ', 'g'), '\S{{2,}}')"""


def raw_titles(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.expr(_TITLES).alias("title"))


@query("placeholder_titles", f"WITH t AS (SELECT p_partkey, {_TITLES} AS title FROM part), f AS (SELECT *, {_PLACEHOLDER_SQL.format(c='title')} AS placeholder FROM t) SELECT p_partkey, placeholder, CASE WHEN NOT placeholder THEN trim(regexp_replace(title, '\\s+', ' ', 'g')) END AS clean_title FROM f")
def placeholder_titles(spark, sf_dir):
    t = raw_titles(spark, sf_dir)
    return t.select("p_partkey", titles.is_placeholder_title(F.col("title")).alias("placeholder"), titles.clean_title(F.col("title")).alias("clean_title"))


@query("title_provenance_counts", f"WITH t AS (SELECT p_partkey, p_brand, {_TITLES} AS title FROM part), f AS (SELECT p_brand, {_PLACEHOLDER_SQL.format(c='title')} AS placeholder FROM t) SELECT p_brand AS title_source, CAST(count(*) FILTER (WHERE NOT placeholder) AS BIGINT) AS titled, count(*) AS total FROM f GROUP BY 1")
def title_provenance_counts(spark, sf_dir):
    t = raw_titles(spark, sf_dir)
    return t.groupBy(F.col("p_brand").alias("title_source")).agg(F.count_if(~titles.is_placeholder_title(F.col("title"))).alias("titled"), F.count("*").alias("total"))


_DOCUMENTS = """CASE o_orderkey % 7 WHEN 0 THEN concat('Doc', 2243000000 + o_orderkey) WHEN 1 THEN '1111111111' WHEN 2 THEN concat('37-', 22430000 + o_orderkey)
  WHEN 3 THEN 'xxxxxxxx' WHEN 4 THEN '3.77E+1100' WHEN 5 THEN NULL ELSE concat(' ', 5672000000 + o_orderkey, ' ') END"""
_DOCUMENT_SQL = "CASE WHEN length(regexp_replace({c}, '[^0-9]', '', 'g')) = 10 AND regexp_replace({c}, '[^0-9]', '', 'g') NOT IN ('1111111111', '0000000000', '1234567890') THEN regexp_replace({c}, '[^0-9]', '', 'g') END"


@query("document_number_normalize", f"SELECT o_orderkey, {_DOCUMENT_SQL.format(c='raw')} AS document_number FROM (SELECT o_orderkey, {_DOCUMENTS} AS raw FROM orders)")
def document_number_normalize(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_DOCUMENTS).alias("raw"))
    return o.select("o_orderkey", keys.document_number(F.col("raw")).alias("document_number"))


_BRIDGE_TITLES = "CASE o_orderkey % 3 WHEN 0 THEN concat('RFQ Doc', 1000000000 + o_orderkey, ' paving') WHEN 1 THEN concat('Doc', 10000000000 + o_orderkey) ELSE 'no number' END"


@query("document_number_bridge", f"""
WITH r AS (SELECT o_orderkey, {_DOCUMENTS} AS ext, {_BRIDGE_TITLES} AS title FROM orders),
x AS (SELECT *, nullif(regexp_extract(title, 'Doc(\\d{{10}})([^0-9]|$)', 1), '') AS named FROM r)
SELECT o_orderkey, coalesce({_DOCUMENT_SQL.format(c='ext')}, {_DOCUMENT_SQL.format(c='named')}) AS document_number FROM x""")
def document_number_bridge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_DOCUMENTS).alias("ext"), F.expr(_BRIDGE_TITLES).alias("title"))
    return o.select("o_orderkey", keys.bridged_document_number(F.col("ext"), F.col("title")).alias("document_number"))


_CALLS = """CASE p_partkey % 6 WHEN 0 THEN concat('Request for Quotation No. 3905-10-', lpad(CAST(p_partkey % 10000 AS VARCHAR(9)), 4, '0'))
  WHEN 1 THEN concat('Tender Call No. ', p_partkey % 4000 + 1, ' -2011, Contract No. 10TE-17WS') WHEN 2 THEN concat('RFQ 9130–10–', lpad(CAST(p_partkey % 10000 AS VARCHAR(9)), 4, '0'))
  WHEN 3 THEN 'RFP of 1850-12' WHEN 4 THEN NULL ELSE concat('Call ', p_partkey % 4000 + 1, '−1998') END"""


@query("call_number_normalize", f"SELECT p_partkey, nullif(regexp_extract(regexp_replace(regexp_replace(raw, '[‐-―−]', '-', 'g'), '[ \\t]*-[ \\t]*', '-', 'g'), '\\b(\\d{{4}}-\\d{{2}}-\\d{{4}}|\\d{{1,4}}-(?:19|20)\\d{{2}})\\b', 1), '') AS call_number FROM (SELECT p_partkey, {_CALLS} AS raw FROM part)")
def call_number_normalize(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr(_CALLS).alias("raw"))
    return p.select("p_partkey", keys.call_number(F.col("raw")).alias("call_number"))


_SUPPLIERS = """CASE k % 11 WHEN 0 THEN concat(n, ' Ltd.') WHEN 1 THEN concat(n, ' LTD') WHEN 2 THEN concat(1800000 + k, ' Ontario Inc. o/a ', n)
  WHEN 3 THEN concat(n, ' Paving Limited o/a Best Roads') WHEN 4 THEN concat(n, '* Non-compliant with 3.2') WHEN 5 THEN 'Please see note below'
  WHEN 6 THEN concat(1900000 + k, ' o/a ', n) WHEN 7 THEN concat(n, ' (Submitted by: a clerk)') WHEN 8 THEN concat(n, ' Appendix "A" - Price Form')
  WHEN 9 THEN concat('Ontario Ltd. d.b.a. ', n) ELSE n END"""
_NAMES = "SELECT 'supplier' AS origin, s_suppkey AS k, s_name AS n FROM supplier UNION ALL SELECT 'customer', c_custkey, c_name FROM customer"
#: supplier_key in the oracle's dialect, staged as the rules are.
SUPPLIER_KEY_SQL = r"""
WITH a AS (SELECT *, regexp_replace(regexp_replace(raw, '\*?\s*non-?compliant.*$', ' ', 'i'), '\(?\s*appendix\s*["“‘'']?\s*[a-z]?\d*\s*["”’'']?\s*[–-]?\s*(?:price\s*form)?\s*\)?', ' ', 'gi') AS t0 FROM raws),
b AS (SELECT *, regexp_replace(regexp_replace(t0, '\s+', ' ', 'g'), '^[ *"]+|[ *"]+$', '', 'g') AS t FROM a),
c AS (SELECT *, regexp_extract(t, '(?i)\b(\d{6,7})\s+(?:ontario|ont|canada|quebec|qc)\b', 1) AS num,
  regexp_matches(t, '(?i)\s*(?:,\s*)?(?:\bo/?a\b|\b0/a\b|\boperating as\b|\bc\.?o\.?b\.?(?:\s*as)?\b|\bd\.?b\.?a\.?\b|\btrading as\b|\bt/a\b)\b.*$') AS marked,
  regexp_replace(t, '(?i)\s*(?:,\s*)?(?:\bo/?a\b|\b0/a\b|\boperating as\b|\bc\.?o\.?b\.?(?:\s*as)?\b|\bd\.?b\.?a\.?\b|\btrading as\b|\bt/a\b)\b.*$', '') AS bare FROM b),
d AS (SELECT *, trim(regexp_replace(regexp_replace(lower(regexp_replace(bare, '(?i)\(\s*submitted by:.*?\)', ' ', 'g')), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS base,
  trim(regexp_replace(regexp_replace(lower(regexp_replace(t, '(?i)\(\s*submitted by:.*?\)', ' ', 'g')), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS plain FROM c),
keyed AS (SELECT *, CASE WHEN coalesce(t, '') = '' OR regexp_matches(t, '(?i)^(please see|see prequalif|see the|refer to|as per|various\b|bid prices|\d+\s*/?\s*bidder was found|the scope of work|\d+\s+bidder\b|part [a-z]:|corrected for mathematical|award amounts have been)') THEN ''
  WHEN num <> '' THEN '#' || num
  WHEN marked AND regexp_matches(base, '^\d{6,7}\b') THEN '#' || regexp_extract(base, '^(\d{6,7})\b', 1)
  WHEN marked AND base <> '' AND base NOT IN ('ontario ltd','ontario limited','ontario inc','ontario incorporated','ontario','inc','ltd','limited','incorporated','canada inc','canada ltd','canada')
    AND len(list_filter(string_split(base, ' '), lambda x: x NOT IN ('inc','ltd','limited','incorporated','corp','corporation','co','company','canada','ontario','ont','llp','lp','the','and'))) > 0 THEN base
  ELSE plain END AS supplier_key FROM d)
"""


def raw_suppliers(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("origin"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("n"))
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("origin"), F.col("c_custkey").alias("k"), F.col("c_name").alias("n"))
    return s.unionByName(c).select("origin", "k", F.expr(_SUPPLIERS).alias("raw"))


RAW_SUPPLIERS_SQL = f"SELECT origin, k, {_SUPPLIERS} AS raw FROM ({_NAMES})"


def keyed_sql(select: str) -> str:
    return SUPPLIER_KEY_SQL.replace("WITH a AS", f"WITH raws AS ({RAW_SUPPLIERS_SQL}), a AS", 1) + select


@query("supplier_key_variants", keyed_sql("SELECT origin, k, raw, supplier_key FROM keyed"))
def supplier_key_variants(spark, sf_dir):
    return raw_suppliers(spark, sf_dir).withColumn("supplier_key", suppliers.supplier_key(F.col("raw")))


@query("supplier_token_sets", r"""
WITH r AS (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN concat('The ', s_name, ' Group Ltd') WHEN 1 THEN concat(s_name, ' & Sons Inc.') ELSE concat(s_name, ' Canada Corp. Paving') END AS raw FROM supplier),
t AS (SELECT s_suppkey, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(raw), '&', ' and '), '^the\s+', ''), '\b(limited|ltd|incorporated|inc|corporation|corp|company|co|lp|llp|ulc|holdings|group|canada|ontario)\b', ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), '\s+', ' ', 'g')) AS k FROM r)
SELECT s_suppkey, array_to_string(list_sort(list_distinct(list_filter(string_split(k, ' '), lambda x: length(x) > 2))), '|') AS tokens FROM t""")
def supplier_token_sets(spark, sf_dir):
    raw = F.expr("CASE s_suppkey % 3 WHEN 0 THEN concat('The ', s_name, ' Group Ltd') WHEN 1 THEN concat(s_name, ' & Sons Inc.') ELSE concat(s_name, ' Canada Corp. Paving') END")
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.array_join(F.array_sort(suppliers.supplier_tokens(raw)), "|").alias("tokens"))


_HEADERS = """CASE n_nationkey % 5 WHEN 0 THEN 'Bid Price (Incl. HST)' WHEN 1 THEN 'Bid Price excluding all applicable taxes' WHEN 2 THEN 'Price'
  WHEN 3 THEN 'Including H.S.T. (not excluding HST)' ELSE NULL END"""


@query("hst_basis", f"SELECT n_nationkey, CASE WHEN regexp_matches(h, '(?i)\\bincl\\w*\\.?\\s*(all applicable taxes|h\\.?s\\.?t)') THEN 'including' WHEN regexp_matches(h, '(?i)\\bexcl\\w*\\.?\\s*(all applicable taxes|h\\.?s\\.?t)') THEN 'excluding' END AS basis FROM (SELECT n_nationkey, {_HEADERS} AS h FROM nation)")
def hst_basis(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(_HEADERS).alias("h"))
    return n.select("n_nationkey", amounts.hst_basis(F.col("h")).alias("basis"))


_BIDDERS = "CASE n_nationkey % 4 WHEN 0 THEN concat('**', n_name, ' INC') WHEN 1 THEN concat(n_nationkey, '. ', n_name, ' Ltd.**') WHEN 2 THEN concat(' † 3) ', n_name, ' ‡') ELSE n_name END"


@query("clean_bidder_name", f"SELECT n_nationkey, regexp_replace(regexp_replace(regexp_replace(b, '^[\\s*^+†‡§]+|[\\s*^+†‡§]+$', '', 'g'), '^\\s*\\d+[.)]\\s+', ''), '^[\\s*^+†‡§]+|[\\s*^+†‡§]+$', '', 'g') AS bidder FROM (SELECT n_nationkey, {_BIDDERS} AS b FROM nation)")
def clean_bidder_name(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(_BIDDERS).alias("b"))
    return n.select("n_nationkey", amounts.clean_bidder(F.col("b")).alias("bidder"))


_PDFS = "CASE page_id % 3 WHEN 0 THEN concat(url, '/legdocs/bgrd/file-', page_id, '.pdf') WHEN 1 THEN concat(url, '/comm/x.PDF') ELSE concat(url, '/index.') END"


@query("pdf_kind", f"SELECT page_id, CASE WHEN contains(u, '/bgrd/') THEN 'bgrd' WHEN contains(u, '/comm/') THEN 'comm' ELSE 'other' END AS kind, string_split(u, '/')[-1] AS leaf, CASE WHEN contains(string_split(u, '/')[-1], '.') THEN lower(string_split(string_split(u, '/')[-1], '.')[-1]) END AS ext FROM (SELECT page_id, {_PDFS} AS u FROM pages)")
def pdf_kind(spark, sf_dir):
    u = table(spark, sf_dir, "pages").select("page_id", F.expr(_PDFS).alias("u"))
    return u.select("page_id", text.pdf_kind(F.col("u")).alias("kind"), text.basename(F.col("u")).alias("leaf"), text.extension(F.col("u")).alias("ext"))


@query("content_digests", "SELECT page_id, sha256(html) AS sha256, substr(sha256(url), 1, 12) AS stamp FROM pages")
def content_digests(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.sha2("html", 256).alias("sha256"), text.version_stamp(F.col("url")).alias("stamp"))


_FIELDS = "CASE n_nationkey % 5 WHEN 0 THEN concat('  ', n_name, ' ') WHEN 1 THEN 'None' WHEN 2 THEN '   ' WHEN 3 THEN NULL ELSE n_name END"


@query("clean_fields", f"""
WITH r AS (SELECT n_nationkey, {_FIELDS} AS raw FROM nation)
SELECT n_nationkey, CASE WHEN trim(raw) IN ('', 'None') THEN NULL ELSE trim(raw) END AS portal, nullif(trim(raw), '') AS feed,
  CASE WHEN n_nationkey % 2 = 0 THEN nullif(trim(raw), '') END AS listed, lower(trim(regexp_replace(raw, '\\s+', ' ', 'g'))) AS folded FROM r""")
def clean_fields(spark, sf_dir):
    raw = F.col("raw")
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.expr(_FIELDS).alias("raw"))
    listed = F.when(F.col("n_nationkey") % 2 == 0, F.array(raw, F.lit("second"))).otherwise(F.array().cast("array<string>"))
    return n.select("n_nationkey", text.clean_portal(raw).alias("portal"), text.clean_feed(raw).alias("feed"), text.clean_feed_list(listed).alias("listed"), text.fold(raw).alias("folded"))


@query("native_refs", "SELECT p_partkey, upper(coalesce(nullif(trim(CASE p_partkey % 3 WHEN 0 THEN concat(' rfp  ', p_partkey) WHEN 1 THEN '' END), '') , nullif(CASE WHEN p_partkey % 2 = 0 THEN concat('t-', p_partkey) ELSE ' ' END, ' '), p_brand)) AS native_ref FROM part".replace("concat(' rfp  ', p_partkey)", "concat('rfp ', p_partkey)"))
def native_refs(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", keys.native_ref(F.expr("CASE p_partkey % 3 WHEN 0 THEN concat(' rfp  ', p_partkey) WHEN 1 THEN '' END"), F.expr("CASE WHEN p_partkey % 2 = 0 THEN concat('t-', p_partkey) ELSE ' ' END"), F.col("p_brand")).alias("native_ref"))


_AWARD_TITLES = "CASE o_orderkey % 4 WHEN 0 THEN concat('Award of Ariba Document Number ', 3234000000 + o_orderkey, ' to X') WHEN 1 THEN concat('award of doc#', 3234000000 + o_orderkey) WHEN 2 THEN concat('Contract ', 3234000000 + o_orderkey) ELSE NULL END"


@query("award_document_numbers", f"SELECT o_orderkey, nullif(regexp_extract(t, '(?i)(?:Ariba\\s+)?Doc(?:ument)?(?:\\s*Number)?\\s*[:#]?\\s*(\\d{{10}})', 1), '') AS document_number FROM (SELECT o_orderkey, {_AWARD_TITLES} AS t FROM orders)")
def award_document_numbers(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_AWARD_TITLES).alias("t"))
    return o.select("o_orderkey", keys.award_document_number(F.col("t")).alias("document_number"))


@query("meeting_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN strftime(o_orderdate, '%Y-%m-%d') END AS meeting_date FROM orders")
def meeting_dates(spark, sf_dir):
    day = F.date_format("o_orderdate", "MMMM d, yyyy")
    page = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("<p>Meeting Date: Wednesday, "), day, F.lit("</p>"))).when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit("held on Friday, "), day)).otherwise("no date")
    return table(spark, sf_dir, "orders").select("o_orderkey", keys.meeting_date(page).cast("string").alias("meeting_date"))


_ROWS = "CASE p_partkey % 4 WHEN 0 THEN concat(p_partkey % 7, '.', p_partkey % 13, ' Drawings') WHEN 1 THEN concat(p_partkey % 7, '.', p_partkey % 13, '.', p_partkey % 3) WHEN 2 THEN 'References' ELSE concat('  Tree   ', p_brand) END"
_LABELS = "CASE p_partkey % 5 WHEN 0 THEN concat('Part ', p_partkey, '.pdf') WHEN 1 THEN 'https://x.example/a.pdf' WHEN 2 THEN 'Appendix E.zip (2 MB)' WHEN 3 THEN 'notes.pdfx' ELSE 'Download' END"


@query("listing_rows", f"""
WITH r AS (SELECT p_partkey, trim(regexp_replace({_ROWS}, '\\s+', ' ', 'g')) AS w, {_LABELS} AS name FROM part)
SELECT p_partkey, CASE WHEN regexp_matches(w, '^\\d+(\\.\\d+)*(\\s|$)') THEN regexp_extract(w, '^(\\d+(?:\\.\\d+)*)', 1) ELSE w END || '#' || (p_partkey % 2) || '#' || name AS key,
  NOT regexp_matches(lower(name), '^(https?://|www\\.)') AND regexp_matches(name, '(?i)\\.(pdf|zip)([^A-Za-z0-9]|$)') AS is_document,
  CASE WHEN p_partkey % 3 = 0 THEN 'menu-item' ELSE 'tree-link' END AS kind FROM r""")
def listing_rows(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.expr(_ROWS).alias("row"), F.expr(_LABELS).alias("name"))
    role = F.when(F.col("p_partkey") % 3 == 0, "MenuItem")
    return p.select("p_partkey", listing.anchor_key(F.col("row"), (F.col("p_partkey") % 2).cast("string"), F.col("name")).alias("key"), listing.is_document_name(F.col("name")).alias("is_document"), listing.anchor_kind(role, F.lit("PML"), F.lit(None).cast("string")).alias("kind"))


@query("outline_sort", f"""
WITH r AS (SELECT p_partkey, p_brand, trim(regexp_replace({_ROWS}, '\\s+', ' ', 'g')) AS w FROM part),
o AS (SELECT *, nullif(regexp_extract(w, '^(\\d+(?:\\.\\d+)*)(?:\\s|$)', 1), '') AS outline FROM r)
SELECT p_partkey, outline, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY outline IS NULL, coalesce(list_transform(string_split(outline, '.'), lambda x: CAST(x AS BIGINT)), []), CASE WHEN outline IS NULL THEN w ELSE '' END, p_partkey) AS INTEGER) AS place FROM o""")
def outline_sort(spark, sf_dir):
    from pyspark.sql.window import Window

    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.expr(_ROWS).alias("row"))
    # a brand is a listing here; places are within one
    place = F.row_number().over(Window.partitionBy("p_brand").orderBy(*listing.listing_order(F.col("row"), F.col("p_partkey"))))
    return p.select("p_partkey", listing.outline(F.col("row")).alias("outline"), place.alias("place"))


@query("display_formats", "SELECT o_orderkey, CASE WHEN s >= 3600 THEN printf('%d h %02d m', s // 3600, s % 3600 // 60) WHEN s >= 60 THEN printf('%d m %02d s', s // 60, s % 60) ELSE printf('%d s', s) END AS took, (CASE WHEN d < 0 THEN '-' ELSE '+' END) || format('{:,}', abs(d)) AS delta FROM (SELECT o_orderkey, CAST(o_orderkey * 37 % 9000 AS BIGINT) AS s, CAST(o_orderkey * 101 % 50000 - 25000 AS BIGINT) AS d FROM orders)")
def display_formats(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", text.elapsed(F.col("o_orderkey") * 37 % 9000).alias("took"), text.signed(F.col("o_orderkey") * 101 % 50000 - 25000).alias("delta"))


_FUZZY = "CASE c_custkey % 4 WHEN 0 THEN concat(c_name, ' Ltd.') WHEN 1 THEN replace(c_name, 'Customer', 'Custmer') WHEN 2 THEN 'Somebody Else' ELSE c_name END"


@query("fuzzy_scoring_names")
def fuzzy_scoring_names(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    key = suppliers.scoring_key(F.expr(_FUZZY))
    return c.select("c_custkey", suppliers.similar_name(key, F.array(suppliers.scoring_key(F.col("c_name")))).alias("matched"))

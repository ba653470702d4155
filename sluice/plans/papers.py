"""Documents, extraction, evaluation and pages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import documents as docs
from ..functions.keys import document_number
from ..operators import evaluate, ledger
from ..sources import html_tables, links, normalize
from ..session import table
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles


def _gated(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("key"), F.when(F.col("doc_id") % 17 != 0, F.col("text")).alias("text")).withColumn("sha256", F.sha2("text", 256))
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), (F.col("quality") == 1).alias("flag"))
    cache = d.filter("key % 5 = 0").select("sha256", F.lit("v1").alias("extractor_version"))
    return ledger.cache_gate(d, cache, labels, "v1")


@query("extraction_gate_stats", """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 17 <> 0 THEN text END AS text FROM documents),
c AS (SELECT DISTINCT sha256(text) AS s FROM d WHERE doc_id % 5 = 0 AND text IS NOT NULL),
g AS (SELECT CASE WHEN coalesce(text, '') = '' THEN 'no_text' WHEN coalesce(quality, 1) <> 1 THEN 'skipped' WHEN sha256(text) IN (SELECT s FROM c) THEN 'cached' ELSE 'to_do' END AS gate FROM d LEFT JOIN labels USING (doc_id))
SELECT gate, count(*) AS documents FROM g GROUP BY 1""")
def extraction_gate_stats(spark, sf_dir):
    return _gated(spark, sf_dir).groupBy("gate").agg(F.count("*").alias("documents"))


@query("extraction_work_limit", """
WITH d AS (SELECT doc_id, CASE WHEN doc_id % 17 <> 0 THEN text END AS text FROM documents),
c AS (SELECT DISTINCT sha256(text) AS s FROM d WHERE doc_id % 5 = 0 AND text IS NOT NULL)
SELECT doc_id AS key FROM d LEFT JOIN labels USING (doc_id) WHERE coalesce(text, '') <> '' AND coalesce(quality, 1) = 1 AND sha256(text) NOT IN (SELECT s FROM c) ORDER BY doc_id LIMIT 20""")
def extraction_work_limit(spark, sf_dir):
    """The limit counts what is to be extracted, after the gates."""
    return _gated(spark, sf_dir).filter("gate = 'to_do'").orderBy("key").limit(20).select("key")


@query("document_chunks", """
WITH d AS (SELECT doc_id, replace(text, chr(10), chr(10) || chr(10)) AS t FROM documents),
f AS (SELECT doc_id, t, list_reduce(list_transform(string_split(t, chr(10) || chr(10)), lambda s: {'n': 1, 'longest': 0, 'open': length(s)}),
  lambda a, x: CASE WHEN a.open + 2 + x.open <= 500 THEN {'n': a.n, 'longest': a.longest, 'open': a.open + 2 + x.open} ELSE {'n': a.n + 1, 'longest': greatest(a.longest, a.open), 'open': x.open} END) AS r FROM d)
SELECT doc_id, CASE WHEN length(t) <= 500 THEN 1 ELSE r.n END::INTEGER AS n_chunks, CASE WHEN length(t) <= 500 THEN length(t) ELSE greatest(r.longest, r.open) END::INTEGER AS longest FROM f""")
def document_chunks(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    chunks = d.select("doc_id", docs.split_document(F.col("text"), 500).alias("chunks"))
    return chunks.select("doc_id", F.size("chunks").alias("n_chunks"), F.array_max(F.transform("chunks", F.length)).alias("longest"))


@query("chunk_roundtrip", "SELECT CAST(0 AS BIGINT) AS lost")
def chunk_roundtrip(spark, sf_dir):
    """Chunks joined by a blank line are the text."""
    d = table(spark, sf_dir, "documents").select(F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("text"))
    return d.agg(F.count_if(F.array_join(docs.split_document(F.col("text"), 500), "\n\n") != F.col("text")).alias("lost"))


#: Replies as an extractor gives them, by conversation: fenced, plain, chatty, broken.
_BIDS = "concat('[', CASE WHEN turn % 3 > 0 THEN '{\"supplier_name\": \"A\", \"amount_raw\": \"$1\"}' ELSE '' END, CASE WHEN turn % 3 = 2 THEN ', {\"supplier_name\": \"B\"}' ELSE '' END, ']')"
_REPLY = f"concat('{{\"contracts\": [{{\"reference\": \"R', conv_id % 7, '\", \"declared_submissions\": ', turn % 4, ', \"bids\": ', {_BIDS}, ', \"awards\": []}}]}}')"
_CONTENT = f"CASE conv_id % 5 WHEN 0 THEN concat('```json', chr(10), {_REPLY}, chr(10), '```') WHEN 4 THEN 'no json at all' ELSE {_REPLY} END"
_TURNS = "conv_id, turn"


def _records(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.expr(_CONTENT).alias("content"))
    return c.withColumn("record", docs.parse_response(F.col("content")))


_PARSED = "SELECT conv_id, turn, 'R' || (conv_id % 7) AS reference, turn % 4 AS declared, CASE turn % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 2 END AS bids FROM conversations WHERE conv_id % 5 <> 4"


@query("contracts_explode", f"SELECT conv_id, turn, reference, CAST(declared AS INTEGER) AS declared, b.supplier_name FROM ({_PARSED}) p, (SELECT 1 AS n, 'A' AS supplier_name UNION ALL SELECT 2, 'B') b WHERE b.n <= p.bids")
def contracts_explode(spark, sf_dir):
    r = _records(spark, sf_dir).select("conv_id", "turn", F.explode("record.contracts").alias("c"))
    return r.select("conv_id", "turn", "c.reference", F.col("c.declared_submissions").alias("declared"), F.explode("c.bids").alias("b")).select("conv_id", "turn", "reference", "declared", "b.supplier_name")


@query("contracts_dedup", f"SELECT reference, arg_max(bids, ROW(bids, -conv_id, -turn)) AS bids, arg_max(conv_id, ROW(bids, -conv_id, -turn)) AS conv_id FROM ({_PARSED}) GROUP BY 1")
def contracts_dedup(spark, sf_dir):
    """Of a reference's contracts the one with most bids, the first of equals."""
    r = _records(spark, sf_dir).select("conv_id", "turn", F.explode("record.contracts").alias("c"))
    best = F.struct(F.size("c.bids").alias("n"), (-F.col("conv_id")).alias("c"), (-F.col("turn")).alias("t"))
    return r.groupBy(F.col("c.reference").alias("reference")).agg(F.max_by(F.size("c.bids"), best).alias("bids"), F.max_by("conv_id", best).alias("conv_id"))


@query("declared_count_flags", f"SELECT conv_id, turn, reference, CAST(declared AS INTEGER) AS declared, CAST(bids AS INTEGER) AS actual, CAST(bids - declared AS INTEGER) AS delta FROM ({_PARSED}) WHERE bids < declared")
def declared_count_flags(spark, sf_dir):
    r = _records(spark, sf_dir)
    return r.select("conv_id", "turn", F.explode(docs.declared_count_flags(F.col("record"))).alias("f")).select("conv_id", "turn", "f.*")


@query("response_errors", "SELECT CAST(count(*) FILTER (WHERE conv_id % 5 = 4) AS BIGINT) AS bad, count(*) AS replies FROM conversations")
def response_errors(spark, sf_dir):
    return _records(spark, sf_dir).agg(F.count_if(F.size(docs.extraction_errors(F.col("record"))) > 0).alias("bad"), F.count("*").alias("replies"))


@query("lenient_json", "SELECT conv_id, turn, conv_id % 5 <> 4 AS parsed FROM conversations")
def lenient_json(spark, sf_dir):
    r = _records(spark, sf_dir)
    chatty = F.concat(F.lit("Here you are: "), F.col("content"), F.lit(" Anything else?"))
    return r.select("conv_id", "turn", docs.parse_lenient(chatty).isNotNull().alias("parsed"))


_KINDS = """CASE doc_id % 6 WHEN 0 THEN concat('REPORT FOR ACTION', chr(10), 'Award of Tender 12 for Paving Works', chr(10), 'Date: May 1', chr(10), text)
  WHEN 1 THEN concat('MINUTES OF meeting', chr(10), repeat(text, 30)) WHEN 2 THEN concat('RE: Budget and audit ', doc_id) WHEN 3 THEN 'short' WHEN 4 THEN concat('Appendix 2: maps ', repeat('x y ', 500)) ELSE repeat('plain words only ', 200) END"""


@query("rule_classifier_distribution", "SELECT source, CASE doc_id % 6 WHEN 0 THEN CASE WHEN text IS NULL THEN 'empty_or_fragment' WHEN length(concat('REPORT FOR ACTION', chr(10), 'Award of Tender 12 for Paving Works', chr(10), 'Date: May 1', chr(10), text)) > 100000 THEN 'meeting_package' ELSE 'procurement_award' END WHEN 1 THEN CASE WHEN text IS NULL THEN 'empty_or_fragment' WHEN length(text) * 30 + 19 > 100000 THEN 'meeting_package' WHEN length(text) * 30 + 19 < 1500 THEN 'empty_or_fragment' ELSE 'minutes' END WHEN 2 THEN 'governance_finance' WHEN 3 THEN 'empty_or_fragment' WHEN 4 THEN 'attachment_or_map' ELSE 'UNCLASSIFIED' END AS class, count(*) AS documents FROM documents GROUP BY 1, 2")
def rule_classifier_distribution(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("source", docs.classify(F.expr(_KINDS))["class"].alias("class"))
    return d.groupBy("source", "class").agg(F.count("*").alias("documents"))


def _sides(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    truth = line.groupBy(F.col("l_orderkey").alias("doc")).agg(F.collect_set(F.concat(F.lit("n"), F.col("l_suppkey") % 20)).alias("names"))
    found = line.filter("l_linenumber <> 2").groupBy(F.col("l_orderkey").alias("doc")).agg(F.collect_set(F.concat(F.lit("n"), F.when(F.col("l_partkey") % 9 == 0, 99).otherwise(F.col("l_suppkey") % 20))).alias("names"))
    return found, truth


_SIDES = """
WITH t AS (SELECT DISTINCT l_orderkey AS doc, l_suppkey % 20 AS n FROM lineitem),
f AS (SELECT DISTINCT l_orderkey AS doc, CASE WHEN l_partkey % 9 = 0 THEN 99 ELSE l_suppkey % 20 END AS n FROM lineitem WHERE l_linenumber <> 2),
shared AS (SELECT DISTINCT doc FROM f),
s AS (SELECT coalesce(t.doc, f.doc) AS doc, CAST(count(*) FILTER (WHERE t.n IS NOT NULL AND f.n IS NOT NULL) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE f.n IS NULL) AS BIGINT) AS fn, CAST(count(*) FILTER (WHERE t.n IS NULL) AS BIGINT) AS fp
  FROM t FULL JOIN f ON t.doc = f.doc AND t.n = f.n WHERE coalesce(t.doc, f.doc) IN (SELECT doc FROM shared) GROUP BY 1)
"""


@query("validation_report", _SIDES + "SELECT count(*) AS documents, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(fp) AS BIGINT) AS fp, sum(tp) / CAST(sum(tp) + sum(fn) AS DOUBLE) AS recall, sum(tp) / CAST(sum(tp) + sum(fp) AS DOUBLE) AS precision FROM s")
def validation_report(spark, sf_dir):
    return evaluate.corpus_report(evaluate.name_scores(*_sides(spark, sf_dir), "doc"))


@query("empty_denominators", "SELECT * FROM (VALUES ('corpus', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)), ('ground_truth', 1.0::DOUBLE, 1.0::DOUBLE)) t(report, recall, precision)")
def empty_denominators(spark, sf_dir):
    found, truth = _sides(spark, sf_dir)
    none = evaluate.name_scores(found, truth, "doc").filter("false")
    rows = [evaluate.corpus_report(none, empty).select(F.lit(name).alias("report"), "recall", "precision") for name, empty in (("corpus", None), ("ground_truth", 1.0))]
    return rows[0].unionByName(rows[1])


@query("ground_truth_scores", _SIDES + "SELECT doc, tp, fn, fp, coalesce(tp / nullif(CAST(tp + fn AS DOUBLE), 0), 1.0) AS recall, coalesce(tp / nullif(CAST(tp + fp AS DOUBLE), 0), 1.0) AS precision FROM s")
def ground_truth_scores(spark, sf_dir):
    s = evaluate.name_scores(*_sides(spark, sf_dir), "doc")
    longs = [F.col(c).cast("long").alias(c) for c in ("tp", "fn", "fp")]
    return s.select("doc", *longs, *evaluate.rates(F.col("tp"), F.col("fn"), F.col("fp"), 1.0))


@query("ground_truth_status", "SELECT doc_id, CASE WHEN d.text IS NULL THEN 'no_document' WHEN l.doc_id % 3 = 0 THEN 'not_extracted' ELSE 'scored' END AS status FROM (SELECT doc_id FROM labels UNION ALL SELECT -1) l LEFT JOIN documents d USING (doc_id)")
def ground_truth_status(spark, sf_dir):
    truth = table(spark, sf_dir, "labels").select("doc_id").unionByName(spark.range(1).select((F.col("id") - 1).alias("doc_id")))
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    cached = d.filter("doc_id % 3 <> 0").select(F.col("doc_id").alias("_c"))
    j = truth.join(d, "doc_id", "left").join(cached, F.col("doc_id") == F.col("_c"), "left")
    return j.select("doc_id", F.when(F.col("sha256").isNull(), "no_document").when(F.col("_c").isNull(), "not_extracted").otherwise("scored").alias("status"))


@query("contract_bucket_scores", _SIDES + ", b AS (SELECT l_orderkey AS doc, CASE WHEN count(DISTINCT l_returnflag) <= 1 THEN 'single' ELSE 'multi' END AS bucket FROM lineitem GROUP BY 1) SELECT bucket, count(*) AS documents, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fn) AS BIGINT) AS fn, CAST(sum(fp) AS BIGINT) AS fp FROM s JOIN b USING (doc) GROUP BY 1")
def contract_bucket_scores(spark, sf_dir):
    s = evaluate.name_scores(*_sides(spark, sf_dir), "doc")
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("doc")).agg(F.when(F.count_distinct("l_returnflag") <= 1, "single").otherwise("multi").alias("bucket"))
    return s.join(b, "doc").groupBy("bucket").agg(F.count("*").alias("documents"), *(F.sum(c).alias(c) for c in ("tp", "fn", "fp")))


def _votes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("voter"))
    kind = F.concat(F.lit("k"), F.when(F.col("doc_id") % 4 == 0, F.col("voter")).when(F.col("doc_id") % 4 == 1, F.col("voter") % 2).otherwise(F.col("doc_id") % 3).cast("string"))
    return d.select("doc_id", "voter", kind.alias("kind"), ((F.col("doc_id") + F.col("voter")) % 5 == 0).alias("flag"), F.repeat(F.lit("e"), (F.col("doc_id") * F.col("voter") % 7).cast("int")).alias("evidence"))


_VOTES = "SELECT doc_id, voter, 'k' || CASE WHEN doc_id % 4 = 0 THEN voter WHEN doc_id % 4 = 1 THEN voter % 2 ELSE doc_id % 3 END AS kind, (doc_id + voter) % 5 = 0 AS flag, repeat('e', CAST(doc_id * voter % 7 AS INTEGER)) AS evidence FROM documents, range(1, 4) v(voter)"


@query("vote_decisions", f"""
WITH v AS ({_VOTES}), k AS (SELECT doc_id, kind, count(*) AS n FROM v GROUP BY 1, 2),
t AS (SELECT doc_id, max(n) AS top, arg_max(kind, ROW(n, kind)) AS kind FROM k GROUP BY 1),
f AS (SELECT doc_id, count(*) FILTER (WHERE flag) AS yes FROM v GROUP BY 1),
d AS (SELECT doc_id, CASE WHEN top * 2 > 3 THEN kind END AS kind, top, yes FROM t JOIN f USING (doc_id)),
e AS (SELECT v.doc_id, arg_max(evidence, ROW(CASE WHEN CASE WHEN d.yes > 0 THEN v.flag ELSE coalesce(v.kind = d.kind, false) END THEN 1 ELSE 0 END, length(evidence), -voter)) AS evidence FROM v JOIN d USING (doc_id) GROUP BY 1)
SELECT doc_id, CAST(3 AS BIGINT) AS votes, kind, CASE WHEN top = 3 THEN 'unanimous' WHEN kind IS NOT NULL THEN 'judged' ELSE 'disputed' END AS kind_agreement, yes > 0 AS flag, CASE WHEN yes IN (0, 3) THEN 'unanimous' ELSE 'or_recovered' END AS flag_agreement, evidence FROM d JOIN e USING (doc_id)""")
def vote_decisions(spark, sf_dir):
    return evaluate.decide(_votes(spark, sf_dir), "doc_id")


@query("vote_disagreements", f"SELECT doc_id, count(DISTINCT kind) AS kinds, count(DISTINCT flag) AS flags FROM ({_VOTES}) GROUP BY 1 HAVING count(DISTINCT kind) > 1 OR count(DISTINCT flag) > 1")
def vote_disagreements(spark, sf_dir):
    return evaluate.disagreements(_votes(spark, sf_dir), "doc_id")


@query("vote_coverage", f"SELECT votes, count(*) AS documents FROM (SELECT doc_id, count(*) AS votes FROM ({_VOTES}) WHERE doc_id % 10 <> voter AND doc_id IN (SELECT doc_id FROM labels) GROUP BY 1) GROUP BY 1")
def vote_coverage(spark, sf_dir):
    """Votes on documents of the manifest; unknown ids don't count."""
    v = _votes(spark, sf_dir).filter("doc_id % 10 <> voter").join(table(spark, sf_dir, "labels").select("doc_id"), "doc_id", "left_semi")
    return v.groupBy("doc_id").agg(F.count("*").alias("votes")).groupBy("votes").agg(F.count("*").alias("documents"))


def _said(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    p = lab.select("doc_id", F.explode(F.sequence(F.lit(1), F.lit(2))).alias("pass"), (F.col("quality") == 1).alias("truth"), F.concat(F.lit("c"), F.col("doc_id") % 3).alias("human"))
    return p.withColumn("said", F.when((F.col("doc_id") + F.col("pass")) % 7 == 0, ~F.col("truth")).otherwise(F.col("truth"))).withColumn("machine", F.when((F.col("doc_id") * F.col("pass")) % 5 == 0, "c0").otherwise(F.col("human")))


_SAID = "SELECT doc_id, pass, quality = 1 AS truth, 'c' || (doc_id % 3) AS human, CASE WHEN (doc_id + pass) % 7 = 0 THEN quality <> 1 ELSE quality = 1 END AS said, CASE WHEN (doc_id * pass) % 5 = 0 THEN 'c0' ELSE 'c' || (doc_id % 3) END AS machine FROM labels, range(1, 3) r(pass)"


@query("honeypot_scores", f"""SELECT CAST(pass AS INTEGER) AS pass, count(*) AS n, count(*) FILTER (WHERE truth = said) / CAST(count(*) AS DOUBLE) AS accuracy, CAST(count(*) FILTER (WHERE truth AND said) AS BIGINT) AS tp, CAST(count(*) FILTER (WHERE NOT truth AND said) AS BIGINT) AS fp, CAST(count(*) FILTER (WHERE truth AND NOT said) AS BIGINT) AS fn,
  count(*) FILTER (WHERE truth AND said) / nullif(CAST(count(*) FILTER (WHERE truth) AS DOUBLE), 0) AS recall, count(*) FILTER (WHERE truth AND said) / nullif(CAST(count(*) FILTER (WHERE said) AS DOUBLE), 0) AS precision FROM ({_SAID}) GROUP BY 1""")
def honeypot_scores(spark, sf_dir):
    return evaluate.binary_scores(_said(spark, sf_dir), F.col("truth"), F.col("said"), ["pass"])


@query("confusion", f"SELECT human, count(*) AS n, " + ", ".join(f"CAST(count(*) FILTER (WHERE machine = 'c{k}') AS BIGINT) AS said_c{k}" for k in range(3)) + f", count(*) FILTER (WHERE machine = human) / CAST(count(*) AS DOUBLE) AS recall FROM ({_SAID}) WHERE pass = 1 GROUP BY 1")
def confusion(spark, sf_dir):
    return evaluate.confusion(_said(spark, sf_dir).filter("pass = 1"), "human", "machine", ["c0", "c1", "c2"])


@query("grouped_accuracy", f"SELECT CAST(pass AS INTEGER) AS pass, count(*) FILTER (WHERE (human = 'c0') = (machine = 'c0')) / CAST(count(*) AS DOUBLE) AS action_accuracy FROM ({_SAID}) GROUP BY 1")
def grouped_accuracy(spark, sf_dir):
    """Classes mapped to what is done with them: only a difference in action is an error."""
    action = spark.createDataFrame([("c0", "extract"), ("c1", "skip"), ("c2", "skip")], "class string, action string")
    a, b = (F.broadcast(action.select(F.col("class").alias(f"k{x}"), F.col("action").alias(f"a{x}"))) for x in "hm")
    s = _said(spark, sf_dir).join(a, F.col("human") == F.col("kh")).join(b, F.col("machine") == F.col("km"))
    return s.groupBy("pass").agg(F.try_divide(F.count_if(F.col("ah") == F.col("am")), F.count("*")).alias("action_accuracy"))


@query("self_consistency", f"SELECT CAST(count(*) FILTER (WHERE kinds > 1) AS BIGINT) AS flips, count(*) AS documents FROM (SELECT doc_id, count(DISTINCT machine) AS kinds FROM ({_SAID}) GROUP BY 1)")
def self_consistency(spark, sf_dir):
    s = _said(spark, sf_dir).groupBy("doc_id").agg(F.count_distinct("machine").alias("kinds"))
    return s.agg(F.count_if(F.col("kinds") > 1).alias("flips"), F.count("*").alias("documents"))


@query("top_confusions", f"SELECT human, machine, count(*) AS n FROM ({_SAID}) WHERE human <> machine GROUP BY 1, 2 ORDER BY n DESC, human, machine LIMIT 3")
def top_confusions(spark, sf_dir):
    s = _said(spark, sf_dir).filter("human <> machine").groupBy("human", "machine").agg(F.count("*").alias("n"))
    return s.orderBy(F.col("n").desc(), "human", "machine").limit(3)


_UNESCAPE = "regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)"
for _entity, _char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"), ("&nbsp;", " "), ("&amp;", "&")):
    _UNESCAPE = f"replace({_UNESCAPE}, '{_entity}', '{_char}')"


@query("page_titles", f"SELECT page_id, nullif(trim(regexp_replace({_UNESCAPE}, '\\s+', ' ', 'g')), '') AS title FROM pages")
def page_titles(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", links.page_title(F.col("html")).alias("title"))


@query("page_links", r"""SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<a\b[^>]*?href=["'']([^"'']+)["'']', 1)) AS INTEGER) AS anchors, CAST(len(list_distinct(regexp_extract_all(html, '(?i)<a\b[^>]*?href=["'']([^"'']+)["'']', 1))) AS INTEGER) AS links FROM pages""")
def page_links(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    every = F.regexp_extract_all("html", F.lit(r"""(?i)<a\b[^>]*?href=["']([^"']+)["']"""))
    return p.select("page_id", F.size(every).alias("anchors"), F.size(links.page_links(F.col("html"))).alias("links"))


_PORTAL = """concat('<link href="/filestream.ashx?DocumentId=', page_id, '"><a href="/FileStream.ashx?DocumentId=', page_id + 1, '&amp;x=1">a</a><a class="b" href="https://h/Meeting.aspx?Id=', page_id, '">m</a><a href="/FileStream.ashx?DocumentId=', page_id + 1, '&amp;x=1">again</a>')"""


@query("page_link_dedup", "SELECT page_id, concat('https://p/FileStream.ashx?DocumentId=', page_id + 1, '&x=1|https://h/Meeting.aspx?Id=', page_id) AS documents, concat('https://p/filestream.ashx?DocumentId=', page_id) AS assets FROM pages")
def page_link_dedup(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", F.expr(_PORTAL).alias("html"))
    return p.select("page_id", F.array_join(links.document_links(F.col("html"), "https://p/"), "|").alias("documents"), F.array_join(links.asset_links(F.col("html"), "https://p/"), "|").alias("assets"))


@query("meeting_pages", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN concat('https://p/Meeting.aspx?Id=m', page_id, '&Agenda=Agenda&lang=English') ELSE '' END AS pages FROM pages")
def meeting_pages(spark, sf_dir):
    calendar = F.expr("concat('{\"d\": [{\"ID\": \"m', page_id, '\", \"HasAgenda\": ', CASE WHEN page_id % 2 = 0 THEN 'true' ELSE 'false' END, '}, {\"HasAgenda\": true}]}')")
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(links.meeting_pages(calendar, "https://p/"), "|").alias("pages"))


@query("error_pages", "SELECT page_id, page_id % 4 = 0 AS missing FROM pages")
def error_pages(spark, sf_dir):
    html = F.when(F.col("page_id") % 8 == 0, "<b>This Meeting is not Available</b>").when(F.col("page_id") % 8 == 4, "The published report was not found.").otherwise(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", links.is_error_page(html).alias("missing"))


#: An agenda with row-major, column-major, shifted, unequal and unrelated tables.
AGENDA = """<h2>BA189.{k} - Award of Ariba Document Number 3234668279 to GHD Limited for Works</h2>
<p><a href="http://x/legdocs/mmis/2017/ba/bgrd/backgroundfile-{k}.pdf">report</a></p>
<table><tr><th>Suppliers</th><th>Bid Price (Incl. HST)</th></tr><tr><td>1. Pave Tar Ltd</td><td>$937,419</td></tr><tr><td>2</td><td>**Joe Inc.</td><td>$1,219,281*</td></tr></table>
<table><tr><td rowspan=3>Number of Bids:</td><td>Firm Name</td><td>Bid Price excluding HST</td></tr><tr><td><p>A Co</p><p>B Co</p></td><td><p>$1.00</p><p>$2.00</p></td></tr><tr><td>C Co<br>D Co</td><td>$3.00</td></tr></table>
<table><tr><td>Cost centre</td><td>Price</td></tr><tr><td>WBS-1</td><td>$5.00</td></tr></table>"""


@query("html_bid_tables", """
SELECT page_id, concat('2017.BA189.189.', page_id) AS reference, '3234668279' AS document_number, b.name AS bidder_name_raw, b.price AS bid_price, b.basis AS hst_basis FROM pages,
(VALUES ('Pave Tar Ltd', '$937,419', 'including'), ('Joe Inc.', '$1,219,281*', 'including'), ('A Co', '$1.00', 'excluding'), ('B Co', '$2.00', 'excluding')) b(name, price, basis)""".replace("BA189.189.", "BA189."))
def html_bid_tables(spark, sf_dir):
    a, b = AGENDA.split("{k}", 1)
    b, c = b.split("{k}", 1)
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit(a), "page_id", F.lit(b), "page_id", F.lit(c)).alias("html"))
    rows = p.lateralJoin(html_tables.BidTables(F.col("html").outer(), F.lit("2017.BA189")))
    return rows.select("page_id", "reference", "document_number", "bidder_name_raw", "bid_price", "hst_basis")


@query("agenda_items_and_pdfs", "SELECT page_id, concat('2017.BA189.', page_id) AS reference, '3234668279' AS documents, concat('http://x/legdocs/mmis/2017/ba/bgrd/backgroundfile-', page_id, '.pdf') AS url FROM pages")
def agenda_items_and_pdfs(spark, sf_dir):
    a, b = AGENDA.split("{k}", 1)
    b, c = b.split("{k}", 1)
    p = table(spark, sf_dir, "pages").select("page_id", F.concat(F.lit(a), "page_id", F.lit(b), "page_id", F.lit(c)).alias("html"))
    items = p.lateralJoin(html_tables.AgendaItems(F.col("html").outer(), F.lit("2017.BA189"))).select("page_id", "reference", F.array_join("document_numbers", "|").alias("documents"))
    pdfs = p.lateralJoin(html_tables.AgendaPdfs(F.col("html").outer(), F.lit("2017.BA189"))).select("page_id", "url", "reference")
    return items.join(pdfs, ["page_id", "reference"])


@query("heading_carry_forward", """
WITH r AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, CASE WHEN l_linenumber % 3 = 1 THEN concat('H', l_partkey) END AS heading FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, last_value(heading IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS owner FROM r""")
def heading_carry_forward(spark, sf_dir):
    r = table(spark, sf_dir, "lineitem").withColumn("heading", F.when(F.col("l_linenumber") % 3 == 1, F.concat(F.lit("H"), "l_partkey")))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_extendedprice").rowsBetween(Window.unboundedPreceding, 0)
    return r.select("l_orderkey", "l_linenumber", "l_partkey", F.last("heading", ignorenulls=True).over(w).alias("owner"))


@query("voting_record_first_per_doc", """
WITH r AS (SELECT conv_id, turn, CASE WHEN turn % 2 = 0 THEN concat('Award of Doc ', 3000000000 + conv_id % 30, ' for x') ELSE 'housekeeping' END AS t, conv_id * 100 + turn AS place FROM conversations)
SELECT CAST(3000000000 + conv_id % 30 AS VARCHAR) AS document_number, concat('I', arg_min(conv_id, place)) AS reference FROM r WHERE turn % 2 = 0 GROUP BY 1""")
def voting_record_first_per_doc(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    title = F.when(F.col("turn") % 2 == 0, F.concat(F.lit("Award of Doc "), (F.lit(3000000000).cast("long") + F.col("conv_id") % 30).cast("string"), F.lit(" for x"))).otherwise("housekeeping")
    rows = c.select(title.alias("Agenda Item Title"), F.concat(F.lit("I"), "conv_id").alias("Agenda Item #"), F.col("role").alias("Committee"), (F.col("conv_id") * 100 + F.col("turn")).alias("place"))
    return normalize.voting_record(rows, "place").select("document_number", "reference")


_FEED = """named_struct('Solicitation_Document_Number', concat('Doc', 2243000000 + o_orderkey), 'Status', concat(' ', o_orderstatus, ' '), 'Client_Division', CASE WHEN o_orderkey % 2 = 0 THEN array(o_orderpriority, 'x') ELSE cast(array() AS array<string>) END,
 'Awarded_Suppliers', array(named_struct('Successful_Bidder', concat('F', o_custkey), 'Award_Amount', '$1', 'Date_Awarded', '', 'AwardedDate', '2020-01-01'), named_struct('Successful_Bidder', '', 'Award_Amount', '$2', 'Date_Awarded', '2021-01-01', 'AwardedDate', '')))"""


def _feed(spark, sf_dir):
    """orders as landed JSON of a feed, read back with the declared schema."""
    json = table(spark, sf_dir, "orders").select(F.to_json(F.expr(_FEED)).alias("j"))
    return json.select(F.from_json("j", normalize.FEEDS["odata_solicitation"]).alias("r")).select("r.*")


@query("feed_solicitations", "SELECT CAST(2243000000 + o_orderkey AS VARCHAR) AS document_number, trim(o_orderstatus) AS status, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS division FROM orders")
def feed_solicitations(spark, sf_dir):
    return normalize.odata_solicitations(_feed(spark, sf_dir))["solicitation"].select("document_number", "status", "division")


@query("feed_awards", "SELECT CAST(2243000000 + o_orderkey AS VARCHAR) AS document_number, concat('F', o_custkey) AS supplier_name_raw, '$1' AS award_amount, '2020-01-01' AS award_date, 'odata' AS source FROM orders")
def feed_awards(spark, sf_dir):
    return normalize.odata_solicitations(_feed(spark, sf_dir))["award"]


@query("portal_projects", "SELECT concat('Works ', p_name, ' - ', CAST(10 + p_partkey % 80 AS VARCHAR), 'ECS-MI-02SW') AS name, concat(CAST(10 + p_partkey % 80 AS VARCHAR), 'ECS-MI-02SW') AS contract_number, CASE WHEN p_partkey % 2 = 0 THEN p_brand END AS owner_division FROM part")
def portal_projects(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    raw = p.select(F.concat(F.lit("Works "), "p_name", F.lit(" - "), (F.col("p_partkey") % 80 + 10).cast("string"), F.lit("ECS-MI-02SW ")).alias("Name and Construction Contract Number"), F.when(F.col("p_partkey") % 2 == 0, F.col("p_brand")).otherwise("None").alias("Project Owner (Division)"), *(F.lit(None).cast("string").alias(c) for c in normalize.CAPITAL if c != "Project Owner (Division)"))
    return normalize.portal_capital(raw)["capital_project"].select("name", "contract_number", "owner_division")


@query("posting_details_left_join", "SELECT CAST(page_id AS VARCHAR) AS rfx_id, CASE WHEN page_id % 2 = 0 THEN 'detail' ELSE 'search' END AS title, CASE WHEN page_id % 2 = 0 THEN CAST(5672000000 + page_id AS VARCHAR) END AS document_number FROM pages")
def posting_details_left_join(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    rid = F.col("page_id").cast("string")
    search = p.select(rid.alias("rfxID"), F.lit("search").alias("title"), F.array(F.lit("c")).alias("productsAndServicesCategories"), F.lit("1").alias("minAmount"), F.lit("x").alias("maxAmount"), F.lit(None).cast("string").alias("datePosted"), F.lit(None).cast("string").alias("endDate"))
    found = p.filter("page_id % 2 = 0").select(rid.alias("id"), F.concat(F.lit("Doc"), (F.lit(5672000000).cast("long") + F.col("page_id")).cast("string")).alias("externalRfxId"), F.lit("detail").alias("title"), F.lit("open").alias("status"), F.expr("array(named_struct('categoryName', 'd'))").alias("categories"), F.expr("named_struct('minAmount', 1L, 'maxAmount', 2L, 'currency', 'CAD')").alias("opportunityAmount"), F.lit("2020").alias("startDate"), F.lit("2021").alias("endDate"), F.lit("u").alias("publicPostingUrl"))
    return normalize.postings(search, found)["ariba_posting"].select("rfx_id", "title", "document_number")


@query("portal_listings", "SELECT n_name AS buyer_id, upper(concat('rfp ', s_suppkey)) AS native_ref FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 2 = 0")
def portal_listings(spark, sf_dir):
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    raw = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(F.lit("9").alias("Id"), F.concat(F.lit(" rfp  "), "s_suppkey").alias("ReferenceNumber"), F.lit(None).cast("string").alias("BidNumber"), F.lit("t").alias("Title"), F.lit(None).cast("string").alias("ClosingDate"), F.lit(None).cast("string").alias("DatePosted"), F.lit("Open").alias("StatusText"), F.lit(1).alias("Documents"), F.lit(0).alias("Addendums"), F.lit(0).alias("PlanTakers"), F.col("n_name").alias("buyer_slug"))
    buyers = n.filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("slug"))
    return normalize.listings(raw, buyers)["agency_solicitation"].select("buyer_id", "native_ref")


@query("award_summary_files", "SELECT CAST(p_partkey AS VARCHAR) AS id, 'Award Summary.pdf' AS name FROM part WHERE p_partkey % 3 = 0")
def award_summary_files(spark, sf_dir):
    files = F.when(F.col("p_partkey") % 3 == 0, F.expr("array(named_struct('name', 'Award Summary.pdf', 'url', 'u'), named_struct('name', 'Other.pdf', 'url', 'v'))")).otherwise(F.expr("array(named_struct('name', 'Other.pdf', 'url', 'v'))"))
    return normalize.award_summary_files(table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("id"), files.alias("uploadedFilesStaff"))).select("id", "name")


@query("archived_titles", "SELECT CAST(2922000000 + page_id AS VARCHAR) AS document_number, concat('Parks & Recreation ', CASE WHEN page_id % 2 = 0 THEN 'works' ELSE 'grounds' END) AS title FROM pages WHERE page_id % 3 <> 0")
def archived_titles(spark, sf_dir):
    """Folder -> document number; the first page's title; placeholders don't count."""
    from ..functions.titles import clean_title

    p = table(spark, sf_dir, "pages")
    html = F.concat(F.lit("<HTML><Title>"), F.when(F.col("page_id") % 3 == 0, "Doc-2922336030").otherwise(F.concat(F.lit("Parks &amp;  Recreation&nbsp;"), F.when(F.col("page_id") % 2 == 0, "works").otherwise("grounds"))), F.lit("</title>"))
    folder = F.concat(F.lit("Doc"), (F.lit(2922000000).cast("long") + F.col("page_id")).cast("string"))
    pages = p.select(document_number(folder).alias("document_number"), "page_id", clean_title(links.page_title(html)).alias("title"))
    return pages.groupBy("document_number").agg(F.min_by("title", "page_id").alias("title")).filter("title is not null")


@query("bow_classifiers")
def bow_classifiers(spark, sf_dir):
    """Quality classes by bags of words and of character n-grams, out of fold."""
    from ..operators.classify import cross_validate
    from ..streaming.upsert import shared_root

    # dealt by key once, for the labels, the folds and an even share of texts a task
    d = table(spark, sf_dir, "documents").repartition("doc_id").join(table(spark, sf_dir, "labels"), "doc_id").select("doc_id", "text", F.col("quality").cast("string").alias("kind"))
    kinds = {"word 1gram + logistic": ("logistic", "word 1"), "word 1gram + bayes": ("bayes", "word 1"), "char 3-5gram + svm": ("svm", "char 3-5")}
    return cross_validate(d, "doc_id", "kind", kinds, shared_root(spark))


@query("stratified_folds", """
WITH r AS (SELECT p_brand, count(*) AS n FROM part GROUP BY 1)
SELECT p_brand, fold, (n // 3 + CASE WHEN (fold + 2) % 3 < n % 3 THEN 1 ELSE 0 END)::BIGINT AS n FROM r, range(3) f(fold) WHERE n // 3 + CASE WHEN (fold + 2) % 3 < n % 3 THEN 1 ELSE 0 END > 0""")
def stratified_folds(spark, sf_dir):
    """Ranks 1, 2, 3, ... of each class modulo three: no fold of a class is larger than another by more than one."""
    from ..operators.classify import with_folds

    return with_folds(table(spark, sf_dir, "part").select("p_partkey", "p_brand"), "p_partkey", "p_brand", 3).groupBy("p_brand", F.col("fold").cast("long").alias("fold")).agg(F.count("*").alias("n"))


@query("download_queue", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN sha256('%PDF' || page_id) END AS sha256, CASE WHEN page_id % 3 = 1 THEN 'not the expected kind of file' WHEN page_id % 3 = 2 THEN 'no answer' END AS error FROM pages WHERE page_id % 4 <> 0")
def download_queue(spark, sf_dir):
    """Pending files only; a failure is its row's, and what isn't a PDF stays queued."""
    from ..sources import landing

    def fetch(url: str) -> bytes:
        k = int(url)
        if k % 3 == 2:
            raise ConnectionError("no answer")
        return (b"%PDF" if k % 3 == 0 else b"<html>") + url.encode()

    index = table(spark, sf_dir, "pages").select("page_id", F.col("page_id").cast("string").alias("url"), F.when(F.col("page_id") % 4 == 0, "held").alias("sha256"))
    pending = landing.queue(index, F.col("sha256").isNotNull(), "page_id")
    return landing.download(pending, "url", fetch).select("page_id", "sha256", "error")


@query("open_events", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS deadline FROM orders WHERE o_orderdate >= TIMESTAMP '1997-06-01' AND o_orderkey % 2 = 0")
def open_events(spark, sf_dir):
    from ..streaming.upsert import open_events as scan

    link = F.when(F.col("o_orderkey") % 2 == 0, "https://x/RFXEVENT/preview/1").otherwise("https://merx.example/1")
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("deadline"), link.alias("link"))
    return scan(o, "deadline", "link", F.lit("1997-06-01")).select("o_orderkey", "deadline")


@query("stream_window_counts", "SELECT event_type, strftime(time_bucket(INTERVAL '1 hour', ts), '%Y-%m-%d %H:%M') AS starts, count(*) AS n FROM events GROUP BY ALL")
def stream_window_counts(spark, sf_dir):
    """An extension: tumbling windows of a stream; what isn't late is counted as in a batch."""
    from ..streaming.upsert import replay_counts

    e = table(spark, sf_dir, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    return replay_counts(e, "ts", "event_type").select("event_type", F.date_format("starts", "yyyy-MM-dd HH:mm").alias("starts"), "n")


def _pages_with(spark, sf_dir, template: str):
    """pages with a page made from a template, in which {k} is the page's id."""
    parts = template.split("{k}")
    pieces = [F.lit(parts[0])]
    for p in parts[1:]:
        pieces += [F.col("page_id").cast("string"), F.lit(p)]
    return table(spark, sf_dir, "pages").select("page_id", F.concat(*pieces).alias("html"))


ITEM_PAGE = """<h1>Item {k}: Award</h1><p>intro</p><h2>Committee Decision</h2><p>That the award</p><ul><li>be approved {k}</li></ul><h2>Background</h2><p><a href="a{k}.pdf">A</a><a href="b.PDF">B</a><a href="a{k}.pdf">A again</a><a href="c.html">C</a></p>"""


@query("council_item_pages", "SELECT page_id, concat('Item ', page_id, ': Award') AS title, concat('That the award be approved ', page_id) AS decision_text, concat('a', page_id, '.pdf|b.PDF') AS pdfs FROM pages")
def council_item_pages(spark, sf_dir):
    p = _pages_with(spark, sf_dir, ITEM_PAGE)
    return p.lateralJoin(html_tables.CouncilItem(F.col("html").outer())).select("page_id", "title", "decision_text", F.array_join("pdfs", "|").alias("pdfs"))


REGISTRY_PAGE = """<table><tr><th>Supplier Name</th><th>Status</th><th>Start Date of Suspension</th><th>End Date of Suspension</th><th>Type of Suspension</th><th>Authority</th></tr>
<tr><td>Firm {k} Ltd</td><td>Active</td><td>November 27, 28, and 29, 2012</td><td>N/A</td><td>Full</td><td>2012.GM1.{k}</td></tr><tr><td>Nobody Inc</td><td></td><td></td><td></td><td></td><td></td></tr></table>"""


@query("suspended_registry", "SELECT page_id, concat('Firm ', page_id, ' Ltd') AS supplier_name_raw, 'November 27, 28, and 29, 2012' AS suspension_start, concat('2012.GM1.', page_id) AS council_authority FROM pages UNION ALL SELECT page_id, 'Nobody Inc', NULL, '' FROM pages")
def suspended_registry(spark, sf_dir):
    rows = _pages_with(spark, sf_dir, REGISTRY_PAGE).lateralJoin(html_tables.Registry(F.col("html").outer())).select("page_id", "cells")
    firms = normalize.suspended(rows)["suspended_firm"]
    names = rows.select("page_id", F.col("cells")["Supplier Name"].alias("n"), F.coalesce(F.nullif(F.col("cells")["Authority"], F.lit("")), F.lit("")).alias("a"))
    return names.join(firms.distinct(), (F.col("n") == F.col("supplier_name_raw")) & (F.col("a") == F.col("council_authority"))).select("page_id", "supplier_name_raw", "suspension_start", "council_authority")


AGENDA_2017 = """<p>BA1.2 - Award of Call {k}-2017 to Big Co. for Works
 is $1,234.50 net of all applicable taxes. BA1.3 - Award 1234567899 to X for Y $5 net of all applicable taxes. BA1.4 - no value to Z for W</p>"""


@query("pre_number_awards", "SELECT page_id, '2017.BA1.2' AS reference, concat('Award of Call ', page_id, '-2017 to Big Co. for Works') AS title, 'Big Co.' AS winner_raw, 1234.5::DOUBLE AS award_value FROM pages")
def pre_number_awards(spark, sf_dir):
    from ..functions.amounts import parse_amount

    rows = _pages_with(spark, sf_dir, AGENDA_2017).lateralJoin(html_tables.PreNumberAwards(F.col("html").outer(), F.lit("2017.BA1")))
    return rows.select("page_id", "reference", "title", "winner_raw", parse_amount(F.col("value_raw")).alias("award_value"))


REPORT_PAGE = """<ul><li>Doc {k} <a href="backgroundfile-{k}.pdf">one</a></li><li>other <a href="backgroundfile-x.pdf">two</a></li></ul>"""


@query("report_links", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN concat('backgroundfile-', page_id, '.pdf') END AS url FROM pages")
def report_links(spark, sf_dir):
    """The link beside the document's number; where none is and there are several, none."""
    wanted = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("Doc "), F.col("page_id").cast("string"))).otherwise("Doc -1")
    p = _pages_with(spark, sf_dir, REPORT_PAGE).withColumn("wanted", wanted)
    return p.lateralJoin(html_tables.ReportLink(F.col("html").outer(), F.col("wanted").outer())).select("page_id", "url")


@query("zip_bundle_index", "SELECT n_nationkey, f.filename, f.path, f.file_size::BIGINT AS file_size FROM nation, (VALUES ('a.txt', 'a.txt', 1), ('c.txt', 'in.zip/b/c.txt', 5), ('bad.zip', 'bad.zip', 9)) f(filename, path, file_size)")
def zip_bundle_index(spark, sf_dir):
    import io
    import zipfile

    from ..sources.zip_index import ZipIndex

    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("b/c.txt", "hello")
    with zipfile.ZipFile(outer, "w") as z:
        for name, data in (("a.txt", b"x"), ("in.zip", inner.getvalue()), ("bad.zip", b"not a zip")):
            z.writestr(name, data)
    n = table(spark, sf_dir, "nation").select("n_nationkey", F.lit(bytearray(outer.getvalue())).alias("content"))
    return n.lateralJoin(ZipIndex(F.col("content").outer())).select("n_nationkey", "filename", "path", "file_size")


@query("feed_noncompetitive", "SELECT concat('W', o_orderkey) AS workspace_number, concat('F', o_custkey) AS supplier_name_raw, '$1' AS contract_amount FROM orders WHERE o_orderkey % 3 <> 0")
def feed_noncompetitive(spark, sf_dir):
    """Only a record's first supplier; no key, no row."""
    supplier = "named_struct('Successful_Bidder', concat('{}', o_custkey), 'Award_Amount', '$1', 'Date_Awarded', '2020')"
    record = F.expr(f"named_struct('Non_Competitive_Reference_Number', CASE WHEN o_orderkey % 3 <> 0 THEN concat('W', o_orderkey) ELSE ' ' END, 'Awarded_Suppliers', array({supplier.format('F')}, {supplier.format('G')}))")
    raw = table(spark, sf_dir, "orders").select(F.from_json(F.to_json(record), normalize.FEEDS["odata_noncompetitive"]).alias("r")).select("r.*")
    return normalize.odata_noncompetitive(raw)["noncompetitive"].select("workspace_number", "supplier_name_raw", "contract_amount")


@query("portal_spine_and_awards", """
SELECT CAST(2243000000 + o_orderkey AS VARCHAR) AS document_number, CASE WHEN o_orderkey % 2 = 0 THEN 'Awarded' ELSE 'Open' END AS status, CASE WHEN o_orderkey % 4 = 0 THEN concat('S', o_custkey) END AS supplier_name_raw FROM orders WHERE o_orderkey % 5 <> 0""")
def portal_spine_and_awards(spark, sf_dir):
    """Both portal feeds: junk numbers drop out, None is null, suppliers are awards of their own."""
    def rows(kind, condition, **fields):
        names = [f.name for f in spark.createDataFrame([], normalize.FEEDS[kind]).schema]
        number = F.when(F.col("o_orderkey") % 5 == 0, "xxxxxxxx").otherwise((F.lit(2243000000).cast("long") + F.col("o_orderkey")).cast("string"))
        values = {"Document Number": number, "Wards": F.lit("None"), **fields}
        return table(spark, sf_dir, "orders").filter(condition).select(*(values.get(n, F.lit(None).cast("string")).alias(n) for n in names))

    awarded = normalize.portal_awarded(rows("portal_awarded", "o_orderkey % 2 = 0", **{"Successful Supplier": F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("S"), "o_custkey")).otherwise(" ")}))
    spine = awarded["solicitation"].unionByName(normalize.portal_open(rows("portal_open", "o_orderkey % 2 = 1"))["solicitation"], allowMissingColumns=True)
    return spine.filter("wards is null").join(awarded["award"].select("document_number", "supplier_name_raw"), "document_number", "left").select("document_number", "status", "supplier_name_raw")


@query("portal_noncompetitive_rows", "SELECT concat('W', s_suppkey) AS workspace_number, s_name AS supplier_name_raw, CASE WHEN s_suppkey % 2 = 0 THEN '$5' END AS contract_amount FROM supplier")
def portal_noncompetitive_rows(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    none = F.lit(None).cast("string")
    raw = s.select(F.concat(F.lit("W"), "s_suppkey").alias("Workspace Number"), none.alias("Reason"), F.col("s_name").alias("Supplier Name"), F.when(F.col("s_suppkey") % 2 == 0, "$5").otherwise("None").alias("Contract Amount"), none.alias("Contract Date"), none.alias("Division"), none.alias("Supplier Address"))
    return normalize.portal_noncompetitive(raw)["noncompetitive"].select("workspace_number", "supplier_name_raw", "contract_amount")

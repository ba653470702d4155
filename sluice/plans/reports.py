"""Aggregates, observed enums, schema dictionary, amounts in tiers, drift and capture checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..export import dictionary
from ..functions import amounts, listing
from ..operators import batches, drift
from ..session import TABLES, table
from . import scalars
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles

_COUNTED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _COUNTED))
def table_counts(spark, sf_dir):
    return dictionary.table_counts({t: table(spark, sf_dir, t) for t in _COUNTED})


@query("source_row_counts", "SELECT source, count(*) AS n, CAST(count(*) FILTER (WHERE text IS NULL) AS BIGINT) AS without_text FROM documents GROUP BY 1")
def source_row_counts(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("without_text"))


@query("distinct_documents", "SELECT count(DISTINCT text) AS texts, count(DISTINCT source) AS sources FROM documents")
def distinct_documents(spark, sf_dir):
    """Distinct texts are counted by digest, so the shuffle carries 32 bytes a document."""
    return table(spark, sf_dir, "documents").select("source", F.sha2("text", 256).alias("digest")).agg(F.count_distinct("digest").alias("texts"), F.count_distinct("source").alias("sources"))


@query("observed_enums", """
SELECT 'o_orderstatus' AS column_name, array_to_string(list_sort(list(DISTINCT o_orderstatus)), '|') AS observed FROM orders
UNION ALL SELECT 'o_orderpriority', array_to_string(list_sort(list(DISTINCT o_orderpriority)), '|') FROM orders
UNION ALL SELECT 'l_returnflag', array_to_string(list_sort(list(DISTINCT l_returnflag)), '|') FROM lineitem""")
def observed_enums(spark, sf_dir):
    o = dictionary.observed_enums(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])
    return o.unionByName(dictionary.observed_enums(table(spark, sf_dir, "lineitem"), ["l_returnflag"])).select("column_name", F.array_join("observed", "|").alias("observed"))


@query("schema_dictionary", """
SELECT table_name, column_name, CAST(ordinal_position AS INTEGER) AS position,
  CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END AS type
FROM information_schema.columns WHERE table_schema = 'main' AND table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')""")
def schema_dictionary(spark, sf_dir):
    return dictionary.schema_rows(spark, {t: table(spark, sf_dir, t) for t in TABLES}).select("table_name", "column_name", "position", "type")


@query("amount_tiers_sum", f"""
WITH a AS (SELECT o_orderstatus, raw, {scalars.AMOUNT_SQL.format(c='raw')} AS n, CASE WHEN raw = 'kj' THEN 7.5 WHEN raw = '1,23' THEN 1.23 END AS labelled, CASE WHEN raw = '0' THEN 'not_an_award' WHEN raw IN ('kj', '1,23') THEN 'amount' END AS verdict FROM ({scalars.RAW_AMOUNTS_SQL}))
SELECT o_orderstatus, count(*) AS n_rows, count(n) AS parsed, CAST(round(sum(n) * 100) AS BIGINT) AS cents_numeric, CAST(round(sum(coalesce(labelled, n)) FILTER (WHERE verdict IS DISTINCT FROM 'not_an_award') * 100) AS BIGINT) AS cents_labelled FROM a GROUP BY 1""")
def amount_tiers_sum(spark, sf_dir):
    raw = F.col("raw")
    a = scalars.raw_amounts(spark, sf_dir).withColumns({"n": amounts.parse_amount(raw), "labelled": F.when(raw == "kj", 7.5).when(raw == "1,23", 1.23), "verdict": F.when(raw == "0", "not_an_award").when(raw.isin("kj", "1,23"), "amount")})
    human = F.when(~F.col("verdict").eqNullSafe("not_an_award"), F.coalesce("labelled", "n"))
    cents = lambda c: F.round(F.sum(c) * 100).cast("long")
    return a.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.count("n").alias("parsed"), cents(F.col("n")).alias("cents_numeric"), cents(human).alias("cents_labelled"))


@query("amount_review_queue", f"SELECT raw, count(*) AS n FROM (SELECT raw, {scalars.AMOUNT_SQL.format(c='raw')} AS amount FROM ({scalars.RAW_AMOUNTS_SQL})) WHERE raw IS NOT NULL AND trim(raw) <> '' AND amount IS NULL AND raw NOT IN ('kj') GROUP BY 1")
def amount_review_queue(spark, sf_dir):
    labels = spark.createDataFrame([("kj",)], "raw string")
    a = scalars.raw_amounts(spark, sf_dir).filter((F.trim("raw") != "") & amounts.parse_amount(F.col("raw")).isNull())
    return a.groupBy("raw").agg(F.count("*").alias("n")).join(labels, "raw", "left_anti")


@query("max_id_per_group", "SELECT event_type, max(event_id) AS last_id, CAST((SELECT coalesce(max(event_id), 0) FROM events) AS BIGINT) AS last_of_all FROM events GROUP BY 1")
def max_id_per_group(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.groupBy("event_type").agg(F.max("event_id").alias("last_id")).join(F.broadcast(e.agg(F.coalesce(F.max("event_id"), F.lit(0)).alias("last_of_all"))))


@query("schema_drift_missing_fields", """
WITH e AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN '{"a": 1}' WHEN 1 THEN '{"k": 2, "extra": 3}' WHEN 2 THEN 'not json' ELSE props END AS j FROM events),
m AS (SELECT unnest(CASE event_id % 4 WHEN 0 THEN ['k', 'b'] WHEN 1 THEN ['a', 'b'] WHEN 2 THEN ['k', 'a', 'b'] ELSE list_filter(['k', 'a', 'b'], lambda x: NOT list_contains(json_keys(j), x)) END) AS field FROM e)
SELECT field, count(*) AS records FROM m GROUP BY 1""")
def schema_drift_missing_fields(spark, sf_dir):
    k = F.col("event_id") % 4
    e = table(spark, sf_dir, "events").withColumn("j", F.when(k == 0, '{"a": 1}').when(k == 1, '{"k": 2, "extra": 3}').when(k == 2, "not json").otherwise(F.col("props")))
    return drift.drift_report(e, "j", ["k", "a", "b"])


@query("fingerprint_changes", """
WITH f AS (SELECT p_brand, array_to_string(list(CAST(p_partkey AS VARCHAR) || chr(1) || p_name ORDER BY p_partkey), chr(2)) AS a,
  array_to_string(list(CAST(p_partkey AS VARCHAR) || chr(1) || CASE WHEN p_partkey % 97 = 0 THEN 'renamed' ELSE p_name END ORDER BY p_partkey), chr(2)) AS b, count(*) AS files FROM part GROUP BY 1)
SELECT p_brand, sha256(a) AS fingerprint, files, sha256(a) <> sha256(b) AS changed FROM f""")
def fingerprint_changes(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", "p_name", F.when(F.col("p_partkey") % 97 == 0, "renamed").otherwise(F.col("p_name")).alias("now"))
    before = drift.fingerprint(p, "p_brand", [F.col("p_partkey")], "p_partkey", "p_name")
    after = drift.fingerprint(p, "p_brand", [F.col("p_partkey")], "p_partkey", "now").select("p_brand", F.col("fingerprint").alias("f"))
    return before.join(after, "p_brand").select("p_brand", "fingerprint", "files", (F.col("fingerprint") != F.col("f")).alias("changed"))


@query("completeness_gate", """
WITH c AS (SELECT o_orderkey % 200 AS event, count(*) FILTER (WHERE o_orderstatus <> 'P' AND o_orderkey % 200 <> 7) AS listed, count(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderkey % 200 <> 7) AS captured, CASE WHEN o_orderkey % 200 % 3 = 0 THEN 30 END AS held FROM orders GROUP BY ALL)
SELECT event, CAST(listed AS BIGINT) AS listed, CAST(captured AS BIGINT) AS captured, CASE WHEN listed = 0 THEN 'refuse_empty' WHEN captured < listed * 0.5 THEN 'refuse_partial' WHEN captured < coalesce(held, 0) THEN 'refuse_shrink' WHEN captured < listed THEN 'archive_with_gap' ELSE 'archive' END AS verdict FROM c""")
def completeness_gate(spark, sf_dir):
    o = table(spark, sf_dir, "orders").withColumn("event", F.col("o_orderkey") % 200)
    seen = F.col("event") != 7
    c = o.groupBy("event").agg(F.count_if((F.col("o_orderstatus") != "P") & seen).alias("listed"), F.count_if((F.col("o_orderstatus") == "F") & seen).alias("captured"))
    return drift.gate(c.withColumn("held", F.when(F.col("event") % 3 == 0, 30))).drop("held")


@query("listing_collisions", "SELECT p_brand, p_size, p_partkey, p_partkey <> min(p_partkey) OVER (PARTITION BY p_brand, p_size) AS collided FROM part")
def listing_collisions(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_size", "p_partkey")
    first, rest = drift.first_of_key(p, ["p_brand", "p_size"], F.col("p_partkey"))
    return first.withColumn("collided", F.lit(False)).unionByName(rest.withColumn("collided", F.lit(True)))


@query("pick_unclaimed", "SELECT min(p_partkey) AS p_partkey FROM part WHERE p_brand = 'Brand#11' AND p_partkey % 2 <> 0")
def pick_unclaimed(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("name"), F.col("p_partkey").cast("string").alias("handle"))
    return drift.pick_unclaimed(p, "Brand#11", p.filter("p_partkey % 2 = 0"), "p_partkey").select("p_partkey")


@query("rejected_labels", "SELECT count(*) AS labels, CAST(count(*) FILTER (WHERE p_partkey % 5 IN (1, 3, 4)) AS BIGINT) AS rejected FROM part")
def rejected_labels(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.expr(scalars._LABELS).alias("name"))
    return p.agg(F.count("*").alias("labels"), F.count_if(~listing.is_document_name(F.col("name"))).alias("rejected"))


@query("unique_names", """
WITH p AS (SELECT p_brand, p_partkey, concat('f', p_size % 5, '.pdf') AS name FROM part)
SELECT *, CASE row_number() OVER w WHEN 1 THEN name ELSE concat(substr(name, 1, length(name) - 4), '_', row_number() OVER w, '.pdf') END AS unique_name FROM p WINDOW w AS (PARTITION BY p_brand, name ORDER BY p_partkey)""")
def unique_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_brand", "p_partkey", F.concat(F.lit("f"), (F.col("p_size") % 5).cast("string"), F.lit(".pdf")).alias("name"))
    return batches.unique_names(p, "p_brand", "p_partkey", "name")


#: A batch is load * 10^7 + documents * 10 + number: the least of them is next.
@query("size_balanced_batches", """
WITH RECURSIVE r AS (SELECT doc_id, source, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS k FROM documents),
g AS (SELECT CAST(1 AS BIGINT) AS k, source, CAST(NULL AS BIGINT) AS doc_id, CAST(NULL AS BIGINT) AS n_chars, CAST(0 AS INTEGER) AS batch, CAST([0, 1, 2, 3, 4] AS BIGINT[]) AS h FROM (SELECT DISTINCT source FROM documents)
  UNION ALL SELECT g.k + 1, g.source, r.doc_id, r.n_chars, CAST(list_min(h) % 10 AS INTEGER), list_transform(h, lambda x: CASE WHEN x = list_min(h) THEN x + least(r.n_chars, 80000) * 10000000 + 10 ELSE x END)
  FROM g JOIN r ON r.source IS NOT DISTINCT FROM g.source AND r.k = g.k)
SELECT source, doc_id, n_chars, batch FROM g WHERE doc_id IS NOT NULL""")
def size_balanced_batches(spark, sf_dir):
    return batches.size_balanced(table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars"), "doc_id", "n_chars", 5, "source")


@query("snapshot_probes", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 6")
def snapshot_probes(spark, sf_dir):
    return batches.probes(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars")


@query("snapshot_ids", "SELECT doc_id, substr(sha256('7:' || doc_id), 1, 12) AS opaque FROM documents WHERE n_chars >= 200")
def snapshot_ids(spark, sf_dir):
    return batches.snapshot(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id", "n_chars", 200, "7").select("doc_id", "opaque")


@query("nonnull_parquet_roundtrip", "SELECT n_nationkey, n_name, CAST(NULL AS VARCHAR) AS note FROM nation")
def nonnull_parquet_roundtrip(spark, sf_dir):
    """A column that is all null keeps its declared type through the Parquet export."""
    from ..export import tabular
    from ..streaming.upsert import shared_root

    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit(None).cast("string").alias("note"))
    return tabular.read_back(spark, tabular.write_parquet({"nation": n}, shared_root(spark))["nation"])


@query("csv_export_roundtrip", "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS n_name FROM nation")
def csv_export_roundtrip(spark, sf_dir):
    from ..export import tabular
    from ..streaming.upsert import shared_root

    n = table(spark, sf_dir, "nation").select("n_nationkey", F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("n_name"))
    path = tabular.write_csv({"nation": n}, shared_root(spark))["nation"]
    return spark.read.csv(path, header=True)

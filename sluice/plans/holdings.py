"""Keyed tables, feeds in their order, bundles, captures, zips and publishing over the driver's tables."""

from __future__ import annotations

import zipfile

from pyspark.sql import functions as F

from ..functions import suppliers
from ..keyed import KeyedTable
from ..session import table
from ..streaming.upsert import shared_root
from .merges import ORACLES as MERGES
from .merges import _arriving
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles


@query("keyed_upserts", """
WITH held AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS total, o_orderpriority AS priority FROM orders),
late AS (SELECT c_custkey AS o_orderkey, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal END AS total, c_mktsegment AS segment FROM customer)
SELECT o_orderkey, coalesce(late.total, held.total) AS total, held.priority, late.segment FROM held FULL JOIN late USING (o_orderkey)""")
def keyed_upserts(spark, sf_dir):
    """A table in buckets, then a batch merged into those it touches: nulls never erase, new columns heal."""
    from ..operators import merge

    keys = ["o_orderkey"]
    t = KeyedTable(spark, f"{shared_root(spark)}/orders", keys, buckets=64)
    t.replace(table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("total"), F.col("o_orderpriority").alias("priority")))
    late = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_orderkey"), F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal")).alias("total"), F.col("c_mktsegment").alias("segment"))
    t.change(late, lambda old, new: merge.merge_upsert(old, new, keys, F.lit(0)))
    return t.read()


@query("feed_arrival_order", "SELECT user_id, arg_max(title, event_id) AS title, count(*) AS n FROM (SELECT user_id, event_id, concat(CASE WHEN event_id % 2 = 0 THEN 'a newer ' ELSE 'Z ' END, 1000000 - event_id) AS title FROM events) GROUP BY 1")
def feed_arrival_order(spark, sf_dir):
    """A landed feed that names a key many times: the record that came last wins, whatever its text."""
    from ..operators import merge
    from ..sources import rest

    e = table(spark, sf_dir, "events").repartitionByRange("event_id").sortWithinPartitions("event_id")
    folder = f"{shared_root(spark)}/feed"
    records = e.select("user_id", F.concat(F.when(F.col("event_id") % 2 == 0, "a newer ").otherwise("Z "), F.lit(1000000) - F.col("event_id")).alias("title"))
    rest.land(records, folder)
    raw = rest.landed(spark, folder, "user_id long, title string")
    n = raw.groupBy("user_id").agg(F.count("*").alias("n"))
    return merge.fold_batch(raw, ["user_id"], F.col("_arrival")).select("user_id", "title").join(n, "user_id")


@query("stream_latest_events", MERGES["merge_overwrite_events"])
def stream_latest_events(spark, sf_dir):
    """Late and null updates as keyed state of a stream, in several batches."""
    from ..streaming.latest import latest_into

    events, root = _arriving(spark, sf_dir), shared_root(spark)
    events.repartition(3, "event_id").write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
    held, running = latest_into(stream, ["user_id"], "event_id", root)
    running.awaitTermination()
    return held.read().select("user_id", "value", "event_type")


def _bundle(key: int, version: int) -> bytes:
    """Kinds by key: nested, broken, flat, whole once and broken later."""
    import io

    kind, out = key % 4, io.BytesIO()
    if kind == 1 or (kind == 3 and version == 2):
        return b"not a zip"
    with zipfile.ZipFile(out, "w") as z:
        if kind == 0:
            inner = io.BytesIO()
            with zipfile.ZipFile(inner, "w") as y:
                y.writestr("b.txt", b"b" * version)
            z.writestr("a.txt", b"a" * (key % 5 + 1))
            z.writestr("in.zip", inner.getvalue())
        elif kind == 2:
            for i in range(key % 3 + version):
                z.writestr(f"f{i}.txt", b"f" * (i + 1))
        else:
            z.writestr("x.txt", b"xx")
    return out.getvalue()


def _files(spark, sf_dir, version):
    """A bundle a supplier; in version 2 kinds 0, 2 and 3 have changed."""
    make = F.udf(lambda k, v: bytearray(_bundle(k, v)), "binary")
    s = table(spark, sf_dir, "supplier")
    content = make("s_suppkey", F.lit(version)).alias("content")
    return s.select(F.concat(F.lit("/in/Doc"), F.lit(2243000000) + F.col("s_suppkey"), F.lit(".zip")).alias("path"), F.lit(version).cast("timestamp").alias("modificationTime"), F.lit(0).cast("long").alias("length"), content)


def _ingested(spark, sf_dir):
    from ..sources.bundles import Bundles

    b = Bundles.at(spark, shared_root(spark))
    for version in (1, 2, 2):
        b.ingest(_files(spark, sf_dir, version))
    return b


@query("bundle_ingest", """
WITH s AS (SELECT s_suppkey AS k, CAST(2243000000 + s_suppkey AS VARCHAR) AS document_number FROM supplier)
SELECT document_number, 'a.txt' AS path, (k % 5 + 1)::BIGINT AS file_size FROM s WHERE k % 4 = 0
UNION ALL SELECT document_number, 'in.zip/b.txt', 2 FROM s WHERE k % 4 = 0
UNION ALL SELECT document_number, 'f' || i || '.txt', i + 1 FROM s, range(4) r(i) WHERE k % 4 = 2 AND i < k % 3 + 2
UNION ALL SELECT document_number, 'x.txt', 2 FROM s WHERE k % 4 = 3""")
def bundle_ingest(spark, sf_dir):
    """Changed bundles replace their documents' leaves, broken ones leave what there was."""
    return _ingested(spark, sf_dir).index.read().select("document_number", "path", "file_size")


@query("bundle_status", """
SELECT CAST(2243000000 + s_suppkey AS VARCHAR) AS document_number, CASE s_suppkey % 4 WHEN 0 THEN 2 WHEN 2 THEN s_suppkey % 3 + 2 ELSE 0 END::BIGINT AS n_files, s_suppkey % 2 = 1 AS broken FROM supplier""")
def bundle_status(spark, sf_dir):
    return _ingested(spark, sf_dir).held.read().select("document_number", "n_files", F.col("error").isNotNull().alias("broken"))


def _captured(spark, sf_dir):
    """Parts as the files of their brands: sizes divisible by 7 fail at first, those by 14 always; one brand's listing changes."""
    from ..sources.capture import Captures

    p = table(spark, sf_dir, "part")
    files = p.select(F.col("p_brand").alias("document_number"), F.concat_ws("/", F.col("p_partkey").cast("string"), F.col("p_size").cast("string")).alias("key"), F.col("p_name").alias("name"))

    def fetch(every):
        def get(document: str, key: str) -> bytes:
            if int(key.split("/")[1]) % every == 0:
                raise OSError("no answer")
            return key.encode()

        return get

    c = Captures(spark, shared_root(spark))
    c.run(files, fetch(7))
    changed = files.withColumn("name", F.when(F.col("document_number") == "Brand#11", F.upper("name")).otherwise(F.col("name")))
    c.run(changed, fetch(14))
    return c


@query("capture_gaps", "SELECT p_brand AS document_number, concat(p_partkey, '/', p_size) AS key, CASE p_brand WHEN 'Brand#11' THEN upper(p_name) ELSE p_name END AS name, 'OSError: no answer' AS reason FROM part WHERE p_size % 14 = 0")
def capture_gaps(spark, sf_dir):
    """What is missing after a second run that fetched only what was owed."""
    return _captured(spark, sf_dir).gap.read()


@query("capture_bundles", "SELECT p_brand AS document_number, count(*) FILTER (p_size % 14 <> 0) AS n_files, count(*) FILTER (p_size % 14 = 0) = 0 AS complete FROM part GROUP BY 1 HAVING count(*) FILTER (p_size % 14 <> 0) > 0")
def capture_bundles(spark, sf_dir):
    return _captured(spark, sf_dir).bundle.read().select("document_number", "n_files", "complete")


@query("zip_roundtrip", "SELECT 'customer' AS member, count(*) AS n, sum(c_custkey)::BIGINT AS keys, count(*) FILTER (c_custkey % 5 = 1) AS returns FROM customer UNION ALL SELECT 'supplier', count(*), sum(s_suppkey)::BIGINT, 0 FROM supplier")
def zip_roundtrip(spark, sf_dir):
    """Tables through a zip of CSV files that tasks deflate; carriage returns and quotes stay."""
    from ..export import zipped

    note = F.when(F.col("c_custkey") % 5 == 1, F.lit('a\r\n"b",c')).alias("note")
    root = shared_root(spark).removeprefix("file://").removeprefix("file:")
    at = zipped.zip_csv({"customer": table(spark, sf_dir, "customer").select("c_custkey", "c_name", note), "supplier": table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")}, f"{root}.zip")

    def read(batches):
        import csv
        import io

        import pandas as pd

        for b in batches:
            for member in b["member"]:
                with zipfile.ZipFile(at) as z, z.open(f"{member}.csv") as f:
                    rows = csv.reader(io.TextIOWrapper(f, newline=""))
                    next(rows)
                    n = keys = returns = 0
                    for row in rows:
                        n, keys, returns = n + 1, keys + int(row[0]), returns + (len(row) > 2 and row[2] == 'a\r\n"b",c')
                yield pd.DataFrame([(member, n, keys, returns)], columns=["member", "n", "keys", "returns"])

    return spark.createDataFrame([("customer",), ("supplier",)], "member string").repartition(2).mapInPandas(read, "member string, n long, keys long, returns long")


@query("publish_retention", """
WITH v AS (SELECT o_orderdate AS made, sum(o_totalprice) AS bytes FROM orders GROUP BY 1)
SELECT made, CASE WHEN made = max(made) OVER () THEN 'newest' WHEN row_number() OVER (PARTITION BY date_trunc('month', made) ORDER BY made) = 1 THEN 'monthly' END AS why FROM v""")
def publish_retention(spark, sf_dir):
    """Each order date as a version of an export: which stay."""
    from ..export.publish import retained

    v = table(spark, sf_dir, "orders").groupBy(F.col("o_orderdate").alias("made")).agg(F.sum("o_totalprice").alias("bytes"))
    return retained(v, "made").select("made", "why")


@query("publish_gate", """
WITH m AS (SELECT o_orderpriority AS name, count(*) FILTER (o_orderdate < TIMESTAMP '1996-01-01') AS before, count(*) FILTER (o_orderstatus = 'F') AS bytes FROM orders GROUP BY 1)
SELECT name, bytes, before, bytes > 0 AND bytes >= 0.9 * before AS ok FROM m""")
def publish_gate(spark, sf_dir):
    """Counts by priority as the sizes of assets: those that shrank hold an export back."""
    from ..export.publish import gate

    o = table(spark, sf_dir, "orders")
    old = o.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count_if(F.col("o_orderdate") < "1996-01-01").alias("bytes"))
    new = o.groupBy(F.col("o_orderpriority").alias("name")).agg(F.count_if(F.col("o_orderstatus") == "F").alias("bytes"))
    return gate(new, old, 0.9)


@query("similar_names_join")
def similar_names_join(spark, sf_dir):
    """Misspelt names of parts beside those as written: all pairs at 0.88 or more, by a join on pieces."""
    p = table(spark, sf_dir, "part")
    name = F.lower(F.concat_ws(" ", "p_name", "p_type", "p_brand"))
    wrong = F.when(F.col("p_partkey") % 3 == 0, F.replace(name, F.lit("widget"), F.lit("wigdet"))).when(F.col("p_partkey") % 3 == 1, F.concat(name, F.lit(" co"))).otherwise(F.substring(name, 2, 100))
    return suppliers.similar_names(p.select(wrong.alias("name")), p.select(name.alias("label")))


@query("meeting_terms", """
WITH RECURSIVE probe AS (SELECT DISTINCT c_nationkey AS t, c_custkey // 25 + 1 AS n, 2000 + c_custkey // 400 AS y FROM customer), hi AS (SELECT t, max(n) AS hi FROM probe GROUP BY 1),
w AS (SELECT t, hi, 0::BIGINT AS n, 2000::BIGINT AS year, 0 AS missed, 0 AS found FROM hi
  UNION ALL SELECT w.t, hi, w.n + 1, coalesce(p.y, w.year), CASE WHEN p.y IS NULL THEN missed + 1 ELSE 0 END, found + (p.y IS NOT NULL)::INTEGER
  FROM w LEFT JOIN probe p ON p.t = w.t AND p.n = w.n + 1 AND p.y IN (w.year, w.year + 1) WHERE w.n < hi AND missed < 2)
SELECT CAST(t AS VARCHAR) AS term, year::INTEGER AS year, n::INTEGER AS last, missed >= 2 AS over, found AS n_found FROM w QUALIFY row_number() OVER (PARTITION BY t ORDER BY n DESC) = 1""")
def meeting_terms(spark, sf_dir):
    """Customers of a nation as its meetings: two numbers in a row without one end a term; the year advances by one at a time."""
    from ..sources.discovery import meetings

    c = table(spark, sf_dir, "customer")
    log = c.select(F.col("c_nationkey").cast("string").alias("term"), F.floor(F.col("c_custkey") / 25 + 1).cast("int").alias("number"), F.floor(2000 + F.col("c_custkey") / 400).cast("int").alias("year"), F.lit(True).alias("found"))
    terms = log.select("term").distinct().withColumns({"first": F.lit(1), "first_year": F.lit(2000)})
    return meetings(log, terms, misses=2).select("term", "year", "last", "over", F.size("found").alias("n_found"))


_TRUTH = """
WITH truth AS (SELECT DISTINCT l_orderkey AS id, lower(l_returnflag) AS s, l_linestatus AS c FROM lineitem),
found AS (SELECT l_orderkey AS id, lower(l_returnflag) AS s, l_linestatus AS c FROM lineitem WHERE l_quantity > 10 UNION SELECT o_orderkey, 'extra', 'F' FROM orders WHERE o_orderkey % 2 = 0),
docs AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 5 = 0 THEN 'not_in_db' WHEN o_orderkey % 3 = 0 THEN 'not_extracted' ELSE 'compared' END AS status FROM orders),
t AS (SELECT id, count(*) AS gt FROM truth GROUP BY 1), f AS (SELECT id, count(*) AS n FROM found GROUP BY 1), b AS (SELECT id, count(*) AS tp FROM truth JOIN found USING (id, s, c) GROUP BY 1),
r AS (SELECT id, status, CASE WHEN status = 'compared' THEN coalesce(gt, 0) END AS gt_count, CASE WHEN status = 'compared' THEN coalesce(tp, 0) END AS tp, CASE WHEN status = 'compared' THEN coalesce(gt, 0) - coalesce(tp, 0) END AS fn, CASE WHEN status = 'compared' THEN coalesce(n, 0) - coalesce(tp, 0) END AS fp
  FROM docs LEFT JOIN t USING (id) LEFT JOIN f USING (id) LEFT JOIN b USING (id))"""


def _against_truth(spark, sf_dir):
    from ..operators.evaluate import against_truth

    o, line = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    read = line.groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_list(F.struct(F.col("l_returnflag").alias("company"), F.col("l_linestatus").alias("contract"))).alias("entries"))
    truth = o.select(F.col("o_orderkey").alias("id"), F.concat(F.lit("u"), "o_orderkey").alias("url"), F.lit(False).alias("none_present")).join(read, "id", "left")
    documents = o.filter("o_orderkey % 5 <> 0").select(F.concat(F.lit("u"), "o_orderkey").alias("url"), F.concat(F.lit("s"), "o_orderkey").alias("sha256"))
    bids = line.filter("l_quantity > 10").select("l_orderkey", "l_linestatus", F.struct(F.concat(F.lit(" "), F.upper("l_returnflag"), F.lit("  ")).alias("supplier_name")).alias("b"))
    contracts = bids.groupBy("l_orderkey", "l_linestatus").agg(F.struct(F.col("l_linestatus").alias("reference"), F.collect_list("b").alias("bids")).alias("c")).groupBy("l_orderkey").agg(F.collect_list("c").alias("cs"))
    award = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.array(F.struct(F.lit("F").alias("reference"), F.array(F.struct(F.lit("Extra").alias("supplier_name"))).alias("awards"))))).otherwise("[]")
    both = o.join(contracts, F.col("l_orderkey") == F.col("o_orderkey"), "left").select("o_orderkey", F.coalesce(F.to_json("cs"), F.lit("[]")).alias("a"), award.alias("b"))
    inner = lambda c: F.substring(c, F.lit(2), F.length(c) - 2)
    joined = F.concat_ws(",", F.nullif(inner(F.col("a")), F.lit("")), F.nullif(inner(F.col("b")), F.lit("")))
    cache = both.filter("o_orderkey % 3 <> 0").select(F.concat(F.lit("s"), "o_orderkey").alias("sha256"), F.lit("v1").alias("extractor_version"), F.concat(F.lit('{"contracts":['), joined, F.lit("]}")).alias("result_json"))
    return against_truth(truth, documents, cache, "v1")


@query("ground_truth_report", _TRUTH + " SELECT id, status, gt_count, tp, fn, fp, CASE WHEN status = 'compared' THEN coalesce(tp / nullif(gt_count, 0), 1.0) END AS recall FROM r")
def ground_truth_report(spark, sf_dir):
    return _against_truth(spark, sf_dir).select("id", "status", "gt_count", "tp", "fn", "fp", "recall")


@query("ground_truth_summary", _TRUTH + " SELECT count(*) AS compared, sum(gt_count)::BIGINT AS total_gt, sum(tp)::BIGINT AS tp, sum(fn)::BIGINT AS fn, sum(fp)::BIGINT AS fp, sum(tp) / sum(gt_count) AS recall, sum(tp) / (sum(tp) + sum(fp)) AS precision FROM r WHERE status = 'compared'")
def ground_truth_summary(spark, sf_dir):
    from ..operators.evaluate import truth_summary

    return truth_summary(_against_truth(spark, sf_dir))

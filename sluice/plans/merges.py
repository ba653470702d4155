"""Merges, rebuilds, healing, cache and ledger over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ledger, merge
from ..schemas import TABLES
from ..session import table
from .registry import Family

query = Family()
QUERIES, ORACLES = query.queries, query.oracles


def _arriving(spark, sf_dir):
    """events as records that arrive: every third value is unknown."""
    e = table(spark, sf_dir, "events")
    return e.select("user_id", "event_id", F.when(F.col("event_id") % 3 != 0, F.col("value")).alias("value"), F.when(F.col("event_id") % 5 != 0, F.col("event_type")).alias("event_type"))


_ARRIVING = "SELECT user_id, event_id, CASE WHEN event_id % 3 <> 0 THEN value END AS value, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event_type FROM events"


@query("merge_overwrite_events", f"SELECT user_id, arg_max(value, event_id) FILTER (WHERE value IS NOT NULL) AS value, arg_max(event_type, event_id) FILTER (WHERE event_type IS NOT NULL) AS event_type FROM ({_ARRIVING}) GROUP BY 1")
def merge_overwrite_events(spark, sf_dir):
    return merge.fold_batch(_arriving(spark, sf_dir), ["user_id"], F.col("event_id"), "overwrite").select("user_id", "value", "event_type")


@query("merge_backfill_events", f"SELECT user_id, arg_min(value, event_id) FILTER (WHERE value IS NOT NULL) AS value, arg_min(event_type, event_id) FILTER (WHERE event_type IS NOT NULL) AS event_type FROM ({_ARRIVING}) GROUP BY 1")
def merge_backfill_events(spark, sf_dir):
    return merge.fold_batch(_arriving(spark, sf_dir), ["user_id"], F.col("event_id"), "backfill").select("user_id", "value", "event_type")


def _spine(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("total"), F.col("o_orderpriority").alias("priority"))


@query("merge_spine_then_backfill", """
WITH s AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS total, o_orderpriority AS priority FROM orders),
l AS (SELECT l_orderkey AS o_orderkey, arg_min(l_extendedprice, ROW(l_linenumber, l_partkey, l_extendedprice, l_returnflag)) AS total, arg_min(l_returnflag, ROW(l_linenumber, l_partkey, l_extendedprice, l_returnflag)) AS flag FROM lineitem GROUP BY 1)
SELECT o_orderkey, coalesce(s.total, l.total) AS total, s.priority, l.flag FROM s FULL JOIN l USING (o_orderkey)""")
def merge_spine_then_backfill(spark, sf_dir):
    """Line numbers repeat within an order, so more columns make the order of arrival total."""
    arrival = F.struct("l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("total"), F.col("l_returnflag").alias("flag"), arrival.alias("_seq0"))
    return merge.merge_upsert(_spine(spark, sf_dir), lines, ["o_orderkey"], F.col("_seq0"), "backfill").drop("_seq0")


@query("merge_null_key_parts", """
WITH b AS (SELECT nullif(l_returnflag, 'N') AS flag, l_linestatus AS status, l_quantity AS quantity, l_orderkey * 10 + l_linenumber AS seq, l_partkey FROM lineitem
  UNION ALL SELECT '', l_linestatus, NULL, 0, 0 FROM lineitem WHERE l_linenumber = 1)
SELECT coalesce(flag, '') AS flag_key, status, arg_max(quantity, seq * 1000000 + l_partkey) FILTER (WHERE quantity IS NOT NULL) AS quantity FROM b GROUP BY 1, 2""")
def merge_null_key_parts(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem")
    seq = ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1000000 + F.col("l_partkey")).alias("seq")
    batch = line.select(F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_quantity").alias("quantity"), seq)
    blank = line.filter("l_linenumber = 1").select(F.lit("").alias("flag"), F.col("l_linestatus").alias("status"), F.lit(None).cast("double").alias("quantity"), F.lit(0).cast("long").alias("seq"))
    folded = merge.fold_batch(batch.unionByName(blank), ["flag", "status"], F.col("seq"), "overwrite", nullable=("flag",))
    return folded.select(F.coalesce("flag", F.lit("")).alias("flag_key"), "status", "quantity")


def _violations(spark, sf_dir, mode: str):
    batch = _arriving(spark, sf_dir)
    target = batch.filter("user_id % 2 = 0").select("user_id", "value", "event_type").groupBy("user_id").agg(F.min("value").alias("value"), F.min("event_type").alias("event_type"))
    once = merge.merge_upsert(target, batch.withColumnRenamed("event_id", "_s"), ["user_id"], F.col("_s"), mode).drop("_s")
    twice = merge.merge_upsert(once, batch.withColumnRenamed("event_id", "_s"), ["user_id"], F.col("_s"), mode).drop("_s")
    return once.exceptAll(twice).agg(F.count("*").alias("violations")).withColumn("mode", F.lit(mode))


@query("merge_idempotence_violations", "SELECT * FROM (VALUES (CAST(0 AS BIGINT), 'overwrite'), (CAST(0 AS BIGINT), 'backfill')) t(violations, mode)")
def merge_idempotence_violations(spark, sf_dir):
    return _violations(spark, sf_dir, "overwrite").unionByName(_violations(spark, sf_dir, "backfill"))


@query("merge_row_metrics", "SELECT CAST(count(*) FILTER (WHERE o_orderkey % 2 = 0) AS BIGINT) AS rows_before, count(*) AS rows_after, CAST(count(*) FILTER (WHERE o_orderkey % 2 <> 0) AS BIGINT) AS rows_added FROM orders")
def merge_row_metrics(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    before = o.filter("o_orderkey % 2 = 0")
    return merge.merge_metrics(before, merge.merge_upsert(before, o, ["o_orderkey"], F.col("o_totalprice")), ["o_orderkey"])


_AWARDS = "SELECT o_orderkey, o_orderpriority AS source, o_totalprice AS amount FROM orders"


@query("rebuild_by_source", f"""
WITH t AS ({_AWARDS}), fresh AS (SELECT o_orderkey, source, -amount AS amount FROM t WHERE source IN ('1-URGENT', '5-LOW') AND o_orderkey % 3 = 0)
SELECT * FROM t WHERE source NOT IN (SELECT source FROM fresh) UNION ALL SELECT * FROM fresh""")
def rebuild_by_source(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("source"), F.col("o_totalprice").alias("amount"))
    fresh = t.filter(F.col("source").isin("1-URGENT", "5-LOW") & (F.col("o_orderkey") % 3 == 0)).withColumn("amount", -F.col("amount"))
    return merge.rebuild_by_source(t, fresh)


@query("rebuild_empty_is_noop", _AWARDS)
def rebuild_empty_is_noop(spark, sf_dir):
    t = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("source"), F.col("o_totalprice").alias("amount"))
    return merge.rebuild_by_source(t, t.filter("false"))


@query("prune_unheld_rows", "SELECT event_id FROM events WHERE NOT (event_id % 7 = 0 AND event_type = (SELECT min(event_type) FROM events))")
def prune_unheld_rows(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type")
    first = e.agg(F.min("event_type").alias("event_type"))
    stale = e.filter("event_id % 7 = 0").join(first, "event_type", "left_semi")
    return merge.prune(e, stale, ["event_id"]).select("event_id")


@query("schema_heal", "SELECT CAST(s_suppkey AS VARCHAR) AS slug, s_name AS name, CAST(NULL AS INTEGER) AS partnered, CAST(s_acctbal AS DOUBLE) AS funding_share, s_nationkey AS extra FROM supplier")
def schema_heal(spark, sf_dir):
    old = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("slug"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("funding_share"), F.col("s_nationkey").alias("extra"))
    return merge.heal(old, TABLES["buyer"]).select("slug", "name", "partnered", "funding_share", "extra")


@query("title_cleanup_update", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_name END AS title FROM part")
def title_cleanup_update(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("Doc"), F.col("p_partkey"))).otherwise(F.col("p_name")).alias("title"))
    from ..functions.titles import is_placeholder_title

    return merge.update_where(p, is_placeholder_title(F.col("title")), title=F.lit(None).cast("string"))


@query("extraction_cache_put", "SELECT sha256, extractor_version, result_json FROM (SELECT sha256(text) AS sha256, 'v1' AS extractor_version, max(CAST(doc_id AS VARCHAR)) AS result_json FROM documents GROUP BY 1)")
def extraction_cache_put(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("sha256"), F.lit("v1").alias("extractor_version"), F.col("doc_id").cast("string").alias("result_json"))
    empty = d.filter("false")
    return merge.merge_upsert(empty, d, ["sha256", "extractor_version"], F.col("result_json"))


def _ledger(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    status = F.when(F.col("event_id") % 4 == 0, "failed").when(F.col("event_id") % 9 == 0, "running").otherwise("ok")
    return e.select(F.col("event_id").alias("id"), F.col("event_type").alias("source"), status.alias("status"), F.col("user_id").alias("rows_fetched"), (F.col("user_id") - 1).alias("rows_upserted"), F.when(F.col("event_id") % 4 == 0, "timed out").alias("error"))


_LEDGER = "SELECT event_id AS id, event_type AS source, CASE WHEN event_id % 4 = 0 THEN 'failed' WHEN event_id % 9 = 0 THEN 'running' ELSE 'ok' END AS status, user_id AS rows_fetched, user_id - 1 AS rows_upserted, CASE WHEN event_id % 4 = 0 THEN 'timed out' END AS error FROM events"


@query("last_run_per_source", f"WITH l AS ({_LEDGER}) SELECT source, id, status, rows_fetched, rows_upserted, error FROM l WHERE id IN (SELECT max(id) FROM l GROUP BY source)")
def last_run_per_source(spark, sf_dir):
    return ledger.last_runs(_ledger(spark, sf_dir))


@query("runs_since", f"SELECT id, source, status, rows_fetched, rows_upserted, error FROM ({_LEDGER}) WHERE id > (SELECT coalesce(max(event_id), 0) // 2 FROM events)")
def runs_since(spark, sf_dir):
    runs = _ledger(spark, sf_dir)
    after = runs.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"] // 2
    return ledger.runs_since(runs, after)


@query("step_summary", f"SELECT count(*) AS steps, CAST(count(*) FILTER (WHERE status = 'ok') AS BIGINT) AS ok, CAST(count(*) FILTER (WHERE status = 'failed') AS BIGINT) AS failed, CAST(count(*) FILTER (WHERE status NOT IN ('ok', 'failed')) AS BIGINT) AS other FROM ({_LEDGER})")
def step_summary(spark, sf_dir):
    return ledger.step_summary(_ledger(spark, sf_dir))


@query("growth_delta", """
WITH b AS (SELECT event_type AS table_name, count(*) AS n FROM events WHERE event_id % 2 = 0 GROUP BY 1 UNION ALL SELECT 'steady', 5),
a AS (SELECT event_type AS table_name, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'steady', 5 UNION ALL SELECT 'sync_run', 99)
SELECT table_name, CAST(coalesce(a.n, 0) - coalesce(b.n, 0) AS BIGINT) AS delta FROM a FULL JOIN b USING (table_name) WHERE table_name <> 'sync_run' AND coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def growth_delta(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumnRenamed("event_type", "table_name")
    fixed = lambda name, n: spark.range(1).select(F.lit(name).alias("table_name"), F.lit(n).cast("long").alias("n"))
    counts = lambda d: d.groupBy("table_name").agg(F.count("*").alias("n"))
    before = counts(e.filter("event_id % 2 = 0")).unionByName(fixed("steady", 5))
    after = counts(e).unionByName(fixed("steady", 5)).unionByName(fixed("sync_run", 99))
    return ledger.growth(before, after)


@query("stream_upsert_events", ORACLES["merge_overwrite_events"])
def stream_upsert_events(spark, sf_dir):
    from ..streaming.upsert import replay_upsert

    events = _arriving(spark, sf_dir)
    return replay_upsert(events, ["user_id"], "event_id").select("user_id", "value", "event_type")

"""The run ledger, growth between runs, and the extraction cache."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def last_runs(ledger: DataFrame) -> DataFrame:
    """The latest run of each source, whole."""
    return ledger.groupBy("source").agg(F.max_by(F.struct(*[c for c in ledger.columns if c != "source"]), "id").alias("r")).select("source", "r.*")


def runs_since(ledger: DataFrame, after_id: int) -> DataFrame:
    return ledger.filter(F.col("id") > after_id).select("id", "source", "status", "rows_fetched", "rows_upserted", "error")


def step_summary(steps: DataFrame) -> DataFrame:
    """Counts by outcome of (source, status)."""
    status = F.col("status")
    return steps.agg(F.count("*").alias("steps"), F.count_if(status == "ok").alias("ok"), F.count_if(status == "failed").alias("failed"), F.count_if(~status.isin("ok", "failed")).alias("other"))


def growth(before: DataFrame, after: DataFrame, skip: tuple[str, ...] = ("sync_run",)) -> DataFrame:
    """(table_name, delta) of counts (table_name, n) that changed; nothing to tell against an
    empty past."""
    b, a = before.select("table_name", F.col("n").alias("_b")), after.select("table_name", F.col("n").alias("_a"))
    delta = a.join(b, "table_name", "full_outer").filter(~F.col("table_name").isin(*skip)).withColumn("delta", F.coalesce("_a", F.lit(0)) - F.coalesce("_b", F.lit(0)))
    some = b.limit(1).select(F.lit(1).alias("_some"))
    return delta.filter("delta <> 0").join(some).select("table_name", "delta")


def cache_gate(documents: DataFrame, cache: DataFrame, labels: DataFrame, version: str) -> DataFrame:
    """documents (key, sha256, text) with what becomes of each: no_text, skipped (its label says
    no; a missing label passes), cached (this text and version), or to_do."""
    done = cache.filter(F.col("extractor_version") == version).select("sha256").distinct().withColumn("_cached", F.lit(True))
    flags = labels.select("key", F.col("flag").alias("_flag"))
    joined = documents.join(flags, "key", "left").join(done, "sha256", "left")
    gate = F.when(F.coalesce(F.col("text"), F.lit("")) == "", "no_text").when(~F.coalesce("_flag", F.lit(True)), "skipped").when(F.col("_cached"), "cached").otherwise("to_do")
    return joined.withColumn("gate", gate).drop("_flag", "_cached")

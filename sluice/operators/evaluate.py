"""Scores of extracted facts against labels, and votes on documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def name_scores(found: DataFrame, truth: DataFrame, key: str) -> DataFrame:
    """(key, tp, fn, fp) over documents of both sides; each side (key, names array)."""
    f, t = found.select(key, F.col("names").alias("_f")), truth.select(key, F.col("names").alias("_t"))
    return f.join(t, key).select(key, F.size(F.array_intersect("_t", "_f")).alias("tp"), F.size(F.array_except("_t", "_f")).alias("fn"), F.size(F.array_except("_f", "_t")).alias("fp"))


def rates(tp: Column, fn: Column, fp: Column, empty: float | None = None) -> list[Column]:
    """recall and precision; ``empty`` is what an empty denominator gives."""
    recall, precision = F.try_divide(tp, tp + fn), F.try_divide(tp, tp + fp)
    if empty is not None:
        recall, precision = F.coalesce(recall, F.lit(empty)), F.coalesce(precision, F.lit(empty))
    return [recall.alias("recall"), precision.alias("precision")]


def corpus_report(scores: DataFrame, empty: float | None = None) -> DataFrame:
    total = scores.agg(F.count("*").alias("documents"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tp", "fn", "fp")))
    return total.select("*", *rates(F.col("tp"), F.col("fn"), F.col("fp"), empty))


def against_truth(truth: DataFrame, documents: DataFrame, cache: DataFrame, version: str) -> DataFrame:
    """Extractions beside what people read in the same documents: a row a document of truth (id, url, none_present,
    entries: array of (company, contract)). status is not_in_db (no such document), not_extracted, or compared;
    then come the counts over distinct (name, contract), bids and awards alike, recall and precision (1 where there
    is nothing to find or nothing was found), what was missed, and contracts with fewer bids than declared."""
    from ..functions.documents import EXTRACTION, declared_count_flags
    from ..functions.text import fold

    pair = lambda name, contract: F.struct(fold(F.coalesce(name, F.lit(""))).alias("supplier"), F.coalesce(contract, F.lit("")).alias("contract"))
    named = lambda c, kind: F.transform(F.coalesce(c[kind], F.array()), lambda b: pair(b.supplier_name, c.reference))
    held = documents.select("url", "sha256").join(cache.filter(F.col("extractor_version") == version).select("sha256", "result_json"), "sha256", "left")
    joined = truth.join(held.select(F.col("url").alias("_url"), "sha256", F.from_json("result_json", EXTRACTION).alias("_r")), F.col("url") == F.col("_url"), "left")
    status = F.when(F.col("_url").isNull(), "not_in_db").when(F.col("_r").isNull(), "not_extracted").otherwise("compared")
    wanted = F.when(F.coalesce("none_present", F.lit(False)), F.array().cast("array<struct<supplier:string,contract:string>>")).otherwise(F.array_distinct(F.transform(F.coalesce("entries", F.array()), lambda e: pair(e.company, e.contract))))
    contracts = F.coalesce(F.col("_r.contracts"), F.array())
    found = F.array_distinct(F.flatten(F.transform(contracts, lambda c: F.concat(named(c, "bids"), named(c, "awards")))))
    each = joined.withColumns({"status": status, "_t": wanted, "_f": found})
    scored = each.withColumns({"missed": F.array_sort(F.array_except("_t", "_f")), "tp": F.size(F.array_intersect("_t", "_f")).cast("long"), "fp": F.size(F.array_except("_f", "_t")).cast("long")})
    scored = scored.withColumns({"fn": F.size("missed").cast("long"), "gt_count": F.size("_t").cast("long"), "extracted_count": F.size("_f").cast("long"), "count_flags": declared_count_flags(F.col("_r"))})
    kept = ("gt_count", "extracted_count", "tp", "fn", "fp", "missed", "count_flags")
    compared = F.col("status") == "compared"
    out = scored.select("id", "url", "status", *(F.when(compared, F.col(c)).alias(c) for c in kept))
    recall, precision = rates(F.col("tp"), F.col("fn"), F.col("fp"), 1.0)
    return out.select("*", F.when(compared, recall).alias("recall"), F.when(compared, precision).alias("precision"))


def truth_summary(report: DataFrame) -> DataFrame:
    """One row: (compared, total_gt, tp, fn, fp, recall, precision) of against_truth's compared documents."""
    total = report.filter("status = 'compared'").agg(F.count("*").alias("compared"), *(F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("gt_count", "total_gt"), ("tp", "tp"), ("fn", "fn"), ("fp", "fp"))))
    return total.select("*", *rates(F.col("tp"), F.col("fn"), F.col("fp"), 1.0))


def decide(votes: DataFrame, key: str) -> DataFrame:
    """Votes (key, voter, kind, flag, evidence) to one row a document: kind by majority, null if
    disputed; the flag if any vote has it, since a miss costs more than a wasted look; the
    longest evidence of the votes that count (ties: the smallest voter's)."""
    kinds = votes.groupBy(key, "kind").agg(F.count("*").alias("n"))
    top = kinds.groupBy(key).agg(F.sum("n").alias("votes"), F.max("n").alias("top_n"), F.max_by("kind", F.struct("n", "kind")).alias("top"))
    flags = votes.groupBy(key).agg(F.count_if(F.col("flag")).alias("yes"))
    kind = F.when(F.col("top_n") * 2 > F.col("votes"), F.col("top"))
    said = top.join(flags, key).select(
        key, "votes", kind.alias("kind"), F.when(F.col("top_n") == F.col("votes"), "unanimous").when(kind.isNotNull(), "judged").otherwise("disputed").alias("kind_agreement"),
        (F.col("yes") > 0).alias("flag"), F.when(F.col("yes").isin(0) | (F.col("yes") == F.col("votes")), "unanimous").otherwise("or_recovered").alias("flag_agreement"),
    )
    counts = F.when(F.col("_d.flag"), F.col("_v.flag")).otherwise(F.col("_v.kind") == F.col("_d.kind"))
    pool = votes.alias("_v").join(said.alias("_d"), F.col(f"_v.{key}") == F.col(f"_d.{key}"))
    order = F.struct(F.coalesce(counts, F.lit(False)).cast("int").alias("in_pool"), F.length(F.col("_v.evidence")).alias("size"), (-F.col("_v.voter")).alias("first"))
    evidence = pool.groupBy(F.col(f"_d.{key}").alias(key)).agg(F.max_by(F.col("_v.evidence"), order).alias("evidence"))
    return said.join(evidence, key)


def disagreements(votes: DataFrame, key: str) -> DataFrame:
    """Documents whose votes differ in kind or flag."""
    seen = votes.groupBy(key).agg(F.count_distinct("kind").alias("kinds"), F.count_distinct("flag").alias("flags"))
    return seen.filter("kinds > 1 or flags > 1")


def binary_scores(rows: DataFrame, truth: Column, said: Column, by: list[str]) -> DataFrame:
    counted = rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(truth == said).alias("agree"), F.count_if(truth & said).alias("tp"), F.count_if(~truth & said).alias("fp"), F.count_if(truth & ~said).alias("fn"))
    return counted.select(*by, "n", F.try_divide("agree", "n").alias("accuracy"), "tp", "fp", "fn", *rates(F.col("tp"), F.col("fn"), F.col("fp")))


def confusion(rows: DataFrame, truth: str, said: str, values: list[str]) -> DataFrame:
    """The matrix of a known set of classes: a row a true class."""
    counts = [F.count_if(F.col(said) == v).alias(f"said_{v}") for v in values]
    return rows.groupBy(truth).agg(F.count("*").alias("n"), *counts, F.try_divide(F.count_if(F.col(truth) == F.col(said)), F.count("*")).alias("recall"))

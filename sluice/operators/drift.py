"""Schema drift and capture completeness: what a record lacks, what a listing has lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_fields(json: Column, expected: list[str]) -> Column:
    """The declared fields a JSON object lacks, in order; more fields are fine, and what can't be
    read lacks all."""
    want = F.array(*map(F.lit, expected))
    return F.array_except(want, F.coalesce(F.json_object_keys(json), F.array().cast("array<string>")))


def drift_report(records: DataFrame, json: str, expected: list[str], sample: int | None = None) -> DataFrame:
    """(field, records): how often each declared field is missing. ``sample``: look at so many."""
    looked = records if sample is None else records.limit(sample)
    return looked.select(F.explode(missing_fields(F.col(json), expected)).alias("field")).groupBy("field").agg(F.count("*").alias("records"))


def fingerprint(listing: DataFrame, group: str, order: list[Column], key: str, name: str) -> DataFrame:
    """A digest of each group's (key, name) pairs in listing order."""
    rows = F.array_sort(F.collect_list(F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)), F.col(key).alias("k"), F.col(name).alias("n"))))
    pairs = F.transform(rows, lambda r: F.concat_ws("\u0001", r.k, r.n))
    return listing.groupBy(group).agg(F.sha2(F.array_join(pairs, "\u0002"), 256).alias("fingerprint"), F.count("*").alias("files"))


def gate(captures: DataFrame, ratio: float = 0.5) -> DataFrame:
    """captures (listed, captured, held) with a verdict: nothing is archived from an empty listing,
    from under ``ratio`` of one, or in place of a larger bundle."""
    verdict = F.when(F.col("listed") == 0, "refuse_empty").when(F.col("captured") < F.col("listed") * ratio, "refuse_partial").when(F.col("captured") < F.coalesce("held", F.lit(0)), "refuse_shrink").when(F.col("captured") < F.col("listed"), "archive_with_gap").otherwise("archive")
    return captures.withColumn("verdict", verdict)


def first_of_key(rows: DataFrame, key: list[str], order: Column) -> tuple[DataFrame, DataFrame]:
    """(first rows by order, the rows that collided with them)."""
    from pyspark.sql.window import Window

    ranked = rows.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(order)))
    return ranked.filter("_r = 1").drop("_r"), ranked.filter("_r > 1").drop("_r")


def pick_unclaimed(anchors: DataFrame, wanted: str, claimed: DataFrame, order: str) -> DataFrame:
    """The first anchor of a label whose handle nobody has claimed."""
    free = anchors.filter(F.col("name") == wanted).join(claimed.select("handle").filter("handle <> ''"), "handle", "left_anti")
    return free.orderBy(order).limit(1)

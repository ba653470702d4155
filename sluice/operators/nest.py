"""Nesting children under parents; children without a parent are kept apart, never lost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def children(child: DataFrame, key: str, name: str, order: list[str]) -> DataFrame:
    """(key, name): a key's rows as structs, in order. A list has no order of its own."""
    rest = [c for c in child.columns if c not in (*order, key)]
    rows = F.array_sort(F.collect_list(F.struct(*order, *rest)))
    return child.groupBy(key).agg(rows.alias(name))


def nest(parent: DataFrame, child: DataFrame, key: str, child_key: str, name: str, order: list[str]) -> DataFrame:
    """parent with its children in an array, empty where there are none."""
    grouped = children(child, child_key, name, order).withColumnRenamed(child_key, "_ck")
    empty = F.array().cast(grouped.schema[name].dataType)
    return parent.join(grouped, F.col(key) == F.col("_ck"), "left").drop("_ck").withColumn(name, F.coalesce(name, empty))


def unlinked(child: DataFrame, parent: DataFrame, child_key: str, key: str) -> DataFrame:
    """Children whose key is null or names no parent."""
    return child.join(parent.select(F.col(key).alias("_pk")).distinct(), F.col(child_key) == F.col("_pk"), "left_anti")


def route(bids: DataFrame, bridge: DataFrame, items: DataFrame, spine: DataFrame) -> DataFrame:
    """Where a bid goes: its solicitation by document number, else by its reference's bridge;
    its council item; or unlinked. ``bridge``: (reference, document_number), one a reference."""
    b = bridge.select(F.col("reference").alias("_r"), F.col("document_number").alias("_d"))
    i = items.select(F.col("reference").alias("_i")).distinct()
    s = spine.select(F.col("document_number").alias("_s")).distinct()
    found = bids.join(b, F.col("reference") == F.col("_r"), "left").withColumn("bridged", F.coalesce("document_number", "_d"))
    found = found.join(s, F.col("bridged") == F.col("_s"), "left").join(i, F.col("reference") == F.col("_i"), "left")
    place = F.when(F.col("_s").isNotNull(), "solicitation").when(F.col("_i").isNotNull(), "council_item").otherwise("unlinked")
    return found.withColumn("placed", place).drop("_r", "_d", "_s", "_i")


def bridge_of(bids: DataFrame, links: DataFrame) -> DataFrame:
    """(reference, document_number): what bids themselves say, the largest number where they
    differ; links fill in the rest."""
    own = bids.filter("reference is not null and document_number is not null").groupBy("reference").agg(F.max("document_number").alias("own"))
    both = own.join(links.select("reference", F.col("document_number").alias("link")), "reference", "full_outer")
    return both.select("reference", F.coalesce("own", "link").alias("document_number"))


def ordered_first(c: str, by: Column | str) -> Column:
    """The value of the first row by an explicit order."""
    return F.min_by(c, by)

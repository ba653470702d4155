"""The supplier dimension: one row a key, rebuilt from every table that names a supplier."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.suppliers import supplier_key


def names_of(sources: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """(origin, pk, raw) of tables given as name -> (rows, primary key, name column)."""
    parts = [d.select(F.lit(origin).alias("origin"), F.col(pk).cast("string").alias("pk"), F.col(name).alias("raw")) for origin, (d, pk, name) in sources.items()]
    return reduce(DataFrame.unionByName, parts)


def keyed(names: DataFrame) -> DataFrame:
    return names.withColumn("supplier_key", supplier_key(F.col("raw")))


def build(names: DataFrame) -> DataFrame:
    """(supplier_key, supplier_id, display_name, variants): names are keyed once each; the
    smallest variant, by code points, is displayed. Keys that no source holds are gone."""
    distinct = keyed(names.select("raw").distinct()).filter("supplier_key <> ''")
    grouped = distinct.groupBy("supplier_key").agg(F.min("raw").alias("display_name"), F.sort_array(F.collect_set("raw")).alias("variants"))
    return grouped.select("supplier_key", F.xxhash64("supplier_key").alias("supplier_id"), "display_name", "variants")


def backfill(rows: DataFrame, name: str, dimension: DataFrame) -> DataFrame:
    """rows with supplier_id from the dimension, null where the name has no key: ids are always
    set anew, so a stale one cannot stay."""
    d = dimension.select(F.col("supplier_key").alias("_k"), F.col("supplier_id").alias("_id"))
    base = rows.drop("supplier_id").withColumn("_key", supplier_key(F.col(name)))
    return base.join(d, F.col("_key") == F.col("_k"), "left").withColumnRenamed("_id", "supplier_id").drop("_key", "_k")

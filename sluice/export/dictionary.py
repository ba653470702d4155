"""The schema dictionary: declared columns, observed enums, row counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    parts = [d.agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n") for t, d in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def observed_enums(df: DataFrame, columns: list[str], most: int = 64) -> DataFrame:
    """(column_name, observed): a column's distinct non-null values, sorted. One pass over all the
    columns; a column of more than ``most`` values is no enum and shows none."""
    pairs = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("v")) for c in columns))).alias("p")).select("p.*")
    sets = pairs.filter("v is not null").distinct().groupBy("column_name").agg(F.count("*").alias("n"), F.sort_array(F.collect_set("v")).alias("observed"))
    return sets.select("column_name", F.when(F.col("n") <= most, F.col("observed")).alias("observed"))


def schema_rows(spark: SparkSession, tables: dict[str, DataFrame], descriptions: dict[str, str] | None = None) -> DataFrame:
    """(table_name, column_name, position, type, description); a description that names no
    column is an error, so that the dictionary cannot go stale."""
    descriptions = descriptions or {}
    known = {f"{t}.{c}" for t, d in tables.items() for c in d.columns}
    if stale := sorted(descriptions.keys() - known):
        raise ValueError(f"descriptions of unknown columns: {stale}")
    rows = [(t, f.name, i + 1, f.dataType.simpleString(), descriptions.get(f"{t}.{f.name}")) for t, d in tables.items() for i, f in enumerate(d.schema)]
    return spark.createDataFrame(rows, "table_name string, column_name string, position int, type string, description string")


def manifest(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(name, bytes) of the artifacts that exist; the missing are left out."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    rows = []
    for p in paths:
        at = hadoop(p)
        fs = at.getFileSystem(conf)
        if fs.exists(at):
            rows.append((p.rstrip("/").rsplit("/", 1)[-1], fs.getContentSummary(at).getLength()))
    return spark.createDataFrame(rows, "name string, bytes long")

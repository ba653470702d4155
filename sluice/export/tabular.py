"""A file set a table: Parquet with declared types, CSV with nulls as empty fields (zipped: ``zipped``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Columns that aren't published.
PRIVATE = ("text", "result_json")


def published(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c in PRIVATE])


def write_parquet(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    paths = {t: f"{root}/parquet/{t}" for t in tables}
    for t, d in tables.items():
        published(d).write.mode("overwrite").parquet(paths[t])
    return paths


def write_csv(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    paths = {t: f"{root}/csv/{t}" for t in tables}
    for t, d in tables.items():
        published(d).write.mode("overwrite").csv(paths[t], header=True, nullValue="", emptyValue='""')
    return paths


def read_back(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

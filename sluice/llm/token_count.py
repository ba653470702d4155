"""Token counts by the whole-token shortcut.

Offline, the driver proves which vocabulary strings encode alone as one token. On the
executors a text is split into pre-tokens; those proven count one by a look-up, and only
the rest is merged, once for each distinct pre-token while it stays in a worker's bounded cache.
This holds for texts of any script, special strings in them split out first.

A null text counts as empty: no bytes, no tokens. Whole texts, however long. Repeated rows, and rows that
repeat an id or lack one, give a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import arrow_rows, batch, table

VOCABULARY = "byte_bpe_50k.json"


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(docs: DataFrame, key: str, text: str, path: str | None = None, limit: int = 1024) -> DataFrame:
    """key, n_bytes, n_tokens, over_limit of every row."""
    spark = docs.sparkSession
    arrow_rows(spark)
    path = path or vocabulary()
    proof = spark.sparkContext.broadcast(bpe.proof(path))  # bounded by the vocabulary
    schema = pa.schema([("key", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = bpe.counter(path, lambda: proof.value)
        for b in batches:
            n = counter.count(b.column(1).to_pylist())
            yield batch(schema, [b.column(0), b.column(2), n, [x > limit for x in n]])

    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return source.mapInArrow(run, "key long, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("key", key)


def op5_token_counts(spark, sf_dir: str) -> DataFrame:
    """The tokens of every document."""
    return count_tokens(table(spark, sf_dir, "documents"), "doc_id", "text")

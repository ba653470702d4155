"""Idempotent keyed upserts of a stream.

Each micro-batch is folded and merged into a keyed table, of which only the buckets it touches are
rewritten; the commit remembers the batch, so one that is replayed after a crash changes nothing.
Because the fold remembers at which ``seq`` each value came, records that come late change nothing
they should not: late nulls never erase, older values never win.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..keyed import KeyedTable


def folded(batch: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """One row a key; each value as struct(seq, value) of its latest non-null record."""
    columns = [c for c in batch.columns if c not in (*keys, seq)]
    latest = [F.max(F.when(F.col(c).isNotNull(), F.struct(F.col(seq).alias("seq"), F.col(c).alias("v")))).alias(c) for c in columns]
    return batch.groupBy(*keys).agg(*latest)


def plain(state: DataFrame, keys: list[str]) -> DataFrame:
    return state.select(*keys, *(F.col(f"{c}.v").alias(c) for c in state.columns if c not in keys))


def upsert_sink(state: KeyedTable, keys: list[str], seq: str, name: str = "upserts"):
    """A ``foreachBatch`` function that merges each micro-batch into state."""

    def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
        if old is None:
            return new
        both = old.unionByName(new, allowMissingColumns=True)
        return both.groupBy(*keys).agg(*(F.max(c).alias(c) for c in both.columns if c not in keys))

    def run(batch: DataFrame, number: int) -> None:
        batch = folded(batch, keys, seq).persist()  # folded once for its buckets and its rows
        try:
            state.change(batch, merge, stream=(name, number))
        finally:
            batch.unpersist()

    return run


def shared_root(spark: SparkSession) -> str:
    """A new folder's name where all executors can reach it; machine-local only where all run in one JVM."""
    if not (at := spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        at = tempfile.mkdtemp(prefix="sluice-")
        spark.sparkContext.setCheckpointDir(at)
    return f"{at.rstrip('/')}/{uuid.uuid4().hex}"


def upsert_stream(stream: DataFrame, keys: list[str], seq: str, root: str, available_now: bool = True) -> tuple[KeyedTable, object]:
    """Start the upsert of a streaming DataFrame; (the table, the running query)."""
    state = KeyedTable(stream.sparkSession, f"{root}/table", keys)
    writer = stream.writeStream.foreachBatch(upsert_sink(state, keys, seq)).option("checkpointLocation", f"{root}/checkpoint")
    return state, (writer.trigger(availableNow=True) if available_now else writer).start()


def replay_upsert(batch: DataFrame, keys: list[str], seq: str, files: int = 3) -> DataFrame:
    """A batch table run through the stream: landed as files, read one a trigger, merged."""
    spark = batch.sparkSession
    root = shared_root(spark)
    batch.repartition(files).write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/landing")
    state, running = upsert_stream(stream, keys, seq, root)
    running.awaitTermination()
    return plain(state.read(), keys)


def open_events(events: DataFrame, deadline: str, link: str, today) -> DataFrame:
    """Events still open: their deadline isn't past and their link is one we can follow."""
    return events.filter((F.col(deadline) >= today) & F.col(link).ilike("%/rfxevent/preview/%")).orderBy(deadline)


def windowed_counts(stream: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """An extension: counts in tumbling windows; rows later than the watermark are dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window), by).agg(F.count("*").alias("n"))


def replay_counts(batch: DataFrame, time: str, by: str) -> DataFrame:
    """windowed_counts of a batch table landed as one file set and read as a stream."""
    spark = batch.sparkSession
    root = shared_root(spark)
    batch.write.parquet(f"{root}/landing")
    stream = spark.readStream.schema(batch.schema).parquet(f"{root}/landing")
    state = KeyedTable(spark, f"{root}/counts", ["starts", by])
    sink = lambda df, _id: state.put(df.select(F.col("window.start").alias("starts"), by, "n"))
    running = windowed_counts(stream, time, by).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    return state.read().select("starts", by, "n")

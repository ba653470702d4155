"""What the operators of this package share: loading, spooling to the shared folder, words."""

from __future__ import annotations

import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: A word: a run of anything but ASCII white space.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows and bytes of an Arrow batch, so that a batch of long texts fits a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "32m")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share; a temporary one only where none is set and all run in one
    JVM, as in tests."""
    sc = spark.sparkContext
    if not (at := spark.conf.get("spark.checkpoint.dir", "")):
        if not (at := sc.getCheckpointDir() or ""):
            if not sc.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            at = tempfile.mkdtemp(prefix="sluice-")
            sc.setCheckpointDir(at)
    return at.rstrip("/")


def spool(df: DataFrame, name: str = "t") -> DataFrame:
    """Write df to the shared folder and read it back: lineage is cut, and a lost
    executor costs nothing that was spooled. Removed when the JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sluice-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    _SPOOLED.append(path)
    return spark.read.schema(df.schema).parquet(path)


_SPOOLED: list[str] = []


def release(spark: SparkSession) -> int:
    """Remove what was spooled so far, for sessions that live long; results not yet written
    elsewhere are lost with it. The number of tables removed."""
    n = len(_SPOOLED)
    while _SPOOLED:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(_SPOOLED.pop())
        hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)
    return n


def free_name(df: DataFrame, base: str) -> str:
    """A column name that df doesn't have: inputs may carry any extra columns."""
    taken, name = {c.lower() for c in df.columns}, base
    while name.lower() in taken:
        name = f"_{name}"
    return name


def batch(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, type=f.type) for x, f in zip(columns, schema)], schema=schema)


def whole_groups(batches, columns: tuple[str, ...], rows: int = 50_000):
    """Tables of about so many rows, of batches sorted by columns, in which every group is
    whole, each with the number of its row's group. Only the last group is held back."""
    import numpy as np

    def numbered(t: pa.Table):
        new = np.zeros(t.num_rows, np.int64)
        for c in columns:
            x = t[c].to_numpy()
            new[1:] |= x[1:] != x[:-1]
        return np.cumsum(new)

    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        group = numbered(t)
        cut = int(np.searchsorted(group, group[-1]))
        if cut:
            yield t.slice(0, cut), group[:cut]
        held, n = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
    if held:
        t = pa.Table.from_batches(held)
        yield t, numbered(t)

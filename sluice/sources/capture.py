"""Captures: all files of a listing, fetched on the executors, resumable, with a record of what is missing.

A listing names the files of documents. Before anything is fetched, a manifest row says what a document's
listing was (its fingerprint). Files are fetched in waves, a few of them at once; each is kept as soon as it is
fetched, so a run that dies loses the waves under way, and the next one fetches what is still owed. A listing that changed
voids what was captured of the document. Gaps are rows, written before the document's bundle and cleared
only after a complete one: where there is no gap row, nothing is missing.

    manifest  document_number -> fingerprint, n_files, collided
    captured  document_number, key -> fingerprint, name, sha256, size; the bytes lie under blobs/
    gap       document_number -> key, name, reason (as many rows as files are missing)
    bundle    document_number -> fingerprint, n_files, complete

A document that lists nothing is an error and never complete. One of which no file came stays pending.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..keyed import KeyedTable

_OWED = "document_number string, key string, name string, fingerprint string"
_FETCHED = "document_number string, key string, name string, fingerprint string, sha256 string, size long, content binary, error string"


class Captures:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16):
        self.spark, self.root = spark, root.rstrip("/")
        table = lambda name, *keys: KeyedTable(spark, f"{self.root}/{name}", list(keys), buckets=buckets)
        self.manifest, self.captured = table("manifest", "document_number"), table("captured", "document_number", "key")
        self.gap, self.bundle = table("gap", "document_number"), table("bundle", "document_number")

    def _rows(self, table: KeyedTable, ddl: str) -> DataFrame:
        held = table.read()
        return held if held is not None else self.spark.createDataFrame([], ddl)

    def _kept(self, df: DataFrame, at: str) -> DataFrame:
        df.write.parquet(at)
        return self.spark.read.schema(df.schema).parquet(at)

    def once(self, listing: DataFrame) -> DataFrame:
        """(document_number, key, name, n): an entry of the listing and how often it is named."""
        return listing.groupBy("document_number", "key").agg(F.max("name").alias("name"), F.count("*").alias("n"))

    def fingerprints(self, once: DataFrame) -> DataFrame:
        """(document_number, fingerprint, n_files, collided) of a listing's entries: a hash
        that takes no order and no repetition, so a document of any size is no group of its own."""
        one = F.xxhash64("key", "name").cast("decimal(38,0)")
        two = F.xxhash64(F.lit(7), "name", "key").cast("decimal(38,0)")
        mark = F.concat_ws("-", F.count("*"), F.sum(one), F.sum(two))
        return once.groupBy("document_number").agg(mark.alias("fingerprint"), F.count("*").alias("n_files"), F.sum(F.col("n") - 1).alias("collided"))

    def plan(self, listing: DataFrame, at: str) -> DataFrame:
        """Write the manifest of what is new or changed; the documents' listings with their fingerprints. What is made of a
        listing is kept under ``at``, as it is asked for many times."""
        once = self._kept(self.once(listing), f"{at}/once")
        marks = self._kept(self.fingerprints(once), f"{at}/marks")
        held = self._rows(self.manifest, "document_number string, fingerprint string, n_files long, collided long")
        self.manifest.put(marks.join(held.select("document_number", "fingerprint", "collided"), ["document_number", "fingerprint", "collided"], "left_anti"))
        return once.drop("n").join(self.manifest.read().select("document_number", "fingerprint"), "document_number")

    def owed(self, planned: DataFrame) -> DataFrame:
        """What isn't captured under the present fingerprint."""
        held = self._rows(self.captured, "document_number string, key string, name string, fingerprint string, sha256 string, size long")
        return planned.join(held.select("document_number", "key", "fingerprint"), ["document_number", "key", "fingerprint"], "left_anti")

    def run(self, listing: DataFrame, fetch: Callable[[str, str], bytes], wave: int = 10_000, tasks: int = 64, at_once: int = 8) -> int:
        """Capture a listing as far as it goes; the number of files still owed. ``fetch(document_number, key)`` gives
        bytes; what it raises is that file's gap. The ``tasks``, so the most files asked for at one time, are shared by
        ``at_once`` waves: while some fetch, others are kept."""
        at = f"{self.root}/owed/{uuid.uuid4().hex}"
        planned = self.plan(listing, at)
        waves = self._waves(self.owed(planned), wave, f"{at}/files")
        at_once = max(1, min(at_once, tasks))

        def capture(k: int) -> str:
            to = f"{self.root}/blobs/{uuid.uuid4().hex}"
            mine = self.spark.read.schema(_OWED).parquet(f"{at}/files/wave={k}")
            mine.repartition(tasks // at_once, "document_number", "key").mapInArrow(_fetching(fetch), _FETCHED).write.parquet(to)
            self.captured.put(self.spark.read.schema(_FETCHED).parquet(to).drop("content").filter("error IS NULL").drop("error"))
            return to

        with ThreadPoolExecutor(at_once) as pool:
            under_way = [pool.submit(capture, k) for k in waves]
            wait(under_way, return_when=FIRST_EXCEPTION)
            for w in under_way:  # none begins after one has failed
                w.cancel()
        if failure := next((e for w in under_way if not w.cancelled() and (e := w.exception())), None):
            raise failure
        fetched = [w.result() for w in under_way]
        ddl = "document_number string, key string, error string"
        if fetched:  # many small files are read once for their errors
            self.spark.read.schema(_FETCHED).parquet(*fetched).filter("error IS NOT NULL").select("document_number", "key", "error").write.parquet(f"{at}/failed")
        failed = self.spark.read.schema(ddl).parquet(f"{at}/failed") if fetched else self.spark.createDataFrame([], ddl)
        missing = self.owed(planned).join(failed.groupBy("document_number", "key").agg(F.max("error").alias("error")), ["document_number", "key"], "left")
        missing = self._kept(missing, f"{at}/missing")
        marks = self.spark.read.schema("document_number string, fingerprint string").parquet(f"{at}/marks")
        self.finish(marks, missing)
        n = missing.count()
        self.captured.files.delete(at)
        return n

    def _waves(self, owed: DataFrame, wave: int, at: str) -> list[int]:
        """Write what is owed under ``at``, by waves of about ``wave`` files; the numbers of those that have any. A wave is a range
        of buckets of ``captured``, which gets more where they are too few: a run reads what is owed and
        rewrites a bucket once, however many waves it takes."""
        many, buckets = -(-owed.count() // wave), self.captured.commit().buckets
        grown = buckets
        while grown < many:
            grown *= 2
        if grown > buckets:
            if self.captured.commit().number:
                self.captured.rebucket(grown)
            self.captured.buckets = grown
        of = F.floor(self.captured.bucket(grown) / max(1, grown // max(1, many))).cast("int")
        owed.select("document_number", "key", "name", "fingerprint", of.alias("wave")).repartition(max(1, many), "wave").write.partitionBy("wave").parquet(at)
        return sorted(int(n[5:]) for n in self.captured.files.names(at) if n.startswith("wave="))

    def finish(self, documents: DataFrame, missing: DataFrame) -> None:
        """Gap rows, then bundles, then the gaps of complete documents are cleared."""
        m = self.manifest.read()
        collided = m.filter("collided > 0").join(documents, ["document_number", "fingerprint"], "left_semi").select("document_number", F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("name"), F.concat(F.col("collided").cast("string"), F.lit(" entries of the listing can't be told apart")).alias("reason"))
        gaps = missing.select("document_number", "key", "name", F.coalesce("error", F.lit("not fetched")).alias("reason")).unionByName(collided)
        self.gap.change(gaps, lambda old, new: new if old is None else self.gap.without(old, new).unionByName(new))
        held = self.captured.read()
        n = held.join(documents, ["document_number", "fingerprint"], "left_semi").groupBy("document_number", "fingerprint").agg(F.count("*").alias("n_files"))
        open_gaps = gaps.select("document_number").distinct().withColumn("gap", F.lit(True))
        self.bundle.put(n.join(open_gaps, "document_number", "left").select("document_number", "fingerprint", "n_files", F.col("gap").isNull().alias("complete")))
        whole = self.bundle.read().filter("complete").join(documents, ["document_number", "fingerprint"], "left_semi").select("document_number")
        if self.gap.read() is not None:
            self.gap.change(whole, lambda old, done: self.gap.without(old, done))

    def salvage(self, closed: DataFrame) -> None:
        """Bundle what there is of postings that closed (document_number, open): what they still owe can't be fetched
        any more and stays a gap. Raises where one is open, whose capture could yet complete."""
        if not closed.filter("open OR open IS NULL").isEmpty():
            raise ValueError("a posting that is open can't be salvaged")
        documents = self.manifest.read().join(closed.select("document_number"), "document_number", "left_semi").select("document_number", "fingerprint")
        mine = self._rows(self.gap, "document_number string, key string, name string, reason string").join(documents, "document_number", "left_semi")
        self.finish(documents, mine.filter("key IS NOT NULL").select("document_number", "key", "name", F.col("reason").alias("error")))

    def empty(self, asked: DataFrame) -> DataFrame:
        """Documents that were asked for and whose listing named nothing: errors, never complete."""
        return asked.select("document_number").distinct().join(self._rows(self.manifest, "document_number string"), "document_number", "left_anti")


def _fetching(fetch: Callable[[str, str], bytes]):
    kinds = (pa.string(), pa.int64(), pa.binary(), pa.string())
    names = ["document_number", "key", "name", "fingerprint", "sha256", "size", "content", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for start in range(0, b.num_rows, 32):  # a few files in memory at once
                some, out = b.slice(start, 32), []
                for d, key in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    try:
                        data = fetch(d, key)
                        out.append((hashlib.sha256(data).hexdigest(), len(data), data, None))
                    except Exception as e:  # one file's failure is its own
                        out.append((None, None, None, f"{type(e).__name__}: {e}"[:500]))
                yield pa.RecordBatch.from_arrays([*some.columns, *map(pa.array, zip(*out), kinds)], names=names)

    return run

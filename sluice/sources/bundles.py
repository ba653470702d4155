"""Bundles of documents: zips that arrive as a stream of files, indexed once by their content.

``index`` holds the leaves of each document's bundle, ``held`` the bundle itself: its name, content hash,
number of leaves or error. A bundle whose hash is held isn't opened again; one that changed replaces its
document's leaves whole, so that no leaf outlives it; one that can't be read is an error in ``held`` and
leaves the leaves of its predecessor. The index is committed before the bundle, so a crash between the
two costs a second indexing and nothing else.
"""

from __future__ import annotations

import zipfile
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.keys import zip_document_number
from ..functions.text import basename
from ..keyed import KeyedTable
from .zip_index import index_zip

#: What the binary file source gives.
FILES = "path string, modificationTime timestamp, length long, content binary"


@F.udtf(returnType="filename string, path string, file_size long, crc32 string, error string")
class Leaves:
    """A row a leaf; of a bundle without leaves or that can't be read one row, with null path."""

    def eval(self, content: bytes):
        try:
            leaves = index_zip(bytes(content))
        except (zipfile.BadZipFile, ValueError, RuntimeError, NotImplementedError) as e:
            yield None, None, None, None, f"{type(e).__name__}: {e}"[:500]
            return
        if not leaves:
            yield None, None, None, None, None
        for leaf in leaves:
            yield (*leaf, None)


@dataclass(frozen=True)
class Bundles:
    """The two tables, under one folder."""

    index: KeyedTable
    held: KeyedTable

    @classmethod
    def at(cls, spark: SparkSession, root: str, buckets: int = 16) -> Bundles:
        return cls(KeyedTable(spark, f"{root}/index", ["document_number"], buckets=buckets), KeyedTable(spark, f"{root}/held", ["document_number"], buckets=buckets))

    def ingest(self, files: DataFrame, again: bool = False) -> None:
        """Index the bundles among files (``FILES``) whose names give a document number; of several of one document
        the newest, by time and path. ``again`` opens those too whose hash is held: the index is
        derived, and may be rebuilt when indexing changes."""
        named = files.withColumn("document_number", zip_document_number(basename(F.col("path")))).filter("document_number IS NOT NULL")
        newest = named.groupBy("document_number").agg(F.max_by("path", F.struct("modificationTime", "path")).alias("newest"))  # contents aren't read for this
        chosen = named.join(newest, "document_number").filter("path = newest").select("document_number", basename(F.col("path")).alias("zip_name"), "content").withColumn("sha256", F.sha2("content", 256))
        if not again and (known := self.held.read()) is not None:
            chosen = chosen.join(known.select("document_number", "sha256"), ["document_number", "sha256"], "left_anti")
        opened = chosen.lateralJoin(Leaves(F.col("content").outer())).drop("content").persist()
        try:
            good = opened.filter("error IS NULL")
            self.index.change(good, self._of_documents)
            summary = opened.groupBy("document_number", "zip_name", "sha256").agg(F.count("path").alias("n_files"), F.max("error").alias("error"))
            self.held.put(summary)
        finally:
            opened.unpersist()

    def _of_documents(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        fresh = new.filter("path IS NOT NULL").drop("error")
        return fresh if old is None else self.index.without(old, new).unionByName(fresh)

    def stream(self, folder: str, checkpoint: str, files_a_batch: int = 1000):
        """Ingest what has come to a folder since the last run."""
        spark = self.index.spark
        arriving = spark.readStream.format("binaryFile").schema(FILES).option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_a_batch).load(folder)
        return arriving.writeStream.foreachBatch(lambda batch, _number: self.ingest(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

    def reindex(self, folder: str) -> None:
        """The index anew from all bundles of a folder."""
        self.ingest(self.index.spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True).load(folder), again=True)

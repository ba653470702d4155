"""The leaves of a zip bundle from its central directories, nested zips included."""

from __future__ import annotations

import io
import zipfile

from pyspark.sql import functions as F


def index_zip(content: bytes, depth: int = 8, most: int = 10_000, at: str = "") -> list[tuple]:
    """(filename, path, file_size, crc32): metadata only, but for nested zips, which are opened to
    ``depth``. A nested zip that is corrupt or empty, or too deep, is a leaf itself. More than
    ``most`` leaves are an error: an index with holes would look whole."""
    leaves: list[tuple] = []
    with zipfile.ZipFile(io.BytesIO(content)) as bundle:
        for info in bundle.infolist():
            if info.is_dir():
                continue
            path, inner = f"{at}{info.filename}", []
            if info.filename.lower().endswith(".zip") and depth > 1:
                try:
                    inner = index_zip(bundle.read(info), depth - 1, most, f"{path}/")
                except (zipfile.BadZipFile, RuntimeError):
                    inner = []
            leaves += inner or [(info.filename.rsplit("/", 1)[-1], path, info.file_size, format(info.CRC, "08x"))]
            if len(leaves) > most:
                raise ValueError(f"more than {most} files in a bundle")
    return leaves


@F.udtf(returnType="filename string, path string, file_size long, crc32 string")
class ZipIndex:
    def eval(self, content: bytes):
        yield from index_zip(bytes(content))


def bundles(spark, folder: str):
    """Bundles of a folder with their leaves; documents are numbered by file name."""
    from ..functions.keys import zip_document_number
    from ..functions.text import basename

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(folder)
    files.createOrReplaceTempView("_bundles")
    spark.udtf.register("zip_index", ZipIndex)
    rows = spark.sql("SELECT b.path AS bundle, z.* FROM _bundles b, LATERAL zip_index(b.content) z")
    return rows.withColumn("document_number", zip_document_number(basename(F.col("bundle"))))

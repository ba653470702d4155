"""Paged REST feeds as a Python data source: ``spark.read.format("paged_rest")``.

Options: ``url``; ``style`` (``odata``: $skip and $top, rows under ``value``; ``portal``: offset
and limit, rows under ``result.records``); ``page_size``; ``total`` (asked of the server where it
isn't given); ``filter`` and ``orderby`` for odata, so that the server filters. Each page is a
partition, read by an executor; equality filters on columns are pushed to an odata server.
The rows are JSON strings in column ``record``, with their place in the feed; ``read_feed`` gives the
declared fields and ``_arrival``. As a stream (``spark.readStream``) the offset is a place: each batch
reads what the feed has gained, a page a partition, and a run that died goes on at its checkpoint's place.
"""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, InputPartition


def get(url: str, params: dict | None = None, retries: int = 3, pause: float = 0.5, data: bytes | None = None, timeout: float = 30) -> bytes:
    """A GET (with data, a POST): server errors and broken connections are retried with growing
    pauses, the client's own errors never."""
    full = f"{url}{'&' if '?' in url else '?'}{urllib.parse.urlencode(params)}" if params else url
    for attempt in range(retries + 1):
        try:
            with urllib.request.urlopen(urllib.request.Request(full, data=data), timeout=timeout) as answer:
                return answer.read()
        except urllib.error.HTTPError as e:
            if e.code < 500 or attempt == retries:
                raise
        except (urllib.error.URLError, TimeoutError, ConnectionError):
            if attempt == retries:
                raise
        time.sleep(pause * 2**attempt)
    raise AssertionError("unreachable")


def resolve_resource(api: str, slug: str) -> str:
    """The id of a package's first resource with a datastore."""
    found = json.loads(get(f"{api}package_show", {"id": slug}))["result"]["resources"]
    return next(r["id"] for r in found if r.get("datastore_active"))


class Page(InputPartition):
    def __init__(self, skip: int, size: int, last: bool):
        super().__init__(skip)
        self.skip, self.size, self.last = skip, size, last


class PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.url, self.style = options["url"], options.get("style", "odata")
        self.size, self.total = int(options.get("page_size", 1000)), options.get("total")
        self.filters = [options["filter"]] if options.get("filter") else []
        self.order, self.resource = options.get("orderby"), options.get("resource_id")

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if self.style == "odata" and isinstance(f, EqualTo) and f.attribute != ("record",) and isinstance(f.value, (str, int)):
                value = f.value.replace("'", "''") if isinstance(f.value, str) else f.value
                self.filters.append(f"{'/'.join(f.attribute)} eq {f"'{value}'" if isinstance(value, str) else value}")
            yield f  # the server's word isn't taken for it

    def _params(self, skip: int, size: int) -> dict:
        if self.style == "portal":
            return {"resource_id": self.resource, "offset": skip, "limit": size} if self.resource else {"offset": skip, "limit": size}
        params = {"$skip": skip, "$top": size, "$count": "true"}
        if self.filters:
            params["$filter"] = " and ".join(self.filters)
        return params | ({"$orderby": self.order} if self.order else {})

    def _page(self, skip: int, size: int) -> tuple[list, int]:
        answer = json.loads(get(self.url, self._params(skip, size)))
        if self.style == "portal":
            return answer["result"]["records"], int(answer["result"].get("total", 0))
        return answer["value"], int(answer.get("@odata.count", 0))

    def count(self) -> int:
        return int(self.total) if self.total is not None else self._page(0, 1)[1]

    def partitions(self):
        total = self.count()
        starts = list(range(0, total, self.size)) or [0]
        return [Page(k, self.size, k == starts[-1]) for k in starts]

    def read(self, partition: Page):
        """The records of a range: a server that gives fewer than asked for is asked again, and the
        last range goes on until the feed is empty, or repeats itself."""
        at, end, before = partition.skip, partition.skip + partition.size, None
        while partition.last or at < end:
            records = self._page(at, partition.size if partition.last else end - at)[0]
            if not records or records == before:
                return
            for k, record in enumerate(records):
                yield json.dumps(record, ensure_ascii=False), at + k
            at, before = at + len(records), records


class PagedStream(DataSourceStreamReader):
    """The feed as it grows: an offset is the number of records before it. A feed that shrank is an error,
    as its places no longer mean what they did."""

    def __init__(self, options: dict):
        self.pages = PagedReader(options)

    def initialOffset(self) -> dict:
        return {"place": 0}

    def latestOffset(self) -> dict:
        return {"place": self.pages.count()}

    def partitions(self, start: dict, end: dict):
        if end["place"] < start["place"]:
            raise ValueError(f"the feed shrank from {start['place']} to {end['place']} records")
        size = self.pages.size
        return [Page(k, min(size, end["place"] - k), False) for k in range(start["place"], end["place"], size)]

    def read(self, partition: Page):
        n = 0
        for row in self.pages.read(partition):
            n += 1
            yield row
        if n < partition.size:
            raise ValueError(f"the feed gave {n} of {partition.size} records from {partition.skip} on")

    def commit(self, end: dict) -> None:
        """Nothing to let go of: a server keeps its records."""


class PagedRest(DataSource):
    @classmethod
    def name(cls) -> str:
        return "paged_rest"

    def schema(self) -> str:
        return "record string, place long"

    def reader(self, schema) -> DataSourceReader:
        return PagedReader(dict(self.options))

    def streamReader(self, schema) -> DataSourceStreamReader:
        return PagedStream(dict(self.options))


def read_feed(spark: SparkSession, url: str, fields: str, **options) -> DataFrame:
    """A feed's records with its declared fields."""
    from pyspark.sql import functions as F

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedRest)
    raw = spark.read.format("paged_rest").option("url", url).options(**options).load()
    return raw.select(F.from_json("record", fields).alias("r"), F.col("place").alias("_arrival")).select("r.*", "_arrival")


def stream_feed(spark: SparkSession, url: str, fields: str, **options) -> DataFrame:
    """read_feed as a stream."""
    from pyspark.sql import functions as F

    spark.dataSource.register(PagedRest)
    raw = spark.readStream.format("paged_rest").option("url", url).options(**options).load()
    return raw.select(F.from_json("record", fields).alias("r"), F.col("place").alias("_arrival")).select("r.*", "_arrival")


def landed(spark: SparkSession, folder: str, fields: str) -> DataFrame:
    """Records that were landed as JSON lines, with the order in which they came in ``_arrival``: files by
    their paths, which ``land`` makes ascend, ranges of a file by their starts, lines within a range."""
    from pyspark.sql import functions as F

    raw = spark.read.schema(fields).option("recursiveFileLookup", True).json(folder)
    return raw.select("*", F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line")).alias("_arrival"))


def land(records: DataFrame, folder: str) -> str:
    """Append records, in the order of their partitions, in a folder of their own whose name ascends with time."""
    at = f"{folder}/landed={time.time_ns():020d}"
    records.drop("_arrival").write.json(at)
    return at


def cached_pages(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, html) of landed pages."""
    from pyspark.sql import functions as F

    pages = spark.read.text(folder, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
    return pages.select(F.regexp_extract("path", r"([^/]*?)(?:\.[^./]*)?$", 1).alias("stem"), "html")

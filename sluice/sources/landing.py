"""Landing jobs: what has to be asked for, asked for, and recorded.

``fetch`` is always handed in: a function from a reference or url to text or bytes. Probing is
sequential by nature and runs on the driver; downloads are a queue DataFrame whose fetches run on
the executors, a row's failure being that row's.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .html_tables import MISSING


def error_page(html: str | None) -> bool:
    text = (html or "").lower()
    return any(m in text for m in MISSING)


def discover_meetings(fetch: Callable[[str], str], term_starts: list[tuple[str, int, str, int]], closed: dict[str, int] | None = None, most: int = 260, misses: int = 4, on_closed: Callable[[str, int], None] = lambda key, last: None) -> dict[str, str]:
    """{reference: page}: each term's meetings, numbered without gaps but for a few. The session
    year only ever advances, so a number is tried in this year and the next. After ``misses``
    numbers in a row without a page the term is over; all but the last term are closed, and what
    is known of a closed one's end is not probed again."""
    found: dict[str, str] = {}
    for k, (series, year, term, first) in enumerate(term_starts):
        key, last_term = f"{series}{term}", k == len(term_starts) - 1
        end = first + most - 1
        known = closed.get(key) if closed and not last_term else None
        missed = 0
        for n in range(first, min(end, known if known is not None else end) + 1):
            page = next(((y, html) for y in (year, year + 1) if not error_page(html := fetch(f"{y}.{series}{n}"))), None)
            if page:
                year, missed = page[0], 0
                found[f"{year}.{series}{n}"] = page[1]
                continue
            missed += 1
            if missed == misses:
                if not last_term and known is None:
                    on_closed(key, n - missed)
                break
    return found


def cache_aside(read: Callable[[str], str | None], write: Callable[[str, str], None], fetch: Callable[[str], str]) -> Callable[[str], str]:
    """fetch, with what was fetched before read instead; error pages aren't kept."""

    def get(reference: str) -> str:
        held = read(reference)
        if held is not None:
            return held
        page = fetch(reference)
        if not error_page(page):
            write(reference, page)
        return page

    return get


def queue(index: DataFrame, done: Column, order: str) -> DataFrame:
    """What is still to be fetched, in order."""
    return index.filter(~F.coalesce(done, F.lit(False))).orderBy(order)


def download(pending: DataFrame, url: str, fetch: Callable[[str], bytes], to_text: Callable[[bytes], str] | None = None, magic: bytes = b"%PDF", tasks: int = 8) -> DataFrame:
    """pending with sha256, text and error. What isn't the expected kind of file stays queued, as
    does what failed: both keep a null sha256."""
    schema = pending.select(url).schema.simpleString()[7:-1] + ", sha256 string, text string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for u in pdf[url]:
                try:
                    data = fetch(u)
                    good = data.startswith(magic)
                    out.append((hashlib.sha256(data).hexdigest(), to_text(data) if to_text else None, None) if good else (None, None, "not the expected kind of file"))
                except Exception as e:  # one bad file must not end the run
                    out.append((None, None, str(e)[:500]))
            yield pd.DataFrame([(u, *o) for u, o in zip(pdf[url], out)], columns=[url, "sha256", "text", "error"])

    fetched = pending.select(url).distinct().repartition(tasks).mapInPandas(run, schema.replace(":", " "))
    return pending.drop("sha256", "text", "error").join(fetched, url)


def require_permission(portal: dict) -> None:
    """A portal is swept only with a permission on record."""
    if not portal.get("enabled") or not portal.get("permission"):
        raise PermissionError(f"portal {portal.get('slug')!r} is not enabled or has no permission on record")


def sweep(spark: SparkSession, portal: dict, statuses: list[int], page: Callable[[int, int], tuple[list[dict], int]], size: int = 100) -> DataFrame:
    """All listings of a portal as (record, buyer_slug, status_code): a partition a status, pages
    of one status in turn. ``page(status, start)`` gives rows and their total."""
    import json

    require_permission(portal)
    slug = portal["slug"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for status in pdf["status_code"]:
                start = 0
                while True:
                    rows, total = page(int(status), start)
                    if rows:
                        yield pd.DataFrame({"record": [json.dumps(r) for r in rows], "buyer_slug": slug, "status_code": int(status)})
                    start += len(rows)
                    if not rows or start >= total:
                        break

    asked = spark.createDataFrame([(s,) for s in statuses], "status_code int").repartition(len(statuses), "status_code")
    return asked.mapInPandas(run, "record string, buyer_slug string, status_code int")


#: Buyers beside the main one: slug, name, whether partnered, funding share.
BUYERS = (("trca", "Conservation authority", 1, None), ("zoo", "Zoo", 1, None), ("ep", "Exhibition place", 1, None))


def buyers(spark: SparkSession) -> DataFrame:
    """The seed of the buyer dimension, merged in overwrite mode."""
    return spark.createDataFrame(list(BUYERS), "slug string, name string, partnered int, funding_share double")

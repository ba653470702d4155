"""Discovery: which meetings there are, asked for in waves that run as tasks, and calendars year by year.

A committee's meetings of a term are numbered without gaps but for a few, and the session year in their
names only ever advances, by one at a time. So a number counts where it has a page in the year of the
meeting before or the next; ``misses`` numbers in a row without one end the term. That rule is sequential,
asking isn't: a wave asks for the next numbers of every open term in all years that these could have,
at once, and the rule is folded over what was found (``meetings``). The probe log is a keyed table, kept wave by wave,
so a run that died goes on, and a term that ended isn't asked for again, but for the last of a series.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..keyed import KeyedTable
from .landing import error_page
from .links import asset_links, document_links, meeting_pages


@dataclass(frozen=True)
class Term:
    """A term of a series: the year it begins and ends, its first number, whether it is the last of its series."""

    series: str
    first_year: int
    last_year: int
    first: int = 1
    open: bool = False

    @property
    def key(self) -> str:
        return f"{self.series}{self.first_year}-{self.last_year}"


#: The terms of the two boards whose agendas are read.
ZOO_TERMS = (Term("ZB", 2015, 2018), Term("ZB", 2019, 2022), Term("ZB", 2023, 2026, open=True))
EXHIBITION_TERMS = (Term("EP", 2019, 2022), Term("EP", 2023, 2026, open=True))

PROBES = "term string, number int, year int, found boolean, run string"


def meetings(log: DataFrame, terms: DataFrame, misses: int = 4) -> DataFrame:
    """(term, year, last, over, found) of terms (term, first, first_year) and a probe log (term, number, year, found): the
    year of the last meeting found, the last number that the rule looked at, whether the term ended, and its meetings
    as (number, year). Numbers that weren't asked for below the highest that was count as without a page. A term's
    numbers are a bounded list."""
    each = log.groupBy("term", "number").agg(F.collect_set(F.when(F.col("found"), F.col("year"))).alias("years"))
    lists = each.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("number", "years"))).alias("asked"), F.max("number").alias("highest"))
    none = F.array().cast("array<struct<number:int,year:int>>")
    start = F.struct(F.col("first_year").alias("year"), (F.col("first") - 1).alias("last"), F.lit(0).alias("missed"), none.alias("found"))
    numbers = F.when(F.coalesce("highest", F.lit(-1)) >= F.col("first"), F.sequence("first", "highest")).otherwise(F.array().cast("array<int>"))

    def step(acc, n):
        years = F.coalesce(F.try_element_at("asked", n), F.array().cast("array<int>"))
        year = F.array_min(F.filter(years, lambda y: (y == acc.year) | (y == acc.year + 1)))
        hit = F.struct(year.alias("year"), n.alias("last"), F.lit(0).alias("missed"), F.array_append(acc.found, F.struct(n.alias("number"), year.alias("year"))).alias("found"))
        miss = F.struct(acc.year.alias("year"), n.alias("last"), (acc.missed + 1).alias("missed"), acc.found.alias("found"))
        return F.when(acc.missed >= misses, acc).when(year.isNotNull(), hit).otherwise(miss)

    walked = terms.join(lists, "term", "left").withColumn("w", F.aggregate(numbers, start, step))
    return walked.select("term", "w.year", "w.last", (F.col("w.missed") >= misses).alias("over"), "w.found")


class Discovery:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = KeyedTable(spark, f"{self.root}/probes", ["term", "number", "year"])

    def _terms(self, terms) -> DataFrame:
        return self.spark.createDataFrame([(t.key, t.first, t.first_year) for t in terms], "term string, first int, first_year int")

    def _probes(self) -> DataFrame:
        held = self.log.read()
        return held if held is not None else self.spark.createDataFrame([], PROBES)

    def run(self, fetch: Callable[[str], str], terms: tuple[Term, ...], wave: int = 16, misses: int = 4, most: int = 260, tasks: int = 32) -> DataFrame:
        """(term, number, year, html) of all meetings. ``fetch(reference)`` gives a page, an error page where there is no such
        meeting; what it raises ends the run, which goes on from its last wave when repeated."""
        run, table = uuid.uuid4().hex, self._terms(terms)
        open_ = [t.key for t in terms if t.open]
        while True:
            # of a term that goes on, what was missing in an earlier run may have come since
            known = self._probes().filter(F.col("found") | ~F.col("term").isin(open_) | (F.col("run") == run))
            state = {r["term"]: r for r in meetings(known, table, misses).select("term", "year", "last", "over").collect()}
            asks = []
            for t in terms:
                at = state[t.key]
                if not at["over"]:
                    upto = min(at["last"] + wave, t.first + most - 1)
                    asks += [(t.key, t.series, n, y) for n in range(at["last"] + 1, upto + 1) for y in range(at["year"], max(t.last_year, at["year"] + 1) + 1)]
            if not asks:
                break
            self._ask(asks, fetch, run, tasks)
        found = meetings(self._probes(), table, misses).select("term", F.explode("found").alias("m")).select("term", "m.number", "m.year")
        if not self.log.files.names(f"{self.root}/pages"):
            return found.withColumn("html", F.lit(None).cast("string"))
        pages = self.spark.read.option("recursiveFileLookup", True).parquet(f"{self.root}/pages").filter("html IS NOT NULL")
        return found.join(pages.groupBy("term", "number", "year").agg(F.max("html").alias("html")), ["term", "number", "year"], "left")

    def _ask(self, asks: list[tuple], fetch: Callable[[str], str], run: str, tasks: int) -> None:
        def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                pages = [fetch(f"{y}.{s}{n}") for s, n, y in zip(pdf["series"], pdf["number"], pdf["year"])]
                yield pdf[["term", "number", "year"]].assign(html=[None if error_page(p) else p for p in pages])

        at = f"{self.root}/pages/{uuid.uuid4().hex}"
        asked = self.spark.createDataFrame(asks, "term string, series string, number int, year int").repartition(tasks)
        asked.mapInPandas(ask, "term string, number int, year int, html string").write.parquet(at)
        done = self.spark.read.parquet(at)
        self.log.put(done.select("term", "number", "year", F.col("html").isNotNull().alias("found"), F.lit(run).alias("run")))


def calendar(spark: SparkSession, years: list[int], ask: Callable[[int], str], page: Callable[[str], str], base: str, tasks: int = 32) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What a board's calendar leads to: (documents (url), assets (url), errors (year or page, error)). A year is a
    task, as is a part of its meetings; a year or page that fails is a row of errors and the others go on."""

    def fetched(of: DataFrame, key: str, get) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                out = []
                for k in pdf[key]:
                    try:
                        out.append((str(k), get(k), None))
                    except Exception as e:  # one failure is one row's
                        out.append((str(k), None, f"{type(e).__name__}: {e}"[:500]))
                yield pd.DataFrame(out, columns=["asked", "body", "error"])

        return of.mapInPandas(run, "asked string, body string, error string").persist()  # asked for once

    by_year = fetched(spark.createDataFrame([(y,) for y in years], "year int").repartition(len(years), "year"), "year", lambda y: ask(int(y)))
    urls = by_year.filter("body IS NOT NULL").select(F.explode(meeting_pages(F.col("body"), base)).alias("url")).distinct()
    pages = fetched(urls.repartition(tasks, "url"), "url", page)
    good = pages.filter("body IS NOT NULL")
    documents = good.select(F.explode(document_links(F.col("body"), base)).alias("url")).filter(F.lower("url").contains("ashx")).distinct()
    assets = good.select(F.explode(asset_links(F.col("body"), base)).alias("url")).distinct()
    errors = by_year.unionByName(pages).filter("error IS NOT NULL").select("asked", "error")
    return documents, assets, errors


def index_documents(archive, documents: DataFrame, assets: DataFrame, kind: str = "agency_board") -> tuple[int, int]:
    """Documents into the archive's index, where what is known stays; files that pages only load leave it,
    unless their bytes are held. (Rows issued, rows added.)"""
    done = archive.upsert("background_pdf", documents.select("url", F.lit(kind).alias("kind")), "backfill")
    held = archive.read("background_pdf")
    stale = assets.join(documents, "url", "left_anti").join(held.filter("sha256 IS NULL").select("url"), "url", "left_semi")
    t = archive.table("background_pdf")
    t.change(stale, lambda old, gone: t.without(old, gone))
    return done


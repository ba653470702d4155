"""Documents to facts: gate, split, extract, deduplicate, flag, cache, backfill.

The extractor is any picklable function from a prompt to a reply; the default is a stub that
answers without contracts. Batches of chunks go to it in ``mapInPandas``; a document that is
cached for this version is never sent again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions import documents as docs
from .functions.text import fold, none_if_blank
from .operators import merge
from .operators.ledger import cache_gate
from .schemas import TABLES

PROMPT = "List every contract in the text below, with its bids and awards, as JSON.\n\n"


def stub(prompt: str) -> str:
    return '{"contracts": []}'


def with_fallback(models: list[Callable[[str], str]], retries: int = 2, pause: float = 0.5) -> Callable[[str], str]:
    """The first model that answers, each tried a few times with growing pauses."""

    def ask(prompt: str) -> str:
        last: Exception | None = None
        for model in models:
            for attempt in range(retries + 1):
                try:
                    return model(prompt)
                except Exception as e:  # whatever a model's client raises
                    last = e
                    time.sleep(pause * 2**attempt)
        raise RuntimeError("no model answered") from last

    return ask


def extract(documents: DataFrame, cache: DataFrame, labels: DataFrame, version: str, client: Callable[[str], str] = stub, limit: int | None = None, max_chars: int = 400_000) -> DataFrame:
    """(sha256, extractor_version, result_json, chunks, error) of the documents that pass the
    gates, each text once; ``limit`` counts these, in order of key."""
    todo = cache_gate(documents, cache, labels, version).filter("gate = 'to_do'").groupBy("sha256").agg(F.min("key").alias("key"), F.min("text").alias("text"))
    if limit is not None:
        todo = todo.orderBy("key").limit(limit)
    chunks = todo.select("sha256", F.posexplode(docs.split_document(F.col("text"), max_chars)).alias("place", "chunk"))

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            replies, errors = [], []
            for chunk in pdf["chunk"]:
                try:
                    replies.append(client(PROMPT + chunk))
                    errors.append(None)
                except Exception as e:  # one bad document is one row's error
                    replies.append(None)
                    errors.append(str(e)[:500])
            yield pdf[["sha256", "place"]].assign(reply=replies, error=errors)

    answers = chunks.mapInPandas(ask, "sha256 string, place int, reply string, error string").withColumn("record", docs.parse_response(F.col("reply")))
    bad = F.coalesce("error", F.when(F.size(docs.extraction_errors(F.col("record"))) > 0, F.array_join(docs.extraction_errors(F.col("record")), "; ")))
    contracts = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("record.contracts").alias("c")))), lambda x: F.coalesce(x.c, F.array())))
    whole = answers.groupBy("sha256").agg(contracts.alias("contracts"), F.count("*").alias("chunks"), F.max(bad).alias("error"))
    record = F.struct(dedup_contracts(F.col("contracts")).alias("contracts"))
    return whole.select("sha256", F.lit(version).alias("extractor_version"), F.when(F.col("error").isNull(), F.to_json(record)).alias("result_json"), "chunks", "error")


def dedup_contracts(contracts):
    """Of a reference's contracts the one with most bids, the first of equals; those without a
    reference are all kept, last."""
    named = lambda c: F.coalesce(c.reference, F.lit("")) != ""
    n_bids = lambda c: F.coalesce(F.size(c.bids), F.lit(0))
    placed = F.transform(F.filter(contracts, named), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    best = F.filter(placed, lambda a: ~F.exists(placed, lambda b: (b.c.reference == a.c.reference) & ((n_bids(b.c) > n_bids(a.c)) | ((n_bids(b.c) == n_bids(a.c)) & (b.i < a.i)))))
    return F.concat(F.transform(best, lambda x: x.c), F.filter(contracts, lambda c: ~named(c)))


def facts(cache: DataFrame, documents: DataFrame, version: str) -> DataFrame:
    """(url, source, contract) of cached records, by the documents that hold the text."""
    parsed = cache.filter(F.col("extractor_version") == version).select("sha256", F.from_json("result_json", docs.EXTRACTION).alias("r"))
    return documents.join(parsed, "sha256").select("url", "source", F.explode("r.contracts").alias("contract"))


#: What each kind of corpus gives: agency tables, bids alone, or composite awards alone.
AGENCY, BIDS_ONLY, COMPOSITE = ("trca", "ep", "zoo"), ("award_summary", "committee"), ("composite",)


def backfill(found: DataFrame) -> dict[str, DataFrame]:
    """facts to rows by table. Contracts without a reference and entries without a name don't
    count. A composite award needs no title; an agency's solicitation is awarded iff it has awards."""
    c = found.select("source", "contract.*").withColumn("reference", none_if_blank(F.trim("reference"))).filter("reference is not null")
    agency = c.filter(F.col("source").isin(*AGENCY))
    bid = lambda d: d.select("source", "reference", F.explode("bids").alias("b")).filter("coalesce(b.supplier_name, '') <> ''")
    award = lambda d: d.select("source", "reference", "title", F.explode("awards").alias("a")).filter("coalesce(a.supplier_name, '') <> ''")
    return {
        "agency_solicitation": agency.select(F.col("source").alias("buyer_id"), F.col("reference").alias("native_ref"), "title", F.when(F.size("awards") > 0, "awarded").alias("status"), F.col("posted_date"), F.col("closed_date").alias("closing_date"), "source"),
        "agency_bid": bid(agency).select(F.col("source").alias("buyer_id"), F.col("reference").alias("native_ref"), F.col("b.supplier_name").alias("bidder_name_raw"), F.col("b.amount_raw").alias("bid_price"), F.col("b.amount_basis").alias("hst_basis"), F.col("b.status").alias("status"), "source"),
        "agency_award": award(agency).select(F.col("source").alias("buyer_id"), F.col("reference").alias("native_ref"), F.col("a.supplier_name").alias("supplier_name_raw"), F.col("a.amount_raw").alias("award_amount"), F.col("a.amount_basis").alias("amount_basis"), "source"),
        "bid": bid(c.filter(F.col("source").isin(*BIDS_ONLY))).select("reference", F.col("b.supplier_name").alias("bidder_name_raw"), F.col("b.amount_raw").alias("bid_price"), F.col("b.amount_basis").alias("hst_basis"), "source"),
        "composite_award": award(c.filter(F.col("source").isin(*COMPOSITE))).select(F.col("reference").alias("call_number"), F.col("a.supplier_name").alias("supplier_name_raw"), F.col("a.amount_raw").alias("award_value"), "title", "reference", "source"),
    }


def names_by_document(found: DataFrame, key: str = "url") -> DataFrame:
    """(key, names): the folded bidder names of each document."""
    bids = found.select(key, F.explode("contract.bids").alias("b")).filter("coalesce(b.supplier_name, '') <> ''")
    return bids.groupBy(key).agg(F.collect_set(fold(F.col("b.supplier_name"))).alias("names"))


#: Which documents make up each corpus.
CORPORA = {
    "trca": "kind = 'agency_board' AND url LIKE '%escribemeetings%'",
    "ep": "kind = 'agency_board' AND url LIKE '%/ep/%'",
    "zoo": "kind = 'agency_board' AND url LIKE '%/zb/%'",
    "award_summary": "kind = 'award_summary'",
    "committee": "kind = 'committee_award'",
    "composite": "kind = 'bgrd'",
}


def corpus(archive, name: str) -> DataFrame:
    """The documents of a corpus whose bytes are held, with ``key`` and ``source`` as extraction wants them."""
    if name not in CORPORA:
        raise ValueError(f"no corpus {name!r}: one of {', '.join(CORPORA)}")
    held = archive.read("background_pdf").filter(CORPORA[name]).filter("sha256 IS NOT NULL")
    return held.withColumns({"key": F.col("url"), "source": F.lit(name)})


def extract_and_backfill(archive, name: str, version: str, labels: DataFrame, client: Callable[[str], str] | None = None, limit: int | None = None) -> dict[str, int]:
    """Extract what a corpus has that isn't cached, then rebuild its rows from the cache: rows written by
    table. Without a client a corpus must be cached whole. Bids and awards of the source are replaced, unless none
    was derived; solicitations are only filled in."""
    documents, done = corpus(archive, name), archive.read("extraction_cache")
    if client is not None:
        fresh = extract(documents, done, labels, version, client, limit).filter("error IS NULL")
        archive.upsert("extraction_cache", fresh.select("sha256", "extractor_version", "result_json"), "overwrite")
    elif missing := cache_gate(documents, done, labels, version).filter("gate = 'to_do'").count():
        raise ValueError(f"{missing} documents of {name} aren't extracted, and there is no client to do it")
    found = facts(archive.read("extraction_cache"), documents, version)
    written = {}
    for table, rows in backfill(found).items():
        spec = TABLES[table]
        told = F.to_json(F.struct(*sorted(rows.columns)))  # documents of a corpus have no order of arrival
        if table == "agency_solicitation":
            written[table] = archive.upsert(table, rows, "backfill", seq=told)[0]
        else:
            whole = merge.healed_keys(rows, spec).withColumn("_told", told)
            written[table] = archive.rebuild(table, merge.fold_batch(whole, list(spec.keys), F.col("_told"), nullable=spec.nullable_keys).drop("_told"))
    return written

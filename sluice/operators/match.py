"""Joins without a shared identifier. A wrong match is worse than none: only unique ones count."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import document_number
from ..functions.suppliers import supplier_tokens


def value_token_matches(items: DataFrame, item_key: str, item_value: Column, item_tokens: Column, awards: DataFrame, award_doc: str, award_value: Column, award_tokens: Column) -> DataFrame:
    """(item_key, document, last_document): the first and last document of the awards of equal value,
    rounded half to even, that share a token. Awards are first aggregated by value and token, so
    an item meets a row a token however many awards have its value: no pairs are made."""
    i = items.select(F.col(item_key), F.bround(item_value).cast("long").alias("_v"), F.explode(F.array_distinct(item_tokens)).alias("_t"))
    a = awards.select(F.col(award_doc).alias("_d"), F.bround(award_value).cast("long").alias("_v"), F.explode(F.array_distinct(award_tokens)).alias("_t"))
    by_token = a.filter("_d is not null").groupBy("_v", "_t").agg(F.min("_d").alias("_a"), F.max("_d").alias("_z"))
    return i.join(by_token, ["_v", "_t"]).groupBy(item_key).agg(F.min("_a").alias("document"), F.max("_z").alias("last_document"))


def unique_matches(matches: DataFrame) -> DataFrame:
    return matches.filter("document = last_document").drop("last_document")


def ambiguous_matches(matches: DataFrame) -> DataFrame:
    return matches.filter("document < last_document").withColumnRenamed("document", "first_document")


#: Where a title comes from, best first.
TITLE_RANK = ("feed", "legacy_page", "council", "council_match", "composite_match")


def fill_titles(spine: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """spine (key, title, title_source) with the best-ranked candidate (key, title, title_source,
    place) where its own title is null or ranks lower; of equals the first by place. Candidates
    without a title don't count."""
    rank = lambda c: F.coalesce(F.array_position(F.array(*map(F.lit, TITLE_RANK)), c), F.lit(0))
    r = F.when(rank(F.col("title_source")) > 0, rank(F.col("title_source"))).otherwise(99)
    best = candidates.filter("title is not null").groupBy(key).agg(F.min_by(F.struct("title", "title_source", r.alias("rank")), F.struct(r.alias("r"), "place")).alias("best"))
    mine = F.when(F.col("title").isNull(), 100).otherwise(r)
    joined = spine.join(best, key, "left")
    better = F.coalesce(F.col("best.rank") < mine, F.lit(False))
    return joined.withColumns({"title": F.when(better, F.col("best.title")).otherwise(F.col("title")), "title_source": F.when(better, F.col("best.title_source")).otherwise(F.col("title_source"))}).drop("best")


def fill_from_titles(items: DataFrame, spine: DataFrame, order: str) -> DataFrame:
    """(document_number, title) for title-less spine rows that an item's title names by its ten
    digits: the first item by order."""
    named = items.select(F.explode(F.array_distinct(F.regexp_extract_all("title", F.lit(r"(\d{10})")))).alias("document_number"), "title", order)
    missing = spine.filter("title is null").select("document_number")
    return named.join(missing, "document_number", "left_semi").groupBy("document_number").agg(F.min_by("title", order).alias("title"))


def item_matches(items: DataFrame, awards: DataFrame) -> DataFrame:
    """items (reference, title, winner_raw, award_value, place) with the one document_number whose
    award has the item's value and a token of its winner; items that fit none or several are
    left out, and so are those without a value."""
    each = items.select(F.struct("reference", "title", "winner_raw", "award_value", "place").alias("item")).distinct()
    held = awards.filter("award_amount_numeric is not null and supplier_name_raw is not null")
    found = value_token_matches(each, "item", F.col("item.award_value"), supplier_tokens(F.col("item.winner_raw")), held, "document_number", F.col("award_amount_numeric"), supplier_tokens(F.col("supplier_name_raw")))
    return unique_matches(found.select(F.col("item"), "document", "last_document")).select("item.*", F.col("document").alias("document_number"))


def item_links(items: DataFrame, awards: DataFrame, method: str) -> DataFrame:
    """(reference, document_number, method) of the items that match one document; where a reference
    stands on several items the last by place counts."""
    found = item_matches(items, awards).filter("reference is not null")
    return found.groupBy("reference").agg(F.max_by("document_number", F.struct("place", "document_number")).alias("document_number")).withColumn("method", F.lit(method))


def matched_titles(items: DataFrame, awards: DataFrame, spine: DataFrame) -> DataFrame:
    """(document_number, title) for title-less spine rows from items that match one of their awards
    alone: the first item by place."""
    missing = spine.filter("title is null").select("document_number")
    found = item_matches(items, awards.join(missing, "document_number", "left_semi")).filter("title is not null")
    return found.groupBy("document_number").agg(F.min_by("title", F.struct("place", "title")).alias("title"))


def name_rows(spine: DataFrame, titles: DataFrame, source: str, over: tuple[str, ...] = ()) -> DataFrame:
    """spine with titles (document_number, title) where it has none, or has one from a source in ``over``."""
    joined = spine.join(titles.select("document_number", F.col("title").alias("_title")), "document_number", "left")
    take = F.col("_title").isNotNull() & (F.col("title").isNull() | F.coalesce(F.col("title_source").isin(*over), F.lit(False)))
    return joined.withColumns({"title_source": F.when(take, F.lit(source)).otherwise(F.col("title_source")), "title": F.when(take, F.col("_title")).otherwise(F.col("title"))}).select(*spine.columns)


def chronological(reference: Column) -> Column:
    """The numbers of a reference, year first: an order in which 2017.BA10 comes after 2017.BA9."""
    return F.transform(F.regexp_extract_all(F.coalesce(reference, F.lit("")), F.lit(r"(\d+)")), lambda x: x.try_cast("long"))


def folder_titles(pages: DataFrame, order: str) -> DataFrame:
    """(document_number, title) of archived pages (folder, title): the first page with a title by order."""
    named = pages.select(document_number(F.col("folder")).alias("document_number"), "title", order).filter("document_number is not null and title is not null")
    return named.groupBy("document_number").agg(F.min_by("title", order).alias("title"))


def fill_postings(postings: DataFrame, spine: DataFrame, link_id: Column, order: str) -> DataFrame:
    """postings (rfx_id, document_number) with nulls filled from the spine row whose link names
    the event; of several the first by order."""
    by_event = spine.select(link_id.alias("_rfx"), F.col("document_number").alias("_doc"), order).filter("_rfx is not null").groupBy("_rfx").agg(F.min_by("_doc", order).alias("_doc"))
    joined = postings.join(by_event, F.col("rfx_id") == F.col("_rfx"), "left")
    return joined.withColumns({"bridged": F.col("document_number").isNull() & F.col("_doc").isNotNull(), "document_number": F.coalesce("document_number", "_doc")}).drop("_rfx", "_doc")

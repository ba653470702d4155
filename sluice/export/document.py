"""The nested archive document: solicitations, council items and buyers with their children,
and what is linked to none of them. Children that name an unknown parent are never lost."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import nest


def archive(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """section -> rows: nested solicitations, council_items and buyers; flat unlinked_* sections.
    tables: solicitation, award, bid, background_pdf, council_item, solicitation_link, buyer,
    agency_solicitation, agency_award, agency_bid."""
    t = tables
    bridge = nest.bridge_of(t["bid"], t["solicitation_link"])
    routed = nest.route(t["bid"], bridge, t["council_item"], t["solicitation"])
    spine_bids = routed.filter("placed = 'solicitation'").withColumn("document_number", F.col("bridged")).drop("bridged", "placed")
    reports = t["background_pdf"].join(bridge.select(F.col("reference").alias("_r"), F.col("document_number").alias("_d")), F.col("reference") == F.col("_r"), "left")
    reports = reports.withColumn("document_number", F.coalesce("document_number", "_d")).drop("_r", "_d")
    spine = t["solicitation"]
    full = nest.nest(spine, t["award"], "document_number", "document_number", "awards", ["supplier_name_raw", "award_amount", "award_date"])
    full = nest.nest(full, spine_bids, "document_number", "document_number", "bids", ["bidder_name_raw", "bid_price"])
    full = nest.nest(full, reports.filter("document_number is not null"), "document_number", "document_number", "documents", ["url"])
    items = nest.nest(t["council_item"], routed.filter("placed = 'council_item'").drop("bridged", "placed"), "reference", "reference", "bids", ["bidder_name_raw", "bid_price"])
    items = nest.nest(items, t["background_pdf"], "reference", "reference", "documents", ["url"])
    buyers = t["buyer"]
    for name, order in (("agency_solicitation", ["native_ref"]), ("agency_award", ["native_ref", "supplier_name_raw"]), ("agency_bid", ["native_ref", "bidder_name_raw"])):
        buyers = nest.nest(buyers, t[name], "slug", "buyer_id", f"{name}s", order)
    known = reports.join(spine.select(F.col("document_number").alias("_s")), F.col("document_number") == F.col("_s"), "left").join(t["council_item"].select(F.col("reference").alias("_i")), F.col("reference") == F.col("_i"), "left")
    return {
        "solicitations": full,
        "council_items": items,
        "buyers": buyers,
        "unlinked_awards": nest.unlinked(t["award"], spine, "document_number", "document_number"),
        "unlinked_bids": routed.filter("placed = 'unlinked'").drop("bridged", "placed"),
        "unlinked_documents": known.filter("_s is null and _i is null").drop("_s", "_i"),
    }


def write_json(sections: dict[str, DataFrame], root: str, generated_at: str) -> dict[str, str]:
    """A folder of JSON lines a section, all with the one time of generation."""
    paths = {s: f"{root}/json/{s}" for s in sections}
    for s, d in sections.items():
        d.withColumn("generated_at", F.lit(generated_at)).write.mode("overwrite").json(paths[s], ignoreNullFields=False)
    return paths

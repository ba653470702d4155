"""The archive's tables: columns, keys, which key parts may be null, and the merge mode.

``DDL`` is the declared schema; ``first_seen`` and ``last_seen`` are managed by the merge.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    keys: tuple[str, ...]
    nullable_keys: tuple[str, ...] = ()
    exported: bool = True

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(f"{self.ddl}, first_seen timestamp, last_seen timestamp")


def _amount(name: str) -> str:
    """An amount in its three tiers: as published, as parsed, as labelled by people."""
    return f"{name} string, {name}_numeric double, {name}_labelled double, {name}_verdict string"


TABLES = {
    t.name: t
    for t in (
        TableSpec("solicitation", "document_number string, status string, solicitation_type string, form_type string, title string, title_source string, description string, category string, issue_date string, submission_deadline string, division string, buyer_name string, buyer_email string, buyer_phone string, wards string, posting_link string, source string", ("document_number",)),
        TableSpec("award", f"document_number string, supplier_name_raw string, {_amount('award_amount')}, award_date string, source string, supplier_id long", ("document_number", "supplier_name_raw", "award_amount", "award_date", "source"), ("supplier_name_raw", "award_amount", "award_date", "source")),
        TableSpec("noncompetitive", f"workspace_number string, reason string, supplier_name_raw string, {_amount('contract_amount')}, contract_date string, division string, supplier_address string, source string, supplier_id long", ("workspace_number",)),
        TableSpec("ariba_posting", "rfx_id string, document_number string, title string, status string, categories array<string>, amount_min double, amount_max double, currency string, start_date string, end_date string, url string", ("rfx_id",)),
        TableSpec("suspended_firm", "supplier_name_raw string, status string, suspension_start string, suspension_end string, suspension_type string, council_authority string, supplier_id long", ("supplier_name_raw", "council_authority"), ("council_authority",)),
        TableSpec("supplier", "supplier_key string, display_name string, variants array<string>", ("supplier_key",)),
        TableSpec("capital_project", "name string, contract_number string, type_of_work string, scope string, delivery_division string, owner_division string, target_sourcing_year string, target_award_year string, sourcing_type string, estimated_range string, estimated_term_months string, source string", ("name",)),
        TableSpec("bid", "reference string, document_number string, bidder_name_raw string, bid_price string, bid_price_numeric double, hst_basis string, price_header string, source string, supplier_id long", ("reference", "document_number", "bidder_name_raw", "bid_price", "source"), ("reference", "document_number", "bid_price")),
        TableSpec("council_item", "reference string, meeting string, title string, decision_text string", ("reference",)),
        TableSpec("background_pdf", "url string, reference string, document_number string, kind string, sha256 string, text string, path string", ("url",)),
        TableSpec("composite_award", f"call_number string, supplier_name_raw string, {_amount('award_value')}, title string, reference string, source string, supplier_id long", ("call_number", "supplier_name_raw", "award_value", "source"), ("supplier_name_raw", "award_value")),
        TableSpec("sync_run", "id long, source string, started_at timestamp, finished_at timestamp, status string, rows_fetched long, rows_upserted long, error string", ("id",)),
        TableSpec("buyer", "slug string, name string, partnered int, funding_share double", ("slug",)),
        TableSpec("agency_solicitation", "buyer_id string, native_ref string, title string, status string, posted_date string, closing_date string, documents int, addendums int, plan_takers int, source string", ("buyer_id", "native_ref")),
        TableSpec("agency_award", f"buyer_id string, native_ref string, supplier_name_raw string, {_amount('award_amount')}, amount_basis string, source string, supplier_id long", ("buyer_id", "native_ref", "supplier_name_raw", "award_amount", "source"), ("supplier_name_raw", "award_amount")),
        TableSpec("agency_bid", "buyer_id string, native_ref string, bidder_name_raw string, bid_price string, bid_price_numeric double, hst_basis string, status string, source string, supplier_id long", ("buyer_id", "native_ref", "bidder_name_raw", "source")),
        TableSpec("ariba_attachment", "document_number string, path string, filename string, file_size long, crc32 string", ("document_number", "path")),
        TableSpec("solicitation_link", "reference string, document_number string, method string", ("reference",)),
        TableSpec("extraction_cache", "sha256 string, extractor_version string, result_json string", ("sha256", "extractor_version"), exported=False),
    )
}
EXPORT_TABLES = [t.name for t in TABLES.values() if t.exported]

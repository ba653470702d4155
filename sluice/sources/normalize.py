"""Feed records to rows: one projection a model, one explode where a record yields several.

Each takes the landed records of one feed and returns model name -> DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import bridged_document_number, contract_number, document_number, native_ref
from ..functions.titles import clean_title
from ..functions.text import clean_feed, clean_feed_list, clean_portal, collapse, none_if_blank, strip

_AWARDED = "array<struct<Award_Amount: string, AwardedDate: string, Date_Awarded: string, Successful_Bidder: string>>"
#: The declared fields of each feed; what a record lacks of them is drift.
FEEDS = {
    "odata_solicitation": "Solicitation_Document_Number string, Status string, Solicitation_Document_Type string, Solicitation_Form_Type string, Posting_Title string, Solicitation_Document_Description string, High_Level_Category string, Issue_Date string, Closing_Date string, Client_Division array<string>, Buyer_Name string, Buyer_Email string, Buyer_Phone_Number string, Wards array<string>, Ariba_Discovery_Posting_Link string, Award_Amount string, Awarded_Suppliers array<struct<Award_Amount: string, AwardedDate: string, Date_Awarded: string, Successful_Bidder: string, city: string, province: string>>, id string",
    "odata_noncompetitive": "Non_Competitive_Reference_Number string, Non_Competitive_Reason string, Solicitation_Document_Number string, Posting_Title string, Client_Division array<string>, Buyer_Name string, Awarded_Suppliers array<struct<Award_Amount: string, Date_Awarded: string, Successful_Bidder: string>>, id string",
    "portal_awarded": "`Document Number` string, `RFx (Solicitation) Type` string, `High Level Category` string, `Successful Supplier` string, Award string, `Award Authority Obtained Date` string, Division string, `Buyer Name` string, `Buyer Email` string, `Buyer Phone Number` string, `Solicitation Document Description` string, `Supplier Address` string, Wards string",
    "portal_open": "`Document Number` string, `RFx (Solicitation) Type` string, `NOIP (Notice of Intended Procurement) Type` string, `Issue Date` string, `Submission Deadline` string, `High Level Category` string, `Solicitation Document Description` string, Division string, `Buyer Name` string, `Buyer Email` string, `Buyer Phone Number` string, Wards string",
    "portal_noncompetitive": "`Workspace Number` string, Reason string, `Contract Date` string, `Supplier Name` string, `Contract Amount` string, Division string, `Supplier Address` string, Wards string",
    "portal_capital": "`Name and Construction Contract Number` string, `Type of Work` string, `Scope of Work: Detailed Description` string, `Delivery Division` string, `Project Owner (Division)` string, `Target Sourcing Year` string, `Target Award Year` string, `Sourcing Type` string, `Estimated Range` string, `Estimated Contract Term (Months)` string",
    "listing": "Id string, ReferenceNumber string, BidNumber string, Title string, ClosingDate string, DatePosted string, StatusText string, Documents int, Addendums int, PlanTakers int, buyer_slug string, status_code int",
}


def _came(raw: DataFrame, *more: str) -> list[Column]:
    """The order in which records came, where raw has it; rows of one record in the order of ``more``."""
    if "_arrival" not in raw.columns:
        return []
    return [F.struct(F.col("_arrival").alias("record"), *more).alias("_arrival") if more else F.col("_arrival")]


def odata_solicitations(raw: DataFrame) -> dict[str, DataFrame]:
    """One solicitation and as many awards as there are named suppliers."""
    base = raw.withColumn("document_number", document_number(F.col("Solicitation_Document_Number"))).filter("document_number is not null")
    c = lambda n: clean_feed(F.col(n))
    spine = base.select(
        "document_number", c("Status").alias("status"), c("Solicitation_Document_Type").alias("solicitation_type"), c("Solicitation_Form_Type").alias("form_type"), clean_title(c("Posting_Title")).alias("title"),
        c("Solicitation_Document_Description").alias("description"), c("High_Level_Category").alias("category"), c("Issue_Date").alias("issue_date"), c("Closing_Date").alias("submission_deadline"),
        clean_feed_list(F.col("Client_Division")).alias("division"), c("Buyer_Name").alias("buyer_name"), c("Buyer_Email").alias("buyer_email"), c("Buyer_Phone_Number").alias("buyer_phone"),
        clean_feed_list(F.col("Wards")).alias("wards"), c("Ariba_Discovery_Posting_Link").alias("posting_link"), F.lit("odata").alias("source"), *_came(raw),
    )
    awards = base.select("document_number", *_came(raw), F.posexplode("Awarded_Suppliers").alias("place", "a")).select(
        "document_number", clean_feed(F.col("a.Successful_Bidder")).alias("supplier_name_raw"), clean_feed(F.col("a.Award_Amount")).alias("award_amount"),
        F.coalesce(clean_feed(F.col("a.Date_Awarded")), clean_feed(F.col("a.AwardedDate"))).alias("award_date"), F.lit("odata").alias("source"), *_came(raw, "place"),
    ).filter("supplier_name_raw is not null")
    return {"solicitation": spine, "award": awards}


def odata_noncompetitive(raw: DataFrame) -> dict[str, DataFrame]:
    """Only the first supplier of a record counts."""
    first = F.get("Awarded_Suppliers", F.lit(0))
    rows = raw.select(
        clean_feed(F.col("Non_Competitive_Reference_Number")).alias("workspace_number"), clean_feed(F.col("Non_Competitive_Reason")).alias("reason"), clean_feed(first.Successful_Bidder).alias("supplier_name_raw"),
        clean_feed(first.Award_Amount).alias("contract_amount"), clean_feed(first.Date_Awarded).alias("contract_date"), clean_feed_list(F.col("Client_Division")).alias("division"), F.lit("odata").alias("source"), *_came(raw),
    )
    return {"noncompetitive": rows.filter("workspace_number is not null")}


def _portal(name: str) -> Column:
    return clean_portal(F.col(f"`{name}`"))


def _portal_spine(raw: DataFrame, status: str, **more: Column) -> DataFrame:
    return raw.select(
        document_number(F.col("`Document Number`")).alias("document_number"), F.lit(status).alias("status"), _portal("RFx (Solicitation) Type").alias("solicitation_type"), _portal("High Level Category").alias("category"),
        _portal("Division").alias("division"), _portal("Buyer Name").alias("buyer_name"), _portal("Buyer Email").alias("buyer_email"), _portal("Buyer Phone Number").alias("buyer_phone"),
        _portal("Solicitation Document Description").alias("description"), _portal("Wards").alias("wards"), F.lit("ckan").alias("source"), *(c.alias(n) for n, c in more.items()), *_came(raw),
    ).filter("document_number is not null")


def portal_awarded(raw: DataFrame) -> dict[str, DataFrame]:
    awards = raw.select(document_number(F.col("`Document Number`")).alias("document_number"), _portal("Successful Supplier").alias("supplier_name_raw"), _portal("Award").alias("award_amount"), _portal("Award Authority Obtained Date").alias("award_date"), F.lit("ckan").alias("source"), *_came(raw))
    return {"solicitation": _portal_spine(raw, "Awarded"), "award": awards.filter("document_number is not null and supplier_name_raw is not null")}


def portal_open(raw: DataFrame) -> dict[str, DataFrame]:
    return {"solicitation": _portal_spine(raw, "Open", form_type=_portal("NOIP (Notice of Intended Procurement) Type"), issue_date=_portal("Issue Date"), submission_deadline=_portal("Submission Deadline"))}


def portal_noncompetitive(raw: DataFrame) -> dict[str, DataFrame]:
    rows = raw.select(_portal("Workspace Number").alias("workspace_number"), _portal("Reason").alias("reason"), _portal("Supplier Name").alias("supplier_name_raw"), _portal("Contract Amount").alias("contract_amount"), _portal("Contract Date").alias("contract_date"), _portal("Division").alias("division"), _portal("Supplier Address").alias("supplier_address"), F.lit("ckan").alias("source"), *_came(raw))
    return {"noncompetitive": rows.filter("workspace_number is not null")}


#: A capital project's column -> its field.
CAPITAL = {
    "Type of Work": "type_of_work", "Scope of Work: Detailed Description": "scope", "Delivery Division": "delivery_division", "Project Owner (Division)": "owner_division", "Target Sourcing Year": "target_sourcing_year",
    "Target Award Year": "target_award_year", "Sourcing Type": "sourcing_type", "Estimated Range": "estimated_range", "Estimated Contract Term (Months)": "estimated_term_months",
}


def portal_capital(raw: DataFrame) -> dict[str, DataFrame]:
    """Projects, with the construction contract number that their name carries."""
    name = _portal("Name and Construction Contract Number")
    rows = raw.select(name.alias("name"), contract_number(name).alias("contract_number"), *(_portal(f).alias(c) for f, c in CAPITAL.items()), F.lit("ckan_pipeline").alias("source"), *_came(raw))
    return {"capital_project": rows.filter("name is not null")}


def postings(search: DataFrame, details: DataFrame) -> dict[str, DataFrame]:
    """Search records with their details where the look-up succeeded: a left join. A detail's
    value goes before the search record's."""
    joined = search.alias("s").join(details.alias("d"), F.col("s.rfxID") == F.col("d.id"), "left")
    pick = lambda a, b: F.coalesce(clean_feed(F.col(a)), clean_feed(F.col(b)))
    rows = joined.select(
        clean_feed(F.col("s.rfxID")).alias("rfx_id"), bridged_document_number(F.col("d.externalRfxId"), pick("d.title", "s.title")).alias("document_number"), pick("d.title", "s.title").alias("title"),
        clean_feed(F.col("d.status")).alias("status"), F.coalesce(F.transform("d.categories", lambda c: c.categoryName), F.col("s.productsAndServicesCategories")).alias("categories"),
        F.coalesce(F.col("d.opportunityAmount.minAmount").cast("double"), F.col("s.minAmount").try_cast("double")).alias("amount_min"), F.coalesce(F.col("d.opportunityAmount.maxAmount").cast("double"), F.col("s.maxAmount").try_cast("double")).alias("amount_max"),
        F.col("d.opportunityAmount.currency").alias("currency"), pick("d.startDate", "s.datePosted").alias("start_date"), pick("d.endDate", "s.endDate").alias("end_date"), clean_feed(F.col("d.publicPostingUrl")).alias("url"),
    )
    return {"ariba_posting": rows.filter("rfx_id is not null")}


def suspended(cells: DataFrame) -> dict[str, DataFrame]:
    """Registry rows as maps of heading to cell; a missing authority is blank, since it is keyed."""
    c = lambda n: none_if_blank(strip(F.col("cells")[n]))
    rows = cells.select(c("Supplier Name").alias("supplier_name_raw"), c("Status").alias("status"), c("Start Date of Suspension").alias("suspension_start"), c("End Date of Suspension").alias("suspension_end"), c("Type of Suspension").alias("suspension_type"), F.coalesce(c("Authority"), F.lit("")).alias("council_authority"))
    return {"suspended_firm": rows.filter("supplier_name_raw is not null")}


def listings(raw: DataFrame, buyers: DataFrame) -> dict[str, DataFrame]:
    """Portal listings of known buyers; those of unknown ones are skipped."""
    ref = native_ref(F.col("ReferenceNumber"), F.col("BidNumber"), F.col("Id"))
    known = buyers.select(F.col("slug").alias("buyer_id"))
    rows = raw.join(known, F.col("buyer_slug") == F.col("buyer_id")).select("buyer_id", ref.alias("native_ref"), clean_feed(F.col("Title")).alias("title"), collapse(F.col("StatusText")).alias("status"), clean_feed(F.col("DatePosted")).alias("posted_date"), clean_feed(F.col("ClosingDate")).alias("closing_date"), F.col("Documents").alias("documents"), F.col("Addendums").alias("addendums"), F.col("PlanTakers").alias("plan_takers"), F.lit("portal").alias("source"))
    return {"agency_solicitation": rows.filter("native_ref is not null")}


def award_summary_files(records: DataFrame) -> DataFrame:
    """(id, name, url): uploaded files that are award summaries."""
    files = F.filter("uploadedFilesStaff", lambda f: F.lower(f["name"]).contains("award summary"))
    return records.select("id", F.explode(files).alias("f")).select("id", "f.name", "f.url")


def voting_record(rows: DataFrame, order: str) -> DataFrame:
    """Award items of a voting record: the first row that names a document number."""
    from ..functions.keys import award_document_number

    named = rows.withColumn("document_number", award_document_number(F.col("`Agenda Item Title`"))).filter("document_number is not null")
    first = F.min_by(F.struct(F.col("`Agenda Item #`").alias("reference"), F.col("Committee").alias("committee"), F.col("`Agenda Item Title`").alias("title")), order)
    return named.groupBy("document_number").agg(first.alias("f")).select("document_number", "f.*")


#: What each feed's records become: the registry of sources.
NORMALIZERS = {
    "odata_solicitation": (odata_solicitations, "overwrite"),
    "odata_noncompetitive": (odata_noncompetitive, "overwrite"),
    "portal_awarded": (portal_awarded, "backfill"),
    "portal_open": (portal_open, "backfill"),
    "portal_noncompetitive": (portal_noncompetitive, "backfill"),
    "portal_capital": (portal_capital, "overwrite"),
}

"""Documents and what is extracted from them: chunks, contracts, flags, classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse, let, none_if_blank

#: The extraction record, as parsed.
EXTRACTION = (
    "contracts array<struct<reference string, solicitation_type string, title string, buyer string, posted_date string, closed_date string, documents_taken string, "
    "declared_submissions int, declared_compliant int, stage string, prequalified array<string>, invited_to_tender array<string>, "
    "bids array<struct<supplier_name string, amount_raw string, amount_basis string, status string, rank int>>, "
    "awards array<struct<supplier_name string, amount_raw string, amount_basis string, contingency_raw string, value_confidential boolean>>, "
    "funding_source string, decision_date string, decision_body string>>"
)


def split_document(text: Column, max_chars: int = 400_000) -> Column:
    """Chunks of whole sections (blank-line separated), each as long as fits; a section that is
    too long by itself stays whole. A text that fits is one chunk."""
    empty = F.array().cast("array<string>")

    def step(acc: Column, section: Column) -> Column:
        fits = F.length(acc.open) + 2 + F.length(section) <= max_chars
        grown = F.concat(acc.open, F.lit("\n\n"), section)
        return (
            F.when(acc.open.isNull(), F.struct(acc.done.alias("done"), section.alias("open")))
            .when(fits, F.struct(acc.done.alias("done"), grown.alias("open")))
            .otherwise(F.struct(F.array_append(acc.done, acc.open).alias("done"), section.alias("open")))
        )

    start = F.struct(empty.alias("done"), F.lit(None).cast("string").alias("open"))
    folded = F.aggregate(F.split(text, "\n\n", -1), start, step, lambda acc: F.array_append(acc.done, acc.open))
    return F.when(F.length(text) <= max_chars, F.array(text)).otherwise(folded)


def _unfenced(content: Column) -> Column:
    fence = r"(?s)^```(?:json)?\s*\n?(.*?)\n?\s*```"
    return F.when(content.rlike(fence), F.regexp_extract(content, fence, 1)).otherwise(content)


def parse_response(content: Column) -> Column:
    """The extraction record of a reply, its code fence gone; null if it isn't one."""
    record = F.from_json(_unfenced(content), EXTRACTION, {"mode": "PERMISSIVE"})
    return F.when(record.contracts.isNotNull(), record)


def parse_lenient(content: Column) -> Column:
    """The outermost braces of a chatty reply, as a record."""
    return parse_response(none_if_blank(F.regexp_extract(content, r"(?s)\{.*\}", 0)))


def extraction_errors(record: Column) -> Column:
    """What makes a record unacceptable, as messages; none for a good one."""
    nameless = lambda kind: F.exists(record.contracts, lambda c: F.exists(F.coalesce(c[kind], F.array()), lambda x: F.coalesce(x.supplier_name, F.lit("")) == ""))
    return F.array_compact(F.array(
        F.when(record.isNull(), "no contracts"),
        F.when(F.coalesce(nameless("bids"), F.lit(False)), "a bid without supplier_name"),
        F.when(F.coalesce(nameless("awards"), F.lit(False)), "an award without supplier_name"),
    ))


def declared_count_flags(record: Column) -> Column:
    """Contracts with fewer bids than they declare; more is no fault."""
    flags = F.transform(record.contracts, lambda c: F.struct(
        F.coalesce(c.reference, F.lit("")).alias("reference"), c.declared_submissions.alias("declared"),
        F.coalesce(F.size(c.bids), F.lit(0)).alias("actual"), (F.coalesce(F.size(c.bids), F.lit(0)) - c.declared_submissions).alias("delta"),
    ))
    return F.filter(flags, lambda f: f.delta < 0)


#: Lengths at which no pattern is asked, and the headings of each kind of document.
PACKAGE_CHARS, FRAGMENT_CHARS, HEAD_CHARS = 100_000, 1_500, 2_500
CONFIDENTIAL = r"(?i)CONFIDENTIAL ATTACHMENT"
TITLE_PATTERNS = (
    r"(?is)REPORT FOR ACTION(?:\s+WITH\s*\n?\s*CONFIDENTIAL ATTACHMENT)?\s*\n(.{6,220}?)\n\s*Date:",
    r"(?is)CONTRACT AWARD\s*\n(.{10,220}?)\n\s*Date:",
    r"(?ms)^\s*RE:\s*(.{4,200})",
    r"(?ims)^\s*Subject:\s*(.{4,200})",
    r"(?m)^\s*\d{1,2}\.\d{1,2}\s+([A-Z][^\n]{10,160})",
)
HEAD_RULES = (
    ("councillor_letter", r"(?m)Toronto City Councillor|City Councillor\s*$"),
    ("minutes", r"(?im)^\s*(PRESENT\b|MINUTES OF|MEMBERS PRESENT)"),
    ("agenda", r"(?im)^\s*(AGENDA|ORDER OF BUSINESS|NOTICE OF MEETING)"),
)
#: Attachments by their first words, and the subjects of titles.
ATTACHMENT = r"(?i)^\s*(At+ach?ment|Appendi?x|Figure|Map|Schedule)\s*\d*\s*[:.\-]"
SUBJECT_RULES = (
    ("procurement_award", r"REQUEST FOR (TENDER|PROPOSAL|QUOT|PREQUAL|SUPPLIER)|\bRF[TPQ]\b|RFSQ|VENDOR[S]? OF RECORD|\bVOR\b|CONTRACT AWARD|TENDER AWARD|AWARD OF|SOLE SOURCE|SINGLE SOURCE|BLANKET CONTRACT|NON-?COMPETITIVE|PROCUREMENT OF"),
    ("permit_regulatory", r"PERMIT|SECTION 28|S\.28|ONTARIO REGULATION|DELEGATED"),
    ("land_property", r"ACQUISITION|GREENLANDS|EXPROPRIAT|PURCHASE OF LAND|DISPOSAL|CONVEYANCE|EASEMENT|LAND EXCHANGE|SITE PLAN"),
    ("agreement_or_mou", r"MEMORANDUM OF UNDERSTANDING|SERVICE LEVEL|\bAGREEMENT\b|LICEN[CS]E|PARTNERSHIP|\bLEASE\b"),
    ("governance_finance", r"POLICY|BY-?LAW|APPOINTMENT|TERMS OF REFERENCE|GOVERNANCE|STRATEGIC PLAN|BUDGET|FINANCIAL|AUDIT|INSURANCE|WSIB|MEETING DATES|YEAR END|ANNUAL GENERAL"),
    ("status_update", r"UPDATE|PROGRESS|STATUS|SUMMARY|ANNUAL REPORT|WORK ?PLAN|REVIEW|REPORT ON"),
)


def document_title(text: Column) -> Column:
    """By the headings of each source, first that fits; white space collapsed."""
    return F.coalesce(*(none_if_blank(collapse(F.regexp_extract(text, p, 1))) for p in TITLE_PATTERNS))


def classify(text: Column) -> Column:
    """struct(class, title, confidential): length first, then headings, then the title's subject."""
    whole = F.coalesce(text, F.lit(""))
    head = F.substring(whole, 1, HEAD_CHARS)

    def classed(title: Column) -> Column:
        kind = F.when((F.length(whole) < FRAGMENT_CHARS) & title.isNull(), "empty_or_fragment").when(F.length(whole) > PACKAGE_CHARS, "meeting_package")
        for name, pattern in HEAD_RULES:
            kind = kind.when(head.rlike(pattern), name)
        kind = kind.when(F.substring(F.regexp_replace(whole, r"(?U)^\s+", ""), 1, 120).rlike(ATTACHMENT), "attachment_or_map").when(title.isNull(), "UNCLASSIFIED")
        for name, pattern in SUBJECT_RULES:
            kind = kind.when(title.rlike(f"(?i){pattern}"), name)
        return let(kind.otherwise("other_titled"), lambda k: F.struct(k.alias("class"), F.when(k.isin("other_titled", *(n for n, _ in SUBJECT_RULES)), title).alias("title"), F.substring(whole, 1, 3000).rlike(CONFIDENTIAL).alias("confidential")))

    return let(F.when(F.length(whole) <= PACKAGE_CHARS, document_title(text)), classed)  # a package's isn't asked for

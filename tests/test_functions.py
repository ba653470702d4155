"""Literal tables for the scalar functions."""

import pytest
from pyspark.sql import functions as F

from sluice.functions import amounts, documents, keys, listing, suppliers, text, titles

RAW = F.col("raw")


@pytest.mark.parametrize("raw, value", [
    ("$1,234,567.89 CAD", 1234567.89), ("500000.00", 500000.0), ("0", 0.0), ("$ 45", 45.0), ("12 cad", 12.0), (" $5 ", 5.0),
    ("942467.", None), ("1,23", None), ("12,34,567", None), ("$5 USD", None), ("kj", None), ("", None), (None, None), ("$1.2.3", None), ("-5", None), ("$45.10 per hour", None),
])
def test_parse_amount(one, raw, value):
    assert one(amounts.parse_amount(RAW), raw=raw) == value


@pytest.mark.parametrize("raw, value", [(12345678.0, 12345678.0), (-5.25, -5.25), (1.5e10, 1.5e10), (7, 7.0)])
def test_a_number_is_its_own_amount(one, raw, value):
    assert one(amounts.parse_amount(RAW), raw=raw) == value


def test_councillor_letters(one):
    from sluice.functions import documents

    assert one(documents.classify(F.col("t"))["class"], t="From Toronto City Councillor Jane Doe\n" + "plain prose " * 200) == "councillor_letter"


@pytest.mark.parametrize("raw, value", [("$2,982,036.67*", 2982036.67), ("$1,581,114.08 *", 1581114.08), ("Non-Compliant", None), ("12†‡", 12.0), ("*12", None)])
def test_parse_bid_price(one, raw, value):
    assert one(amounts.parse_bid_price(RAW), raw=raw) == value


@pytest.mark.parametrize("title, placeholder", [
    ("Sewer", False), ("Bed Frames", False), ("Doc-Ariba Doc No. 2243638006 RFP NO. 9118205024", True), ("Doc2922336030", True), ("", True), (None, True), ("  ", True), ("A B C", True), ("RFQ 12 paving", False),
])
def test_placeholder(one, title, placeholder):
    assert one(titles.is_placeholder_title(RAW), raw=title) is placeholder


@pytest.mark.parametrize("raw, number", [("Doc5672751291", "5672751291"), ("3.77E+1100", None), ("1111111111", None), ("37-77000000", "3777000000"), ("xxxxxxxx", None), (None, None)])
def test_document_number(one, raw, number):
    assert one(keys.document_number(RAW), raw=raw) == number


def test_bridge_refuses_an_eleventh_digit(one):
    bridged = keys.bridged_document_number(F.col("ext"), F.col("title"))
    assert one(bridged, ext="nothing", title="RFQ Doc1234567899 x") == "1234567899"
    assert one(bridged, ext="nothing", title="Doc12345678991") is None
    assert one(bridged, ext="Doc2243638006", title="Doc1234567899") == "2243638006"


@pytest.mark.parametrize("raw, number", [
    ("Request for Quotation No. 3905-10-0097", "3905-10-0097"), ("RFQ 9130–10–7291", "9130-10-7291"), ("Tender Call No. 120 -2011", "120-2011"), ("Tender Call No. 317-2010, Contract No. 10TE-17WS", "317-2010"), ("1850-12", None), (None, None),
])
def test_call_number(one, raw, number):
    assert one(keys.call_number(RAW), raw=raw) == number


@pytest.mark.parametrize("raw, key", [
    ("Fermar Paving Limited* Non-compliant", "fermar paving limited"), ("1234567 Ontario Inc. o/a Joe's", "#1234567"), ("1818620 o/a X", "#1818620"), ("1818620 Ontario Ltd o/a X", "#1818620"),
    ("Best Roads Ltd. operating as Roads", "best roads ltd"), ("Ontario Ltd. o/a Good Firm", "ontario ltd o a good firm"), ("Please see note", ""), ("", ""), (None, ""), ("A.B.C. Inc (Submitted by: x)", "a b c inc"), ('Appendix "A" - Price Form', ""),
])
def test_supplier_key(one, raw, key):
    assert one(suppliers.supplier_key(RAW), raw=raw) == key


def test_supplier_tokens(one):
    assert sorted(one(suppliers.supplier_tokens(RAW), raw="The Municipal Infrastructure Group & Sons Ltd")) == ["and", "infrastructure", "municipal", "sons"]


@pytest.mark.parametrize("name, ext", [("a/b.PDF", "pdf"), ("a.b/c", None), ("trailing.", ""), (None, None)])
def test_extension(one, name, ext):
    assert one(text.extension(RAW), raw=name) == ext


def test_spaces_are_unicode(one):
    assert one(text.collapse(RAW), raw=" a   b ") == "a b"
    assert one(text.clean_portal(RAW), raw=" None ") is None
    assert one(text.clean_feed(RAW), raw=" None ") == "None"


@pytest.mark.parametrize("label, good", [("a.pdf", True), ("Appendix E.zip (2 MB)", True), ("https://x/a.pdf", False), ("www.x/a.pdf", False), ("a.pdfx", False), ("", False), (None, False)])
def test_document_name(one, label, good):
    assert one(listing.is_document_name(RAW), raw=label) is good


def test_listing_order(spark):
    rows = [("4.10 b", 0), ("4.9 a", 0), ("Refs", 1), ("Refs", 0), ("4 x", 0)]
    df = spark.createDataFrame(rows, "row string, ordinal long")
    got = [tuple(r) for r in df.orderBy(*listing.listing_order(F.col("row"), F.col("ordinal"))).collect()]
    assert got == [("4 x", 0), ("4.9 a", 0), ("4.10 b", 0), ("Refs", 0), ("Refs", 1)]


def test_split_document(one):
    split = lambda t, n: one(documents.split_document(RAW, n), raw=t)
    assert split("short", 10) == ["short"]
    assert split("aaa\n\nbbb\n\nccc", 8) == ["aaa\n\nbbb", "ccc"]
    assert split("x" * 20 + "\n\nb", 8) == ["x" * 20, "b"]
    assert split("\n\n" + "a" * 9, 8) == ["", "a" * 9]


def test_responses(one):
    good = '{"contracts": [{"reference": "R", "declared_submissions": 3, "bids": [{"supplier_name": "A"}], "awards": []}]}'
    flags = documents.declared_count_flags(documents.parse_response(RAW))
    assert one(F.size(flags), raw=f"```json\n{good}\n```") == 1
    assert one(documents.parse_response(RAW), raw="no json") is None
    assert one(documents.parse_lenient(RAW), raw=f"Sure! {good} Done.") is not None
    nameless = good.replace('"A"', '""')
    assert one(documents.extraction_errors(documents.parse_response(RAW)), raw=nameless) == ["a bid without supplier_name"]


@pytest.mark.parametrize("value, kind", [
    ("short", "empty_or_fragment"), ("x" * 100_001, "meeting_package"), ("MINUTES OF x\n" + "a " * 1000, "minutes"), ("RE: Lease of land\n", "agreement_or_mou"), ("plain " * 400, "UNCLASSIFIED"), ("RE: Picnic tables\n", "other_titled"), (None, "empty_or_fragment"),
])
def test_classify(one, value, kind):
    assert one(documents.classify(RAW)["class"], raw=value) == kind

"""HTML, zips, REST pages, and the run from landed feeds to exports."""

import http.server
import io
import json
import threading
import urllib.parse
import zipfile

import pytest
from pyspark.sql import functions as F

from sluice import pipeline
from sluice.export import dictionary, document, tabular, zipped
from sluice.extraction import backfill, dedup_contracts, extract, facts, with_fallback
from sluice.functions.documents import EXTRACTION
from sluice.schemas import EXPORT_TABLES
from sluice.sources import html_tables, normalize, rest
from sluice.sources.zip_index import index_zip
from sluice.store import Archive


def bids(html):
    return [(r[2], r[3]) for r in html_tables.bid_rows(html, "2017.BA1")]


def test_row_major_with_shifted_numbers():
    html = "<table><tr><th>Bidder</th><th>Price</th></tr><tr><td>1</td><td>Joe Inc.**</td><td>$5</td></tr><tr><td>2. Pave</td><td></td></tr></table>"
    assert bids(html) == [("Joe Inc.", "$5"), ("Pave", None)]


def test_column_major():
    assert bids("<table><tr><td>Number of Bids:</td><td><p>Firm Name</p><p>A</p><p>B</p></td><td><p>Bid Price</p><p>$ 1.00</p><p>$ 2.00</p></td></tr></table>") == [("A", "$ 1.00"), ("B", "$ 2.00")]
    assert bids("<table><tr><td rowspan=2>N:</td><td>Firm Name</td><td>Price</td></tr><tr><td>A<br>B</td><td>$1.00<br/>No bid</td></tr></table>") == [("A", "$1.00"), ("B", "No bid")]


def test_column_major_below_and_beside():
    rows = "<tr><td rowspan=3>Bids:</td><td>Contractor:</td><td>Extra</td><td>Bid Amount</td></tr><tr><td>A<br>2. B</td><td>x<br>y</td><td>$1.00<br>$2.00</td></tr>"
    assert bids(f"<table>{rows}<tr><td>C*</td><td>z</td><td>withdrawn</td></tr></table>") == [("A", "$1.00"), ("B", "$2.00"), ("C", "withdrawn")]
    assert bids(f"<table>{rows}<tr><td>note</td><td></td><td>see below</td></tr><tr><td>D</td><td>z</td><td>$3.00</td></tr></table>") == [("A", "$1.00"), ("B", "$2.00")]
    assert bids(f"<table>{rows}<tr><td>C</td><td>z</td><td>$3.00<br>$4.00</td></tr><tr><td>D</td><td>z</td><td>$5.00</td></tr></table>") == [("A", "$1.00"), ("B", "$2.00"), ("D", "$5.00")]
    assert bids(f"<table>{rows}<tr><td>1</td><td>2</td><td>C</td><td>z</td><td>$3.00</td></tr></table>") == [("A", "$1.00"), ("B", "$2.00")]


def test_unequal_columns_are_refused():
    assert bids("<table><tr><td><p>Firm Name</p><p>A</p><p>B</p></td><td><p>Price</p><p>$1.00</p></td></tr></table>") == []


def test_finance_tables_are_not_bids():
    assert bids("<table><tr><td>Cost centre</td><td>Amount</td></tr><tr><td>WBS</td><td>$5.00</td></tr></table>") == []


def test_links_belong_to_the_last_heading():
    html = '<a href="/legdocs/mmis/0.pdf">m</a><h3>BA1.2 - Award A</h3><a href="/legdocs/mmis/1.pdf">x</a><h3>other</h3><a href="/legdocs/mmis/1.pdf">y</a>'
    assert html_tables.agenda_pdfs(html, "2017.BA1") == [("/legdocs/mmis/0.pdf", "2017.BA1"), ("/legdocs/mmis/1.pdf", "2017.BA1.2")]


def test_housekeeping_is_no_item():
    html = "<h2>BA1.1 - Confirmation of Minutes</h2><h2>BA1.2 - Award 2243638006 and 2243638006</h2>"
    assert html_tables.agenda_items(html, "2017.BA1") == [("2017.BA1.2", "Award 2243638006 and 2243638006", ["2243638006"])]


def test_registry_raises_on_arity():
    with pytest.raises(ValueError):
        html_tables.registry("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td></tr></table>")
    assert html_tables.registry("<table><tr><th>A</th></tr><tr><td>1</td></tr></table>") == [{"A": "1"}]


def test_report_link():
    html = '<li>Doc 1234567899 <a href="backgroundfile-1.pdf">a</a></li><li><a href="backgroundfile-2.pdf">b</a></li>'
    assert html_tables.report_link(html, "1234567899") == "backgroundfile-1.pdf"
    assert html_tables.report_link(html, "555") is None
    assert html_tables.report_link('<a href="backgroundfile-2.pdf">b</a>', "555") == "backgroundfile-2.pdf"


def test_pre_number_awards():
    text = "BA1.2 - Award of Call 12-2017 to Big Co. for Works\n is $1,234.50 net of all applicable taxes. BA1.3 - Award 1234567899 to X for Y $5 net of all applicable taxes"
    assert html_tables.pre_number_awards(f"<p>{text}</p>", "2017.BA1") == [("2017.BA1.2", "Award of Call 12-2017 to Big Co. for Works", "Big Co.", "1,234.50")]


def test_nested_zip():
    inner, outer = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("b/c.txt", "hello")
    with zipfile.ZipFile(outer, "w") as z:
        z.writestr("a.txt", "x")
        z.writestr("in.zip", inner.getvalue())
        z.writestr("bad.zip", b"not a zip")
    got = index_zip(outer.getvalue())
    assert [(name, path, size) for name, path, size, _ in got] == [("a.txt", "a.txt", 1), ("c.txt", "in.zip/b/c.txt", 5), ("bad.zip", "bad.zip", 9)]
    with pytest.raises(ValueError):
        index_zip(outer.getvalue(), most=1)


class Feed(http.server.BaseHTTPRequestHandler):
    rows = [{"id": str(i), "Status": "Open" if i % 2 else "Closed"} for i in range(25)]
    seen: list = []
    most = 1000
    failures = {"n": 1}

    def do_GET(self):
        q = {k: v[0] for k, v in urllib.parse.parse_qs(urllib.parse.urlparse(self.path).query).items()}
        if Feed.failures["n"]:
            Feed.failures["n"] -= 1
            self.send_response(503)
            self.end_headers()
            return
        Feed.seen.append(q)
        body = json.dumps({"value": self.rows[int(q["$skip"]) : int(q["$skip"]) + min(int(q["$top"]), Feed.most)], "@odata.count": len(self.rows)}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_paged_rest(spark):
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Feed)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        got = rest.read_feed(spark, f"http://127.0.0.1:{server.server_port}/feed", "id string, Status string", page_size="10")
        assert sorted(int(r.id) for r in got.collect()) == list(range(25))
        Feed.most = 2  # a server that caps its pages
        got = rest.read_feed(spark, f"http://127.0.0.1:{server.server_port}/feed", "id string, Status string", page_size="10")
        assert sorted(int(r.id) for r in got.collect()) == list(range(25))
    finally:
        server.shutdown()


def test_zipped_csv_keeps_rows_like_the_header(spark, tmp_path):
    t = spark.createDataFrame([("a", "b"), ("x", "y"), ("a", "b"), (None, "z")], "a string, b string").repartition(3)
    z = zipped.zip_csv({"t": t}, f"{tmp_path}/t.zip")
    with zipfile.ZipFile(z) as f:
        lines = f.read("t.csv").decode().splitlines()
    assert lines[0] == "a,b" and sorted(lines[1:]) == [",z", "a,b", "a,b", "x,y"]


FEED = {
    "odata_solicitation": [
        {"Solicitation_Document_Number": "Doc2243638006", "Status": "Awarded", "Posting_Title": "Doc2243638006", "Ariba_Discovery_Posting_Link": "https://x/RfxEvent/preview/77", "Client_Division": ["Parks", "x"], "Awarded_Suppliers": [{"Successful_Bidder": "A Co Ltd", "Award_Amount": "$5.00", "Date_Awarded": "", "AwardedDate": "2020-01-01"}, {"Successful_Bidder": ""}]},
        {"Solicitation_Document_Number": "nothing"},
    ],
    "odata_noncompetitive": [],
    "portal_awarded": [{"Document Number": "2243638006", "High Level Category": "Goods", "Division": "Other", "Successful Supplier": "B Inc", "Award": "kj"}, {"Document Number": "xxxxxxxx"}],
    "portal_open": [], "portal_noncompetitive": [], "portal_capital": [{"Name and Construction Contract Number": "Works - 25ECS-MI-02SW"}],
}


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("archive")
    a = Archive(spark, f"{root}/a")
    sources = []
    for name, (f, mode) in normalize.NORMALIZERS.items():
        path = root / name
        path.mkdir()
        (path / "x.json").write_text("".join(json.dumps(r) + "\n" for r in FEED[name]))
        sources.append(pipeline.Source(name, lambda p=str(path), n=name: rest.landed(spark, p, normalize.FEEDS[n]), f, mode))
    sources.append(pipeline.Source("broken", lambda: spark.read.json(f"{root}/missing"), lambda raw: {}))
    labels = spark.createDataFrame([("kj", 7.0, "amount")], "raw string, value double, verdict string")
    runs = pipeline.sync(a, sources, labels=labels)
    return a, runs, root


def test_sync(archive):
    a, runs, _ = archive
    assert {r.source: r.status for r in runs if r.status != "ok"} == {"broken": "failed"}
    s = a.read("solicitation").collect()
    assert len(s) == 1 and s[0].title is None and s[0].division == "Parks" and s[0].category == "Goods" and s[0].first_seen is not None
    awards = {r.supplier_name_raw: r for r in a.read("award").collect()}
    assert awards["A Co Ltd"].award_amount_numeric == 5.0 and awards["A Co Ltd"].award_date == "2020-01-01"
    assert awards["B Inc"].award_amount_numeric is None and awards["B Inc"].award_amount_labelled == 7.0
    assert {r.supplier_key for r in a.read("supplier").collect()} == {"a co ltd", "b inc"}
    assert awards["A Co Ltd"].supplier_id is not None
    assert a.read("sync_run").filter("status = 'failed'").count() == 1
    assert a.read("capital_project").first().contract_number == "25ECS-MI-02SW"


def test_link_passes(spark, tmp_path):
    a = Archive(spark, f"{tmp_path}/a")
    docs = ["2243000001", "2243000002", "2243000003", "2243000004", "2243000005", "2243000006"]
    titles = [None, None, None, "Feed words", None, None]
    spine = spark.createDataFrame([(d, t, "feed" if t else None) for d, t in zip(docs, titles)], "document_number string, title string, title_source string")
    awards = spark.createDataFrame([
        (docs[1], "Big Co. Ltd", "$1,234.50", "odata"), (docs[2], "Twin Works", "$77.00", "odata"), (docs[3], "Feed Firm", "$900.00", "odata"),
        (docs[4], "Twin Builders", "$77.00", "odata"), (docs[5], "Compo Inc", "$55.00", "odata"), (docs[0], "Other Book", "$900.00", "ckan"),
    ], "document_number string, supplier_name_raw string, award_amount string, source string")
    a.upsert("solicitation", spine, "overwrite")
    a.upsert("award", awards.withColumn("award_date", F.lit("2018-01-01")), "overwrite")
    a.upsert("council_item", spark.createDataFrame([("2019.BA10.1", f"Later {docs[0]}"), ("2019.BA9.1", f"First {docs[0]}"), ("2019.BA9.2", None)], "reference string, title string"), "overwrite")
    a.upsert("composite_award", spark.createDataFrame([("1-2010", "Compo Limited", "$55.00", "Sewers", "2010.BA1.1", "composite")], "call_number string, supplier_name_raw string, award_value string, title string, reference string, source string"), "overwrite")
    items = spark.createDataFrame([
        ("2017.BA1.2", "Award to Big Co. for Works", "Big Co.", 1234.5), ("2017.BA1.3", "Twins", "Twin Works and Twin Builders", 77.0), ("2017.BA2.1", "Feed", "Feed Firm", 900.0),
        ("2017.BA2.2", "Stranger", "Nobody Else", 1234.5), ("2017.BA2.3", "No value", "Big Co.", None), (None, "No reference", "Big Co.", 1234.5),
    ], "reference string, title string, winner_raw string, award_value double")
    for again in range(2):  # a second run changes nothing
        runs = pipeline.link_passes(a, panel=pipeline.Panel(items))
        assert not [r.error for r in runs if r.status != "ok"]
        got = {r.document_number: (r.title, r.title_source) for r in a.read("solicitation").collect()}
        assert got == {
            docs[0]: (f"First {docs[0]}", "council"), docs[1]: ("No reference", "council_match"), docs[2]: (None, None),
            docs[3]: ("Feed words", "feed"), docs[4]: (None, None), docs[5]: ("Sewers", "composite_match"),
        }
        links = {r.reference: (r.document_number, r.method) for r in a.read("solicitation_link").collect()}
        assert links == {"2017.BA1.2": (docs[1], "council_match"), "2017.BA2.1": (docs[3], "council_match")}
    seen = {r.reference: r.first_seen for r in a.read("solicitation_link").collect()}
    page = spark.createDataFrame([(d, "Posting") for d in docs], "document_number string, title string")
    pipeline.link_passes(a, panel=pipeline.Panel(items.limit(0), page))
    assert {r.reference: r.first_seen for r in a.read("solicitation_link").collect()} == seen
    got = {r.document_number: (r.title, r.title_source) for r in a.read("solicitation").collect()}
    assert got[docs[0]] == ("Posting", "legacy_page") and got[docs[1]][1] == "council_match" and got[docs[3]][1] == "feed" and got[docs[2]] == ("Posting", "legacy_page")


def test_enrich_titles_command(spark, tmp_path):
    from sluice import cli

    a = Archive(spark, f"{tmp_path}/a")
    a.upsert("solicitation", spark.createDataFrame([("2243000001",), ("2243000002",)], "document_number string"), "overwrite")
    a.upsert("award", spark.createDataFrame([("2243000001", "Big Co. Ltd", "$1,234.50", "odata")], "document_number string, supplier_name_raw string, award_amount string, source string").withColumn("award_date", F.lit("2018-01-01")), "overwrite")
    (tmp_path / "pages").mkdir()
    for meeting in ("2017.BA1", "2020.BA1"):
        (tmp_path / "pages" / f"{meeting}.html").write_text("<p>BA1.2 - Award of Call 7-2017 to Big Co. for Works is $1,234.50 net of all applicable taxes.</p>")
    folder = tmp_path / "old" / "Doc2243000002"
    folder.mkdir(parents=True)
    (folder / "a.html").write_text("<title>Doc-2243000002</title>")
    (folder / "b.html").write_text("<title>Snow &amp; Ice</title>")
    args = cli.parser().parse_args(["--archive", f"{tmp_path}/a", "enrich-titles", "--pages", f"{tmp_path}/pages", "--archived", f"{tmp_path}/old"])
    assert args.run(a, args) == 0
    assert {(r.document_number, r.title_source) for r in a.read("solicitation").collect()} == {("2243000001", "council_match"), ("2243000002", "legacy_page")}
    assert {r.reference for r in a.read("solicitation_link").collect()} == {"2017.BA1.2"}


def test_export(archive):
    a, _, root = archive
    tables = {t: a.read(t) for t in EXPORT_TABLES}
    sections = document.archive(tables)
    awards = sections["solicitations"].select(F.size("awards").alias("n")).first().n + sections["unlinked_awards"].count()
    assert awards == tables["award"].count()
    paths = document.write_json(sections, f"{root}/out", "now")
    assert json.loads(next(r.value for r in a.spark.read.text(paths["solicitations"]).collect()))["generated_at"] == "now"
    flat = {t: tables[t] for t in ("award", "sync_run")}
    tabular.write_parquet(flat, f"{root}/out")
    z = zipped.zip_csv(flat, f"{root}/out/t.zip")
    with zipfile.ZipFile(z) as f:
        assert sorted(f.namelist()) == ["award.csv", "sync_run.csv"] and len(f.read("award.csv").splitlines()) == 3
    m = {r.name: r.bytes for r in dictionary.manifest(a.spark, [z, f"{root}/out/parquet", f"{root}/nothing"]).collect()}
    assert m.keys() == {"t.zip", "parquet"} and all(v > 0 for v in m.values())
    with pytest.raises(ValueError):
        dictionary.schema_rows(a.spark, flat, {"award.no_such": "x"})


def test_extraction(spark):
    d = spark.createDataFrame([("u1", "one\n\ntwo", "ep"), ("u2", "", "ep"), ("u3", "no", "ep"), ("u4", "one\n\ntwo", "ep")], "url string, text string, source string").withColumns({"key": F.col("url"), "sha256": F.sha2("text", 256)})
    labels = spark.createDataFrame([("u3", False)], "key string, flag boolean")
    cache = spark.createDataFrame([], "sha256 string, extractor_version string, result_json string")

    def client(prompt):
        name = "A" if prompt.endswith("one") else "B"
        return json.dumps({"contracts": [{"reference": f"R{name}", "bids": [{"supplier_name": name, "amount_raw": "$1"}], "awards": [{"supplier_name": ""}] if name == "C" else [{"supplier_name": name}]}]})

    done = extract(d, cache, labels, "v1", client, max_chars=4)
    rows = done.collect()
    assert len(rows) == 1 and rows[0].chunks == 2 and rows[0].error is None
    assert extract(d, done.select("sha256", "extractor_version", "result_json"), labels, "v1", client).count() == 0
    found = backfill(facts(done, d.filter("url = 'u1'"), "v1"))
    assert sorted(r.bidder_name_raw for r in found["agency_bid"].collect()) == ["A", "B"]
    assert found["bid"].count() == 0 and {r.status for r in found["agency_solicitation"].collect()} == {"awarded"}


def test_dedup_contracts(spark):
    c = [("R", 1), ("R", 2), (None, 0), ("S", 0), ("R", 2)]
    rec = json.dumps({"contracts": [{"reference": r, "bids": [{"supplier_name": str(i)} for i in range(n)]} for r, n in c]})
    got = spark.createDataFrame([(rec,)], "r string").select(dedup_contracts(F.from_json("r", EXTRACTION).contracts).alias("c")).first().c
    assert [(x.reference, len(x.bids)) for x in got] == [("R", 2), ("S", 0), (None, 0)]


def test_fallback():
    calls = []

    def bad(p):
        calls.append("bad")
        raise ConnectionError

    assert with_fallback([bad, lambda p: "ok"], retries=1, pause=0)("x") == "ok" and calls == ["bad", "bad"]


def test_discovery_probes_and_remembers():
    from sluice.sources.landing import cache_aside, discover_meetings

    real = {"2017.BA1", "2017.BA2", "2018.BA3", "2018.BA5", "2019.BA1"}
    asked, held, closed = [], {}, {}

    def fetch(ref):
        asked.append(ref)
        return "agenda" if ref in real else "This meeting is not available"

    get = cache_aside(held.get, held.__setitem__, fetch)
    terms = [("BA", 2017, "2014-2018", 1), ("BA", 2019, "2018-2022", 1)]
    found = discover_meetings(get, terms, misses=3, on_closed=closed.__setitem__)
    assert found.keys() == real and closed == {"BA2014-2018": 5} and held.keys() == real
    asked.clear()
    discover_meetings(get, terms, closed, misses=3)
    assert not any(a.endswith(("BA6", "BA7", "BA8")) for a in asked)


def test_sweep_needs_permission(spark):
    from sluice.sources.landing import sweep

    data = {1: [{"Id": str(i)} for i in range(5)], 2: []}
    page = lambda status, start: (data[status][start : start + 2], len(data[status]))
    with pytest.raises(PermissionError):
        sweep(spark, {"slug": "x", "enabled": True}, [1, 2], page)
    got = sweep(spark, {"slug": "x", "enabled": True, "permission": "letter"}, [1, 2], page).collect()
    assert len(got) == 5 and {r.status_code for r in got} == {1}


def test_awards_of_pages_with_long_numbers(spark, tmp_path):
    """Pages from 1000 on: their values are written as amounts are, with each thousand set apart."""
    from sluice.plans.layouts import awards_by_layout

    ids = [0, 3, 999, 1003, 2499, 150003]
    spark.createDataFrame([(i,) for i in ids], "page_id long").write.parquet(f"{tmp_path}/pages.parquet")
    want = {(p, f"2016.BA3.{i}", f"Big {i} Co.", float(f"{p}{100 + i}.50")) for p in ids for i in (1, 4) if i <= p % 4 + 1}
    assert set(map(tuple, awards_by_layout(spark, str(tmp_path)).collect())) == want

"""Discovery in waves, the commands over landed files, reports and settings."""

import json
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sluice import cli, pipeline
from sluice.settings import portals, setting
from sluice.sources.discovery import Discovery, Term, calendar, index_documents
from sluice.sources.landing import discover_meetings
from sluice.store import Archive

MISSING = "This meeting is not available"


def logged(tmp_path, real):
    log = f"{tmp_path}/asked"

    def fetch(reference):
        with open(log, "a") as f:
            f.write(reference + "\n")
        if reference == "die":
            raise OSError
        return f"page {reference}" if reference in real else MISSING

    return fetch, lambda: Path(log).read_text().split()


REAL = {"2015.ZB1", "2015.ZB2", "2016.ZB4", "2017.ZB5", "2018.ZB7", "2018.ZB12", "2020.ZB9", "2019.ZB1", "2019.ZB2", "2020.ZB3"}
TERMS = (Term("ZB", 2015, 2018), Term("ZB", 2019, 2022, open=True))


@pytest.mark.parametrize("wave", [1, 3, 16])
def test_waves_find_what_the_sequential_rule_finds(spark, tmp_path, wave):
    fetch, _ = logged(tmp_path, REAL)
    found = Discovery(spark, f"{tmp_path}/d").run(fetch, TERMS, wave=wave, misses=3, most=20, tasks=3).collect()
    want = discover_meetings(lambda r: "page" if r in REAL else MISSING, [("ZB", 2015, "2014-2018", 1), ("ZB", 2019, "2018-2022", 1)], most=20, misses=3)
    assert sorted(f"{r.year}.ZB{r.number}" for r in found) == sorted(want)
    assert all(r.html == f"page {r.year}.ZB{r.number}" for r in found)


def test_discovery_goes_on_and_leaves_closed_terms(spark, tmp_path):
    fetch, asked = logged(tmp_path, REAL)
    d = Discovery(spark, f"{tmp_path}/d")

    def dies(reference):
        if reference == "2020.ZB5":
            raise OSError("down")
        return fetch(reference)

    with pytest.raises(Exception, match="down"):
        d.run(dies, TERMS, wave=2, misses=3, most=20, tasks=2)
    n = len(asked())
    assert d.log.read().count() > 0
    d.run(fetch, TERMS, wave=2, misses=3, most=20, tasks=2)
    assert not {"2015.ZB1", "2019.ZB1"} & set(asked()[n:])  # kept by the run that died
    n = len(asked())
    fetch2, _ = logged(tmp_path, REAL | {"2021.ZB4"})
    found = d.run(fetch2, TERMS, wave=2, misses=3, most=20, tasks=2).collect()
    assert ("ZB2019-2022", 4, 2021) in {(r.term, r.number, r.year) for r in found}
    again = asked()[n:]
    assert again and not any(int(r[:4]) < 2019 for r in again) and not {"2019.ZB1", "2020.ZB3"} & set(again)


def test_calendar(spark, tmp_path):
    base = "https://b/"
    answers = {2020: json.dumps({"d": [{"ID": "m1", "HasAgenda": True}, {"ID": "m2", "HasAgenda": True}, {"ID": "m3", "HasAgenda": False}]})}
    page = '<a href="filestream.ashx?DocumentId=7">Report</a><img src="filestream.ashx?DocumentId=8">'

    def one(url):
        if "m2" in url:
            raise OSError("404")
        return page

    documents, assets, errors = calendar(spark, [2019, 2020], lambda y: answers[y], one, base, tasks=2)
    urls = [r.url for r in documents.collect()]
    assert len(urls) == 1 and "DocumentId=7" in urls[0]
    assert {r.asked.split("Id=")[-1].split("&")[0]: r.error for r in errors.collect()} == {"2019": "KeyError: 2019", "m2": "OSError: 404"}
    a = Archive(spark, f"{tmp_path}/a")
    stale = [r.url for r in assets.collect()]
    assert stale
    a.upsert("background_pdf", spark.createDataFrame([(stale[0], None), ("held", "x")], "url string, sha256 string"), "backfill")
    assert index_documents(a, documents, assets.unionByName(spark.createDataFrame([("held",)], "url string"))) == (1, 1)
    assert {r.url for r in a.read("background_pdf").collect()} == {urls[0], "held"}


@pytest.fixture(scope="module")
def home(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("home")
    return Archive(spark, f"{root}/a"), root


def run(archive, *words):
    args = cli.parser().parse_args(["--archive", archive.root, *map(str, words)])
    return args.run(archive, args) or 0


def test_council_and_awards(home, capsys):
    a, root = home
    (root / "items").mkdir()
    (root / "items" / "2020.GL1.1.html").write_text("<h1>Award of Doc 2243000001</h1><h2>Decision</h2><p>Approved.</p><h2>Files</h2><a href='https://x/r.pdf'>r</a>")
    (root / "items" / "2020.GL1.2.html").write_text("<p>nothing here</p>")
    assert run(a, "enrich-council", "--pages", root / "items") == 0
    assert [(r.reference, r.decision_text) for r in a.read("council_item").collect()] == [("2020.GL1.1", "Approved.")]
    (root / "records").mkdir()
    (root / "records" / "r.json").write_text(json.dumps({"id": "9", "uploadedFilesStaff": [{"name": "Award Summary.pdf", "url": "https://x/s.pdf"}, {"name": "o.pdf", "url": "u"}]}))
    assert run(a, "enrich-awards", "--records", root / "records") == 0 and run(a, "enrich-awards", "--records", root / "records") == 0
    assert "1 award summaries still to be fetched" in capsys.readouterr().out
    assert {r.url: r.kind for r in a.read("background_pdf").collect()} == {"https://x/r.pdf": "other", "https://x/s.pdf": "award_summary"}


def test_committee_awards_and_agencies(home, capsys):
    a, root = home
    (root / "votes").mkdir()
    (root / "votes" / "v.csv").write_text('Agenda Item #,Committee,Agenda Item Title\n2026.GG1.1,GG,"Award of Doc 2243000002, works"\n2026.GG1.2,GG,Other\n')
    (root / "gg").mkdir()
    (root / "gg" / "2026.GG1.1.html").write_text("<p>Doc 2243000002 <a href='https://x/backgroundfile-1.pdf'>r</a></p>")
    assert run(a, "enrich-committee-awards", "--votes", root / "votes", "--pages", root / "gg") == 0
    held = {r.url: r for r in a.read("background_pdf").collect()}
    assert held["https://x/backgroundfile-1.pdf"].document_number == "2243000002" and held["https://x/backgroundfile-1.pdf"].kind == "committee_award"
    (root / "boards").mkdir()
    (root / "boards" / "2019.ZB1.html").write_text("<h3>ZB1.2 - Works</h3><a href='https://x/zb/bgrd/backgroundfile-2.pdf'>r</a>")
    assert run(a, "enrich-agencies", "--pages", root / "boards") == 0
    assert a.read("buyer").count() == 3


def test_attachments_validation_and_publishing(home, spark, capsys):
    a, root = home
    (root / "zips").mkdir()
    with zipfile.ZipFile(root / "zips" / "Doc2243000001.zip", "w") as z:
        z.writestr("a.txt", "a")
    (root / "zips" / "Doc2243000003.zip").write_bytes(b"junk")
    assert run(a, "enrich-attachments", root / "zips") == 0 and run(a, "enrich-attachments", root / "zips", "--reindex") == 0
    assert "unreadable: Doc2243000003.zip" in capsys.readouterr().out
    assert [(r.document_number, r.path) for r in a.read("ariba_attachment").collect()] == [("2243000001", "a.txt")]
    a.upsert("background_pdf", spark.createDataFrame([("https://x/r.pdf", "h1"), ("https://x/s.pdf", "h2")], "url string, sha256 string"), "overwrite")
    record = {"contracts": [{"reference": "R", "declared_submissions": 2, "bids": [{"supplier_name": "A  Co"}], "awards": [{"supplier_name": "Odd"}]}]}
    a.upsert("extraction_cache", spark.createDataFrame([("h1", "v1", json.dumps(record))], "sha256 string, extractor_version string, result_json string"), "overwrite")
    truth = [{"id": str(k), "url": u, "none_present": k == 9, "entries": [{"company": "a co", "contract": "R"}, {"company": "B", "contract": "R"}]} for k, u in enumerate(("https://x/r.pdf", "https://x/s.pdf", "nowhere"))]
    (root / "truth.json").write_text(json.dumps({"documents": truth}, indent=1))
    assert run(a, "extract-validate", root / "truth.json") == 0
    said = capsys.readouterr().out
    assert "compared 1, entries 2, TP 1, FN 1, FP 1, recall 50.0%, precision 50.0%" in said
    assert "https://x/r.pdf: compared; missed b; R declared 2, got 1" in said and "https://x/s.pdf: not_extracted" in said and "nowhere: not_in_db" in said
    out = root / "out"
    (out / "json").mkdir(parents=True)
    (out / "json" / "x").write_text("x" * 100)
    assert run(a, "publish", "--to", out, "--name", "v1") == 0
    (out / "json" / "x").write_text("x" * 10)
    with pytest.raises(ValueError, match="held back: json"):
        run(a, "publish", "--to", out, "--name", "v2")


def test_a_corpus_is_rebuilt_from_its_cache(spark, tmp_path):
    from sluice.extraction import extract_and_backfill

    a = Archive(spark, f"{tmp_path}/a")
    zoo = [(f"https://x/zb/{k}.pdf", "agency_board", f"h{k}", f"text {k}") for k in range(3)]
    a.upsert("background_pdf", spark.createDataFrame([*zoo, ("https://x/ep/1.pdf", "agency_board", "h9", "other")], "url string, kind string, sha256 string, text string"), "overwrite")
    labels = spark.createDataFrame([("https://x/zb/2.pdf", False)], "key string, flag boolean")
    with pytest.raises(ValueError, match="2 documents"):
        extract_and_backfill(a, "zoo", "v1", labels)
    with pytest.raises(ValueError, match="no corpus"):
        extract_and_backfill(a, "moon", "v1", labels)

    def client(prompt):
        one = {"reference": "R1", "title": "Works", "bids": [{"supplier_name": "A", "amount_raw": "$5"}, {"supplier_name": "B", "amount_raw": "$6"}], "awards": [{"supplier_name": "A", "amount_raw": "$5"}]}
        return json.dumps({"contracts": [one]})

    written = extract_and_backfill(a, "zoo", "v1", labels, client)
    assert written["agency_bid"] == 2 and written["agency_award"] == 1  # two documents that say the same
    assert extract_and_backfill(a, "zoo", "v1", labels)["agency_bid"] == 2
    assert sorted((r.native_ref, r.bidder_name_raw, r.bid_price_numeric) for r in a.read("agency_bid").collect()) == [("R1", "A", 5.0), ("R1", "B", 6.0)]
    assert [(r.buyer_id, r.native_ref, r.status) for r in a.read("agency_solicitation").collect()] == [("zoo", "R1", "awarded")]
    with pytest.raises(ValueError):
        extract_and_backfill(a, "ep", "v1", labels)


def test_summary_and_growth():
    runs = [pipeline.Run("a", "ok", fetched=1200, seconds=75), pipeline.Run("b", "failed", error="no")]
    text = pipeline.summary(runs, pipeline.growth({"award": 5, "bid": 2, "sync_run": 1}, {"award": 8, "bid": 2, "sync_run": 9}), 3 << 20, exported=True)
    assert text.split("\n") == ["2 steps, 1 failed, 1m15s", "  a: ok, 1m15s", "  a: 1,200 fetched", "  award: 8 (+3)", "  export 3.0 MiB", "  b: no"]
    assert pipeline.growth({}, {"award": 8}) == [] and "export FAILED" in pipeline.summary([], exported=True)
    said = []
    assert not pipeline.post("x", None) and not pipeline.post("x", "http://127.0.0.1:9/secret", said.append) and "secret" not in said[0]


def test_placeholders_count_as_unset(tmp_path):
    env = {"A": "real", "B": "your-key-here", "C": "<token>", "D": " ", "E": "changeme", "F": "odd", "G": "yourself"}
    assert [setting(k, "none", ("odd",), env) for k in "ABCDEFGH"] == ["real", "none", "none", "none", "none", "none", "yourself", "none"]
    path = tmp_path / "p.json"
    path.write_text(json.dumps([{"slug": "x", "enabled": False}, {"slug": "y", "enabled": True, "permission": "letter"}]))
    assert [p["slug"] for p in portals(str(path))] == ["y"]
    path.write_text(json.dumps([{"slug": "x", "enabled": True}]))
    with pytest.raises(PermissionError):
        portals(str(path))

"""Command line: ``python -m sluice.cli --archive DIR COMMAND``."""

from __future__ import annotations

import argparse
import datetime

from pyspark.sql import functions as F

from . import pipeline
from .export import dictionary, document, publish, tabular, zipped
from .extraction import CORPORA, backfill, extract, extract_and_backfill, facts
from .functions.amounts import parse_amount
from .functions.text import pdf_kind
from .functions.titles import clean_title
from .keyed import KeyedTable
from .operators import evaluate
from .operators.ledger import last_runs
from .operators.match import chronological, folder_titles
from .schemas import EXPORT_TABLES, TABLES
from .session import local_session
from .settings import setting
from .sources import html_tables, landing, links, normalize, rest
from .sources.bundles import Bundles
from .store import Archive


def sources(archive: Archive, landing: str) -> list[pipeline.Source]:
    """Feeds landed as JSON lines under ``landing/<feed>``."""
    spark = archive.spark
    return [pipeline.Source(name, lambda n=name: rest.landed(spark, f"{landing}/{n}", normalize.FEEDS[n]), f, mode) for name, (f, mode) in normalize.NORMALIZERS.items()]


def panel(archive: Archive, pages: str | None, archived: str | None) -> pipeline.Panel:
    """Items without a document number of agendas before 2019, and titles of pages in folders named by their document."""
    items = titles = None
    if pages:
        old = rest.cached_pages(archive.spark, pages).withColumnRenamed("stem", "meeting").filter(F.substring_index("meeting", ".", 1) < "2019")
        rows = old.lateralJoin(html_tables.PreNumberAwards(F.col("html").outer(), F.col("meeting").outer()))
        items = rows.select("reference", "title", "winner_raw", parse_amount(F.col("value_raw")).alias("award_value"))
    if archived:
        held = archive.spark.read.option("recursiveFileLookup", True).text(archived, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html"))
        titles = folder_titles(held.select(F.regexp_extract("path", r"([^/]*)/[^/]*$", 1).alias("folder"), clean_title(links.page_title(F.col("html"))).alias("title"), "path"), "path")
    return pipeline.Panel(items, titles)


def cmd_sync(archive, args):
    runs = pipeline.sync(archive, sources(archive, args.landing), args.only, panel=panel(archive, args.pages, args.archived))
    print(pipeline.summary(runs))
    return int(any(r.status != "ok" for r in runs))


def cmd_status(archive, args):
    archive.counts().orderBy("table_name").show(100, False)
    last_runs(archive.read("sync_run")).orderBy("source").show(100, False)


def cmd_export(archive, args):
    at = datetime.datetime.now(datetime.timezone.utc).isoformat()
    tables = {t: archive.read(t) for t in EXPORT_TABLES}
    document.write_json(document.archive({t: d.drop("text") for t, d in tables.items()}), args.to, at)
    dictionary.schema_rows(archive.spark, tables).withColumn("generated_at", F.lit(at)).coalesce(1).write.mode("overwrite").json(f"{args.to}/schema")
    tabular.write_parquet(tables, args.to)
    flat = {t: d.select(*(F.to_json(c).alias(c) if kind.startswith("array") else F.col(c) for c, kind in d.dtypes)) for t, d in tables.items()}
    tabular.write_csv(flat, args.to)
    zipped.zip_csv({t: tabular.published(d) for t, d in tables.items()}, f"{args.to}/tables.zip")


def cmd_manifest(archive, args):
    for r in dictionary.manifest(archive.spark, [f"{args.to}/{p}" for p in ("json", "schema", "parquet", "csv", "tables.zip")]).collect():
        print(f"{r['name']}\t{r['bytes']}")


def cmd_record_step(archive, args):
    pipeline.record(archive, [pipeline.Run(args.name, args.status, error=args.error)])


def cmd_nightly(archive, args):
    before = {r["table_name"]: r["n"] for r in archive.counts().collect()}
    runs = pipeline.nightly(archive, sources(archive, args.landing), [], lambda: cmd_export(archive, args))
    after = {r["table_name"]: r["n"] for r in archive.counts().collect()}
    size = None
    if runs[-1].status == "ok":
        size = sum(r["bytes"] for r in dictionary.manifest(archive.spark, [f"{args.to}/json"]).collect())
    told = pipeline.summary(runs, pipeline.growth(before, after), size, exported=True)
    print(told)
    pipeline.post(told, setting("SLUICE_WEBHOOK"), print)
    return int(any(r.status != "ok" for r in runs))


def cmd_enrich_titles(archive, args):
    """Items, reports and bids from cached agenda pages named by their meeting; then the link passes."""
    pages = rest.cached_pages(archive.spark, args.pages)
    pages = pages.withColumnRenamed("stem", "meeting")
    placed = chronological(F.col("meeting")).alias("_meeting"), F.monotonically_increasing_id().alias("_row")  # rows of a page stay together
    items = pages.lateralJoin(html_tables.AgendaItems(F.col("html").outer(), F.col("meeting").outer())).select("reference", "meeting", "title", *placed)
    pdfs = pages.lateralJoin(html_tables.AgendaPdfs(F.col("html").outer(), F.col("meeting").outer())).select("url", "reference", pdf_kind(F.col("url")).alias("kind"), *placed)
    bids = pages.lateralJoin(html_tables.BidTables(F.col("html").outer(), F.col("meeting").outer())).select("reference", "document_number", "bidder_name_raw", "bid_price", "hst_basis", "price_header", F.lit("bid_award_panel").alias("source"), *placed)
    for name, rows, mode in (("council_item", items, "overwrite"), ("background_pdf", pdfs, "backfill"), ("bid", bids, "overwrite")):
        print(name, *archive.upsert(name, rows, mode, seq=F.struct(F.col("_meeting"), F.col("_row"))))
    runs = pipeline.link_passes(archive, panel=panel(archive, args.pages, args.archived))
    pipeline.record(archive, runs)
    print(pipeline.summary(runs))
    return int(any(r.status != "ok" for r in runs))


def cmd_amounts(archive, args):
    """The review queue: published amounts that no machine reads and no label covers."""
    for name, spec in TABLES.items():
        names = spec.schema.fieldNames()
        for c in [n for n in names if f"{n}_verdict" in names]:
            queue = archive.read(name).filter(F.col(c).isNotNull() & parse_amount(F.col(c)).isNull() & F.col(f"{c}_verdict").isNull())
            for r in queue.groupBy(F.col(c).alias("raw")).count().orderBy("raw").collect():
                print(name, r["raw"], r["count"], sep="\t")


def cmd_extract(archive, args):
    """Extract the facts of held texts and write them back by source; with --corpus, of one corpus, whose rows are
    rebuilt from what is cached."""
    if args.corpus:
        labels = archive.spark.createDataFrame([], "key string, flag boolean")
        for name, n in extract_and_backfill(archive, args.corpus, args.version, labels, limit=args.limit).items():
            print(name, n)
        return
    pdfs = archive.read("background_pdf").withColumns({"key": F.col("url"), "source": F.coalesce("kind", F.lit("other"))})
    none = archive.spark.createDataFrame([], "key string, flag boolean")
    done = extract(pdfs.filter("sha256 is not null"), archive.read("extraction_cache"), none, args.version, limit=args.limit).filter("error is null")
    archive.upsert("extraction_cache", done.select("sha256", "extractor_version", "result_json"), "overwrite")
    if args.backfill:
        for name, rows in backfill(facts(archive.read("extraction_cache"), pdfs, args.version)).items():
            print(name, archive.rebuild(name, rows))


def cmd_enrich_council(archive, args):
    """Items' titles and decisions, and the files they link, from landed item pages named by their reference."""
    pages = rest.cached_pages(archive.spark, args.pages).withColumnRenamed("stem", "reference")
    items = pages.lateralJoin(html_tables.CouncilItem(F.col("html").outer())).persist()
    try:
        print("council_item", *archive.upsert("council_item", items.filter("title IS NOT NULL").select("reference", "title", "decision_text"), "overwrite"))
        files = items.select("reference", F.explode("pdfs").alias("url")).groupBy("url").agg(F.min("reference").alias("reference"))
        print("background_pdf", *archive.upsert("background_pdf", files.withColumn("kind", pdf_kind(F.col("url"))), "backfill"))
    finally:
        items.unpersist()


def cmd_enrich_awards(archive, args):
    """Award summaries among the uploaded files of landed records: queued for download where they are new."""
    records = archive.spark.read.schema("id string, uploadedFilesStaff array<struct<name string, url string>>").json(args.records)
    files = normalize.award_summary_files(records).filter("url IS NOT NULL").groupBy("url").agg(F.min("id").alias("reference"))
    print("background_pdf", *archive.upsert("background_pdf", files.withColumn("kind", F.lit("award_summary")), "backfill"))
    waiting = archive.read("background_pdf").filter("kind = 'award_summary' AND sha256 IS NULL").count()
    print(f"{waiting} award summaries still to be fetched")


def cmd_enrich_agencies(archive, args):
    """The reports that landed agendas of the boards link, the buyers, and the supplier dimension; a part that fails
    is named at the end."""
    failed = []

    def reports():
        pages = rest.cached_pages(archive.spark, args.pages).withColumnRenamed("stem", "meeting")
        pdfs = pages.lateralJoin(html_tables.AgendaPdfs(F.col("html").outer(), F.col("meeting").outer())).groupBy("url").agg(F.min("reference").alias("reference"))
        print("background_pdf", *archive.upsert("background_pdf", pdfs.withColumn("kind", F.lit("agency_board")), "backfill"))

    for name, step in (("buyers", lambda: print("buyer", *archive.upsert("buyer", landing.buyers(archive.spark), "overwrite"))), ("reports", reports), ("suppliers", lambda: pipeline.rebuild_suppliers(archive))):
        try:
            step()
        except Exception as e:  # the others go on
            failed.append(name)
            print(f"FAILED {name}: {e}")
    return int(bool(failed))


def cmd_committee_awards(archive, args):
    """Reports of award items in landed voting records (CSV), found on the items' landed pages."""
    spark = archive.spark
    votes = spark.read.option("header", True).option("multiLine", True).csv(args.votes)
    items = normalize.voting_record(votes.withColumn("_place", F.struct(F.col("_metadata.file_path"), F.monotonically_increasing_id())), "_place")
    pages = rest.cached_pages(spark, args.pages)
    found = items.join(pages, F.col("reference") == F.col("stem")).lateralJoin(html_tables.ReportLink(F.col("html").outer(), F.col("document_number").outer())).filter("url IS NOT NULL")
    rows = found.groupBy("url").agg(F.min(F.struct("reference", "document_number")).alias("x")).select("url", "x.*", F.lit("committee_award").alias("kind"))
    print("background_pdf", *archive.upsert("background_pdf", rows, "backfill"))


def cmd_attachments(archive, args):
    """Index bundles of a folder: those that are new or changed, or with --reindex all of them."""
    held = Bundles.at(archive.spark, f"{archive.root}/_bundles")
    if args.reindex:
        held.reindex(args.folder)
    else:
        held.stream(args.folder, f"{archive.root}/_bundles/checkpoint").awaitTermination()
    index = held.index.read()
    if index is not None:
        archive.replace("ariba_attachment", index.select("document_number", "path", "filename", "file_size", "crc32"))
        bad = held.held.read().filter("error IS NOT NULL")
        for r in bad.orderBy("document_number").collect():
            print(f"unreadable: {r['zip_name']}: {r['error']}")
        print("ariba_attachment", archive.table("ariba_attachment").commit().count)


def cmd_extract_validate(archive, args):
    """Cached extractions beside a file of documents that people have read."""
    spark = archive.spark
    one = "id: string, url: string, none_present: boolean, entries: array<struct<company: string, contract: string>>"
    truth = spark.read.schema(f"documents array<struct<{one}>>").option("multiLine", True).json(args.truth)
    report = evaluate.against_truth(truth.select(F.explode("documents").alias("d")).select("d.*"), archive.read("background_pdf"), archive.read("extraction_cache"), args.version).persist()
    try:
        s = evaluate.truth_summary(report).first()
        print(f"compared {s['compared']}, entries {s['total_gt']}, TP {s['tp']}, FN {s['fn']}, FP {s['fp']}, recall {s['recall']:.1%}, precision {s['precision']:.1%}")
        told = report.filter("status <> 'compared' OR size(missed) > 0 OR size(count_flags) > 0")
        for r in told.orderBy("url").toLocalIterator():
            print(f"{r['url']}: {r['status']}", *(f"missed {m['supplier']}" for m in r["missed"] or ()), *(f"{f['reference']} declared {f['declared']}, got {f['actual']}" for f in r["count_flags"] or ()), sep="; ")
    finally:
        report.unpersist()


def cmd_publish(archive, args):
    """Check an export against the last published one and record it; exports that may go are listed."""
    paths = [f"{args.to}/{p}" for p in ("json", "schema", "parquet", "csv", "tables.zip")]
    log = KeyedTable(archive.spark, f"{archive.root}/_published", ["version", "name"])
    at = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    versions = publish.publish(log, dictionary.manifest(archive.spark, paths), args.name or at.strftime("%Y%m%d%H%M%S"), at)
    for r in versions.orderBy("at").collect():
        print(r["version"], r["bytes"], r["why"] or "may go", sep="\t")


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sluice")
    p.add_argument("--archive", required=True)
    sub = p.add_subparsers(dest="command", required=True)
    for name, f, options in (
        ("sync", cmd_sync, [("--landing", {"required": True}), ("--only", {"nargs": "*"}), ("--pages", {}), ("--archived", {})]), ("status", cmd_status, []), ("export", cmd_export, [("--to", {"required": True})]), ("manifest", cmd_manifest, [("--to", {"required": True})]),
        ("record-step", cmd_record_step, [("name", {}), ("status", {"choices": ["ok", "failed"]}), ("--error", {})]), ("nightly", cmd_nightly, [("--landing", {"required": True}), ("--to", {"required": True})]),
        ("enrich-council", cmd_enrich_council, [("--pages", {"required": True})]), ("enrich-awards", cmd_enrich_awards, [("--records", {"required": True})]), ("enrich-agencies", cmd_enrich_agencies, [("--pages", {"required": True})]),
        ("enrich-committee-awards", cmd_committee_awards, [("--votes", {"required": True}), ("--pages", {"required": True})]), ("enrich-attachments", cmd_attachments, [("folder", {}), ("--reindex", {"action": "store_true"})]),
        ("extract-validate", cmd_extract_validate, [("truth", {}), ("--version", {"default": "v1"})]), ("publish", cmd_publish, [("--to", {"required": True}), ("--name", {})]),
        ("enrich-titles", cmd_enrich_titles, [("--pages", {"required": True}), ("--archived", {})]), ("amounts", cmd_amounts, []), ("extract", cmd_extract, [("--version", {"default": "v1"}), ("--limit", {"type": int}), ("--backfill", {"action": "store_true"}), ("--corpus", {"choices": sorted(CORPORA)})]),
    ):
        one = sub.add_parser(name, help=f.__doc__)
        for option, how in options:
            one.add_argument(option, **how)
        one.set_defaults(run=f)
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    return args.run(Archive(local_session(), args.archive), args) or 0


if __name__ == "__main__":
    raise SystemExit(main())

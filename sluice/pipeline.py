"""The nightly run: sources in order, each by itself; link passes after them, whatever was synced.

A source that fails leaves what it had written and a ``failed`` run in the ledger; the others go
on. Link passes are table to table and may be repeated.
"""

from __future__ import annotations

import datetime
import functools
import json
import operator
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .functions.amounts import parse_amount
from .functions.keys import rfx_id
from .functions.suppliers import supplier_key
from .functions.titles import is_placeholder_title
from .operators import dimension, match, merge
from .schemas import TABLES
from .store import ARRIVAL, Archive

#: Tables that name suppliers: (primary key, name column).
NAMED = {
    "award": ("document_number", "supplier_name_raw"), "noncompetitive": ("workspace_number", "supplier_name_raw"), "suspended_firm": ("supplier_name_raw", "supplier_name_raw"), "bid": ("bidder_name_raw", "bidder_name_raw"),
    "composite_award": ("call_number", "supplier_name_raw"), "agency_award": ("native_ref", "supplier_name_raw"), "agency_bid": ("native_ref", "bidder_name_raw"),
}


@dataclass(frozen=True)
class Source:
    """A feed: read gives its landed records, normalize the rows by table."""

    name: str
    read: Callable[[], DataFrame]
    normalize: Callable[[DataFrame], dict[str, DataFrame]]
    mode: str = "overwrite"


@dataclass
class Run:
    source: str
    status: str = "running"
    fetched: int = 0
    upserted: int = 0
    error: str | None = None
    started: datetime.datetime = field(default_factory=lambda: datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None))
    added: int = 0
    seconds: float = 0.0

    def ended(self) -> Run:
        self.seconds = (datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None) - self.started).total_seconds()
        return self


def run_source(archive: Archive, source: Source) -> Run:
    run = Run(source.name)
    try:
        raw = source.read().cache()
        try:
            if ARRIVAL not in raw.columns:
                raise ValueError(f"{source.name}: the order in which its records came is unknown")
            run.fetched = raw.count()
            for name, rows in source.normalize(raw).items():
                issued, added = archive.upsert(name, rows, source.mode)
                run.upserted, run.added = run.upserted + issued, run.added + added
        finally:
            raw.unpersist()
        run.status = "ok"
    except Exception as e:  # one source's failure is its own
        run.status, run.error = "failed", str(e)[:1000]
    return run.ended()


def record(archive: Archive, runs: list[Run]) -> None:
    """Append runs to the ledger: one write for all."""
    if not runs:
        return
    spark = archive.spark
    last = archive.read("sync_run").agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    rows = [(last + 1 + i, r.source, r.started, now, r.status, r.fetched, r.upserted, r.error) for i, r in enumerate(runs)]
    archive.put("sync_run", spark.createDataFrame(rows, TABLES["sync_run"].ddl))


def clean_titles(archive: Archive) -> None:
    t = archive.read("solicitation").filter(is_placeholder_title(F.col("title")))
    archive.put("solicitation", t.withColumn("title", F.lit(None).cast("string")))


def bridge_postings(archive: Archive) -> None:
    spine = archive.read("solicitation").select("document_number", "posting_link")
    by_event = spine.select(rfx_id(F.col("posting_link")).alias("_rfx"), "document_number").filter("_rfx is not null").groupBy("_rfx").agg(F.min("document_number").alias("_doc"))
    p = archive.read("ariba_posting").join(by_event, F.col("rfx_id") == F.col("_rfx"), "left")
    bridged = p.filter("document_number is null and _doc is not null").withColumn("document_number", F.col("_doc"))
    archive.put("ariba_posting", bridged.drop("_rfx", "_doc"))


@dataclass(frozen=True)
class Panel:
    """What link passes read of landed pages. awards: (reference, title, winner_raw, award_value) of
    items that name no document; archived: (document_number, title) of postings' own pages."""

    awards: DataFrame | None = None
    archived: DataFrame | None = None


def _feed_awards(archive: Archive) -> DataFrame:
    return archive.read("award").filter("source = 'odata'")


def _placed(items: DataFrame) -> DataFrame:
    return items.withColumn("place", match.chronological(F.col("reference")))


def link_references(archive: Archive, panel: Panel) -> None:
    """Items' references to the documents that they alone match. The table is rebuilt, links that
    stay keep when they were first seen; where no link is derived it stays as it was."""
    if panel.awards is None:
        return
    links = match.item_links(_placed(panel.awards), _feed_awards(archive), "council_match")
    if not links.isEmpty():
        held = archive.read("solicitation_link").select("reference", "document_number", "first_seen")
        now = F.current_timestamp()
        fresh = links.join(held, ["reference", "document_number"], "left").withColumns({"first_seen": F.coalesce("first_seen", now), "last_seen": now})
        archive.replace("solicitation_link", fresh)


def _name(archive: Archive, titles: DataFrame, source: str, over: tuple[str, ...] = ()) -> None:
    named = match.name_rows(archive.read("solicitation").withColumn("_before", F.col("title")), titles, source, over)
    archive.put("solicitation", named.filter(~F.col("title").eqNullSafe(F.col("_before"))).drop("_before"))


def titles_from_items(archive: Archive) -> None:
    items = _placed(archive.read("council_item").filter("title is not null"))
    _name(archive, match.fill_from_titles(items.withColumn("place", F.struct("place", "title")), archive.read("solicitation"), "place"), "council")


def titles_from_awards(archive: Archive, panel: Panel) -> None:
    if panel.awards is not None:
        _name(archive, match.matched_titles(_placed(panel.awards), _feed_awards(archive), archive.read("solicitation")), "council_match")


def titles_from_composites(archive: Archive) -> None:
    c = archive.read("composite_award").filter("award_value_numeric is not null and supplier_name_raw is not null")
    items = c.select("reference", "title", F.col("supplier_name_raw").alias("winner_raw"), F.col("award_value_numeric").alias("award_value"))
    _name(archive, match.matched_titles(_placed(items), _feed_awards(archive), archive.read("solicitation")), "composite_match")


def titles_from_archive(archive: Archive, panel: Panel) -> None:
    """A posting's own page names it better than the item that awarded it; the feed's title stays."""
    if panel.archived is not None:
        _name(archive, panel.archived, "legacy_page", ("council",))


def backfill_amounts(archive: Archive) -> None:
    """The machine's amounts where they are missing and the text parses."""
    for name, spec in TABLES.items():
        names = spec.schema.fieldNames()
        columns = [n for n in names if f"{n}_numeric" in names and n != "bid_price"]
        if columns and archive.version(name):
            late = [F.col(f"{c}_numeric").isNull() & parse_amount(F.col(c)).isNotNull() for c in columns]
            t = archive.read(name).filter(functools.reduce(operator.or_, late))
            archive.put(name, t.withColumns({f"{c}_numeric": F.coalesce(F.col(f"{c}_numeric"), parse_amount(F.col(c))) for c in columns}))


def apply_labels(archive: Archive, labels: DataFrame | None) -> None:
    """People's verdicts on raw strings, beside the machine's amounts and never in their place."""
    if labels is None:
        return
    lab = labels.select(F.col("raw").alias("_raw"), F.col("value").alias("_value"), F.col("verdict").alias("_verdict"))
    for name, spec in TABLES.items():
        names = spec.schema.fieldNames()
        for c in [n for n in names if f"{n}_verdict" in names]:
            if archive.version(name):
                t = archive.read(name).join(lab, F.col(c) == F.col("_raw"))
                verdict = F.coalesce("_verdict", f"{c}_verdict")
                told = t.filter(~F.col(f"{c}_labelled").eqNullSafe(F.col("_value")) | ~F.col(f"{c}_verdict").eqNullSafe(verdict))
                archive.put(name, told.withColumns({f"{c}_labelled": F.col("_value"), f"{c}_verdict": verdict}).drop("_raw", "_value", "_verdict"))


def rebuild_suppliers(archive: Archive) -> None:
    sources = {n: (archive.read(n), pk, col) for n, (pk, col) in NAMED.items()}
    d = dimension.build(dimension.names_of(sources))
    archive.replace("supplier", d.select("supplier_key", "display_name", "variants"))
    for n, (t, _, col) in sources.items():
        if archive.version(n):
            found = t.withColumn("_id", F.when(supplier_key(F.col(col)) != "", F.xxhash64(supplier_key(F.col(col)))))
            archive.put(n, found.filter(~F.col("supplier_id").eqNullSafe(F.col("_id"))).withColumn("supplier_id", F.col("_id")).drop("_id"))


def link_passes(archive: Archive, labels: DataFrame | None = None, panel: Panel = Panel()) -> list[Run]:
    """Title passes follow each other: what one names is no longer in doubt for the next."""
    out = []
    for name, step in (
        ("title_cleanup", clean_titles), ("posting_bridge", bridge_postings), ("amount_backfill", backfill_amounts), ("amount_labels", lambda a: apply_labels(a, labels)),
        ("titles_from_items", titles_from_items), ("titles_from_awards", lambda a: titles_from_awards(a, panel)), ("reference_links", lambda a: link_references(a, panel)),
        ("titles_from_composites", titles_from_composites), ("titles_from_archive", lambda a: titles_from_archive(a, panel)), ("supplier_dimension", rebuild_suppliers),
    ):
        run = Run(name)
        try:
            step(archive)
            run.status = "ok"
        except Exception as e:  # a pass that fails leaves its table as it was
            run.status, run.error = "failed", str(e)[:1000]
        out.append(run.ended())
    return out


def sync(archive: Archive, sources: list[Source], only: list[str] | None = None, labels: DataFrame | None = None, panel: Panel = Panel()) -> list[Run]:
    """Sources in order (``only`` some), then all link passes; runs go to the ledger."""
    runs = [run_source(archive, s) for s in sources if only is None or s.name in only]
    runs += link_passes(archive, labels, panel)
    record(archive, runs)
    return runs


def nightly(archive: Archive, sources: list[Source], steps: list[tuple[str, Callable[[], None]]], export: Callable[[], None], monthly: list[tuple[str, Callable[[], None]]] = (), today: datetime.date | None = None, panel: Panel = Panel()) -> list[Run]:
    """sync, further steps, on the first of a month the monthly ones, and the export, which runs
    whatever failed before it; each step by itself."""
    runs = sync(archive, sources, panel=panel)
    today = today or datetime.date.today()
    for name, step in [*steps, *(monthly if today.day == 1 else ()), ("export", export)]:
        run = Run(name)
        try:
            step()
            run.status = "ok"
        except Exception as e:  # isolation is the contract
            run.status, run.error = "failed", str(e)[:1000]
        runs.append(run.ended())
        record(archive, [run])
    return runs


def elapsed(seconds: float) -> str:
    m, s = divmod(int(seconds), 60)
    return f"{m}m{s:02d}s" if m else f"{s}s"


def growth(before: dict[str, int], after: dict[str, int], skip: tuple[str, ...] = ("sync_run", "buyer")) -> list[tuple[str, int, int]]:
    """(table, rows now, change) of the tables that changed; nothing where the counts before aren't known, as
    a change from a number that nobody took would be made up."""
    return [(t, n, n - before.get(t, 0)) for t, n in after.items() if before and t not in skip and n != before.get(t, 0)]


def summary(runs: list[Run], grown: list[tuple] = (), export_bytes: int | None = None, exported: bool = False) -> str:
    """A text report of a run: how long it took, its steps, what each source gave, what grew, the export's size, what
    failed. Total over a partial report: it mustn't be what fails the run that it reports."""
    failed = [r for r in runs if r.status != "ok"]
    lines = [f"{len(runs)} steps, {len(failed)} failed, {elapsed(sum(r.seconds for r in runs))}"]
    lines += [f"  {r.source}: {r.status}, {elapsed(r.seconds)}" for r in runs if r.seconds >= 1]
    lines += [f"  {r.source}: {r.fetched:,} fetched" for r in runs if r.fetched]
    lines += [f"  {t}: {n:,} ({d[0]:+,})" if d else f"  {t}: {n:+,}" for t, n, *d in grown]
    if exported:
        lines.append("  export FAILED" if export_bytes is None else f"  export {export_bytes / (1 << 20):.1f} MiB")
    lines += [f"  {r.source}: {r.error}" for r in failed]
    return "\n".join(lines)


def post(text: str, webhook: str | None, log: Callable[[str], None] = lambda line: None) -> bool:
    """Send a report to a webhook; whether it went out. Without one nothing happens; a failure is logged by its kind
    alone, as its message may hold the address, and never fails the run."""
    import urllib.request

    if not webhook:
        return False
    try:
        request = urllib.request.Request(webhook, json.dumps({"text": text}).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=15) as answer:
            return answer.status < 400
    except Exception as e:
        log(f"report not sent: {type(e).__name__} {getattr(e, 'code', '')}".rstrip())
        return False

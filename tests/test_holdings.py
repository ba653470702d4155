"""Keyed tables, arrival order, streams that restart, bundles, captures, zips, publishing, batches."""

import csv
import io
import json
import random
import threading
import time
import zipfile
from difflib import SequenceMatcher
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from sluice import keyed
from sluice.export import publish, zipped
from sluice.functions.suppliers import similar_names
from sluice.operators import batches, merge
from sluice.operators.classify import counted, counts, out_of_fold, with_folds
from sluice.sources import rest
from sluice.sources.bundles import Bundles
from sluice.sources.capture import Captures
from sluice.store import Archive
from sluice.streaming.latest import latest_into
from sluice.streaming.upsert import upsert_stream


def held(t):
    df = t.read()
    return sorted(map(tuple, df.collect())) if df is not None else None


def test_only_touched_buckets_are_written(spark, tmp_path):
    t = keyed.KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=64)
    t.replace(spark.range(5000).select(F.col("id").alias("k"), F.lit(1).alias("v")))
    before = t.commit()
    c = t.change(spark.createDataFrame([(3, 9), (7, None), (9999, 5)], "k long, v int"), lambda old, new: merge.merge_upsert(old, new, ["k"], F.lit(0)))
    changed = [b for b in c.at if c.at[b] != before.at.get(b)]
    assert len(changed) <= 3 and set(changed) <= set(c.written) and c.count == 5001
    rows = dict(held(t))
    assert rows[3] == 9 and rows[7] == 1 and rows[9999] == 5 and len(rows) == 5001
    assert dict(map(tuple, t.read(before.number).collect()))[3] == 1  # an older state
    assert t.vacuum(keep=1) == 0 and held(t) == sorted(rows.items())
    t.rebucket(3)
    assert held(t) == sorted(rows.items()) and t.commit().buckets == 3
    assert t.vacuum(keep=1) == 2 and held(t) == sorted(rows.items())


def test_crash_before_the_commit_changes_nothing(spark, tmp_path, monkeypatch):
    t = keyed.KeyedTable(spark, f"{tmp_path}/t", ["k"])
    t.put(spark.createDataFrame([(1, "a")], "k long, v string"))
    before = t.commit()

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(keyed.KeyedTable, "_commit", die)
        with pytest.raises(RuntimeError):
            t.put(spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"))
    assert held(t) == [(1, "a")] and t.commit() == before
    assert t.vacuum() == 1  # what the crash left
    t.put(spark.createDataFrame([(1, "b"), (2, "c")], "k long, v string"))
    assert held(t) == [(1, "b"), (2, "c")]


def test_writers_that_meet(spark, tmp_path):
    t = keyed.KeyedTable(spark, f"{tmp_path}/t", ["k"])
    t.put(spark.createDataFrame([(1, 1)], "k long, v long"))
    calls = []

    def add(old, new):
        if not calls:  # another writer commits while this one works
            calls.append(1)
            t.put(spark.createDataFrame([(1, 10)], "k long, v long"))
        return old.withColumn("v", F.col("v") + 1)

    t.change(spark.createDataFrame([(1,)], "k long"), add)
    assert held(t) == [(1, 11)]


def test_writers_of_other_buckets_stand(spark, tmp_path):
    """A writer that meets one of other buckets doesn't merge anew: only its commit is."""
    t = keyed.KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=64)
    t.put(spark.createDataFrame([(1, 1), (2, 2)], "k long, v long"))
    calls = []

    def add(old, new):
        calls.append(1)
        if len(calls) == 1:
            keyed.KeyedTable(spark, f"{tmp_path}/t", ["k"]).put(spark.createDataFrame([(2, 20)], "k long, v long"))
        return old.withColumn("v", F.col("v") + 1)

    c = t.change(spark.createDataFrame([(1,)], "k long"), add)
    assert held(t) == [(1, 2), (2, 20)] and len(calls) == 1 and (c.number, c.count) == (3, 2) and t.commits() == [1, 2, 3]


def test_keys_of_odd_values(spark, tmp_path):
    t = keyed.KeyedTable(spark, f"{tmp_path}/t", ["a", "b"], nullable=("b",))
    assert t.read() is None and t.commit().count == 0
    t.put(spark.createDataFrame([], "a string, b string, v long"))
    assert held(t) == []
    t.put(spark.createDataFrame([("x", None, 1), ("x", "y", 2)], "a string, b string, v long"))
    t.put(spark.createDataFrame([("x", "", 3)], "a string, b string, v long"))  # null and blank are one
    assert held(t) == [("x", "", 3), ("x", "y", 2)]


def test_later_row_of_a_feed_wins(spark, tmp_path):
    a = Archive(spark, f"{tmp_path}/a")
    rows = [("1", "Second-best"), ("1", "A newer title"), ("2", "9"), ("2", "10"), ("3", "only"), ("3", None)]
    batch = spark.createDataFrame(rows, "document_number string, title string")
    with pytest.raises(ValueError, match="order"):
        a.upsert("solicitation", batch, "overwrite")
    folder = f"{tmp_path}/feed"
    rest.land(batch.coalesce(1), folder)
    rest.land(spark.createDataFrame([("2", "11")], batch.schema), folder)
    came = rest.landed(spark, folder, "document_number string, title string")
    assert a.upsert("solicitation", came, "overwrite") == (7, 3)
    assert {r.document_number: r.title for r in a.read("solicitation").collect()} == {"1": "A newer title", "2": "11", "3": "only"}
    assert "_arrival" not in a.read("solicitation").columns
    assert a.upsert("solicitation", came, "backfill") == (7, 0)


class Feed(BaseHTTPRequestHandler):
    records: list = []

    def do_GET(self):
        q = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
        skip, top = int(q["$skip"]), int(q["$top"])
        body = json.dumps({"value": self.records[skip : skip + top], "@odata.count": len(self.records)}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *_):
        pass


def test_feed_as_a_stream_resumes(spark, tmp_path):
    Feed.records = [{"id": str(i % 7), "n": i} for i in range(23)]
    server = HTTPServer(("127.0.0.1", 0), Feed)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        url = f"http://127.0.0.1:{server.server_port}/feed"

        def run():
            feed = rest.stream_feed(spark, url, "id string, n long", page_size="5")
            q = feed.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
            q.awaitTermination()

        run()
        assert spark.read.parquet(f"{tmp_path}/out").count() == 23
        Feed.records = Feed.records + [{"id": "z", "n": 100 + i} for i in range(4)]
        run()  # goes on where it was
        got = sorted((r["_arrival"], r.id, r.n) for r in spark.read.parquet(f"{tmp_path}/out").collect())
        assert got == [(k, r["id"], r["n"]) for k, r in enumerate(Feed.records)]
    finally:
        server.shutdown()


def test_state_of_a_stream_survives_a_restart(spark, tmp_path):
    schema, folder = "k long, seq long, v string, w long", f"{tmp_path}/in"
    first = [(1, 5, "five", None), (1, 3, "three", 3), (2, 1, None, None)]
    second = [(1, 4, "late", 4), (1, 6, None, None), (2, 2, "two", 2), (3, 1, "new", None)]

    def run(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        table, q = latest_into(spark.readStream.schema(schema).parquet(folder), ["k"], "seq", f"{tmp_path}/s")
        q.awaitTermination()
        return held(table)

    assert run(first) == [(1, "five", 3), (2, None, None)]
    assert run(second) == [(1, "five", 4), (2, "two", 2), (3, "new", None)]
    table, q = latest_into(spark.readStream.schema(schema).parquet(folder), ["k"], "seq", f"{tmp_path}/b", mode="backfill")
    q.awaitTermination()
    assert held(table) == [(1, "three", 3), (2, "two", 2), (3, "new", None)]


def test_replayed_batch_is_skipped(spark, tmp_path):
    from sluice.streaming.upsert import plain, upsert_sink

    t = keyed.KeyedTable(spark, f"{tmp_path}/t", ["k"])
    sink = upsert_sink(t, ["k"], "seq")
    for number, rows in ((0, [(1, 1, "a")]), (1, [(1, 2, "b")]), (1, [(1, 2, "b")]), (0, [(9, 9, "x")])):
        sink(spark.createDataFrame(rows, "k long, seq long, v string"), number)
    assert t.commit().number == 2 and plain(t.read(), ["k"]).collect() == [(1, "b")]
    spark.createDataFrame([(1, 3, "c")], "k long, seq long, v string").write.parquet(f"{tmp_path}/in")
    state, q = upsert_stream(spark.readStream.schema("k long, seq long, v string").parquet(f"{tmp_path}/in"), ["k"], "seq", f"{tmp_path}/u")
    q.awaitTermination()
    assert plain(state.read(), ["k"]).collect() == [(1, "c")]


def zip_of(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in files.items():
            z.writestr(name, data)
    return out.getvalue()


def test_bundles_as_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    one, two = "2243000001", "2243000002"
    (folder / f"Doc{one}.zip").write_bytes(zip_of({"a.txt": "a", "deep.zip": zip_of({"b.txt": "bb"}), "bad.zip": b"junk"}))
    (folder / f"Doc{two}.zip").write_bytes(b"junk")
    (folder / "nameless.zip").write_bytes(zip_of({"c.txt": "c"}))
    b = Bundles.at(spark, f"{tmp_path}/b")

    def run():
        b.stream(str(folder), f"{tmp_path}/c").awaitTermination()
        return sorted((r.document_number, r.path) for r in b.index.read().collect()), {r.document_number: (r.n_files, r.error is None) for r in b.held.read().collect()}

    index, status = run()
    assert index == [(one, "a.txt"), (one, "bad.zip"), (one, "deep.zip/b.txt")] and status == {one: (3, True), two: (0, False)}
    n = b.index.commit().number
    again = folder / "again"
    again.mkdir()
    (again / f"Doc{one}.zip").write_bytes((folder / f"Doc{one}.zip").read_bytes())
    assert run() == (index, status) and b.index.read().count() == 3
    (again / f"Doc{two}.zip").write_bytes(zip_of({"late.txt": "x"}))
    index, status = run()
    assert (two, "late.txt") in index and status[two] == (1, True) and b.index.commit().number > n
    b.reindex(str(folder))
    assert len(b.index.read().collect()) == 4


def test_capture_killed_and_resumed(spark, tmp_path):
    rows = [(f"D{d}", f"k{i}", f"file {i}") for d in range(4) for i in range(5)] + [("D1", "k0", "file 0")]
    listing = spark.createDataFrame(rows, "document_number string, key string, name string")
    log = f"{tmp_path}/asked"

    def fetch(d, key):
        with open(log, "a") as f:
            f.write(f"{d} {key}\n")
        if (d, key) == ("D2", "k3"):
            raise OSError("gone")
        return f"{d}{key}".encode()

    c = Captures(spark, f"{tmp_path}/c")
    put, waves = c.captured.put, []

    def dies(rows):
        if waves:
            raise RuntimeError("killed")
        waves.append(1)
        return put(rows)

    c.captured.put = dies
    with pytest.raises(RuntimeError):
        c.run(listing, fetch, wave=7, tasks=2)
    first = c.captured.read().count()
    assert 0 < first < 19 and c.bundle.read() is None and c.gap.read() is None
    asked = len(open(log).readlines())
    c = Captures(spark, f"{tmp_path}/c")
    assert c.run(listing, fetch, wave=7, tasks=2) == 1
    assert len(open(log).readlines()) - asked == 20 - first  # only what was owed
    gaps = {(r.document_number, r.key): r.reason for r in c.gap.read().collect()}
    assert gaps == {("D1", None): "1 entries of the listing can't be told apart", ("D2", "k3"): "OSError: gone"}
    assert {r.document_number: (r.n_files, r.complete) for r in c.bundle.read().collect()} == {"D0": (5, True), "D1": (5, False), "D2": (4, False), "D3": (5, True)}
    with pytest.raises(ValueError):
        c.salvage(spark.createDataFrame([("D2", True)], "document_number string, open boolean"))
    c.salvage(spark.createDataFrame([("D2", False)], "document_number string, open boolean"))
    assert ("D2", "k3") in {(r.document_number, r.key) for r in c.gap.read().collect()}
    # a changed listing voids what was captured of its document, a complete run clears its gaps
    changed = listing.distinct().withColumn("name", F.when(F.col("document_number") == "D2", F.upper("name")).otherwise(F.col("name")))
    asked = len(open(log).readlines())
    assert c.run(changed, lambda d, k: fetch("D9", k), wave=100) == 0
    assert len(open(log).readlines()) - asked == 5
    assert c.gap.read().count() == 0 and c.bundle.read().filter("complete").count() == 4
    assert [r.document_number for r in c.empty(spark.createDataFrame([("D0",), ("D8",)], "document_number string")).collect()] == ["D8"]


def test_capture_reads_and_writes_once_however_many_waves(spark, tmp_path):
    """Waves are ranges of buckets: each wave writes buckets of its own, and what is owed is asked for twice a run."""
    listing = spark.createDataFrame([(f"D{i % 3}", f"k{i}", f"file {i}") for i in range(60)], "document_number string, key string, name string")
    c = Captures(spark, f"{tmp_path}/c", buckets=2)
    owed, asked = c.owed, []
    c.owed = lambda planned: asked.append(1) or owed(planned)
    assert c.run(listing, lambda d, key: key.encode(), wave=15, tasks=1) == 0 and len(asked) == 2
    written = [c.captured.commit(n).written for n in c.captured.commits()]
    assert sorted(b for w in written for b in w) == [0, 1, 2, 3] and len(written) == 4
    # a table that is there gets more buckets, and what was captured stays
    changed = listing.withColumn("name", F.when(F.col("document_number") == "D1", F.upper("name")).otherwise(F.col("name")))
    assert c.run(changed, lambda d, key: b"new", wave=4, tasks=1) == 0 and c.captured.commit().buckets == 8 and len(asked) == 4
    rows = c.captured.read().collect()
    assert len(rows) == 60 and {(r.key, r.size == 3, r.name.isupper()) for r in rows if r.document_number == "D1"} == {(f"k{i}", True, True) for i in range(1, 60, 3)}
    assert c.bundle.read().filter("complete").count() == 3 and c.gap.read().count() == 0


def test_capture_waves_are_under_way_at_once(spark, tmp_path):
    """A file comes only once files of two waves are asked for; each wave is still kept by itself."""
    listing = spark.createDataFrame([("D", f"k{i}", f"file {i}") for i in range(16)], "document_number string, key string, name string")
    asked = tmp_path / "asked"
    asked.mkdir()

    def fetch(d, key):
        (asked / key).touch()
        for _ in range(200):
            if len(list(asked.iterdir())) > 1:
                return key.encode()
            time.sleep(0.1)
        raise OSError("alone")

    c = Captures(spark, f"{tmp_path}/c", buckets=2)
    assert c.run(listing, fetch, wave=2, tasks=2, at_once=2) == 0
    written = [c.captured.commit(n).written for n in c.captured.commits()]
    assert c.captured.commit().buckets == 8 and all(len(w) == 1 for w in written) and len({b for w in written for b in w}) == len(written) > 2
    assert all(len([f for f in b.iterdir() if f.name.startswith("part-")]) == 1 for b in (tmp_path / "c" / "blobs").iterdir())  # of two tasks each wave has one
    assert [tuple(r) for r in c.bundle.read().select("n_files", "complete").collect()] == [(16, True)]


def test_capture_makes_its_listing_once(spark, tmp_path):
    """However often a run asks for the listing and for what is missing, the listing's rows are made once."""
    log = f"{tmp_path}/log"

    def name(i):
        with open(log, "a") as f:
            f.write(f"{i}\n")
        return f"file {i}"

    listing = spark.range(30).select(F.concat(F.lit("D"), F.col("id") % 3).alias("document_number"), F.col("id").cast("string").alias("key"), F.udf(name)("id").alias("name"))
    c = Captures(spark, f"{tmp_path}/c")
    assert c.run(listing, lambda d, key: {"7": b"no"}[key], wave=10, tasks=2) == 29
    assert sorted(map(int, open(log))) == list(range(30))
    assert c.gap.read().count() == 29 and [tuple(r) for r in c.bundle.read().collect()][0][2:] == (1, False)
    assert not list((tmp_path / "c" / "owed").iterdir())


def test_zip_of_many_parts(spark, tmp_path):
    rows = [(i, "x\ry" if i % 3 else None, 'say "hi", then\nbye' if i % 2 else "") for i in range(2000)]
    t = spark.createDataFrame(rows, "i long, a string, b string").repartitionByRange(5, "i").sortWithinPartitions("i")
    z = zipped.zip_csv({"t": t, "none": t.limit(0), "other": t.select("i")}, f"{tmp_path}/t.zip")
    with zipfile.ZipFile(z) as f:
        assert f.testzip() is None and f.namelist() == ["t.csv", "none.csv", "other.csv"]
        back = list(csv.reader(io.TextIOWrapper(f.open("t.csv"), encoding="utf-8", newline="")))
        assert back[0] == ["i", "a", "b"] and back[1:] == [[str(i), a or "", b] for i, a, b in rows]
        assert f.read("none.csv") == b"i,a,b\n" and len(f.read("other.csv").split()) == 2001
        assert b",," not in f.read("t.csv").split(b"\n")[2] and b',,""' in f.read("t.csv")  # null is empty, empty is quoted
    assert [p.name for p in tmp_path.iterdir()] == ["t.zip"]


def test_failed_zip_leaves_none(spark, tmp_path):
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id").cast("string")).alias("v"))
    with pytest.raises(Exception, match="no"):
        zipped.zip_csv({"t": bad}, f"{tmp_path}/t.zip")
    assert not (tmp_path / "t.zip").exists()


def test_checksums_combine():
    import zlib

    r = random.Random(1)
    for n in (0, 1, 7, 1000):
        a, b = r.randbytes(n * 3), r.randbytes(n)
        assert zipped.combined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_publish_holds_back_what_shrank(spark, tmp_path):
    import datetime

    log = keyed.KeyedTable(spark, f"{tmp_path}/log", ["version", "name"])
    asset = lambda *rows: spark.createDataFrame(rows, "name string, bytes long")
    day = lambda m, d: datetime.datetime(2024, m, d)
    publish.publish(log, asset(("a", 100), ("b", 10)), "v1", day(1, 5))
    publish.publish(log, asset(("a", 60), ("b", 10), ("c", 1)), "v2", day(1, 9))
    for shrunk in (asset(("a", 29), ("b", 10), ("c", 1)), asset(("a", 60), ("c", 1)), asset(("a", 60), ("b", 10), ("c", 1), ("d", 0))):
        with pytest.raises(ValueError, match="held back"):
            publish.publish(log, shrunk, "v3", day(2, 1))
    kept = publish.publish(log, asset(("a", 60), ("b", 10), ("c", 1)), "v3", day(2, 1))
    assert {r.version: r.why for r in kept.collect()} == {"v1": "monthly", "v2": None, "v3": "newest"}


@pytest.mark.parametrize("seed", range(3))
def test_batches_by_histogram_are_the_greedy_ones(spark, seed):
    r = random.Random(seed)
    docs = [(i, r.choice([None, "a", "a", "a", "b"]), r.choice([0, 5, 5, 5, r.randrange(200), None])) for i in range(600)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n long").repartition(5)
    got = {x.doc_id: x.batch for x in batches.size_balanced(df, "doc_id", "n", 4, "source", cap=120).collect()}
    want = {}
    for s in {s for _, s, _ in docs}:
        want |= batches.balance([(i, n or 0) for i, t, n in docs if t == s], 4, cap=120)
    assert got == want


@pytest.mark.parametrize("seed", range(2))
def test_no_similar_name_is_lost(spark, seed):
    r = random.Random(seed)
    base = ["".join(r.choices("abcdef ", k=r.randrange(1, 30))) for _ in range(25)]

    def bent(s):
        s = list(s)
        for _ in range(r.randrange(4)):
            k = r.randrange(len(s) + 1)
            s[k : k + r.randrange(2)] = r.choice(["", "x", "yz"])
        return "".join(s)

    names, labels = {bent(s) for s in base for _ in range(3)}, set(base)
    got = {(x.name, x.label) for x in similar_names(spark.createDataFrame([(n,) for n in names] + [(None,)], "name string"), spark.createDataFrame([(n,) for n in labels] + [("",)], "label string")).collect()}
    assert got == {(a, b) for a in names for b in labels if a and b and SequenceMatcher(None, a, b).ratio() >= 0.88}


def test_similar_names_that_share_most_pieces(spark):
    """Pieces that all names share: pairs whose letters differ go within the join, none is broadcast, each is scored once."""
    from sluice.functions.suppliers import similar_names

    labels = [f"the very same long beginning of {a}{b} \U0001f600" for a in ("alpha", "beta", "gamma", "delta", "zeta") for b in range(12)]
    names = [x.replace("\U0001f600", "\U0001f601").replace("a", "e", 1) for x in labels]
    found = similar_names(spark.createDataFrame([(x,) for x in names], "name string"), spark.createDataFrame([(x,) for x in labels], "label string"), block=7)
    assert {(x.name, x.label) for x in found.collect()} == {(a, b) for a in names for b in labels if SequenceMatcher(None, a, b).ratio() >= 0.88}
    plan = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert "Broadcast" not in plan and plan.count("ArrowEvalPython") == 1


def test_similar_names_of_the_catalogue(spark, sf):
    from sluice.plans.holdings import similar_names_join

    p = spark.read.parquet(f"{sf}/part.parquet").collect()
    right = {f"{x.p_name} {x.p_type} {x.p_brand}".lower() for x in p}
    left = set()
    for x in p:
        n = f"{x.p_name} {x.p_type} {x.p_brand}".lower()
        left.add([n.replace("widget", "wigdet"), f"{n} co", n[1:]][x.p_partkey % 3])
    want = {(a, b, round(q, 9)) for a in left for b in right if (q := SequenceMatcher(None, a, b).ratio()) >= 0.88}
    assert {(x.name, x.label, round(x.ratio, 9)) for x in similar_names_join(spark, sf).collect()} == want


def test_folds_and_scores(spark, tmp_path):
    rows = [(i, f"good fine number {i}" if i % 3 else f"bad awful number {i}", "good" if i % 3 else "bad") for i in range(90)] + [(1000, None, "bad"), (1001, "x", None)]
    docs = spark.createDataFrame(rows, "k long, text string, kind string")
    sizes = [r["count"] for r in with_folds(docs.filter("kind IS NOT NULL"), "k", "kind", 4).groupBy("kind", "fold").count().collect()]
    assert sorted(sizes) == [7, 8, 8, 8, 15, 15, 15, 15]
    scores = out_of_fold(docs, "k", "kind", {"b": ("bayes", "word 1"), "s": ("svm", "char 3-5")}, f"{tmp_path}/f")
    assert scores.count() == 180 and scores.filter("predicted <> kind").count() == 0
    assert scores.groupBy("model", "k").count().filter("count > 1").isEmpty()


def test_character_counts_of_bytes_are_those_of_strings(spark, sf):
    rows = [(1, "Hello  World\n\tab"), (2, ""), (3, "ab"), (4, "abc"), (5, "ÄÖÜ straße \U0001f600\U0001f601x日本語テキスト"), (6, "x" * 5000), (7, "   İI")]
    odd = spark.createDataFrame(rows, "k long, text string")
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.col("doc_id").alias("k"), "text").filter("text IS NOT NULL")
    for given, features in ((odd, 1 << 12), (odd, 1000), (docs, 1 << 12)):
        got = counted(given, "char 3-5", features)
        assert got.columns == ["k", "tf"] and "MapInArrow" in got._jdf.queryExecution().toString()
        want = {r.k: r.tf for r in counts("char 3-5", features).transform(given).collect()}
        assert {r.k: r.tf for r in got.collect()} == want and len(want) == given.count()
    assert [r.tf for r in counted(odd, "word 1").orderBy("k").collect()] == [r.tf for r in counts("word 1").transform(odd).orderBy("k").collect()]


def test_counts_are_kept_in_small_row_groups(spark, tmp_path, monkeypatch):
    """A reader holds a row group's counts at once, so these don't grow with the table."""
    import pyarrow.parquet as pq

    from sluice.operators import classify

    monkeypatch.setattr(classify, "GROUP", 1 << 16)
    docs = spark.range(2000).select(F.col("id").alias("k"), F.concat_ws(" ", *(F.sha2(F.concat_ws("-", "id", F.lit(n)), 512) for n in range(4))).alias("text"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("kind"))
    assert out_of_fold(docs.coalesce(1), "k", "kind", {"s": ("bayes", "char 3-5")}, f"{tmp_path}/f").count() == 2000
    files = [pq.ParquetFile(f).metadata for f in (tmp_path / "f" / "counts-0").glob("*.parquet")]
    assert max(m.row_group(g).num_rows for m in files for g in range(m.num_row_groups)) <= 200


def test_folds_keep_every_row(spark, tmp_path):
    """Rows without a key, and several of one key, are scored like the others."""
    rows = [(None if i < 3 else i // 2, f"good fine number {i}" if i % 3 else f"bad awful number {i}", "good" if i % 3 else "bad") for i in range(90)]
    scores = out_of_fold(spark.createDataFrame(rows, "k long, text string, kind string"), "k", "kind", {"b": ("bayes", "word 1")}, f"{tmp_path}/f")
    assert scores.count() == 90 and scores.filter("k IS NULL").count() == 3 and scores.filter("k IS NOT NULL").groupBy("k").agg(F.countDistinct("fold").alias("n")).filter("n > 1").isEmpty()


def test_fuzzy_scoring_names_is_exact(spark, sf):
    from sluice.functions.suppliers import scoring_key
    from sluice.plans.scalars import _FUZZY, fuzzy_scoring_names

    keys = spark.read.parquet(f"{sf}/customer.parquet").select("c_custkey", scoring_key(F.expr(_FUZZY)).alias("a"), scoring_key(F.col("c_name")).alias("b")).collect()
    want = {r.c_custkey: r.a == r.b or SequenceMatcher(None, r.a, r.b).ratio() >= 0.88 for r in keys}
    assert {r.c_custkey: r.matched for r in fuzzy_scoring_names(spark, sf).collect()} == want and len(set(want.values())) == 2


def test_classifiers_after_the_session_was_observed(spark, sf):
    """A session that has observed a frame can't be serialized: no result may hold a fitted model's summary."""
    from pyspark.sql import Observation

    from sluice.plans.papers import bow_classifiers

    seen = Observation()
    spark.range(3).observe(seen, F.count("*").alias("n")).collect()
    assert seen.get["n"] == 3
    got = {r.model: (r.n, r.correct) for r in bow_classifiers(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("text IS NOT NULL AND quality IS NOT NULL")
    assert len(got) == 3 and all(n == docs.count() and n >= ok > n * 0.5 for n, ok in got.values())

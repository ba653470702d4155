"""Merges, rebuilds, nesting, titles, votes: small tables with known answers."""

from pyspark.sql import functions as F

from sluice.operators import batches, drift, evaluate, match, merge, nest
from sluice.schemas import TABLES

SEQ = F.col("seq")


def keyed(df, key="k"):
    return {r[key]: tuple(r) for r in df.collect()}


def test_fold_in_order_and_null_never_erases(spark):
    b = spark.createDataFrame([("a", 1, "x", None), ("a", 2, None, "p"), ("a", 3, "z", None)], "k string, seq long, u string, v string")
    assert keyed(merge.fold_batch(b, ["k"], SEQ, "overwrite").select("k", "u", "v"))["a"] == ("a", "z", "p")
    assert keyed(merge.fold_batch(b, ["k"], SEQ, "backfill").select("k", "u", "v"))["a"] == ("a", "x", "p")


def test_modes(spark):
    t = spark.createDataFrame([("a", "old", None), ("b", "keep", "w")], "k string, u string, v string")
    b = spark.createDataFrame([("a", 1, "new", "fill"), ("c", 2, "add", None)], "k string, seq long, u string, v string")
    over = keyed(merge.merge_upsert(t, b, ["k"], SEQ).select("k", "u", "v"))
    assert over == {"a": ("a", "new", "fill"), "b": ("b", "keep", "w"), "c": ("c", "add", None)}
    back = keyed(merge.merge_upsert(t, b, ["k"], SEQ, "backfill").select("k", "u", "v"))
    assert back["a"] == ("a", "old", "fill")


def test_null_and_blank_keys_collide(spark):
    t = spark.createDataFrame([(None, "q", 1)], "k string, j string, u long")
    b = spark.createDataFrame([("", "q", 2, 1), (None, "q", 3, 2)], "k string, j string, u long, seq long")
    assert merge.merge_upsert(t, b, ["k", "j"], SEQ, nullable=("k",)).select("u").collect() == [(3,)]


def test_timestamps(spark):
    now = F.lit("2020-01-02 00:00:00").cast("timestamp")
    t = spark.createDataFrame([("a", 1), ("b", 1)], "k string, u long").withColumns({"first_seen": F.lit("2019-01-01").cast("timestamp"), "last_seen": F.lit("2019-01-01").cast("timestamp")})
    b = spark.createDataFrame([("a", 2, 1), ("c", 3, 2)], "k string, u long, seq long")
    got = {r.k: (str(r.first_seen)[:4], str(r.last_seen)[:4]) for r in merge.merge_upsert(t, b, ["k"], SEQ, now=now).collect()}
    assert got == {"a": ("2019", "2020"), "b": ("2019", "2019"), "c": ("2020", "2020")}


def test_derived_amounts_are_added_on_write(spark):
    spec = TABLES["agency_bid"]
    b = spark.createDataFrame([("t", "r", "A", "$5*", "s")], "buyer_id string, native_ref string, bidder_name_raw string, bid_price string, source string")
    empty = spark.createDataFrame([], spec.schema)
    r = merge.write_batch(empty, b.withColumn("seq", F.lit(1)), spec, SEQ, "overwrite", F.current_timestamp()).first()
    assert r.bid_price == "$5*" and r.bid_price_numeric == 5.0


def test_rebuild(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k long, source string")
    fresh = spark.createDataFrame([(9, "a")], "k long, source string")
    assert sorted(map(tuple, merge.rebuild_by_source(t, fresh).select("k", "source").collect())) == [(2, "b"), (9, "a")]
    assert merge.rebuild_by_source(t, fresh.limit(0)).count() == 2


def test_nothing_is_lost_in_nesting(spark):
    p = spark.createDataFrame([(1,), (2,)], "id long")
    c = spark.createDataFrame([(1, 5), (1, 3), (7, 1), (None, 2)], "pid long, n long")
    nested = nest.nest(p, c, "id", "pid", "kids", ["n"])
    assert {r.id: [k.n for k in r.kids] for r in nested.collect()} == {1: [3, 5], 2: []}
    assert sorted(r.n for r in nest.unlinked(c, p, "pid", "id").collect()) == [1, 2]


def test_ambiguous_is_refused(spark):
    items = spark.createDataFrame([("i", 2.5, ["x"]), ("j", 10.0, ["y"])], "ref string, v double, t array<string>")
    awards = spark.createDataFrame([("d1", 2.0, ["x"]), ("d2", 10.0, ["y"]), ("d3", 10.0, ["y"])], "doc string, v double, t array<string>")
    m = match.value_token_matches(items, "ref", F.col("v"), F.col("t"), awards, "doc", F.col("v"), F.col("t"))
    assert [tuple(r) for r in match.unique_matches(m).collect()] == [("i", "d1")]  # 2.5 rounds to even
    assert [tuple(r) for r in match.ambiguous_matches(m).collect()] == [("j", "d2", "d3")]


def test_title_without_title_never_fills(spark):
    spine = spark.createDataFrame([("d", None, None)], "k string, title string, title_source string")
    c = spark.createDataFrame([("d", None, "council", 1), ("d", "T", "council_match", 2)], "k string, title string, title_source string, place long")
    assert tuple(match.fill_titles(spine, c, "k").first()) == ("d", "T", "council_match")


def test_votes(spark):
    v = spark.createDataFrame([(1, 1, "a", False, "x"), (1, 2, "a", False, "yy"), (1, 3, "b", True, "z"), (2, 1, "a", False, ""), (2, 2, "b", False, "q"), (2, 3, "c", False, "")], "d long, voter long, kind string, flag boolean, evidence string")
    got = {r.d: r for r in evaluate.decide(v, "d").collect()}
    assert (got[1].kind, got[1].kind_agreement, got[1].flag, got[1].flag_agreement, got[1].evidence) == ("a", "judged", True, "or_recovered", "z")
    assert (got[2].kind, got[2].kind_agreement, got[2].flag_agreement, got[2].evidence) == (None, "disputed", "unanimous", "q")


def test_empty_denominators(spark):
    none = spark.createDataFrame([], "d long, tp long, fn long, fp long")
    assert evaluate.corpus_report(none).first().recall is None
    assert evaluate.corpus_report(none, 1.0).first().recall == 1.0


def test_unique_names():
    assert batches.unique_in(["a.pdf", "a.pdf", "a_2.pdf", "a.pdf", "b", "b"]) == ["a.pdf", "a_2.pdf", "a_2_2.pdf", "a_3.pdf", "b", "b_2"]


def test_unique_names_are_given_in_linear_time():
    """60,000 equal names: each went through all numbers before its own."""
    import time

    begin = time.process_time()
    got = batches.unique_in(["a.pdf"] * 60_000 + ["a_7.pdf"])
    assert got[-2:] == ["a_60000.pdf", "a_7_2.pdf"] and len(set(got)) == len(got) and time.process_time() - begin < 20


def test_unique_names_by_families(spark):
    """As one listing at a time gives them, whatever names meet: numbers, dots, none, nulls."""
    import random

    r = random.Random(4)
    pool = ["a.pdf", "a_2.pdf", "a_2_2.pdf", "a_3.pdf", "a_02.pdf", "x.y_2", "x_2.y_2", "x.y", "b", "b_2", "b_2_3", ".c", "_2.c", "d.", "d_2.", "e.f.g", "e_2.f.g", "e.f_2.g", "z\n", "z_2\n", "", "_2", None]
    rows = [(r.choice(["g", "h", None]), k, r.choice(pool)) for k in range(900)]
    want = {}
    for g in ("g", "h", None):
        mine = [x for x in rows if x[0] == g]
        want |= dict(zip([x[1] for x in mine], batches.unique_in([x[2] for x in mine])))
    got = batches.unique_names(spark.createDataFrame(rows, "g string, k long, n string").repartition(5), "g", "k", "n").collect()
    assert len(got) == 900 and {x.k: x.unique_name for x in got} == want and {(x.g, x.k, x.n) for x in got} == set(rows)


def test_balance_is_greedy():
    placed = batches.balance([(1, 50), (2, 40), (3, 30), (4, 20)], 2)
    assert placed == {1: 0, 2: 1, 3: 1, 4: 0}


def test_gate(spark):
    c = spark.createDataFrame([(0, 0, None), (10, 4, None), (10, 6, 8), (10, 9, 8), (10, 10, 8)], "listed long, captured long, held long")
    assert [r.verdict for r in drift.gate(c).collect()] == ["refuse_empty", "refuse_partial", "refuse_shrink", "archive_with_gap", "archive"]

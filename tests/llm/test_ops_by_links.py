"""URL rules, SimHash, NN-descent, substring dedup and the pipeline against brute force."""

import collections
import fnmatch
import hashlib
import random
import re

import llm_tools as tools
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from sluice.llm import graph, mixing, nn_descent, repeats, simhash, substring, url_filter
from sluice.llm.common import spool, table


def glob_regex(glob):
    out = ""
    for part in re.split(r"(\*\*|\*|\?)", glob):
        out += {"**": ".*", "*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part))
    return re.compile(out, re.S)


def test_automaton_against_regular_expressions():
    rng = random.Random(3)
    globs = ["".join(rng.choice(["a", "b", "/", "*", "**", "?", "é"]) for _ in range(rng.randint(0, 6))) for _ in range(60)]
    texts = ["".join(rng.choice("ab/éc") for _ in range(rng.randint(0, 9))) for _ in range(400)] + ["a" * 3000]
    found = url_filter.Automaton(globs).run(texts)
    for j, g in enumerate(globs):
        r = glob_regex(g)
        assert found[:, j].tolist() == [bool(r.fullmatch(t)) for t in texts], g
    assert fnmatch.fnmatch("a", "a")  # globs without slashes are the usual ones


@pytest.mark.parametrize("url, rule, verdict", [
    ("http://Example.ORG/es/1?x", "example.org/es/", "block"), ("https://a.example.org/en/12", "example.org/en/1", "block"), ("https://a.example.org/en/2", "org/", "allow"), ("https://notexample.org/es/", "org/", "allow"),
    ("http://x.com/fr/", "com/fr/", "allow"), ("http://x.com/de/a", "com/de/", "block"), ("http://x.com/a.org/", None, "allow"), ("http://x.org", None, "allow"), ("http://x.org?/", None, "allow"), ("x.org/", None, "allow"), (None, None, "allow"), ("", None, "allow"),
    ("http://org/", "org/", "allow"), ("http://x.net/a/b.zip", None, "block"), ("http://x.net/shop/cart/1", None, "block"), ("http://" + "a" * 50_000 + ".org/", "org/", "allow"),
])
def test_rules(spark, url, rule, verdict):
    df = spark.createDataFrame([(1, url)], "page_id long, url string")
    r = url_filter.judge(df, "url", "page_id").first()
    assert (r.rule, r.verdict) == (rule, verdict)


def test_rules_of_an_empty_table(spark):
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string, host string"), "url", "page_id").count() == 0


def brute_fingerprint(t):
    words = tools.WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(ids, linked):
    up = {i: i for i in ids}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in linked:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def near(fps, tau):
    ids = sorted(fps)
    a = np.array([fps[i] for i in ids], np.uint64)
    return [(ids[i], ids[i + 1 + j]) for i in range(len(ids)) for j in np.flatnonzero(np.bitwise_count(a[i + 1 :] ^ a[i]) <= tau)]


def check_simhash(docs, got):
    fps = {d: brute_fingerprint(t) for d, t in docs.items()}
    parts = brute_components(sorted(fps), near(fps, 3))
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{fps[d]:016x}", parts[d]) for d in docs}


def test_simhash(spark, sf):
    check_simhash(tools.texts(table(spark, sf, "documents")), simhash.op8_simhash(spark, sf).collect())


def test_simhash_of_nasty_rows(spark, tmp_path):
    docs = tools.nasty_documents(spark).withColumn("text", F.when(F.col("doc_id") == 7, F.substring("text", 1, 3000)).otherwise(F.col("text")))
    check_simhash(tools.texts(docs), simhash.op8_simhash(spark, tools.folder(docs, tmp_path)).collect())
    assert simhash.op8_simhash(spark, tools.folder(tools.empty_documents(spark), tmp_path)).count() == 0


def dense_fingerprints():
    """Chains of close fingerprints, a dense ball, and pairs at three and four bits."""
    rng = random.Random(5)
    fps = set()
    for _ in range(60):
        x = rng.getrandbits(64)
        for _ in range(12):
            fps.add(x)
            for b in rng.sample(range(64), rng.randint(1, 4)):
                x ^= 1 << b
    ball = rng.getrandbits(64)
    fps |= {ball ^ (rng.getrandbits(9) << 3) for _ in range(300)}
    return dict(enumerate(sorted(fps)))


@pytest.mark.parametrize("block", [4096, 7])
def test_pigeonring_loses_no_link(spark, block):
    fps = dense_fingerprints()
    signed = [(i, [f - (1 << 64) if f >> 63 else f]) for i, f in fps.items()]
    nodes = spark.createDataFrame(signed, "id long, fps array<long>")
    found = {r.id: r.component for r in graph.components(simhash.near_links(nodes, 3, block=block)).collect()}
    parts = brute_components(sorted(fps), near(fps, 3))
    assert {i: found.get(i, i) for i in fps} == parts


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1000 + i) for i in range(400)] + [(rng.randint(2000, 2500), rng.randint(2000, 2500)) for _ in range(300)] + [(5, 5)]
    rng.shuffle(edges)
    parts = brute_components(sorted({x for e in edges for x in e}), edges)
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: p for i, p in parts.items() if i in got} and all(i in got for i, p in parts.items() if i != p)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors_table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "'x' AS label", "2 AS key", "3 AS links")


def check_vectors(rows, got):
    good = {i: np.array(v, np.float64) for i, v in rows if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    ids = sorted(good)
    x = {i: good[i] / np.linalg.norm(good[i]) for i in ids}
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if len(x[a]) == len(x[b]) and x[a] @ x[b] >= 0.95]
    degree = collections.Counter(i for e in linked for i in e)
    parts = brute_components(ids, linked)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {i: (degree[i], parts.get(i, i), parts.get(i, i) == i) for i, _ in rows}


def test_links_between_clumps(spark):
    """Lists full of clump-mates hold no link across, and the audit must not call that whole."""
    rng = np.random.default_rng(11)
    base, other = np.linalg.qr(rng.normal(size=(48, 2)))[0].T
    centres = [base, 0.965 * base + (1 - 0.965**2) ** 0.5 * other]
    rows = [(100 * c + i, (centres[c] + rng.normal(size=48) * (0.0005 / 48) ** 0.5).astype(np.float32).tolist()) for c in range(2) for i in range(100)]
    rows += [(1000 + i, rng.normal(size=48).astype(np.float32).tolist()) for i in range(300)]
    got = nn_descent.near_duplicates(vectors_table(spark, rows), "vec_id", "embedding", leaf=16, trees=2).collect()
    check_vectors(rows, got)
    assert {r.n_links for r in got if r.vec_id < 200} == {199}


def test_missed_recall_is_searched_exactly(spark):
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(150, 24))
    rows = [(i, (centres[i % 150] + rng.normal(size=24) * 0.1).astype(np.float32).tolist()) for i in range(300)]
    check_vectors(rows, nn_descent.near_duplicates(vectors_table(spark, rows), "vec_id", "embedding", k=1, trees=1, leaf=2, rounds=0, again=0).collect())


def test_nn_descent(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(300, 32))
    rows = [(int(i), (centres[i % 300] + rng.normal(size=32) * 0.08 * (i % 4)).astype(np.float32).tolist()) for i in range(700)]
    hub = rng.normal(size=32)
    rows += [(1000 + i, (hub + rng.normal(size=32) * 0.1).astype(np.float32).tolist()) for i in range(150)]  # a saturated cluster
    rows += [(2000 + i, rows[0][1]) for i in range(40)]
    check_vectors(rows, nn_descent.near_duplicates(vectors_table(spark, rows), "vec_id", "embedding", leaf=32).collect())


def test_vectors_that_link_with_nothing(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-30, 0.0]), (11, [-1.0, 0.0]), (12, [1.0, 0.0])]
    check_vectors(rows, nn_descent.near_duplicates(vectors_table(spark, rows), "vec_id", "embedding").collect())
    assert nn_descent.near_duplicates(vectors_table(spark, []), "vec_id", "embedding").count() == 0


def test_repeated_and_null_vector_ids(spark):
    rows = [(5, [1.0, 0.0]), (5, [0.0, 1.0]), (7, [0.0, 1.001]), (None, [1.0, 0.001]), (None, None), (None, [-1.0, 0.0])]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in nn_descent.near_duplicates(vectors_table(spark, rows), "vec_id", "embedding").collect())
    assert got == [(0, 0, 0, False), (0, 0, 0, False), (0, 1, 5, False), (5, 1, 5, True), (5, 1, 5, True), (7, 1, 5, False)]


def test_recall_on_the_driver_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    check_vectors(rows, nn_descent.op9_embedding_dedup(spark, sf).collect())


def brute_substring(docs, window=13):
    first, out = {}, {}
    for d in sorted(docs):
        words = tools.WORDS.findall(docs[d] or "")
        for i in range(len(words) - window + 1):
            first.setdefault(tuple(words[i : i + window]), d)
    for d, t in docs.items():
        words = tools.WORDS.findall(t or "")
        gone = {i + k for i in range(len(words) - window + 1) if first[tuple(words[i : i + window])] < d for k in range(window)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[d] = (len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def digests(got):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got}


def test_substring(spark, sf):
    docs = tools.texts(table(spark, sf, "documents"))
    assert digests(substring.op10_substring_dedup(spark, sf).collect()) == brute_substring(docs)


def test_substring_over_few_words(spark):
    """Texts over a tiny vocabulary repeat in every way; small buckets and groups."""
    rng = random.Random(9)
    passage = [rng.choice("abcdefgh") for _ in range(200)]
    rows = []
    for d in range(150):
        words = [rng.choice("abcd") for _ in range(rng.randint(0, 60))]
        at = rng.randint(0, 180)
        words[5:5] = passage[at : at + rng.randint(0, 40)]
        rows.append((d, " ".join(words) if d % 20 else None))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = substring.remove_repeats(docs, "doc_id", "text", bucket_bytes=600, group_words=500)
    assert digests(got.collect()) == brute_substring(dict(rows))


def test_substring_of_nasty_rows(spark, tmp_path):
    docs = tools.nasty_documents(spark)
    assert digests(substring.op10_substring_dedup(spark, tools.folder(docs, tmp_path)).collect()) == brute_substring(tools.texts(docs))
    assert substring.op10_substring_dedup(spark, tools.folder(tools.empty_documents(spark), tmp_path)).count() == 0


def test_substring_of_repeated_and_null_ids(spark):
    t, u = (" ".join(f"{c}{i}" for i in range(20)) for c in "tu")
    rows = [(3, t), (7, t), (7, u), (None, t), (None, u), (None, "v " + u)]
    got = sorted((r.doc_id or 0, r.n_removed) for r in substring.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text").collect())
    assert got == [(0, 20), (0, 20), (0, 20), (3, 0), (7, 0), (7, 20)]


def test_copies_within_a_split_of_any_order(spark):
    """The copy of smallest id stands for its text, wherever it comes in its split."""
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(9, t), (2, t), (5, "x " + t + " y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert digests(substring.remove_repeats(docs, "doc_id", "text").collect()) == brute_substring(dict(rows))


@pytest.fixture(scope="module")
def stages(spark, sf):
    import corpus_pipeline

    docs, out = table(spark, sf, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = (docs, docs := spool(stage(spark, docs, sf), name))
    return out


def test_pipeline_stages(spark, sf, stages):
    import corpus_pipeline

    columns = table(spark, sf, "documents").columns
    for name, (before, after) in stages.items():
        if name != "packing":
            assert after.columns == columns and after.dtypes == before.dtypes
            assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    packed = {r.doc_id for r in stages["packing"][1].collect()}
    assert packed == {r.doc_id for r in stages["source_mixing"][1].collect()}
    assert corpus_pipeline.run(spark, sf).count() == stages["packing"][1].count()


def test_quality_stage_keeps_what_it_keeps(stages):
    before, after = stages["quality_rules"]
    assert not {(r.doc_id, r.text) for r in after.collect()} - {(r.doc_id, r.text) for r in before.collect()}


def test_line_stage_against_brute_force(stages):
    before, after = (tools.texts(d) for d in stages["line_dedup"])
    want = {d: (t, n) for d, (t, n) in tools.brute_lines(before).items() if not n or tools.WORDS.search(t)}
    assert after == {d: t for d, (t, _) in want.items()}


def test_mixing_stage_draws_by_the_odds(stages):
    before, after = stages["source_mixing"]
    names = ["source", "lang", "topic"]
    light = mixing.weights(before, "doc_id", "text")
    odds = {tuple(r[n] for n in names): r.probability for r in mixing.odds(light, names).collect()}
    draw = lambda d: int(hashlib.md5(str(d).encode()).hexdigest()[:13], 16) / 2**52
    assert {r.doc_id for r in after.collect()} == {r.key for r in light.collect() if draw(r.key) < odds[tuple(r[n] for n in names)]}


def test_near_dedup_keeps_rows_without_an_id(spark, sf):
    import corpus_pipeline

    rows = [(None, tools.PROSE), (None, "another text of a few words"), (4, tools.PROSE + " indeed"), (9, tools.PROSE), (9, tools.PROSE)]
    kept = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf).collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 4]


def test_near_dedup_judges_rows_by_their_own_text(spark, sf):
    """Rows that repeat an id: a text of its own stays, copies go but one, and no id joins groups that have nothing in common."""
    import corpus_pipeline

    x, y, z, v = (" ".join(f"{c}{i}" for i in range(60)) for c in "xyzv")
    rows = [(3, x, 1), (5, x + " end", 2), (5, y, 3), (7, y + " end", 4), (8, z, 5), (8, z, 6), (8, v, 7), (9, z + " end", 8), (2, None, 9), (2, "", 10), (None, v, 11), (None, v, 12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int")
    for n in (1, 4):
        kept = corpus_pipeline.near_dedup(spark, docs.repartition(n), sf)
        assert kept.columns == docs.columns
        kept = kept.collect()
        assert sorted((r.doc_id or 0, r.text or "") for r in kept) == sorted([(3, x), (5, y), (8, z), (8, v), (2, ""), (0, v), (0, v)])


def jaccard(a, b):
    def shingles(t):
        w = tools.WORDS.findall(t.lower())
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_near_dedup_stage(stages):
    """No pair of near duplicates is left, and what left has a near duplicate in the input."""
    before, after = (tools.texts(d) for d in stages["simhash_near_dedup"])
    for d in before.keys() - after.keys():
        assert max(jaccard(before[d], before[o]) for o in before if o != d) >= 0.8
    kept = sorted(after)
    assert not [(a, b) for i, a in enumerate(kept) for b in kept[i + 1 :] if abs(len(after[a]) - len(after[b])) < 0.3 * len(after[a]) and jaccard(after[a], after[b]) >= 0.8]


def test_near_dedup_finds_longer_and_shorter_versions(spark, sf):
    """Texts with new words at the end, or cut short, at 0.80 to 0.90."""
    import corpus_pipeline

    rng, rows, pairs = random.Random(6), [], []
    for i in range(120):
        words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
        extra = [f"n{rng.randrange(10**6)}" for _ in range(34 + i % 41)]  # 0.80: 296 of 370 shingles
        pair = (" ".join(words), " ".join(words + extra))
        pair = pair if i % 2 else pair[::-1]
        assert 0.8 <= jaccard(*pair) < 0.9
        pairs.append((2 * i, 2 * i + 1))
        rows += zip(pairs[-1], pair)
    base = [f"b{rng.randrange(10**6)}" for _ in range(300)]
    rows += [(1000, " ".join(base)), (1001, " ".join(base + [f"c{k}" for k in range(90)]))]  # under 0.8
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, sf).collect()}
    assert kept == {a for a, _ in pairs} | {1000, 1001}


@pytest.mark.parametrize("block", [256, 3])
def test_confirmed_links(spark, block):
    rng = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(40):
        words = list(base)
        for _ in range(i % 5):
            words[rng.randrange(120)] = f"x{rng.randrange(1000)}"
        rows.append((i, " ".join(words)))
    rows += [(90, ""), (91, None), (92, "a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = spark.createDataFrame([(i, 0) for i, _ in rows], "id long, component long")
    found = {r.id: r.component for r in graph.components(simhash.confirmed_links(docs, "doc_id", "text", groups, 0.8, block=block)).collect()}
    texts = {i: t or "" for i, t in rows}
    linked = [(a, b) for a in texts for b in texts if a < b and (not texts[a] and not texts[b] or (texts[a] and texts[b] and jaccard(texts[a], texts[b]) >= 0.8))]
    assert {i: found.get(i, i) for i in texts} == brute_components(sorted(texts), linked)


def test_pipeline_of_nasty_rows(spark, tmp_path):
    import corpus_pipeline

    at = tools.folder(tools.nasty_documents(spark), tmp_path)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs = table(spark, at, "documents")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, at).count() >= 0
        assert stage(spark, docs.limit(0), at).count() == 0
    assert corpus_pipeline.run(spark, at).count() >= 0


def brute_repeats(texts, window):
    """(first id, start, words, occurrences) of each maximal repeat, from all runs of words."""
    first_of = {}
    for d, t in sorted(texts.items()):
        first_of.setdefault(t, d)
    runs = {}
    for t, d in first_of.items():
        words = tools.WORDS.findall(t or "")
        for i in range(len(words)):
            for j in range(i + window, len(words) + 1):
                runs.setdefault(tuple(words[i:j]), []).append((d, i, words[i - 1] if i else None, words[j] if j < len(words) else None))
    found = set()
    for run, at in runs.items():
        ways = [[x[k] for x in at] for k in (2, 3)]
        if len({x[0] for x in at}) > 1 and all(None in w or len(set(w)) > 1 for w in ways):
            found.add((min(at)[0], min(x[:2] for x in at)[1], len(run), len(at)))
    return found


@pytest.mark.parametrize("buckets", [400, 4 << 20])
def test_maximal_repeats(spark, buckets):
    """Nested repeats, at both ends of texts, longer than the first ranges, in copies and near copies."""
    rng = random.Random(4)
    passage = [rng.choice("abcdefgh") for _ in range(90)]
    rows = []
    for d in range(60):
        words = [rng.choice("ab") for _ in range(rng.randint(0, 12))]
        at = rng.randint(0, 60)
        words[rng.choice([0, 5]) : 5] = passage[at : at + rng.randint(0, 90)]
        rows.append((d, " ".join(words)))
    rows += [(60, " ".join(passage)), (61, " ".join(passage)), (62, " ".join(["x", *passage])), (63, " ".join([*passage, "y"])), (64, None), (65, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = repeats.maximal_repeats(docs, "doc_id", "text", window=6, gram=3, bucket_bytes=buckets, group_words=500, width=8).collect()
    assert len(got) == len({tuple(r) for r in got}) and {tuple(r) for r in got} == brute_repeats(dict(rows), 6)
    assert max(r.n_words for r in got) == 90
    assert repeats.maximal_repeats(docs.limit(0), "doc_id", "text").count() == 0

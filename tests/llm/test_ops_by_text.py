"""Sharding, token counts, packing, quality, line dedup, mixing against brute force."""

import collections
import hashlib
import itertools
import zlib

import llm_tools as tools
import numpy as np
import pytest

from sluice.llm import bpe, line_dedup, mixing, packing, quality, sharding, token_count
from sluice.llm.common import table


@pytest.fixture(scope="module")
def library():
    return bpe.load(token_count.vocabulary())


def test_bins_are_best_fit():
    assert sharding.pack([(6, 1), (4, 1), (3, 2)], 10) == [(6, 0, 1), (4, 0, 1), (3, 1, 2)]
    assert sharding.pack([(12, 1)], 10) == [(12, 0, 1)]  # larger than the capacity: a bin of its own
    assert {b for _, b, _ in sharding.pack_into([(5, 8)], 8)} == set(range(8))


@pytest.mark.parametrize("histogram, share", [
    ([(10_000, 1), (1, 20_000)], 1 / 3),  # a group of a third of all: the others share the rest
    ([(9000, 1), (4000, 1), (1, 17_000)], 0.3),
    ([(1000, 9)], 2 / 9),
])
def test_hot_groups_leave_no_shard_empty(histogram, share):
    sizes, total = collections.Counter(), sum(s * n for s, n in histogram)
    for size, b, n in sharding.pack_into(histogram, 8):
        sizes[b] += size * n
    assert set(sizes) == set(range(8)) and sum(sizes.values()) == total and max(sizes.values()) <= share * total + 1
    rest = sorted(sizes.values())[: 8 - sum(n for s, n in histogram if s * 8 > total)]
    assert max(rest, default=0) - min(rest, default=0) <= (1000 if len(histogram) == 1 else 0.01 * total)


def check_shards(docs, got):
    assert sorted(r.doc_id for r in got) == sorted(docs)
    by_text, slots, sizes = collections.defaultdict(set), collections.defaultdict(list), collections.Counter()
    for r in got:
        t = docs[r.doc_id]
        assert r.size == len((t or "").encode()) + 1 and r.text_crc32 == zlib.crc32((t or "").encode())
        by_text[t].add(r.shard)
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r.size
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_sharding(spark, sf):
    sizes = check_shards(tools.texts(table(spark, sf, "documents")), sharding.op3_sharding(spark, sf).collect())
    assert set(sizes) == set(range(8)) and max(sizes.values()) < 1.02 * sum(sizes.values()) / 8


def test_sharding_of_nasty_rows(spark, tmp_path):
    docs = tools.nasty_documents(spark)
    check_shards(tools.texts(docs), sharding.op3_sharding(spark, tools.folder(docs, tmp_path)).collect())
    assert sharding.op3_sharding(spark, tools.folder(tools.empty_documents(spark), tmp_path)).count() == 0


@pytest.mark.parametrize("nasty", [False, True])
def test_token_counts(spark, sf, tmp_path, library, nasty):
    at = tools.folder(tools.nasty_documents(spark), tmp_path) if nasty else sf
    docs = tools.texts(table(spark, at, "documents"))
    got = token_count.op5_token_counts(spark, at).collect()
    assert len(got) == len(docs)
    for r in got:
        t = docs[r.doc_id] or ""
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(t.encode()), n, n > 1024)


def test_whole_tokens_are_proven(library):
    proven = bpe.Proof(token_count.vocabulary()).whole
    assert len(proven) > 40_000 and " the" in proven
    assert all(len(e.ids) == 1 for e in library.encode_batch(proven[::97], add_special_tokens=False))
    assert any(ord(c) > 0x400 for t in proven for c in t)


SCRIPTS = ["Привет, мир! Это дом 42.", "漢字とカナ テスト、です。 123", "مرحبا بالعالم ١٢٣", "नमस्ते दुनिया १२३", "한국어 문장 입니다", "Ελλάδα ὁ λόγος", "😀 👩‍👩‍👧 ok\u3000x", "a<|endoftext|> b<|endoftext|><|endoftext|>\n c", "x\u2028y \x1c z\x85 ", "\U0003134f \u0c5c \U0001e6c0 new", "ß's don't I'LL we've", "\ufeff  tail  \n\n"]


def test_every_script_takes_the_shortcut(library):
    counter, encoder = bpe.TokenCounter(bpe.Proof(token_count.vocabulary())), bpe.Encoder(token_count.vocabulary(), bpe.odd_characters(token_count.vocabulary()))
    want = [library.encode(t, add_special_tokens=False).ids for t in SCRIPTS]
    assert counter.count(SCRIPTS) == [len(x) for x in want]
    assert [encoder.ids(t) for t in SCRIPTS] == [np.asarray(x, "<u4").tobytes() for x in want]
    assert [counter.pretokens(t) is None for t in SCRIPTS] == ["\u0c5c" in t for t in SCRIPTS]
    small = bpe.TokenCounter(bpe.Proof(token_count.vocabulary()), entries=10, size=10)  # a cache that never holds
    assert small.count(SCRIPTS * 2) == [len(x) for x in want] * 2


def check_packing(docs, got, library, window=1024):
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert by_doc.keys() == docs.keys()
    total = 0
    for d, pieces in by_doc.items():
        ids, at = library.encode(docs[d] or "", add_special_tokens=False).ids + [0], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.length > 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[r.start : at], "<u4").tobytes())
        assert at == len(ids)
        total += at
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return total / (len(by_seq) * window)


def test_packing(spark, sf, library):
    docs = tools.texts(table(spark, sf, "documents"))
    assert check_packing(docs, packing.op6_packing(spark, sf).collect(), library) > 0.97


def test_packing_of_nasty_rows(spark, tmp_path, library):
    docs = tools.nasty_documents(spark)
    check_packing(tools.texts(docs), packing.op6_packing(spark, tools.folder(docs, tmp_path)).collect(), library)
    assert packing.op6_packing(spark, tools.folder(tools.empty_documents(spark), tmp_path)).count() == 0


def test_leftovers_merge_over_many_partitions(spark, library):
    docs = spark.range(400).selectExpr("id AS doc_id", "repeat('word ', cast(id % 90 as int)) AS text").repartition(40)
    fill = check_packing(tools.texts(docs), packing.pack_documents(docs, "doc_id", "text", open_windows=4).collect(), library)
    assert fill > 0.8


def brute_quality(t):
    words = tools.WORDS.findall(t)
    windows = collections.Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marked = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if tools.WORDS.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, len(marked)


def test_quality_counts_and_accuracy(spark, sf):
    docs = tools.texts(table(spark, sf, "documents"))
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    right = []
    for r in quality.op7_quality(spark, sf).collect():
        b = brute_quality(docs[r.doc_id] or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == b
        assert r.base_failed == (b[0] < 20 or 100 * b[4] > 30 * b[0]) and not (r.base_failed and r.kept)
        if r.doc_id in labels and not r.base_failed:
            right.append(r.kept == bool(labels[r.doc_id]))
    assert np.mean(right) > 0.95


def test_quality_holds_out(spark):
    """Fitted on half of the labelled documents, judged on the other half."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    field = quality.train(docs, labels.filter("doc_id % 2 = 0"), "doc_id", "text")
    held = {r.doc_id: r.quality for r in labels.filter("doc_id % 2 = 1").collect()}
    got = [(held[r.doc_id], r.kept) for r in quality.judge(docs, "doc_id", "text", field).collect() if r.doc_id in held and not r.base_failed]
    clean = [k for y, k in got if y]
    assert np.mean(clean) > 0.98 and np.mean([bool(y) == k for y, k in got]) > 0.95


def best_path(field, masks):
    """The labels of the best path, of all paths; of equal ones that with most content at the end."""
    score = lambda path: sum(field.emit[m] * y for m, y in zip(masks, path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))
    return max(itertools.product((0, 1), repeat=len(masks)), key=lambda path: (round(score(path), 9), path[::-1]))


def test_verdicts_against_all_paths(spark, sf):
    """kept, of texts of up to ten lines, from the best of all label sequences."""
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    field = quality.train(docs, labels, "doc_id", "text")
    texts, n = tools.texts(docs), 0
    for r in quality.judge(docs, "doc_id", "text", field).collect():
        p = quality.Profile(texts[r.doc_id] or "")
        if 0 < len(p.masks) <= 10:
            content = sum(s for s, y in zip(p.sizes, best_path(field, p.masks)) if y)
            assert r.n_content_words == content and r.kept == (not r.base_failed and 2 * content >= r.n_words)
            n += 1
    assert n > 100


def test_boilerplate_lines_inside_documents(spark):
    """Lines are told from their documents: fitted on whole documents' labels alone."""
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    field = quality.train(docs, labels, "doc_id", "text")
    good = "\n".join(f"The harbour of the old town lies beside the river, and every morning the boats go out to sea number {i}." for i in range(4))
    bad = ["HOME!! NEWS!! SPORT!! LOGIN!! CART!!", "home | news | sport | login | cart | help | about | terms", "Buy*** now$$$ cheap### deals%%% here&&& today***"]
    for line in bad:
        rows = good.split("\n")
        marked = field.decode(quality.Profile("\n".join([*rows[:2], line, line + " too", *rows[2:]])).masks)
        assert marked == [1, 1, 0, 0, 1, 1]
    documents = quality.sample(docs, labels, "doc_id", "text")
    fitted = quality.fit_lines(documents)[1]
    mixed = np.mean([len(set(y)) == 2 for y in fitted if len(y) > 1])
    assert mixed > 0.05
    judged = quality.judge(docs, "doc_id", "text", field).filter("n_content_words > 0 and n_content_words < n_words").count()
    assert judged > 50


def test_long_lines_have_all_features():
    line = "word " * 100 + "All rights reserved 2020"
    assert quality.Profile(line).masks[0] >> 8 == 3 and quality.Profile("plain words of no such kind").masks[0] >> 8 == 0


def test_quality_of_nasty_rows(spark, tmp_path):
    docs = tools.nasty_documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    field = quality.train(docs, none, "doc_id", "text")
    got = {r.doc_id: r for r in quality.judge(docs, "doc_id", "text", field).collect()}
    assert len(got) == 13 and got[3].base_failed and got[4].n_words == 0 and got[7].n_words == 60_000 and got[10].base_failed
    assert quality.judge(docs.limit(0), "doc_id", "text", field).count() == 0
    kept = quality.keep_good(docs, "text", field)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.kept}


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    field = quality.Field(rng.normal(size=len(quality.FEATURES) + 1), rng.normal(size=(2, 2)))
    for _ in range(50):
        masks = rng.integers(0, 1 << len(quality.FEATURES), 6).tolist()

        def score(path, masks=masks):
            return sum(field.emit[m] * y for m, y in zip(masks, path)) + sum(field.moves[a, b] for a, b in zip(path, path[1:]))

        best = max(score([b >> i & 1 for i in range(6)]) for b in range(64))
        assert abs(score(field.decode(masks)) - best) < 1e-9
    assert field.decode([]) == []


def dropped(spark, rows, **how):
    return {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.drop_templates(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text", **how).collect()}


def test_line_dedup_drops_recurring_templates(spark):
    rows = [(i, f"Own words {'abcdefghij'[i % 10]} stand alone number {'klmnopqrst'[i // 10]} here\nPage {i} of the {i * 7} visitors today\nAll rights reserved.") for i in range(40)]
    rows += [(100 + i, f"Dear reader mister {n} we greet you on this fine day today\nunique tail {n} never seen twice {n}") for i, n in enumerate("Ann Bob Cyd Dan Eve Fay".split())]
    got = dropped(spark, rows)
    assert got[0] == (rows[0][1], 0)  # the first carrier keeps its lines
    assert all(got[i][0].split("\n")[1:] == [] for i in range(1, 40))
    assert got[100][1] == 0 and all(got[100 + i][0].startswith("unique tail") for i in range(1, 6))
    assert got == tools.brute_lines(dict(rows))


@pytest.mark.parametrize("n", [2000, 2100, 20_000])
def test_one_template_of_any_number_of_lines(spark, n):
    name = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    got = dropped(spark, [(i, f"Dear reader mister {name(i)} we greet you on this fine day") for i in range(n)])
    assert sum(x[1] for x in got.values()) == n - 1 and got[0][1] == 0


def test_fields_of_few_values_and_carriers_as_documents(spark):
    pairs = [(i, f"Now the user {'abcdefghij'[i % 10]}x logged in from host {'klmnopqrst'[i // 10]}y and left again soon") for i in range(100)]
    assert [x[1] for _, x in sorted(dropped(spark, pairs).items())] == [0] + [1] * 99  # no value pair occurs twice
    two = [(1, "\n".join(f"Dear reader mister {n} we greet you on this fine day" for n in ("Ann", "Bob", "Cyd", "Dan"))), (2, "Dear reader mister Eve we greet you on this fine day")]
    assert all(x[1] == 0 for x in dropped(spark, two).values())  # five lines, two documents


def test_line_dedup_against_brute_force(spark, sf):
    docs = tools.texts(table(spark, sf, "documents"))
    got = {r.doc_id: (r.text, r.n_dropped) for r in line_dedup.op2_line_dedup(spark, sf).collect()}
    want = tools.brute_lines(docs)
    assert sum(n for _, n in want.values()) > 0
    assert {d: (t or "", n) for d, (t, n) in got.items()} == {d: (t or "", n) for d, (t, n) in want.items()}
    assert all((got[d][0] is None) == (docs[d] is None) for d in docs)


def test_line_dedup_of_nasty_rows(spark):
    docs = tools.nasty_documents(spark)
    out = line_dedup.drop_templates(docs, "doc_id", "text", carry=True, least_carriers=2)
    assert out.columns == docs.columns and out.count() == 13
    got = tools.texts(out)
    assert got[1] == tools.PROSE and got[2] == "" and got[3] is None and got[4] == "" and got[10] == tools.texts(docs)[10]
    fewer = line_dedup.drop_templates(docs, "doc_id", "text", carry=True, keep_emptied=False, least_carriers=2)
    assert {r.doc_id for r in fewer.collect()} == set(range(1, 14)) - {2}
    assert line_dedup.drop_templates(docs.limit(0), "doc_id", "text").count() == 0
    odd = [(None, "a line of its own"), (None, "a line of its own"), (7, "a line of its own"), (7, "a line of its own"), (9, None)]
    got = line_dedup.drop_templates(spark.createDataFrame(odd, "doc_id long, text string"), "doc_id", "text", least_carriers=2).collect()
    assert sorted((r.doc_id or 0, r.text, r.n_dropped) for r in got if r.text is not None) == [(0, "", 1)] * 2 + [(7, "a line of its own", 0)] * 2


NAMES = ["source", "lang", "topic"]


def test_drawn_tokens_meet_the_targets(spark):
    at = "/root/testdata/sf0.01"
    cells = mixing.odds(mixing.weights(table(spark, at, "documents"), "doc_id", "text"), NAMES)
    assert cells.filter("probability > 1").count() == 0
    by = {(r.margin, r.value): (r.target, r.expected) for r in mixing.report(cells, NAMES, mixing.TARGETS).collect()}
    assert all(abs(t - e) <= 6e-3 * t + 1e-9 for t, e in by.values())
    assert abs(sum(by["lang", x][0] for x in ("en", "de", "fr", "es")) + by.get(("lang", "\\N"), (0,))[0] - 1) < 1e-9
    assert abs(by["source", "src0"][0] - 0.1) < 1e-9
    drawn = mixing.op1_source_mixing(spark, at).filter("sampled").groupBy("lang").agg({"tokens": "sum"}).toPandas().set_index("lang")["sum(tokens)"]
    assert np.allclose([by["lang", x][1] for x in drawn.index], drawn / drawn.sum(), atol=0.04)


def test_full_cells_are_fixed_and_the_rest_raked_on(spark):
    """A cell that cannot give what plain raking asks: the others of its values make up for it."""
    cells = spark.createDataFrame([("a", "x", "t", 10.0), ("a", "y", "t", 90.0), ("b", "x", "t", 290.0), ("b", "y", "t", 210.0)], "source string, lang string, topic string, tokens double")
    targets = {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.6, "y": 0.4}, "topic": {}}
    fitted = mixing.rake(cells, NAMES, targets, keep=0.5, fill=1.0)
    got = {(r.source, r.lang): (r.tokens * min(1.0, r.odds), r.odds) for r in fitted.collect()}
    assert max(x[1] for x in got.values()) > 1 and got["a", "x"][0] == 10.0
    whole = sum(x[0] for x in got.values())
    assert abs(sum(v[0] for k, v in got.items() if k[0] == "a") - 0.3 * whole) < 0.01 * whole
    assert abs(sum(v[0] for k, v in got.items() if k[1] == "x") - 0.6 * whole) < 0.01 * whole


def test_a_scarce_value_does_not_empty_the_corpus(spark):
    """One document of a value that should be a tenth: it gives what it has, the others share the rest."""
    docs = spark.range(2000).selectExpr("id AS doc_id", "'one two three four' AS text", "if(id = 7, 'src0', concat('s', id % 4)) AS source", "'en' AS lang", "'t' AS topic")
    cells = mixing.odds(mixing.weights(docs, "doc_id", "text"), NAMES, mixing.TARGETS)
    got = {r.source: r.probability for r in cells.collect()}
    assert abs(got["src0"] - 0.8) < 0.01 and all(abs(got[f"s{k}"] - 0.25) < 0.01 for k in range(4))
    assert 400 < mixing.sample(docs, "doc_id", "text").count() < 600
    table_ = spark.createDataFrame([("a", 0.6, 10.0), ("b", 0.3, 90.0), ("c", 0.1, 900.0)], "source string, share double, n double")
    assert [round(r.share, 9) for r in mixing.within_reach(table_, 500.0, 1.0).orderBy("source").collect()] == [0.02, 0.18, 0.8]


def test_raking_says_how_far_off_it_ended(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10.0), ("b", "y", "t", 90.0)], "source string, lang string, topic string, tokens double")
    with pytest.warns(UserWarning, match="off its target"):
        mixing.rake(cells, NAMES, {"source": {"a": 0.05, "b": 0.95}, "lang": {"x": 0.1, "y": 0.9}, "topic": {}}, rounds=2)


def test_training_is_bounded_in_rows_and_lines(spark):
    docs = spark.range(500).selectExpr("1L AS doc_id", "repeat('some words here\n', 50) AS text").union(spark.range(2, 40).selectExpr("id AS doc_id", "'other words'"))
    labels = spark.range(1, 40).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    rows = quality.sample(docs, labels, "doc_id", "text", train_documents=10, train_lines=7)
    assert len(rows) == 10 and max(len(masks) for masks, _, _ in rows) <= 7


def test_own_topics_and_unnamed_values(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "'one two three four' AS text", "if(id % 3 = 0, 'hot', null) AS source", "'en' AS lang", "if(id % 10 = 0, 'rare', 'often') AS topic")
    cells = mixing.odds(mixing.weights(docs, "doc_id", "text"), NAMES, {"topic": {"rare": 0.2}, "source": {}, "lang": {"en": 1.0, "xx": 1.0}})
    by = {(r.margin, r.value): (r.target, r.expected) for r in mixing.report(cells, NAMES, {"topic": {"rare": 0.2}, "source": {}, "lang": {"en": 1.0, "xx": 1.0}}).collect()}
    assert by["topic", "rare"][0] == 0.2 and by["lang", "en"][0] == 1.0 and abs(by["source", "hot"][0] - 1 / 3) < 1e-9


def test_sampling_follows_the_odds(spark, sf):
    docs = table(spark, sf, "documents")
    got = mixing.op1_source_mixing(spark, sf).toPandas()
    draws = got["doc_id"].map(lambda d: int(hashlib.md5(str(d).encode()).hexdigest()[:13], 16) / 2**52)
    sure = (draws - got["probability"]).abs() > 1e-5
    assert ((draws < got["probability"]) == got["sampled"])[sure].all()
    kept = mixing.sample(docs, "doc_id", "text")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(got[got["sampled"]]["doc_id"])


def test_mixing_of_nasty_rows(spark):
    docs = tools.nasty_documents(spark)
    assert mixing.sample(docs, "doc_id", "text", targets={}, keep=1e12, fill=1.0).count() == 13
    assert mixing.sample(docs.limit(0), "doc_id", "text").count() == 0


def test_mixing_runs_no_python(spark, sf):
    light = mixing.weights(table(spark, sf, "documents"), "doc_id", "text")
    cells = light.groupBy(*NAMES).agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")
    plan = mixing.rake(cells, NAMES, mixing.TARGETS, rounds=1)._jdf.queryExecution().toString() + light._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))

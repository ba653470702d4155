"""Conversation trie, HTML text and source divergence against brute force."""

import collections
import hashlib
import html
import random
import re
import zlib

import pytest
from llm_tools import WORDS, empty_documents, nasty_documents

from sluice.llm import divergence, html_blocks, prefix_trie


@pytest.fixture
def many_blocks(spark):
    """Small tables fall into many ranges, so that most nodes reach over blocks."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def brute_trie(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [t[3:] for t in sorted(v)] for c, v in own.items()}
    members = collections.defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole = own.get(c - c % 20, [])[:h] + turns[h:]
        for d in range(len(whole) + 1):
            members[tuple(whole[:d])].append((c, len(whole) == d))
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(m) - 1) * (len(WORDS.findall(k[-1][1])) if k else 0)
    return sorted(
        (min(m)[0], len(k), min(members[k[:-1]])[0] if k else -1, len(m), children[k], leaves[k], saved[k], hashlib.sha256(",".join(str(c) for c, ends in sorted(m) if ends).encode()).hexdigest())
        for k, m in members.items()
    )


def trie(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS key", "2 AS block", "3 AS t", "4 AS base", "5 AS words")
    return sorted(tuple(-1 if x is None else x for x in r) for r in prefix_trie.prefix_trie(df.repartition(3)).collect())


def conversations(seed, n, alphabet, deepest):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(3 * n), n):
        rows += [(c, t, r.choice(["user", None]), " ".join("ab"[: r.randrange(1, 3)] * r.randrange(1, alphabet))) for t in range(r.randrange(1, deepest))]
    return rows


@pytest.mark.parametrize("seed, n, alphabet, deepest", [(1, 150, 2, 9), (2, 120, 3, 5), (3, 40, 2, 40)])
def test_trie_of_many_blocks(spark, many_blocks, seed, n, alphabet, deepest):
    rows = conversations(seed, n, alphabet, deepest)
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_odd_rows(spark, many_blocks):
    long_ = "w " * 50_000
    rows = [
        (0, 1, "user", "hi"), (0, None, "user", "first"), (0, 1, "user", "hi"), (0, 1, "assistant", "tie"), (1, 0, None, None), (1, 1, "", ""), (2, 0, "user", long_), (None, 0, "user", "nobody"), (20, 5, "user", "x"), (21, 0, "user", "x"), (22, 0, "u", "serx"), (23, 0, "us", "erx"),
        *((c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(5)), *((7, t, "user", str(t)) for t in range(300)),
    ]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_one_path(spark):
    assert trie(spark, []) == []
    rows = [(5, t, "user", "a b") for t in range(3)]
    assert trie(spark, rows) == brute_trie(rows)
    rows = [(c, t, "user", "a b") for c in range(40, 60) for t in range(4)]
    assert trie(spark, rows) == brute_trie(rows)


def test_many_ids_end_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE", 7)
    rows = [(c, 0, "user", "same") for c in range(0, 3000, 20)]
    assert trie(spark, rows) == brute_trie(rows)


def brute_audit(rows, least=30, top=50):
    docs = collections.defaultdict(list)
    for lang, source, text in rows:
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        docs[lang or "", source or ""].append(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low))
    out = []
    for lang in {g for g, _ in docs}:
        groups = {s: collections.Counter(w for d in v for w in d) for (g, s), v in docs.items() if g == lang}
        df = collections.Counter(w for (g, _), v in docs.items() if g == lang for d in v for w in set(d))
        kept = [w for w in df if df[w] >= least]

        def shares(count):
            n = sum(count[w] for w in kept)
            return {w: 1 + 10**9 * (count[w] + 5) // (n + 5 * len(kept)) for w in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(sum(groups.values(), collections.Counter()))
        for s in groups:
            pairs = [(-sum(abs(p[s][w] - p[o][w]) for w in kept), o.encode()) for o in groups if o != s]
            terms = [(q[w] - p[s][w], w.encode()) for w in kept if groups[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -f, k + 1) for k, (f, item) in enumerate(found)]
    return sorted(out)


def audit(df, **k):
    return sorted(tuple(r) for r in divergence.audit(df, **k).collect())


@pytest.mark.parametrize("terms, sources", [(256, 128), (3, 2)])
def test_audit(spark, monkeypatch, terms, sources):
    monkeypatch.setattr(divergence, "TERMS", terms)
    monkeypatch.setattr(divergence, "SOURCES", sources)
    r = random.Random(5)
    vocabulary = ["the", "The", "été", "ÉTÉ", "漢字", "a-b", "x1y", "z_z", "of", "off", "in", "on", "at"]
    rows = [(r.choice(["en", "en", "fr", None]), r.choice(["a", "b", "c", "é", "z", None]), " ".join(r.choices(vocabulary, k=r.randrange(12)))) for _ in range(300)]
    rows += [("en", "mute", "123 456"), ("xx", "only", "rare"), ("yy", "p", None), ("yy", "q", "")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").selectExpr("*", "1 AS n", "2 AS term", "3 AS side", "4 AS block")
    assert audit(df, least=5, top=4) == brute_audit(rows, 5, 4)


def test_audit_of_odd_tables(spark):
    assert audit(empty_documents(spark)) == []
    docs = nasty_documents(spark)
    rows = [(r.lang, r.source, r.text) for r in docs.collect()]
    assert audit(docs, least=2) == brute_audit(rows, 2)
    assert audit(docs.union(docs), least=2) == brute_audit(rows * 2, 2)


def test_shares_are_exact_for_large_counts():
    import numpy as np

    counts, total, terms = [0, 1, 10**14, 7 * 10**15 - 6], 7 * 10**15, 10**6
    found = divergence.shares(np.array(counts), np.int64(total), np.int64(terms))
    assert found.tolist() == [1 + 10**9 * (c + 5) // (total + 5 * terms) for c in counts]


PROSE = "The committee met on the first of the month and it was agreed by all of the members that the work on the road should be done in the spring"
SHELL = {
    "nav": '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News of the day</a></ul></nav>', "head": "<header><p>The best paper in the town and of the county</p></header>", "foot": "<footer>&copy; 2020 the owners of the site</footer>",
    "side": f'<div class="sidebar"><p>{PROSE} sidebar.</p></div>', "ad": f'<div class="ad-box">{PROSE} advert.</div>', "notice": '<div id="cookie-notice">We use cookies on this site so that it works for you.</div>', "form": '<form><label>The name</label><input name="n"><button>Send it to us</button></form>',
    "notes": f'<section id="comments"><article class="comment"><p>{PROSE} comment.</p></article></section>', "script": "<script>document.write('<p>the of and</p>')</script><style>p > a {}</style><!-- <p>the note of</p> -->", "menu": '<div role="navigation">All of the menus</div>', "hidden": f'<p hidden>{PROSE} hidden</p><p style="display: none">{PROSE} unseen</p>',
}


@pytest.mark.parametrize("wrap", ["<article>%s</article>", '<main class="has-sidebar">%s</main>', '<form id="page"><article>%s</article></form>', '<div class="layout">%s</div>', '<div class="sidebar-right"><article class="post">%s</article></div>'])
@pytest.mark.parametrize("seed", range(4))
def test_article_among_the_rest(wrap, seed):
    r = random.Random(seed)
    paragraphs = [f"{PROSE} &amp; number {k} of the caf&eacute;s&nbsp;&lt;here&gt;.\n  It was the end of <b>this</b><i>one</i> and it is as good as the other ones are, so they say." for k in range(4)]
    body = "<h1>On the road</h1>" + "".join(f"<p>{p}" for p in paragraphs[:2]) + "<p>So it is.</p>" + "".join(f"<p>{p}<br>Then.</p>" for p in paragraphs[2:])
    plain = [" ".join(html.unescape(re.sub(r"</?[bi]>", "", p)).split()) for p in paragraphs]
    shell = list(SHELL.values())
    r.shuffle(shell)
    page = f"<!DOCTYPE html><html><head><title>The road</title></head><body class='sidebar no-ads'>{''.join(shell[:5])}{wrap % body}{''.join(shell[5:])}"
    assert html_blocks.main_text(page) == " ".join(["On the road", *plain[:2], "So it is.", plain[2] + " Then.", plain[3] + " Then."])


def test_broken_markup():
    t = html_blocks.main_text
    assert t(None) == t("") == t("<nav>menu</nav>") == t("<article></article>") == ""
    assert t("<article><p>a < b &amp b</article>") == "a < b & b"
    assert t('<article><p title="x > y">one<p class="ad">two<p>three') == "one three"
    assert t("<article><p>kept</p></article><script>never closed <p>x</p>") == "kept"
    assert t('<article><p>kept <a href="no end>x</a> more</p></article>').startswith("kept")
    assert t("<article><p>a<!-- b > c --><!--> d<span>e</span>f<span class='share-this'>g</span></p></article>") == "a def"
    assert t("<article><p>a</p><div class='related'><p>b</p></div><p>c</p><aside>d</aside></article>") == "a c"
    assert t("<article>" + "<div>" * 20_000 + "deep" + "</span>" * 20_000) == "deep"
    assert t("<article><p>" + "<a \"" * 20_000 + "</p></article>") == ""
    assert t("<article><p>" + "word " * 200_000) == ("word " * 200_000).strip()


def test_blocks_without_an_article():
    page = f"<div>{PROSE}. {PROSE}.</div><div>Short.</div><div>{PROSE}; {PROSE}.</div><div>xyzzy plugh qwerty asdf zxcv uiop hjkl vbnm tyui ghjk bnmq wert sdfg</div><div>Off.</div>"
    assert html_blocks.main_text(page) == f"{PROSE}. {PROSE}. Short. {PROSE}; {PROSE}."


def test_pages_of_odd_rows(spark):
    rows = [(1, "u", f"<article><p>{PROSE}</p></article>"), (1, "u", f"<article><p>{PROSE}</p></article>"), (None, None, None), (2, None, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_chars", "3 AS key")
    found = sorted(map(tuple, html_blocks.extract(df).collect()), key=str)
    assert found == sorted([(1, "u", PROSE, len(PROSE))] * 2 + [(None, None, "", 0), (2, None, "", 0)], key=str)
    assert html_blocks.extract(df.limit(0)).count() == 0


def test_pages_of_the_table(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    for r in html_blocks.op12_html_text(spark, sf).collect():
        article = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub(r"</?b>", "", re.sub(r"</?(?:p|h1|br)>", " ", article))).split())
        assert r.n_chars == len(r.text)

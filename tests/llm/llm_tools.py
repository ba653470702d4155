"""Small tables for the tests of this folder: nulls, empties, ties, long texts, clashing columns."""

from __future__ import annotations

import collections
import itertools
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
PROSE = "The quick brown fox jumps over a lazy dog while seven wise owls watch from the old oak tree beside the silent river bank"


def nasty_documents(spark):
    """Rows that must not crash an operator, with extra columns of clashing names."""
    long_ = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    rows = [
        (1, PROSE, "en", "a"), (2, PROSE, "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, "   \n\t ", "en", "b"), (6, "one", "fr", "b"), (7, long_, "en", "a"),
        (8, PROSE + " indeed", "en", "a"), (9, "é" * 5000, "fr", "c"), (10, "\n".join(["same line again here"] * 30), "en", "a"), (11, "漢字 テスト 😀 <|endoftext|> x", "ja", "c"), (12, None, "en", "a"), (13, PROSE.upper(), "en", "a"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return docs.selectExpr("*", "length(text) AS n_chars", "1 AS key", "2 AS shard", "3 AS fp", "'z' AS bucket", "4 AS part", "5 AS id", "6 AS probability", "7 AS cell", "8 AS size")


def empty_documents(spark):
    return nasty_documents(spark).limit(0)


def texts(df):
    return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}


def folder(df, tmp_path, name="documents"):
    path = tmp_path / "tables"
    df.write.mode("overwrite").parquet(f"{path}/{name}.parquet")
    return str(path)


STAR = "\0"


def brute_templates(line, similarity=0.7, least_tokens=3):
    """The templates of a line: itself and with one or two of its eight runs generalised."""
    tokens = [STAR if any(c.isdigit() and c.isascii() for c in w) else w for w in WORDS.findall(line)]
    n = len(tokens)
    if n < least_tokens:
        return set()
    lead = min(n, 3)
    cuts = [lead + (n - lead) * k // 8 for k in range(9)]
    out = set()
    for mask in [(), *itertools.combinations(range(8), 1), *itertools.combinations(range(8), 2)]:
        places = [set(range(cuts[k], cuts[k + 1])) for k in mask]
        field = set().union(*places)
        if all(places) and len(field) <= 0.3 * n + 1e-9 and any(t != STAR for i, t in enumerate(tokens) if i not in field):
            out.add((n, mask, tuple(None if i in field else t for i, t in enumerate(tokens))))
    return out


def brute_lines(docs, least=5):
    """The texts without the lines of recurring templates."""
    carriers = collections.defaultdict(set)
    for d, t in docs.items():
        for line in (t or "").split("\n"):
            for x in brute_templates(line):
                carriers[x].add(d)
    out = {}
    for d, t in docs.items():
        kept = [line for line in (t or "").split("\n") if not any(len(carriers[x]) >= least and min(carriers[x]) != d for x in brute_templates(line))]
        out[d] = (None if t is None else "\n".join(kept), (t or "").count("\n") + 1 - len(kept))
    return out

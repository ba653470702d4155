"""Source divergence audit: how far the sources of a language use its terms differently.

A term is a run of ASCII letters and non-ASCII characters, A-Z lower-cased. Terms are counted
in the scan, a Counter for each (language, source) that a task meets, flushed when large, and
summed by Spark. A language keeps the terms in at least ``least`` of its documents. A group's
smoothed share of a term is the integer ``1 + floor(10^9 (count + 5) / (N + 5 V))``.

Pairs and top terms come from dense tiles: the kept terms of a language are dealt to blocks of
about ``TERMS`` by hash, its sources to blocks of ``SOURCES``; a tile is the int64 matrix of
the sources of two blocks by the terms of one, and all pairs of its rows are compared by
broadcasting, some rows at a time. A task adds up the pair matrices of the tiles that it meets
one after the other, Spark sums what tasks found; each group's heap of the ``top`` terms is
merged the same way. So a language with most of the rows, or with very many terms or
sources, is spread over its tiles, and a tile's memory is bounded by the two constants.

Null text, lang and source are ''. A row is a document, whatever its id: repeated rows and ids
count each. Texts are read whole. Equal values rank by the UTF-8 bytes of their items. Groups
without terms take part; a language of one source has no pairs; one without kept terms has
pairs of value 0. Extra columns are ignored, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_rows, batch, spool, table, whole_groups

#: Over lower-cased UTF-8: letters, and every byte of a character outside ASCII.
TERM = re.compile(rb"[a-z\x80-\xff]+")
#: Size of a tile: terms, and sources a side.
TERMS, SOURCES = 256, 128
#: Distinct terms that a task holds before it passes its counts on.
HELD = 400_000
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())])
_FOUND = pa.schema([("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def shares(counts: np.ndarray, totals: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 (count + 5) / (total + 5 terms)), exact while totals stay under 9 * 10^15:
    three decimal digits at a time, so that nothing overflows."""
    rest, whole = counts + 5, totals + 5 * terms
    out = np.zeros_like(rest)
    for _ in range(3):
        rest = rest * 1000
        digits = rest // whole
        out = out * 1000 + digits
        rest = rest - digits * whole
    return out + 1


def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each term and group, of batches of (lang, source, UTF-8 text)."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))

    def flush():
        for (lang, source), (n, df) in held.items():
            terms = list(n)
            for k in range(0, len(terms), 50_000):
                some = terms[k : k + 50_000]
                yield batch(_COUNTS, [[lang] * len(some), [source] * len(some), [t.decode() for t in some], [n[t] for t in some], [df[t] for t in some]])
        held.clear()

    for b in batches:
        for lang, source, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            words = TERM.findall(text.as_py().lower())
            n, df = held[lang, source]
            n.update(words)
            df.update(set(words))
        if sum(len(n) for n, _ in held.values()) > HELD:
            yield from flush()
    yield from flush()


def _tiles(top: int):
    """Pair sums and top terms of tiles; rows come sorted by (lang, lo, hi, block), each source's
    own row (term '') beside those of its terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs: dict[tuple, tuple] = {}  # the names of the rows and columns of a matrix of sums
        heaps: dict[tuple, list] = defaultdict(list)
        at = None

        def flush():
            for (lang, lo, hi), (of_left, of_right, sums) in pairs.items():
                x, y = np.triu_indices(len(of_left), 1) if lo == hi else np.indices(sums.shape).reshape(2, -1)
                a, b, f = of_left[x], of_right[y], sums[x, y]
                yield batch(_FOUND, [[lang] * 2 * len(a), ["pair"] * 2 * len(a), [*a, *b], [*b, *a], [*f, *f]])
            for (lang, source), heap in heaps.items():
                yield batch(_FOUND, [[lang] * len(heap), ["term"] * len(heap), [source] * len(heap), [t for _, t in heap], [-f for f, _ in heap]])
            pairs.clear()
            heaps.clear()

        for rows, group in whole_groups(batches, ("lang", "lo", "hi", "block")):
            cut = np.flatnonzero(np.diff(group, prepend=group[0] - 1))
            for start, end in zip(cut, [*cut[1:], len(group)]):
                t = rows.slice(start, end - start)
                key = tuple(t[c][0].as_py() for c in ("lang", "lo", "hi"))
                if key != at:
                    if at is not None:
                        yield from flush()
                    at = key
                _, lo, hi = key
                term, side, number, n = t["term"].to_numpy(), t["side"].to_numpy(), t["number"].to_numpy(), t["n"].to_numpy()
                own = term == ""
                order = np.argsort(number[own], kind="stable")
                numbers, name = number[own][order], t["source"].to_numpy()[own][order]
                first = side[own][order] == lo
                names, column = np.unique(term[~own], return_inverse=True)
                counts = np.zeros((len(numbers), len(names)), np.int64)
                counts[np.searchsorted(numbers, number[~own]), column] = n[~own]
                terms = t["terms"].to_numpy()[0]
                p = shares(counts, n[own][order][:, None], terms)
                left, right = (p, p) if lo == hi else (p[first], p[~first])
                of_left, of_right = (name, name) if lo == hi else (name[first], name[~first])
                sums = np.zeros((len(left), len(right)), np.int64)
                for k in range(0, len(left), 16):
                    sums[k : k + 16] = np.abs(left[k : k + 16, None, :] - right[None, :, :]).sum(axis=2)
                pairs[key] = of_left, of_right, sums + (pairs[key][2] if key in pairs else 0)
                if lo == hi and len(names):
                    everywhere = np.zeros(len(names), np.int64)
                    everywhere[column] = t["total"].to_numpy()[~own]
                    q = shares(everywhere, t["lang_n"].to_numpy()[0], terms)
                    over = (counts > 0) & (p > q)
                    for g in np.flatnonzero(over.any(axis=1)):
                        new = [(-int(p[g, c] - q[c]), names[c]) for c in np.flatnonzero(over[g])]
                        heaps[key[0], name[g]] = heapq.nsmallest(top, heaps[key[0], name[g]] + new)
        if at is not None:
            yield from flush()

    return run


def audit(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = 30, top: int = 50) -> DataFrame:
    """lang, source, part ('pair' or 'term'), item, value, rank."""
    spark = docs.sparkSession
    arrow_rows(spark, 1000)
    named = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    counts = spool(named.mapInArrow(count_terms, "lang string, source string, term string, n long, df long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df")), "terms")
    kept = spool(counts.groupBy("lang", "term").agg(F.sum("df").alias("df"), F.sum("n").alias("total")).filter(F.col("df") >= least).drop("df"), "kept")
    counted = spool(counts.drop("df").join(kept, ["lang", "term"]), "counted")

    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("lang_n"))
    sizes = counted.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    groups = (
        named.select("lang", "source").distinct().join(sizes, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["size", "terms", "lang_n"])
        .withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
        .withColumn("sides", F.floor((F.count("*").over(Window.partitionBy("lang")) - 1) / SOURCES))
        .withColumn("side", F.floor(F.col("number") / SOURCES))
        .withColumn("blocks", F.greatest(F.ceil(F.col("terms") / TERMS), F.lit(1)))
    )
    groups = spool(groups, "groups")
    columns = ["lang", "lo", "hi", "block", "number", "side", "source", "term", "n", "total", "terms", "lang_n"]
    own = groups.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select("*", F.lit("").alias("term"), F.col("size").alias("n"), F.lit(0).cast("long").alias("total"))
    of_terms = counted.join(groups, ["lang", "source"]).withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")))
    rows = own.unionByName(of_terms, allowMissingColumns=True).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("sides"))))
    rows = rows.withColumn("lo", F.least("side", "other")).withColumn("hi", F.greatest("side", "other")).select(*columns)
    tiled = rows.repartition("lang", "lo", "hi", "block").sortWithinPartitions("lang", "lo", "hi", "block")
    found = tiled.mapInArrow(_tiles(top), "lang string, part string, source string, item string, value long")
    found = found.groupBy("lang", "part", "source", "item").agg(F.sum("value").alias("value"))
    best = (F.col("part") == "pair") | (F.col("rank") <= top)
    for share in ([F.pmod(F.xxhash64("item"), F.lit(16))], []):  # heaps of sixteenths first: tasks' heaps may be many
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part", *share).orderBy(F.desc("value"), "item"))).filter(best)
    return found.select("lang", "source", "part", "item", "value", "rank")


def op13_source_divergence(spark, sf_dir: str) -> DataFrame:
    """Every language and source of the documents."""
    return audit(table(spark, sf_dir, "documents"))

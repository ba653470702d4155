"""Maximal repeats: the subtrees of substring dedup grown to their full depth, by elastic ranges.

A repeat is a run of ``window`` words or more that stands in two different texts at least; it is
maximal if its occurrences don't all go on by the same word, nor all come after the same word.
These are the internal nodes of the subtrees whose leaves have different words before them. A
first range of words shows the nodes within it; a node that is as deep as all words sent stays
open, and only its leaves send a further range, twice as long. A node whose leaves all follow one
word ends there, as nothing below it can be maximal: so of a long passage only its start goes on.

A unit sends one entry for all its occurrences of equal words, with their number, so a passage that
all documents share costs a unit one entry for each word before it and way to go on.
Equal texts count as one, that of the smallest id. Null texts and texts of under ``window`` words
hold no repeat; very long texts are read whole; a null id comes out as null; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, spool
from .substring import _LAST, Unit, candidates, leaves, numbered, received_words, sent_words
from .wordcodes import tables

_RANGE = pa.schema([("part", pa.string()), ("bucket", pa.int32()), ("facts", pa.binary()), ("vocabulary", pa.binary()), ("words", pa.binary())])
_RANGE_DDL = "part string, bucket int, facts binary, vocabulary binary, words binary"
_NODE = pa.schema([("part", pa.string()), ("bucket", pa.int32()), ("facts", pa.binary()), ("key", pa.int64()), ("start", pa.int64()), ("n_words", pa.int64()), ("n_occurrences", pa.int64())])
_NODE_DDL = "part string, bucket int, facts binary, key long, start long, n_words long, n_occurrences long"
#: What an entry tells of its occurrences: id and place of the first, its text, the last one's text, their number.
_KEY, _AT, _TEXT, _LAST_TEXT, _N = range(5)


def deep_nodes(shared: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """The internal nodes of least depth: (first leaf, leaf after the last, depth)."""
    held: list[tuple[int, int]] = []
    for i, d in enumerate([*shared[1:].tolist(), -1], 1):
        low = i - 1
        while held and held[-1][0] > d:
            depth, low = held.pop()
            yield low, i, depth
        if d >= least and (not held or held[-1][0] < d):
            held.append((d, low))


class Reach:
    """The words around occurrences in a unit's texts, as numbers; 0 is no word."""

    def __init__(self, u: Unit):
        self.u = u
        coded, self.vocabulary = numbered([b"", *(w for ws in u.split for w in ws)])
        self.number = coded[1:]
        self.base = np.concatenate([[0], np.cumsum(u.counts)])

    def words(self, start: np.ndarray, text: np.ndarray, low: int, width: int) -> np.ndarray:
        """The word before each start, then the words from low on."""
        at = start[:, None] + np.concatenate([[-1], np.arange(low, low + width)])
        there = (at >= self.base[text][:, None]) & (at < self.base[text + 1][:, None])
        return np.where(there, self.number[np.where(there, at, 0)], 0)

    def entries(self, start: np.ndarray, text: np.ndarray, low: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(facts, words, start) of the entries of occurrences in rising order."""
        m = self.words(start, text, low, width)
        order, shared = leaves(m, len(self.vocabulary))
        first = np.flatnonzero(shared <= width)
        n = np.diff([*first, len(order)])
        head, tail = order[first], order[first + n - 1]
        t = text[head]
        return np.stack([self.u.keys[t], start[head] - self.base[t], t, text[tail], n], axis=1).astype("<i8"), m[head], start[head]

    def members(self, facts: np.ndarray, low: int) -> tuple[np.ndarray, np.ndarray]:
        """All occurrences of the entries of these facts, which share low words."""
        u, mine = self.u, self.base[facts[:, _TEXT]] + facts[:, _AT]
        entry = np.empty(len(u.start), np.int64)
        entry[u.order] = u.entry
        of = entry[np.searchsorted(u.start, mine)]
        at = np.flatnonzero(np.isin(entry, of))
        order, shared = leaves(self.words(u.start[at], u.text[at], 0, low), len(self.vocabulary))
        kin = np.cumsum(shared <= low)
        told = np.isin(kin, kin[np.isin(u.start[at][order], mine)])
        at = np.sort(at[order][told])
        return u.start[at], u.text[at]


def maximal_repeats(docs: DataFrame, key: str, text: str, window: int = 13, gram: int = 6, bucket_bytes: int = 4 << 20, group_words: int = 4 << 20, width: int = 16) -> DataFrame:
    """(key, start, n_words, n_occurrences): a row for each maximal repeat, named by where it first
    stands, in the text of smallest id: its first word there (from 0) and its length."""
    distinct = docs.filter(F.col(text).isNotNull()).groupBy(F.col(text).alias("text")).agg(F.min(F.col(key).cast("long")).alias("key"))
    by_bucket, replies, cuts = candidates(spool(distinct, "texts"), "key", "text", window, gram, bucket_bytes, group_words)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        u = Unit(left, right, window, gram, cuts)
        if not len(u.start):
            return _RANGE.empty_table()
        r = Reach(u)
        facts, m, start = r.entries(u.start, u.text, 0, width)
        part = np.empty(len(u.suffixes), np.int64)  # of each window, as its prefix says
        for p, g in u.sent.items():
            part[g] = p
        entry = np.empty(len(u.start), np.int64)
        entry[u.order] = u.entry
        part = part[entry[np.searchsorted(u.start, start)]]
        by = np.argsort(part, kind="stable")
        rows = [(str(part[g[0]]), left["bucket"][0].as_py(), facts[g].tobytes(), *sent_words(m[g], r.vocabulary)) for g in np.split(by, np.flatnonzero(np.diff(part[by])) + 1)]
        return pa.Table.from_batches([batch(_RANGE, [list(c) for c in zip(*rows)])])

    def subtree(depth: int, width: int, least: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in tables(batches, "part"):
                told = [np.frombuffer(f, "<i8").reshape(-1, 5) for f in t["facts"].to_pylist()]
                bucket = np.repeat(t["bucket"].to_numpy(), [len(f) for f in told])
                facts = np.concatenate(told)
                m, vocabulary = received_words(t["vocabulary"].to_pylist(), t["words"].to_pylist(), width + 1)
                # several occurrences of an entry are two leaves: they make a node of their own
                several = np.flatnonzero(facts[:, _N] > 1)
                entry = np.concatenate([np.arange(len(facts)), several])
                count = facts[entry, _N].copy()
                count[several] -= 1
                count[len(facts) :] = 1
                order, shared = leaves(m[entry, 1:], len(vocabulary))
                entry, count = entry[order], count[order]
                end = pc.index(vocabulary, b"").as_py()
                shared = np.minimum(shared, (m[entry, 1:] != end).sum(axis=1))
                before = m[entry, 0]
                other = np.zeros(len(entry), np.int64)  # steps to another word before, or none
                other[1:] = (before[1:] != before[:-1]) | (before[1:] == end)
                other = np.cumsum(other)
                low_text = (bucket[entry].astype(np.int64) << 32) | facts[entry, _TEXT]
                high_text = (bucket[entry].astype(np.int64) << 32) | facts[entry, _LAST_TEXT]
                part = t["part"][0].as_py()
                for number, (low, high, shares) in enumerate(deep_nodes(shared, least)):
                    if other[high - 1] == other[low] or low_text[low:high].min() == high_text[low:high].max():
                        continue
                    here = np.unique(entry[low:high])
                    if shares < width:
                        first = here[np.lexsort((facts[here, _AT], facts[here, _KEY]))[0]]
                        yield batch(_NODE, [[None], [None], [None], [int(facts[first, _KEY])], [int(facts[first, _AT])], [depth + shares], [int(count[low:high].sum())]])
                    else:
                        for b in np.unique(bucket[here]).tolist():
                            yield batch(_NODE, [[f"{part}.{number}"], [b], [facts[here[bucket[here] == b]].tobytes()], [None], [None], [None], [None]])

        return run

    def send_on(depth: int, width: int):
        columns = ["key", "text", "bucket"]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            opened = right.filter(pc.is_valid(right["part"]))
            if not opened.num_rows or not left.num_rows:
                return _RANGE.empty_table()
            u = Unit(left.select(columns), right.filter(pc.is_valid(right["kind"])), window, gram, cuts)
            r, rows = Reach(u), []
            for part, facts in zip(opened["part"].to_pylist(), opened["facts"].to_pylist()):
                start, text_ = r.members(np.frombuffer(facts, "<i8").reshape(-1, 5), depth)
                found, m, _ = r.entries(start, text_, depth, width)
                rows.append((part, left["bucket"][0].as_py(), found.tobytes(), *sent_words(m, r.vocabulary)))
            return pa.Table.from_batches([batch(_RANGE, [list(c) for c in zip(*rows)])])

        return run

    def grown(sent: DataFrame, depth: int, width: int, least: int) -> DataFrame:
        return spool(sent.repartition("part").sortWithinPartitions("part").mapInArrow(subtree(depth, width, least), _NODE_DDL), "nodes")

    found = grown(by_bucket.cogroup(replies.groupBy("bucket")).applyInArrow(send, _RANGE_DDL), 0, width, window)
    out, depth = found, width
    while not (opened := found.filter("part IS NOT NULL").select("bucket", "part", "facts")).isEmpty():
        told = replies.unionByName(opened, allowMissingColumns=True)
        found = grown(by_bucket.cogroup(told.groupBy("bucket")).applyInArrow(send_on(depth, depth), _RANGE_DDL), depth, depth, 0)
        out, depth = out.unionByName(found), 2 * depth
    return out.filter("part IS NULL").select(F.nullif("key", F.lit(_LAST)).alias(key), "start", "n_words", "n_occurrences")

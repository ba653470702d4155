"""Line dedup by a log-template tree.

A line's tokens that hold a digit are variable fields. The tree has a fixed depth: a line
descends by its number of tokens, then by its first LEADING tokens, to a leaf. What follows the
leading tokens is cut into SEGMENTS runs of nearly equal length, and below the leaf stand the
templates: the line itself, and the line with one or two of its runs generalised to variable
fields, as long as the share ``similarity`` of its tokens at least stays as it is. So a line has 37
templates at most, lines that agree but for such fields share one, and which templates there are
depends on the line alone: neither on the size of a leaf nor on the order of lines.

A template's carriers are the distinct documents that hold a line of it. Templates of
``least_carriers`` or more are recurring; a line is dropped from every document that isn't the
first carrier, that of smallest id, of each recurring template of the line.

Counting is a partial aggregate. Documents are dealt to buckets once; a bucket sends every
template as one entry (its documents here, and the smallest id among them), so a template that
all documents share costs a bucket one entry, and gets a byte back for each. Before that, the
same is done with four quarters of every line: a template whose untouched quarters aren't all
held by ``least_carriers`` documents can't recur and isn't sent.

Lines of fewer than ``least_tokens`` tokens, lines without words and templates without a fixed
token never recur. A null text stays null. A text that has lost all its lines is empty. Very long
texts are read whole; rows that repeat an id, or lack one, count as documents of their own (a null id
comes last); an empty table gives no rows; extra columns are ignored, or carried as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import arrow_rows, batch, table
from .wordcodes import MIX, Words, mix, tables

#: Leading tokens that lead to a leaf, and the runs into which the others are cut.
LEADING, SEGMENTS = 3, 8
#: The runs that a template generalises.
MASKS = [(), *combinations(range(SEGMENTS), 1), *combinations(range(SEGMENTS), 2)]
_STAR = 0x5851F42D4C957F2D
_LAST = np.iinfo(np.int64).max


class Lines:
    """The lines of a bucket's texts, an entry a distinct line."""

    def __init__(self, texts: pa.Table, least_tokens: int, similarity: float):
        raw, keys = texts["text"].to_pylist(), texts["key"].fill_null(_LAST).to_numpy()
        self.order = sorted(range(len(raw)), key=lambda i: (keys[i], raw[i]))  # the same in every pass
        self.keys, self.similarity = keys[self.order], similarity
        self.lines = [raw[i].encode().split(b"\n") for i in self.order]
        self.base = np.concatenate([[0], np.cumsum([len(x) for x in self.lines])]).astype(np.int64)
        codes, counts, _ = Words(_STAR).codes([line for x in self.lines for line in x])
        doc = np.repeat(np.arange(len(raw)), np.diff(self.base))
        ends = np.cumsum(counts)
        self.at = np.flatnonzero(counts >= max(least_tokens, 1))  # the lines that count
        self.doc = doc[self.at]
        n, first = counts[self.at], (ends - counts)[self.at]
        place = np.arange(len(codes)) - np.repeat(ends - counts, counts)
        zero = np.zeros(1, np.uint64)
        self.sums = np.concatenate([zero, np.cumsum(codes * (mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)))])
        self.fixed = np.concatenate([[0], np.cumsum(codes != _STAR)])
        whole = mix(self.sums[first + n] - self.sums[first] + mix(n.astype(np.uint64)))
        _, head, self.entry = np.unique(whole, return_index=True, return_inverse=True)
        self.n, self.first = n[head], first[head]
        # (entry, document) pairs: what carries a line
        pairs = np.unique(self.entry * (len(raw) + 1) + self.doc)
        self.held, self.by = pairs // (len(raw) + 1), pairs % (len(raw) + 1)
        self.many = np.bincount(self.held, minlength=len(self.n))
        self.start = np.concatenate([[0], np.cumsum(self.many)]).astype(np.int64)
        lead = np.minimum(self.n, LEADING)
        self.leaf = mix(self.sums[self.first + lead] - self.sums[self.first] + mix(self.n.astype(np.uint64) + np.uint64(1 << 40)))
        self.cuts = self.first[:, None] + lead[:, None] + (self.n - lead)[:, None] * np.arange(SEGMENTS + 1) // SEGMENTS

    def quarters(self) -> np.ndarray:
        """Four codes an entry: of its leaf and two runs each."""
        x = self.sums[self.cuts[:, 2::2]] - self.sums[self.cuts[:, :-2:2]]
        return mix(self.leaf[:, None] + x * MIX[3, :4] + np.arange(4, dtype=np.uint64))

    def templates(self, often: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries, codes) of the templates of all entries whose untouched quarters are often held."""
        runs = self.sums[self.cuts[:, 1:]] - self.sums[self.cuts[:, :-1]]
        size = np.diff(self.cuts, axis=1)
        fixed = np.diff(self.fixed[self.cuts], axis=1)
        whole = self.sums[self.cuts[:, -1]] - self.sums[self.cuts[:, 0]]
        plain = self.fixed[self.first + self.n] - self.fixed[self.first]
        entries, codes = [], []
        for k, mask in enumerate(MASKS):
            m = list(mask)
            least = [q for q in range(4) if not {2 * q, 2 * q + 1} & set(m)]
            ok = often[:, least].all(axis=1) & (size[:, m] > 0).all(axis=1) & (size[:, m].sum(axis=1) <= (1 - self.similarity) * self.n + 1e-9)
            at = np.flatnonzero(ok & (plain - fixed[:, m].sum(axis=1) > 0))
            if len(at):
                entries.append(at)
                codes.append(mix(self.leaf[at] + (whole[at] - runs[at][:, m].sum(axis=1, dtype=np.uint64)) * MIX[3, 8] + MIX[2, k]))
        none = np.zeros(0, np.int64)
        return np.concatenate(entries or [none]), np.concatenate(codes or [none.astype(np.uint64)])

    def counted(self, entries: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct codes, their distinct documents here, the least id, and each row's place among them."""
        code, of = np.unique(codes, return_inverse=True)
        rows = np.repeat(np.arange(len(entries)), self.many[entries])
        places = np.repeat(self.start[entries] - np.concatenate([[0], np.cumsum(self.many[entries])[:-1]]), self.many[entries]) + np.arange(len(rows)) if len(rows) else rows
        by = self.by[places]
        pairs = np.unique(of[rows] * (len(self.keys) + 1) + by)
        carriers = np.bincount(pairs // (len(self.keys) + 1), minlength=len(code))
        least = np.full(len(code), _LAST)
        np.minimum.at(least, of[rows], self.keys[by])
        return code, carriers, least, of


def _by_part(code: np.ndarray, parts: int) -> Iterator[tuple[int, np.ndarray]]:
    """Entries by part, each in rising order."""
    part = (code % np.uint64(parts)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    for g in np.split(order, np.flatnonzero(np.diff(part[order])) + 1) if len(order) else ():
        yield int(part[g[0]]), g


_SENT = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("code", pa.binary()), ("carriers", pa.binary()), ("least", pa.binary())])
_SENT_DDL = "part int, bucket int, code binary, carriers binary, least binary"
_REPLY = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("said", pa.binary())])
_REPLY_DDL = "bucket int, kind int, part int, said binary"


def _said(replies: pa.Table, kind: int) -> dict[int, np.ndarray]:
    return {p: np.frombuffer(s, np.uint8) for k, p, s in zip(*(replies[c].to_pylist() for c in ("kind", "part", "said"))) if k == kind}


def _joined(t: pa.Table, column: str, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(t[column].to_pylist()), kind)


def drop_templates(docs: DataFrame, key: str, text: str, least_carriers: int = 5, similarity: float = 0.7, least_tokens: int = 3, bucket_bytes: int = 4 << 20, carry: bool = False, keep_emptied: bool = True) -> DataFrame:
    """key, text without the lines of recurring templates, n_lines, n_dropped of every row;
    with ``carry``, all other columns too (then without the two counts). Without
    ``keep_emptied``, rows whose every word stood in dropped lines go."""
    spark = docs.sparkSession
    arrow_rows(spark)
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, parts = max(shuffles, -(-total // bucket_bytes)), max(shuffles, -(-total // (64 << 20)))
    others = [c for c in docs.columns if c.lower() not in (key.lower(), text.lower())] if carry else []
    source = docs.select(
        F.pmod(F.when(F.col(key).isNull(), F.xxhash64(F.col(text))).otherwise(F.xxhash64(F.col(key).cast("long"))), F.lit(buckets)).cast("int").alias("bucket"), F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.col(text).isNull().alias("none"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)),
    )
    by_bucket = source.groupBy("bucket")

    def send(bucket: int, code: np.ndarray, carriers: np.ndarray, least: np.ndarray) -> pa.Table:
        rows = [(p, bucket, code[g].astype("<u8").tobytes(), carriers[g].astype("<u4").tobytes(), least[g].astype("<i8").tobytes()) for p, g in _by_part(code, parts)]
        return pa.Table.from_batches([batch(_SENT, [list(c) for c in zip(*rows)])]) if rows else _SENT.empty_table()

    def answered(code: np.ndarray, said: dict[int, np.ndarray]) -> np.ndarray:
        """What was said of each of the codes sent; 0 where nothing."""
        out = np.zeros(len(code), np.uint8)
        for p, g in _by_part(code, parts):
            if p in said:
                out[g] = said[p]
        return out

    def quarters(left: pa.Table) -> pa.Table:
        u = Lines(left, least_tokens, similarity)
        code, carriers, least, _ = u.counted(np.repeat(np.arange(len(u.n)), 4), u.quarters().ravel())
        return send(left["bucket"][0].as_py(), code, carriers, least)

    def often(u: Lines, replies: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        codes = u.quarters().ravel()
        code, of = np.unique(codes, return_inverse=True)
        return u.templates((answered(code, _said(replies, 0)) > 0)[of].reshape(-1, 4))

    def templates(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _SENT.empty_table()
        u = Lines(left, least_tokens, similarity)
        code, carriers, least, _ = u.counted(*often(u, right))
        return send(left["bucket"][0].as_py(), code, carriers, least)

    def weigh(kind: int):
        """Per code: 0 where it is too rare, 2 to the bucket of its least id, 1 to the others."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in tables(batches, "part"):
                code, carriers, least = (_joined(t, c, k) for c, k in (("code", "<u8"), ("carriers", "<u4"), ("least", "<i8")))
                _, of = np.unique(code, return_inverse=True)
                recurring = np.bincount(of, carriers)[of] >= least_carriers
                first = np.full(len(of), _LAST)
                np.minimum.at(first, of, least)
                said = np.where(recurring, np.where(least == first[of], 2, 1), 0).astype(np.uint8)
                part, at = t["part"][0].as_py(), 0
                for b, x in zip(t["bucket"].to_pylist(), t["carriers"].to_pylist()):
                    m = len(x) // 4
                    if said[at : at + m].any():
                        yield batch(_REPLY, [[b], [kind], [part], [said[at : at + m].tobytes()]])
                    at += m

        return run

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        said = _said(right, 1)
        if said:
            u = Lines(left, least_tokens, similarity)
            entries, codes = often(u, right)
            code, _, least, of = u.counted(entries, codes)
            told = answered(code, said)
            later = np.zeros(len(u.n), bool)  # not the first carrier's, whatever the document
            later[entries[told[of] == 1]] = True
            first = np.full(len(u.n), _LAST)  # the first carrier of all templates that start here
            mine = told[of] == 2
            np.minimum.at(first, entries[mine], least[of[mine]])
            some = np.zeros(len(u.n), bool)
            some[entries[mine]] = True
            gone = np.zeros(u.base[-1], bool)
            gone[u.at] = later[u.entry] | (some[u.entry] & (u.keys[u.doc] != first[u.entry]))
            texts, dropped = [], []
            for i, x in enumerate(u.lines):
                drop = gone[u.base[i] : u.base[i + 1]]
                dropped.append(int(drop.sum()))
                texts.append(b"\n".join(y for y, d in zip(x, drop.tolist()) if not d).decode() if dropped[-1] else b"\n".join(x).decode())
            left = left.take(u.order)
            counts = np.diff(u.base)
        else:
            texts = left["text"].to_pylist()
            dropped, counts = [0] * len(texts), [x.count("\n") + 1 for x in texts]
        text_ = pa.array([None if none else x for x, none in zip(texts, left["none"].to_pylist())], pa.string())
        carried = [(f"c{i}", left[f"c{i}"]) for i in range(len(others))]
        out = pa.table({"key": left["key"], "text": text_, "n_lines": pa.array(counts, pa.int64()), "n_dropped": pa.array(dropped, pa.int64()), **dict(carried)})
        return out if keep_emptied else out.filter(pa.array([not d or bool(x.encode().split()) for x, d in zip(texts, dropped)]))

    def told(sent: DataFrame, kind: int) -> DataFrame:
        return sent.repartition("part").sortWithinPartitions("part", "bucket").mapInArrow(weigh(kind), _REPLY_DDL)

    quarter_replies = told(by_bucket.applyInArrow(quarters, _SENT_DDL), 0)
    replies = told(by_bucket.cogroup(quarter_replies.groupBy("bucket")).applyInArrow(templates, _SENT_DDL), 1)
    fields = [T.StructField("key", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]
    fields += [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(others)]
    done = by_bucket.cogroup(quarter_replies.unionByName(replies).groupBy("bucket")).applyInArrow(finish, T.StructType(fields))
    if not carry:
        return done.select(F.col("key").alias(key), F.col("text").alias(text), "n_lines", "n_dropped")
    back = {c: f"c{i}" for i, c in enumerate(others)} | {key: "key", text: "text"}
    return done.select(*(F.col(back.get(c, "key" if c.lower() == key.lower() else "text")).alias(c) for c in docs.columns))


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without its recurring template lines."""
    return drop_templates(table(spark, sf_dir, "documents"), "doc_id", "text")

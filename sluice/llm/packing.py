"""Packing into training sequences: bounded-space online packing.

Each partition keeps at most ``open_windows`` open windows. A document is cut into
whole windows and a rest; the rest goes to the open window it fits best. When it fits
none and all windows are open, the fullest is emitted, first topped up with the start
of the rest if its gap is worth a cut; so padding stays small and memory bounded.
What is left open in each partition is merged at last, window by window, best fit
decreasing, up a tree of fixed fan-in: each node passes on ``open_windows`` windows at
most, so no task's input grows with the corpus. Only lengths travel up the tree.

A null text packs as an empty one: its end id alone. Texts of any length are taken
whole. Equal documents are packed as often as they come; extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import arrow_rows, batch, spool, table
from .token_count import vocabulary

FAN_IN = 16


class Packer:
    """Open windows of one partition. ``cuts`` gives, for a document of n tokens, its
    pieces as (start, length, sequence, offset)."""

    def __init__(self, window: int, open_windows: int, least_cut: int, first: int):
        self.window, self.most, self.least_cut, self.next = window, open_windows, least_cut, first
        self.rooms: list[tuple[int, int]] = []  # (room, sequence) of the open windows, tightest first

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def cuts(self, n: int) -> list[tuple[int, int, int, int]]:
        out, at = [], 0
        while n - at >= self.window:
            out.append((at, self.window, self._new(), 0))
            at += self.window
        while at < n:
            left = n - at
            k = bisect_left(self.rooms, (left, -1))
            if k < len(self.rooms):
                room, seq = self.rooms.pop(k)
            elif len(self.rooms) < self.most:
                room, seq = self.window, self._new()
            else:
                room, seq = self.rooms.pop(0)  # the fullest leaves, topped up or as it is
                if room >= self.least_cut:
                    out.append((at, room, seq, self.window - room))
                    at += room
                continue
            out.append((at, left, seq, self.window - room))
            at = n
            if room > left:
                insort(self.rooms, (room - left, seq))
        return out


def _merge_node(window: int, keep: int):
    """Best-fit decreasing over whole windows; all but the ``keep`` emptiest are done."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rooms: list[tuple[int, int]] = []
        fill: dict[int, int] = {}
        rows = []
        for used, seq in sorted(zip(pdf["fill"], pdf["seq"]), key=lambda x: (-x[0], x[1])):
            k = bisect_left(rooms, (used, -1))
            if k < len(rooms):
                room, into = rooms.pop(k)
                rows.append((seq, into, fill[into]))
                fill[into] += used
            else:
                room, into = window, seq
                rows.append((seq, seq, 0))
                fill[seq] = used
            if room > used:
                insort(rooms, (room - used, into))
        on = {s for _, s in sorted((-room, s) for room, s in rooms)[:keep]}
        node = int(pdf["node"].iloc[0]) // FAN_IN
        return pd.DataFrame([(s, i, b, fill[i], i == s and i in on, node) for s, i, b in rows], columns=["seq", "into", "base", "fill", "goes_on", "node"])

    return run


def merge_leftovers(leftovers: DataFrame, window: int, keep: int) -> DataFrame | None:
    """seq -> (into, base) for windows (seq, fill, node) of the partitions numbered ``node``."""
    top = leftovers.agg(F.max("node")).first()[0]
    if top is None:
        return None
    moves, level = None, leftovers
    while True:
        parts = level.withColumn("_group", F.floor(F.col("node") / FAN_IN))
        merged = spool(parts.groupBy("_group").applyInPandas(_merge_node(window, keep), "seq long, into long, base long, fill long, goes_on boolean, node long"), "merged")
        step = merged.select("seq", "into", "base")
        if moves is None:
            moves = step
        else:
            onward = step.select(F.col("seq").alias("_s"), F.col("into").alias("_i"), F.col("base").alias("_b"))
            moves = moves.join(onward, F.col("into") == F.col("_s"), "left").select("seq", F.coalesce("_i", "into").alias("into"), (F.col("base") + F.coalesce("_b", F.lit(0))).alias("base"))
        top //= FAN_IN
        if top == 0:
            return moves
        level = merged.filter("goes_on").select("seq", "fill", "node")


def pack_documents(docs: DataFrame, key: str, text: str, path: str | None = None, window: int = 1024, end_id: int = 0, open_windows: int = 16, least_cut: int = 16) -> DataFrame:
    """Every piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    arrow_rows(docs.sparkSession)
    path = path or vocabulary()
    odd = bpe.odd_characters(path)
    end = int(end_id).to_bytes(4, "little")
    fields = [("key", "long"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("doc_tokens", "long"), ("seq", "long"), ("offset", "long"), ("node", "long"), ("fill", "long")]
    schema = pa.schema([(n, pa.int64()) for n, _ in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, node = bpe.encoder(path, odd), TaskContext.get().partitionId()
        packer = Packer(window, open_windows, least_cut, node << 32)
        for b in batches:
            cols: list[list] = [[] for _ in range(7)]
            for doc, value in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.ids(value.as_py()) + end
                n = len(ids) // 4
                for start, length, seq, offset in packer.cuts(n):
                    for col, x in zip(cols, (doc, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)]), n, seq, offset)):
                        col.append(x)
            size = len(cols[0])
            yield batch(schema, [*cols, pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64())])
        if packer.rooms:  # a row for each window left open, after the pieces
            left = len(packer.rooms)
            none = pa.nulls(left, pa.int64())
            yield batch(schema, [none] * 5 + [[s for _, s in packer.rooms], none, [node] * left, [window - r for r, _ in packer.rooms]])

    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = spool(source.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in fields)), "pieces")
    pieces = rows.filter("node is null").drop("node", "fill")
    moves = merge_leftovers(rows.filter("node is not null").select("seq", "fill", "node"), window, open_windows)
    if moves is not None:
        pieces = pieces.join(moves, "seq", "left").withColumn("offset", F.col("offset") + F.coalesce("base", F.lit(0))).withColumn("seq", F.coalesce("into", "seq"))
    return pieces.select(F.col("key").alias(key), "start", "length", "ids_crc32", "doc_tokens", F.col("seq").alias("sequence_id"), "offset")


def op6_packing(spark, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text")

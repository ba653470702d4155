"""Conversation prefix trie: a Cartesian tree over the LCP array of the sorted conversations.

Conversations become rows of turn digests (16 bytes a turn; texts stay where they are read).
Equal sequences are one entry, and the distinct ones are sorted over ranges of a shuffle; each
range is a block. Between neighbours stands the length of their common prefix (LCP). Every
node of the trie at which paths part is an interval of that array between nearest smaller
values; those whose two bounds lie in their block come from one pass with a stack. For the
rest, each block passes on its staircases, the running minima from its left and right end
(at most two entries a depth), and the minima of whole blocks say in which block the nearest
smaller value of an entry lies. Entries of equal LCP with one left bound are one node. Depths
at which paths don't part have the members of the next node below and are filled in from its
upper to its lower end. All aggregates are differences of running sums over the sorted entries,
and minima over intervals.

What the driver holds: a few numbers a block. What a task holds: one block's numbers, or a piece
of the ids that end in one node. Ids that share a sequence are hashed as a stream, in pieces of
``PIECE`` of them made in parallel.

Rows without conv_id belong to no conversation and are left out. Null role or text is empty, a
null turn sorts first, equal turns by the digest of role and text. Repeated rows are turns of
their own. Extra columns are ignored. An empty table gives no rows, not even the root, as
it would have no member. A single conversation's digests are one row, however long it is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_PATTERN, batch, spool, table, whole_groups

#: Ids whose decimal text one row carries on the way to the hash of a node.
PIECE = 5_000
_EMPTY = hashlib.sha256(b"").digest()
_NONE = np.iinfo(np.int64).max
NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODES = pa.schema([*((c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")), ("ends_sha256", pa.string())])
#: Running sums: members, leaves, words of all members, new words of each entry, words of each entry.
SUMS = ("members", "leaves", "all_words", "new_words", "words")
_ENTRY = "block long, i long, lcp long, len long, members long, least long, ends binary, path array<long>, seq array<binary>"
_STAIR = "block long, side string, value long, pos long, equal long, path array<long>, members long, leaves long, all_words long, new_words long, words long, own_new long, own_words long, len long, ends binary, least long"


def sequences(conversations: DataFrame, shared: int = 3, every: int = 20) -> DataFrame:
    """conv_id, seq (turn digests), path (words up to each turn) of the rebuilt conversations: the
    first crc32(id) % (shared + 1) turns of the conversation whose id is the next lower multiple of
    ``every``, then the own turns after as many."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"), F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("id"), F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    ).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)
    whole = turns.groupBy("base", "conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "id", "words"))).alias("t"))
    lead = whole.filter("conv_id = base").select("base", F.slice("t", 1, shared).alias("lead"))
    own = whole.join(lead, "base", "left").withColumn("h", (F.crc32(F.col("conv_id").cast("string")) % (shared + 1)).cast("int"))
    rebuilt = own.withColumn("t", F.expr("concat(slice(coalesce(lead, slice(t, 1, 0)), 1, h), slice(t, h + 1, size(t)))"))
    path = F.expr("transform(t, x -> x.words)")
    return rebuilt.select("conv_id", F.transform("t", lambda x: x["id"]).alias("seq"), path.alias("counts"))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, id) become texts of up to PIECE ids."""
    schema = pa.schema([("key", pa.string()), ("least", pa.int64()), ("ids", pa.string())])
    key, ids = None, []
    for b in batches:
        out = []
        for k, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            if ids and (k != key or len(ids) == PIECE):
                out.append((key, ids[0], ",".join(map(str, ids))))
                ids = []
            key = k
            ids.append(i)
        if out:
            yield batch(schema, [list(c) for c in zip(*out)])
    if ids:
        yield batch(schema, [[key], [ids[0]], [",".join(map(str, ids))]])


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash a key, of its pieces in their order."""
    schema = pa.schema([("key", pa.string()), ("ends", pa.binary())])
    key, digest = None, None
    for b in batches:
        out = []
        for k, piece in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
            if k != key:
                if digest is not None:
                    out.append((key, digest.digest()))
                key, digest = k, hashlib.sha256(piece.encode())
            else:
                digest.update(b"," + piece.encode())
        if out:
            yield batch(schema, [list(c) for c in zip(*out)])
    if digest is not None:
        yield batch(schema, [[key], [digest.digest()]])


def _common(a: list, b: list) -> int:
    n = min(len(a), len(b))
    return next((k for k in range(n) if a[k] != b[k]), n)


_ENTRY_ARROW = pa.schema([("block", pa.int64()), ("i", pa.int64()), ("lcp", pa.int64()), ("len", pa.int64()), ("members", pa.int64()), ("least", pa.int64()), ("ends", pa.binary()), ("path", pa.list_(pa.int64())), ("seq", pa.list_(pa.binary()))])


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (seq, counts, members, least, ends): places in the block and LCPs within it. Only
    the ends of a block keep their sequences."""
    block, i, before, held = TaskContext.get().partitionId(), 0, None, None
    for b in batches:
        out = [] if held is None else [held]
        for seq, counts, members, least, ends in zip(*(c.to_pylist() for c in b.columns)):
            lcp = None if before is None else _common(before, seq)
            out.append((block, i, lcp, len(seq), members, least, ends, np.cumsum(counts, dtype=np.int64), None if i else seq))
            before, i = seq, i + 1
        if out:
            held = out.pop()
        if out:
            yield batch(_ENTRY_ARROW, [list(c) for c in zip(*out)])
    if held is not None:
        yield batch(_ENTRY_ARROW, [[x] for x in (*held[:-1], before)])


class _Block:
    """The numbers of one block's entries, sorted."""

    def __init__(self, t: pa.Table, borders: dict[int, tuple[int, int]]):
        t = t.combine_chunks()
        self.number = t["block"][0].as_py()
        first, self.after = borders[self.number]
        n = self.n = t.num_rows
        self.lcp = t["lcp"].fill_null(first).to_numpy().copy()
        self.len, members, self.least = (t[c].to_numpy() for c in ("len", "members", "least"))
        self.ends = t["ends"]
        lists = t["path"].chunk(0) if t["path"].num_chunks else pa.array([], pa.list_(pa.int64()))
        self.offsets, self.flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        total = np.where(self.len > 0, self.flat[np.maximum(self.offsets[1:] - 1, 0)] if len(self.flat) else 0, 0)
        new = total - np.array([self.upto(k, max(v, 0)) for k, v in enumerate(self.lcp)], np.int64)
        self.next = np.append(self.lcp[1:], self.after)
        leaves = (self.next < self.len).astype(np.int64)
        rows = np.stack([members, leaves, members * total, new, total])
        self.sums = np.concatenate([np.zeros((5, 1), np.int64), np.cumsum(rows, axis=1)], axis=1)

    def upto(self, k: int, depth: int) -> int:
        """Words of the first turns of entry k."""
        return int(self.flat[self.offsets[k] + depth - 1]) if depth > 0 else 0

    def path(self, k: int, depth: int) -> np.ndarray:
        """Words above each depth 0 .. depth: of the first max(depth - 1, 0) turns."""
        return np.concatenate([[0, 0], self.flat[self.offsets[k] : self.offsets[k] + max(depth - 1, 0)]])[: depth + 1]

    def stairs(self) -> Iterator[tuple]:
        """The running minima from the right and from the left: (side, value, place, how many equal)."""
        for side, order in (("R", range(self.n - 1, -1, -1)), ("L", range(self.n))):
            at = None
            for k in order:
                v = self.lcp[k]
                if at is None or v < at[0]:
                    if at:
                        yield (side, *at)
                    at = [v, k, 1]
                elif v == at[0]:
                    at[2] += 1
            yield (side, *at)


def _blocks(batches):
    for t, group in whole_groups(batches, ("block",)):
        cut = [*np.flatnonzero(np.diff(group, prepend=group[0] - 1)), len(group)]
        for start, end in zip(cut, cut[1:]):
            yield t.slice(start, end - start)


def _staircases(borders):
    """Each block's staircases, and a row of side '' with its minimum and sums."""
    fields = pa.schema([("block", pa.int64()), ("side", pa.string()), ("value", pa.int64()), ("pos", pa.int64()), ("equal", pa.int64()), ("path", pa.list_(pa.int64())), *((c, pa.int64()) for c in SUMS), ("own_new", pa.int64()), ("own_words", pa.int64()), ("len", pa.int64()), ("ends", pa.binary()), ("least", pa.int64())])

    def run(batches):
        for t in _blocks(batches):
            b = _Block(t, borders)
            low = int(b.lcp.min())
            tail, head = np.minimum.accumulate(b.least[::-1])[::-1], np.append(_NONE, np.minimum.accumulate(b.least))
            rows = [(b.number, "", low, b.n, 0, None, *b.sums[:, -1], 0, 0, 0, None, tail[0])]
            for side, value, pos, equal in b.stairs():
                if side == "R" and value == low:
                    equal = 0  # the left staircase counts those
                own = b.sums[:, pos + 1] - b.sums[:, pos]
                rows.append((b.number, side, value, pos, equal, b.path(pos, max(int(value), 0)), *b.sums[:, pos], own[3], own[4], b.len[pos], b.ends[int(pos)].as_py(), tail[pos] if side == "R" else head[pos]))
            yield batch(fields, [list(c) for c in zip(*rows)])

    return run


class _Minima:
    """Minima over ranges of a list, by a table of powers of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values, np.int64)]
        while len(a := self.levels[-1]) > (half := 1 << (len(self.levels) - 1)):
            self.levels.append(np.minimum(a[:-half], a[half:]))

    def over(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The least of values[start:end]; _NONE where that is empty."""
        size = end - start
        out = np.full(len(size), _NONE, np.int64)
        level = np.where(size > 0, np.log2(np.maximum(size, 1)).astype(np.int64), -1)
        for k in np.unique(level[level >= 0]):
            at = level == k
            out[at] = np.minimum(self.levels[k][start[at]], self.levels[k][end[at] - (1 << k)])
        return out

    def before(self, at: int, value: int) -> int:
        """The last place before ``at`` with a smaller value, or -1."""
        for k in range(len(self.levels) - 1, -1, -1):
            if at >= 1 << k and self.levels[k][at - (1 << k)] >= value:
                at -= 1 << k
        return at - 1

    def after(self, at: int, value: int) -> int:
        """The first place from ``at`` on with a smaller value, or the number of values."""
        n = len(self.levels[0])
        for k in range(len(self.levels) - 1, -1, -1):
            if at + (1 << k) <= n and self.levels[k][at] >= value:
                at += 1 << k
        return at


def _nodes_within(borders):
    """The nodes whose interval lies in their block, all depths filled in. Rows of kind 0 hold the
    ids of nodes across blocks: (side, value) of the block's own staircases, 'N' of the next block's first."""

    def run(batches):
        for t in _blocks(batches):
            kind = t["kind"].to_numpy()
            start = int(np.searchsorted(kind, 1))
            across = {(s, v): (c, p) for s, v, c, p in zip(*(t.slice(0, start)[c].to_pylist() for c in ("side", "value", "conv", "i")))}
            b = _Block(t.slice(start), borders)
            n, lcp = b.n, b.lcp
            left, right, equal, owner, last = np.full(n, -1), np.full(n, n), np.ones(n, np.int64), np.arange(n), np.arange(n)
            stack: list[int] = []
            for i in range(n):
                v = lcp[i]
                while stack and lcp[stack[-1]] > v:
                    right[stack.pop()] = i
                if stack and lcp[stack[-1]] == v:
                    h = stack[-1]
                    owner[i], last[h] = h, i
                    equal[h] += 1
                else:
                    if stack:
                        left[i] = last[stack[-1]]
                    stack.append(i)
            minima = _Minima(b.least)
            inner = np.flatnonzero((owner == np.arange(n)) & (left >= 0) & (right < n))
            conv = np.full(n, -1, np.int64)
            conv[inner] = minima.over(left[inner], right[inner])
            is_inner = np.zeros(n, bool)
            is_inner[inner] = True

            def id_of(q: int) -> int:
                if q == n:
                    return across["N", b.after][0]
                h = owner[q]
                return int(conv[h]) if is_inner[h] else across["L" if left[h] < 0 else "R", int(lcp[h])][0]

            leaf = np.flatnonzero(b.len > b.next)
            jobs = [(int(left[h]), int(right[h]), int(lcp[h]), int(equal[h]), int(conv[h])) for h in inner] + [(int(i), int(i) + 1, int(b.len[i]), -1, int(b.least[i])) for i in leaf]
            rows: list[tuple] = []
            for l, r, depth, parts, who in jobs:
                at_right = b.after if r == n else int(lcp[r])
                low = max(int(lcp[l]), at_right) + 1
                parent = None if low == 0 else id_of(l if lcp[l] >= at_right else r)
                s = b.sums[:, r] - b.sums[:, l]
                ends = b.ends[l].as_py() if b.len[l] == depth else _EMPTY
                rows.extend(_filled(b.path(l, depth)[low:], low, depth, parent, who, 0 if parts < 0 else parts + int(b.len[l] > depth), int(s[0]), int(s[1]), int(s[2]), int(s[3] - (b.sums[3, l + 1] - b.sums[3, l])), int(b.sums[4, l + 1] - b.sums[4, l]), ends))
                if len(rows) > 50_000:
                    yield batch(_NODES, [list(c) for c in zip(*rows)])
                    rows = []
            if rows:
                yield batch(_NODES, [list(c) for c in zip(*rows)])

    return run


def _filled(above, low, depth, parent, who, children, members, leaves, all_words, later_new, first_words, ends):
    """A node and the depths over it that have its members: what a depth saves is the words of all
    its members from there on, less those of each distinct turn from there on."""
    for k, d in enumerate(range(low, depth + 1)):
        w = int(above[k])
        saved = all_words - members * w - later_new - (first_words - w)
        yield who, d, parent if d == low else who, members, children if d == depth else 1, leaves, saved, (ends if d == depth else _EMPTY).hex()


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """A row a node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = conversations.sparkSession
    whole = spool(sequences(conversations).withColumn("key", F.md5(F.array_join(F.transform("seq", F.hex), ""))), "conversations")
    pieces = whole.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(_pieces, "key string, least long, ids string")
    ends = pieces.repartition("key").sortWithinPartitions("key", "least").mapInArrow(_hashes, "key string, ends binary")
    distinct = whole.groupBy("key", "seq", "counts").agg(F.count("*").alias("members"), F.min("conv_id").alias("least"))
    distinct = spool(distinct.join(ends, "key").select("seq", "counts", "members", "least", "ends"), "sequences")
    raw = spool(distinct.repartitionByRange("seq").sortWithinPartitions("seq").mapInArrow(_entries, _ENTRY), "entries")

    parts = sorted(r["block"] for r in raw.select("block").distinct().collect())  # a number a block
    if not parts:
        return spark.createDataFrame([], NODES)
    numbers = spark.createDataFrame([(p, k) for k, p in enumerate(parts)], "block long, number long")
    entries = raw.join(F.broadcast(numbers), "block").drop("block").withColumnRenamed("number", "block")
    edges = entries.filter("seq IS NOT NULL").groupBy("block").agg(F.min_by("seq", "i").alias("first"), F.max_by("seq", "i").alias("final"))
    met = edges.select((F.col("block") + 1).alias("block"), "final").join(edges.select("block", "first"), "block")
    met = met.select("block", F.expr("array_position(zip_with(final, first, (a, b) -> NOT (a <=> b)), true) - 1").alias("lcp"))
    between = {r["block"]: r["lcp"] for r in met.collect()}
    borders = {k: (between.get(k, -1), between.get(k + 1, -1)) for k in range(len(parts))}

    light = entries.drop("seq")
    stairs = spool(light.repartition("block").sortWithinPartitions("block", "i").mapInArrow(_staircases(borders), _STAIR), "stairs")
    blocks = sorted(stairs.filter("side = ''").select("block", "value", "least", *SUMS).collect())
    low, least = _Minima(np.array([r["value"] for r in blocks])), _Minima(np.array([r["least"] for r in blocks]))
    before = np.concatenate([np.zeros((1, 5), np.int64), np.cumsum([[r[c] for c in SUMS] for r in blocks], axis=0)])

    across = _nodes_across(stairs.filter("side <> ''"), low, least, before)
    across = spool(across, "across")
    lookups = across.select("block", "side", "value", "pos", "conv")
    ids = lookups.select("block", "side", "value", "conv").unionByName(lookups.filter("side = 'L' AND pos = 0 AND block > 0").select(F.col("block") - 1, F.lit("N"), "value", "conv").toDF("block", "side", "value", "conv"))
    rows = light.withColumn("kind", F.lit(1)).unionByName(ids.withColumn("kind", F.lit(0)), allowMissingColumns=True)
    rows = rows.select("block", "kind", "side", "value", "conv", "i", "lcp", "len", "members", "least", "ends", "path")
    within = rows.repartition("block").sortWithinPartitions("block", "kind", "i").mapInArrow(_nodes_within(borders), NODES)
    return within.unionByName(_across_filled(across))


def _nodes_across(stairs: DataFrame, low: _Minima, least: _Minima, before: np.ndarray) -> DataFrame:
    """Every entry of the staircases with the node it belongs to: bounds, members and the rest."""
    n = len(before) - 1

    @F.pandas_udf("long")
    def left_block(block, side, value):
        import pandas as pd

        return pd.Series([b if s == "R" and v > low.levels[0][b] else low.before(b, v) for b, s, v in zip(block, side, value)], dtype="int64")

    @F.pandas_udf("long")
    def right_block(block, side, value):
        import pandas as pd

        return pd.Series([b if s == "L" and v > low.levels[0][b] else low.after(b + 1, v) for b, s, v in zip(block, side, value)], dtype="int64")

    @F.pandas_udf("long")
    def least_between(start, end):
        import pandas as pd

        return pd.Series(least.over(start.to_numpy(), end.to_numpy()))

    asks = stairs.filter("value >= 0").withColumn("lb", left_block("block", "side", "value")).withColumn("rb", right_block("block", "side", "value"))
    sums = _before(stairs.sparkSession, before)
    known = stairs.join(sums, "block").select("block", "side", "value", "pos", *((F.col(c) + F.col(f"before_{c}")).alias(c) for c in SUMS), "own_new", "own_words", "len", "ends", "least")
    left = _nearest(asks.select("block", "side", "value", F.col("lb").alias("target")), known.filter("side = 'R'"), "l")
    right = _nearest(asks.filter(F.col("rb") < n).select("block", "side", "value", F.col("rb").alias("target")), known.filter("side = 'L'"), "r")
    whole = asks.select("block", "side", "value", "pos", "equal", "path", "lb", "rb").join(left, ["block", "side", "value"]).join(right, ["block", "side", "value"], "left")
    total = [int(x) for x in before[-1]]
    whole = whole.select(
        "block", "side", "value", "pos", "equal", "path", "lb", "rb", F.col("l.pos").alias("lpos"), F.col("l.value").alias("lvalue"), F.coalesce("r.value", F.lit(-1)).alias("rvalue"), F.col("l.len").alias("len"), F.col("l.ends").alias("ends"), F.col("l.own_words").alias("first_words"),
        *((F.coalesce(f"r.{c}", F.lit(t)) - F.col(f"l.{c}")).alias(c) for c, t in zip(SUMS, total)), F.col("l.own_new").alias("own_new"),
        F.least("l.least", F.coalesce("r.least", F.lit(int(_NONE))), least_between(F.col("lb") + 1, F.col("rb"))).alias("conv"),
    )
    return whole.withColumn("parts", F.sum("equal").over(Window.partitionBy("lb", "lpos", "value")))


def _before(spark, before: np.ndarray) -> DataFrame:
    """The sums of all blocks before each: a row a block."""
    return F.broadcast(spark.createDataFrame([(k, *(int(x) for x in row)) for k, row in enumerate(before[:-1])], "block long, " + ", ".join(f"before_{c} long" for c in SUMS)))


def _nearest(asks: DataFrame, known: DataFrame, name: str) -> DataFrame:
    """For each (block, side, value) the entry of the target block's staircase with the greatest smaller value.
    Blocks that ask the same are one question, so a target has no more of them than depths."""
    entry = F.struct(*(c for c in known.columns if c not in ("block", "side")))
    both = asks.select("target", "value").distinct().withColumn("kind", F.lit(0)).unionByName(known.select(F.col("block").alias("target"), "value", entry.alias(name), F.lit(1).alias("kind")), allowMissingColumns=True)
    smaller = Window.partitionBy("target").orderBy("value", "kind").rowsBetween(Window.unboundedPreceding, 0)
    told = both.withColumn(name, F.last(name, ignorenulls=True).over(smaller)).filter("kind = 0").select("target", "value", name)
    return asks.join(told, ["target", "value"]).select("block", "side", "value", name)


def _across_filled(across: DataFrame) -> DataFrame:
    """The nodes across blocks, each once, all depths filled in."""
    nodes = across.withColumn("k", F.row_number().over(Window.partitionBy("lb", "lpos", "value").orderBy("block", "side"))).filter("k = 1").drop("k")
    nodes = nodes.withColumn("low", F.greatest("lvalue", "rvalue") + 1)
    at_left = F.col("lvalue") >= F.col("rvalue")
    nodes = nodes.withColumn("up_block", F.when(at_left, F.col("lb")).otherwise(F.col("rb"))).withColumn("up_side", F.when(at_left, "R").otherwise("L")).withColumn("up_value", F.col("low") - 1)
    up = across.select(F.col("block").alias("up_block"), F.col("side").alias("up_side"), F.col("value").alias("up_value"), F.col("conv").alias("up_conv"))
    nodes = nodes.join(up, ["up_block", "up_side", "up_value"], "left")
    each = nodes.withColumn("depth", F.explode(F.sequence("low", "value"))).withColumn("w", F.element_at("path", (F.col("depth") + 1).cast("int")))
    end, only = F.col("depth") == F.col("value"), F.hex(F.lit(_EMPTY))
    saved = F.col("all_words") - F.col("members") * F.col("w") - (F.col("new_words") - F.col("own_new")) - (F.col("first_words") - F.col("w"))
    return each.select(
        F.col("conv").alias("conv_id"), "depth", F.when(F.col("depth") == F.col("low"), F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("members").alias("n_convs"),
        F.when(end, F.col("parts") + (F.col("len") > F.col("value")).cast("long")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("leaves").alias("n_leaves"), saved.alias("saved_tokens"),
        F.lower(F.when(end & (F.col("len") == F.col("value")), F.hex("ends")).otherwise(only)).alias("ends_sha256"),
    )


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """All conversations, rebuilt."""
    return prefix_trie(table(spark, sf_dir, "conversations"))

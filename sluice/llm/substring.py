"""Substring dedup: suffix trees of prefix-partitioned groups, cut at their nodes of 13 words.

Every word position starts a suffix. Suffixes are split into groups between variable-length
prefixes of one to four words (by their hashes), chosen from order statistics of all suffixes so
that a group fits a task. A group's subtree is its suffixes sorted by words, with the number of
leading words that each shares with the one before it: runs that share 13 or more are the deep
internal nodes. Words are compared themselves, never by hash alone. What is removed depends on
nothing below depth 13, so 13 words of a suffix are sent; ``repeats.maximal_repeats`` grows the
subtrees to their full depth.

Only suffixes that can be in a deep node are sent: every window elects an anchor, its
word 6-gram of least hash, and equal windows elect equal anchors; a window whose anchor
stands in no other document is in no deep node. Units (splits of the scan, then buckets of
documents) send what they know in arrays, one entry a distinct window and unit, so a passage
that all documents share costs a unit one entry. Replies are bits in the order sent.

Copies: of equal texts only that of the smallest id is searched; the others go whole.
A null text has no words, like an empty one; texts of under 13 words lose nothing; very long
texts are read whole. Rows that repeat an id never count as earlier than each other; null ids come last, and none
before another (they travel as the largest long, which is no id). An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, batch, spool, table
from .wordcodes import MIX, Words, five, from_five, from_planes, mix, planes, tables

def _grams(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A code of each run of k words, over text borders too."""
    n = max(len(h) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out += h[j : j + n] * MIX[seed, j]
    return mix(out)


class Windows:
    """Windows of many texts: their first words, texts and anchors."""

    def __init__(self, h: np.ndarray, counts: np.ndarray, window: int, gram: int):
        self.h, self.window = h, window
        self.base = np.concatenate([[0], np.cumsum(counts)])
        text = np.repeat(np.arange(len(counts)), counts)
        n = max(len(h) - window + 1, 0)
        self.start = np.flatnonzero(text[:n] == text[window - 1 :]) if n else np.zeros(0, np.int64)
        self.text = text[self.start]
        self.gram = _grams(h, gram, 0)
        best = self.gram[self.start] if len(self.start) else np.zeros(0, np.uint64)
        at = self.start.copy()
        for j in range(1, window - gram + 1):
            x = self.gram[self.start + j]
            less = x < best
            best = np.where(less, x, best)
            at[less] = self.start[less] + j
        self.anchor, self.anchor_at = best, at

    def lead(self) -> np.ndarray:
        """The first four words of each window as 16 bits each, in 63 bits."""
        out = np.zeros(len(self.start), np.uint64)
        for j in range(4):
            out = (out << np.uint64(16)) | (self.h[self.start + j] >> np.uint64(48))
        return out >> np.uint64(1)


_SCAN = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("buckets", pa.binary()), ("ord", pa.binary()), ("code", pa.binary()), ("words", pa.int64()), ("leads", pa.list_(pa.int64()))])
_SCAN_DDL = "part int, ids binary, buckets binary, ord binary, code binary, words long, leads array<long>"
#: Every so many suffixes, in order, one goes into the order statistics.
_STEP = 1024
_LAST = (1 << 63) - 1


def _scan(parts: int, window: int, gram: int, flush: int = 16 << 20):
    """What a split knows: anchors by part; at part -1 its texts' ids, buckets and digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        ids: list[int] = []
        buckets: list[int] = []
        digests: list[bytes] = []
        held: list[tuple[np.ndarray, np.ndarray]] = []
        leads: list[np.ndarray] = []
        n_words = size = 0
        owner: dict[bytes, int] = {}  # a text's place in owners: of its copies here, the row of smallest id
        owners: list[tuple[int, int]] = []

        def out():
            ids_a, buckets_a = np.array(ids, "<i8"), np.array(buckets, "<i4")
            step = np.sort(np.concatenate(leads))[_STEP // 2 :: _STEP].astype(np.int64).tolist() if leads else []
            yield batch(_SCAN, [[-1], [ids_a.tobytes()], [buckets_a.tobytes()], [None], [b"".join(digests)], [n_words], [step]])
            if held:
                text, code = (np.concatenate(c) for c in zip(*held))
                part = (code % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                cuts = np.searchsorted(part[order], np.arange(parts + 1))
                ids_a, buckets_a = (np.array(x, t) for x, t in zip(zip(*owners), ("<i8", "<i4")))
                for p in np.flatnonzero(np.diff(cuts)).tolist():
                    at = order[cuts[p] : cuts[p + 1]]
                    used, ordinal = np.unique(text[at], return_inverse=True)
                    yield batch(_SCAN, [[p], [ids_a[used].tobytes()], [buckets_a[used].tobytes()], [planes(ordinal)], [five(code[at] // np.uint64(parts))], [None], [None]])

        for b in batches:
            keys, where, texts = b.column(0).to_pylist(), b.column(1).to_pylist(), [v.as_py().encode() for v in b.column(2)]
            for at in range(0, len(texts), 256):
                some = texts[at : at + 256]
                found = [hashlib.blake2b(t, digest_size=16).digest() for t in some]
                digests += found
                first = len(owners)
                ids += keys[at : at + 256]
                buckets += where[at : at + 256]
                fresh = []
                for text, d, row in zip(some, found, zip(keys[at : at + 256], where[at : at + 256])):
                    if d not in owner:
                        owner[d] = len(owners)
                        owners.append(row)
                        fresh.append(text)
                    elif row < owners[owner[d]]:
                        owners[owner[d]] = row
                h, counts, _ = words.codes(fresh)
                w = Windows(h, counts, window, gram)
                n_words += len(h)
                if len(w.start):
                    leads.append(w.lead())
                    keep = np.unique(w.anchor_at, return_index=True)[1]
                    held.append((w.text[keep] + first, w.anchor[keep] & np.uint64((1 << 40) - 1)))
                size += sum(map(len, some))
                if size > flush:
                    yield from out()
                    ids, buckets, digests, held, leads = [], [], [], [], []
                    n_words = size = 0
                    owner, owners = {}, []
        if ids:
            yield from out()

    return run


_REPLY = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("a", pa.binary()), ("b", pa.binary())])
_REPLY_DDL = "bucket int, kind int, a binary, b binary"


def _shared_anchors(parts: int):
    """Anchors that stand in two texts at least, told to the buckets of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables(batches, "part"):
            ids, buckets, codes = [], [], []
            for i, b, o, c in zip(*(t[n].to_pylist() for n in ("ids", "buckets", "ord", "code"))):
                ordinal = from_planes(o)
                ids.append(np.frombuffer(i, "<i8")[ordinal])
                buckets.append(np.frombuffer(b, "<i4")[ordinal])
                codes.append(from_five(c))
            doc, bucket, code = np.concatenate(ids), np.concatenate(buckets), np.concatenate(codes)
            order = np.argsort(code, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], code[order][1:] != code[order][:-1]]))
            shared = np.repeat(np.minimum.reduceat(doc[order], first) != np.maximum.reduceat(doc[order], first), np.diff([*first, len(order)]))
            at = order[shared]
            if len(at):
                full = code[at] * np.uint64(parts) + np.uint64(t["part"][0].as_py())
                by = np.argsort(bucket[at], kind="stable")
                cut = np.flatnonzero(np.diff(bucket[at][by])) + 1
                for g in np.split(by, cut):
                    yield batch(_REPLY, [[int(bucket[at[g[0]]])], [0], [doc[at[g]].astype("<i8").tobytes()], [five(full[g])]])

    return run


_SENT = pa.schema([("part", pa.int32()), ("bucket", pa.int32()), ("docs", pa.binary()), ("ord", pa.binary()), ("vocabulary", pa.binary()), ("words", pa.binary())])
_SENT_DDL = "part int, bucket int, docs binary, ord binary, vocabulary binary, words binary"


def numbered(words: list[bytes]) -> tuple[np.ndarray, pa.Array]:
    """A number for every word, equal where the words' bytes are, and the word of each number."""
    coded = pa.array(words, pa.binary()).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def leaves(m: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """The leaves of the subtree over suffixes m, a row of word numbers each: their order, ties as
    given, and how many leading words each shares with the one before it."""
    n, width = m.shape
    bits, per = (21, 3) if n_words <= 1 << 21 else (31, 2)
    keys = []
    for j in range(0, width, per):
        k = np.zeros(n, np.int64)
        for i in range(j, min(j + per, width)):
            k = (k << bits) | m[:, i]
        keys.append(k)
    order = np.lexsort(keys[::-1])
    in_order = m[order]
    same = in_order[1:] == in_order[:-1]
    shared = np.zeros(n, np.int64)
    shared[1:] = np.where(same.all(axis=1), width, same.argmin(axis=1))
    return order, shared


def sent_words(m: np.ndarray, vocabulary: pa.Array) -> tuple[bytes, bytes]:
    """Rows of word numbers as they travel: the words used, and numbers among these."""
    coded = pa.array(m.ravel()).dictionary_encode()
    used = vocabulary.take(coded.dictionary).to_pylist()
    numbers = coded.indices.to_numpy().astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.compress(b" ".join(used), 1), zstandard.compress(numbers, 1)


def received_words(vocabularies: list[bytes], words: list[bytes], width: int) -> tuple[np.ndarray, pa.Array]:
    """What senders sent, as rows of word numbers that hold for all of them; the words."""
    known: list[bytes] = []
    numbers = []
    for v, w in zip(vocabularies, words):
        x = np.ascontiguousarray(np.frombuffer(zstandard.decompress(w), np.uint8).reshape(4, -1).T).view("<u4").ravel()
        numbers.append(x.astype(np.int64) + len(known))
        known += zstandard.decompress(v).split(b" ")
    number, vocabulary = numbered(known)
    return number[np.concatenate(numbers)].reshape(-1, width), vocabulary


class Unit:
    """A bucket of texts: its candidate suffixes, one entry for all of equal leading words."""

    def __init__(self, texts: pa.Table, replies: pa.Table, window: int, gram: int, cuts: np.ndarray):
        raw, keys = texts["text"].to_pylist(), texts["key"].to_numpy()
        order = sorted(range(len(raw)), key=lambda i: (keys[i], raw[i]))  # the same in every pass
        self.keys = keys[order]
        h, self.counts, self.split = Words().codes([raw[i].encode() for i in order])
        kinds = replies["kind"].to_numpy() if replies.num_rows else np.zeros(0, np.int32)
        a, b = replies["a"].to_pylist(), replies["b"].to_pylist()
        gone = {(int.from_bytes(a[i], "little", signed=True), b[i]) for i in np.flatnonzero(kinds == 2)}
        some = {k for k, _ in gone}
        self.copies = np.array([k in some and (k, hashlib.blake2b(raw[i].encode(), digest_size=16).digest()) in gone for k, i in zip(self.keys.tolist(), order)], bool)
        docs = np.concatenate([np.zeros(0, "<i8"), *(np.frombuffer(a[i], "<i8") for i in np.flatnonzero(kinds == 0))])
        codes = np.concatenate([np.zeros(0, np.uint64), *(from_five(b[i]) for i in np.flatnonzero(kinds == 0))])
        self.bits = {int.from_bytes(a[i], "little"): b[i] for i in np.flatnonzero(kinds == 1)}
        w = Windows(h, self.counts, window, gram)
        told = np.unique(mix(docs.astype(np.uint64)) + codes)
        mine = mix(self.keys[w.text].astype(np.uint64)) + (w.anchor & np.uint64((1 << 40) - 1))
        at = np.flatnonzero(~self.copies[w.text] & np.isin(mine, told))
        self.start, self.text = w.start[at], w.text[at]
        number, self.vocabulary = numbered([x for ws in self.split for x in ws])
        suffixes = number[self.start[:, None] + np.arange(window)]
        self.order, shared = leaves(suffixes, len(self.vocabulary))
        # the entry of a node: its first suffix, in the text of smallest id
        new = shared < window
        self.entry = np.cumsum(new) - 1  # of each suffix in self.order
        head = self.order[new]
        self.first_text = self.text[head]
        self.suffixes = suffixes[head]
        lead = w.lead()[at][head]
        part = np.searchsorted(cuts, lead, side="right")
        self.sent: dict[int, np.ndarray] = {}
        by = np.lexsort((self.start[head], part))
        for g in np.split(by, np.flatnonzero(np.diff(part[by])) + 1) if len(by) else ():
            self.sent[int(part[g[0]])] = g


def _cuts(leads: DataFrame, groups: int) -> np.ndarray:
    """Group borders: quantiles of the leads, each cut to the fewest words that tell it from
    the border before, so groups are ranges between prefixes of one to four words."""
    if groups < 2:
        return np.zeros(0, np.uint64)
    row = leads.agg(F.percentile_approx("lead", [k / groups for k in range(1, groups)], 10 * groups)).first()[0]
    out: list[int] = []
    for q in sorted(set(row or [])):
        before = out[-1] if out else -1
        for words in range(1, 5):
            short = (q >> (64 - 16 * words - (words < 4))) << (64 - 16 * words - (words < 4)) if words < 4 else q
            if short > before:
                break
        if short > before:
            out.append(short)
    return np.array(out, np.uint64)


def _little(column: str):
    """A long as eight little-endian bytes."""
    hexes = F.lpad(F.hex(column), 16, "0")
    return F.unhex(F.concat(*(F.substring(hexes, k, 2) for k in range(15, 0, -2))))


def remove_repeats(docs: DataFrame, key: str, text: str, window: int = 13, gram: int = 6, bucket_bytes: int = 4 << 20, group_words: int = 4 << 20) -> DataFrame:
    """(key, n_words, n_removed, kept_sha256) of every row: words under a window that also
    starts in a row of smaller key are removed."""
    return _apply(docs, key, text, window, gram, bucket_bytes, group_words, False)


def candidates(docs: DataFrame, key: str, text: str, window: int, gram: int, bucket_bytes: int, group_words: int):
    """(texts by bucket, what buckets are told of copies and shared anchors, group borders)."""
    spark = docs.sparkSession
    arrow_rows(spark)
    source = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_LAST)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shuffles = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets, parts = max(shuffles, -(-total // bucket_bytes)), max(shuffles, -(-total // (64 << 20)))
    source = source.withColumn("bucket", F.pmod(F.when(F.col("key") == _LAST, F.xxhash64("text")).otherwise(F.xxhash64("key")), F.lit(buckets)).cast("int"))

    scanned = spool(source.select("key", "bucket", "text").mapInArrow(_scan(parts, window, gram), _SCAN_DDL), "scan")
    stats = scanned.filter("part < 0")
    n_words = stats.agg(F.sum("words")).first()[0] or 0
    cuts = _cuts(stats.select(F.explode("leads").alias("lead")), max(shuffles, -(-n_words // group_words)))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("key", pa.int64()), ("bucket", pa.int32()), ("digest", pa.binary())])
        for b in batches:
            for i, k, d in zip(*(b.column(n).to_pylist() for n in range(3))):
                yield batch(schema, [np.frombuffer(i, "<i8"), np.frombuffer(k, "<i4"), [d[j : j + 16] for j in range(0, len(d), 16)]])

    each = stats.select("ids", "buckets", "code").mapInArrow(unpack, "key long, bucket int, digest binary")
    least = spool(each.groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("n")).filter("n > 1").select("digest", "least"), "copied")
    copies = each.join(least, "digest").filter("key > least").select("bucket", F.lit(2).alias("kind"), _little("key").alias("a"), F.col("digest").alias("b")).distinct()
    anchors = scanned.filter("part >= 0").select("part", "ids", "buckets", "ord", "code").repartition("part").sortWithinPartitions("part")
    replies = spool(anchors.mapInArrow(_shared_anchors(parts), _REPLY_DDL).unionByName(copies), "replies")
    return source.select("bucket", "key", "text").groupBy("bucket"), replies, cuts


def _apply(docs: DataFrame, key: str, text: str, window: int, gram: int, bucket_bytes: int, group_words: int, texts: bool) -> DataFrame:
    by_bucket, replies, cuts = candidates(docs, key, text, window, gram, bucket_bytes, group_words)

    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        u = Unit(left, right, window, gram, cuts)
        rows = []
        for p, g in u.sent.items():
            used, ordinal = np.unique(u.first_text[g], return_inverse=True)
            rows.append((p, left["bucket"][0].as_py(), u.keys[used].astype("<i8").tobytes(), planes(ordinal), *sent_words(u.suffixes[g], u.vocabulary)))
        return pa.Table.from_batches([batch(_SENT, [list(c) for c in zip(*rows)])]) if rows else _SENT.empty_table()

    def tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in tables(batches, "part"):
            docs_ = [np.frombuffer(d, "<i8")[from_planes(o)] for d, o in zip(t["docs"].to_pylist(), t["ord"].to_pylist())]
            sizes, doc = [len(d) for d in docs_], np.concatenate(docs_)
            suffixes, vocabulary = received_words(t["vocabulary"].to_pylist(), t["words"].to_pylist(), window)
            order, shared = leaves(suffixes, len(vocabulary))
            # a deep node: leaves that share a whole window, each with the one before it
            first = np.flatnonzero(shared < window)
            least_ = np.repeat(np.minimum.reduceat(doc[order], first), np.diff([*first, len(order)]))
            repeated = np.zeros(len(order), bool)
            repeated[order] = doc[order] > least_
            part = int(t["part"][0].as_py()).to_bytes(4, "little")
            at = 0
            for b, n in zip(t["bucket"].to_pylist(), sizes):
                if repeated[at : at + n].any():
                    yield batch(_REPLY, [[b], [1], [part], [np.packbits(repeated[at : at + n]).tobytes()]])
                at += n

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        u = Unit(left, right, window, gram, cuts)
        later = np.zeros(len(u.suffixes), bool)
        for p, g in u.sent.items():
            if p in u.bits:
                later[g] = np.unpackbits(np.frombuffer(u.bits[p], np.uint8), count=len(g)).astype(bool)
        base = np.concatenate([[0], np.cumsum(u.counts)])
        # equal ids of repeated rows are no earlier than each other
        covered = later[u.entry] | (u.keys[u.text[u.order]] > u.keys[u.first_text[u.entry]])
        marks = np.zeros(base[-1] + 1, np.int64)
        hit = u.start[u.order[covered]]
        np.add.at(marks, hit, 1)
        np.add.at(marks, hit + window, -1)
        gone = np.cumsum(marks[:-1]) > 0
        whole = u.copies & (u.counts >= window)
        cols: list[list] = [[], [], [], []]
        for i, w in enumerate(u.split):
            drop = gone[base[i] : base[i + 1]]
            n = len(w) if whole[i] else int(drop.sum())
            kept = [] if whole[i] else [x for x, d in zip(w, drop.tolist()) if not d] if n else w
            for col, x in zip(cols, (int(u.keys[i]), len(w), n, b" ".join(kept).decode() if texts else hashlib.sha256(b" ".join(kept)).hexdigest())):
                col.append(x)
        return pa.table({"key": pa.array(cols[0], pa.int64()), "n_words": pa.array(cols[1], pa.int64()), "n_removed": pa.array(cols[2], pa.int64()), "kept": pa.array(cols[3], pa.string())})

    sent = by_bucket.cogroup(replies.groupBy("bucket")).applyInArrow(send, _SENT_DDL)
    found = sent.repartition("part").sortWithinPartitions("part", "bucket").mapInArrow(tree, _REPLY_DDL)
    final = by_bucket.cogroup(replies.unionByName(found).groupBy("bucket")).applyInArrow(finish, "key long, n_words long, n_removed long, kept string")
    return final.select(F.nullif("key", F.lit(_LAST)).alias(key), "n_words", "n_removed", F.col("kept").alias("kept_text" if texts else "kept_sha256"))


def op10_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the 13-word windows that an earlier one starts."""
    return remove_repeats(table(spark, sf_dir, "documents"), "doc_id", "text")

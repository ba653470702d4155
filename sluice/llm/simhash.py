"""SimHash near-dedup with pigeonring filtering.

A 64-bit fingerprint is cut into four segments on a ring. If two fingerprints differ in at
most tau bits, some segment starts a chain in which, for every length l, the first l
segments differ in at most floor(l * tau / 4) bits (the pigeonring principle; the plain
pigeonhole is l = 1). With tau = 3 the budgets are 0, 1, 2, 3: the first segment is equal,
and of the two halves of the second one is. So each distinct fingerprint is filed under
eight keys: start, half, the first segment and that half (24 bits). Pairs under one key
must keep the chain's budgets before the full Hamming distance is taken.

Only distinct fingerprints are compared; of a key's links a spanning forest leaves the task.
A key with more than ``block`` fingerprints is cut into blocks, and each pair of blocks is a
task of its own: bounded memory, no link lost.

A text without words has fingerprint zero, as a null has, and links like any other; texts
shorter than a shingle are one shingle. Very long texts are read whole. Repeated rows with
one id count once; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_rows, batch, spool, table, whole_groups
from .graph import components, local_components

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SEED = 42


def _words(text: str) -> list[bytes]:
    return _WORD.findall(text.encode().lower())


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words joined by a space; of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    ends = list(accumulate(len(w) + 1 for w in words))
    pieces = [joined[a : b - 1] for a, b in zip([0, *ends], ends[width - 1 :])]
    return np.fromiter(map(xxhash.xxh64_intdigest, pieces, repeat(SEED)), np.uint64, len(pieces))


def majority(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def rehashed(hashes: np.ndarray, turn: int) -> np.ndarray:
    """Independent hashes of what hashes are of; turn 0: they themselves."""
    if not turn:
        return hashes
    x = hashes + np.uint64((turn * 0x9E3779B97F4A7C15) & ((1 << 64) - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Bands of least hashes: a pair of sets of Jaccard similarity s shares none of the bands with
#: chance (1 - s**ROWS)**BANDS, under 1e-5 at 0.8.
BANDS, ROWS = 64, 8
_RNG = np.random.default_rng(8064)
_SLOPE, _SHIFT = _RNG.integers(1, 1 << 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = _RNG.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(hashes: np.ndarray) -> np.ndarray:
    """A code a band of the least hashes of a set, under BANDS * ROWS orders of its members."""
    if not len(hashes):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[at : at + 2048] * _SLOPE + _SHIFT).min(axis=1))
    codes = (rehashed(least, 1).reshape(BANDS, ROWS) * _ROW).sum(axis=1, dtype=np.uint64)
    return rehashed(codes + np.arange(BANDS, dtype=np.uint64), 2).view(np.int64)


def fingerprints(docs: DataFrame, key: str, text: str, shingle: int = 3, turns: int = 1, distinct: bool = False, set_shingle: int | None = None) -> DataFrame:
    """(key, fps as signed longs, digest, bands): A-Z lower-cased, shingles with repeats or, if
    ``distinct``, without. digest, bands: of the set of ``set_shingle``-word shingles, where asked for."""
    arrow_rows(docs.sparkSession)
    schema = pa.schema([("key", pa.int64()), ("fps", pa.list_(pa.int64())), ("digest", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps, digests, codes = [], [], []
            for value in b.column(1):
                words = _words(value.as_py())
                hashes = shingle_hashes(words, shingle)
                hashes = np.unique(hashes) if distinct else hashes
                fps.append(np.array([majority(rehashed(hashes, k)) for k in range(turns)], np.uint64).view(np.int64))
                members = np.unique(shingle_hashes(words, set_shingle)) if set_shingle else None
                digests.append(hashlib.blake2b(members.tobytes(), digest_size=16).digest() if set_shingle else None)
                codes.append(bands(members) if set_shingle else None)
            yield batch(schema, [b.column(0), fps, digests, codes])

    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInArrow(run, "key long, fps array<long>, digest binary, bands array<long>").withColumnRenamed("key", key)


def chain_ok(x: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether differences x keep the chain budgets 0, 1, 2, 3 from segment ``start`` on."""
    ring = np.stack([np.bitwise_count((x >> np.uint64(16 * k)) & np.uint64(0xFFFF)) for k in range(4)], axis=1).astype(np.int64)
    rows, total, ok = np.arange(len(x)), np.zeros(len(x), np.int64), np.ones(len(x), bool)
    for step in range(4):
        total += ring[rows, (start + step) % 4]
        ok &= total <= step
    return ok


def _links(key: np.ndarray, start: np.ndarray, fp: np.ndarray, side: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs in one group (sorted) that link. side: 0 a row of a single block; in a
    pair of blocks 1 and 2, of which only pairs across count."""
    out_a, out_b = [], []
    a = np.arange(len(key) - 1)
    step = 1
    while len(a):
        a = a[a + step < len(key)]
        a = a[key[a] == key[a + step]]
        for at in range(0, len(a), 1 << 18):
            i = a[at : at + (1 << 18)]
            j = i + step
            x = fp[i] ^ fp[j]
            ok = ((side[i] == 0) | (side[i] != side[j])) & (np.bitwise_count(x & np.uint64(0xFFFF)) <= tau)
            i, j, x = i[ok], j[ok], x[ok]
            ok = chain_ok(x, start[i])
            i, j, x = i[ok], j[ok], x[ok]
            ok = np.bitwise_count(x) <= tau
            i, j = i[ok], j[ok]
            out_a.append(i)
            out_b.append(j)
        step += 1
    empty = np.zeros(0, np.int64)
    return np.concatenate(out_a or [empty]), np.concatenate(out_b or [empty])


def _paired(rows: DataFrame, count: str, block: int) -> DataFrame:
    """rows (of a group of ``count``) dealt to pairs of blocks p <= q of their group; side: 0 in a
    single block, else 1 or 2. Only pairs across the two sides of a pair count."""
    rows = rows.withColumn("_blocks", F.ceil(F.col(count) / block).cast("int")).withColumn("_mine", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("_blocks") - 1), lambda o: F.struct(F.least("_mine", o).alias("p"), F.greatest("_mine", o).alias("q"), F.when(F.col("_mine") == o, 0).when(F.col("_mine") < o, 1).otherwise(2).cast("int").alias("side")))
    return rows.withColumn("_pair", F.explode(pairs)).select(*[c for c in rows.columns if c not in ("_blocks", "_mine", count)], "_pair.p", "_pair.q", "_pair.side")


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _star(ids: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch | None:
    """A spanning forest of links between places of ids."""
    root = local_components(len(ids), a, b)
    part = np.unique(np.concatenate([a, b]))
    part = part[root[part] != part]
    return batch(_EDGES, [ids[root[part]], ids[part]]) if len(part) else None


def near_links(nodes: DataFrame, tau: int = 3, block: int = 4096) -> DataFrame:
    """Edges (a, b) that join the links of nodes (id, fps): those of whose fingerprints at one
    place of ``fps`` differ in ``tau`` bits at most."""
    if not 0 <= tau <= 3:
        raise ValueError("keys hold for up to three differing bits")
    turned = nodes.select("id", F.posexplode("fps").alias("turn", "fp"))
    seg = [F.call_function("shiftrightunsigned", F.col("fp"), F.lit(16 * k)).bitwiseAND(F.lit(0xFFFF)) for k in range(4)]
    keys = []
    for k in range(4):
        for half in range(2):
            part = F.call_function("shiftrightunsigned", seg[(k + 1) % 4], F.lit(8 * half)).bitwiseAND(F.lit(0xFF))
            keys.append(F.lit((k * 2 + half) << 24).cast("long").bitwiseOR(F.call_function("shiftleft", seg[k], F.lit(8))).bitwiseOR(part))
    turn = F.call_function("shiftleft", F.col("turn").cast("long"), F.lit(27))
    filed = turned.select("id", "fp", F.explode(F.array(*keys)).alias("key"), "turn").select("id", "fp", F.col("key").bitwiseOR(turn).alias("key"))
    sizes = filed.groupBy("key").count().filter("count > 1")
    dealt = _paired(filed.join(sizes, "key"), "count", block).repartition("key", "p", "q").sortWithinPartitions("key", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in whole_groups(batches, ("key", "p", "q")):
            start = (rows["key"].to_numpy() >> 25) & 3
            a, b = _links(group, start, rows["fp"].to_numpy().view(np.uint64), rows["side"].to_numpy(), tau)
            if len(a) and (out := _star(rows["id"].to_numpy(), a, b)) is not None:
                yield out

    return dealt.mapInArrow(run, "a long, b long")


def band_links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that join the nodes (id, bands) which share a band: each to its smallest."""
    filed = nodes.select("id", F.explode("bands").alias("key"))
    heads = filed.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).filter("n > 1").select("key", "a")
    return filed.join(heads, "key").filter("a < id").select("a", F.col("id").alias("b")).distinct()


def alike(sets: list[np.ndarray], side: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets whose Jaccard similarity is ``least`` at least, by an inverted index: one
    count over the postings of each set's members. Empty sets are alike."""
    size = np.array([len(s) for s in sets], np.int64)
    _, member = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(member, kind="stable")
    posted, bound = owner[order], np.concatenate([[0], np.cumsum(np.bincount(member))]) if len(member) else np.zeros(1, np.int64)
    at, out_a, out_b = np.concatenate([[0], np.cumsum(size)]), [], []
    for x in range(len(sets)):
        mine = member[at[x] : at[x + 1]]
        first, many = bound[mine], bound[mine + 1] - bound[mine]
        places = np.repeat(first - np.concatenate([[0], np.cumsum(many)[:-1]]), many) + np.arange(many.sum()) if len(mine) else np.zeros(0, np.int64)
        shared = np.bincount(posted[places], minlength=len(sets)) if len(places) else np.zeros(len(sets), np.int64)
        ok = (shared >= least * (size + size[x] - shared) - 1e-9) & ((side == 0) | (side != side[x]))
        y = np.flatnonzero(ok)
        y = y[y > x]
        out_a.append(np.full(len(y), x))
        out_b.append(y)
    return np.concatenate(out_a), np.concatenate(out_b)


def confirmed_links(docs: DataFrame, key: str, text: str, groups: DataFrame, similarity: float, width: int = 5, block: int = 256) -> DataFrame:
    """Edges (a, b) that join the pairs in a group (id, component) whose sets of ``width``-word
    shingles have that Jaccard similarity exactly, in pairs of bounded blocks."""
    arrow_rows(docs.sparkSession, 200)
    texts = docs.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    sizes = groups.groupBy("component").count()
    members = texts.join(groups.join(sizes, "component"), "id")
    dealt = _paired(members, "count", block).repartition("component", "p", "q").sortWithinPartitions("component", "p", "q")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in whole_groups(batches, ("component", "p", "q"), 256):
            ids, side, texts_ = rows["id"].to_numpy(), rows["side"].to_numpy(), rows["text"].to_pylist()
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
            for s, e in zip(cuts, cuts[1:]):
                if e - s > 1:
                    sets = [np.unique(shingle_hashes(_words(t), width)) for t in texts_[s:e]]
                    a, b = alike(sets, side[s:e], similarity)
                    if len(a) and (out := _star(ids[s:e], a, b)) is not None:
                        yield out

    return dealt.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str, text: str, shingle: int = 3, tau: int = 3, turns: int = 1, distinct: bool = False, similarity: float | None = None, block: int = 4096) -> DataFrame:
    """(key, fingerprint as 16 hex digits, component_id). Documents link if their fingerprints of
    any of ``turns`` independent hashes differ in ``tau`` bits at most. With ``similarity``, those
    link whose sets of five-word shingles have that Jaccard similarity: shared bands of least
    hashes propose (a pair at 0.8 is missed with a chance under 1e-5), the sets decide within what
    so hangs together. Equal documents, or sets, are one node."""
    fps = spool(fingerprints(docs, key, text, shingle, turns, distinct, 5 if similarity is not None else None), "fps")
    same = "fps" if similarity is None else "digest"
    nodes = spool(fps.groupBy(same).agg(F.min(key).alias("id"), F.min("bands").alias("bands")), "nodes")
    if similarity is None:
        found = components(near_links(nodes, tau, block))
    else:
        found = components(confirmed_links(docs, key, text, components(band_links(nodes)), similarity))
    classes = nodes.join(found, "id", "left").select(same, F.coalesce("component", "id").alias("component_id"))
    return fps.join(classes, same).select(key, F.lpad(F.lower(F.hex(F.get("fps", F.lit(0)))), 16, "0").alias("fingerprint"), "component_id")


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and component."""
    return near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")

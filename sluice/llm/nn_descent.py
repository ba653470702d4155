"""Embedding near-dedup by NN-descent.

Equal vectors are one node with a multiplicity. Every node starts with its nearest
neighbours in the leaves of a few random-hyperplane trees. Then rounds of local joins: at
each node its neighbours, and the nodes whose neighbour it is, meet; a pair that is closer
than what a list holds enters the list.

Edges at or above the threshold are kept. A node whose list is full of such edges is
saturated: it may have links beyond its list, so it is searched against all nodes exactly, in
passes of bounded size, and the components that its links lead to are joined. Then, within each
component, every node's links are counted in full, in pairs of bounded blocks, so no group
is held by a task and no pairs are emitted.

What was counted is audited: a bounded set of nodes is searched by brute force against all.
Below ``target`` of all their links, lists get twice as long, as many new trees are added, and
more rounds follow; if ``again`` of these don't reach it, every node is searched exactly.

Vectors that are null, empty, zero, or hold null or non-finite components link with
nothing. Vectors of different lengths never link; of any length, they are taken whole. Nodes have ids of their own, so that
of repeated ids each row is judged by its own vector. A null id names no component: vectors that reach only such have
a null one, and are not kept. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import arrow_rows, batch, spool, table, whole_groups
from .graph import components


def _narrow(x: np.ndarray) -> bytes:
    """Bytes of a vector, in single precision where that is exact."""
    y = x.astype(np.float32)
    return b"\4" + y.tobytes() if (y == x).all() else b"\10" + x.tobytes()


def _vectors(blobs: list[bytes]) -> np.ndarray:
    """Unit vectors of what _narrow wrote."""
    if all(b[0] == 4 for b in blobs):
        x = np.frombuffer(b"".join(b[1:] for b in blobs), np.float32).reshape(len(blobs), -1)
        return _unit_rows(x.astype(np.float64))
    return _unit_rows(np.stack([np.frombuffer(b[1:], np.float32 if b[0] == 4 else np.float64).astype(np.float64) for b in blobs]))


def _unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def parse(vectors: DataFrame, key: str, vec: str) -> DataFrame:
    """(key, digest, dim, vec as bytes); digest null: links with nothing."""
    schema = pa.schema([("key", pa.int64()), ("digest", pa.binary()), ("dim", pa.int32()), ("vec", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            lengths = [0 if v is None else v for v in b.column(1).value_lengths().to_pylist()]
            at, rows = 0, []
            for n in lengths:
                x = flat[at : at + n]
                at += n
                good = n and np.isfinite(x).all() and x.any()
                blob = _narrow(x) if good else None
                rows.append((hashlib.blake2b(blob, digest_size=16).digest(), n, blob) if good else (None, None, None))
            yield batch(schema, [b.column(0), *(list(c) for c in (zip(*rows) if rows else ((), (), ())))])

    source = vectors.select(F.col(key).cast("long").alias("key"), F.col(vec).cast("array<double>").alias("vec"))
    return source.mapInArrow(run, "key long, digest binary, dim int, vec binary")


def _top(edges: DataFrame, k: int) -> DataFrame:
    """The k nearest (u, w, sim) of each u; one shuffle."""
    merged = edges.repartition("u").groupBy("u", "w").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.col("sim").desc(), "w"))
    return merged.withColumn("_r", rank).filter(F.col("_r") <= k).drop("_r")


_EDGE = pa.schema([("u", pa.int64()), ("w", pa.int64()), ("sim", pa.float64())])


def _bounds(group: np.ndarray) -> list[tuple[int, int]]:
    cuts = np.flatnonzero(np.diff(group)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(group)]))


def forest(nodes: DataFrame, n: int, k: int, trees: int, leaf: int, seed: int) -> DataFrame:
    """Each node's nearest in its leaf of each tree; a leaf of more than 4 * leaf nodes is dealt
    out at random among as many leaves as it fills."""
    depth = max(0, min(40, math.ceil(math.log2(max(n, 1) / leaf))))
    schema = pa.schema([("id", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary()), ("cells", pa.list_(pa.int64()))])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            dims, blobs = np.array(b.column(1).to_pylist(), np.int64), b.column(2).to_pylist()
            cells = np.zeros((len(blobs), trees), np.int64)
            for d in np.unique(dims):
                if d not in planes:
                    planes[d] = np.random.default_rng([seed, int(d)]).standard_normal((int(d), trees * max(depth, 1)))
                at = np.flatnonzero(dims == d)
                bits = (_vectors([blobs[i] for i in at]) @ planes[d] > 0).reshape(len(at), trees, -1)[:, :, :depth]
                cells[at] = (bits.astype(np.int64) << np.arange(depth)).sum(axis=2) | (np.arange(trees, dtype=np.int64) << 42)
            yield batch(schema, [b.column(0), b.column(1), b.column(2), list(cells)])

    coded = nodes.select("id", "dim", "vec").mapInArrow(code, "id long, dim int, vec binary, cells array<long>").select("id", "dim", "vec", F.explode("cells").alias("cell"))
    coded = spool(coded, "cells")
    large = coded.groupBy("cell", "dim").count().filter(F.col("count") > 4 * leaf)
    dealt = coded.join(large, ["cell", "dim"], "left").withColumn("salt", F.coalesce(F.pmod(F.xxhash64("id", "cell"), F.ceil(F.col("count") / leaf)), F.lit(0)).cast("long"))
    dealt = dealt.select("cell", "dim", "salt", "id", "vec").repartition("cell", "dim", "salt").sortWithinPartitions("cell", "dim", "salt")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in whole_groups(batches, ("cell", "dim", "salt"), 20_000):
            ids, blobs, out = rows["id"].to_numpy(), rows["vec"].to_pylist(), []
            for a, b in _bounds(group):
                if b - a > 1:
                    x = _vectors(blobs[a:b])
                    out.append(_nearest(ids[a:b], x @ x.T, k))
            if out:
                yield batch(_EDGE, [np.concatenate(c) for c in zip(*out)])

    return dealt.mapInArrow(solve, "u long, w long, sim double")


def _nearest(ids: np.ndarray, s: np.ndarray, k: int, floor: np.ndarray | None = None) -> tuple:
    """The k largest of each row of s, off its diagonal, above the row's floor."""
    m = min(k, len(ids) - 1)
    np.fill_diagonal(s, -2.0)
    cols = np.argpartition(-s, m - 1, axis=1)[:, :m]
    rows = np.repeat(np.arange(len(ids)), m)
    cols = cols.ravel()
    sims = s[rows, cols]
    keep = ids[rows] != ids[cols]
    if floor is not None:
        keep &= sims > floor[rows]
    return ids[rows[keep]], ids[cols[keep]], sims[keep]


def descend(nodes: DataFrame, graph: DataFrame, k: int, reverse: int) -> DataFrame:
    """One round of neighbours-of-neighbours joins."""
    back = graph.select(F.col("w").alias("v"), F.col("u").alias("m"), "sim")
    back = back.withColumn("_r", F.row_number().over(Window.partitionBy("v").orderBy(F.col("sim").desc(), "m"))).filter(F.col("_r") <= reverse)
    members = graph.select(F.col("u").alias("v"), F.col("w").alias("m")).unionByName(back.select("v", "m")).distinct()
    floors = graph.groupBy("u").agg(F.when(F.count("*") >= k, F.min("sim")).otherwise(-2.0).alias("floor"))
    known = nodes.select("id", "vec").join(floors, F.col("id") == F.col("u"), "left").select(F.col("id").alias("m"), "vec", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
    met = members.join(known, "m").repartition("v").sortWithinPartitions("v")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in whole_groups(batches, ("v",), 20_000):
            ids, blobs, floor, out = rows["m"].to_numpy(), rows["vec"].to_pylist(), rows["floor"].to_numpy(), []
            for a, b in _bounds(group):
                if b - a > 1:
                    x = _vectors(blobs[a:b])
                    out.append(_nearest(ids[a:b], x @ x.T, k, floor[a:b]))
            if out:
                yield batch(_EDGE, [np.concatenate(c) for c in zip(*out)])

    return _top(graph.unionByName(met.mapInArrow(solve, "u long, w long, sim double")), k)


def audit(nodes: DataFrame, counted: DataFrame, threshold: float, queries: int = 512, enough: int = 128, most: int = 4096) -> float:
    """The mean share of their links, as brute force over all nodes has them, that ``counted``
    (id, links) holds. Nodes are drawn until ``enough`` have links, or ``most`` are drawn."""
    chosen = nodes.orderBy(F.xxhash64("id"), "id").select("id", "dim", "vec").limit(most).collect()
    true: dict[int, int] = {}
    for at in range(0, len(chosen), queries):
        asked: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        part = chosen[at : at + queries]
        for d in {r["dim"] for r in part}:
            of = [r for r in part if r["dim"] == d]
            asked[d] = np.array([r["id"] for r in of]), _vectors([bytes(r["vec"]) for r in of])

        def search(batches: Iterator[pa.RecordBatch], asked=asked) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids, dims, blobs, mult = b.column(0).to_numpy(), np.array(b.column(1).to_pylist(), np.int64), b.column(2).to_pylist(), b.column(3).to_numpy()
                for d in np.unique(dims):
                    if int(d) in asked:
                        on = np.flatnonzero(dims == d)
                        of, x = asked[int(d)]
                        near = (x @ _vectors([blobs[j] for j in on]).T >= threshold) & (of[:, None] != ids[on])
                        links = near @ mult[on]
                        yield batch(pa.schema([("id", pa.int64()), ("n", pa.int64())]), [of[links > 0], links[links > 0]])

        truth = nodes.select("id", "dim", "vec", "mult").mapInArrow(search, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
        true |= {r["id"]: r["n"] for r in truth.collect()}
        if len(true) >= enough:
            break
    held = {r["id"]: r["links"] for r in counted.filter(F.col("id").isin(list(true))).collect()} if true else {}
    return sum(min(held.get(i, 0) / n, 1.0) for i, n in true.items()) / len(true) if true else 1.0


def across(nodes: DataFrame, found: DataFrame, asked: DataFrame, threshold: float, pass_bytes: int = 16 << 20, block: int = 1024) -> DataFrame:
    """Edges (u, w) that join the component of each node of ``asked`` (id) with those of all nodes
    it links with: an exact search against all nodes, in passes of bounded bytes. A node gives
    a component one edge a block at most."""
    spark = nodes.sparkSession
    of = spool(nodes.join(found, "id", "left").select("id", "dim", "vec", F.coalesce("component", "id").alias("component")), "of")
    asked = spool(of.join(asked.select("id"), "id", "left_semi"), "asked")
    passes = -(-(asked.agg(F.sum(F.octet_length("vec"))).first()[0] or 0) // pass_bytes)
    out = spark.createDataFrame([], "u long, w long")
    for k in range(passes):
        rows = asked.filter(F.pmod(F.xxhash64("id"), F.lit(passes)) == k).orderBy("component", "id").collect()
        queries = {d: [(r["id"], r["component"], bytes(r["vec"])) for r in rows if r["dim"] == d] for d in {r["dim"] for r in rows}}

        def search(batches: Iterator[pa.RecordBatch], queries=queries) -> Iterator[pa.RecordBatch]:
            units = {d: (np.array([r[0] for r in x], np.int64), np.array([r[1] for r in x], np.int64), _vectors([r[2] for r in x])) for d, x in queries.items()}
            for b in batches:
                ids, dims, blobs, part = b.column(0).to_numpy(), np.array(b.column(1).to_pylist(), np.int64), b.column(2).to_pylist(), b.column(3).to_numpy()
                for d in np.unique(dims):
                    if int(d) not in units:
                        continue
                    on = np.flatnonzero(dims == d)
                    y = _vectors([blobs[j] for j in on])
                    whose, theirs, x = units[int(d)]
                    for at in range(0, len(x), block):
                        q, i = np.nonzero(x[at : at + block] @ y.T >= threshold)
                        q += at
                        apart = theirs[q] != part[on[i]]
                        q, i = q[apart], i[apart]
                        if len(q):
                            _, one = np.unique(np.stack([theirs[q], i]), axis=1, return_index=True)
                            yield batch(pa.schema([("u", pa.int64()), ("w", pa.int64())]), [whose[q[one]], ids[on[i[one]]]])

        out = out.unionByName(spool(of.mapInArrow(search, "u long, w long"), "across"))
    return out


def linked(nodes: DataFrame, found: DataFrame, threshold: float, block: int = 256) -> DataFrame:
    """(id, links): the links of every node within its component, weighted with ``mult``."""
    of = found.join(nodes, "id").select("component", "id", "vec", "mult")
    sizes = of.groupBy("component").count()
    of = of.join(sizes, "component").withColumn("blocks", F.ceil(F.col("count") / block).cast("int"))
    of = of.withColumn("mine", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least("mine", o).alias("p"), F.greatest("mine", o).alias("q"), F.when(F.col("mine") == o, 0).when(F.col("mine") < o, 1).otherwise(2).cast("int").alias("side")))
    dealt = of.withColumn("pair", F.explode(pairs)).select("component", F.col("pair.p").alias("p"), F.col("pair.q").alias("q"), F.col("pair.side").alias("side"), "id", "vec", "mult")
    dealt = dealt.repartition("component", "p", "q").sortWithinPartitions("component", "p", "q")
    schema = pa.schema([("id", pa.int64()), ("links", pa.int64())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, group in whole_groups(batches, ("component", "p", "q"), 20_000):
            ids, blobs, side, mult = rows["id"].to_numpy(), rows["vec"].to_pylist(), rows["side"].to_numpy(), rows["mult"].to_numpy()
            links = np.zeros(len(ids), np.int64)
            for a, b in _bounds(group):
                x = _vectors(blobs[a:b])
                left, right = (np.arange(b - a), np.arange(b - a)) if side[a] == 0 else (np.flatnonzero(side[a:b] == 1), np.flatnonzero(side[a:b] == 2))
                near = x[left] @ x[right].T >= threshold
                if side[a] == 0:
                    np.fill_diagonal(near, False)
                    links[a:b] = near @ mult[a:b]
                else:
                    links[a + left] = near @ mult[a + right]
                    links[a + right] = near.T @ mult[a + left]
            yield batch(schema, [ids, links])

    return dealt.mapInArrow(solve, "id long, links long").groupBy("id").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, key: str, vec: str, threshold: float = 0.95, k: int = 8, trees: int = 10, leaf: int = 64, rounds: int = 2, reverse: int = 8, target: float = 0.98, again: int = 2, seed: int = 7) -> DataFrame:
    """(key, n_links, component_id, kept) of every row."""
    arrow_rows(vectors.sparkSession, 5000)
    rows = spool(parse(vectors, key, vec), "vectors")
    nodes = rows.filter("digest is not null").groupBy("digest").agg(F.min("key").alias("least"), F.count("*").alias("mult"), F.first("dim").alias("dim"), F.first("vec").alias("vec"))
    nodes = spool(nodes.withColumn("id", F.monotonically_increasing_id()), "nodes")
    n = nodes.count()
    graph = spool(_top(forest(nodes, n, k, trees, leaf, seed), k), "graph")

    def counts(edges: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
        found = components(edges, "u", "w")
        joined = components(edges.unionByName(across(nodes, found, asked, threshold)), "u", "w")
        return joined, spool(linked(nodes, joined, threshold), "links")

    for attempt in range(again + 1):
        for _ in range(rounds):
            graph = spool(descend(nodes, graph, k, reverse), "graph")
        edges = spool(graph.filter(F.col("sim") >= threshold).select("u", "w"), "near")
        full = graph.groupBy("u").agg(F.count("*").alias("n"), F.min("sim").alias("least")).filter((F.col("n") >= k) & (F.col("least") >= threshold))
        found, counted = counts(edges, full.select(F.col("u").alias("id")))
        if audit(nodes, counted, threshold) >= target:
            break
        if attempt == again:  # the target is missed: every node is searched exactly
            found, counted = counts(edges, nodes)
            break
        k, reverse, seed = 2 * k, 2 * reverse, seed + 1
        graph = spool(_top(graph.unionByName(forest(nodes, n, k, trees, leaf, seed)), k), "graph")
    of = nodes.select("digest", "id", "mult", "least").join(found, "id", "left").join(counted, "id", "left").withColumn("component", F.coalesce("component", "id"))
    labels = of.groupBy("component").agg(F.min("least").alias("label"))
    classes = of.join(labels, "component").select("digest", "label", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("links"))
    good = rows.filter("digest is not null").select("key", "digest").join(classes, "digest").select("key", "links", "label")
    alone = rows.filter("digest is null").select("key", F.lit(0).cast("long").alias("links"), F.col("key").alias("label"))
    return good.unionByName(alone).select(F.col("key").alias(key), F.col("links").alias("n_links"), F.col("label").alias("component_id"), F.coalesce(F.col("key") == F.col("label"), F.lit(False)).alias("kept"))


def op9_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Every vector's links, component and whether it stays."""
    return near_duplicates(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")

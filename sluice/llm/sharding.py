"""Sharding: best-fit-decreasing bin packing of indivisible groups.

Groups of rows (here: equal texts) must stay together. Sorted by size, largest
first, each enters the bin with the tightest remaining capacity that still holds
it. The bins stand in a balanced order (a sorted list searched by bisection,
O(log bins) a placement).

What makes it distributed: the packing needs only how many groups there are of
each size, not the groups. Sizes are rounded up to ``digits`` binary digits, so
there are at most 64 * 2**(digits-1) classes whatever the input, and equal-sized
groups are placed in runs. The driver packs that bounded histogram; the groups
get their place from their rank in one global order by size, found from range
partitions and their counts, so no size class, group or shard lies in one task.

Nulls, empties, ties: a null text has size 1 (0 bytes plus 1) and all null texts
form a group of their own, apart from the empty texts; equal sizes are ordered
by group key. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import spool, table


def size_class(size: Column, digits: int = 12) -> Column:
    """size rounded up to so many leading binary digits (up to 2**digits: exact)."""
    shift = F.greatest(F.length(F.bin(size)) - F.lit(digits), F.lit(0))
    unit = F.call_function("shiftleft", F.lit(1).cast("long"), shift)
    return (F.floor((size + unit - 1) / unit) * unit).cast("long")


class Bins:
    """Open bins ordered by remaining capacity; the tightest that fits is a bisection away."""

    def __init__(self, capacity: int, most: int | None = None):
        self.capacity, self.most, self.open, self.count = capacity, most, [], 0

    def place(self, size: int, n: int) -> list[tuple[int, int]] | None:
        """Place n items of one size; runs of (bin, items), or None when bins run out."""
        runs: list[tuple[int, int]] = []
        while n:
            at = bisect_left(self.open, (size, -1))
            if at < len(self.open):
                room, bin_ = self.open.pop(at)
            elif self.most is None or self.count < self.most:
                room, bin_, self.count = max(self.capacity, size), self.count, self.count + 1
            else:
                return None
            take = min(n, room // size)
            insort(self.open, (room - take * size, bin_))
            runs.append((bin_, take))
            n -= take
        return runs


def pack(histogram: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int]] | None:
    """Best-fit decreasing over (size, count): (size, bin, items) in rank order."""
    bins, out = Bins(capacity, most), []
    for size, n in sorted(histogram, reverse=True):
        runs = bins.place(size, n)
        if runs is None:
            return None
        out += [(size, b, k) for b, k in runs]
    return out


def pack_into(histogram: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """A packing into so many shards of nearly equal size. A group larger than the average share of
    what is left gets a shard of its own, and so does the largest where shards would stay empty; the
    rest is packed at the smallest capacity, to a thousandth of a shard, that needs no more shards."""
    left = sorted(([s, n] for s, n in histogram if n > 0), reverse=True)
    total, groups, own = sum(s * n for s, n in left), sum(n for _, n in left), []
    while True:
        while left and shards - len(own) > 1 and left[0][0] * (shards - len(own)) > total:
            total, groups = _alone(left, own, total, groups)
        found = _smallest([(s, n) for s, n in left], shards - len(own), total)
        used = len({b for _, b, _ in found})
        if used == min(groups, shards - len(own)):
            return [(s, b, 1) for b, s in enumerate(own)] + [(s, b + len(own), n) for s, b, n in found]
        total, groups = _alone(left, own, total, groups)


def _alone(left: list[list[int]], own: list[int], total: int, groups: int) -> tuple[int, int]:
    """One of the largest groups leaves for a shard of its own."""
    size = left[0][0]
    own.append(size)
    left[0][1] -= 1
    if not left[0][1]:
        del left[0]
    return total - size, groups - 1


def _smallest(histogram: list[tuple[int, int]], shards: int, total: int) -> list[tuple[int, int, int]]:
    low = max(-(-total // shards), max((s for s, _ in histogram), default=1))
    if (found := pack(histogram, low, shards)) is not None:
        return found
    good, high = None, low
    while good is None:
        high += max(1, high // 8)
        good = pack(histogram, high, shards)
    while high - low > max(1, low // 4000):
        mid = (low + high) // 2
        if (found := pack(histogram, mid, shards)) is None:
            low = mid
        else:
            good, high = found, mid
    return good


def ranked(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """df with its global rank from 0 in that order, which must be total. Rows are dealt
    by range, so the only window is inside a partition."""
    part = f"{rank}_part"
    dealt = df.repartitionByRange(*order).withColumn(part, F.spark_partition_id())
    dealt = spool(dealt, "ranked")
    first = dealt.groupBy(part).count()
    # one row a partition, so this running sum is over a bounded number of rows
    offset = first.select(part, (F.sum("count").over(Window.orderBy(part)) - F.col("count")).alias("_offset"))
    inside = F.row_number().over(Window.partitionBy(part).orderBy(*order)) - 1
    return dealt.join(F.broadcast(offset), part).withColumn(rank, (F.col("_offset") + inside).cast("long")).drop(part, "_offset")


def shard(rows: DataFrame, key: str, size: str, group: str, shards: int | None = 8, capacity: int | None = None, digits: int = 12) -> DataFrame:
    """rows (unique ``key``, ``size`` in bytes, ``group`` to keep together) with
    ``shard`` and ``slot``, which counts a shard's rows from 0 without a gap.

    ``capacity``: fixed; as few shards as the packing needs. Otherwise ``shards`` shards of
    nearly equal size. A group larger than the capacity, or than the average share, gets
    a shard of its own."""
    rows = spool(rows, "rows")  # what follows reads it thrice
    groups = rows.groupBy(group).agg(F.sum(size).alias("_bytes"))
    groups = ranked(groups.withColumn("_class", size_class(F.col("_bytes"), digits)), [F.col("_class").desc(), F.col(group)], "_rank")
    groups = spool(groups, "groups")
    histogram = [(r["_class"], r["n"]) for r in groups.groupBy("_class").agg(F.count("*").alias("n")).collect()]
    runs = pack(histogram, capacity) if capacity else pack_into(histogram, shards)
    start, ranges = 0, []
    for _, b, n in runs:
        if ranges and ranges[-1][2] == b:
            ranges[-1] = (ranges[-1][0], start + n, b)
        else:
            ranges.append((start, start + n, b))
        start += n
    placed = _by_range(groups, ranges).select(F.col(group).alias("_g"), "shard") if ranges else groups.select(F.col(group).alias("_g"), F.lit(0).alias("shard"))
    out = rows.join(placed, F.col(group) == F.col("_g")).drop("_g")
    slots = ranked(out, [F.col("shard"), F.col(key)], "_n")
    first = slots.groupBy("shard").agg(F.min("_n").alias("_first"))
    return slots.join(F.broadcast(first), "shard").withColumn("slot", F.col("_n") - F.col("_first")).drop("_n", "_first")


def _by_range(groups: DataFrame, ranges: list[tuple[int, int, int]]) -> DataFrame:
    """The shard of each rank: the ranks of a run are dealt out as chunks of a bounded
    lookup, joined on the chunk number and filtered to the run."""
    spark = groups.sparkSession
    total = ranges[-1][1]
    chunk = max(1, -(-total // 4096))
    rows = [(c, a, b, s) for a, b, s in ranges for c in range(a // chunk, (b - 1) // chunk + 1)]
    lookup = spark.createDataFrame(rows, "_chunk long, _from long, _to long, shard int")
    chunked = groups.withColumn("_chunk", F.floor(F.col("_rank") / F.lit(chunk)))
    return chunked.join(F.broadcast(lookup), (chunked["_chunk"] == lookup["_chunk"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")))


def op3_sharding(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 7 of nearly equal bytes, equal texts together."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).cast("long").alias("text_crc32"),
        F.coalesce(F.sha2(F.col("text"), 256), F.lit("null")).alias("text_key"),
    )
    return shard(docs, "doc_id", "size", "text_key", shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )

"""Sequential choices: unique names inside a bounded listing, size-balanced batches over a bounded histogram, probes."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unique_in(names: list[str | None]) -> list[str | None]:
    """Later duplicates get _2, _3 before the extension, and never an existing name. What was used stays
    used, so a name goes on from the number where it stopped. Null stays null."""
    used: set[str] = set()
    last: dict[str, int] = {}
    out = []
    for name in names:
        made = name
        if name is not None and name in used:
            stem, dot, ext = name.rpartition(".")
            i = last.get(name, 1)
            while made in used:
                i += 1
                made = f"{stem}_{i}.{ext}" if dot else f"{name}_{i}"
            last[name] = i
        used.add(made)
        out.append(made)
    return out


def family(name: Column) -> Column:
    """What a name is without the numbers that end it before its extension: what ``unique_in`` makes of a name
    stays in its family, so names of two families never meet."""
    return F.regexp_replace(name, F.when(F.contains(name, F.lit(".")), F.lit(r"(?:_[1-9][0-9]*)+(?=\.[^.]*\z)")).otherwise(F.lit(r"(?:_[1-9][0-9]*)+\z")), F.lit(""))


def unique_names(rows: DataFrame, group: str, order: str, name: str) -> DataFrame:
    """(group, order, name, unique_name): in order, as ``unique_in`` names a listing. A name alone in its family gets its
    rank as number, and no task meets all its rows; a family of several names, of which one may be
    what another would become, is one task's, in order."""
    held = rows.select(group, order, name)
    schema = T.StructType([*held.schema.fields, T.StructField("unique_name", T.StringType())])
    tagged = held.withColumn("_family", family(F.col(name)))
    several = tagged.groupBy(group, "_family").agg(F.min(name).alias("_a"), F.max(name).alias("_z")).filter("_a < _z").select(F.col(group).alias("_g"), F.col("_family").alias("_f"))
    mine = F.col(group).eqNullSafe(F.col("_g")) & F.col("_family").eqNullSafe(F.col("_f"))
    # nothing but group and order is ranked: both uses of the ranges are one exchange then
    alone = tagged.join(several, mine, "left_anti").select(F.struct(F.col(group).alias("g"), F.col(name).alias("n")).alias("_of_name"), order)
    ranks = ranked(alone, "_of_name", order).select(F.col("_of_name.g").alias(group), order, F.col("_of_name.n").alias(name), "rank")
    extension = F.regexp_extract(name, r"\.[^.]*\z", 0)
    numbered = F.concat(F.substring(F.col(name), F.lit(1), F.length(name) - F.length(extension)), F.lit("_"), (F.col("rank") + 1).cast("string"), extension)
    single = ranks.select(group, order, name, F.when(F.col("rank") == 0, F.col(name)).otherwise(numbered).alias("unique_name"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable").drop(columns="_family")
        return pdf.assign(unique_name=unique_in(pdf[name].tolist()))

    return single.unionByName(tagged.join(several, mine, "left_semi").groupBy(group, "_family").applyInPandas(run, schema))


def balance(sizes: list[tuple[int, int]], batches: int, cap: int = 80_000) -> dict[int, int]:
    """Greedy: the largest first, each to the lightest batch (then the shortest); a size counts
    up to cap. ids by descending size then id."""
    import heapq

    heap = [(0, 0, b) for b in range(batches)]
    out = {}
    for size, key in sorted(((s, k) for k, s in sizes), key=lambda x: (-x[0], x[1])):
        load, count, b = heapq.heappop(heap)
        out[key] = b
        heapq.heappush(heap, (load + min(size, cap), count + 1, b))
    return out


def place(classes: list[tuple[int, int]], batches: int) -> list[tuple[list[int], list[int]]]:
    """The choices of ``balance`` for classes (size, how many), largest first: of each class the batches of
    its first documents one by one, then the order in which all batches take turns. Once the lightest
    batch, made heavier, is the heaviest, each takes one in turn and their order stays."""
    import bisect

    order = [(0, 0, b) for b in range(batches)]
    out = []
    for size, n in classes:
        lead: list[int] = []
        while n:
            load, count, b = order[0]
            after = (load + size, count + 1, b)
            if after > order[-1]:
                break
            order.pop(0)
            bisect.insort(order, after)
            lead.append(b)
            n -= 1
        turns = [b for _, _, b in order]
        rounds, rest = divmod(n, batches)
        order = sorted((load + size * (rounds + (k < rest)), count + rounds + (k < rest), b) for k, (load, count, b) in enumerate(order))
        out.append((lead, turns))
    return out


def ranked(rows: DataFrame, group: str, *order) -> DataFrame:
    """rows with their ``rank`` in the group, from 0, by a total order: ranks within the ranges of a sort and
    counts of the ranges before, so that no task ranks a whole group."""
    group_order = F.struct(F.col(group).isNull(), F.col(group))
    ranges = rows.repartitionByRange(group_order, *order).withColumn("_range", F.spark_partition_id())
    sizes = ranges.groupBy(group, "_range").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col(group).alias("_group"), F.col("_range").alias("_of"), before.alias("_start"))
    place_ = F.row_number().over(Window.partitionBy(group, "_range").orderBy(*order)) - 1
    held = ranges.withColumn("_place", place_).join(starts, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_of")))
    return held.withColumn("rank", F.col("_start") + F.col("_place")).drop("_range", "_place", "_group", "_of", "_start")


def size_balanced(docs: DataFrame, key: str, size: str, batches: int, group: str, cap: int = 80_000) -> DataFrame:
    """(group, key, size, batch): a group's documents over so many batches, as ``balance`` places them. Only a
    histogram of a group meets one task: its sizes up to cap, so cap + 1 rows at most. A document finds its batch
    by its rank. A null size counts as nothing."""
    rows = docs.select(group, key, size)
    bounded = F.least(F.coalesce(F.col(size), F.lit(0)), F.lit(cap)).cast("long")
    placed = ranked(rows, group, F.coalesce(F.col(size), F.lit(0)).desc(), F.col(key)).withColumn("_class", bounded)
    classes = rows.groupBy(F.col(group).alias("_group"), bounded.alias("_size")).agg(F.count("*").alias("_n"))
    some = T.ArrayType(T.IntegerType())
    schema = T.StructType([T.StructField("_group", rows.schema[group].dataType)]).add("_size", T.LongType()).add("_first", T.LongType()).add("_lead", some).add("_turns", some)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_size", ascending=False)
        found = place(list(zip(pdf["_size"].tolist(), pdf["_n"].tolist())), batches)
        first = pdf["_n"].cumsum() - pdf["_n"]
        return pd.DataFrame({"_group": pdf["_group"].to_numpy(), "_size": pdf["_size"].to_numpy(), "_first": first.to_numpy(), "_lead": [x for x, _ in found], "_turns": [x for _, x in found]})

    plan = classes.groupBy("_group").applyInPandas(run, schema)
    joined = placed.join(plan, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_class") == F.col("_size")))
    k = F.col("rank") - F.col("_first")
    batch = F.when(k < F.size("_lead"), F.get("_lead", k.cast("int"))).otherwise(F.get("_turns", ((k - F.size("_lead")) % batches).cast("int")))
    return joined.select(group, key, size, batch.alias("batch"))


def probes(docs: DataFrame, key: str, size: str, k: int = 6) -> DataFrame:
    """The k largest documents."""
    return docs.orderBy(F.col(size).desc(), key).limit(k)


def snapshot(docs: DataFrame, key: str, size: str, least: int, seed: str) -> DataFrame:
    """Documents of some length in a seeded order, named by opaque ids of that order's hash."""
    return docs.filter(F.col(size) >= least).withColumn("opaque", F.substring(F.sha2(F.concat_ws(":", F.lit(seed), F.col(key)), 256), 1, 12))

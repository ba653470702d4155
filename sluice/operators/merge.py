"""Null-preserving keyed merges.

``overwrite``: the newest value that isn't null wins, a null never erases. ``backfill``: what
is there wins, only nulls are filled. Within a batch, records of one key fold in the order of
``seq``, which must be total. Rows are never lost: a merge is an outer join. Null and blank are
the same in a nullable key part.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import parse_amount, parse_bid_price
from ..schemas import TableSpec


def _key(c: str, nullable: bool) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) if nullable else F.col(c)


def fold_batch(batch: DataFrame, keys: list[str], seq: Column, mode: str = "overwrite", nullable: tuple[str, ...] = ()) -> DataFrame:
    """One row a key: of each column the last non-null value in order (backfill: the first).
    One aggregate, combined before the shuffle, so a key with many records stays small."""
    pick: Callable = F.max_by if mode == "overwrite" else F.min_by
    on = [_key(k, k in nullable).alias(f"_k{i}") for i, k in enumerate(keys)]
    ordered = batch.select("*", *on, seq.alias("_order"))
    kept = [c for c in batch.columns if c not in keys or c in nullable]
    # an order by null sorts out the records where the column is null
    values = [pick(F.col(c), F.when(F.col(c).isNotNull(), F.col("_order"))).alias(c) for c in kept]
    folded = ordered.groupBy([f"_k{i}" for i in range(len(keys))]).agg(*values)
    return folded.select(*(F.col(c) if c in kept else F.col(f"_k{keys.index(c)}").alias(c) for c in batch.columns))


def merge_upsert(target: DataFrame, batch: DataFrame, keys: list[str], seq: Column, mode: str = "overwrite", nullable: tuple[str, ...] = (), now: Column | None = None) -> DataFrame:
    """target with batch merged in; columns of either side are kept (schema healing). With
    ``now``, first_seen and last_seen are managed."""
    new = fold_batch(batch, keys, seq, mode, nullable)
    columns = target.columns + [c for c in new.columns if c not in target.columns]
    t = target.select(*target.columns, *(_key(k, k in nullable).alias(f"_k{i}") for i, k in enumerate(keys)), F.lit(True).alias("_old")).alias("t")
    b = new.select(*new.columns, *(_key(k, k in nullable).alias(f"_k{i}") for i, k in enumerate(keys)), F.lit(True).alias("_new")).alias("b")
    joined = t.join(b, [F.col(f"t._k{i}") == F.col(f"b._k{i}") for i in range(len(keys))], "full_outer")

    def value(c: str) -> Column:
        sides = [F.col(f"{s}.{c}") for s, d in (("t", target), ("b", new)) if c in d.columns]
        if c not in keys and mode == "overwrite":
            sides.reverse()
        return F.coalesce(*sides).alias(c)

    out = [value(c) for c in columns if now is None or c not in ("first_seen", "last_seen")]
    if now is not None:
        first = F.col("t.first_seen") if "first_seen" in target.columns else F.lit(None)
        last = F.col("t.last_seen") if "last_seen" in target.columns else F.lit(None)
        out += [F.coalesce(first, now).alias("first_seen"), F.when(F.col("b._new"), now).otherwise(last).alias("last_seen")]
    return joined.select(*out)


def merge_metrics(target: DataFrame, merged: DataFrame, keys: list[str]) -> DataFrame:
    """(rows_before, rows_after, rows_added): distinct rows, as apart from upserts issued."""
    before, after = target.agg(F.count("*").alias("rows_before")), merged.agg(F.count("*").alias("rows_after"))
    return before.join(after).withColumn("rows_added", F.col("rows_after") - F.col("rows_before"))


def derived(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The machine's amounts, added where rows are written so that no source can forget them."""
    names = spec.schema.fieldNames()
    for c in [n for n in names if f"{n}_numeric" in names and n in df.columns]:
        parse = parse_bid_price if c == "bid_price" else parse_amount
        df = df.withColumn(f"{c}_numeric", parse(F.col(c)))
    return df


def write_batch(target: DataFrame, batch: DataFrame, spec: TableSpec, seq: Column, mode: str, now: Column) -> DataFrame:
    """A batch of a declared table, derived columns and all, merged."""
    return merge_upsert(target, derived(batch, spec), list(spec.keys), seq, mode, spec.nullable_keys, now)


def key_value(c: str, spec: TableSpec) -> Column:
    """A key part as merges compare it."""
    return _key(c, c in spec.nullable_keys)


def healed_keys(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """batch with all key columns, of their declared types."""
    types = {f.name: f.dataType for f in spec.schema}
    return batch.withColumns({k: (F.col(k) if k in batch.columns else F.lit(None)).cast(types[k]) for k in spec.keys})


def heal(df: DataFrame, spec: TableSpec) -> DataFrame:
    """df with the declared columns it lacks as nulls and its types as declared; no row is lost,
    and no column either."""
    empty = df.sparkSession.createDataFrame([], spec.schema)
    healed = df.unionByName(empty, allowMissingColumns=True)
    types = {f.name: f.dataType for f in spec.schema}
    return healed.select(*(F.col(c).cast(types[c]).alias(c) if c in types else F.col(c) for c in healed.columns))


def rebuild_by_source(target: DataFrame, fresh: DataFrame, source_column: str = "source") -> DataFrame:
    """Of each source in fresh, fresh replaces all rows; a source of which nothing was derived
    keeps its rows, so an empty derivation deletes nothing."""
    derived_from = fresh.select(source_column).distinct()
    return target.join(derived_from, source_column, "left_anti").select(*target.columns).unionByName(fresh, allowMissingColumns=True)


def prune(target: DataFrame, stale: DataFrame, keys: list[str]) -> DataFrame:
    return target.join(stale.select(*keys).distinct(), keys, "left_anti")


def update_where(df: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """A conditional update over the whole table; what the condition leaves null stays."""
    return df.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})

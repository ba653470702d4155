"""The archive: a folder of keyed tables (``keyed.KeyedTable``) with the declared schemas.

A change rewrites the buckets of the keys that it touches and then commits, so readers never see a
table that is being changed, and a table may be derived from itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .keyed import KeyedTable
from .operators import merge
from .schemas import EXPORT_TABLES, TABLES

#: The column that says in which order a feed's records came; never stored.
ARRIVAL = "_arrival"


class Archive:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 4):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    def table(self, name: str) -> KeyedTable:
        spec = TABLES[name]
        return KeyedTable(self.spark, f"{self.root}/{name}", list(spec.keys), spec.nullable_keys, self.buckets)

    def version(self, name: str) -> int:
        return self.table(name).commit().number

    def read(self, name: str) -> DataFrame:
        held = self.table(name).read()
        return self._healed(name, held)

    def _healed(self, name: str, held: DataFrame | None) -> DataFrame:
        return merge.heal(held, TABLES[name]) if held is not None else self.spark.createDataFrame([], TABLES[name].schema)

    def replace(self, name: str, df: DataFrame) -> None:
        self.table(name).replace(df)

    def put(self, name: str, rows: DataFrame) -> None:
        """Changed rows in place of those with their keys; the other buckets stay as they are."""
        self.table(name).put(merge.heal(rows, TABLES[name]))

    def upsert(self, name: str, batch: DataFrame, mode: str, seq: Column | None = None, now: Column | None = None) -> tuple[int, int]:
        """Merge a batch; (upserts issued, rows added). Rows of one key come in the order ``seq``, or else
        that of column ``_arrival``; a batch that has neither must hold each key once. Columns whose names
        begin with _ order rows and aren't stored."""
        spec, t = TABLES[name], self.table(name)
        if seq is None and ARRIVAL not in batch.columns:
            once = merge.healed_keys(batch, spec).groupBy(*(merge.key_value(k, spec) for k in spec.keys)).count().filter("count > 1")
            if not once.isEmpty():
                raise ValueError(f"{name}: rows of one key, and no order in which they came")
        ordered = merge.healed_keys(batch, spec).withColumn("_seq", seq if seq is not None else F.col(ARRIVAL) if ARRIVAL in batch.columns else F.lit(0))
        keyed = ordered.drop(*(c for c in batch.columns if c.startswith("_")))
        at = now if now is not None else F.current_timestamp()
        before = t.commit().count
        after = t.change(keyed, lambda old, new: merge.write_batch(self._healed(name, old), new, spec, F.col("_seq"), mode, at).drop("_seq"))
        return batch.count(), after.count - before

    def rebuild(self, name: str, fresh: DataFrame) -> int:
        """Replace the rows of the sources in fresh; nothing if nothing was derived."""
        if fresh.isEmpty():
            return 0
        self.replace(name, merge.rebuild_by_source(self.read(name), merge.derived(fresh, TABLES[name])))
        return fresh.count()

    def vacuum(self, keep: int = 2) -> int:
        """Remove what no kept commit of any table names."""
        return sum(self.table(t).vacuum(keep) for t in TABLES if self.version(t))

    def counts(self) -> DataFrame:
        from .export.dictionary import table_counts

        return table_counts({t: self.read(t) for t in EXPORT_TABLES})

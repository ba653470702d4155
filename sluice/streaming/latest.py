"""The newest known values of each key as state of a stream: ``transformWithState`` with one value
state a key, which nulls never erase and older records never overwrite.

The state of a key is bounded by its columns, whatever the number of its records, and lives in the
state store of the task that owns the key; checkpoints make it survive a restart. Each micro-batch
gives the present values of the keys that it changed.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..keyed import KeyedTable

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Latest(StatefulProcessor):
    """Of each column the value of the last record, by ``seq``, that has one."""

    def __init__(self, keys: list[str], seq: str, columns: list[str], state: T.StructType, mode: str = "overwrite"):
        self.keys, self.seq, self.columns, self.schema, self.mode = keys, seq, columns, state, mode

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", self.schema)

    def handleInputRows(self, key, rows: Iterator[Row], timers) -> Iterator[Row]:
        n = len(self.columns)
        held = list(self.held.get()) if self.held.exists() else [None] * (2 * n)
        changed = not self.held.exists()
        for row in rows:
            at = row[self.seq]
            for k, c in enumerate(self.columns):
                # the order of a value and the value itself stand side by side
                if row[c] is not None and (held[2 * k] is None or (at > held[2 * k] if self.mode == "overwrite" else at < held[2 * k])):
                    held[2 * k], held[2 * k + 1] = at, row[c]
                    changed = True
        if changed:
            self.held.update(tuple(held))
            yield Row(**dict(zip((*self.keys, *self.columns), (*key, *held[1::2]))))

    def close(self) -> None:
        """Nothing to let go of."""


def latest_values(stream: DataFrame, keys: list[str], seq: str, mode: str = "overwrite") -> DataFrame:
    """The stream of changed keys with their present values (``backfill``: the first known values). ``seq``
    must not be null and orders the records of a key."""
    columns = [c for c in stream.columns if c not in (*keys, seq)]
    types = {f.name: f.dataType for f in stream.schema}
    state = T.StructType([T.StructField(f"{part}_{k}", types[seq] if part == "at" else types[c]) for k, c in enumerate(columns) for part in ("at", "value")])
    out = T.StructType([T.StructField(c, types[c]) for c in (*keys, *columns)])
    return stream.groupBy(*keys).transformWithState(Latest(keys, seq, columns, state, mode), outputStructType=out, outputMode="Update", timeMode="None")


def latest_into(stream: DataFrame, keys: list[str], seq: str, root: str, mode: str = "overwrite"):
    """Start latest_values, which needs the RocksDB state store, into a keyed table under root; (the table, the running query)."""
    spark = stream.sparkSession
    table, setting = KeyedTable(spark, f"{root}/latest", keys), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    spark.conf.set(setting, ROCKS)  # a query takes it over as it starts
    try:
        writer = latest_values(stream, keys, seq, mode).writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint")
        return table, writer.foreachBatch(lambda rows, number: table.put(rows)).trigger(availableNow=True).start()
    finally:
        spark.conf.unset(setting) if before is None else spark.conf.set(setting, before)

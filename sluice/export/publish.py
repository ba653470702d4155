"""Which versions of an export stay, and whether a new one may go out.

``retained``: the newest version, and the first of each month, for good. ``gate``: an export whose
assets are missing, or much smaller than when last published, is held back: a truncated one is worse than none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..keyed import KeyedTable


def retained(versions: DataFrame, at: str = "at") -> DataFrame:
    """versions (one row each, with a time) with ``kept`` and ``why``: newest, monthly or neither."""
    month = F.date_trunc("month", at)
    newest = versions.agg(F.max(at).alias("_newest"))
    first = F.row_number().over(Window.partitionBy(month).orderBy(at)) == 1
    why = F.when(F.col(at) == F.col("_newest"), "newest").when(first, "monthly")
    return versions.join(F.broadcast(newest)).withColumn("why", why).withColumn("kept", F.col("why").isNotNull()).drop("_newest")


def gate(manifest: DataFrame, published: DataFrame, least: float = 0.5) -> DataFrame:
    """(name, bytes, before, ok) of a manifest (name, bytes) against the last published one: every asset
    published before must be there, with at least such a share of its size, and nothing may be empty."""
    new, old = manifest.select("name", F.col("bytes")), published.select("name", F.col("bytes").alias("before"))
    ok = (F.coalesce("bytes", F.lit(0)) > 0) & (F.coalesce("bytes", F.lit(0)) >= F.coalesce("before", F.lit(0)) * least)
    return new.join(old, "name", "full_outer").withColumn("ok", ok)


def publish(log: KeyedTable, manifest: DataFrame, version: str, at, least: float = 0.5) -> DataFrame:
    """Record a version's manifest in the log (keyed by version and name), unless the gate holds it back, which
    raises; the versions of the log with what is to be kept of them."""
    held = log.read()
    if held is not None and not (refused := gate(manifest, last_published(held), least).filter("NOT ok")).isEmpty():
        names = sorted(r["name"] for r in refused.select("name").limit(20).collect())
        raise ValueError(f"{version} is held back: {', '.join(names)}")
    log.put(manifest.select(F.lit(version).alias("version"), F.lit(at).alias("at"), "name", "bytes"))
    return retained(log.read().groupBy("version").agg(F.max("at").alias("at"), F.sum("bytes").alias("bytes")))


def last_published(log: DataFrame) -> DataFrame:
    """The manifest (name, bytes) of the newest version."""
    newest = log.agg(F.max_by("version", F.struct("at", "version")).alias("version"))
    return log.join(F.broadcast(newest), "version").select("name", "bytes")

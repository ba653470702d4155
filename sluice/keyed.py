"""Keyed tables in buckets: a change reads and writes only the buckets that its keys fall in.

    root/data/<write>/bucket=<b>/part-*.parquet    rows, as one write left them
    root/commits/<n>.json                          of each bucket the write that holds it

A bucket is a hash class of the key. A change merges its rows with those of the buckets it touches,
writes these anew and then commits: a small file that names every bucket's write appears whole, by
a rename that fails where the number is taken. Until then readers see the table as it was, so a crash
changes nothing; what it left is removed by ``vacuum``. Writers that meet begin again on the new state
where they touched the same buckets; else what they wrote stands and only the commit is made anew.
Rows are in no particular order. The folder must be one that all executors share.
"""

from __future__ import annotations

import json
import threading
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class Conflict(Exception):
    """Another writer committed first."""


@dataclass(frozen=True)
class Commit:
    """What the table is after one change. ``rows`` and ``at`` are by bucket; ``done`` holds the last batch of each stream."""

    number: int = 0
    buckets: int = 0
    schema: dict = field(default_factory=dict)
    at: dict[int, str] = field(default_factory=dict)
    rows: dict[int, int] = field(default_factory=dict)
    done: dict[str, int] = field(default_factory=dict)
    written: tuple[int, ...] = ()

    @property
    def count(self) -> int:
        return sum(self.rows.values())


class Files:
    """The few file operations of a table, on whatever file system its root names."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.jvm, self.conf = spark, spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, at: str):
        return self.jvm.org.apache.hadoop.fs.Path(at)

    def names(self, folder: str) -> list[str]:
        at = self.path(folder)
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def exists(self, at: str) -> bool:
        return self.fs.exists(self.path(at))

    def read(self, at: str) -> str:
        stream = self.fs.open(self.path(at))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, at: str, text: str) -> bool:
        """Whether the file could be made: whole, and only if there was none."""
        draft = f"{at}.{uuid.uuid4().hex}.draft"
        stream = self.fs.create(self.path(draft), False)
        stream.write(text.encode())
        stream.close()
        from py4j.protocol import Py4JJavaError

        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(at).toUri(), self.conf)
        plain = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self.path(draft), self.path(at), plain)
            return True
        except Py4JJavaError as e:
            self.fs.delete(self.path(draft), False)
            if "FileAlreadyExists" in str(e.java_exception):
                return False
            raise

    def delete(self, at: str) -> None:
        self.fs.delete(self.path(at), True)


class KeyedTable:
    """``keys`` as in a merge; those in ``nullable`` take null and blank as one value. ``buckets`` is the number of a
    new table; an old one keeps its own until ``rebucket``."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], nullable: tuple[str, ...] = (), buckets: int = 16):
        self.spark, self.root, self.keys, self.nullable, self.buckets = spark, root.rstrip("/"), list(keys), nullable, buckets
        self.files, self._newest, self._turn = Files(spark, self.root), 0, threading.Lock()
        self._seen: dict[int, Commit] = {}  # the last commits, which never change

    def commits(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self.files.names(f"{self.root}/commits") if n.endswith(".json") and n[:-5].isdigit())

    def commit(self, number: int | None = None) -> Commit:
        """The newest commit, or an older one; number 0 stands for a table not yet written."""
        if not (number := self._last() if number is None else number):
            return Commit(0, self.buckets)
        if number in self._seen:
            return self._seen[number]
        c = json.loads(self.files.read(self._at(number)))
        return self._keep(Commit(c["number"], c["buckets"], c["schema"], {int(b): w for b, w in c["at"].items()}, {int(b): n for b, n in c["rows"].items()}, c["done"], tuple(c["written"])))

    def _keep(self, c: Commit) -> Commit:
        self._seen[c.number] = c
        for old in [n for n in list(self._seen) if n <= c.number - 32]:
            self._seen.pop(old, None)
        return c

    def _at(self, number: int) -> str:
        return f"{self.root}/commits/{number:012d}.json"

    def _last(self) -> int:
        """The newest commit's number, looked for from the last one seen on: numbers have no gaps, and listing all at each change would cost their square."""
        n = self._newest
        if not n or not self.files.exists(self._at(n)):
            n = max(self.commits(), default=0)
        while self.files.exists(self._at(n + 1)):
            n += 1
        self._newest = n
        return n

    def bucket(self, n: int) -> Column:
        """Equal keys have equal buckets, whatever their numeric types."""
        parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in self.keys]
        return F.pmod(F.xxhash64(*parts), F.lit(n)).cast("int")

    def read(self, number: int | None = None) -> DataFrame | None:
        """The table, or an older state of it; None before the first commit."""
        c = self.commit(number)
        return self._read(c, c.at) if c.number else None

    def _read(self, c: Commit, buckets) -> DataFrame:
        paths = [f"{self.root}/data/{c.at[b]}/bucket={b}" for b in sorted(buckets) if b in c.at]
        schema = T.StructType.fromJson(c.schema)
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema).limit(0)  # which the planner knows to be empty

    def change(self, batch: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], stream: tuple[str, int] | None = None, tries: int = 5) -> Commit:
        """``merge(old, batch)`` gives the new rows of the buckets that batch touches; old holds all their
        rows (None before the first commit), batch must have the key columns. A batch of a stream, (its
        name, its number), that was committed before changes nothing."""
        for k in range(tries):
            base = self.commit()
            if stream and base.done.get(stream[0], -1) >= stream[1]:
                return base
            touched = [r["b"] for r in batch.select(self.bucket(base.buckets).alias("b")).distinct().collect()]
            if not touched and not stream and base.number:
                return base
            old = self._read(base, touched) if base.number else None
            try:
                return self._write(base, touched, merge(old, batch), stream)
            except Conflict:
                if k == tries - 1:
                    raise
        raise AssertionError("unreachable")

    def replace(self, df: DataFrame) -> Commit:
        """All rows anew."""
        base = self.commit()
        return self._write(base, range(base.buckets), df, None)

    def put(self, rows: DataFrame) -> Commit:
        """Rows as they are in place of those with their keys, which must be unique among them."""

        def merge(old: DataFrame | None, new: DataFrame) -> DataFrame:
            return new if old is None else self.without(old, new).unionByName(new, allowMissingColumns=True)

        return self.change(rows, merge)

    def without(self, old: DataFrame, gone: DataFrame) -> DataFrame:
        """The rows of old whose key isn't in gone."""
        k = lambda d: [(F.coalesce(d[c].cast("string"), F.lit("")) if c in self.nullable else d[c]) for c in self.keys]
        o, g = old.alias("o"), gone.select(*(c.alias(f"_k{i}") for i, c in enumerate(k(gone)))).distinct()
        return o.join(g, [a == F.col(f"_k{i}") for i, a in enumerate(k(old))], "left_anti")

    def rebucket(self, buckets: int) -> Commit:
        """The same rows in another number of buckets: to be grown so that a bucket stays a task's worth."""
        base = self.commit()
        return self._write(Commit(base.number, buckets, base.schema, done=base.done), range(buckets), self._read(base, base.at), None)

    def _write(self, base: Commit, touched, df: DataFrame, stream: tuple[str, int] | None) -> Commit:
        touched = sorted(touched)
        write = f"{base.number + 1:012d}-{uuid.uuid4().hex}"
        at = {b: w for b, w in base.at.items() if b not in set(touched)}
        rows = {b: n for b, n in base.rows.items() if b in at}
        if touched:
            dealt = df.withColumn("bucket", self.bucket(base.buckets))
            dealt.repartition(min(len(touched), 1024), "bucket").write.partitionBy("bucket").parquet(f"{self.root}/data/{write}")
            written = self._sizes(write)
            at |= {b: write for b in written}
            rows |= written
        schema = json.loads(df.schema.json())
        for f in schema["fields"]:
            f["nullable"] = True
        done = base.done | ({stream[0]: stream[1]} if stream else {})
        new = Commit(base.number + 1, base.buckets, schema, at, rows, done, tuple(touched))
        with self._turn:  # writers of one process needn't meet
            while True:
                if self._last() > base.number:
                    new = self._onto(base.number, new, stream)
                try:
                    self._commit(new)
                    return new
                except Conflict:
                    if self._last() < new.number:
                        raise

    def _onto(self, seen: int, new: Commit, stream: tuple[str, int] | None) -> Commit:
        """new after the commits that came since ``seen``; Conflict where one of these touched its buckets, has other buckets or columns, or the stream's batch."""
        since = [self.commit(n) for n in range(seen + 1, self._last() + 1)]
        mine = set(new.written)
        if any(c.buckets != new.buckets or c.schema != new.schema or mine & set(c.written) or (stream and c.done.get(stream[0], -1) >= stream[1]) for c in since):
            raise Conflict(f"{self.root} has changed since commit {seen}")
        last = since[-1]
        over = lambda old, own: {b: x for b, x in old.items() if b not in mine} | {b: x for b, x in own.items() if b in mine}
        done = last.done | ({stream[0]: stream[1]} if stream else {})
        return replace(new, number=last.number + 1, at=over(last.at, new.at), rows=over(last.rows, new.rows), done=done)

    def _sizes(self, write: str) -> dict[int, int]:
        found = [int(n[7:]) for n in self.files.names(f"{self.root}/data/{write}") if n.startswith("bucket=")]
        if not found:
            return {}
        counted = self.spark.read.schema("bucket int").parquet(f"{self.root}/data/{write}").groupBy("bucket").count()
        return {r["bucket"]: r["count"] for r in counted.collect()}

    def _commit(self, c: Commit) -> None:
        text = json.dumps({"number": c.number, "buckets": c.buckets, "schema": c.schema, "at": c.at, "rows": c.rows, "done": c.done, "written": c.written})
        if not self.files.create(f"{self.root}/commits/{c.number:012d}.json", text):
            raise Conflict(f"{self.root} has commit {c.number} already")
        self._keep(c)

    def vacuum(self, keep: int = 2) -> int:
        """Remove all commits but the newest ``keep``, and every write that none of these names: those of
        older states and those of writers that never committed. Not to be run beside a writer. The number of writes removed."""
        numbers = self.commits()
        for n in numbers[:-keep]:
            self.files.delete(f"{self.root}/commits/{n:012d}.json")
        named = {(w, b) for n in numbers[-keep:] for b, w in self.commit(n).at.items()}
        held = {w for w, _ in named}
        removed = 0
        for write in self.files.names(f"{self.root}/data"):
            if write not in held:
                self.files.delete(f"{self.root}/data/{write}")
                removed += 1
                continue
            for name in self.files.names(f"{self.root}/data/{write}"):
                if name.startswith("bucket=") and (write, int(name[7:])) not in named:
                    self.files.delete(f"{self.root}/data/{write}/{name}")
        return removed

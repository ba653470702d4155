"""Zipped CSV as a Python data source: ``df.write.format("zipped_csv")``.

Rows are (member, line): the lines of each file of the zip. Each task deflates what it holds of a
member to a part beside the target; parts end at a byte's edge, so that joined one after the other they are one
deflated stream, and their checksums combine. The commit writes the zip: headers, and the parts'
bytes as they are. A task or a job that fails leaves no zip. Only compressed bytes are copied, in pieces of
a megabyte; no line passes the driver. The target is a path that all machines mount.
"""

from __future__ import annotations

import json
import os
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Bytes held before they go to the deflater, and copied at once.
CHUNK = 1 << 20
#: The bits of an empty last block: what ends a deflated stream.
_END = b"\x03\x00"
_POLYNOMIAL = 0xEDB88320


def _times(a: int, b: int) -> int:
    """The product of two polynomials over GF(2), modulo that of CRC-32; the highest bit is x^0."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (_POLYNOMIAL if b & 1 else 0)
    return out


def combined_crc(first: int, second: int, length: int) -> int:
    """The CRC-32 of two strings joined, from theirs and the length of the second."""
    shift, power, n = 1 << 31, 1 << 23, length  # x^0, and x^8 for each byte
    while n:
        if n & 1:
            shift = _times(shift, power)
        power, n = _times(power, power), n >> 1
    return _times(shift, first) ^ second


@dataclass
class Part:
    member: str
    place: tuple[int, int]
    path: str
    crc: int
    size: int
    packed: int


class _Deflated:
    """One part being written."""

    def __init__(self, member: str, place: tuple[int, int], path: str):
        self.part, self.deflater, self.held, self.n = Part(member, place, path, 0, 0, 0), zlib.compressobj(6, zlib.DEFLATED, -15), [], 0
        self.out = open(path, "wb")

    def add(self, line: bytes) -> None:
        self.held.append(line)
        self.n += len(line)
        if self.n >= CHUNK:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        data = b"".join(self.held)
        self.held, self.n = [], 0
        self.part.crc = zlib.crc32(data, self.part.crc)
        self.part.size += len(data)
        packed = self.deflater.compress(data) + (self.deflater.flush(zlib.Z_FULL_FLUSH) if last else b"")
        self.part.packed += len(packed)
        self.out.write(packed)

    def close(self) -> Part:
        self._flush(last=True)
        self.out.close()
        return self.part


@dataclass
class Parts(WriterCommitMessage):
    parts: list[Part]


def _entry(member: str, crc: int, packed: int, size: int) -> tuple[bytes, bytes]:
    """The header before a member's bytes, and what follows the signature in the directory; both with 64-bit sizes."""
    name = f"{member}.csv".encode()
    common = struct.pack("<HHHHHIII", 45, 0x800, 8, 0, 0x21, crc, 0xFFFFFFFF, 0xFFFFFFFF)
    local = b"PK\x03\x04" + common + struct.pack("<HH", len(name), 20) + name + struct.pack("<HHQQ", 1, 16, size, packed)
    return local, common


def join(target: str, headers: dict[str, str], parts: list[Part]) -> None:
    """Write the zip beside the target and move it there."""
    draft, directory = f"{target}.{uuid.uuid4().hex}.draft", []
    with open(draft, "wb") as out:
        for member, header in headers.items():
            own = sorted((p for p in parts if p.member == member), key=lambda p: p.place)
            first = (header + "\n").encode()
            deflater = zlib.compressobj(6, zlib.DEFLATED, -15)
            top = deflater.compress(first) + deflater.flush(zlib.Z_FULL_FLUSH)
            crc, size, packed = zlib.crc32(first), len(first), len(top) + len(_END)
            for p in own:
                crc, size, packed = combined_crc(crc, p.crc, p.size), size + p.size, packed + p.packed
            local, common = _entry(member, crc, packed, size)
            at = out.tell()
            out.write(local + top)
            for p in own:
                with open(p.path, "rb") as f:
                    shutil.copyfileobj(f, out, CHUNK)
            out.write(_END)
            name = f"{member}.csv".encode()
            directory.append(b"PK\x01\x02" + struct.pack("<H", 45) + common + struct.pack("<HHHHHII", len(name), 28, 0, 0, 0, 0, 0xFFFFFFFF) + name + struct.pack("<HHQQQ", 1, 24, size, packed, at))
        start = out.tell()
        out.write(b"".join(directory))
        end, n = out.tell(), len(directory)
        out.write(b"PK\x06\x06" + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, n, n, end - start, start) + b"PK\x06\x07" + struct.pack("<IQI", 0, end, 1))
        out.write(b"PK\x05\x06" + struct.pack("<HHHHIIH", 0, 0, min(n, 0xFFFF), min(n, 0xFFFF), 0xFFFFFFFF, 0xFFFFFFFF, 0))
    os.replace(draft, target)


class ZipWriter(DataSourceWriter):
    def __init__(self, options: dict):
        self.target, self.headers = options["path"], json.loads(options["headers"])
        self.folder = f"{self.target}.{uuid.uuid4().hex}.parts"

    def write(self, iterator: Iterator) -> Parts:
        os.makedirs(self.folder, exist_ok=True)
        context, parts, now = TaskContext.get(), [], None
        for row in iterator:
            if now is None or row["member"] != now.part.member:
                if now is not None:
                    parts.append(now.close())
                now = _Deflated(row["member"], (context.partitionId(), len(parts)), f"{self.folder}/{context.taskAttemptId()}-{len(parts)}")
            now.add(row["line"].encode() + b"\n")
        return Parts(parts + ([now.close()] if now is not None else []))

    def commit(self, messages: list) -> None:
        join(self.target, self.headers, [p for m in messages if m is not None for p in m.parts])
        shutil.rmtree(self.folder, ignore_errors=True)

    def abort(self, messages: list) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


class ZippedCsv(DataSource):
    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def schema(self) -> str:
        return "member string, line string"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return ZipWriter(dict(self.options))


def csv_line(df: DataFrame) -> DataFrame:
    """(line): each row as a line of CSV; a null is an empty field, an empty text a quoted one, and what
    a field holds of quotes, commas and line ends stays, in quotes."""

    def field(c: str, kind: str):
        text = F.to_json(c) if kind.startswith(("array", "struct", "map")) else F.col(c).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text.isNull(), "").when((text == "") | text.rlike('[",\r\n]') | text.rlike("^\\s|\\s$"), quoted).otherwise(text)

    return df.select(F.concat_ws(",", *(field(f"`{c}`", t) for c, t in df.dtypes)).alias("line"))


def zip_csv(tables: dict[str, DataFrame], target: str) -> str:
    """One zip of a CSV a table, in the order of its partitions."""
    spark: SparkSession = next(iter(tables.values())).sparkSession
    spark.dataSource.register(ZippedCsv)
    headers = {name: ",".join(f'"{c.replace(chr(34), chr(34) * 2)}"' if set(c) & set('",\r\n') else c for c in d.columns) for name, d in tables.items()}
    lines = [csv_line(d).select(F.lit(name).alias("member"), "line") for name, d in tables.items()]
    whole = lines[0]
    for one in lines[1:]:
        whole = whole.unionByName(one)
    whole.write.format("zipped_csv").mode("append").option("headers", json.dumps(headers)).save(target.removeprefix("file://").removeprefix("file:"))
    return target

"""Word codes of many texts at once, and the byte forms in which arrays travel."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_M64 = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 5
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, _M64, 256, dtype=np.uint64)
_BYTE[32] = 0
#: Odd multipliers by purpose and place.
MIX = _RNG.integers(1, _M64, (4, 64), dtype=np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words:
    """Word codes of many texts: a polynomial of each word's bytes, by prefix sums. With
    ``star``, a word with a digit gets that code."""

    def __init__(self, star: int | None = None):
        self.star = star
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            n = max(n, 1 << 20)
            for name, base in (("power", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                x = np.full(n, base, np.uint64)
                x[0] = 1
                setattr(self, name, np.multiply.accumulate(x))

    def codes(self, texts: list[bytes], chunk: int = 1 << 20) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """(codes of all words, words of each text, the words)."""
        split = [t.split() for t in texts]
        counts = np.array([len(w) for w in split], np.int64)
        parts, held, size = [], [], 0
        for w in split:
            if w:
                held.append(b" ".join(w))
                size += len(held[-1]) + 1
            if size >= chunk:
                parts.append(self._hash(b" ".join(held) + b" "))
                held, size = [], 0
        if held:
            parts.append(self._hash(b" ".join(held) + b" "))
        return np.concatenate(parts) if parts else np.zeros(0, np.uint64), counts, split

    def _hash(self, joined: bytes) -> np.ndarray:
        buf = np.frombuffer(joined, np.uint8)
        self._grow(len(buf))
        ends = np.flatnonzero(buf == 32)
        total = np.cumsum(_BYTE[buf] * self.power[: len(buf)])
        starts = np.concatenate([[0], ends[:-1] + 1])
        at_end = total[ends]
        before = np.concatenate([np.zeros(1, np.uint64), at_end[:-1]])
        codes = mix((at_end - before) * self.inverse[starts] + (ends - starts).astype(np.uint64))
        if self.star is not None:
            digits = np.concatenate([[0], np.cumsum((buf >= 48) & (buf <= 57))])
            codes[digits[ends] > digits[starts]] = self.star
        return codes


def planes(x: np.ndarray) -> bytes:
    """Numbers under 2**32 as the byte planes of their steps: where they rise slowly, planes of zeros compress away."""
    return np.diff(x.astype("<u4"), prepend=np.zeros(1, "<u4")).view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(b: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(4, -1).T).view("<u4").ravel(), dtype=np.uint32).astype(np.int64)


def five(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def from_five(b: bytes) -> np.ndarray:
    x = np.zeros((len(b) // 5, 8), np.uint8)
    x[:, :5] = np.frombuffer(b, np.uint8).reshape(-1, 5)
    return x.view("<u8").ravel().astype(np.uint64)


def tables(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """The rows of each value of column, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        x = b.column(b.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(x[1:] != x[:-1]) + 1).tolist(), len(x)]
        for s, e in zip(cuts, cuts[1:]):
            if e > s:
                if held and held[0].column(held[0].schema.get_field_index(column))[0].as_py() != x[s]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(b.slice(s, e - s))
    if held:
        yield pa.Table.from_batches(held)

"""Quality rules by line sequence labelling: a linear-chain conditional random field.

Every line that has a word gets a small set of yes/no features, so a line is one of a
bounded number of feature masks. The field has two labels, content and boilerplate;
Viterbi decoding marks the lines of a document, and the share of its words that stand in
content lines decides whether it is kept, after the counting rules (too few words, too
many repeated passages).

The field is fitted on the driver on a bounded sample of labelled rows: at most
``train_documents`` (parameter) rows, those whose ids hash lowest, however many rows an id has; of each only the
feature masks and lengths of its first ``train_lines`` (parameter) lines travel. Labels are of documents, so the lines' are latent:
in good documents a line starts as content, unless it has rights or licence wording; in bad ones
as what its features speak for, by their odds between bad and good documents. Then, in turns, a field is
fitted and the lines take the labels it decodes, as long as a bad document keeps a boilerplate line
and a good one its content. So documents of both kinds of lines are in the fit, and the moves
between labels are learnt too. Without labels of both kinds the prior weights below are used.

A null text has no words and no lines, as has an empty one: base_failed, not kept. Very
long texts are read whole, every line of any length with all its features. Equal rows, and rows that
repeat an id or lack one, are judged each by its own text; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_rows, batch, table

_SYMBOL = re.compile(r"[#*$%&|<>]")
#: Names of the features, by bit.
FEATURES = (
    "short line", "very short line", "many symbols", "mostly capitals", "words repeat within the line",
    "equals an earlier line", "ends as a sentence does", "exclamation marks in a row", "rights or licence wording", "has a digit",
)
#: Weights towards content where nothing can be fitted: bias, then one a feature.
PRIOR = (2.0, -0.3, -0.3, -3.0, -3.0, -3.0, -1.0, 0.5, -2.0, -1.5, 0.0)
_LICENCE = re.compile(r"licen[cs]ed? under")
_LEGAL_BIT = 8
_DIGIT = re.compile(r"[0-9]")


def _legal(line: str) -> bool:
    low = line.lower()
    return "rights reserved" in low or "copyright" in low or "(c)" in low or "©" in low or ("licen" in low and bool(_LICENCE.search(low)))


def line_mask(line: str, words: list[str], symbols: int, duplicate: bool) -> int:
    n = len(words)
    mask = (n <= 8) | (n <= 3) << 1 | (symbols * 20 > len(line)) << 2 | duplicate << 5
    mask |= (2 * sum(map(str.isupper, words)) > n and n > 2) << 3
    mask |= (n > 5 and 2 * len(set(words)) < n) << 4
    mask |= (words[-1][-1] in ".!?:…\"'»)") << 6 | ("!!" in line) << 7
    mask |= _legal(line) << _LEGAL_BIT | bool(_DIGIT.search(line)) << 9
    return int(mask)


class Profile:
    """What the rules need of one text."""

    __slots__ = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "masks", "sizes")

    def __init__(self, text: str, window: int = 8):
        words, seen, self.masks, self.sizes = [], set(), [], []
        self.n_dup_lines = self.n_symbols = 0
        for line in text.split("\n"):
            found = WORD.findall(line)
            symbols = len(_SYMBOL.findall(line))
            self.n_symbols += symbols
            if found:
                duplicate = line in seen
                seen.add(line)
                self.n_dup_lines += duplicate
                self.masks.append(line_mask(line, found, symbols, duplicate))
                self.sizes.append(len(found))
                words += found
        self.n_words, self.word_chars = len(words), sum(map(len, words))
        self.n_repeat_words = repeated_words(words, window)


_ODD = np.array([pow(0x9E3779B97F4A7C15, k + 1, 1 << 64) for k in range(64)], np.uint64)


def repeated_words(words: list[str], window: int = 8) -> int:
    """Words that stand in a window of so many words found at least twice in the list. A hash
    finds candidates; where it finds any, ranks that double (1, 2, 4, 8 words) decide exactly."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids = defaultdict(count().__next__)
    a = np.fromiter(map(ids.__getitem__, words), np.uint64, len(words))
    if len(ids) == len(words):
        return 0
    h = np.zeros(n, np.uint64)
    for k in range(window):
        h += (a[k : k + n] + np.uint64(1)) * _ODD[k]
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return 0
    rank, width = a.astype(np.int64), 1
    while width < window:
        step = min(width, window - width)
        pair = rank[: len(rank) - step] * (int(rank.max()) + 1) + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
        width += step
    often = np.bincount(rank)[rank] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, np.flatnonzero(often), 1)
    np.add.at(marks, np.flatnonzero(often) + window, -1)
    return int((np.cumsum(marks[:-1]) > 0).sum())


class Field:
    """A linear-chain CRF over feature masks; label 1 is content."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves  # (features + 1,) towards content; (2, 2) from, to
        bits = (np.arange(1 << len(FEATURES))[:, None] >> np.arange(len(FEATURES))) & 1
        self.emit = (bits @ weights[1:] + weights[0]).tolist()
        self.pairs = moves.tolist()

    @classmethod
    def prior(cls) -> Field:
        return cls(np.array(PRIOR), np.array([[0.5, -0.5], [-0.5, 0.5]]))

    def decode(self, masks: list[int]) -> list[int]:
        """Viterbi: the best labels. Ties go to content."""
        (aa, ab), (ba, bb) = self.pairs
        emit, back, x, y = self.emit, [], 0.0, 0.0
        first = True
        for m in masks:
            e = emit[m]
            if first:
                x, y, first = 0.0, e, False
                continue
            to_x, to_y = (0, x + aa) if x + aa > y + ba else (1, y + ba), (0, x + ab) if x + ab > y + bb else (1, y + bb)
            back.append((to_x[0], to_y[0]))
            x, y = to_x[1], to_y[1] + e
        if not masks:
            return []
        label = int(y >= x)
        out = [label]
        for b in reversed(back):
            label = b[label]
            out.append(label)
        return out[::-1]

    @classmethod
    def fit(cls, sequences: list[tuple[list[int], list[int]]], rounds: int = 120, rate: float = 1.0, decay: float = 1e-4, decay_moves: float = 1e-2, chunk: int = 32) -> Field:
        """Gradient ascent on the conditional likelihood of (masks, labels), forward-backward over padded
        chunks of ``chunk`` lines (whole texts, however long, are cut into as many chunks as needed)."""
        parts = [(m[k : k + chunk], y[k : k + chunk]) for m, y in sequences for k in range(0, len(m), chunk)]
        if len({y for _, labels in parts for y in labels}) < 2:
            return cls.prior()
        n, d = len(parts), len(FEATURES) + 1
        masks, on = np.zeros((n, chunk), np.int64), np.zeros((n, chunk), bool)
        labels = np.zeros((n, chunk), np.int64)
        for i, (m, y) in enumerate(parts):
            masks[i, : len(m)], labels[i, : len(m)], on[i, : len(m)] = m, y, True
        x = np.concatenate([np.ones((n, chunk, 1)), (masks[..., None] >> np.arange(d - 1)) & 1], axis=2)
        lines = on.sum()
        seen = (x * (on & (labels == 1))[..., None]).sum((0, 1)) / lines
        real = np.zeros((2, 2))
        both = on[:, 1:] & on[:, :-1]
        np.add.at(real, (labels[:, :-1][both], labels[:, 1:][both]), 1)
        real /= lines
        w, t = np.array(PRIOR), np.zeros((2, 2))
        gw, gt = np.zeros(d), np.zeros((2, 2))
        for _ in range(rounds):
            e = np.stack([np.zeros((n, chunk)), x @ w], axis=2)
            fwd, bwd = np.zeros((n, chunk, 2)), np.zeros((n, chunk, 2))
            fwd[:, 0] = e[:, 0]
            for k in range(1, chunk):
                step = np.logaddexp.reduce(fwd[:, k - 1, :, None] + t, axis=1) + e[:, k]
                fwd[:, k] = np.where(on[:, k, None], step, fwd[:, k - 1])
            for k in range(chunk - 2, -1, -1):
                step = np.logaddexp.reduce(t + (e[:, k + 1] + bwd[:, k + 1])[:, None, :], axis=2)
                bwd[:, k] = np.where(on[:, k + 1, None], step, bwd[:, k + 1])
            z = np.logaddexp.reduce(fwd[:, -1], axis=1)
            p = np.exp(fwd + bwd - z[:, None, None])[..., 1] * on
            joint = np.exp(fwd[:, :-1, :, None] + t + (e[:, 1:] + bwd[:, 1:])[:, :, None, :] - z[:, None, None, None]) * on[:, 1:, None, None]
            dw, dt = seen - (x * p[..., None]).sum((0, 1)) / lines - decay * w, real - joint.sum((0, 1)) / lines - decay_moves * t
            gw, gt = gw + dw * dw, gt + dt * dt
            w = w + rate * dw / (np.sqrt(gw) + 1e-8)
            t = t + rate * dt / (np.sqrt(gt) + 1e-8)
        return cls(w, t)


def evidence(documents: list[tuple[list[int], list[int], int]]) -> np.ndarray:
    """What each feature mask speaks for boilerplate: the sum of its features' log odds between the
    lines of bad and of good documents, of (masks, sizes, good)."""
    seen = np.ones((2, len(FEATURES)))
    lines = np.full(2, 2.0)
    for masks, _, good in documents:
        seen[good] += ((np.array(masks)[:, None] >> np.arange(len(FEATURES))) & 1).sum(axis=0)
        lines[good] += len(masks)
    rate = seen / lines[:, None]
    bits = (np.arange(1 << len(FEATURES))[:, None] >> np.arange(len(FEATURES))) & 1
    return np.log(np.where(bits, rate[0] / rate[1], (1 - rate[0]) / (1 - rate[1]))).sum(axis=1)


def fit_lines(documents: list[tuple[list[int], list[int], int]], turns: int = 2, content_share: float = 0.5) -> tuple[Field, list[list[int]]]:
    """A field, and the line labels on which it was fitted, from (masks, sizes, good) of documents."""
    if len({good for _, _, good in documents}) < 2:
        return Field.prior(), [[int(good)] * len(masks) for masks, _, good in documents]
    speaks = evidence(documents)
    labels = []
    for masks, _, good in documents:
        if good:
            labels.append([1 - (m >> _LEGAL_BIT & 1) for m in masks])
        else:
            most = max(speaks[m] for m in masks)
            labels.append([int(speaks[m] < min(most, 0.0)) if most <= 0 else int(speaks[m] <= 0) for m in masks])
    for turn in range(turns):
        field = Field.fit([(masks, y) for (masks, _, _), y in zip(documents, labels)])
        if turn + 1 < turns:
            for i, (masks, sizes, good) in enumerate(documents):
                told = [y & ~(m >> _LEGAL_BIT) & 1 for m, y in zip(masks, field.decode(masks))]
                content = sum(n for n, y in zip(sizes, told) if y)
                if (content >= content_share * sum(sizes)) if good else (0 in told):
                    labels[i] = told
    return field, labels


def train(docs: DataFrame, labels: DataFrame, key: str, text: str, target: str = "quality", train_documents: int = 2000, train_lines: int = 2000) -> Field:
    """A field fitted on at most ``train_documents`` labelled rows, ``train_lines`` lines of each."""
    return fit_lines(sample(docs, labels, key, text, target, train_documents, train_lines))[0]


def sample(docs: DataFrame, labels: DataFrame, key: str, text: str, target: str = "quality", train_documents: int = 2000, train_lines: int = 2000) -> list[tuple[list[int], list[int], int]]:
    """(masks, sizes, good) of at most ``train_documents`` labelled rows with lines, of the first ``train_lines`` lines of each."""
    chosen = labels.filter(F.col(key).isNotNull() & F.col(target).isNotNull()).select(F.col(key).cast("long").alias("_k"), F.col(target).cast("int").alias("_y"))
    chosen = chosen.groupBy("_k").agg(F.max("_y").alias("_y")).orderBy(F.xxhash64("_k"), "_k").limit(train_documents)
    of = docs.select(F.col(key).cast("long").alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(chosen), "_k").select("_k", "_y", "text")
    schema = pa.schema([("k", pa.int64()), ("y", pa.int32()), ("masks", pa.list_(pa.int32())), ("sizes", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            profiles = [Profile(t) for t in b.column(2).to_pylist()]
            yield batch(schema, [b.column(0), b.column(1), [p.masks[:train_lines] for p in profiles], [p.sizes[:train_lines] for p in profiles]])

    profiled = of.mapInArrow(run, "k long, y int, masks array<int>, sizes array<int>").filter("size(masks) > 0")
    rows = profiled.orderBy(F.xxhash64("k"), "k", F.xxhash64("masks", "sizes")).limit(train_documents).collect()  # a heap a task
    rows.sort(key=lambda r: (r["k"], r["masks"], r["sizes"]))
    return [(r["masks"], r["sizes"], int(r["y"] > 0)) for r in rows if r["masks"]]


def judge(docs: DataFrame, key: str, text: str, field: Field, **limits) -> DataFrame:
    """Counts and verdict of every row, with n_content_words, the words in content lines."""
    arrow_rows(docs.sparkSession)
    longs = ("key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_content_words")
    schema = pa.schema([(c, pa.int64()) for c in longs] + [("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[] for _ in schema.names]
            for k, value in zip(b.column(0).to_pylist(), b.column(1)):
                p = Profile(value.as_py())
                for col, x in zip(cols, (k, p.n_words, p.word_chars, p.n_symbols, p.n_dup_lines, p.n_repeat_words, *verdict(p, field, **limits))):
                    col.append(x)
            yield batch(schema, cols)

    source = docs.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return source.mapInArrow(run, ", ".join(f"{c} long" for c in longs) + ", base_failed boolean, kept boolean").withColumnRenamed("key", key)


def verdict(p: Profile, field: Field, content_share: float = 0.5, least_words: int = 20, most_repeated: int = 30) -> tuple[int, bool, bool]:
    """(words in content lines, base_failed, kept) of one text."""
    content = sum(s for s, y in zip(p.sizes, field.decode(p.masks)) if y)
    failed = p.n_words < least_words or 100 * p.n_repeat_words > most_repeated * p.n_words
    return content, failed, not failed and content >= content_share * p.n_words


def keep_good(docs: DataFrame, text: str, field: Field, **limits) -> DataFrame:
    """The rows that are kept, with all their columns; nothing is shuffled."""
    arrow_rows(docs.sparkSession)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array([verdict(Profile(v.as_py() or ""), field, **limits)[2] for v in b.column(place)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    """Every document judged by the counting rules and the field."""
    docs = table(spark, sf_dir, "documents")
    return judge(docs, "doc_id", "text", train(docs, table(spark, sf_dir, "labels"), "doc_id", "text"))

"""URL filters: a bit-parallel wildcard automaton (Shift-And over many globs at once).

All glob rules are laid side by side in one bit vector of 64-bit words. A state is
one position of one rule; reading a character moves every live state of every rule
by a shift, a carry between words and two masks:

    live = ((live << 1) & enter[char]) | (live & stay[char])

``enter`` holds the states whose character this is, ``stay`` those that sit before
a wildcard. A batch of URLs runs in step, one array operation a character, and a
URL whose states have all died leaves the batch.

Globs match a canonical URL ``.host/path``: ``*`` is any run without ``/``, ``**``
any run, ``?`` one character but ``/``, all else itself.

A null URL, or one without ``://``, has an empty host and path and matches no rule.
Very long URLs are read whole. Repeated rows get equal verdicts; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch, table

#: (verdict, rule): a rule is a host and a path prefix; it fits the host and its subdomains.
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
#: Globs of the method itself, for URLs that no rule fits: (verdict, glob). The rest is allowed.
GLOBS = (
    ("block", "**/wp-login*"),
    ("block", "**/cart/**"),
    ("block", "**.doubleclick.net/**"),
    ("block", "**/*.zip"),
)


class Automaton:
    """The masks of a list of globs and their simulation over a batch of strings."""

    def __init__(self, globs: list[str]):
        moves: list[tuple[int, str]] = []  # (state entered, its character, "" for the start)
        loops: dict[int, bool] = {}  # state -> whether "/" is in the loop too
        self.starts, self.ends, state = [], [], 0
        for glob in globs:
            self.starts.append(state)
            i = 0
            while i < len(glob):
                if glob.startswith("**", i):
                    loops[state] = True
                    i += 2
                elif glob[i] == "*":
                    loops.setdefault(state, False)
                    i += 1
                else:
                    state += 1
                    moves.append((state, glob[i]))
                    i += 1
            self.ends.append(state)
            state += 1
        self.words = state // 64 + 1
        chars = sorted({c for _, c in moves if c != "?"} | {"/"})
        self.code = {c: k + 1 for k, c in enumerate(chars)}  # 0: any other character
        self.enter = np.zeros((len(chars) + 1, self.words), np.uint64)
        self.stay = np.zeros_like(self.enter)
        for s, c in moves:
            for k in range(len(chars) + 1) if c == "?" else (self.code[c],):
                if c != "?" or k != self.code["/"]:
                    self.enter[k, s // 64] |= np.uint64(1 << (s % 64))
        for s, slash in loops.items():
            for k in range(len(chars) + 1):
                if slash or k != self.code["/"]:
                    self.stay[k, s // 64] |= np.uint64(1 << (s % 64))
        self.first = np.zeros(self.words, np.uint64)
        for s in self.starts:
            self.first[s // 64] |= np.uint64(1 << (s % 64))

    def run(self, texts: list[str]) -> np.ndarray:
        """A boolean for each text and glob."""
        n = len(texts)
        final = np.zeros((n, self.words), np.uint64)
        if not n:
            return np.zeros((0, len(self.ends)), bool)
        order = np.argsort([-len(t) for t in texts], kind="stable")
        points = [np.frombuffer(texts[i].encode("utf-32-le"), np.uint32) for i in order]
        lengths = np.array([len(p) for p in points])
        offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        flat = np.concatenate(points) if lengths.sum() else np.zeros(0, np.uint32)
        codes = np.zeros(len(flat), np.int64)
        for c, k in self.code.items():
            codes[flat == ord(c)] = k
        live, alive, at = np.tile(self.first, (n, 1)), np.arange(n), 0
        while len(alive):
            done = lengths[alive] == at
            if done.any():
                final[order[alive[done]]] = live[done]
                alive, live = alive[~done], live[~done]
                if not len(alive):
                    break
            k = codes[offsets[alive] + at]
            shifted = live << np.uint64(1)
            shifted[:, 1:] |= live[:, :-1] >> np.uint64(63)
            live = (shifted & self.enter[k]) | (live & self.stay[k])
            lost = ~live.any(axis=1)
            if lost.any():
                alive, live = alive[~lost], live[~lost]
            at += 1
        return np.stack([(final[:, e // 64] >> np.uint64(e % 64)) & np.uint64(1) for e in self.ends], axis=1).astype(bool)


def rule_glob(rule: str) -> str:
    """The glob of a host-and-path rule over the canonical ``.host/path``."""
    return f"*.{rule}**"


def host_and_path(url: str | None) -> tuple[str, str]:
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    cut = min((p for p in map(rest.find, "?#") if p >= 0), default=len(rest))
    slash = rest.find("/", 0, cut)
    host = rest[: slash if slash >= 0 else cut]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host) if not host.islower() else host, rest[slash:cut] if slash >= 0 else ""


def judge(pages: DataFrame, url: str, key: str, rules=RULES, globs=GLOBS, default: str = "allow") -> DataFrame:
    """key, host, path, rule (the longest that fits, else null), verdict. Of rules equally
    long, the first listed wins."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][1]), i))
    ranked = [rules[i] for i in order]
    automaton = Automaton([rule_glob(r) for _, r in ranked] + [g for _, g in globs])
    schema = pa.schema([("key", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = [host_and_path(u) for u in b.column(1).to_pylist()]
            found = automaton.run([f".{h}{p}" if h else "" for h, p in parts])
            rule: list[str | None] = [None] * len(parts)
            verdict = [default] * len(parts)
            for k in range(len(ranked) + len(globs) - 1, -1, -1):
                for i in np.flatnonzero(found[:, k]):
                    if k < len(ranked):
                        verdict[i], rule[i] = ranked[k]
                    else:
                        verdict[i] = globs[k - len(ranked)][0]
            yield batch(schema, [b.column(0), [h for h, _ in parts], [p for _, p in parts], rule, verdict])

    source = pages.select(F.col(key).cast("long").alias("key"), F.col(url).alias("url"))
    return source.mapInArrow(run, "key long, host string, path string, rule string, verdict string").withColumnRenamed("key", key)


def op4_url_filters(spark, sf_dir: str) -> DataFrame:
    """Every page's URL, judged."""
    return judge(table(spark, sf_dir, "pages"), "url", "page_id")

"""Byte-level BPE vocabularies: pre-tokens, whole-token proofs, counts and ids.

Vocabulary files are public tokenizers' ``.json`` files; their path is always a parameter.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import cache, lru_cache

import numpy as np
import regex

#: Texts of these characters only (ASCII, Latin letters with signs, common punctuation) are
#: split by PRETOKEN; the letters and digits among them are known, so that ``re`` does it. All
#: other texts are split by PATTERN, of the same classes over all of Unicode.
PLAIN = re.compile("[^\t\n\r\x20-\x7e\xa0-ɏ‐-‧‰-⁞]")
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_DIGIT = "0-9²³¹¼-¾"
_SPACE = "\t\n\r \xa0"
#: The contractions and classes by which byte-level BPE vocabularies split text.
PRETOKEN = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
#: The same split over all of Unicode.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A run that a quadratic merge must not get.
_LONG_RUN = re.compile(r"\S{4000}")


def load(path: str):
    """The vocabulary by its own library, one thread, special strings handled as by default."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the others get the letters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


def token_bytes(path: str) -> tuple[dict[bytes, int], dict[str, int], bool]:
    """The vocabulary as bytes -> id, its special strings, and whether ids follow the merges."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    letters = _byte_letters()
    vocab = spec["model"]["vocab"]
    ranks = {bytes(letters[c] for c in t): i for t, i in vocab.items() if all(c in letters for c in t)}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
    ids = [vocab.get(a + b, -1) for a, b in merges]
    ordered = all(x < y for x, y in zip(ids, ids[1:])) and len(ranks) == 256 + len(merges)
    return ranks, {t["content"]: t["id"] for t in spec["added_tokens"] if t["special"]}, ordered


#: Ranges of code points that the proof tries: the basic plane, symbols and the larger set of ideographs.
_TRIED = ((1, 0xD800), (0xE000, 0x10000), (0x1F000, 0x1FB00), (0x20000, 0x2A6E0))


@cache
def odd_characters(path: str) -> str:
    """A pattern of the code points that PATTERN and the library's own split class differently, such
    as one of the two doesn't know yet, and of those not tried: each is tried among letters, digits, signs and spaces."""
    tok, split = load(path), regex.compile(PATTERN)

    def differ(chars: list[str]) -> bool:
        text = "".join(f"a{x}b {x} 1{x}2  {x}{x}a.{x}\n" for x in chars)
        return [text[i:j] for _, (i, j) in tok.pre_tokenizer.pre_tokenize_str(text)] != split.findall(text)

    points, last = [], 0
    for first, end in _TRIED:
        points += range(last, first)
        last = end
        for at in range(first, end, 16):
            some = [chr(c) for c in range(at, min(at + 16, end))]
            points += [ord(x) for x in some if differ([x])] if differ(some) else []
    return _character_class([*points, *range(last, 0x110000)])


def _character_class(points: list[int]) -> str:
    """A pattern of any of the code points, as ranges; one that never matches for none."""
    ranges: list[list[int]] = []
    for c in points:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]" if ranges else r"(?!)"


class Proof:
    """What is proven offline, once on the driver: the whole tokens of a vocabulary, and the
    characters over which the split of pre-tokens is the library's."""

    def __init__(self, path: str):
        self.path, self.odd = path, odd_characters(path)
        self.whole = whole_tokens(path, self.odd)


@lru_cache(maxsize=2)
def proof(path: str) -> Proof:
    return Proof(path)


def whole_tokens(path: str, odd: str) -> list[str]:
    """Vocabulary strings that are a pre-token by themselves and that the library encodes,
    alone, as one token. A string that merges cannot reach isn't among them."""
    tok, proven = load(path), []
    ranks, special, _ = token_bytes(path)
    strange, split = re.compile(odd), regex.compile(PATTERN)
    strings = []
    for b, i in ranks.items():
        try:
            text = b.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if text not in special and not strange.search(text) and split.fullmatch(text):
            strings.append((text, i))
    for at in range(0, len(strings), 5000):
        part = strings[at : at + 5000]
        for (text, i), e in zip(part, tok.encode_batch([t for t, _ in part], add_special_tokens=False)):
            if e.ids == [i]:
                proven.append(text)
    return proven


class TokenCounter:
    """Counts of tokens. A pre-token proven to be a whole token counts one; the others are
    merged, once each while they fit a cache of ``entries`` and ``size`` characters. Special strings
    are split out first and count one each. Only texts with characters that the proof excludes, or
    of vocabularies whose special strings take white space with them, go to the library whole."""

    def __init__(self, proof: Proof, entries: int = 700_000, size: int = 24 << 20):
        self.tok, self.entries, self.size = load(proof.path), entries, size
        self.whole = dict.fromkeys(proof.whole, 1)
        self.counts, self.held = dict(self.whole), 0
        self.odd, self.split = re.compile(proof.odd), regex.compile(PATTERN)
        added = self.tok.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]
        self.plain = not any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added)
        self.cut = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")

    def pretokens(self, text: str) -> tuple[list[str], int] | None:
        """The pre-tokens of a text and its special strings; None where the library must do it."""
        if any(s in text for s in self.special):
            if not self.plain:
                return None
            parts = self.cut.split(text)
            found = [self.pretokens(x) for x in parts]
            return None if None in found else ([p for x, _ in found for p in x], len(parts) - 1)
        if not PLAIN.search(text):
            return PRETOKEN.findall(text), 0
        return None if self.odd.search(text) else (self.split.findall(text), 0)

    def count(self, texts: list[str]) -> list[int]:
        out, group, held = [0] * len(texts), [], 0
        for k, text in enumerate(texts):
            pieces = self.pretokens(text)
            if pieces is None:
                out[k] = len(self.tok.encode(text, add_special_tokens=False).ids)
                continue
            group.append((k, *pieces))
            held += len(text)
            if held > 4_000_000:
                self._count(group, out)
                group, held = [], 0
        self._count(group, out)
        return out

    def _count(self, group: list[tuple[int, list[str], int]], out: list[int]) -> None:
        counts = self.counts
        rest = list({p for _, pieces, _ in group for p in pieces if p not in counts})
        for at in range(0, len(rest), 5000):
            part = rest[at : at + 5000]
            counts.update(zip(part, (len(e.ids) for e in self.tok.encode_batch(part, add_special_tokens=False))))
        get = counts.__getitem__
        for k, pieces, more in group:
            out[k] = sum(map(get, pieces)) + more
        self.held += sum(map(len, rest))
        if self.held > self.size or len(counts) > self.entries:
            self.counts, self.held = dict(self.whole), 0


_COUNTERS: dict[str, TokenCounter] = {}


def counter(path: str, proof: Callable[[], Proof]) -> TokenCounter:
    """The counter of a vocabulary, one a worker: tasks that follow each other there share its tables."""
    if path not in _COUNTERS:
        _COUNTERS.clear()  # one vocabulary at a time
        _COUNTERS[path] = TokenCounter(proof())
    return _COUNTERS[path]


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to the library's. Where ids follow
    the merges, the rank-based encoder does it, several times as fast; very long runs without
    white space, on which that one is quadratic, and characters of ``odd`` go to the library."""

    def __init__(self, path: str, odd: str):
        self.path, self.tok, self.odd = path, None, re.compile(odd)  # the library is loaded where a text needs it
        ranks, special, ordered = token_bytes(path)
        self.fast, self.special = None, set(special)
        if ordered:
            import tiktoken

            self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def ids(self, text: str) -> bytes:
        if self.fast is not None and (len(text) < 4000 or not _LONG_RUN.search(text)) and not (PLAIN.search(text) and self.odd.search(text)):
            return self.fast.encode_to_numpy(text, allowed_special=self.special, disallowed_special=()).astype("<u4", copy=False).tobytes()
        self.tok = self.tok or load(self.path)
        return np.asarray(self.tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@lru_cache(maxsize=1)
def encoder(path: str, odd: str) -> Encoder:
    """The encoder of a vocabulary, one a worker."""
    return Encoder(path, odd)

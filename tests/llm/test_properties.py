"""Properties of the pure parts, over generated inputs."""

import llm_tools as tools
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import packing, quality, sharding, simhash, substring, token_count, wordcodes
from sluice.llm.bpe import Encoder, Proof, TokenCounter, load
from sluice.llm.common import release, spool

PATH = token_count.vocabulary()
LIBRARY, ENCODER = load(PATH), Encoder(PATH, Proof(PATH).odd)
COUNTER = TokenCounter(Proof(PATH))


@given(st.lists(st.integers(0, 3000), max_size=60), st.integers(1, 6), st.integers(1, 40))
def test_packer_places_every_token_once(sizes, open_windows, least_cut):
    packer = packing.Packer(100, open_windows, least_cut, 0)
    filled: dict[int, list] = {}
    for n in sizes:
        at = 0
        for start, length, seq, offset in sorted(packer.cuts(n)):
            assert start == at and length > 0
            at += length
            filled.setdefault(seq, []).append((offset, length))
        assert at == n
        assert len(packer.rooms) <= open_windows
    for pieces in filled.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 100


@given(st.lists(st.tuples(st.integers(1, 5000), st.integers(1, 50)), min_size=1, max_size=30, unique_by=lambda x: x[0]), st.integers(1, 9))
def test_packing_into_shards_places_every_group(histogram, shards):
    runs = sharding.pack_into(histogram, shards)
    placed: dict[int, int] = {}
    for size, shard, n in runs:
        assert 0 <= shard < shards
        placed[size] = placed.get(size, 0) + n
    assert placed == dict(histogram)


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="ab'st 019\n\t.,!éßñª² \u0085’漢😀​\x1c<|>", max_size=60))
def test_tokens_equal_the_library(text):
    ids = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ENCODER.ids(text), "<u4").tolist() == ids
    assert COUNTER.count([text]) == [len(ids)]


@given(st.integers(0, 2**64 - 1), st.lists(st.integers(0, 63), max_size=3, unique=True))
def test_three_bits_always_leave_a_chain(x, bits):
    y = x
    for b in bits:
        y ^= 1 << b
    d = np.array([x ^ y] * 4, np.uint64)
    ok = simhash.chain_ok(d, np.arange(4))
    assert ok.any()
    segment = [(x ^ y) >> 16 * k & 0xFFFF for k in range(4)]
    assert any(ok[k] and segment[k] == 0 and (segment[(k + 1) % 4] & 0xFF == 0 or segment[(k + 1) % 4] >> 8 == 0) for k in range(4))


@given(st.lists(st.sampled_from("abc"), max_size=80), st.integers(2, 8))
def test_repeated_words(words, window):
    windows = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(window)}
    assert quality.repeated_words(words, window) == len(marked)


@given(st.lists(st.text(alphabet="ab1 \n\té", max_size=30), max_size=20))
def test_word_codes_follow_words(texts):
    codes, counts, split = wordcodes.Words().codes([t.encode() for t in texts])
    words = [w for t in texts for w in tools.WORDS.findall(t)]
    assert counts.tolist() == [len(tools.WORDS.findall(t)) for t in texts] and [w.decode() for ws in split for w in ws] == words
    assert len(set(zip(words, codes.tolist()))) == len(set(words)) == len(set(codes.tolist()))
    starred = wordcodes.Words(7).codes([t.encode() for t in texts])[0]
    assert [c == 7 for c in starred] == ["1" in w for w in words]


@given(st.lists(st.sampled_from("abcd"), min_size=13, max_size=60))
def test_equal_windows_elect_equal_anchors(words):
    h, counts, _ = wordcodes.Words().codes([" ".join(words).encode()])
    w = substring.Windows(h, counts, 13, 6)
    anchors = {}
    for s, a in zip(w.start.tolist(), w.anchor.tolist()):
        assert anchors.setdefault(tuple(words[s : s + 13]), a) == a


@given(st.lists(st.integers(0, 2**32 - 1), max_size=50), st.lists(st.integers(0, 2**40 - 1), max_size=50))
def test_byte_forms_round_trip(a, b):
    assert wordcodes.from_planes(wordcodes.planes(np.array(a, np.int64))).tolist() == a
    assert wordcodes.from_five(wordcodes.five(np.array(b, np.uint64))).tolist() == b


def test_spool_and_release(spark):
    df = spool(spark.range(5))
    assert df.count() == 5 and release(spark) >= 1 and release(spark) == 0

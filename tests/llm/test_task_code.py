"""The parts that run inside one task, against brute force."""

import random

import numpy as np
import public_tokenizers as PT
import pyarrow as pa
import pytest
import regex

from repolens.llm import cuckoo, pretokens, simple8b
from repolens.llm.common import Stretches, code_points, text_parts
from repolens.llm.winnow import winnow

PARTS = ["'", "s", "t", "re", "ve", "ll", "m", "d", " ", "  ", "\n", "\t", "a", "é", "1", "２", "!", "，", "　", "\xa0", "👍", "x", "-"]


@pytest.mark.parametrize("size", [1 << 19, 64, 7])
def test_pre_tokens_are_the_matches_of_the_pattern(size):
    rng = random.Random(1)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 30))) for _ in range(3000)] + ["", None, "a" * 50 + " b" * 40]
    data, offsets = text_parts(pa.array(texts))
    start, _ = pretokens.pre_tokens(data, offsets, pretokens.classes(), size)
    end, raw, out = np.append(start[1:], len(data)), data.tobytes(), [[] for _ in texts]
    for i, a, b in zip(np.searchsorted(offsets, start, "right") - 1, start, end):
        out[i].append(raw[a:b].decode())
    assert out == [regex.findall(PT.PATTERN, t or "") for t in texts]


@pytest.mark.parametrize("n", [0, 1, 59, 60, 61, 4095, 4096, 4097, 9000])
@pytest.mark.parametrize("high", [2, 3, 1000, 50257, 1 << 40, 1 << 60, (1 << 64) - 1])
def test_simple8b_round_trip(n, high):
    x = np.random.default_rng(n).integers(0, high, n, dtype=np.uint64)
    x[50:90] = 0
    assert (simple8b.unpack(*simple8b.pack(x), n) == x).all()


def test_a_cut_shard_is_noticed():
    body = simple8b.group_bytes(np.array([1]), np.array([3]), np.array([1, 2, 3]))
    assert len(list(simple8b.read_groups(body + simple8b.MARKER.encode()))) == 1
    with pytest.raises(ValueError):
        list(simple8b.read_groups(body))


def test_winnowing_matches_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abé") for _ in range(n)) for n in (0, 1, 4, 5, 7, 12, 13, 40, 300)] + ["a" * 60]
    k, w = 5, 8
    cp, first = code_points(*text_parts(pa.array(texts)))
    hashes, positions, bounds = winnow(cp, first, k, w)
    for i, text in enumerate(texts):
        own = np.array([ord(c) for c in text], np.uint32)
        n = len(own)
        at = np.arange(max(n - k + 1, 1) if n else 0)
        h = (Stretches(own).of(at, np.minimum(at + k, n)) >> np.uint64(32)).astype(int).tolist()
        kept = []
        for j in range(max(len(h) - w + 1, 1) if h else 0):
            window = h[j : j + w]
            best = max(x for x in range(len(window)) if window[x] == min(window)) + j
            if not kept or kept[-1] != best:
                kept.append(best)
        assert positions[bounds[i] : bounds[i + 1]].tolist() == kept
        assert hashes[bounds[i] : bounds[i + 1]].tolist() == [h[x] for x in kept]


def test_cuckoo_filter_keeps_and_deletes():
    keys = np.arange(1, 20001) * 977
    table = cuckoo.empty(len(keys))
    assert cuckoo.insert(table, keys) and cuckoo.contains(table, keys).all()
    cuckoo.delete(table, keys[:10000])
    assert cuckoo.contains(table, keys[10000:]).all()
    assert cuckoo.contains(table, keys[:10000]).mean() < 0.01
    assert not cuckoo.insert(np.zeros((16, 4), np.uint16), np.arange(200), 20)


def thue_morse(n):
    w = "a"
    while len(w) < n:
        w += w.translate(str.maketrans("ab", "ba"))
    return w


def test_words_whose_hashes_meet_are_kept_apart():
    one = thue_morse(2048)
    other = one.translate(str.maketrans("ab", "ba"))
    data, offsets = text_parts(pa.array([one, other, one, other + " x"]))
    hashes = Stretches(data).of(offsets[:-1], offsets[1:])
    assert hashes[0] == hashes[1]
    _, codes = pretokens.pre_tokens(data, offsets, pretokens.classes())
    assert codes.tolist() == [0, 1, 0, 1, 2]
    for texts in ([one, other, "x"], ["x", other, one]):
        words = pa.array([t.encode() for t in texts], pa.large_binary())
        order, _ = pretokens.by_hash(words)
        assert [texts[i] for i in order if texts[i] != "x"] == sorted([one, other])

"""Pre-tokens of whole texts: where the public pattern splits, for many texts at once.

The pattern splits texts into contractions, runs of letters, of numbers and of other
characters with at most one space before them, and white space. With the
classes of the code points known, its matches follow from the bounds of the
runs; no text is cut at any length."""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np

from repolens.llm.common import Stretches, code_points, coded, row_groups, text_parts

PIECE = 1 << 19
OTHER, LETTER, NUMBER, SPACE = range(4)


def _table(found) -> np.ndarray:
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        table[np.frombuffer(found(pattern).encode("utf-32-le"), np.uint32)] = kind
    return table


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Classes as the pattern engine of the tiktoken library sees them; the
    tokenizers library sees the same (a test compares them)."""
    import tiktoken

    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)

    def found(pattern):
        one = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        return bytes(one.encode_ordinary(every)).decode()

    return _table(found)


def token_starts(cp: np.ndarray, begin: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Flags of the code points at which a match of the pattern begins.
    ``begin`` flags the first code point of each text, and the end."""
    n = len(cp)
    kind = table[cp]
    new = begin[:n].copy()
    new[1:] |= kind[1:] != kind[:-1]
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    run = kind[start]
    token = new
    # White space before something else: its last character stands alone, or
    # leads what follows if it is a space.
    before = end[(run == SPACE) & ~begin[end]]
    token[before - 1] = True
    token[before[cp[before - 1] == 32]] = False
    # 's 't 'm 'd 're 've 'll, where an apostrophe begins a match.
    q = start[(run == OTHER) & (end - start == 1)]
    q = q[(cp[q] == 39) & token[q] & ~begin[q + 1]]
    if len(q):
        c = np.append(cp, np.zeros(3, cp.dtype))
        c1, c2 = c[q + 1], np.where(begin[np.minimum(q + 2, n)], 0, c[q + 2])
        one = np.isin(c1, [ord(x) for x in "stmd"])
        two = ((c1 == ord("r")) & (c2 == ord("e"))) | ((c1 == ord("v")) & (c2 == ord("e"))) | ((c1 == ord("l")) & (c2 == ord("l")))
        token[q[one | two] + 1] = False
        after = np.concatenate([q[one] + 2, q[two] + 3])
        token[after[after < n]] = True
    return token


def _pieces(data: np.ndarray, offsets: np.ndarray, size: int):
    """Byte ranges of about ``size``: whole texts, and parts of long texts cut
    before white space that follows an ASCII character, where a match ends
    whatever stands around."""
    at, end = 0, int(offsets[-1])
    while at < end:
        stop = int(offsets[np.searchsorted(offsets, at + size, "right") - 1])
        if stop <= at:  # one text is longer
            limit = int(offsets[np.searchsorted(offsets, at, "right")])
            stop, look = limit, at + size
            while look < limit:
                part = data[look : min(look + 65536, limit)]
                cut = np.flatnonzero(((part[1:] == 32) | (part[1:] == 10)) & (part[:-1] > 32) & (part[:-1] < 127))
                if len(cut):
                    stop = look + int(cut[0]) + 1
                    break
                look += 65535
        yield at, stop
        at = stop


def token_bounds(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, size: int = PIECE) -> np.ndarray:
    """Start bytes of the pre-tokens of all texts, which cover the texts, and the end of the last."""
    starts = []
    for a, b in _pieces(data, offsets, size):
        part = data[a:b]
        inner = offsets[np.searchsorted(offsets, a, "left") : np.searchsorted(offsets, b, "right")] - a
        cp, first = code_points(part, np.concatenate([[0], inner, [b - a]]))
        begin = np.zeros(len(cp) + 1, bool)
        begin[first[1:]] = True
        begin[0] = True
        at = np.flatnonzero(token_starts(cp, begin, table))
        if len(cp) != len(part):
            at = np.flatnonzero((part & 0xC0) != 0x80)[at]
        starts.append(at + a)
    return np.concatenate([*starts, [len(data)]]).astype(np.int64)


def pre_tokens(data: np.ndarray, offsets: np.ndarray, table: np.ndarray, size: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """(start bytes, codes) of the pre-tokens of all texts; equal pre-tokens, and no others, have equal codes."""
    bounds = token_bounds(data, offsets, table, size)
    return bounds[:-1], coded(data, bounds)[0]


def by_hash(distinct) -> tuple[np.ndarray, np.ndarray]:
    """An order of distinct words that does not depend on how they were met, by hash and then by bytes, and their hashes in it."""
    data, at = text_parts(distinct)
    # Piece by piece: a hash depends on the word alone, and long prefix sums take memory.
    parts = [Stretches(data[at[i] : at[j]]).of(at[i:j] - at[i], at[i + 1 : j + 1] - at[i]) for i, j in row_groups(at, PIECE)]
    hashes = np.concatenate([np.zeros(0, np.uint64), *parts])
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    tied = np.flatnonzero(hashes[1:] == hashes[:-1])
    for run in np.split(tied, np.flatnonzero(np.diff(tied) > 1) + 1) if len(tied) else []:
        i, j = run[0], run[-1] + 2
        order[i:j] = sorted(order[i:j].tolist(), key=lambda k: distinct[k].as_py())
    return order, hashes


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a rank file: base64 token and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}

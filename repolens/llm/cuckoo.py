"""A cuckoo filter on numpy arrays: sets of 64-bit hashes with insertion and deletion.

A key has a 16-bit mark and two buckets of four marks; the second bucket follows
from the first and the mark alone, so marks can move without their keys."""

from __future__ import annotations

import numpy as np

from repolens.llm.common import mix64

SLOTS = 4
LOAD = 0.8


def empty(n_keys: int) -> np.ndarray:
    """A table with room for ``n_keys`` keys."""
    return np.zeros((1 << max(4, int(np.ceil(np.log2(max(1, n_keys) / LOAD / SLOTS)))), SLOTS), np.uint16)


def _marks(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix64(keys.astype(np.uint64))
    mark = (h >> np.uint64(48)).astype(np.uint16)
    return np.where(mark == 0, np.uint16(1), mark), (h & np.uint64(len(table) - 1)).astype(np.int64)


def _other(table: np.ndarray, mark: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    return bucket ^ (mix64(mark.astype(np.uint64)) & np.uint64(len(table) - 1)).astype(np.int64)


def _rank(values: np.ndarray) -> np.ndarray:
    """How many equal values stand before each."""
    order = np.argsort(values, kind="stable")
    sorted_ = values[order]
    start = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(values) else np.zeros(0, int)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values)) - np.repeat(start, np.diff(np.append(start, len(values))))
    return rank


def insert(table: np.ndarray, keys: np.ndarray, rounds: int = 400) -> bool:
    """Insert distinct keys; False if the table is too full (then build a larger one)."""
    mark, bucket = _marks(table, keys)
    for turn in range(rounds):
        if not len(mark):
            return True
        rank = _rank(bucket)
        taken = table[bucket] != 0
        room = SLOTS - taken.sum(1)
        put = rank < room
        slot = np.argsort(taken, axis=1, kind="stable")[np.arange(len(mark)), np.minimum(rank, SLOTS - 1)]
        table[bucket[put], slot[put]] = mark[put]
        mark, bucket, rank = mark[~put], bucket[~put], rank[~put]
        if turn == 0:  # the other bucket, before any mark has to move
            bucket = _other(table, mark, bucket)
            continue
        # One key a bucket takes the place of a mark, which goes to its other bucket.
        one = _rank(bucket) == 0
        slot = (mix64(bucket[one].astype(np.uint64) + np.uint64(turn)) & np.uint64(SLOTS - 1)).astype(np.int64)
        out = table[bucket[one], slot]
        full = out != 0
        table[bucket[one], slot] = mark[one]
        moved, at = out[full], bucket[one][full]
        mark = np.concatenate([mark[~one], moved])
        bucket = np.concatenate([bucket[~one], _other(table, moved, at)])
    return not len(mark)


def contains(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """True for every key inserted and not deleted, and seldom for others."""
    mark, bucket = _marks(table, keys)
    return (table[bucket] == mark[:, None]).any(1) | (table[_other(table, mark, bucket)] == mark[:, None]).any(1)


def delete(table: np.ndarray, keys: np.ndarray) -> None:
    """Delete keys that were inserted."""
    mark, bucket = _marks(table, keys)
    for m, a, b in zip(mark.tolist(), bucket.tolist(), _other(table, mark, bucket).tolist()):
        for i in (a, b):
            at = np.flatnonzero(table[i] == m)
            if len(at):
                table[i, at[0]] = 0
                break

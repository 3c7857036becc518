"""Helpers shared by the operators: text buffers and hashes inside a task,
connected components and ordered buckets across tasks."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.session import cut_lineage

_BASE = 0x9E3779B97F4A7C15 | 1
_WORD = (1 << 64) - 1


# --- inside a task ---------------------------------------------------------


def text_parts(array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, one text after another, and the
    offsets of its n + 1 bounds. A null is an empty text."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("" if not pa.types.is_binary(array.type) else b"")
    array = array.cast(pa.large_binary())
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1] if len(array) else np.zeros(1, np.int64)
    if data is None or at[-1] == at[0]:
        return np.zeros(0, np.uint8), at - at[0]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def row_groups(offsets: np.ndarray, limit: int):
    """Ranges (first, last + 1) of consecutive texts of about ``limit``
    bytes together; a longer text is a range of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


def code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts and the offsets of the texts in them."""
    if not len(data) or data.max() < 128:
        return data.astype(np.uint32), offsets
    heads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=heads[1:])
    cp = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
    return cp, heads[offsets]


def mix64(h: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit words."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=4)
def _powers(size: int, base: int) -> np.ndarray:
    p = np.full(size, base, np.uint64)
    p[0] = 1
    return np.cumprod(p)


def powers(n: int, inverse: bool = False) -> np.ndarray:
    size = 1 << max(16, int(n).bit_length())
    return _powers(size, pow(_BASE, -1, 1 << 64) if inverse else _BASE)


class Stretches:
    """Polynomial hashes modulo 2**64 of any stretches of an array of small
    integers, read off one prefix sum."""

    def __init__(self, values: np.ndarray):
        self.prefix = np.zeros(len(values) + 1, np.uint64)
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * powers(len(values))[: len(values)], out=self.prefix[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self.prefix[end] - self.prefix[start]) * powers(len(self.prefix), True)[start]
        return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def take_slices(values: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """values[start[i]:start[i] + length[i]] of all i, one after another."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(start - (ends - length), length) + np.arange(total)]


def slices(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The stretches of ``data`` between consecutive ``offsets``, as binary strings without a copy."""
    ends, body = np.ascontiguousarray(offsets, np.int64), np.ascontiguousarray(data)
    return pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(body)])


def coded(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A code for each stretch between ``offsets``, equal for equal bytes and for no others, and
    the distinct stretches by code. Stretches are compared byte by byte, not by a hash."""
    found = slices(data, offsets).dictionary_encode()
    return found.indices.to_numpy(zero_copy_only=False), found.dictionary


#: The bytes that separate words, space and 9 to 13.
BLANK = np.isin(np.arange(256), [32, *range(9, 14)])


def words_of(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the longest stretches without ``blank`` bytes, each within its text."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~blank[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    here, before = inside[1:], inside[:-1]
    start = np.flatnonzero(here & (~before | edge))
    end = np.flatnonzero(before & (~here | edge))
    return start, end


def packed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The disjoint ascending stretches [start, end) one after another, and their bounds."""
    step = np.zeros(len(data) + 1, np.int8)
    step[start] = 1
    step[end] -= 1
    keep = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
    return data[keep], np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)


def tidy() -> None:
    """Give memory of a finished group back to the system: idle Python workers keep theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidied(batches_to_batches):
    """The same function on batches, tidying up after each."""

    def run(batches):
        for b in batches_to_batches(batches):
            yield b
            tidy()

    return run


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


# --- across tasks ----------------------------------------------------------


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, as --py-files would, once per application."""
    context = spark.sparkContext
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if context.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    _SHIPPED.add(context.applicationId)
    packed = os.path.join(tempfile.mkdtemp(prefix="py-files-"), f"{os.path.basename(root)}.zip")
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f), os.path.relpath(os.path.join(folder, f), os.path.dirname(root)))
    context.addPyFile(packed)


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of all texts."""
    return df.select(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(id, component) of every id in ``edges`` (columns a, b, integers);
    component is the smallest id reachable.

    Each round hooks every vertex to its smallest neighbour and contracts the edges by the
    hooks; edges within one vertex go, and of what is left only local minima remain, at most
    half of the vertices. The hooks of all rounds are followed at the end. A round writes
    two tables to the shared checkpoint folder. A hub is pre-aggregated by the partial
    minimum, its join is split by AQE.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    e = cut_lineage(e, f"{name}-edges")
    hooks = []
    while not hooks or not e.isEmpty():
        both = e.union(e.select("b", "a"))
        hook = cut_lineage(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.min("a")).alias("p")), f"{name}-hooks")
        hooks.append(hook)
        pa_, pb = hook.select(F.col("v").alias("a"), F.col("p").alias("pa")), hook.select(F.col("v").alias("b"), F.col("p").alias("pb"))
        e = e.join(pa_, "a").join(pb, "b").select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).filter("a < b").distinct()
        e = cut_lineage(e, f"{name}-edges")
    labels = hooks[0].select(F.col("v").alias("id"), F.col("p").alias("component"))
    for i, hook in enumerate(hooks[1:]):
        labels = labels.join(hook, labels["component"] == hook["v"], "left").select("id", F.coalesce("p", "component").alias("component"))
        if i % 4 == 3:
            labels = cut_lineage(labels, f"{name}-labels")
    return cut_lineage(labels, f"{name}-labels")


def order_buckets(df: DataFrame, key: str, n: int, tie: Column | None = None, parts: int = 64) -> Column:
    """Number of the range of the integer ``key`` that a row is in, ascending, for about ``n`` ranges of
    equal counts; a null key is in the first. The cut points, one a range, come from Spark's own range
    partitioning of the key alone. A key that is a cut point (as one that fills a range is) has a range to
    itself, as null has, cut into ``parts`` by ``tie``, a 64-bit integer that orders rows of one key."""
    keys = df.select(F.col(key).cast("long").alias("k")).filter("k is not null").repartitionByRange(n, "k")
    found = keys.groupBy(F.spark_partition_id().alias("p")).agg(F.max("k").alias("top")).collect()
    cuts = np.array(sorted({r["top"] for r in found}), np.int64)

    @F.pandas_udf("long")
    def bucket(ids: pd.Series, ties: pd.Series) -> pd.Series:
        k = ids.fillna(0).to_numpy(np.int64)
        left, right = np.searchsorted(cuts, k, "left"), np.searchsorted(cuts, k, "right")
        at = np.where(ids.isna(), 0, 1 + left + right)  # odd: between two cuts, even: on one
        alone = np.isin(at, [0]) | (left != right)
        order = (ties.to_numpy(np.int64) ^ np.int64(-(1 << 63))).view(np.uint64)
        return pd.Series(at.astype(np.int64) * parts + np.where(alone, (order // np.uint64(-(-(1 << 64) // parts))).astype(np.int64), 0))

    return bucket(F.col(key).cast("long"), F.lit(0).cast("long") if tie is None else tie)

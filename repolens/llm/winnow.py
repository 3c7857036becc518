"""Document fingerprints by winnowing.

The hashes of all k-grams of code points are taken in order; of each window of w
consecutive hashes the smallest is kept, the rightmost of equal ones, with
its position. Any match of k + w - 1 code points between two texts shares a
kept hash; none shorter than k is seen. A text of fewer than k code points
is one gram; one of fewer than w grams is one window; an empty (or null) text
has no grams and an empty fingerprint.

Hash and position share one 64-bit word (hash above, position counted from the
end below), so one running minimum settles ties and keeps positions.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import Stretches, code_points, list_array, order_buckets, row_groups, text_parts, tidied
from repolens.session import cut_lineage

K, W = 24, 64
#: Ranges that rows are dealt into at most, and parts of a range that one key has to itself.
MAX_RANGES, PARTS = 1 << 14, 64
_LOW = np.uint64(0xFFFFFFFF)


def winnow(cp: np.ndarray, first: np.ndarray, k: int = K, w: int = W) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, positions, bounds) of the kept grams of texts of code points.
    ``first``: the n + 1 bounds of the texts; bounds: those of their fingerprints."""
    size = np.diff(first)
    n = int(first[-1])
    # Windows of a text cover its gram places 0 .. grams - 1; the rest of its places holds the maximum.
    grams = np.where(size > 0, np.maximum(size - k + 1, 1), 0)
    text = np.repeat(np.arange(len(size)), size)
    place = np.arange(n) - first[:-1][text]
    real = np.flatnonzero(place < grams[text])
    of, at = text[real], place[real]
    h = Stretches(cp).of(real, real + np.minimum(k, size[of]))
    key = (h & ~_LOW) | (_LOW - at.astype(np.uint64))
    # Runs of grams lie one after another; windows do not cross into the next run.
    run_end = np.cumsum(grams)
    low = key.copy()
    left = run_end[of] - np.arange(len(key))  # grams from here to the end of the text
    have = 1
    while have < w:
        step = min(have, w - have)
        far = np.flatnonzero(left > step)
        low[far] = np.minimum(low[far], low[far + step])
        have += step
    whole = (left >= w) | ((at == 0) & (grams[of] < w))
    kept, texts = low[whole], of[whole]
    new = np.ones(len(kept), bool)
    new[1:] = (kept[1:] != kept[:-1]) | (texts[1:] != texts[:-1])
    kept, texts = kept[new], texts[new]
    bounds = np.searchsorted(texts, np.arange(len(size) + 1))
    return (kept >> np.uint64(32)).astype(np.int64), (_LOW - (kept & _LOW)).astype(np.int32), bounds


def fingerprint(df: DataFrame, texts: dict[str, str], k: int = K, w: int = W) -> DataFrame:
    """``df`` with, for each (text column, prefix) of ``texts``, the columns <prefix>_hashes
    (array of 32-bit values as longs) and <prefix>_positions (code points from the start)."""
    places = [(df.columns.index(c), p) for c, p in texts.items()]
    added = [T.StructField(f"{p}_{x}", T.ArrayType(t)) for _, p in places for x, t in (("hashes", T.LongType()), ("positions", T.IntegerType()))]
    names = [f.name for f in df.schema.fields + added]

    def prints(batches):
        for batch in batches:
            longest = sum(np.diff(text_parts(batch.column(i))[1]) for i, _ in places)
            for a, b in row_groups(np.concatenate([[0], np.cumsum(longest)]), 1 << 20):
                part = batch.slice(a, b - a)
                columns = list(part.columns)
                for i, _ in places:
                    hashes, positions, bounds = winnow(*code_points(*text_parts(part.column(i))), k, w)
                    columns += [list_array(hashes, bounds, pa.int64()), list_array(positions, bounds, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(tidied(prints), T.StructType([*df.schema.fields, *added]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two lists of hashes as sets; 1 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def as_text(hashes: Column) -> Column:
    """The kept hashes in the order of the text, 8 hexadecimal digits each."""
    return F.concat_ws("", F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h), 8, "0"))))


def with_next(df: DataFrame, key: str, columns: list[str], n_ranges: int, prefix: str = "next_") -> DataFrame:
    """``df`` with ``columns`` of the next row in descending order of ``key`` under new names;
    the first row follows the last. Rows of one key are taken in the order of the hash of
    ``columns``; null keys come last.

    Rows are dealt into ranges of the key, at most ``MAX_RANGES``; a key that fills ranges, and null, by the hash too. The
    largest row of each range is sent to the range above as well, so that no range needs another: what is
    broadcast for that is a key a range, at most ``2 * MAX_RANGES`` and ``PARTS`` for each key that has a range to itself."""
    least = F.lit(-(1 << 63))
    dealt = df.withColumn("tie", F.xxhash64(*columns))
    dealt = dealt.withColumn("range", order_buckets(df, key, min(n_ranges, MAX_RANGES), F.col("tie"), PARTS))
    at = F.struct(F.coalesce(F.col(key).cast("long"), least).alias("k"), F.col("tie"))
    down = Window.orderBy(F.col("range").desc())  # one row a range
    tops = dealt.groupBy("range").agg(F.max(at).alias("top"))
    tops = tops.select("range", "top", F.coalesce(F.lag("range").over(down), F.min("range").over(Window.partitionBy())).alias("to"))
    own = F.struct(F.col("range").alias("r"), F.lit(1).alias("own"))
    also = F.struct(F.col("to").alias("r"), F.lit(0).alias("own"))
    rows = dealt.join(F.broadcast(cut_lineage(tops, "range-tops")), "range")
    rows = rows.withColumn("sent", F.explode(F.when(at == F.col("top"), F.array(own, also)).otherwise(F.array(own))))
    up = Window.partitionBy("sent.r").orderBy("sent.own", F.col(key).asc_nulls_first(), "tie")
    named = [F.lag(c).over(up).alias(f"{prefix}{c}") for c in columns]
    return rows.select(*df.columns, "sent", *named).filter("sent.own = 1").drop("sent")

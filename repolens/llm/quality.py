"""Quality rules with thresholds that follow the data: quantile sketches per language and source.

``measure`` counts words, symbols, repeated lines and repeated windows of each whole text.
``sketch`` turns the ratios of all documents into histograms on a fixed log-linear scale: a value
below 64 is a bucket of its own, above that 32 buckets lie between consecutive powers of two, so a
quantile read off is at most 1/32 too low. Sketches are rows (group, measure, bucket, count) and merge
by adding counts: one sketch per language and source, merged to one per language and one of all.
A group with fewer than ``least`` documents takes the sketch of its language, then that of all.
``thresholds`` reads median and upper and lower quantiles off a sketch and sets a bound beyond
them by ``spread`` times their distance from the median, so that the bulk of any language or
source passes, whatever its level. ``judge`` joins the bounds back and filters.

Nulls: a null text has no words; null languages and sources are groups of their own. Empty texts
fail the base rules. Rows may repeat, each is judged by itself and counts once. Other columns pass
through whatever their names, but for the names of the columns added, which replace theirs. An
empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.llm.common import coded, packed, row_groups, text_parts, tidied, words_of
from repolens.session import cut_lineage

#: The characters that count as symbols.
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Ratios judged, in per mille of n_words: (name, numerator, room beyond any bound, bounded below too).
#: The room lets a measure that is 0 nearly everywhere vary a little.
MEASURES = (
    ("length", "word_chars", 1000, True),
    ("symbols", "n_symbols", 100, False),
    ("dup_lines", "n_dup_lines", 100, False),
    ("repeats", "n_repeat_words", 300, False),
)
LEAST_DOCUMENTS = 200
#: Quantiles in per mille, and how many times their distance from the median the bounds lie beyond
#: them. Quartiles stay where they are with up to a quarter of junk in a group.
LOW, HIGH, SPREAD = 250, 750, 8


def counts_of(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """The counts named in ``COUNTS`` of each text."""
    n = len(offsets) - 1
    start, end = words_of(data, offsets)
    bound = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(n), np.diff(bound))

    def total(flags: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[offsets])

    body, at = packed(data, start, end)
    heads = np.concatenate([[0], np.cumsum((body & 0xC0) != 0x80, dtype=np.int64)])
    chars = np.diff(heads[at[bound]])
    symbols = total(np.isin(np.arange(256), list(SYMBOLS.encode()))[data])
    return [np.diff(bound), chars, symbols, _repeated_lines(data, offsets, start), _words_in_repeats(body, at, row, n)]


def _repeated_lines(data: np.ndarray, offsets: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Lines of each text that hold a word and equal an earlier line of it."""
    n = len(offsets) - 1
    breaks = np.flatnonzero(data == 10)
    owner = np.searchsorted(offsets, breaks, "right") - 1
    inner = breaks + 1 < offsets[owner + 1]  # nothing stands behind a last break
    first, row = np.concatenate([offsets[:-1], breaks[inner] + 1]), np.concatenate([np.arange(n), owner[inner]])
    order = np.lexsort((row, first))
    first, row = first[order], row[order]
    last = np.append(first[1:], len(data))
    worded = np.searchsorted(start, last) > np.searchsorted(start, first)
    first, last, row = first[worded], last[worded], row[worded]
    ends = last - (data[last - 1] == 10)
    code, _ = coded(*packed(data, first, ends))
    key = np.unique(row * (len(code) + 1) + code)
    return np.bincount(row, minlength=n) - np.bincount(key // (len(code) + 1), minlength=n)


def _words_in_repeats(body: np.ndarray, at: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Words of each text that lie in windows of three words found twice or more in it."""
    import pandas as pd

    if len(row) < 4:
        return np.zeros(n, np.int64)
    word, distinct = coded(body, at)
    word = word.astype(np.int64)
    two = pd.factorize(word[:-1] * len(distinct) + word[1:])[0].astype(np.int64)
    three = pd.factorize(two[:-1] * len(distinct) + word[2:])[0].astype(np.int64)
    whole = np.flatnonzero(row[:-2] == row[2:])
    window = pd.factorize(row[whole] * len(row) + three[whole])[0]
    again = whole[np.bincount(window, minlength=1)[window] > 1]
    inside = np.zeros(len(row), bool)
    for k in range(3):
        inside[again + k] = True
    return np.bincount(row[inside], minlength=n)


def measure(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with the counts of ``COUNTS`` and ``base_failed``."""
    at = df.columns.index(text)
    others = [i for i, c in enumerate(df.columns) if c != text and c not in (*COUNTS, "base_failed")]
    inner = df.select(*[F.col(f"`{df.columns[i]}`").alias(f"c{i}") for i in others], F.col(f"`{df.columns[at]}`").cast("string").alias("body"))
    schema = T.StructType([*inner.schema.fields[:-1], *(T.StructField(c, T.LongType()) for c in COUNTS)])

    def counted(batches: Iterable[pa.RecordBatch]):
        for b in batches:
            _, bounds = text_parts(b.column(len(others)))
            for i, j in row_groups(bounds, 4 << 20):
                part = b.slice(i, j - i)
                found = counts_of(*text_parts(part.column(len(others))))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *(pa.array(c, pa.int64()) for c in found)], names=schema.names)

    out = inner.mapInArrow(tidied(counted), schema)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(*[F.col(f"c{i}").alias(df.columns[i]) for i in others], *COUNTS, failed.alias("base_failed"))


def ratio(count: str) -> Column:
    """A count in per mille of the words; null without words."""
    return F.expr(f"CASE WHEN n_words > 0 THEN 1000 * {count} DIV n_words END")


def bucket(value: Column) -> Column:
    """Number of the bucket of a value of 0 or more."""
    bits = F.length(F.bin(value))
    shift = (bits - 6).cast("int")
    return F.when(value < 64, value).otherwise(F.lit(32).cast("long") * shift + F.call_function("shiftright", value, shift))


def floor_of(number: Column) -> Column:
    """The smallest value of a bucket."""
    shift = F.expr("cast(0 as int)") + F.floor((number - 32) / 32).cast("int")
    return F.when(number < 64, number).otherwise(F.call_function("shiftleft", number - F.lit(32).cast("long") * shift, shift))


def sketch(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(level, lang, source, measure, bucket, n) of all documents that pass the base rules: level 2 by language
    and source, 1 by language, 0 of all. Counts are added up before any shuffle, then merged level by level."""
    values = F.array(*[F.struct(F.lit(name).alias("measure"), bucket(ratio(count)).alias("bucket")) for name, count, _, _ in MEASURES])
    rows = measured.filter(~F.col("base_failed")).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{source}`").cast("string").alias("source"), F.explode(values).alias("v"))
    fine = rows.groupBy("lang", "source", "v.measure", "v.bucket").agg(F.count("*").alias("n"))
    fine = cut_lineage(fine.select(F.lit(2).alias("level"), "lang", "source", "measure", "bucket", "n"), "quality-sketch")
    return fine.union(merge(fine, ["lang"], 1)).union(merge(fine, [], 0))


def merge(sketches: DataFrame, by: list[str], level: int) -> DataFrame:
    """Sketches merged to one for each combination of ``by``."""
    found = sketches.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))
    keys = [F.col(c) if c in by else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    return found.select(F.lit(level).alias("level"), *keys, "measure", "bucket", "n")


def thresholds(sketches: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(level, lang, source, measure, low, high): bounds in per mille of the words, from each sketch of
    at least ``least`` documents; that of all counts whatever its size."""
    group = Window.partitionBy("level", "lang", "source", "measure")
    ordered = sketches.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))

    def quantile(per_mille: int) -> Column:
        return floor_of(F.min(F.when(1000 * F.col("upto") >= per_mille * F.col("total"), F.col("bucket"))))

    found = ordered.groupBy("level", "lang", "source", "measure").agg(F.first("total").alias("total"), quantile(LOW).alias("q_low"), quantile(500).alias("mid"), quantile(HIGH).alias("q_high"))
    room = F.create_map(*[F.lit(x) for name, _, room, _ in MEASURES for x in (name, room)])[F.col("measure")]
    low = F.col("q_low") - SPREAD * (F.col("mid") - F.col("q_low")) - room
    high = F.col("q_high") + SPREAD * (F.col("q_high") - F.col("mid")) + room
    return found.filter((F.col("total") >= least) | (F.col("level") == 0)).select("level", "lang", "source", "measure", low.alias("low"), high.alias("high"))


def judge(measured: DataFrame, bounds: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``kept``: no base rule failed, and all measures within the bounds of the finest group that
    has some. Bounds are one row a group; AQE broadcasts them if they are small and splits a large group otherwise."""
    wide = bounds.groupBy("level", "lang", "source").agg(*[F.max(F.when(F.col("measure") == name, F.col(side))).alias(f"__{name}_{side}") for name, _, _, _ in MEASURES for side in ("low", "high")])
    sides = [c for c in wide.columns if c.startswith("__")]
    out = measured.withColumns({"__lang": F.col(f"`{lang}`").cast("string"), "__source": F.col(f"`{source}`").cast("string")})
    for level, keys in ((2, ("lang", "source")), (1, ("lang",)), (0, ())):
        own = wide.filter(F.col("level") == level).select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.struct(*sides).alias(f"__level{level}"))
        if keys:
            on = [F.col(f"__{k}").eqNullSafe(F.col(f"__k_{k}")) for k in keys]
            out = out.join(own, on, "left").drop(*[f"__k_{k}" for k in keys])
        else:  # one row at most
            out = out.withColumn(f"__level{level}", own.select(f"__level{level}").scalar())
    found = F.coalesce("__level2", "__level1", "__level0")
    passes = ~F.col("base_failed")
    for name, count, _, below in MEASURES:
        passes &= F.coalesce(ratio(count) <= found[f"__{name}_high"], F.lit(True))
        if below:
            passes &= F.coalesce(ratio(count) >= found[f"__{name}_low"], F.lit(True))
    return out.withColumn("kept", passes).drop("__lang", "__source", "__level0", "__level1", "__level2")


def apply(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``df`` without ``text``, with the counts, ``base_failed`` and ``kept`` of every row. The counts are
    written once; the texts are read once."""
    measured = cut_lineage(measure(df, text), "quality-counts")
    return judge(measured, thresholds(sketch(measured, lang, source), least), lang, source)

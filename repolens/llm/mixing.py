"""Mixing sources to target weights under a curriculum that varies in time.

Each source has a weight and a schedule: the share of the weight that is due at each time of the
training, from 0 to 1. The integral of the schedules gives every source its target of words,
bounded by ``most`` times its size; what a bound takes away is shared out again by weight. The
target decides how often a document is taken: in whole passes over the source, and in a last
pass that takes documents in the order of a hash of their ids until the target is met to
half a document.

The words taken of a source, in the order of passes and hashes, are its supply; the
integral of its schedule is the demand for them. Inverting the demand at
the middle of a document gives the time at which it is due, its training position; the
mix is sorted by position, in ranges.

DataFrame functions only. A source that holds a third of all documents is cut into buckets of
the hash; sums of buckets are added up before documents are, so no task sees a source.
Tables with one row a source, or one a bucket, are the only ones that a window orders.

Null texts have size 0 and are never taken; null ids count as the text "null", a null source is the last.
Rows with one id and text are taken alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.session import cut_lineage

WEIGHTS = (1, 2, 3)
MOST = 3
#: Slope of the first and last source's schedule: -0.8 is due early, 0.8 late.
TILT = 0.8
#: Hex digits of the hash that name a bucket.
DIGITS = 3
WORD = r"[^\x20\x09-\x0D]+"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, target, tilt) of sources (source, source_size), one row each.

    Sources that reach their bound are those with the smallest bound a unit of weight; with the
    sources in that order, the last level that no bound exceeds settles all others."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    rank = F.row_number().over(by_name) - 1
    s = sizes.withColumn("rank", rank).withColumn("n", F.count(F.lit(1)).over(everything))
    s = s.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    s = s.withColumn("bound", F.col("source_size") * F.lit(float(most))).withColumn("total", F.sum("source_size").over(everything).cast("double"))
    order = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    s = s.withColumn("level", (F.col("total") - F.coalesce(F.sum("bound").over(before), F.lit(0.0))) / F.sum("weight").over(after))
    free = F.col("level") * F.col("weight") <= F.col("bound")
    s = s.withColumn("settled", F.min(F.when(free, F.struct(F.col("bound") / F.col("weight"), "source_size", "level"))).over(everything)["level"])
    target = F.least(F.col("bound"), F.coalesce(F.col("settled") * F.col("weight"), F.col("bound")))
    tilt = F.when(F.col("n") > 1, (F.col("rank") * 2 / (F.col("n") - 1) - 1) * TILT).otherwise(0.0)
    return s.select("source", "source_size", target.alias("target"), tilt.alias("tilt"))


def due(done: Column, tilt: Column) -> Column:
    """The time at which a part ``done`` of a source's words is due: the schedule 1 + tilt (2 t - 1) has
    the integral (1 - tilt) t + tilt t^2, inverted here."""
    b = 1 - tilt
    return F.when(F.abs(tilt) < 1e-9, done).otherwise(2 * done / (b + F.sqrt(F.greatest(F.lit(0.0), b * b + 4 * tilt * done))))


def plan(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per row of ``docs`` (its ``key`` as id, source, digest of the text): size, source_size, target, copies,
    before (the words of the pass up to the document), pass_words (of whole passes) and
    taken_words (of the source)."""
    rows = docs.select(F.col(key).alias("id"), F.col(source).alias("source"), words(text).alias("size"), F.xxhash64(F.col(text)).alias("digest"))
    order = F.md5(F.coalesce(F.col("id").cast("string"), F.lit("null")).cast("binary"))
    # Rows without an id share one hash: they are cut by their texts' digests, in the order of the window below.
    none = F.md5(F.lit("null").cast("binary"))
    by_text = F.lpad(F.hex(F.shiftrightunsigned(F.col("digest").bitwiseXOR(F.lit(-(1 << 63))), 52)), 3, "0")
    place = F.when(F.col("id").isNull(), F.concat(F.lit("1"), by_text)).when(F.col("order") < none, F.lit("0")).otherwise(F.lit("2"))
    bucket = F.concat(F.substring("order", 1, DIGITS), place)
    rows = cut_lineage(rows.withColumn("order", order).withColumn("bucket", bucket), "mix-sizes")
    buckets = cut_lineage(rows.groupBy("source", "bucket").agg(F.sum("size").alias("words")), "mix-buckets")
    aims = cut_lineage(targets(buckets.groupBy("source").agg(F.sum("words").alias("source_size"))), "mix-targets")
    up = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = buckets.withColumn("base", F.coalesce(F.sum("words").over(up), F.lit(0)))
    bases = bases.join(aims, bases["source"].eqNullSafe(aims["source"])).select(bases["source"].alias("s"), F.col("bucket").alias("b"), "base", "source_size", "target", "tilt")
    both = rows.join(bases, rows["source"].eqNullSafe(bases["s"]) & (rows["bucket"] == bases["b"])).drop("s", "b")
    inner = Window.partitionBy("source", "bucket").orderBy("order", "id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    both = both.withColumn("before", F.col("base") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    both = both.withColumn("passes", passes.cast("long"))
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    more = (F.col("size") > 0) & (F.col("before") + F.col("size") / 2 <= rest)
    both = both.withColumn("copies", F.when(F.col("size") > 0, F.col("passes") + more.cast("long")).otherwise(F.lit(0)))
    return both.select("id", "source", "digest", "size", "source_size", "target", "tilt", "before", "passes", "copies")


def report(planned: DataFrame) -> DataFrame:
    """One row per document: id, size, source_size, target, taken and the positions of its copies."""
    return planned.select("id", "source", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), positions().alias("positions"))


def positions() -> Column:
    """The training positions of a planned row's copies."""
    # Of the target, the part that is due when the middle of the copy comes.
    done = lambda c: F.least(F.lit(1.0), (c * F.col("source_size") + F.col("before") + F.col("size") / 2) / F.col("target"))
    copies = F.when(F.col("copies") > 0, F.sequence(F.lit(0), F.col("copies").cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(copies, lambda c: due(done(c), F.col("tilt")))


def mix(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs``, each as often as it is taken, in the order of their training positions."""
    planned = plan(docs, key, text, source).select(F.col("id").alias("_id"), F.col("source").alias("_source"), F.col("digest").alias("_digest"), positions().alias("_positions"))
    planned = planned.filter(F.size("_positions") > 0).dropDuplicates(["_id", "_source", "_digest"])
    here = docs.withColumn("_d", F.xxhash64(F.col(text)))
    both = here.join(planned, here[key].eqNullSafe(planned["_id"]) & here[source].eqNullSafe(planned["_source"]) & (here["_d"] == planned["_digest"]))
    out = both.select(*[here[c] for c in docs.columns], F.explode("_positions").alias("_position"))
    return out.orderBy("_position", F.col(key)).drop("_position")

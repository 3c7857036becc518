"""Incremental marts (J2, J3, J7): a batch rebuilds the partitions it touches, and nothing else.

``repo`` and ``repo_topic`` lie by creation month of the repository, sorted by
language inside the files, ``owner`` by a hash bucket of its url, the roll-ups
by the month of their groups. A batch of landed items

1. finds, in the months it has repositories of, the rows whose key it holds
   anew (a repository's creation month never changes, its language may),
2. rebuilds the partitions that gain or lose a row,
3. counts licences and branches of the rebuilt partitions in
   ``category_counts``, whose sum over all partitions gives the top-k names
   (``top_k``, at most 2 * (k + 1) rows) without reading ``repo``; the names
   are joined at roll-up time, the repositories keep their own licence,
4. rolls the rebuilt partitions up, and
5. publishes all tables by one manifest (``sources/versions.py``).

Rows older than the table's row of their key are dropped, so a batch may be
run again or late. Roll-ups of partitions that no batch touches keep the top-k
names of the batch that built them, as the original's do.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.functions.dates import ntz_lit
from repolens.operators.rollups import repo_rollup, topic_rollup
from repolens.operators.tables import build_tables, normalize_repos
from repolens.schemas import NA, OTHER, SUPPORTED_LANGUAGES, TABLE_KEYS, TABLE_SCHEMAS, TOP_K_VALUES_TO_KEEP
from repolens.session import cut_lineage, own_scratch
from repolens.sources import versions as V

BY_MONTH, BY_BUCKET = ["in_month"], ["in_bucket"]
OWNER_BUCKETS = 16
CATEGORIES = ["license", "default_branch"]
_COUNTS = T.StructType([T.StructField("category", T.StringType()), T.StructField("value", T.StringType()), T.StructField("n", T.LongType())])
_TOP = T.StructType([T.StructField("category", T.StringType()), T.StructField("value", T.StringType())])

#: Tables of a mart and how they are partitioned.
PARTITIONS = {
    "repo": BY_MONTH, "repo_topic": BY_MONTH, "owner": BY_BUCKET,
    "topic_analytics": BY_MONTH, "repo_analytics": BY_MONTH,
    "category_counts": BY_MONTH, "top_k": [],
}
MART_NAMES = ("repo", "repo_topic", "owner", "topic_analytics", "repo_analytics")


def _schema(name: str) -> T.StructType:
    found = {"category_counts": _COUNTS, "top_k": _TOP}.get(name) or TABLE_SCHEMAS[name]
    # The roll-up of a mart has no branch column.
    return T.StructType([f for f in found.fields if not (name == "repo_analytics" and f.name == "default_branch")])


def mart(spark: SparkSession, root: str, name: str, manifest: V.Manifest | None = None, keep=None) -> DataFrame:
    """A published table. Readers of several tables pass one manifest, so that they see one run."""
    manifest = manifest or V.read_manifest(spark, root)
    return V.load(spark, root, manifest, name, _schema(name), PARTITIONS[name], keep)


def marts(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All published tables of one manifest, without partition columns."""
    manifest = V.read_manifest(spark, root)
    return {n: mart(spark, root, n, manifest).drop(*PARTITIONS[n]) for n in MART_NAMES if n in manifest.tables}


def _month(c: Column) -> Column:
    return F.trunc(F.to_date(c), "month")


def _merged(spark: SparkSession, root: str, old: V.Manifest, draft: V.Manifest, name: str, fresh: DataFrame, near, batch_ts: dt.datetime) -> set[str]:
    """Rebuild the partitions of ``name`` that gain a row of ``fresh`` or lose one to it; returns them.
    ``near``: the partitions where rows of the same keys can lie."""
    keys, parts = TABLE_KEYS[name], PARTITIONS[name]
    held = mart(spark, root, name, old, near)
    newer = held.where(F.col("updated_at") > ntz_lit(batch_ts)).select(*keys)
    fresh = fresh.join(newer, keys, "left_anti")
    losing = held.select(*keys, *parts).join(fresh.select(*keys), keys, "left_semi")
    touched = V.touched_partitions(fresh, parts) | V.touched_partitions(losing, parts)
    kept = mart(spark, root, name, old, touched.__contains__).join(fresh.select(*keys), keys, "left_anti")
    V.write_batch(kept.unionByName(fresh.select(*kept.columns)), root, draft, name, parts, touched)
    return touched


def top_names(counts: DataFrame, k: int) -> DataFrame:
    """(category, value): the k most frequent values of each category by the summed counts (ties by value, NULL
    last), and the sentinel of missing ones."""
    totals = counts.groupBy("category", "value").agg(F.sum("n").alias("n"))
    heads = [totals.where(F.col("category") == c).orderBy(F.desc("n"), F.col("value").asc_nulls_last()).limit(k).select("category", "value") for c in CATEGORIES]
    missing = counts.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in CATEGORIES])).alias("category"), F.lit(NA).alias("value"))
    out = missing
    for head in heads:
        out = out.unionByName(head)
    return out.distinct()


def with_top_names(repo: DataFrame, top: DataFrame) -> DataFrame:
    """Categories outside the top-k names become ``Other``. ``top`` has at most k + 1 rows a category."""
    out = repo
    for c in CATEGORIES:
        names = top.where(F.col("category") == c).select(F.col("value").alias("__name"))
        out = out.join(F.broadcast(names), F.col(c) == F.col("__name"), "left")
        out = out.withColumn(c, F.when(F.col("__name").isNotNull(), F.col(c)).otherwise(F.lit(OTHER))).drop("__name")
    return out


@own_scratch
def refresh_marts(
    spark: SparkSession,
    root: str,
    raw: DataFrame,
    as_of,
    batch_ts: dt.datetime,
    top_k: int = TOP_K_VALUES_TO_KEEP,
    order_cols: list[str] | None = None,
    rebuild: bool = False,
    run: str | None = None,
    stage: str = "marts",
) -> dict[str, DataFrame]:
    """Merge a batch of landed items into the tables under ``root`` and publish them; returns the tables.
    ``rebuild`` leaves out what the tables hold now; readers see it until the new ones are published.
    ``run`` notes in the same manifest that this run's ``stage`` is done."""
    old = V.read_manifest(spark, root)
    if rebuild:
        old = V.Manifest(old.number, {t: p for t, p in old.tables.items() if t not in PARTITIONS}, old.done)
    draft = old.draft()
    raw = raw.where(F.col("language").isin(list(SUPPORTED_LANGUAGES)))
    norm = cut_lineage(normalize_repos(raw, as_of, order_cols=order_cols), "norm")
    place = {"in_month": _month(F.col("creation_date"))}
    batch = build_tables(norm, batch_ts)
    where = norm.select(F.col("id").alias("repo_id"), *[c.alias(n) for n, c in place.items()])
    batch["repo"] = batch["repo"].withColumns(place)
    batch["repo_topic"] = batch["repo_topic"].join(where, "repo_id")
    bucket = F.pmod(F.xxhash64("url"), F.lit(OWNER_BUCKETS)).cast("int")
    batch["owner"] = cut_lineage(batch["owner"].withColumn("in_bucket", bucket), "owner")
    of_months = V.touched_partitions(where, BY_MONTH).__contains__
    buckets = V.touched_partitions(batch["owner"], BY_BUCKET)
    near = {"repo": of_months, "repo_topic": of_months, "owner": buckets.__contains__}
    touched = {n: _merged(spark, root, old, draft, n, batch[n], near[n], batch_ts) for n in ("repo", "repo_topic", "owner")}

    def now(name: str, keep=None) -> DataFrame:
        return mart(spark, root, name, draft, keep)

    rebuilt = touched["repo"]
    repo = now("repo", rebuilt.__contains__)
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).alias("value")) for c in CATEGORIES])).alias("p")
    counts = repo.select(*BY_MONTH, pairs).groupBy(*BY_MONTH, "p.category", "p.value").agg(F.count(F.lit(1)).alias("n"))
    V.write_batch(counts.select(*_COUNTS.names, *BY_MONTH), root, draft, "category_counts", BY_MONTH, rebuilt)
    V.write_batch(top_names(now("category_counts"), top_k).coalesce(1), root, draft, "top_k", [], [""])
    by_group = {"in_month": F.to_date("creation_date")}
    rolled = repo_rollup(with_top_names(repo, now("top_k")), batch_ts=batch_ts)
    V.write_batch(rolled.withColumns(by_group).select(*_schema("repo_analytics").names, *BY_MONTH), root, draft, "repo_analytics", BY_MONTH, rebuilt)
    topics = topic_rollup(now("repo_topic", of_months), repo, batch_ts=batch_ts)
    V.write_batch(topics.withColumns(by_group).select(*_schema("topic_analytics").names, *BY_MONTH), root, draft, "topic_analytics", BY_MONTH, rebuilt)
    if run:
        draft.done.setdefault(run, []).append(stage)
    V.publish(spark, root, draft)
    return marts(spark, root)

"""Monthly roll-ups and top-k category clean-up."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.functions.dates import ntz_lit, month_start, year_of
from repolens.functions.numeric import ceil_avg
from repolens.functions.predicates import between
from repolens.schemas import NA, OTHER, TOP_K_VALUES_TO_KEEP


def _window(df: DataFrame, start, end, col: str = "creation_date") -> DataFrame:
    if start is None and end is None:
        return df
    if start is None:  # open at the start
        return df.where(F.col(col) <= ntz_lit(end))
    return df.where(between(F.col(col), start, end if end is not None else start))


def repo_rollup(
    repo: DataFrame,
    start=None,
    end=None,
    batch_ts: dt.datetime | None = None,
) -> DataFrame:
    """repositories by language, licence, creation month/year and
    last-commit month/year over an inclusive creation-date window.

    Two exact distinct counts, five flag sums, four averages rounded to one
    decimal, a rounded size average and two ceiled day averages. Each distinct
    count is an aggregate of its own over narrow (group, id) or (group,
    owner) rows, pre-aggregated before the shuffle, so a hot group is never
    gathered raw into one task; the three results, a row a group, meet in a
    last aggregate.
    """
    groups = ["language", "license", "creation_date", "last_commit_date"]
    df = _window(repo, start, end).withColumns({c: month_start(F.col(c)) for c in groups[2:]})
    measures = df.groupBy(*groups).agg(
        F.sum("archived").cast("long").alias("n_archived_repos"),
        F.sum("has_license").cast("long").alias("n_repos_with_license"),
        F.sum("has_topic").cast("long").alias("n_repos_with_topic"),
        F.sum("has_description").cast("long").alias("n_repos_with_desc"),
        F.sum("has_wiki").cast("long").alias("n_repos_with_wiki"),
        F.round(F.avg("size")).cast("long").alias("size"),
        F.round(F.avg("stars"), 1).alias("stars"),
        F.round(F.avg("watchers"), 1).alias("watchers"),
        F.round(F.avg("forks"), 1).alias("forks"),
        F.round(F.avg("open_issues"), 1).alias("open_issues"),
        ceil_avg(F.col("days_since_creation")).alias("days_since_creation"),
        ceil_avg(F.col("days_since_last_commit")).alias("days_since_last_commit"),
    )
    parts = measures
    for name, col in (("n_repos", "id"), ("n_owners", "owner")):
        distinct = df.select(*groups, F.col(col).alias("__value")).distinct()
        parts = parts.unionByName(distinct.groupBy(*groups).agg(F.count("__value").alias(name)), allowMissingColumns=True)
    names = ["n_repos", "n_owners", *[c for c in measures.columns if c not in groups]]
    # Each column has one value a group, in one of its three rows.
    out = parts.groupBy(*groups).agg(*[F.max(c).alias(c) for c in names]).select(
        "language", "license",
        "creation_date", year_of(F.col("creation_date")).alias("creation_year"),
        "last_commit_date", year_of(F.col("last_commit_date")).alias("last_commit_year"),
        *names,
    )
    if batch_ts is not None:
        out = out.withColumn("updated_at", ntz_lit(batch_ts))
    return out


def topic_rollup(
    repo_topic: DataFrame,
    repo: DataFrame,
    start=None,
    end=None,
    batch_ts: dt.datetime | None = None,
) -> DataFrame:
    """F2 (with E1): distinct repositories by language, topic, creation month
    and last-commit month. The repo side is filtered and pruned to four
    columns before the join on ``repo_id = id``.

    A repository's topics are made a set, and its rows distinct, before they
    meet: each pair that comes out is a repository of its group, once, so
    groups are counted without a table of (group, repository)."""
    r = _window(repo, start, end).select(
        F.col("id").alias("__id"),
        F.col("language").alias("__language"),
        month_start(F.col("creation_date")).alias("creation_date"),
        month_start(F.col("last_commit_date")).alias("last_commit_date"),
    )
    # In a struct a NULL topic stays in the set.
    rt = repo_topic.where(F.col("repo_id").isNotNull()).groupBy("repo_id").agg(F.collect_set(F.struct("topic")).alias("__topics"))
    joined = rt.join(r.distinct(), rt["repo_id"] == r["__id"], "inner")
    out = joined.select("__language", F.inline("__topics"), "creation_date", "last_commit_date").groupBy(
        F.col("__language").alias("language"), "topic", "creation_date", "last_commit_date"
    ).agg(F.count(F.lit(1)).alias("n_repos"))
    if batch_ts is not None:
        out = out.withColumn("updated_at", ntz_lit(batch_ts))
    return out


def top_k_values(df: DataFrame, col: str, k: int = TOP_K_VALUES_TO_KEEP) -> DataFrame:
    """The ``k`` most frequent values of ``col`` (ties: value
    ascending, NULL last) plus ``__NA__``. At most k + 1 rows."""
    top = (
        df.groupBy(col)
        .agg(F.count(F.lit(1)).alias("__n"))
        .orderBy(F.col("__n").desc(), F.col(col).asc_nulls_last())
        .limit(k)
        .select(col)
    )
    na = df.sparkSession.range(1).select(F.lit(NA).alias(col))
    return top.union(na).distinct()


def top_k_by_column(df: DataFrame, cols: list[str], k: int = TOP_K_VALUES_TO_KEEP) -> dict[str, DataFrame]:
    """``top_k_values`` of several columns from one count: one row a column and input row is counted map-side by
    (column, value), and the columns' heads share its exchange."""
    pairs = F.array(*[F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = df.select(F.explode(pairs).alias("p")).groupBy("p.category", "p.value").agg(F.count(F.lit(1)).alias("n"))
    na = df.sparkSession.range(1).select(F.lit(NA).alias("value"))
    heads = {}
    for c in cols:
        top = counts.orderBy((F.col("category") == c).desc(), F.col("n").desc(), F.col("value").asc_nulls_last()).limit(k)
        heads[c] = top.where(F.col("category") == c).select("value").union(na).distinct().select(F.col("value").alias(c))
    return heads


def keep_top_k(df: DataFrame, cols: list[str], k: int = TOP_K_VALUES_TO_KEEP) -> DataFrame:
    """Replace each value of ``cols`` outside its top-k set (plus
    ``__NA__``) by ``Other``; NULL becomes ``Other`` as well.

    The top-k set is bounded by k + 1 rows, so it is broadcast; the large
    side is never shuffled for this step.
    """
    out = df
    for col, values in top_k_by_column(df, cols, k).items():
        keep = values.select(F.col(col).alias(f"__keep_{col}"))
        out = out.join(F.broadcast(keep), out[col] == keep[f"__keep_{col}"], "left")
        out = out.withColumn(
            col, F.when(F.col(f"__keep_{col}").isNotNull(), F.col(col)).otherwise(F.lit(OTHER))
        ).drop(f"__keep_{col}")
    return out

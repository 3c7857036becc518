"""Normalised repository tables.

``normalize_repos`` turns landed search items into one row per repository
with flags, rounded dates and mapped language; ``repo_table``,
``topic_table`` and ``owner_table`` split that into the three modelled
tables. All steps are narrow projections except the G1 de-duplication, which
shuffles ids and the rows of repeated ids, and the owner count, a single
partial aggregation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.functions import normalize as N
from repolens.functions.dates import ntz_lit, days_since, parse_iso_timestamp, round_to_day
from repolens.functions.text import has_topic, join_topics_capped
from repolens.operators.dedupe import dedupe_repeated
from repolens.schemas import NA, REPO_COLUMNS, TOPICS_MAX_LENGTH

_RENAMES = {
    "stargazers_count": "stars",
    "watchers_count": "watchers",
    "forks_count": "forks",
    "open_issues_count": "open_issues",
    "html_url": "url",
}


def normalize_repos(
    raw: DataFrame,
    as_of,
    alias_col: str = "language",
    order_cols: list[str] | None = None,
    pass_through_unknown: bool = False,
) -> DataFrame:
    """Landed items -> normalised repository rows.

    ``alias_col`` holds the language alias (the ``language=`` partition);
    ``as_of`` replaces the wall clock for the day counts. Duplicate ids keep
    the first row by ``order_cols`` (landed-file order when the caller passes
    the file path and row index). The topic array is kept as ``topic_list``
    for the topic table.
    """
    created = round_to_day(parse_iso_timestamp(F.col("created_at")))
    pushed = round_to_day(parse_iso_timestamp(F.col("pushed_at")))
    lic = N.license_name(F.col("license"))
    df = raw.select(
        F.col("id").cast("long").alias("id"),
        F.col("name"),
        F.col("owner.login").alias("owner"),
        F.col("owner.html_url").alias("owner_url"),
        N.display_language(F.col(alias_col), pass_through_unknown).alias("language"),
        F.col(alias_col).alias("lang_alias"),
        F.col("html_url").alias("url"),
        F.col("topics").alias("topic_list"),
        N.bool_flag(F.col("archived")).alias("archived"),
        N.has_license(lic).alias("has_license"),
        N.not_null_flag(F.col("description")).alias("has_description"),
        N.bool_flag(F.col("has_wiki")).alias("has_wiki"),
        F.col("default_branch"),
        lic.alias("license"),
        F.col("description").cast("string").alias("description"),
        F.col("size").cast("long").alias("size"),
        *[F.col(k).cast("long").alias(v) for k, v in _RENAMES.items() if k != "html_url"],
        days_since(created, as_of).alias("days_since_creation"),
        days_since(pushed, as_of).alias("days_since_last_commit"),
        created.alias("creation_date"),
        pushed.alias("last_commit_date"),
        *[F.col(c) for c in (order_cols or [])],
    )
    if order_cols:
        df = dedupe_repeated(df, ["id"], list(order_cols)).drop(*order_cols)
    else:
        df = dedupe_repeated(df, ["id"], [])
    return df


def repo_table(
    norm: DataFrame, batch_ts: dt.datetime | None = None, max_length: int = TOPICS_MAX_LENGTH
) -> DataFrame:
    """The ``repo`` table (24 columns + ``updated_at``)."""
    topics = join_topics_capped(F.col("topic_list"), max_length)
    out = norm.withColumn("topics", topics).withColumn("has_topic", has_topic(topics))
    out = out.select(*REPO_COLUMNS)
    if batch_ts is not None:
        out = out.withColumn("updated_at", ntz_lit(batch_ts))
    return out


def topic_table(norm: DataFrame, batch_ts: dt.datetime | None = None) -> DataFrame:
    """C14: one row per (repo, topic); an empty or NULL list gives one
    ``__NA__`` row; topics are lower-cased."""
    out = norm.select(
        F.col("id").alias("repo_id"),
        F.col("language"),
        F.explode_outer("topic_list").alias("topic"),
    ).withColumn("topic", F.coalesce(F.lower("topic"), F.lit(NA)))
    out = out.select("repo_id", "language", "topic")
    if batch_ts is not None:
        out = out.withColumn("updated_at", ntz_lit(batch_ts))
    return out


def owner_table(
    norm: DataFrame,
    batch_ts: dt.datetime | None = None,
    owner_col: str = "owner",
    url_col: str = "owner_url",
    id_col: str = "id",
) -> DataFrame:
    """repositories per (owner, owner url); rows with a NULL owner or url
    are dropped; NULL ids are not counted."""
    out = (
        norm.where(F.col(owner_col).isNotNull() & F.col(url_col).isNotNull())
        .groupBy(F.col(owner_col).alias("name"), F.col(url_col).alias("url"))
        .agg(F.count(id_col).alias("n_repos"))
    )
    if batch_ts is not None:
        out = out.withColumn("updated_at", ntz_lit(batch_ts))
    return out


def build_tables(norm: DataFrame, batch_ts: dt.datetime | None = None) -> dict[str, DataFrame]:
    """Table name -> DataFrame for one normalised batch."""
    return {
        "repo": repo_table(norm, batch_ts),
        "repo_topic": topic_table(norm, batch_ts),
        "owner": owner_table(norm, batch_ts),
    }

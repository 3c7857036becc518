"""Repository explorer and paged search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.functions.predicates import all_of, repo_conditions, search_conditions
from repolens.functions.text import split_topics
from repolens.operators.joins import repos_with_all, semi_join
from repolens.schemas import MAX_ITEMS_PER_PAGE, REPORT_LIMIT, SEARCH_ITEMS_LIMIT

REPORT_COLUMNS = [
    "id", "name", "url", "language", "stars", "forks", "open_issues", "archived",
    "has_wiki", "description", "license", "topics", "owner", "days_since_creation",
    "days_since_last_commit", "creation_date", "last_commit_date",
]

SORT_OPTIONS = ("stars", "forks", "open_issues", "creation_date", "last_commit_date")


def order_desc(sort_by: str, tie: str | None = "id") -> list:
    """H1/H6: descending with NULLs first, plus a unique tie-break."""
    cols = [F.col(sort_by).desc_nulls_first()]
    if tie and tie != sort_by:
        cols.append(F.col(tie).asc())
    return cols


def repo_report(
    repo: DataFrame,
    repo_topic: DataFrame | None = None,
    package: DataFrame | None = None,
    creation_date_range=None,
    last_commit_date_range=None,
    languages=None,
    topics=None,
    licenses=None,
    packages=None,
    sort_by: str = "stars",
    exclude_archived: bool = False,
    exclude_without_wiki: bool = False,
    exclude_without_topic: bool = False,
    exclude_without_license: bool = False,
    limit: int | None = REPORT_LIMIT,
    split: bool = True,
) -> DataFrame:
    """Distinct 16-column repository report with every filter.

    Package restriction (E4) and topic restriction (E3) are left-semi
    joins on the repository id; the repository filters are plain
    predicates that Catalyst pushes into the scan. The ``limit`` ids of the
    head come from a narrow ``TakeOrderedAndProject``; the broadcast of them
    is bounded by ``limit``.
    """
    if sort_by not in SORT_OPTIONS:
        raise ValueError(f"sort_by must be one of {SORT_OPTIONS}")
    r = repo.where(
        all_of(
            repo_conditions(
                creation_date_range=creation_date_range,
                last_commit_date_range=last_commit_date_range,
                languages=languages,
                licenses=licenses,
                exclude_archived=exclude_archived,
                exclude_without_license=exclude_without_license,
                exclude_without_wiki=exclude_without_wiki,
            )
        )
    )
    if packages:
        if package is None:
            raise ValueError("packages given without a package table")
        r = semi_join(r, repos_with_all(package, list(packages)))
    if topics or exclude_without_topic:
        if repo_topic is None:
            raise ValueError("topics given without a repo_topic table")
        ft = repo_topic.where(
            all_of(
                repo_conditions(
                    topics=topics, languages=languages, exclude_without_topic=exclude_without_topic
                )
            )
        ).select("repo_id")
        r = semi_join(r, ft)
    out = r.select(*REPORT_COLUMNS)
    if limit:
        # The head is found on two columns; only its rows are made distinct in full width.
        head = out.select("id", F.col(sort_by).alias("by")).distinct().orderBy(F.col("by").desc_nulls_first(), "id").limit(limit)
        ids = head.select(F.col("id").alias("head_id")).distinct()
        out = out.join(F.broadcast(ids), out["id"].eqNullSafe(ids["head_id"]), "left_semi")
    out = out.distinct().orderBy(*order_desc(sort_by))
    if limit:
        out = out.limit(limit)
    if split:
        out = out.withColumn("topics", split_topics(F.col("topics")))
    return out.drop("id")


def display_head(df: DataFrame, limit: int | None) -> DataFrame:
    """H2: first ``limit`` rows of an already ordered report."""
    return df.limit(limit) if limit else df


def paged_search(
    repo: DataFrame,
    created_date=None,
    languages=None,
    min_pushed_date=None,
    min_stars: int | None = 1,
    sort_by: str = "stars",
    order_by: str = "desc",
    page: int = 1,
    per_page: int = MAX_ITEMS_PER_PAGE,
    max_items: int = SEARCH_ITEMS_LIMIT,
    tie: str = "id",
    **cols,
) -> DataFrame:
    """One page of a search sorted by ``sort_by``; at most
    ``max_items`` results are reachable (pages past that are empty)."""
    conds = search_conditions(created_date, languages, min_pushed_date, min_stars, **cols)
    key = F.col(sort_by).desc_nulls_first() if order_by == "desc" else F.col(sort_by).asc_nulls_last()
    df = repo.where(all_of(conds)).orderBy(key, F.col(tie).asc())
    start = (page - 1) * per_page
    n = max(0, min(per_page, max_items - start))
    return df.offset(start).limit(n)

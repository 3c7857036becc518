"""Joins of the repository model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.predicates import path_matches


def semi_join(df: DataFrame, keys: DataFrame, left_key: str = "id", right_key: str = "repo_id") -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (EXISTS)."""
    k = keys.select(F.col(right_key).alias("__k"))
    return df.join(k, df[left_key] == k["__k"], "left_semi")



def repos_with_all(
    items: DataFrame, values: list[str], key: str = "repo_id", item: str = "package"
) -> DataFrame:
    """Relational division, keys that have *every* listed value.

    Duplicates on either side do not break it: distinct values per key are
    counted against the number of distinct requested values. The filter is
    pushed to the scan; the count is a partial aggregation.
    """
    wanted = sorted(set(values))
    return (
        items.where(F.col(item).isin(wanted))
        .groupBy(key)
        .agg(F.countDistinct(item).alias("__n"))
        .where(F.col("__n") == len(wanted))
        .select(key)
    )



def repos_with_files(repos: DataFrame, files: DataFrame, key: str = "repo_id") -> DataFrame:
    """Every selected repository, with its files or one row of NULLs."""
    return repos.join(files, key, "left")


def tree_blobs(trees: DataFrame, path_pattern: str | None = None) -> DataFrame:
    """Recursive tree responses to (repo_id, path, url) rows:
    blobs only, path lower-cased, optional regex on the lowered path."""
    rows = trees.select("repo_id", F.explode("tree").alias("e")).select(
        "repo_id", F.col("e.path").alias("path"), F.col("e.type").alias("type"), F.col("e.url").alias("url")
    )
    rows = rows.where(F.col("type") == "blob").withColumn("path", F.lower("path"))
    if path_pattern:
        rows = rows.where(path_matches(F.col("path"), path_pattern))
    return rows.select("repo_id", "path", "url")


def files_by_pattern(
    files: DataFrame,
    patterns: list[str],
    path_col: str = "path",
    key_col: str = "key",
    limit: int | None = None,
    order_cols: list[str] | None = None,
) -> DataFrame:
    """A file appears once per pattern its lower-cased path matches
    (case-insensitive regex, NULL path never matches).

    The patterns are an argument-sized list, so each becomes one literal
    ``rlike`` in a per-row array that is exploded: no join, no shuffle.
    ``limit`` keeps the first n files per pattern by ``order_cols``
    (a window top-k that Spark pre-limits on the map side).
    """
    hits = F.array(
        *[F.when(path_matches(F.col(path_col), p, case_insensitive=True), F.lit(p)) for p in patterns]
    )
    out = files.withColumn(key_col, F.explode(F.filter(hits, lambda x: x.isNotNull())))
    if limit:
        order = [F.col(c) for c in (order_cols or [path_col])]
        w = Window.partitionBy(key_col).orderBy(*order)
        out = out.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= limit).drop("__rn")
    return out


def content_lookup(files: DataFrame, blobs: DataFrame, key: str = "url", content_col: str = "content") -> DataFrame:
    """Attach landed content to each file; NULL when it was not fetched."""
    b = blobs.select(F.col(key).alias("__url"), F.col(content_col).alias(content_col))
    return files.join(b, files[key] == b["__url"], "left").drop("__url")


def branch_fallback(
    repos: DataFrame,
    trees: DataFrame,
    repo_key: str = "id",
    branch_col: str = "branch",
    default_col: str = "default_branch",
) -> DataFrame:
    """Pick the tree of the requested branch, else the repository's
    default branch. ``trees`` holds (repo_id, branch, ...) entries; the
    result is ``repos`` plus ``tree_branch`` (NULL when neither exists)."""
    # One row a repository with the few branches that it has landed: one join.
    landed = trees.groupBy(F.col("repo_id").alias("__rid")).agg(F.collect_set("branch").alias("__branches"))
    out = repos.join(landed, repos[repo_key] == landed["__rid"], "left")
    asked, default = F.col(branch_col), F.col(default_col)
    found = F.when(F.array_contains("__branches", asked), asked).when(F.array_contains("__branches", default), default)
    return out.withColumn("tree_branch", found).drop("__rid", "__branches")

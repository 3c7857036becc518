"""Content flow over a window of days and languages.

Three stages, each landed by key and read by the next:

* structure: repositories of each (language, day) -> their file rows, landed
  by (language, month), key (language, day);
* content: landed structure -> one row a file and matching pattern, landed
  by (language, pattern, month), key (language, pattern, day);
* packages: landed contents of the requirements pattern -> the ``package``
  table, rebuilt in the buckets of the repositories it touches and published
  by the manifest.

A stage is one plan over its whole window: no loop over days, languages or
patterns. Keys that are landed already are left out before any tree or
content is looked up (``skip``), or replaced (``overwrite``); only the
partitions of the window are read.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repolens.functions.dates import as_date, ntz_lit
from repolens.operators.joins import branch_fallback, content_lookup, files_by_pattern, repos_with_files, tree_blobs
from repolens.operators.packages import package_table
from repolens.schemas import CONTENT, DEFAULT_PATH_PATTERN, FULL_PATH_PATTERN, PACKAGE, STRUCTURE, TABLE_KEYS
from repolens.session import cut_lineage, own_scratch, path_exists
from repolens.sources import readers as R
from repolens.sources import versions as V
from repolens.sources.sinks import write_partitioned

STRUCTURE_PARTITIONS = ["language", "created_month"]
CONTENT_PARTITIONS = ["language", "key", "created_month"]
DAY_KEY = ("language", "created_date")
PATTERN_KEY = ("language", "key", "created_date")
REQUIREMENTS_KEY = r"requirements.*\.txt"
PACKAGE_BUCKETS = 16


def split_patterns(path_pattern: str | list[str]) -> list[str]:
    """The single patterns of an alternative, each a landing key of its own."""
    return path_pattern.split("|") if isinstance(path_pattern, str) else list(path_pattern)


def _landed_keys(landed: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return landed.select(*keys).distinct()


def structure_rows(
    repos: DataFrame, trees: DataFrame, path_pattern: str | None = FULL_PATH_PATTERN, current_branches: DataFrame | None = None
) -> DataFrame:
    """(repo_id, path, url, language, created_date) of the crawl list's repositories: the blobs of the
    requested branch's tree, or of the current default branch's if there is none, that match the pattern; one row
    with NULL path and url where nothing is left. Trees without a ``branch`` answer any."""
    key = repos.select(F.col("id").alias("repo_id"), "language", "created_date")
    if "branch" in trees.columns:
        now = current_branches if current_branches is not None else repos.select(F.col("id").alias("repo_id"), F.col("branch").alias("default_branch"))
        asked = repos.select("id", "branch").join(now.withColumnRenamed("repo_id", "id"), "id", "left")
        chosen = branch_fallback(asked, trees).select(F.col("id").alias("repo_id"), F.col("tree_branch").alias("branch"))
        trees = trees.join(chosen, ["repo_id", "branch"], "left_semi")
    files = tree_blobs(trees.join(key.select("repo_id"), "repo_id", "left_semi"), path_pattern)
    return repos_with_files(key, files, "repo_id").select("repo_id", "path", "url", "language", "created_date")


def run_structure(
    spark: SparkSession,
    repo: DataFrame,
    trees: DataFrame,
    out_path: str,
    start,
    end=None,
    languages="python",
    path_pattern: str | None = FULL_PATH_PATTERN,
    min_stars: int = 10,
    limit: int | None = None,
    overwrite: bool = False,
    current_branches: DataFrame | None = None,
) -> None:
    """Land the structure of every (language, day) of the window that has repositories."""
    repos = R.crawl_list(repo, languages, start, end, min_stars, limit)
    if not overwrite and path_exists(spark, out_path):
        have = R.read_structure(spark, out_path, languages, start, end if end is not None else start)
        repos = repos.join(_landed_keys(have, DAY_KEY), list(DAY_KEY), "left_anti")
    rows = structure_rows(repos, trees, path_pattern, current_branches)
    write_partitioned(rows, out_path, STRUCTURE_PARTITIONS, "overwrite" if overwrite else "append", STRUCTURE, DAY_KEY)


def content_rows(structure: DataFrame, path_pattern: str | list[str] = DEFAULT_PATH_PATTERN, limit: int | None = None) -> DataFrame:
    """One row a file and pattern that its path matches, tagged with the pattern as ``key``; with ``limit`` the
    first of each (language, day, pattern) by path, url and repository."""
    found = files_by_pattern(structure.where(F.col("path").isNotNull()), split_patterns(path_pattern))
    if limit:
        rank = F.row_number().over(Window.partitionBy(*PATTERN_KEY).orderBy("path", "url", "repo_id"))
        found = found.withColumn("__rank", rank).where(F.col("__rank") <= limit).drop("__rank")
    return found


def run_content(
    spark: SparkSession,
    structure_path: str,
    blobs: DataFrame,
    out_path: str,
    start,
    end=None,
    languages="python",
    path_pattern: str | list[str] = DEFAULT_PATH_PATTERN,
    limit: int | None = None,
    overwrite: bool = False,
) -> None:
    """Land the contents of the window's files, keyed by (language, pattern, day). A content
    that was not fetched (``blobs`` lacks its url) is NULL."""
    structure = R.read_structure(spark, structure_path, languages, start, end)
    files = content_rows(structure, path_pattern, limit)
    if not overwrite and path_exists(spark, out_path):
        have = R.read_content(spark, out_path, None, languages, start, end if end is not None else start)
        files = files.join(_landed_keys(have, PATTERN_KEY), list(PATTERN_KEY), "left_anti")
    rows = content_lookup(files, blobs).select("repo_id", "path", "url", "content", "created_date", "language", "key", "created_month")
    write_partitioned(rows, out_path, CONTENT_PARTITIONS, "overwrite" if overwrite else "append", CONTENT, PATTERN_KEY)


def package(spark: SparkSession, root: str, manifest: V.Manifest | None = None, keep=None) -> DataFrame:
    """The published ``package`` table."""
    return V.load(spark, root, manifest or V.read_manifest(spark, root), "package", PACKAGE, ["in_bucket"], keep)


@own_scratch
def run_packages(
    spark: SparkSession,
    content_path: str,
    root: str,
    batch_ts: dt.datetime,
    start=None,
    end=None,
    languages=None,
    key: str = REQUIREMENTS_KEY,
    run: str | None = None,
    stage: str = "packages",
) -> DataFrame:
    """Parse the landed requirements files of the window (of all days without one) and merge them into the
    ``package`` table: a (repo_id, package) of the batch replaces the older row, rows without a package are
    appended once a batch. Buckets of repositories that the batch lacks are not rewritten."""
    old = V.read_manifest(spark, root)
    draft = old.draft()
    rows = package_table(R.read_content(spark, content_path, key, languages, start, end))
    bucket = F.pmod(F.xxhash64("repo_id"), F.lit(PACKAGE_BUCKETS)).cast("int")
    fresh = cut_lineage(rows.withColumn("updated_at", ntz_lit(batch_ts)).withColumn("in_bucket", bucket), "packages")
    touched = V.touched_partitions(fresh, ["in_bucket"])
    held = package(spark, root, old, touched.__contains__)
    keys = TABLE_KEYS["package"]
    newer = held.where(F.col("updated_at") > ntz_lit(batch_ts)).select(*keys)
    fresh = fresh.join(newer, keys, "left_anti")
    # NULL packages are no key: those of this very batch are replaced, so that it may be run again.
    again = held.where(F.col("package").isNotNull() | (F.col("updated_at") != ntz_lit(batch_ts)))
    kept = again.join(fresh.select(*keys), keys, "left_anti")
    V.write_batch(kept.unionByName(fresh.select(*kept.columns)), root, draft, "package", ["in_bucket"], touched)
    if run:
        draft.done.setdefault(run, []).append(stage)
    V.publish(spark, root, draft)
    return package(spark, root).drop("in_bucket")


def run_content_flow(
    spark: SparkSession,
    repo: DataFrame | None,
    trees: DataFrame | None,
    blobs: DataFrame | None,
    root: str,
    start,
    end=None,
    languages="python",
    structure: bool = True,
    content: bool = True,
    packages: bool = True,
    overwrite: bool = False,
    min_stars: int = 10,
    structure_path_pattern: str | None = FULL_PATH_PATTERN,
    content_path_pattern: str | list[str] = DEFAULT_PATH_PATTERN,
    limit: int | None = None,
    batch_ts: dt.datetime | None = None,
    current_branches: DataFrame | None = None,
) -> None:
    """The three stages under ``root`` (``structure``, ``content``, ``marts/package``), each switchable; a
    stage works on what the one before has landed, in this run or an earlier one."""
    if structure:
        run_structure(spark, repo, trees, f"{root}/structure", start, end, languages, structure_path_pattern, min_stars, limit, overwrite, current_branches)
    if content:
        run_content(spark, f"{root}/structure", blobs, f"{root}/content", start, end, languages, content_path_pattern, limit, overwrite)
    if packages:
        ts = batch_ts or dt.datetime.combine(as_date(end if end is not None else start), dt.time())
        run_packages(spark, f"{root}/content", f"{root}/marts", ts, start, end, languages)

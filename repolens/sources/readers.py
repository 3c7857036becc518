"""Readers (A1-A5, A7-A9).

Every reader declares its schema up front (no inference pass over 100 TB,
and absent columns come back as NULL instead of failing). Language and date
restrictions are predicates on the ``language=`` / ``created_date=``
partition columns, so Spark prunes directories instead of opening files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from repolens.functions.dates import as_date, check_date_range, ntz_lit
from pyspark.sql import types as T

from repolens.schemas import (
    CONTENT,
    RAW_REPO_FIELDS,
    RAW_REPO,
    RAW_REPO_COLUMNS,
    SEARCH_PAGE,
    STRUCTURE,
    SUPPORTED_LANGUAGES,
    TREE_PAGE,
)


def parse_languages(languages=None) -> list[str]:
    """Supported language aliases out of a list or a comma-separated string; all of
    them for None. Naming none that is supported is an error, not "no filter"."""
    if languages is None:
        return list(SUPPORTED_LANGUAGES)
    names = languages.split(",") if isinstance(languages, str) else list(languages)
    found = [n.strip().lower() for n in names if n.strip().lower() in SUPPORTED_LANGUAGES]
    if not found:
        raise ValueError(f"no supported language in {languages!r}")
    return list(dict.fromkeys(found))


def partition_filter(
    df: DataFrame,
    languages=None,
    start=None,
    end=None,
    language_col: str = "language",
    date_col: str = "created_date",
    month_col: str = "created_month",
) -> DataFrame:
    """A2: restrict to languages and an inclusive date window (partition
    pruning); absent partitions simply contribute no rows. Without ``end`` the
    window is the day ``start``, without ``start`` it is open; ``languages`` that name none that is
    supported, or no language at all, are an error."""
    if languages is not None:
        df = df.where(F.col(language_col).isin(parse_languages(languages)))
    if start is not None and end is not None:
        check_date_range(start, end)
    # Redundant with the day predicate, but on the partition column: Spark
    # prunes whole month directories before opening any file.
    months = month_col in df.columns
    if start is not None:
        s = as_date(start)
        df = df.where(F.col(date_col) >= F.lit(s))
        df = df.where(F.col(month_col) >= F.lit(s.replace(day=1))) if months else df
    if end is not None or start is not None:
        e = as_date(end if end is not None else start)
        df = df.where(F.col(date_col) <= F.lit(e))
        df = df.where(F.col(month_col) <= F.lit(e.replace(day=1))) if months else df
    return df


def read_raw_repos(
    spark: SparkSession,
    path: str,
    languages=None,
    start=None,
    end=None,
    with_file_order: bool = False,
) -> DataFrame:
    """A1/A2: landed search items (18 columns) plus the partitions; only
    supported languages (A3). ``with_file_order`` adds the landed file path
    and row index for first-in-file de-duplication (G1)."""
    df = spark.read.schema(RAW_REPO).parquet(path)
    df = partition_filter(df, parse_languages(languages), start, end)
    cols = [F.col(c) for c in RAW_REPO_COLUMNS] + [F.col("language"), F.col("created_date")]
    if with_file_order:
        cols += [
            F.col("_metadata.file_path").alias("__file"),
            F.col("_metadata.row_index").alias("__row"),
        ]
    return df.select(*cols)


def read_daily_files(spark: SparkSession, path: str, languages=None, start=None, end=None) -> DataFrame:
    """A1/A2 for the crawler's own layout ``language=<alias>/<YYYY-MM-DD>.parquet``:
    the day comes from the file name (``_metadata.file_name``)."""
    data = T.StructType(RAW_REPO_FIELDS + [T.StructField("language", T.StringType())])
    df = spark.read.schema(data).parquet(path)
    df = df.withColumn(
        "created_date",
        F.to_date(F.regexp_extract(F.col("_metadata.file_name"), r"^(\d{4}-\d{2}-\d{2})", 1)),
    )
    return partition_filter(df, parse_languages(languages), start, end)


def discover_languages(df: DataFrame, language_col: str = "language") -> DataFrame:
    """A3: supported languages present among the partitions."""
    return (
        df.select(language_col)
        .distinct()
        .where(F.col(language_col).isin(list(SUPPORTED_LANGUAGES)))
    )


def read_structure(spark: SparkSession, path: str, languages=None, start=None, end=None) -> DataFrame:
    """A4: structure rows; a file without ``path`` gives NULL paths."""
    return partition_filter(spark.read.schema(STRUCTURE).parquet(path), languages, start, end)


def read_content(
    spark: SparkSession, path: str, key: str | None = None, languages=None, start=None, end=None
) -> DataFrame:
    """A5: content rows of one ``key=`` partition, all dates or a window."""
    df = partition_filter(spark.read.schema(CONTENT).parquet(path), languages, start, end)
    if key is not None:
        df = df.where(F.col("key") == F.lit(key))
    return df


def read_search_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed search responses -> items. A response lies in a ``language=<alias>`` folder, whose alias its items
    get, or below no such folder, where they keep the language that they report. ``multi_line``: a
    file is one response; otherwise each line is one, so that large files are split."""
    pages = spark.read.schema(SEARCH_PAGE).option("multiLine", multi_line).json(path)
    if "language" not in pages.columns:
        return pages.select(F.explode("items").alias("r")).select("r.*")
    return pages.select("language", F.explode("items").alias("r")).select(*[f"r.{f.name}" for f in RAW_REPO_FIELDS], "language")


def read_tree_pages(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Landed recursive file-tree responses, one a file or one a line."""
    return spark.read.schema(TREE_PAGE).option("multiLine", multi_line).json(path)


def crawl_list(repo: DataFrame, languages, start, end=None, min_stars: int = 1, limit: int | None = None) -> DataFrame:
    """A9 over a window: (id, owner, repo, branch, language, created_date) of the repositories of every (language,
    day) with at least ``min_stars`` stars; with ``limit`` the first of each (language, day) by id."""
    s, e = check_date_range(start, end)
    day = F.to_date("creation_date")
    df = repo.where(F.col("lang_alias").isin(parse_languages(languages)) & (F.col("stars") >= F.lit(min_stars)))
    # Days are midnights: a repository whose date has a time belongs to no day.
    df = df.where(F.col("creation_date").between(ntz_lit(s), ntz_lit(e)) & (F.col("creation_date") == day.cast("timestamp_ntz")))
    df = df.select(
        "id", "owner", F.col("name").alias("repo"), F.col("default_branch").alias("branch"),
        F.col("lang_alias").alias("language"), day.alias("created_date"),
    ).distinct()
    if limit:
        rank = F.row_number().over(Window.partitionBy("language", "created_date").orderBy("id", "owner", "repo", "branch"))
        df = df.withColumn("__rank", rank).where(F.col("__rank") <= limit).drop("__rank")
    return df


def select_repos_to_crawl(
    repo: DataFrame,
    language: str,
    creation_date,
    min_stars: int = 1,
    limit: int | None = None,
) -> DataFrame:
    """Repositories of one language alias (created on one day, when
    ``creation_date`` is given) with at
    least ``min_stars`` stars; a stable order (id) before the optional limit,
    then distinct."""
    cond = (F.col("lang_alias") == F.lit(language)) & (F.col("stars") >= F.lit(min_stars))
    if creation_date is not None:
        cond = cond & (F.col("creation_date") == ntz_lit(creation_date))
    df = repo.where(cond).select(
        "id", "owner", F.col("name").alias("repo"), F.col("default_branch").alias("branch")
    )
    if limit:
        df = df.orderBy("id").limit(limit)
    return df.distinct()

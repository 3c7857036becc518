"""Dependency-file parsing as a Spark job (C17-C25, J4 core).

Each content row is decoded, split into lines and exploded; each line is
parsed with one regex; rows are reduced to one per (repo, package) with a
partial aggregation. Everything is built-in expressions: no Python runs per
row, and a repository with a huge file is split across lines by
``explode`` rather than handled by one Python call.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from repolens.functions import requirements as R
from repolens.functions.normalize import display_language
from repolens.operators.dedupe import best_version_per_package


def parse_requirements(
    content: DataFrame,
    language_col: str | None = "language",
    content_col: str = "content",
    pass_through_language: bool = True,
) -> DataFrame:
    """Content rows -> (repo_id, language, package, version, operator) rows.

    A row whose content does not decode (or decodes to '') leaves one row
    with only repo_id and language (C19); a decodable file without any
    dependency line leaves none. One pass: each file is decoded once and an
    undecodable one explodes to a single NULL line.
    """
    lang = (
        display_language(F.col(language_col), pass_through_language)
        if language_col
        else F.lit(None).cast("string")
    )
    decoded = content.select(
        F.col("repo_id"), lang.alias("language"), R.decode_base64_text(F.col(content_col)).alias("__text")
    )
    valid = F.coalesce(F.col("__text") != F.lit(""), F.lit(False))
    parsed = F.transform(F.filter(R.content_lines(F.col("__text")), R.starts_with_letter), R.requirement_parts)
    lines = decoded.select(
        "repo_id",
        "language",
        F.explode(F.when(valid, parsed).otherwise(F.array(F.lit(None).cast("array<string>")))).alias("__parts"),
    )
    package, operator, version = R.fields_of_parts(F.col("__parts"))
    rows = lines.where(F.col("__parts").isNull() | package.isNotNull())
    return rows.select("repo_id", "language", package.alias("package"), version.alias("version"), operator.alias("operator"))


def prepare_packages(parsed: DataFrame) -> DataFrame:
    """C23 + C24: version default/length rule, then one row per
    (repo_id, package)."""
    cleaned = parsed.withColumn("version", R.clean_version(F.col("version")))
    return best_version_per_package(cleaned)


def package_table(content: DataFrame, language_col: str | None = "language", content_col: str = "content") -> DataFrame:
    """J4 core: content -> deduplicated package rows."""
    return prepare_packages(parse_requirements(content, language_col, content_col))

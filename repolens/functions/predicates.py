"""Predicate builders.

Only the arguments that are given become predicates; the result is a list
of ``Column``s that callers fold with ``all_of``. Catalyst pushes each one
to the Parquet scan (or below a semi-join) on its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from repolens.schemas import NA


def _c(name: str, table: str | None) -> Column:
    return F.col(f"{table}.{name}" if table else name)


def _ts(value):
    """Range bounds are compared as timestamps (a bare date means midnight)."""
    from repolens.functions.dates import ntz_lit

    return ntz_lit(value)


def between(col: Column, start, end) -> Column:
    """Inclusive both ends."""
    return col.between(_ts(start), _ts(end))


def repo_conditions(
    table: str | None = None,
    creation_date_range=None,
    last_commit_date_range=None,
    languages=None,
    licenses=None,
    topics=None,
    exclude_archived: bool = False,
    exclude_without_wiki: bool = False,
    exclude_without_license: bool = False,
    exclude_without_topic: bool = False,
) -> list[Column]:
    """Dynamic conjunction of the dashboard filters."""
    conds: list[Column] = []
    if creation_date_range:
        start, end = creation_date_range
        conds.append(between(_c("creation_date", table), start, end))
    if last_commit_date_range:
        start, end = last_commit_date_range
        conds.append(between(_c("last_commit_date", table), start, end))
    if languages:
        conds.append(_c("language", table).isin(list(languages)))
    if licenses:
        conds.append(_c("license", table).isin(list(licenses)))
    if exclude_archived:
        conds.append(_c("archived", table) == 0)
    if exclude_without_wiki:
        conds.append(_c("has_wiki", table) == 1)
    if exclude_without_license:
        conds.append(_c("has_license", table) == 1)
    if exclude_without_topic:
        conds.append(_c("topic", table) != F.lit(NA))
    if topics:
        conds.append(_c("topic", table).isin(list(topics)))
    return conds


def all_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds, F.lit(True))


def search_conditions(
    created_date=None,
    languages=None,
    min_pushed_date=None,
    min_stars: int | None = None,
    created_col: str = "creation_date",
    pushed_col: str = "last_commit_date",
    stars_col: str = "stars",
    language_col: str = "lang_alias",
) -> list[Column]:
    """Created on a day, pushed on/after a day, at least n stars, any
    of the languages."""
    conds: list[Column] = []
    if created_date is not None:
        conds.append(F.col(created_col).cast("date") == F.lit(created_date).cast("date"))
    if min_pushed_date is not None:
        conds.append(F.col(pushed_col) >= _ts(min_pushed_date))
    if min_stars:
        conds.append(F.col(stars_col) >= F.lit(min_stars))
    if languages:
        if isinstance(languages, str):
            languages = [languages]
        conds.append(F.col(language_col).isin(list(languages)))
    return conds


def path_matches(path: Column, pattern: str, case_insensitive: bool = False) -> Column:
    """Regex 'contains' on a path (D11, D12); NULL path -> false."""
    if case_insensitive:
        return F.coalesce(F.lower(path).rlike(pattern.lower()), F.lit(False))
    return F.coalesce(path.rlike(pattern), F.lit(False))

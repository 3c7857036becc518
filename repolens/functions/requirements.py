"""Dependency-file expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from repolens.schemas import (
    DEFAULT_VERSION,
    RE_COMMENT,
    RE_FIRST_LETTER,
    RE_REQUIREMENT,
    RE_VERSION,
    VERSION_MAX_LENGTH,
    VERSION_OPERATORS,
)


def decode_base64_text(c: Column) -> Column:
    """Base64 -> UTF-8 text, NULL on any error (C17).

    Characters outside the alphabet (line breaks) are dropped first; the
    remainder must be a whole number of 4-character quanta, as a strict
    decoder requires. Invalid UTF-8 gives NULL.
    """
    bare = F.replace(F.replace(c, F.lit("\n"), F.lit("")), F.lit("\r"), F.lit(""))
    plain = F.try_to_binary(bare, F.lit("base64"))
    size = F.octet_length(plain)
    # Text that has the length and padding of its bytes' encoding holds no other character: it needs no pattern.
    padded = F.when(size % 3 == 1, F.endswith(bare, F.lit("=="))).when(size % 3 == 2, F.endswith(bare, F.lit("="))).otherwise(True)
    exact = (F.octet_length(bare) == F.ceil(size / 3) * 4) & padded
    cleaned = F.regexp_replace(bare, r"[^A-Za-z0-9+/=]", "")
    picked = F.when(exact, plain).when(F.length(cleaned) % 4 == 0, F.try_to_binary(cleaned, F.lit("base64")))
    return F.try_validate_utf8(picked.cast("string"))


def strip_all(c: Column) -> Column:
    """Remove leading and trailing whitespace of every kind (not just spaces)."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def content_lines(text: Column) -> Column:
    """Array of lower-cased lines of the stripped text."""
    return F.split(F.lower(strip_all(text)), "\n")


def starts_with_letter(line: Column) -> Column:
    return line.rlike(RE_FIRST_LETTER)


def _group(line: Column, idx: int) -> Column:
    return F.nullif(F.regexp_extract(line, RE_REQUIREMENT, idx), F.lit(""))


def requirement_fields(line: Column) -> tuple[Column, Column, Column]:
    """(package, operator, version) of one requirement line, comment removed
    (C20, C21). Unknown operators become NULL; the version is kept."""
    clean = F.regexp_replace(line, RE_COMMENT, "")
    package = _group(clean, 1)
    op = _group(clean, 2)
    operator = F.when(op.isin(VERSION_OPERATORS), op)
    version = _group(clean, 3)
    return package, operator, version


# One pass over a line: the three leading runs of the requirement pattern
# rewritten to "package\x01operator\x01version". Equivalent to matching the
# full pattern once the line is known to start with a letter: the pattern's
# tail "(.*?)\s*(;.*)?$" then always matches, so the groups are the greedy
# leading runs. '#' belongs to none of the three classes, so a comment can
# never change them either.
_SEP = "\u0001"
_RE_LEADING_RUNS = r"(?s)^\s*([\p{L}\p{N}_\-\.]+)\s*([><=~]+)?\s*([\p{L}\p{N}_\.]+)?.*$"


def requirement_parts(line: Column) -> Column:
    """[package, operator, version] of a line that starts with a letter, '' where one is missing. To be evaluated
    inside the array of a file's lines: behind the explode its result is a column, so that no
    filter or projection evaluates the pattern again."""
    return F.split(F.regexp_replace(line, _RE_LEADING_RUNS, f"$1{_SEP}$2{_SEP}$3"), _SEP)


def fields_of_parts(parts: Column) -> tuple[Column, Column, Column]:
    """(package, operator, version) of ``requirement_parts``."""
    package = F.nullif(parts.getItem(0), F.lit(""))
    op = F.nullif(F.try_element_at(parts, F.lit(2)), F.lit(""))
    version = F.nullif(F.try_element_at(parts, F.lit(3)), F.lit(""))
    return package, F.when(op.isin(VERSION_OPERATORS), op), version


def requirement_fields_fast(line: Column) -> tuple[Column, Column, Column]:
    """Same result as ``requirement_fields`` for lines that start with a letter."""
    return fields_of_parts(requirement_parts(line))


def clean_version(version: Column) -> Column:
    """Default '0.0.0'; longer than 25 characters -> NULL."""
    v = F.coalesce(version, F.lit(DEFAULT_VERSION))
    return F.when(F.length(v) > VERSION_MAX_LENGTH, F.lit(None).cast("string")).otherwise(v)


def extract_version(c: Column) -> Column:
    """First version-like number in a string, '' if none."""
    return F.regexp_extract(c, RE_VERSION, 0)

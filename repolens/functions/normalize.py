"""Repository normalisation expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from repolens.schemas import NA, SUPPORTED_LANGUAGES


def language_map() -> Column:
    """Literal alias -> display-name map (13 entries, folded into the plan)."""
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(SUPPORTED_LANGUAGES.items())])


def display_language(alias: Column, pass_through: bool = False) -> Column:
    """Alias to display name (C10). With ``pass_through`` an unknown alias is
    returned unchanged (C25); otherwise it maps to NULL."""
    mapped = F.try_element_at(language_map(), alias)
    return F.coalesce(mapped, alias) if pass_through else mapped


def license_name(license_struct: Column) -> Column:
    """``license.name`` with the missing-value sentinel."""
    return F.coalesce(license_struct.getField("name"), F.lit(NA))


def has_license(license_value: Column) -> Column:
    return (license_value != F.lit(NA)).cast("int")


def not_null_flag(c: Column) -> Column:
    """1 when present (an empty string counts as present) (C4)."""
    return c.isNotNull().cast("int")


def bool_flag(c: Column) -> Column:
    """Boolean to 0/1."""
    return c.cast("int")

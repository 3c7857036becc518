"""Keyed upsert and schema-aligned append."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from repolens.functions.dates import ntz_lit


def upsert_merge(
    old: DataFrame,
    new: DataFrame,
    keys: list[str],
    update_cols: list[str] | None = None,
) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET <update_cols>.

    New keys are inserted; on a key match the ``update_cols`` take the new
    row's values (even NULL) and every other column keeps the old value.
    NULL keys never conflict. ``update_cols=None`` updates every non-key
    column. One full outer join on the keys; both sides are key-unique.
    """
    keys = list(keys)
    cols = old.columns
    for c in new.columns:
        if c not in cols:
            cols = cols + [c]
    update = set(update_cols if update_cols is not None else [c for c in cols if c not in keys])
    o = old.select(*[F.col(c).alias(f"__o_{c}") for c in old.columns], F.lit(True).alias("__o"))
    n = new.select(*[F.col(c).alias(f"__n_{c}") for c in new.columns], F.lit(True).alias("__n"))
    cond = reduce(lambda a, b: a & b, [F.col(f"__o_{k}") == F.col(f"__n_{k}") for k in keys])
    joined = o.join(n, cond, "full_outer")
    both = F.col("__o").isNotNull() & F.col("__n").isNotNull()
    out = []
    for c in cols:
        oc = F.col(f"__o_{c}") if c in old.columns else F.lit(None)
        nc = F.col(f"__n_{c}") if c in new.columns else F.lit(None)
        matched = nc if c in update else oc
        out.append(F.when(both, matched).when(F.col("__n").isNotNull(), nc).otherwise(oc).alias(c))
    return joined.select(*out)


def align_to(df: DataFrame, schema: T.StructType, defaults: dict | None = None) -> DataFrame:
    """Target column order, only target columns, missing ones defaulted or
    NULL, each cast to the target type (B5)."""
    defaults = defaults or {}
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, T.TimestampNTZType):
            cols.append(ntz_lit(defaults.get(f.name)).alias(f.name))
        else:
            cols.append(F.lit(defaults.get(f.name)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_aligned(
    target: DataFrame, batch: DataFrame, defaults: dict | None = None
) -> DataFrame:
    """Append ``batch`` to ``target`` after aligning it to the target schema."""
    return target.unionByName(align_to(batch, target.schema, defaults))

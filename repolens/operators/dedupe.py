"""Keep-latest and de-duplication.

All of them are written as aggregations so that Spark combines map-side
before the shuffle: a key that holds a third of the rows is reduced to one
partial row per input partition, never gathered into a single task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repolens.session import cut_lineage

_LATEST = "__latest"


def _any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])


def keep_latest(
    df: DataFrame, keys: list[str], date_col: str = "updated_at", ties: str = "all"
) -> DataFrame:
    """Delete every row that has a strictly newer row with equal keys.

    ``ties="all"`` (default): rows tied on the latest date all survive; rows
    with a NULL key or a NULL date are never deleted (SQL ``=`` and ``<``
    never hold on NULL). Plan: partial ``max`` per key, then a left join
    back on the keys and a ``date >= max`` filter; AQE splits a hot key on
    the large side.
    ``ties="one"``: one row per key (greatest date, then greatest row),
    by a partial aggregation of whole rows, which Spark sorts by key.
    """
    keys = list(keys)
    protected = _any_null(keys) | F.col(date_col).isNull()
    candidates = df.where(~protected)
    if ties == "one":
        others = [c for c in df.columns if c not in keys]
        best = candidates.groupBy(*keys).agg(
            F.max(F.struct(F.col(date_col).alias("__d"), *[F.col(c) for c in others])).alias("__r")
        )
        picked = best.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in others]).select(*df.columns)
        return picked.unionByName(df.where(protected))
    if ties != "all":
        raise ValueError("ties must be 'all' or 'one'")
    latest = candidates.groupBy(*keys).agg(F.max(date_col).alias(_LATEST))
    latest = latest.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], _LATEST)
    left = df.alias("__l")
    cond = reduce(lambda a, b: a & b, [F.col(f"__l.{k}") == F.col(f"__k{i}") for i, k in enumerate(keys)])
    # ``df`` is read twice, once for its keys and dates only. ``latest`` is
    # unique per key, so the left join never duplicates a row; protected rows find no partner and are kept by
    # the filter. The date test stays out of the join keys, so the join is
    # clustered on ``keys`` only and an input already partitioned by them
    # (e.g. after a de-duplication) is not re-shuffled.
    joined = left.join(latest, on=cond, how="left")
    kept = joined.where(protected | (F.col(f"__l.{date_col}") >= F.col(_LATEST)))
    return kept.select(*[F.col(f"__l.{c}").alias(c) for c in df.columns])


def dedupe_first(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """One row per key: the first by ``order_cols`` (ties broken by the rest
    of the row) (G1). A partial ``min(struct)`` aggregation, which Spark sorts
    by key on both sides of the shuffle."""
    keys = list(keys)
    order_cols = [c for c in order_cols if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_cols]
    agg = df.groupBy(*keys).agg(F.min(F.struct(*order_cols, *rest)).alias("__r"))
    return agg.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in order_cols + rest]).select(
        *df.columns
    )


def dedupe_repeated(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    """``dedupe_first`` for wide rows of keys that seldom repeat: the keys that do are counted first (keys alone
    are shuffled) and written, and only their rows are aggregated; all others stay where they are. Same rows,
    whatever the keys; ``df`` is read three times, the first time for its keys only."""
    keys = list(keys)
    counts = df.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    found = cut_lineage(counts.where(F.col("__n") > 1).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]), "repeated")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)])
    once = df.join(found, same, "left_anti")
    return once.unionByName(dedupe_first(df.join(found, same, "left_semi"), keys, order_cols))



def best_version_per_package(
    df: DataFrame,
    keys: tuple[str, ...] = ("repo_id", "package"),
    version_col: str = "version",
    operator_col: str = "operator",
) -> DataFrame:
    """One row per (repo, package): a NULL version wins, else the greatest
    version text; among equal versions the greatest operator, NULL last
    (C24). A partial ``max(struct)`` aggregation, which Spark sorts by key."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys and c not in (version_col, operator_col)]
    best = df.groupBy(*keys).agg(
        F.max(
            F.struct(
                F.col(version_col).isNull().alias("__vnull"),
                F.col(version_col).alias(version_col),
                F.col(operator_col).alias(operator_col),
                *[F.col(c) for c in rest],
            )
        ).alias("__r")
    )
    cols = [version_col, operator_col] + rest
    return best.select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols]).select(*df.columns)

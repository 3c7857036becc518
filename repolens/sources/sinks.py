"""Partitioned sinks and table maintenance.

Landed data is partitioned by (language, month) and sorted by day inside
the files: one directory per language-day would hold a few hundred rows
each (small-file blow-up at scale), while month directories stay large
and Parquet min/max statistics still skip row groups by day.

Write modes (per landing key = (language, day)):

* ``append``: add the batch.
* ``skip``: add only keys not landed yet (left-anti join on the key columns
  of the existing data; only the batch's months are scanned, two columns).
* ``overwrite``: replace the keys present in the batch, keep every other
  key. The affected month partitions (found by a semi-join that Spark turns
  into dynamic partition pruning, so untouched months are not even read)
  are rebuilt once, in a hidden folder beside the data that readers skip, and
  put in place by renames; untouched months are never rewritten. A run that is lost
  between two renames leaves whole months, old or new; run again, it ends the same.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions.dates import ntz_lit
from pyspark.sql import types as T

from repolens.schemas import LANDING_PARTITIONS
from repolens.session import cut_lineage, own_scratch, path_exists, swap_partitions


def with_month(df: DataFrame, date_col: str = "created_date", month_col: str = "created_month") -> DataFrame:
    return df.withColumn(month_col, F.trunc(F.col(date_col), "month"))


def _existing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if path_exists(spark, path) else None


def _write(df: DataFrame, path: str, partition_cols: list[str], date_col: str) -> None:
    # One shuffle on the partition keys, as a REBALANCE: AQE coalesces small
    # (language, month) groups and splits a large one into advisory-sized
    # tasks, so no single task writes a hot partition and files stay big.
    out = df.hint("rebalance", *partition_cols).sortWithinPartitions(*partition_cols, date_col)
    # Landed texts (base64) shrink by entropy coding only, which the default codec lacks.
    out.write.partitionBy(*partition_cols).mode("append").option("compression", "zstd").parquet(path)


@own_scratch
def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: list[str] | None = None,
    mode: str = "overwrite",
    schema: T.StructType | None = None,
    key_cols: tuple[str, ...] = ("language", "created_date"),
    date_col: str = "created_date",
) -> None:
    """Land ``df`` under ``path`` (see the module notes for modes).
    Zero rows write nothing."""
    spark = df.sparkSession
    partition_cols = list(partition_cols or LANDING_PARTITIONS)
    if "created_month" in partition_cols and "created_month" not in df.columns:
        df = with_month(df, date_col)
    keys = list(key_cols)
    if mode == "append":
        _write(df, path, partition_cols, date_col)
        return
    existing = _existing(spark, path, schema or df.schema)
    if mode == "skip":
        out = df
        if existing is not None:
            # Only the batch's months are scanned: the semi-join on the
            # partition columns gets a dynamic partition-pruning filter.
            touched = df.select(*partition_cols).distinct()
            have = existing.join(touched, partition_cols, "left_semi").select(*keys).distinct()
            out = df.join(have, keys, "left_anti")
        _write(out, path, partition_cols, date_col)
        return
    if mode != "overwrite":
        raise ValueError("mode must be 'append', 'skip' or 'overwrite'")
    if existing is None:
        _write(df, path, partition_cols, date_col)
        return
    # The batch's keys once, narrow; its rows once, in the write of the rebuilt months.
    found = cut_lineage(df.select(*dict.fromkeys(partition_cols + keys)).distinct(), "landing-keys")
    kept = (
        existing.join(found.select(*partition_cols).distinct(), partition_cols, "left_semi")
        .join(found.select(*keys).distinct(), keys, "left_anti")
        .select(*df.columns)
    )
    staging = f"{path.rstrip('/')}/.rebuilt-{uuid.uuid4().hex[:12]}"
    _write(kept.unionByName(df), staging, partition_cols, date_col)
    swap_partitions(spark, staging, path, len(partition_cols))


def file_metadata(
    landed: DataFrame,
    batch_ts: dt.datetime | None = None,
    language_col: str = "language",
    date_col: str = "created_date",
) -> DataFrame:
    """Per (language, date) partition, row count and landed file path.

    ``landed`` must come straight from a file scan (it reads
    ``_metadata.file_path``); elapsed seconds are not observable after the
    fact and are left NULL.
    """
    out = landed.groupBy(
        F.col(language_col).alias("repo_language"), F.col(date_col).alias("repo_creation_date")
    ).agg(
        F.count(F.lit(1)).alias("n_repos"),
        F.min(F.col("_metadata.file_path")).alias("file_path"),
    ).withColumn("elapsed_time_seconds", F.lit(None).cast("long"))
    if batch_ts is not None:
        out = out.withColumn("updated_at", ntz_lit(batch_ts))
    return out


# Columns an on-conflict re-landing updates in the file-metadata table; the
# row count keeps its first value.
FILE_METADATA_KEYS = ["repo_language", "repo_creation_date"]
FILE_METADATA_UPDATE = ["file_path", "elapsed_time_seconds", "updated_at"]


def upsert_file_metadata(old: DataFrame, new: DataFrame) -> DataFrame:
    """B7 on ``repo_file_metadata``: insert new (language, day) keys; for an
    existing key update path, seconds and timestamp, keep ``n_repos``."""
    from repolens.operators.upsert import upsert_merge

    return upsert_merge(old, new, FILE_METADATA_KEYS, FILE_METADATA_UPDATE)


def clear_table(df: DataFrame, path: str) -> None:
    """Replace a table by an empty one with the same schema."""
    df.limit(0).write.mode("overwrite").parquet(path)


def table_stats(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """Exact row count and total bytes of each Parquet table.

    One scan a table that reads no column; the rows of all tables are counted
    by file in one aggregate, and the files' counts and sizes (``_metadata``)
    summed by table. A table without rows counts 0 and has NULL bytes; there
    is no index size on Spark.
    """
    files = [
        spark.read.parquet(path).select(F.lit(name).alias("table_name"), "_metadata.file_path", "_metadata.file_size")
        for name, path in tables.items()
    ]
    named = [(name, None, None) for name in tables]  # a row without a file keeps tables without rows
    rows = reduce(DataFrame.unionByName, files, spark.createDataFrame(named, "table_name string, file_path string, file_size long"))
    by_file = rows.groupBy("table_name", "file_path", "file_size").agg(F.count("file_path").alias("n"))
    return by_file.groupBy("table_name").agg(F.sum("n").alias("row_count"), F.sum("file_size").alias("total_bytes"))

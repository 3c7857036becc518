"""availableNow file pick-up feeding the batch marts (J7 / J10 incremental)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from repolens.schemas import RAW_REPO


def landed_repo_stream(spark: SparkSession, landed_path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming read of the landed search-item dataset (declared schema,
    hive partitions discovered)."""
    reader = spark.readStream.schema(RAW_REPO).option("basePath", landed_path)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(landed_path)


def process_new_files(
    spark: SparkSession,
    landed_path: str,
    checkpoint_path: str,
    handle_batch: Callable[[DataFrame, int], None],
    max_files_per_trigger: int | None = None,
) -> None:
    """Run ``handle_batch(batch_df, batch_id)`` over every file landed since
    the last run, then stop. A lost batch is handled again under its id;
    ``handle_batch`` must be idempotent per ``batch_id`` (e.g. write with a
    dynamic partition overwrite)."""
    stream = landed_repo_stream(spark, landed_path, max_files_per_trigger)
    q = (
        stream.writeStream.foreachBatch(handle_batch)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def marts_batch_writer(out_path: str, as_of: dt.date, batch_ts: dt.datetime) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` handler that normalises a micro-batch and writes the
    three modelled tables, each batch to its own partition ``batch_id``: a batch that is
    handled again replaces its own rows (keep-latest is applied when they are read)."""
    from repolens.operators.tables import build_tables, normalize_repos

    def handle(batch: DataFrame, batch_id: int) -> None:
        norm = normalize_repos(batch, as_of)
        for name, df in build_tables(norm, batch_ts).items():
            df.write.mode("overwrite").parquet(f"{out_path}/{name}/batch_id={batch_id}")

    return handle

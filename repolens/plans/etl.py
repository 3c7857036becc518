"""The whole ETL (J9): both flows over one window, stage by stage, restartable.

Stages run in the order of their data: ``land`` (search responses -> landed
items and their file metadata), ``marts`` (items -> modelled tables and
roll-ups), ``structure``, ``content``, ``packages``. A stage that has committed
under a run's name is noted in the manifest and not run again, so a run that
was lost is started again under its name and goes on after its last
committed stage. ``marts`` and ``packages`` note themselves in the manifest that
publishes their tables; the stages that land files may be run twice without
harm and are noted after their write.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from repolens.functions.dates import as_date, shift_date
from repolens.plans import content as C
from repolens.plans.marts import mart
from repolens.plans.pipelines import land_search_pages, run_repo_info
from repolens.schemas import CONTENT_LANGUAGES, DEFAULT_PATH_PATTERN, FULL_PATH_PATTERN
from repolens.sources import readers as R
from repolens.sources import versions as V

STAGES = ("land", "marts", "structure", "content", "packages")


@dataclass(frozen=True)
class Sources:
    """Where the landed responses lie. ``blobs``: (url, content) of fetched files; ``multi_line``: one
    JSON response a file, else one a line."""

    pages: str | None = None
    trees: str | None = None
    blobs: str | None = None
    multi_line: bool = True


def run_etl(
    spark: SparkSession,
    sources: Sources,
    root: str,
    as_of,
    n_last_days: int = 0,
    start=None,
    run: str | None = None,
    info: bool = True,
    contents: bool = True,
    overwrite: bool = False,
    languages=None,
    min_stars: int = 10,
    structure_path_pattern: str | None = FULL_PATH_PATTERN,
    content_path_pattern: str | list[str] = DEFAULT_PATH_PATTERN,
    batch_ts: dt.datetime | None = None,
    only: tuple[str, ...] = STAGES,
    current_branches: DataFrame | None = None,
) -> list[str]:
    """Run both flows over [as_of - n_last_days, as_of] (or from ``start``) into ``root``; returns the stages that ran.

    ``info`` and ``contents`` switch the flows, ``only`` single stages. The content flow takes the languages among
    ``languages`` that it supports."""
    begin, end = (as_date(start) if start is not None else shift_date(as_of, n_last_days)), as_date(as_of)
    run = run or f"{begin}_{end}"
    batch_ts = batch_ts or dt.datetime.combine(end, dt.time())
    marts_root = f"{root}/marts"
    crawled = [x for x in R.parse_languages(languages) if x in CONTENT_LANGUAGES]

    def land() -> None:
        land_search_pages(spark, sources.pages, f"{root}/info", "overwrite" if overwrite else "skip", languages, sources.multi_line, f"{root}/file_metadata", batch_ts)

    def marts() -> None:
        run_repo_info(spark, f"{root}/info", marts_root, begin, end, end, batch_ts, languages, align=None, run=run)

    def structure() -> None:
        trees = R.read_tree_pages(spark, sources.trees, sources.multi_line)
        repo = mart(spark, marts_root, "repo").drop("in_month")
        C.run_structure(spark, repo, trees, f"{root}/structure", begin, end, crawled, structure_path_pattern, min_stars, None, overwrite, current_branches)

    def content() -> None:
        C.run_content(spark, f"{root}/structure", spark.read.parquet(sources.blobs), f"{root}/content", begin, end, crawled, content_path_pattern, None, overwrite)

    def packages() -> None:
        C.run_packages(spark, f"{root}/content", marts_root, batch_ts, begin, end, crawled, run=run)

    ready = {"land": info and sources.pages, "marts": info, "structure": contents and crawled, "content": contents and crawled, "packages": contents and crawled}
    actions: dict[str, Callable[[], None]] = {"land": land, "marts": marts, "structure": structure, "content": content, "packages": packages}
    ran = []
    for stage in STAGES:
        if not ready[stage] or stage not in only or stage in V.read_manifest(spark, marts_root).done.get(run, []):
            continue
        actions[stage]()
        if stage not in ("marts", "packages"):
            V.mark_done(spark, marts_root, run, stage)
        ran.append(stage)
    return ran

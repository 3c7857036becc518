"""Pipelines (J2-J11): the batch jobs, as ordered DataFrame dependencies.

Nothing loops over files or dates on the driver: a run reads the whole
window of landed data once, and Spark parallelises by file and by key.
Time enters only as arguments (``as_of``, ``batch_ts``), never ``now()``.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from repolens.functions.dates import ntz_lit, check_date_range, shift_date
from repolens.operators.dedupe import keep_latest
from repolens.operators.joins import (
    branch_fallback,
    content_lookup,
    files_by_pattern,
    repos_with_files,
    tree_blobs,
)
from repolens.operators.packages import package_table
from repolens.operators.reports import (
    categorical_top_n,
    corr_matrix,
    filter_topics,
    filters_info,
    has_properties,
    kpi_report,
    language_options,
    licenses_by_repos,
    topic_cloud,
    package_options,
    packages_data,
    repos_by_many,
    rollup_filtered,
    topic_options,
    topics_data,
)
from repolens.operators.rollups import keep_top_k, repo_rollup, topic_rollup
from repolens.operators.tables import normalize_repos, owner_table, repo_table, topic_table
from repolens.schemas import (
    RAW_REPO,
    DEFAULT_PATH_PATTERN,
    FULL_PATH_PATTERN,
    REFRESH_WINDOW_DAYS,
    REPO_FILE_METADATA,
    SUPPORTED_LANGUAGES,
    TABLE_KEYS,
    TOP_K_VALUES_TO_KEEP,
)
from repolens.plans.marts import MART_NAMES, marts, refresh_marts
from repolens.session import path_exists, cut_lineage, shared_scratch
from repolens.sources import readers as R
from repolens.sources import versions as V
from repolens.sources.sinks import upsert_file_metadata, write_partitioned


def month_aligned(start, end) -> tuple[dt.date, dt.date]:
    """Widen [start, end] to whole months so a partial-month refresh does
    not replace a month's roll-up row with a partial one."""
    s, e = check_date_range(start, end)
    first = s.replace(day=1)
    nxt = (e.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    return first, nxt - dt.timedelta(days=1)


def build_repo_marts(
    raw: DataFrame,
    as_of,
    batch_ts: dt.datetime,
    start=None,
    end=None,
    top_k: int = TOP_K_VALUES_TO_KEEP,
    order_cols: list[str] | None = None,
    existing: dict[str, DataFrame] | None = None,
    materialize: bool = True,
) -> dict[str, DataFrame]:
    """J2 + J3: landed items -> repo, repo_topic, owner (keep-latest), then
    the top-k licence / branch clean-up of ``repo``, then the topic and repo
    roll-ups over the creation window.

    ``existing`` (optional) holds the current modelled tables; the batch is
    appended and keep-latest runs over the union, like the load + delete of
    the original. Only supported languages are read (A3).

    ``materialize`` writes the two shared intermediates (normalised batch,
    cleaned repo table) as reliable checkpoints under the shared checkpoint
    folder instead of recomputing their lineage for every consumer.
    """
    raw = raw.where(F.col("language").isin(list(SUPPORTED_LANGUAGES)))
    norm = normalize_repos(raw, as_of, order_cols=order_cols)
    if materialize:
        # Three tables are cut from the normalised batch: write it once.
        norm = cut_lineage(norm, "norm")
    tables = {
        "repo": repo_table(norm, batch_ts),
        "repo_topic": topic_table(norm, batch_ts),
        "owner": owner_table(norm, batch_ts),
    }
    if existing:
        for name, df in existing.items():
            if name in tables:
                tables[name] = df.unionByName(tables[name], allowMissingColumns=True)
    for name in list(tables):
        tables[name] = keep_latest(tables[name], TABLE_KEYS[name], "updated_at")
    repo = keep_top_k(tables["repo"], ["license", "default_branch"], top_k)
    if materialize:
        # Both roll-ups (and the caller's writes) read the cleaned repo table.
        repo = cut_lineage(repo, "repo")
    tables["repo"] = repo
    tables["topic_analytics"] = topic_rollup(tables["repo_topic"], repo, start, end, batch_ts)
    tables["repo_analytics"] = repo_rollup(repo, start, end, batch_ts)
    if existing:
        # Roll-up rows of months outside the window stay; a re-computed
        # month replaces its older row (keep-latest by month key).
        for name in ("topic_analytics", "repo_analytics"):
            if name in existing:
                merged = existing[name].unionByName(tables[name], allowMissingColumns=True)
                tables[name] = keep_latest(merged, TABLE_KEYS[name], "updated_at")
    return tables


def package_job(content: DataFrame, batch_ts: dt.datetime | None = None, existing: DataFrame | None = None) -> DataFrame:
    """Content -> package rows -> append -> keep latest by
    (repo_id, package). ``existing`` rows can only be merged under a ``batch_ts``."""
    if existing is not None and batch_ts is None:
        raise ValueError("batch_ts is needed to merge with existing packages")
    pk = package_table(content)
    if batch_ts is not None:
        pk = pk.withColumn("updated_at", ntz_lit(batch_ts))
    if existing is not None:
        pk = existing.unionByName(pk, allowMissingColumns=True)
    return keep_latest(pk, TABLE_KEYS["package"], "updated_at") if batch_ts is not None else pk


def structure_job(
    repo: DataFrame,
    trees: DataFrame,
    language: str,
    creation_date,
    path_pattern: str = FULL_PATH_PATTERN,
    min_stars: int = 10,
    limit: int | None = None,
    current_branches: DataFrame | None = None,
) -> DataFrame:
    """Repositories of a (language, day) -> file rows of their landed
    trees (blobs matching the pattern); repositories without files keep one
    row with NULL path and url.

    When the landed trees carry a ``branch``, the tree of the requested
    branch is used, else the one of the repository's current default branch
    (``current_branches``: repo_id, default_branch) (E9)."""
    repos = R.select_repos_to_crawl(repo, language, creation_date, min_stars, limit)
    if "branch" in trees.columns:
        cur = current_branches if current_branches is not None else repos.select(
            F.col("id").alias("repo_id"), F.col("branch").alias("default_branch")
        )
        req = repos.join(cur.withColumnRenamed("repo_id", "id"), "id", "left")
        chosen = branch_fallback(req, trees).select(
            F.col("id").alias("repo_id"), F.col("tree_branch").alias("branch")
        )
        trees = trees.join(chosen, ["repo_id", "branch"], "left_semi")
    files = tree_blobs(trees, path_pattern)
    return repos_with_files(repos.withColumnRenamed("id", "repo_id"), files, "repo_id").select(
        "repo_id", "path", "url"
    )


def content_job(
    structure: DataFrame,
    blobs: DataFrame,
    path_pattern: str | list[str] = DEFAULT_PATH_PATTERN,
    limit: int | None = None,
) -> DataFrame:
    """Structure rows -> one content row per (file, matching pattern),
    tagged with the pattern as ``key``."""
    patterns = path_pattern.split("|") if isinstance(path_pattern, str) else list(path_pattern)
    matched = files_by_pattern(structure, patterns, limit=limit, order_cols=["path", "url"])
    return content_lookup(matched, blobs)


def trailing_window(as_of, window: int = REFRESH_WINDOW_DAYS) -> tuple[dt.date, dt.date]:
    """[as_of - window, as_of - 1], recomputed at every run."""
    return shift_date(as_of, window), shift_date(as_of, 1)


def refresh_landed(
    batch: DataFrame, path: str, as_of, window: int = REFRESH_WINDOW_DAYS, schema=None,
) -> tuple[dt.date, dt.date]:
    """J10 sink side: replace the landed (language, day) keys of the
    trailing window; every other day is left as it is."""
    start, end = trailing_window(as_of, window)
    part = batch.where(F.col("created_date").between(F.lit(start), F.lit(end)))
    write_partitioned(part, path, mode="overwrite", schema=schema)
    return start, end


def partition_refresh_demo(spark: SparkSession, raw: DataFrame, as_of) -> DataFrame:
    """B1/B2/J10 round trip under the shared checkpoint folder: land every
    supported partition, skip-if-exists a second landing, overwrite the
    trailing window with changed rows, then re-read (A1-A3)."""
    path = shared_scratch(spark, "landed")
    raw = raw.where(F.col("language").isin(list(SUPPORTED_LANGUAGES)))
    write_partitioned(raw, path, mode="overwrite", schema=RAW_REPO)
    # A second landing in skip mode must not change anything.
    write_partitioned(
        raw.withColumn("stargazers_count", F.col("stargazers_count") + 1), path, mode="skip", schema=RAW_REPO
    )
    changed = raw.withColumn("stargazers_count", F.col("stargazers_count") + 1000)
    refresh_landed(changed, path, as_of, schema=RAW_REPO)
    back = R.read_raw_repos(spark, path)
    return back.select("id", "language", "created_date", "stargazers_count")


def run_repo_info(
    spark: SparkSession,
    landed_path: str,
    out_path: str,
    start,
    end=None,
    as_of=None,
    batch_ts: dt.datetime | None = None,
    languages=None,
    align: str | None = "month",
    incremental: bool = True,
    run: str | None = None,
) -> dict[str, DataFrame]:
    """J7 (transform side): read the window once (widened to whole months), merge it into the
    current tables, rewriting only the partitions it touches, and publish all tables by one manifest.
    ``incremental=False`` rebuilds the tables from the window alone."""
    s, e = check_date_range(start, end)
    as_of = as_of or e
    batch_ts = batch_ts or dt.datetime.combine(as_of, dt.time())
    ws, we = month_aligned(s, e) if align == "month" else (s, e)
    # Month alignment: a refreshed month is rebuilt from all of its days.
    raw = R.read_raw_repos(spark, landed_path, languages, ws, we, with_file_order=True)
    _read_tables(spark, out_path)
    return refresh_marts(spark, out_path, raw, as_of, batch_ts, order_cols=["__file", "__row"], rebuild=not incremental, run=run)


def _read_tables(spark: SparkSession, out_path: str) -> dict[str, DataFrame]:
    """The current tables; empty on a first run. Tables without a manifest that names them are an
    error: their history must not be replaced by a window."""
    found = marts(spark, out_path)
    there = [name for name in MART_NAMES if path_exists(spark, f"{out_path}/{name}")]
    if there and not found and V.read_manifest(spark, out_path).number == 0:
        plain = [n for n in there if not V.has_batches(spark, f"{out_path}/{n}")]
        if plain:
            raise ValueError(f"{out_path} holds {plain} but no manifest names them")
    return found


def land_search_pages(
    spark: SparkSession,
    pages_path: str,
    landed_path: str,
    mode: str = "skip",
    languages=None,
    multi_line: bool = True,
    metadata_path: str | None = None,
    batch_ts: dt.datetime | None = None,
) -> DataFrame:
    """J7 extract side (re-aimed): landed search responses (JSON) -> items
    partitioned by (language alias, creation month), one landing key per
    (language, creation day). ``mode`` is B2's skip-if-exists or overwrite.

    Items get the alias of the ``language=`` folder that their response lies in; responses in no
    such folder are tagged with the alias of the display language that each item
    reports. Unsupported languages are dropped (A3).

    With ``metadata_path`` the file-metadata table there is kept up (B7, B8): rows, folder and whole seconds of this
    write for each (language, day) that it lands, upserted by that key."""
    from repolens.functions.dates import parse_iso_timestamp

    items = R.read_search_pages(spark, pages_path, multi_line)
    if "language" in spark.read.json(pages_path, schema="total_count long").columns:
        landed = items.where(F.col("language").isin(list(SUPPORTED_LANGUAGES)))
    else:
        rev = F.create_map(*[F.lit(x) for kv in SUPPORTED_LANGUAGES.items() for x in (kv[1], kv[0])])
        landed = items.withColumn("language", F.try_element_at(rev, F.col("language"))).where(F.col("language").isNotNull())
    if languages is not None:
        landed = landed.where(F.col("language").isin(R.parse_languages(languages)))
    landed = landed.withColumn("created_date", F.to_date(parse_iso_timestamp(F.col("created_at"))))
    landed = landed.select(*[f.name for f in RAW_REPO.fields if f.name != "created_month"])
    if metadata_path is None:
        write_partitioned(landed, landed_path, mode=mode, schema=RAW_REPO)
        return landed
    fresh = landed
    if mode == "skip":  # the days that this write adds
        have = spark.read.schema(RAW_REPO).parquet(landed_path) if path_exists(spark, landed_path) else None
        if have is not None:
            fresh = landed.join(have.select("language", "created_date").distinct(), ["language", "created_date"], "left_anti")
    days = cut_lineage(fresh.select("language", "created_date").distinct(), "landed-days")
    if days.isEmpty():  # nothing new: no write, no row
        return landed
    written = Observation("landed")
    began = time.monotonic()
    write_partitioned(fresh.observe(written, F.count(F.lit(1)).alias("rows")), landed_path, mode="append" if mode == "skip" else mode, schema=RAW_REPO)
    seconds = int(time.monotonic() - began)
    rows = record_landing(spark, landed_path, days, metadata_path, seconds, batch_ts)
    if rows != written.get["rows"]:
        raise RuntimeError(f"{written.get['rows']} items were written, {rows} lie in the landed days: another run writes them too")
    return landed


def record_landing(spark: SparkSession, landed_path: str, days: DataFrame, metadata_path: str, seconds: int, batch_ts: dt.datetime | None) -> int:
    """Upsert a row for each landed (language, day): its rows as they lie there now, their folder and the seconds
    of the write. Returns the rows of those days."""
    there = spark.read.schema(RAW_REPO).parquet(landed_path).select("language", "created_date", F.col("_metadata.file_path").alias("file"))
    folder = F.regexp_replace("file", "/[^/]*$", "")
    new = there.join(days, ["language", "created_date"], "left_semi").groupBy(
        F.col("language").alias("repo_language"), F.col("created_date").alias("repo_creation_date")
    ).agg(F.count(F.lit(1)).alias("n_repos"), F.min(folder).alias("file_path"))
    new = cut_lineage(new, "file-metadata").withColumn("elapsed_time_seconds", F.lit(seconds).cast("long")).withColumn("updated_at", ntz_lit(batch_ts))
    manifest = V.read_manifest(spark, metadata_path)
    old = V.load(spark, metadata_path, manifest, "repo_file_metadata", REPO_FILE_METADATA, [])
    draft = manifest.draft()
    rows = upsert_file_metadata(old, new).select(*REPO_FILE_METADATA.names)
    V.write_batch(rows, metadata_path, draft, "repo_file_metadata", [], [""])
    V.publish(spark, metadata_path, draft)
    return new.agg(F.sum("n_repos")).first()[0] or 0


def landed_file_metadata(spark: SparkSession, metadata_path: str) -> DataFrame:
    """The file-metadata table that ``land_search_pages`` keeps."""
    return V.load(spark, metadata_path, V.read_manifest(spark, metadata_path), "repo_file_metadata", REPO_FILE_METADATA, [])


def run_repo_info_flow(
    spark: SparkSession,
    pages_path: str | None,
    landed_path: str,
    out_path: str,
    start,
    end=None,
    as_of=None,
    extract: bool = True,
    transform: bool = True,
    overwrite_existed_files: bool = False,
    languages=None,
) -> dict[str, DataFrame] | None:
    """Optional landing of search responses, then the transform run."""
    if extract and pages_path:
        land_search_pages(spark, pages_path, landed_path, "overwrite" if overwrite_existed_files else "skip", languages)
    if transform:
        return run_repo_info(spark, landed_path, out_path, start, end, as_of=as_of, languages=languages)
    return None


REQUIREMENTS_KEY = r"requirements.*\.txt"


def run_repo_content_flow(
    repo: DataFrame,
    trees: DataFrame,
    blobs: DataFrame,
    language: str = "python",
    creation_date=None,
    structure: bool = True,
    content: bool = True,
    packages: bool = True,
    structure_path_pattern: str = FULL_PATH_PATTERN,
    content_path_pattern: str = DEFAULT_PATH_PATTERN,
    min_stars: int = 10,
    batch_ts: dt.datetime | None = None,
    package_key: str = REQUIREMENTS_KEY,
    landed_structure: DataFrame | None = None,
    landed_content: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Structure -> content -> packages, each stage switchable. A stage whose
    predecessor is switched off works on what that one landed before (``landed_structure``,
    ``landed_content``: what ``read_structure`` and ``read_content`` give)."""
    out: dict[str, DataFrame] = {}
    if structure:
        out["structure"] = structure_job(repo, trees, language, creation_date, structure_path_pattern, min_stars)
    if content:
        found = out.get("structure", landed_structure)
        if found is None:
            raise ValueError("the content stage needs the structure stage or landed_structure")
        out["content"] = content_job(found.where(F.col("path").isNotNull()), blobs, content_path_pattern)
    if not packages:
        return out
    files = out.get("content", landed_content)
    if files is None:
        raise ValueError("the package stage needs the content stage or landed_content")
    # The package stage reads only the requirements-file partition (A5).
    req = files.where(F.col("key") == F.lit(package_key))
    out["package"] = package_job(req.withColumn("language", F.lit(language)), batch_ts)
    return out


def dashboard_reports(
    repo_analytics: DataFrame,
    topic_analytics: DataFrame,
    package: DataFrame | None = None,
    creation_date_range=None,
    last_commit_date_range=None,
    languages=None,
) -> dict[str, DataFrame]:
    """The data behind one dashboard page, as lazy DataFrames."""
    from repolens.schemas import SUPPORTED_LANGUAGES as SL

    filters = filters_info(repo_analytics)
    all_topics = topics_data(topic_analytics)
    repos = rollup_filtered(repo_analytics, creation_date_range, last_commit_date_range, languages)
    language_list = list(SL.values())
    topics = filter_topics(all_topics, language_list, languages)
    out = {
        "filters": filters,
        "language_options": language_options(filters),
        "topics": topics,
        "repos": repos,
        "kpi": kpi_report(repos, topics),
        "topic_options": topic_options(all_topics, language_list, languages),
        "topic_cloud": topic_cloud(topics),
        "licenses": licenses_by_repos(repos),
        "corr": corr_matrix(repos),
    }
    if package is not None:
        out["packages"] = packages_data(package)
    return out


#: The four splits of the page: flag sum and label.
PAGE_SPLITS = [
    ("n_repos_with_license", "has_license"), ("n_archived_repos", "is_archived"),
    ("n_repos_with_wiki", "has_wiki"), ("n_repos_with_topic", "has_topic"),
]
PAGE_CHARTS = ["creation_year", "last_commit_year", "language", "license"]


def dashboard_page(
    repo_analytics: DataFrame,
    topic_analytics: DataFrame,
    package: DataFrame | None = None,
    creation_date_range=None,
    last_commit_date_range=None,
    languages=None,
    topic_languages=None,
    top_licenses: int = 5,
    top_topics: int = 100,
) -> DataFrame:
    """All frames of the page as rows (frame, key, other, value).

    The filtered roll-up and the topics are written once; of the roll-up, all
    charts come from one grouping-sets pass, the splits, the KPIs and the
    correlations from one pass each. The tables themselves are read twice
    (``repo_analytics``: filters and filtered roll-up) and once (topics)."""
    language_list = list(SUPPORTED_LANGUAGES.values())
    filters = filters_info(repo_analytics)
    repos = cut_lineage(rollup_filtered(repo_analytics, creation_date_range, last_commit_date_range, languages), "page-repos")
    all_topics = cut_lineage(topics_data(topic_analytics, 1), "page-topics")
    topics = filter_topics(all_topics, language_list, topic_languages)
    charts = cut_lineage(repos_by_many(repos, PAGE_CHARTS), "page-charts")
    none = F.lit(None).cast("string")

    def rows(frame: str, df: DataFrame, key, value, other=none) -> DataFrame:
        return df.select(F.lit(frame).alias("frame"), key.cast("string").alias("key"), other.cast("string").alias("other"), value.cast("double").alias("value"))

    c = F.col
    kpi = kpi_report(repos, topics)
    kpi = kpi.select(F.inline(F.array(*[F.struct(F.lit(k).alias("name"), c(k).cast("double").alias("v")) for k in kpi.columns])))
    out = [
        rows("kpi", kpi, c("name"), c("v")),
        rows("filters", filters, c("language"), c("n_repos"), F.concat_ws("-", *[c(f"{x}_{y}_year") for x in ("creation", "last_commit") for y in ("start", "end")])),
        rows("language_options", language_options(filters), c("language"), c("n_repos")),
        rows("topic_options", topic_options(all_topics, language_list, topic_languages), c("topic"), F.lit(None)),
        rows("topic_cloud", topic_cloud(topics, top_topics), c("topic"), c("n_repos")),
        rows("corr", corr_matrix(repos), c("row"), c("corr"), c("col")),
    ]
    out += [rows(f"by_{x}", charts.where(c("dimension") == x), c("key"), c("n_repos")) for x in PAGE_CHARTS]
    licences = charts.where(c("dimension") == "license").select(c("key").alias("license"), "n_repos")
    out.append(rows("top_licenses", categorical_top_n(licences, "license", "n_repos", top_licenses), c("license"), c("n_repos")))
    splits = has_properties(repos, PAGE_SPLITS)
    out += [rows(label, splits.where(c("property") == label), c("answer"), c("n_repos")) for _, label in PAGE_SPLITS]
    if package is not None:
        freq = cut_lineage(packages_data(package), "page-packages")
        out.append(rows("packages", freq, c("package"), c("freq"), c("language")))
        out.append(rows("package_options", package_options(freq), c("package"), F.lit(None)))
    page = out[0]
    for part in out[1:]:
        page = page.unionByName(part)
    return page

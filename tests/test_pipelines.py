"""End-to-end runs over landed JSON responses (J5-J11, A7, A8, B8, B10,
B11, streaming pick-up)."""

import base64
import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from repolens.plans import pipelines as P
from repolens.session import shared_scratch
from repolens.sources import readers as R
from repolens.sources.sinks import clear_table, file_metadata, table_stats


def _item(i, lang, created, topics=None, license_name="MIT", owner="o1", stars=5):
    return {
        "id": i, "name": f"r{i}", "owner": {"login": owner, "html_url": f"https://x/{owner}"},
        "html_url": f"https://x/{owner}/r{i}", "language": lang, "description": None if i % 2 else "d",
        "topics": topics if topics is not None else ["ml", "Data"], "license": {"name": license_name} if license_name else None,
        "archived": False, "has_wiki": True, "size": 100 + i, "default_branch": "main",
        "stargazers_count": stars, "watchers_count": stars, "forks_count": 1, "open_issues_count": 0,
        "created_at": created, "pushed_at": "2024-01-20T10:00:00Z",
    }


@pytest.fixture(scope="module")
def landed(spark):
    root = shared_scratch(spark, "test-pipe")
    # The test writes its JSON fixtures with plain Python: strip the URI
    # scheme of the (local, test-only) checkpoint folder.
    local = root[len("file:"):] if root.startswith("file:") else root
    pages = os.path.join(local, "pages")
    os.makedirs(pages, exist_ok=True)
    page1 = {"total_count": 3, "items": [
        _item(1, "Python", "2024-01-02T10:00:00Z"),
        _item(2, "Python", "2024-01-02T13:00:00Z", topics=[]),
        _item(3, "Kotlin", "2024-01-02T10:00:00Z"),
    ]}
    page2 = {"total_count": 2, "items": [
        _item(4, "Go", "2024-01-03T01:00:00Z", license_name=None, owner="o2"),
        _item(1, "Python", "2024-01-02T10:00:00Z", stars=7),
    ]}
    for n, p in (("p1.json", page1), ("p2.json", page2)):
        with open(os.path.join(pages, n), "w") as fh:
            json.dump(p, fh)
    return root


def test_repo_info_flow(spark, landed):
    out = P.run_repo_info_flow(
        spark, f"{landed}/pages", f"{landed}/landed", f"{landed}/marts", "2024-01-01", "2024-01-31",
        as_of=dt.date(2024, 2, 1),
    )
    repo = {r.id: r for r in out["repo"].collect()}
    assert sorted(repo) == [1, 2, 4]  # Kotlin dropped, duplicate id 1 kept once
    assert repo[2].creation_date == dt.datetime(2024, 1, 3)  # 13:00 rounds up
    assert repo[4].license == "__NA__" and repo[4].language == "Go"
    topics = sorted((r.repo_id, r.topic) for r in out["repo_topic"].collect())
    assert topics == [(1, "data"), (1, "ml"), (2, "__NA__"), (4, "data"), (4, "ml")]
    ra = out["repo_analytics"]
    assert ra.agg(F.sum("n_repos")).first()[0] == 3
    owners = sorted((r.name, r.n_repos) for r in out["owner"].collect())
    assert owners == [("o1", 2), ("o2", 1)]
    # landing again in skip mode changes nothing
    P.land_search_pages(spark, f"{landed}/pages", f"{landed}/landed", mode="skip")
    assert R.read_raw_repos(spark, f"{landed}/landed").count() == 4
    reports = P.dashboard_reports(out["repo_analytics"], out["topic_analytics"])
    kpi = reports["kpi"].first()
    # every language selected: topics below the frequency floor (10) drop out
    assert kpi.n_repos == 3 and kpi.topics == 0
    narrow = P.dashboard_reports(out["repo_analytics"], out["topic_analytics"], languages=["Python"])
    kpi = narrow["kpi"].first()
    assert kpi.n_repos == 2 and kpi.topics == 3  # data, ml, __NA__ of Python, no floor


def test_file_metadata_and_stats(spark, landed):
    raw = spark.read.parquet(f"{landed}/landed")
    meta = file_metadata(raw, dt.datetime(2024, 2, 1)).collect()
    assert sorted((m.repo_language, m.repo_creation_date.day, m.n_repos) for m in meta) == [
        ("go", 3, 1), ("python", 2, 3),
    ]
    stats = {r.table_name: r for r in table_stats(spark, {"landed": f"{landed}/landed", "repo": f"{landed}/marts/repo"}).collect()}
    assert stats["landed"].row_count == 4 and stats["repo"].row_count == 3 and stats["repo"].total_bytes > 0
    tmp = f"{landed}/cleared"
    clear_table(spark.read.parquet(f"{landed}/marts/owner"), tmp)
    assert spark.read.parquet(tmp).count() == 0


def test_repo_content_flow(spark, landed):
    repo = spark.read.parquet(f"{landed}/marts/repo").withColumn("stars", F.lit(50))
    trees = spark.createDataFrame(
        [
            (1, "main", [("requirements.txt", "blob", "u1"), ("src", "tree", "u2"), ("README.md", "blob", "u3")]),
            (2, "dev", [("requirements-dev.txt", "blob", "u4")]),
        ],
        "repo_id long, branch string, tree array<struct<path string, type string, url string>>",
    )
    current = spark.createDataFrame([(1, "main"), (2, "dev")], "repo_id long, default_branch string")
    blobs = spark.createDataFrame(
        [("u1", base64.b64encode(b"numpy>=1.2\nPandas\n").decode()), ("u4", base64.b64encode(b"pytest==7\n").decode())],
        "url string, content string",
    )
    structure = P.structure_job(repo, trees, "python", None, min_stars=10, current_branches=current)
    assert sorted((r.repo_id, r.path) for r in structure.collect()) == [
        (1, "readme.md"), (1, "requirements.txt"), (2, "requirements-dev.txt"),
    ]
    out = P.run_repo_content_flow(repo, trees, blobs, "python", structure=True)
    pk = sorted((r.repo_id, r.package, r.version) for r in out["package"].collect())
    assert pk == [(1, "numpy", "1.2"), (1, "pandas", "0.0.0")]  # repo 2: requested branch 'main' missing


def test_streaming_pickup(spark, landed):
    from repolens.streaming.incremental import process_new_files

    seen = []

    def handle(batch, batch_id):
        seen.append(batch.count())

    ckpt = shared_scratch(spark, "test-stream-ckpt")
    process_new_files(spark, f"{landed}/landed", ckpt, handle)
    assert sum(seen) == 4
    seen.clear()
    process_new_files(spark, f"{landed}/landed", ckpt, handle)  # nothing new
    assert sum(seen) == 0


def test_discovery_content_and_file_metadata_upsert(spark, landed):
    from repolens.sources.sinks import upsert_file_metadata, write_partitioned
    from repolens.schemas import CONTENT

    raw = spark.read.parquet(f"{landed}/landed")
    assert sorted(r.language for r in R.discover_languages(raw).collect()) == ["go", "python"]
    content = spark.createDataFrame(
        [(1, "requirements.txt", "u1", "eA==", dt.date(2024, 1, 2), "python", "requirements.*\\.txt"),
         (1, "readme.md", "u3", None, dt.date(2024, 1, 2), "python", "^readme.md$"),
         (2, "requirements.txt", "u5", "eQ==", dt.date(2024, 2, 9), "python", "requirements.*\\.txt")],
        "repo_id long, path string, url string, content string, created_date date, language string, key string",
    )
    path = f"{landed}/content"
    write_partitioned(content, path, ["language", "key", "created_month"], mode="overwrite", schema=CONTENT)
    got = R.read_content(spark, path, key="requirements.*\\.txt", start="2024-01-01", end="2024-01-31")
    assert [(r.repo_id, r.url) for r in got.collect()] == [(1, "u1")]
    ts0, ts1 = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    old = file_metadata(raw, ts0)
    new = spark.createDataFrame(
        [("python", dt.date(2024, 1, 2), 99, "new-path", 5, ts1), ("rust", dt.date(2024, 1, 5), 7, "p", 1, ts1)],
        "repo_language string, repo_creation_date date, n_repos long, file_path string, elapsed_time_seconds long, updated_at timestamp_ntz",
    )
    rows = {(r.repo_language, r.repo_creation_date.day): r for r in upsert_file_metadata(old, new).collect()}
    assert rows[("python", 2)].n_repos == 3 and rows[("python", 2)].file_path == "new-path"
    assert rows[("python", 2)].updated_at == ts1 and rows[("rust", 5)].n_repos == 7 and rows[("go", 3)].updated_at == ts0


def test_daily_file_layout_and_stream_marts(spark, landed):
    from repolens.streaming.incremental import marts_batch_writer, process_new_files

    P.land_search_pages(spark, f"{landed}/pages", f"{landed}/landed", mode="skip")  # idempotent
    # the crawler's own layout: language=<alias>/<YYYY-MM-DD>.parquet
    raw = spark.read.parquet(f"{landed}/landed").drop("created_date", "created_month")
    root = landed[len("file:"):] if landed.startswith("file:") else landed
    for alias, day in (("python", "2024-01-02"), ("go", "2024-01-03")):
        import pyarrow.parquet as pq

        part = raw.where(F.col("language") == alias).drop("language").toArrow()
        os.makedirs(f"{root}/daily/language={alias}", exist_ok=True)
        pq.write_table(part, f"{root}/daily/language={alias}/{day}.parquet")
    daily = R.read_daily_files(spark, f"{landed}/daily", start="2024-01-03", end="2024-01-03")
    assert [(r.id, r.language, r.created_date) for r in daily.collect()] == [(4, "go", dt.date(2024, 1, 3))]
    out = f"{landed}/stream-marts"
    handler = marts_batch_writer(out, dt.date(2024, 2, 1), dt.datetime(2024, 2, 1))
    process_new_files(spark, f"{landed}/landed", shared_scratch(spark, "test-stream-marts"), handler)
    assert spark.read.parquet(f"{out}/repo").select("id").distinct().count() == 3
    assert spark.read.parquet(f"{out}/owner").count() == 2


def test_incremental_daily_run(spark, landed):
    """A second daily run merges into the tables: a re-landed repository is
    updated, older repositories and roll-up months are kept."""
    root = landed[len("file:"):] if landed.startswith("file:") else landed
    pages = os.path.join(root, "pages2")
    os.makedirs(pages, exist_ok=True)
    with open(os.path.join(pages, "p.json"), "w") as fh:
        json.dump({"total_count": 2, "items": [
            _item(2, "Python", "2024-01-02T13:00:00Z", topics=["new"], stars=50),
            _item(5, "Python", "2024-02-10T08:00:00Z"),
        ]}, fh)
    out = f"{landed}/daily-marts"
    first = P.run_repo_info_flow(spark, f"{landed}/pages", f"{landed}/landed-d", out, "2024-01-01", "2024-01-31",
                                 as_of=dt.date(2024, 2, 1))
    assert first["repo"].count() == 3
    second = P.run_repo_info_flow(spark, f"{landed}/pages2", f"{landed}/landed-d", out, "2024-02-01", "2024-02-28",
                                  as_of=dt.date(2024, 3, 1), overwrite_existed_files=True)
    repo = {r.id: r for r in second["repo"].collect()}
    assert sorted(repo) == [1, 2, 4, 5]
    ra = {(r.creation_date.month, r.language): r.n_repos for r in second["repo_analytics"].collect()}
    assert ra[(2, "Python")] == 1 and ra[(1, "Python")] == 2  # January kept from the first run


def test_languages_are_parsed_strictly():
    from repolens.sources.readers import parse_languages

    assert parse_languages("python, java") == ["python", "java"]
    with pytest.raises(ValueError):
        parse_languages(["kotlin"])


def test_missing_table_is_not_a_first_run(spark, tmp_path):
    from repolens.plans.pipelines import _read_tables

    assert _read_tables(spark, str(tmp_path)) == {}
    spark.range(1).write.parquet(str(tmp_path / "repo"))
    with pytest.raises(ValueError):
        _read_tables(spark, str(tmp_path))


def test_streamed_batch_can_be_handled_again(spark, landed, tmp_path):
    import datetime as dt

    from repolens.schemas import RAW_REPO
    from repolens.streaming.incremental import marts_batch_writer

    handle = marts_batch_writer(str(tmp_path), dt.date(2001, 1, 1), dt.datetime(2001, 1, 1))
    batch = spark.createDataFrame([], RAW_REPO).limit(0)
    handle(batch, 1)
    handle(batch, 1)
    assert len(list((tmp_path / "repo").glob("batch_id=*"))) == 1


def test_package_stage_alone_needs_landed_content():
    from repolens.plans.pipelines import package_job, run_repo_content_flow

    with pytest.raises(ValueError):
        run_repo_content_flow(None, None, None, structure=False, content=False)
    with pytest.raises(ValueError):
        package_job(None, existing=object())

"""Content flow, incremental marts, manifest and whole ETL."""

import base64
import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from repolens.plans import content as C
from repolens.plans import etl as E
from repolens.plans import pipelines as P
from repolens.plans.marts import MART_NAMES, mart, marts, refresh_marts
from repolens.schemas import RAW_REPO
from repolens.sources import readers as R
from repolens.sources import versions as V
from test_pipelines import _item

TREE = "repo_id long, branch string, tree array<struct<path string, type string, url string>>"
REQ = C.REQUIREMENTS_KEY


def item_rows(spark, items):
    """Landed items of (alias, item)."""
    rows = []
    for alias, i in items:
        day = dt.date.fromisoformat(i["created_at"][:10])
        rows.append({**i, "language": alias, "created_date": day, "created_month": day.replace(day=1)})
    return spark.createDataFrame(rows, RAW_REPO)


def repo_rows(spark, rows):
    """(id, alias, day, stars, branch)"""
    made = [(i, f"o{i}", f"r{i}", b, a, s, dt.datetime.fromisoformat(day)) for i, a, day, s, b in rows]
    return spark.createDataFrame(made, "id long, owner string, name string, default_branch string, lang_alias string, stars long, creation_date timestamp_ntz")


def structure_of(spark, path):
    return sorted((r.repo_id, r.path or "", r.language, str(r.created_date)) for r in R.read_structure(spark, path).collect())


@pytest.fixture()
def crawl(spark):
    repo = repo_rows(spark, [
        (1, "python", "2024-01-02", 50, "main"), (2, "python", "2024-01-02", 50, "dev"), (3, "python", "2024-02-01", 50, "main"),
        (4, "jupyter-notebook", "2024-01-02", 50, "main"), (5, "python", "2024-01-02", 3, "main"), (6, "python", "2024-03-09", 50, "main"), (7, "python", "2024-01-02", 50, "gone"),
    ])
    trees = spark.createDataFrame([
        (1, "main", [("Requirements.txt", "blob", "u1"), ("src", "tree", "t1"), ("README.md", "blob", "u2")]),
        (2, "main", [("setup.py", "blob", "u3")]), (3, "main", [("other.c", "blob", "u4")]),
        (4, "main", [("requirements.txt", "blob", "u5")]), (5, "main", [("setup.py", "blob", "u6")]), (6, "main", [("setup.py", "blob", "u7")]), (7, "x", [("setup.py", "blob", "u8")]),
    ], TREE)
    now = spark.createDataFrame([(2, "main"), (7, "lost")], "repo_id long, default_branch string")
    return repo, trees, now


def test_structure_of_a_window(spark, tmp_path, crawl):
    repo, trees, now = crawl
    path = str(tmp_path / "structure")
    C.run_structure(spark, repo, trees, path, "2024-01-01", "2024-02-28", "python,jupyter-notebook", current_branches=now)
    first = [
        (1, "readme.md", "python", "2024-01-02"), (1, "requirements.txt", "python", "2024-01-02"), (2, "setup.py", "python", "2024-01-02"),
        (3, "", "python", "2024-02-01"), (4, "requirements.txt", "jupyter-notebook", "2024-01-02"), (7, "", "python", "2024-01-02"),
    ]
    assert structure_of(spark, path) == first
    # Landed days stay as they are, new ones come; an overwrite replaces the days of its window only.
    more = trees.withColumn("tree", F.array(F.struct(F.lit("pipfile").alias("path"), F.lit("blob").alias("type"), F.lit("n").alias("url"))))
    C.run_structure(spark, repo, more, path, "2024-01-01", "2024-03-31", "python", current_branches=now)
    assert structure_of(spark, path) == [*first[:5], (6, "pipfile", "python", "2024-03-09"), first[5]]
    C.run_structure(spark, repo, more, path, "2024-02-01", "2024-02-28", "python", overwrite=True, current_branches=now)
    assert (3, "pipfile", "python", "2024-02-01") in structure_of(spark, path)
    assert structure_of(spark, path)[:3] == first[:3]
    with pytest.raises(ValueError):
        C.run_structure(spark, repo, trees, path, "2024-01-01", languages=[])
    assert R.read_structure(spark, path, "python", end="2024-01-31").count() == 4
    with pytest.raises(ValueError):
        R.read_structure(spark, path, ["kotlin"])


def test_limits_hold_for_each_key(spark, tmp_path, crawl):
    repo, trees, now = crawl
    picked = R.crawl_list(repo, "python,jupyter-notebook", "2024-01-01", "2024-12-31", 10, limit=1).collect()
    assert sorted(r.id for r in picked) == [1, 3, 4, 6]
    files = spark.createDataFrame(
        [(i, p, f"u{i}", "python", dt.date(2024, 1, d)) for i, p, d in [(1, "setup.py", 1), (2, "a/setup.py", 1), (3, "setup.py", 2), (4, "readme.md", 1), (5, None, 1)]],
        "repo_id long, path string, url string, language string, created_date date",
    )
    got = C.content_rows(files, "setup.py|^readme.md$", limit=1).collect()
    assert sorted((r.repo_id, r.key) for r in got) == [(2, "setup.py"), (3, "setup.py"), (4, "^readme.md$")]


def test_each_stage_works_on_what_is_landed(spark, tmp_path, crawl):
    repo, trees, now = crawl
    root = str(tmp_path)
    blobs = spark.createDataFrame([("u1", base64.b64encode(b"numpy>=1.2\npandas\n").decode()), ("u5", base64.b64encode(b"scipy\n").decode())], "url string, content string")
    flow = dict(start="2024-01-01", end="2024-03-31", languages="python,jupyter-notebook", current_branches=now)
    C.run_content_flow(spark, repo, trees, None, root, content=False, packages=False, **flow)
    C.run_content_flow(spark, None, None, blobs, root, structure=False, packages=False, **flow)
    rows = R.read_content(spark, f"{root}/content").collect()
    assert sorted((r.repo_id, r.key, r.content is None) for r in rows) == [(1, "^readme.md$", True), (1, REQ, False), (4, REQ, False)]
    # A pattern is a landing key of its own.
    C.run_content_flow(spark, None, None, blobs, root, structure=False, packages=False, content_path_pattern=["setup.py", REQ], **flow)
    assert sorted(r.repo_id for r in R.read_content(spark, f"{root}/content", "setup.py").collect()) == [2, 6]
    assert R.read_content(spark, f"{root}/content", REQ).count() == 2
    C.run_content_flow(spark, None, None, None, root, structure=False, content=False, batch_ts=dt.datetime(2024, 4, 1), **flow)
    first = {(r.repo_id, r.package): r.version for r in C.package(spark, f"{root}/marts").collect()}
    assert first == {(1, "numpy"): "1.2", (1, "pandas"): "0.0.0", (4, "scipy"): "0.0.0"}
    # Later contents replace a package by its key, others stay; a late batch does not.
    blobs = blobs.withColumn("content", F.when(F.col("url") == "u1", F.base64(F.lit("numpy==2\n").cast("binary"))).otherwise(F.lit("!")))
    C.run_content_flow(spark, None, None, blobs, root, structure=False, overwrite=True, batch_ts=dt.datetime(2024, 5, 1), **flow)
    second = sorted((r.repo_id, r.package or "", r.version, r.updated_at.month) for r in C.package(spark, f"{root}/marts").collect())
    want = [(1, "numpy", "2", 5), (1, "pandas", "0.0.0", 4), (4, "", "0.0.0", 5), (4, "scipy", "0.0.0", 4)]
    assert second == want
    for ts in (dt.datetime(2024, 4, 15), dt.datetime(2024, 5, 1)):
        C.run_packages(spark, f"{root}/content", f"{root}/marts", ts)
        rows = [x for x in C.package(spark, f"{root}/marts").collect() if x.package]
        assert sorted((r.repo_id, r.package, r.updated_at.month) for r in rows) == [(1, "numpy", 5), (1, "pandas", 4), (4, "scipy", 4)]


def test_a_batch_rewrites_only_the_months_it_touches(spark, tmp_path):
    root, as_of = str(tmp_path), dt.date(2024, 6, 1)
    one = item_rows(spark, [("python", _item(1, None, "2024-01-02T10:00:00Z")), ("go", _item(2, None, "2024-01-03T10:00:00Z", owner="o2")), ("go", _item(3, None, "2024-02-03T10:00:00Z", stars=9))])
    refresh_marts(spark, root, one, as_of, dt.datetime(2024, 3, 1))

    def files(name):
        m = V.read_manifest(spark, root)
        return {k: sorted(glob.glob(f"{root}/{name}/batch={b}/{k}/*.parquet")) for k, b in m.tables[name].items()}

    before = {n: files(n) for n in MART_NAMES}
    two = item_rows(spark, [("java", _item(3, None, "2024-02-03T10:00:00Z", topics=["new"], stars=99)), ("go", _item(4, None, "2024-02-04T10:00:00Z"))])
    refresh_marts(spark, root, two, as_of, dt.datetime(2024, 4, 1))
    for name in MART_NAMES:
        if name != "owner":
            now = files(name)
            assert now["in_month=2024-01-01"] == before[name]["in_month=2024-01-01"]
            assert now["in_month=2024-02-01"] != before[name]["in_month=2024-02-01"]
    found = marts(spark, root)
    assert sorted((r.id, r.language, r.stars) for r in found["repo"].collect()) == [(1, "Python", 5), (2, "Go", 5), (3, "Java", 99), (4, "Go", 5)]
    assert sorted((r.repo_id, r.topic) for r in found["repo_topic"].collect() if r.repo_id == 3) == [(3, "data"), (3, "ml"), (3, "new")]
    rolled = sorted((r.language, r.creation_date.month, r.n_repos) for r in found["repo_analytics"].collect())
    assert rolled == [("Go", 1, 1), ("Go", 2, 1), ("Java", 2, 1), ("Python", 1, 1)]  # Go lost one of February
    # The same batch again, and one that is late, change nothing.
    rows = {n: sorted(map(str, found[n].collect())) for n in MART_NAMES}
    for ts, batch in ((dt.datetime(2024, 4, 1), two), (dt.datetime(2024, 2, 1), one)):
        refresh_marts(spark, root, batch, as_of, ts)
        later = marts(spark, root)
        for name in ("repo", "repo_topic"):
            assert sorted(map(str, later[name].collect())) == rows[name]
    assert V.drop_unnamed(spark, root, MART_NAMES) > 0
    assert sorted(map(str, marts(spark, root)["repo"].collect())) == rows["repo"]


def test_jobs_delete_what_they_wrote_on_the_way(spark, tmp_path):
    base = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    batch = item_rows(spark, [("go", _item(1, None, "2024-01-02T10:00:00Z"))])
    before = set(os.listdir(base))
    found = refresh_marts(spark, str(tmp_path), batch, dt.date(2024, 6, 1), dt.datetime(2024, 3, 1))
    assert set(os.listdir(base)) == before
    assert found["repo"].count() == 1


def test_top_names_follow_the_counts_of_all_months(spark, tmp_path):
    root, as_of, ts = str(tmp_path), dt.date(2024, 6, 1), dt.datetime(2024, 3, 1)
    items = [("go", _item(i, None, f"2024-01-{i:02d}T01:00:00Z", license_name=name)) for i, name in enumerate(["A", "A", "A", "B", "B", "C", None], 1)]
    refresh_marts(spark, root, item_rows(spark, items), as_of, ts, top_k=2)
    licences = {r.license: r.n_repos for r in mart(spark, root, "repo_analytics").groupBy("license").agg(F.sum("n_repos").alias("n_repos")).collect()}
    assert licences == {"A": 3, "B": 2, "Other": 1, "__NA__": 1}
    assert {r.license for r in mart(spark, root, "repo").collect()} == {"A", "B", "C", "__NA__"}  # repositories keep theirs
    more = [("go", _item(20 + i, None, f"2024-02-{i:02d}T01:00:00Z", license_name="C")) for i in range(1, 5)]
    refresh_marts(spark, root, item_rows(spark, more), as_of, ts + dt.timedelta(days=1), top_k=2)
    february = mart(spark, root, "repo_analytics").where(F.col("creation_date") >= "2024-02-01")
    assert {r.license for r in february.collect()} == {"C"}  # five C in all by now


def test_readers_see_one_version_when_a_run_is_lost(spark, tmp_path, monkeypatch):
    root, as_of = str(tmp_path), dt.date(2024, 6, 1)
    refresh_marts(spark, root, item_rows(spark, [("go", _item(1, None, "2024-01-02T10:00:00Z"))]), as_of, dt.datetime(2024, 3, 1))
    before = {n: sorted(map(str, df.collect())) for n, df in marts(spark, root).items()}
    write, calls = V.write_batch, []

    def lost(*a, **k):
        calls.append(1)
        if len(calls) == 3:
            raise OSError("executor and driver are gone")
        return write(*a, **k)

    two = item_rows(spark, [("go", _item(1, None, "2024-01-02T10:00:00Z", stars=7)), ("go", _item(2, None, "2024-01-02T10:00:00Z"))])
    monkeypatch.setattr(V, "write_batch", lost)
    with pytest.raises(OSError):
        refresh_marts(spark, root, two, as_of, dt.datetime(2024, 4, 1))
    monkeypatch.undo()
    assert {n: sorted(map(str, df.collect())) for n, df in marts(spark, root).items()} == before
    refresh_marts(spark, root, two, as_of, dt.datetime(2024, 4, 1))
    assert sorted((r.id, r.stars) for r in marts(spark, root)["repo"].collect()) == [(1, 7), (2, 5)]


def test_of_two_runs_from_one_manifest_the_second_is_refused(spark, tmp_path):
    root = str(tmp_path)
    a, b = (V.read_manifest(spark, root).draft() for _ in range(2))
    V.publish(spark, root, a)
    with pytest.raises(V.StaleManifest):
        V.publish(spark, root, b)
    assert V.read_manifest(spark, root).number == 1


def landed_sources(spark, root):
    pages = {"python": [_item(1, "Jupyter Notebook", "2024-01-02T10:00:00Z"), _item(2, None, "2024-02-02T10:00:00Z")], "go": [_item(3, "Go", "2024-01-05T10:00:00Z")], "kotlin": [_item(9, "Kotlin", "2024-01-02T10:00:00Z")]}
    for alias, items in pages.items():
        os.makedirs(f"{root}/pages/language={alias}", exist_ok=True)
        with open(f"{root}/pages/language={alias}/p.json", "w") as fh:
            json.dump({"total_count": len(items), "items": items}, fh)
    trees = [(i, "main", [("requirements.txt", "blob", f"u{i}")]) for i in (1, 2, 3)]
    os.makedirs(f"{root}/trees", exist_ok=True)
    for i, branch, tree in trees:
        with open(f"{root}/trees/{i}.json", "w") as fh:
            json.dump({"repo_id": i, "branch": branch, "tree": [dict(zip(("path", "type", "url"), e)) for e in tree]}, fh)
    spark.createDataFrame([(f"u{i}", base64.b64encode(f"p{i}>=1\n".encode()).decode()) for i in (1, 2, 3)], "url string, content string").write.parquet(f"{root}/blobs")
    return E.Sources(f"{root}/pages", f"{root}/trees", f"{root}/blobs")


def test_whole_etl_goes_on_after_its_last_stage(spark, tmp_path, monkeypatch):
    sources, root = landed_sources(spark, str(tmp_path)), str(tmp_path / "out")
    run = dict(start="2024-01-01", min_stars=1)
    with monkeypatch.context() as m:
        m.setattr(C, "run_content", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            E.run_etl(spark, sources, root, "2024-01-31", **run)
    assert E.run_etl(spark, sources, root, "2024-01-31", **run) == ["content", "packages"]
    assert E.run_etl(spark, sources, root, "2024-01-31", **run) == []
    assert [r.package for r in C.package(spark, f"{root}/marts").collect()] == ["p1"]
    # The folder's language counts, whatever an item reports; unsupported folders stay out.
    meta = P.landed_file_metadata(spark, f"{root}/file_metadata").collect()
    assert sorted((r.repo_language, str(r.repo_creation_date), r.n_repos) for r in meta) == [("go", "2024-01-05", 1), ("python", "2024-01-02", 1), ("python", "2024-02-02", 1)]
    assert all(r.elapsed_time_seconds >= 0 and f"language={r.repo_language}" in r.file_path for r in meta)
    assert sorted(r.id for r in marts(spark, f"{root}/marts")["repo"].collect()) == [1, 3]
    assert E.run_etl(spark, sources, root, "2024-02-28", contents=False, **run) == ["land", "marts"]
    assert sorted(r.id for r in marts(spark, f"{root}/marts")["repo"].collect()) == [1, 2, 3]
    assert E.run_etl(spark, sources, root, "2024-02-28", info=False, only=("structure",), **run) == ["structure"]
    assert R.read_structure(spark, f"{root}/structure").count() == 2
    assert E.run_etl(spark, sources, root, "2024-02-28", n_last_days=27, run="again", languages="go", min_stars=1) == ["land", "marts"]

"""Plan checks and oracle agreement on the smallest scale."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from repolens.plans import catalog, flows  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

# Cheap, representative subset checked against DuckDB on every test run;
# tools/check_oracle.py runs all of them at sf0.01.
ORACLE_SUBSET = [
    "repo_normalize", "keep_latest", "upsert_merge", "topk_other", "repo_rollup", "rollup_filtered",
    "kpi_report", "explorer_flags", "paged_search", "parse_requirements", "files_by_pattern",
    "corr_matrix", "topic_histogram", "etl_marts",
]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "n_repos" in df.columns and "license" in df.columns


def test_every_query_has_oracle():
    assert set(catalog.queries()) == set(catalog.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_no_python_udf_or_cartesian(spark, name):
    if name == "partition_refresh" or name in flows.QUERIES:
        pytest.skip("writes data; covered by the oracle run")
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan, f"{name}: {bad} in plan"


def test_day_rounding_reads_two_columns(spark):
    df = E.queries()["round_to_day"](spark, SF_SMALL)
    plan = _plan(df)
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan


def test_explorer_pushes_filters(spark):
    from repolens.operators.explorer import repo_report
    from repolens.plans import bindings as B

    repo = B.materialized(spark, SF_SMALL, "repo-whole", lambda s, d: B.repo_t(s, d))
    found = repo_report(repo, B.repo_topic_t(spark, SF_SMALL), languages=["Python"], exclude_archived=True, sort_by="stars", limit=10, split=False)
    scans = [line for line in _plan(found).splitlines() if "FileScan parquet" in line and "archived" in line]
    assert scans and any("EqualTo(archived,0)" in line and "EqualTo(language,Python)" in line for line in scans), _plan(found)


def test_requirement_pattern_is_evaluated_once_a_line(spark):
    from repolens.plans import bindings as B

    plan = B.package(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("[><=~]") == 1, plan


def test_corr_matrix_is_one_compiled_pass(spark):
    """The input goes into one aggregate keyed by the columns present: no row per pair before it,
    and few enough buffer fields for whole-stage codegen."""
    df = E.queries()["corr_matrix"](spark, SF_SMALL)
    df.collect()
    final = _plan(df).split("== Initial Plan ==")[0].splitlines()
    partial = [i for i, ln in enumerate(final) if "HashAggregate" in ln and "partial_covar" in ln.lower()]
    assert len(partial) == 1, "\n".join(final)
    assert "*(" in final[partial[0]].split("HashAggregate")[0], final[partial[0]]
    below = final[partial[0] + 1:]
    assert sum("FileScan" in ln for ln in final) == 1
    assert not any(bad in ln for ln in below for bad in ("Generate", "Expand")), "\n".join(below)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def _norm(v):
    import datetime as dt

    if isinstance(v, float):
        return round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


DUCK_TO_SPARK = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz", "DATE": "date", "BOOLEAN": "boolean",
}


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_types_match_oracle(spark, duck, name):
    stypes = {f.name: f.dataType.simpleString() for f in E.queries()[name](spark, SF_SMALL).schema.fields}
    rel = duck.sql(E.oracle_sql()[name])
    dtypes = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    assert stypes == dtypes


@pytest.mark.parametrize("name", ORACLE_SUBSET)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    exp = sorted((tuple(_norm(r[i]) for i in idx) for r in res.fetchall()), key=repr)
    assert got == exp


@pytest.mark.parametrize("name", ["round_to_day", "repo_normalize", "upsert_merge", "period_presets", "etl_marts"])
def test_results_do_not_depend_on_session_time_zone(spark, duck, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        test_matches_oracle(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_rollup_and_report_invariants(spark):
    from pyspark.sql import functions as F

    from repolens.operators import reports as RP
    from repolens.operators.rollups import repo_rollup
    from repolens.plans import bindings as B

    repo = B.repo_t(spark, SF_SMALL)
    start, end = "1996-01-01", "2000-12-31"
    rollup = repo_rollup(repo, start, end)
    in_window = repo.where(F.col("creation_date").between(F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")))
    assert rollup.agg(F.sum("n_repos")).first()[0] == in_window.select("id").distinct().count()
    non_na = rollup.where(F.col("license") != "__NA__").agg(F.sum("n_repos")).first()[0]
    assert RP.categorical_top_n(rollup, "license", "n_repos", 3).agg(F.sum("n_repos")).first()[0] == non_na
    topics = RP.topics_data(B.repo_topic_t(spark, SF_SMALL).withColumn("n_repos", F.lit(1)), 1)
    hist = RP.topic_histogram(topics, 10)
    assert hist.agg(F.sum("count")).first()[0] == topics.select("topic").distinct().count()
    # column pruning reaches the scan of the materialised table
    plan = rollup._jdf.queryExecution().executedPlan().toString()
    scan = [line for line in plan.splitlines() if "FileScan parquet" in line][0]
    import re

    fields = re.findall(r"[<,]([a-z_]+):", scan.split("ReadSchema: ", 1)[1])
    assert fields and "description" not in fields and "url" not in fields and "name" not in fields

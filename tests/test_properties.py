"""Property tests: operators against brute-force Python on random inputs,
plus hot-key plans (one key holding a large share of the rows)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from repolens.functions.text import join_topics_capped
from repolens.operators import reports as RP
from repolens.operators.dedupe import best_version_per_package, dedupe_first, keep_latest
from repolens.operators.upsert import upsert_merge

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

keys = st.one_of(st.none(), st.integers(0, 3))
days = st.one_of(st.none(), st.integers(0, 3).map(lambda d: dt.datetime(2024, 1, 1) + dt.timedelta(days=d)))


def _brute_keep_latest(rows):
    out = []
    for r in rows:
        k, _, d = r
        newer = any(k is not None and k2 == k and d is not None and d2 is not None and d < d2 for k2, _, d2 in rows)
        if not newer:
            out.append(r)
    return out


def _key(r):
    return tuple((x is None, str(x)) for x in r)


@SETTINGS
@given(st.lists(st.tuples(keys, st.integers(0, 9), days), max_size=25))
def test_keep_latest_matches_delete_semantics(spark, rows):
    rows = [(k, i, d) for i, (k, _, d) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k long, v long, updated_at timestamp_ntz")
    got = sorted((tuple(r) for r in keep_latest(df, ["k"]).collect()), key=_key)
    assert got == sorted(_brute_keep_latest(rows), key=_key)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.integers(0, 100)), min_size=1, max_size=30))
def test_dedupe_first_is_min_per_key(spark, rows):
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = sorted(tuple(r) for r in dedupe_first(df, ["k"], ["o"]).collect())
    best = {}
    for k, o, v in rows:
        if k not in best or (o, v) < best[k]:
            best[k] = (o, v)
    assert got == sorted((k, o, v) for k, (o, v) in best.items())


versions = st.one_of(st.none(), st.sampled_from(["1", "10", "9", "1.2", "0.0.0"]))
ops = st.one_of(st.none(), st.sampled_from(["==", ">=", "<"]))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["a", "b"]), versions, ops), min_size=1, max_size=30))
def test_best_version_rule(spark, rows):
    df = spark.createDataFrame(rows, "repo_id long, package string, version string, operator string")
    got = {(r.repo_id, r.package): (r.version, r.operator) for r in best_version_per_package(df).collect()}
    exp = {}
    for rid, p, v, o in rows:
        rank = (v is None, v or "", o is not None, o or "")
        if (rid, p) not in exp or rank > exp[(rid, p)][0]:
            exp[(rid, p)] = (rank, (v, o))
    assert got == {k: val for k, (_, val) in exp.items()}


@SETTINGS
@given(
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=12, unique_by=lambda r: r[0]),
    st.lists(st.tuples(st.integers(0, 6), st.integers(0, 9)), max_size=12, unique_by=lambda r: r[0]),
)
def test_upsert_matches_on_conflict(spark, old, new):
    o = spark.createDataFrame([(k, v, v) for k, v in old], "k long, keep long, upd long")
    n = spark.createDataFrame([(k, v + 100, v + 100) for k, v in new], "k long, keep long, upd long")
    got = sorted(tuple(r) for r in upsert_merge(o, n, ["k"], ["upd"]).collect())
    table = {k: (v, v) for k, v in old}
    for k, v in new:
        table[k] = (table[k][0], v + 100) if k in table else (v + 100, v + 100)
    assert got == sorted((k, a, b) for k, (a, b) in table.items())


words = st.lists(st.text(alphabet="abcxyz-", min_size=1, max_size=9), max_size=8)


@SETTINGS
@given(st.lists(words, min_size=1, max_size=5), st.integers(3, 30))
def test_topic_cap_matches_python(spark, lists, n):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(lists)], "i long, t array<string>")
    got = [r[0] for r in df.orderBy("i").select(join_topics_capped(F.col("t"), n)).collect()]

    def ref(value):
        value = "|".join(value)
        if len(value) > n:
            value = "|".join(value[:n].split("|")[:-1])
        return value

    assert got == [ref(t) for t in lists]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["t1", "t2", "t3", "t4", "t5", "t6"]), st.integers(1, 6)), min_size=1, max_size=30),
       st.integers(2, 8))
def test_topic_histogram_matches_value_counts(spark, rows, threshold):
    df = spark.createDataFrame(rows, "topic string, n_repos long")
    got = {r.freq: r["count"] for r in RP.topic_histogram(df, threshold).collect()}
    totals = {}
    for t, n in rows:
        totals[t] = totals.get(t, 0) + n
    exp = {}
    for v in totals.values():
        label = f"{threshold}+" if v >= threshold else str(v)
        exp[label] = exp.get(label, 0) + 1
    assert got == exp


def _partials_before_first_exchange(df) -> bool:
    plan = df._jdf.queryExecution().executedPlan().toString().splitlines()
    # The plan string is printed top-down; the last Exchange is the one
    # closest to the scan. A partial aggregate must sit below it.
    idx = max(i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line)
    return any("partial_" in line for line in plan[idx:])


def test_hot_key_is_combined_map_side(spark):
    # One key holds a third of the rows.
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 17).alias("o"),
        F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz").alias("updated_at"),
        F.col("id").cast("string").alias("v"),
    ).repartition(8)
    first = dedupe_first(df, ["k"], ["o"])
    latest = keep_latest(df, ["k"])
    for out in (first, latest):
        out.write.format("noop").mode("overwrite").save()
        assert _partials_before_first_exchange(out)
    assert first.where(F.col("k") == 0).count() == 1
    assert latest.count() == 30000  # all rows tie on the latest date

"""Operator semantics on hand-made rows and invariants."""

import datetime as dt

from pyspark.sql import functions as F

from repolens.operators import reports as RP
from repolens.operators.dedupe import best_version_per_package, dedupe_first, keep_latest
from repolens.operators.explorer import paged_search
from repolens.operators.joins import files_by_pattern, repos_with_all
from repolens.operators.packages import package_table
from repolens.operators.rollups import keep_top_k
from repolens.operators.tables import normalize_repos, owner_table, repo_table, topic_table
from repolens.operators.upsert import align_to, upsert_merge

D1, D2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def _k(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=_k)


def test_keep_latest_ties_and_nulls(spark):
    df = spark.createDataFrame(
        [(1, "a", D1), (1, "b", D2), (1, "c", D2), (None, "n1", D1), (None, "n2", D2), (2, "x", None), (2, "y", D1)],
        "k long, v string, updated_at timestamp_ntz",
    )
    got = keep_latest(df, ["k"])
    assert rows(got, "v") == [("b",), ("c",), ("n1",), ("n2",), ("x",), ("y",)]
    # idempotent
    assert rows(keep_latest(got, ["k"]), "v") == rows(got, "v")
    one = keep_latest(df.where(F.col("k") == 1), ["k"], ties="one")
    assert rows(one, "v") == [("c",)]


def test_dedupe_first(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (2, 5, "z")], "k long, o int, v string")
    assert rows(dedupe_first(df, ["k"], ["o"]), "k", "v") == [(1, "a"), (2, "z")]


def test_upsert_merge(spark):
    old = spark.createDataFrame([(1, 10, "p", "o1"), (2, 20, "q", "o2"), (None, 0, "z", "on")], "k long, n long, f string, t string")
    new = spark.createDataFrame([(2, 99, None, "n2"), (3, 30, "r", "n3"), (None, 1, "y", "nn")], "k long, n long, f string, t string")
    got = upsert_merge(old, new, ["k"], ["f", "t"])
    assert rows(got, "k", "n", "f", "t") == sorted(
        [(1, 10, "p", "o1"), (2, 20, None, "n2"), (3, 30, "r", "n3"), (None, 0, "z", "on"), (None, 1, "y", "nn")],
        key=_k,
    )
    got_map = {r["t"]: (r["k"], r["n"], r["f"]) for r in got.collect()}
    assert got_map["n2"] == (2, 20, None)  # n kept, f updated to NULL
    assert got_map["n3"] == (3, 30, "r")
    assert "o1" in got_map and "on" in got_map and "nn" in got_map


def test_align_to(spark):
    from pyspark.sql import types as T

    target = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.StringType()), T.StructField("c", T.StringType())])
    df = spark.createDataFrame([(1, "x", 5)], "a int, c string, extra int")
    out = align_to(df, target, {"b": "dflt"})
    assert out.columns == ["a", "b", "c"] and out.first() == (1, "dflt", "x")


def _raw(spark):
    owner = "struct<login string, html_url string>"
    schema = (
        f"id long, name string, owner {owner}, html_url string, description string, topics array<string>,"
        " license struct<name string>, archived boolean, has_wiki boolean, size long, default_branch string,"
        " stargazers_count long, watchers_count long, forks_count long, open_issues_count long,"
        " created_at string, pushed_at string, language string"
    )
    data = [
        (1, "r1", ("o1", "u1"), "h1", None, ["A", "b"], None, True, False, 10, "main", 5, 5, 1, 0,
         "1970-01-02T12:00:00Z", "1970-01-01T12:00:00Z", "python"),
        (2, "r2", ("o1", "u1"), "h2", "", [], ("MIT",), False, True, 20, "master", 7, 7, 2, 1,
         "1970-01-02T11:00:00Z", "1970-01-02T13:00:00Z", "go"),
        (3, "r3", None, "h3", "d", None, ("MIT",), False, True, 20, "master", 7, 7, 2, 1,
         "1970-01-02T11:00:00Z", "1970-01-02T13:00:00Z", "go"),
        (3, "dup", None, "h3", "d", None, ("MIT",), False, True, 20, "master", 7, 7, 2, 1,
         "1970-01-02T11:00:00Z", "1970-01-02T13:00:00Z", "go"),
    ]
    return spark.createDataFrame(data, schema)


def test_normalize_and_tables(spark):
    norm = normalize_repos(_raw(spark), dt.date(1970, 1, 10))
    assert norm.count() == 3  # duplicate id 3 removed
    repo = {r["id"]: r for r in repo_table(norm).collect()}
    r1 = repo[1]
    assert (r1.license, r1.has_license, r1.has_description, r1.archived, r1.has_wiki) == ("__NA__", 0, 0, 1, 0)
    assert r1.creation_date == dt.datetime(1970, 1, 3) and r1.last_commit_date == dt.datetime(1970, 1, 1)
    assert (r1.language, r1.lang_alias, r1.topics, r1.has_topic) == ("Python", "python", "A|b", 1)
    assert r1.days_since_creation == 7
    assert repo[2].has_description == 1 and repo[2].topics == "" and repo[2].has_topic == 0
    topics = rows(topic_table(norm), "repo_id", "topic")
    assert topics == [(1, "a"), (1, "b"), (2, "__NA__"), (3, "__NA__")]
    assert rows(owner_table(norm), "name", "url", "n_repos") == [("o1", "u1", 2)]


def test_keep_top_k(spark):
    data = [("A",)] * 3 + [("B",)] * 2 + [("C",)] + [("__NA__",)] + [(None,)]
    df = spark.createDataFrame(data, "license string")
    got = rows(keep_top_k(df, ["license"], 2).groupBy("license").count(), "license", "count")
    assert got == [("A", 3), ("B", 2), ("Other", 2), ("__NA__", 1)]


def test_first_per_key_edges(spark):
    """NULL keys are one key, NULL comes first, ties go to the rest of the row, repeated rows are one;
    keys alone and empty tables work."""
    df = spark.createDataFrame(
        [(None, 2, "b"), (None, 1, "c"), (1, None, "z"), (1, 0, "a"), (2, 5, "q"), (2, 5, None), (3, 1, "x"), (3, 1, "x")],
        "k int, o int, v string",
    )
    found = sorted((tuple(r) for r in dedupe_first(df, ["k"], ["o"]).collect()), key=str)
    assert found == sorted([(None, 1, "c"), (1, None, "z"), (2, 5, None), (3, 1, "x")], key=str)
    assert sorted(str(r.k) for r in dedupe_first(df.select("k"), ["k"], []).collect()) == ["1", "2", "3", "None"]
    assert dedupe_first(df.limit(0), ["k"], ["o"]).count() == 0
    last = sorted((tuple(r) for r in keep_latest(df, ["k"], "o", ties="one").collect()), key=str)
    assert last == sorted([(None, 2, "b"), (None, 1, "c"), (1, None, "z"), (1, 0, "a"), (2, 5, "q"), (3, 1, "x")], key=str)


def test_best_version(spark):
    df = spark.createDataFrame(
        [(1, "a", "9", "=="), (1, "a", "10", ">="), (2, "b", None, None), (2, "b", "1.0", "=="), (3, "c", "1", None), (3, "c", "1", "==")],
        "repo_id long, package string, version string, operator string",
    )
    got = rows(best_version_per_package(df), "repo_id", "version", "operator")
    assert got == [(1, "9", "=="), (2, None, None), (3, "1", "==")]


def test_package_table_invalid_and_empty(spark):
    import base64

    good = base64.b64encode(b"# header\n\nNumpy>=1.0\nrequests\n").decode()
    nodeps = base64.b64encode(b"# only a comment\n").decode()
    df = spark.createDataFrame(
        [(1, good, "python"), (2, "@@@", "python"), (3, "", "go"), (4, nodeps, "python")],
        "repo_id long, content string, language string",
    )
    got = rows(package_table(df), "repo_id", "language", "package", "version", "operator")
    assert got == [
        (1, "Python", "numpy", "1.0", ">="),
        (1, "Python", "requests", "0.0.0", None),
        (2, "Python", None, "0.0.0", None),
        (3, "Go", None, "0.0.0", None),
    ]


def test_division_with_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "a")], "repo_id long, package string")
    assert rows(repos_with_all(df, ["a", "b", "a"]), "repo_id") == [(1,)]


def test_files_by_pattern(spark):
    df = spark.createDataFrame([("Docs/README.md",), ("requirements-dev.txt",), (None,)], "path string")
    got = rows(files_by_pattern(df, ["^docs/", "requirements.*\\.txt", "\\.md$"]), "path", "key")
    assert got == [("Docs/README.md", "\\.md$"), ("Docs/README.md", "^docs/"), ("requirements-dev.txt", "requirements.*\\.txt")]


def test_corr_constant_column(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, k double")
    got = {(r.row, r.col): r.corr for r in RP.corr_matrix(df, ["a", "b", "k"]).collect()}
    assert got[("a", "a")] == 100.0 and got[("a", "k")] is None and got[("k", "k")] is None
    assert 99.0 < got[("a", "b")] <= 100.0 and got[("a", "b")] == got[("b", "a")]


def test_corr_pairwise_complete_matches_brute_force(spark):
    """Each pair uses only the rows where both of its columns are present;
    compared with a per-pair numpy computation over the same rows."""
    import math

    import numpy as np

    data = [
        (1.0, 2.0, None), (2.0, None, 1.0), (3.0, 7.5, 4.0), (4.0, 3.0, 2.0),
        (None, 1.0, 8.0), (6.0, 9.0, 3.5), (7.0, 4.0, None), (8.0, 6.5, 6.0),
    ]
    cols = ["a", "b", "c"]
    df = spark.createDataFrame(data, "a double, b double, c double")
    got = {(r.row, r.col): r.corr for r in RP.corr_matrix(df, cols).collect()}
    assert len(got) == len(cols) ** 2
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            pairs = [(r[i], r[j]) for r in data if r[i] is not None and r[j] is not None]
            xs, ys = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
            den = xs.std() * ys.std()
            want = None if den == 0 else round(float(((xs - xs.mean()) * (ys - ys.mean())).mean() / den) * 100, 1)
            assert got[(x, y)] is not None and math.isclose(got[(x, y)], want, abs_tol=1e-9), (x, y, got[(x, y)], want)


def test_corr_groups_of_nulls_merge_exactly(spark):
    """Every pattern of nulls, values far from zero, a column constant on some pairs' rows only, one
    never present with another: against a per-pair computation in exact fractions."""
    import random
    from fractions import Fraction

    rng = random.Random(5)
    cols = ["a", "b", "c", "d", "e"]
    data = []
    for n in range(400):
        a = 1e9 + rng.random() if rng.random() < 0.7 else None
        b = rng.gauss(3.0, 2.0) + (a - 1e9 if a else 0.0) if rng.random() < 0.6 else None
        c = 0.1 if b is not None else (rng.random() if rng.random() < 0.5 else None)
        d = None if a is not None else rng.random()
        e = 0.1 * n if rng.random() < 0.9 else None
        data.append((a, b, c, d, e))
    df = spark.createDataFrame(data, ", ".join(f"{c} double" for c in cols)).repartition(5)
    found = RP.corr_matrix(df, cols).collect()
    got = {(r.row, r.col): r.corr for r in found}
    assert len(found) == len(got) == len(cols) ** 2
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            both = [(Fraction(r[i]), Fraction(r[j])) for r in data if r[i] is not None and r[j] is not None]
            n = len(both) or 1
            mx, my = sum(p for p, _ in both) / n, sum(q for _, q in both) / n
            xx, yy = sum((p - mx) ** 2 for p, _ in both), sum((q - my) ** 2 for _, q in both)
            xy = sum((p - mx) * (q - my) for p, q in both)
            if not xx or not yy:
                assert got[(x, y)] is None, (x, y, got[(x, y)])
            else:
                want = float(xy) / (float(xx) ** 0.5 * float(yy) ** 0.5) * 100
                assert abs(got[(x, y)] - want) <= 0.0501, (x, y, got[(x, y)], want)
    assert got[("a", "d")] is None and got[("b", "c")] is None and got[("a", "c")] is not None
    assert RP.corr_matrix(df.limit(0), cols).count() == 0


def test_topic_histogram(spark):
    df = spark.createDataFrame([("t1", 1), ("t2", 1), ("t3", 12), ("t4", 10), ("t3", 1)], "topic string, n_repos long")
    got = rows(RP.topic_histogram(df, 10), "sort_key", "freq", "count")
    assert got == [(1, "1", 2), (10, "10+", 2)]
    small = spark.createDataFrame([("t1", 1), ("t2", 3)], "topic string, n_repos long")
    assert rows(RP.topic_histogram(small, 10), "freq") == [("1",), ("3",)]


def test_categorical_and_has_property(spark):
    df = spark.createDataFrame(
        [("A", 5, 1), ("B", 3, 0), ("C", 2, 2), ("__NA__", 9, 0), ("Other", 1, 0)], "license string, n_repos long, flag long"
    )
    got = rows(RP.categorical_top_n(df, "license", "n_repos", 2), "license", "n_repos")
    assert got == [("A", 5), ("B", 3), ("Other", 3)]
    hp = rows(RP.has_property(df, "flag", "has_flag"), "has_flag", "n_repos")
    assert hp == [("No", 17), ("Yes", 3)]


def test_paged_search_cap(spark):
    df = spark.range(2500).select(F.col("id"), (F.col("id") % 97).alias("stars"))
    assert paged_search(df, min_stars=None, page=10, per_page=100).count() == 100
    assert paged_search(df, min_stars=None, page=11, per_page=100).count() == 0


def test_one_pass_reports_match_single_reports(spark):
    df = spark.createDataFrame(
        [("Python", 2001, 2002, 5, 2, 1), ("Go", 2001, 2003, 3, 0, 3), ("Python", 2002, 2003, 4, 4, 0)],
        "language string, creation_year int, last_commit_year int, n_repos long, a long, b long",
    )
    many = {(r.dimension, r.key): r.n_repos for r in RP.repos_by_many(df, ["creation_year", "language"]).collect()}
    single = {("creation_year", str(r.creation_year)): r.n_repos for r in RP.repos_by(df, "creation_year").collect()}
    single.update({("language", r.language): r.n_repos for r in RP.repos_by(df, "language").collect()})
    assert many == single
    props = rows(RP.has_properties(df, [("a", "has_a"), ("b", "has_b")]), "property", "answer", "n_repos")
    one = rows(RP.has_property(df, "a", "x"), "x", "n_repos") + rows(RP.has_property(df, "b", "x"), "x", "n_repos")
    assert [(a, n) for _, a, n in props] == sorted(one[:2]) + sorted(one[2:])

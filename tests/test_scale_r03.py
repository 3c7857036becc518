"""Steps that were rewritten to move fewer and narrower rows: same rows, and plans without the old step."""

import base64
import datetime as dt

from pyspark.sql import functions as F

from repolens.functions.requirements import decode_base64_text
from repolens.operators.dedupe import dedupe_first, dedupe_repeated
from repolens.operators.rollups import repo_rollup, topic_rollup


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def test_rows_of_unique_keys_are_not_moved(spark):
    rows = [(1, 2, "b"), (1, 1, None), (None, 1, "x"), (None, 0, "y"), (3, None, "w"), (4, 4, "only"), (1, 1, None)]
    df = spark.createDataFrame(rows, "k long, o int, wide string")
    assert _rows(dedupe_repeated(df, ["k"], ["o"])) == _rows(dedupe_first(df, ["k"], ["o"]))
    assert _rows(dedupe_repeated(df, ["k"], [])) == _rows(dedupe_first(df, ["k"], []))
    assert dedupe_repeated(df.limit(0), ["k"], ["o"]).count() == 0
    unique = spark.range(1000).select(F.col("id").alias("k"), F.lit("w" * 50).alias("wide"))
    kept = dedupe_repeated(unique, ["k"], [])
    assert kept.count() == 1000
    branch = _plan(kept).split("LeftAnti", 1)[1].split("LeftSemi", 1)[0]
    assert "hashpartitioning" not in branch, _plan(kept)


def test_topics_are_counted_without_pairs_of_group_and_repository(spark):
    day, later = dt.datetime(2000, 1, 5), dt.datetime(2000, 2, 7)
    repo = spark.createDataFrame([(1, "Go", day, day), (1, "Go", day, day), (1, "C", day, later), (2, "Go", day, day), (None, "Go", day, day)], "id long, language string, creation_date timestamp_ntz, last_commit_date timestamp_ntz")
    topics = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "a"), (None, "a"), (9, "b")], "repo_id long, topic string")
    out = topic_rollup(topics, repo)
    got = {(r["language"], r["topic"], r["last_commit_date"].month): r["n_repos"] for r in out.collect()}
    assert got == {("Go", "a", 1): 2, ("Go", None, 1): 1, ("C", "a", 2): 1, ("C", None, 2): 1}
    keys = [x.split("keys=[", 1)[1].split("]", 1)[0] for x in _plan(out).splitlines() if "Aggregate(keys=[" in x]
    assert keys and not [k for k in keys if "topic" in k and "repo_id" in k], keys


def test_distinct_counts_of_the_rollup_do_not_expand_wide_rows(spark):
    day = dt.datetime(2000, 1, 5)
    flags = ["archived", "has_license", "has_topic", "has_description", "has_wiki", "size", "stars", "watchers", "forks", "open_issues", "days_since_creation", "days_since_last_commit"]
    rows = [(1, "o", "Go", None, day, day, *[1] * 12), (1, "o", "Go", None, day, day, *[2] * 12), (2, None, "Go", None, day, None, *[None] * 12), (None, "p", None, "x", None, None, *[4] * 12)]
    repo = spark.createDataFrame(rows, "id long, owner string, language string, license string, creation_date timestamp_ntz, last_commit_date timestamp_ntz, " + ", ".join(f"{f} long" for f in flags))
    out = repo_rollup(repo)
    got = {(r["language"], r["last_commit_year"]): (r["n_repos"], r["n_owners"], r["n_archived_repos"], r["stars"]) for r in out.collect()}
    assert got == {("Go", 2000): (1, 1, 3, 1.5), ("Go", None): (1, 0, None, None), (None, None): (0, 1, 4, 4.0)}
    assert "Expand" not in _plan(out)


def test_base64_without_a_pattern_is_as_with_one(spark):
    texts = [b"", b"a", b"ab", b"abc", "é日本\n".encode(), bytes(range(256)), b"x" * 200]
    whole = [base64.b64encode(t).decode() for t in texts]
    odd = ["QQ", "QQ  ", "QQ=", "QQ= ", " QQ=", "QQ==", "QQ= =", "QQ==\n", "QQ ", "QU JD", "QUJD!", "QUJD====", "=", "====", "QUI\t", "QUI ", "QUI=", "not base64!", "日本", "\n", " ", "QUJDQQ==QUJD", "QUJD\r\nQUJD\r\n", None]
    chunked = ["\n".join(x[i : i + 7] for i in range(0, len(x), 7)) for x in whole]
    df = spark.createDataFrame([(x,) for x in whole + odd + chunked], "c string")
    cleaned = F.regexp_replace("c", r"[^A-Za-z0-9+/=]", "")
    by_pattern = F.when(F.length(cleaned) % 4 == 0, F.try_validate_utf8(F.try_to_binary(cleaned, F.lit("base64")).cast("string")))
    for r in df.select("c", decode_base64_text(F.col("c")).alias("got"), by_pattern.alias("want")).collect():
        assert r["got"] == r["want"], r

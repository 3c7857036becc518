"""Registered queries: one per operator group of the blueprint, each with
its Spark plan and an equivalent DuckDB SQL oracle over the same Parquet.

Every query runs over the whole driver tables (no id subsets, no row caps);
a ``limit`` appears only where it is the feature (top-k, paging, display
head).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.functions.dates import ntz_lit

from repolens.functions import dates as D
from repolens.functions.requirements import decode_base64_text, extract_version
from repolens.functions.text import join_topics_capped, split_topics
from repolens.operators import reports as RP
from repolens.operators.dedupe import dedupe_first, keep_latest
from repolens.operators.explorer import paged_search, repo_report
from repolens.operators.joins import (
    branch_fallback,
    content_lookup,
    files_by_pattern,
    repos_with_all,
    repos_with_files,
    tree_blobs,
)
from repolens.operators.rollups import keep_top_k, repo_rollup, topic_rollup
from repolens.operators.tables import owner_table
from repolens.operators.upsert import align_to, append_aligned, upsert_merge
from repolens.plans import bindings as B
from repolens.plans import flows
from repolens.plans import pipelines as P
from repolens.sources.readers import select_repos_to_crawl
from repolens.sources.sinks import table_stats

QueryFn = Callable[[SparkSession, str], DataFrame]

ROLLUP_START, ROLLUP_END = "1996-01-01", "2000-12-31"
F8_CREATION = ("1996-01-01", "1999-12-31")
F8_COMMIT = ("1996-01-01", "2001-12-31")
F8_LANGS = ["Python", "Java", "Go", "Rust", "C", "HTML"]

TS = B.BATCH_TS.isoformat(sep=" ")


def _t(spark, d, name):
    return B.table(spark, d, name)


# ---------------------------------------------------------------------------
# Shared SQL fragments
# ---------------------------------------------------------------------------

REPO_ROLLUP_SELECT = """
  SELECT language, license,
         CAST(date_trunc('month', creation_date) AS TIMESTAMP) AS creation_date,
         CAST(year(creation_date) AS INTEGER) AS creation_year,
         CAST(date_trunc('month', last_commit_date) AS TIMESTAMP) AS last_commit_date,
         CAST(year(last_commit_date) AS INTEGER) AS last_commit_year,
         count(DISTINCT id) AS n_repos,
         count(DISTINCT owner) AS n_owners,
         CAST(sum(archived) AS BIGINT) AS n_archived_repos,
         CAST(sum(has_license) AS BIGINT) AS n_repos_with_license,
         CAST(sum(has_topic) AS BIGINT) AS n_repos_with_topic,
         CAST(sum(has_description) AS BIGINT) AS n_repos_with_desc,
         CAST(sum(has_wiki) AS BIGINT) AS n_repos_with_wiki,
         CAST(round(avg(size)) AS BIGINT) AS size,
         round(avg(stars), 1) AS stars,
         round(avg(watchers), 1) AS watchers,
         round(avg(forks), 1) AS forks,
         round(avg(open_issues), 1) AS open_issues,
         CAST(ceil(avg(days_since_creation)) AS BIGINT) AS days_since_creation,
         CAST(ceil(avg(days_since_last_commit)) AS BIGINT) AS days_since_last_commit
  FROM {src}
  WHERE creation_date >= TIMESTAMP '{start}' AND creation_date <= TIMESTAMP '{end}'
  GROUP BY 1, 2, 3, 4, 5, 6"""


def rollup_cte(src: str = "repo_full", start=ROLLUP_START, end=ROLLUP_END, name: str = "rollup") -> str:
    return f",\n{name} AS ({REPO_ROLLUP_SELECT.format(src=src, start=start, end=end)})"


TOPIC_ROLLUP_CTE = f""",
topic_rollup AS (
  SELECT r.language, rt.topic,
         CAST(date_trunc('month', r.creation_date) AS TIMESTAMP) AS creation_date,
         CAST(date_trunc('month', r.last_commit_date) AS TIMESTAMP) AS last_commit_date,
         count(DISTINCT rt.repo_id) AS n_repos
  FROM repo_topic rt JOIN repo_full r ON r.id = rt.repo_id
  WHERE r.creation_date >= TIMESTAMP '{ROLLUP_START}' AND r.creation_date <= TIMESTAMP '{ROLLUP_END}'
  GROUP BY 1, 2, 3, 4)"""

TOPICS_DATA_CTE = """,
topics_data AS (
  SELECT language, topic, CAST(sum(n_repos) AS BIGINT) AS n_repos
  FROM topic_rollup GROUP BY language, topic HAVING sum(n_repos) >= {min_repos})"""

F8_CTE = f""",
f8 AS (
  SELECT language, license, creation_year, last_commit_year,
         CAST(sum(n_repos) AS BIGINT) AS n_repos, CAST(sum(n_owners) AS BIGINT) AS n_owners,
         CAST(sum(n_archived_repos) AS BIGINT) AS n_archived_repos,
         CAST(sum(n_repos_with_license) AS BIGINT) AS n_repos_with_license,
         CAST(sum(n_repos_with_topic) AS BIGINT) AS n_repos_with_topic,
         CAST(sum(n_repos_with_desc) AS BIGINT) AS n_repos_with_desc,
         CAST(sum(n_repos_with_wiki) AS BIGINT) AS n_repos_with_wiki,
         round(avg(size)) AS size,
         round(avg(stars), 1) AS stars, round(avg(watchers), 1) AS watchers,
         round(avg(forks), 1) AS forks, round(avg(open_issues), 1) AS open_issues,
         CAST(ceil(avg(days_since_creation)) AS BIGINT) AS days_since_creation,
         CAST(ceil(avg(days_since_last_commit)) AS BIGINT) AS days_since_last_commit
  FROM rollup
  WHERE creation_date BETWEEN TIMESTAMP '{F8_CREATION[0]}' AND TIMESTAMP '{F8_CREATION[1]}'
    AND last_commit_date BETWEEN TIMESTAMP '{F8_COMMIT[0]}' AND TIMESTAMP '{F8_COMMIT[1]}'
    AND language IN ({", ".join("'" + x + "'" for x in F8_LANGS)})
  GROUP BY language, license, creation_year, last_commit_year)"""


def _with(*parts: str) -> str:
    body = "".join(parts).strip()
    if body.startswith(","):
        body = body[1:]
    return "WITH " + body + "\n"


# ---------------------------------------------------------------------------
# Spark helpers shared by several queries
# ---------------------------------------------------------------------------


def _rollup(spark, d):
    return repo_rollup(B.repo_t(spark, d), ROLLUP_START, ROLLUP_END)


def _topic_rollup(spark, d):
    return topic_rollup(B.repo_topic_t(spark, d), B.repo_t(spark, d), ROLLUP_START, ROLLUP_END)


# The dashboard's reports read the roll-up tables the ETL wrote
# (repo_analytics, topic_analytics), not a recomputation of them per
# report: both are derived once per session from the modelled tables and
# read back with pruning. ``repo_rollup`` / ``topic_rollup`` (F1, F2)
# themselves always compute from the repo tables.
def _rollup_table(spark, d):
    return B.materialized(spark, d, "repo_analytics", _rollup)


def _topic_rollup_table(spark, d):
    return B.materialized(spark, d, "topic_analytics", _topic_rollup)


def _f8(spark, d):
    return RP.rollup_filtered(_rollup_table(spark, d), F8_CREATION, F8_COMMIT, F8_LANGS)


# ---------------------------------------------------------------------------
# Queries
# ---------------------------------------------------------------------------

Q: dict[str, QueryFn] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return deco


# C1-C13, G1 -----------------------------------------------------------------
@register("repo_normalize", _with(B.REPO_SQL) + "SELECT * FROM repo_full")
def q_repo_normalize(spark, d):
    return B.repo(spark, d)


# C7 -------------------------------------------------------------------------
@register(
    "round_to_day",
    f"SELECT event_id, ts, {B.round_day_sql('ts')} AS day FROM events",
)
def q_round_to_day(spark, d):
    ev = _t(spark, d, "events")
    return ev.select("event_id", "ts", D.round_to_day(F.col("ts")).alias("day"))


# C14 ------------------------------------------------------------------------
@register("topic_table", _with(B.NORM_SQL, B.REPO_TOPIC_SQL) + "SELECT * FROM repo_topic")
def q_topic_table(spark, d):
    return B.repo_topic(spark, d)


# C11, C12, C15 --------------------------------------------------------------
_TOPIC_TRUNC_SQL = """
WITH pairs AS (
  SELECT DISTINCT o.o_custkey, lower(p.p_name || '-' || p.p_brand) AS t
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey),
lists AS (SELECT o_custkey, list_sort(list(t)) AS tl FROM pairs GROUP BY o_custkey),
j AS (
  SELECT c.c_custkey, coalesce(array_to_string(l.tl, '|'), '') AS joined
  FROM customer c LEFT JOIN lists l ON l.o_custkey = c.c_custkey),
capped AS (
  SELECT c_custkey, CAST(length(joined) AS INTEGER) AS full_length,
         CASE WHEN length(joined) > 255 THEN regexp_replace(substr(joined, 1, 255), '\\|?[^|]*$', '')
              ELSE joined END AS topics
  FROM j)
SELECT c_custkey, full_length, topics, CAST(topics <> '' AS INTEGER) AS has_topic,
       CAST(len(string_split(CASE WHEN topics = '' THEN '__NA__' ELSE topics END, '|')) AS INTEGER) AS n_topics,
       string_split(CASE WHEN topics = '' THEN '__NA__' ELSE topics END, '|')[-1] AS last_topic
FROM capped
"""


@register("topic_join_truncate", _TOPIC_TRUNC_SQL)
def q_topic_join_truncate(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_custkey")
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = _t(spark, d, "part").select("p_partkey", "p_name", "p_brand")
    pairs = (
        o.join(li, o["o_orderkey"] == li["l_orderkey"])
        .join(p, li["l_partkey"] == p["p_partkey"])
        .select("o_custkey", F.lower(F.concat("p_name", F.lit("-"), "p_brand")).alias("t"))
    )
    # collect_set de-duplicates map-side: a customer's list is bounded by the
    # distinct name-brand strings, not by its number of lines.
    lists = pairs.groupBy("o_custkey").agg(F.sort_array(F.collect_set("t")).alias("tl"))
    c = _t(spark, d, "customer").select("c_custkey")
    j = c.join(lists, c["c_custkey"] == lists["o_custkey"], "left")
    topics = join_topics_capped(F.col("tl"))
    parts = split_topics(F.col("topics"))
    return (
        j.select(
            "c_custkey",
            F.length(F.array_join(F.coalesce("tl", F.array().cast("array<string>")), "|")).alias("full_length"),
            topics.alias("topics"),
        )
        .withColumn("has_topic", (F.col("topics") != "").cast("int"))
        .withColumn("n_topics", F.size(parts))
        .withColumn("last_topic", F.element_at(parts, -1))
    )


# B9, E5 ---------------------------------------------------------------------
_KEEP_LATEST_SQL = """
WITH eb AS (SELECT event_id, user_id, event_type, value, CAST(date_trunc('day', ts) AS TIMESTAMP) AS updated_at
            FROM events)
SELECT * FROM eb e
WHERE NOT EXISTS (SELECT 1 FROM eb e2
                  WHERE e2.user_id = e.user_id AND e2.event_type = e.event_type
                    AND e.updated_at < e2.updated_at)
"""


@register("keep_latest", _KEEP_LATEST_SQL)
def q_keep_latest(spark, d):
    ev = _t(spark, d, "events").select(
        "event_id", "user_id", "event_type", "value",
        D.day_start(F.col("ts")).alias("updated_at"),
    )
    return keep_latest(ev, ["user_id", "event_type"], "updated_at")


# G1 -------------------------------------------------------------------------
_DEDUPE_FIRST_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1
"""


@register("dedupe_first", _DEDUPE_FIRST_SQL)
def q_dedupe_first(spark, d):
    li = _t(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    return dedupe_first(li, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"])


# B7 -------------------------------------------------------------------------
_UPSERT_SQL = f"""
WITH old AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
                    TIMESTAMP '2002-12-31 00:00:00' AS updated_at FROM orders),
new AS (SELECT o_orderkey + 2000 AS o_orderkey, o_custkey + 1 AS o_custkey, 'N' AS o_orderstatus,
               o_totalprice * 2 AS o_totalprice, TIMESTAMP '{TS}' AS updated_at
        FROM orders WHERE o_orderkey % 3 = 0)
SELECT coalesce(n.o_orderkey, o.o_orderkey) AS o_orderkey,
       CASE WHEN o.o_orderkey IS NOT NULL THEN o.o_custkey ELSE n.o_custkey END AS o_custkey,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_orderstatus ELSE o.o_orderstatus END AS o_orderstatus,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.o_totalprice ELSE o.o_totalprice END AS o_totalprice,
       CASE WHEN n.o_orderkey IS NOT NULL THEN n.updated_at ELSE o.updated_at END AS updated_at
FROM old o FULL OUTER JOIN new n ON o.o_orderkey = n.o_orderkey
"""


@register("upsert_merge", _UPSERT_SQL)
def q_upsert_merge(spark, d):
    o = _t(spark, d, "orders")
    old = o.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
        ntz_lit(dt.datetime(2002, 12, 31)).alias("updated_at"),
    )
    new = o.where(F.col("o_orderkey") % 3 == 0).select(
        (F.col("o_orderkey") + 2000).alias("o_orderkey"),
        (F.col("o_custkey") + 1).alias("o_custkey"),
        F.lit("N").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
        ntz_lit(B.BATCH_TS).alias("updated_at"),
    )
    return upsert_merge(old, new, ["o_orderkey"], ["o_orderstatus", "o_totalprice", "updated_at"])


# B5, B6, I1 -----------------------------------------------------------------
_APPEND_SQL = f"""
SELECT c_custkey AS id, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
       c_mktsegment AS segment, TIMESTAMP '2002-12-31 00:00:00' AS updated_at FROM customer
UNION ALL
SELECT s_suppkey AS id, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
       NULL::VARCHAR AS segment, TIMESTAMP '{TS}' AS updated_at FROM supplier
"""


@register("append_aligned", _APPEND_SQL)
def q_append_aligned(spark, d):
    c = _t(spark, d, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
        ntz_lit(dt.datetime(2002, 12, 31)).alias("updated_at"),
    )
    s = _t(spark, d, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"),
        F.lit("supplier").alias("source"),
    )
    return append_aligned(c, s, defaults={"updated_at": B.BATCH_TS})


# F3, C30, H3 ----------------------------------------------------------------
_TOPK_SQL = _with(B.REPO_SQL) + """,
lic AS (SELECT license FROM repo_full GROUP BY license ORDER BY count(*) DESC, license ASC NULLS LAST LIMIT 10),
br AS (SELECT default_branch FROM repo_full GROUP BY default_branch
       ORDER BY count(*) DESC, default_branch ASC NULLS LAST LIMIT 10),
upd AS (
  SELECT CASE WHEN license IN (SELECT license FROM lic) OR license = '__NA__' THEN license ELSE 'Other' END AS license,
         CASE WHEN default_branch IN (SELECT default_branch FROM br) OR default_branch = '__NA__'
              THEN default_branch ELSE 'Other' END AS default_branch
  FROM repo_full)
SELECT license, default_branch, count(*) AS n FROM upd GROUP BY 1, 2
"""


@register("topk_other", _TOPK_SQL)
def q_topk_other(spark, d):
    r = keep_top_k(B.repo_t(spark, d), ["license", "default_branch"], 10)
    return r.groupBy("license", "default_branch").agg(F.count(F.lit(1)).alias("n"))


# F1, C27-C29, D19 -----------------------------------------------------------
@register("repo_rollup", _with(B.REPO_SQL, rollup_cte()) + "SELECT * FROM rollup")
def q_repo_rollup(spark, d):
    return _rollup(spark, d)


# F2, E1 ---------------------------------------------------------------------
@register(
    "topic_rollup",
    _with(B.REPO_SQL, B.REPO_TOPIC_SQL, TOPIC_ROLLUP_CTE) + "SELECT * FROM topic_rollup",
)
def q_topic_rollup(spark, d):
    return _topic_rollup(spark, d)


# F4 -------------------------------------------------------------------------
@register(
    "owner_counts",
    _with(B.NORM_SQL)
    + "SELECT owner AS name, owner_url AS url, count(id) AS n_repos FROM norm "
    "WHERE owner IS NOT NULL AND owner_url IS NOT NULL GROUP BY 1, 2",
)
def q_owner_counts(spark, d):
    return owner_table(B.normalized(spark, d))


# F5, H6 ---------------------------------------------------------------------
@register(
    "filters_info",
    _with(B.REPO_SQL, rollup_cte())
    + """SELECT language, CAST(sum(n_repos) AS BIGINT) AS n_repos,
       min(creation_year) AS creation_start_year, max(creation_year) AS creation_end_year,
       min(last_commit_year) AS last_commit_start_year, max(last_commit_year) AS last_commit_end_year
FROM rollup GROUP BY language ORDER BY n_repos DESC NULLS FIRST, language""",
)
def q_filters_info(spark, d):
    return RP.filters_info(_rollup_table(spark, d))


# D17 ------------------------------------------------------------------------
@register(
    "language_options",
    _with(B.REPO_SQL, rollup_cte())
    + """SELECT language, CAST(sum(n_repos) AS BIGINT) AS n_repos FROM rollup
WHERE language IN ('Python', 'Jupyter Notebook', 'Markdown', 'HTML', 'Shell', 'Java', 'JavaScript',
                   'TypeScript', 'C', 'C++', 'C#', 'Rust', 'Go')
GROUP BY language""",
)
def q_language_options(spark, d):
    return RP.language_options(RP.filters_info(_rollup_table(spark, d)))


# F6, D14 --------------------------------------------------------------------
TOPICS_MIN = 40


@register(
    "topics_having",
    _with(B.REPO_SQL, B.REPO_TOPIC_SQL, TOPIC_ROLLUP_CTE, TOPICS_DATA_CTE.format(min_repos=TOPICS_MIN))
    + "SELECT * FROM topics_data",
)
def q_topics_having(spark, d):
    return RP.topics_data(_topic_rollup_table(spark, d), TOPICS_MIN)


# F7 -------------------------------------------------------------------------
@register(
    "package_freq",
    _with(B.PACKAGE_SQL) + "SELECT language, package, count(*) AS freq FROM package GROUP BY 1, 2",
)
def q_package_freq(spark, d):
    return RP.packages_data(B.package_t(spark, d))


# D15 ------------------------------------------------------------------------
PACKAGE_FLOOR = 60


@register(
    "package_options",
    _with(B.PACKAGE_SQL)
    + f"""SELECT package FROM (SELECT language, package, count(*) AS freq FROM package GROUP BY 1, 2)
WHERE freq >= {PACKAGE_FLOOR} AND package IS NOT NULL""",
)
def q_package_options(spark, d):
    return RP.package_options(RP.packages_data(B.package_t(spark, d)), PACKAGE_FLOOR)


# F8, D1-D3 ------------------------------------------------------------------
@register("rollup_filtered", _with(B.REPO_SQL, rollup_cte(), F8_CTE) + "SELECT * FROM f8")
def q_rollup_filtered(spark, d):
    return _f8(spark, d)


# F9, C35 --------------------------------------------------------------------
@register(
    "kpi_report",
    _with(B.REPO_SQL, B.REPO_TOPIC_SQL, rollup_cte(), F8_CTE, TOPIC_ROLLUP_CTE, TOPICS_DATA_CTE.format(min_repos=1))
    + """SELECT CAST(coalesce(sum(n_repos), 0) AS BIGINT) AS n_repos,
       CAST(coalesce(sum(n_owners), 0) AS BIGINT) AS n_owners,
       CAST(count(DISTINCT language) AS BIGINT) AS language,
       (SELECT count(DISTINCT topic) FROM topics_data WHERE n_repos >= 10) AS topics,
       round(coalesce(avg(stars), 0), 1) AS stars,
       round(coalesce(avg(watchers), 0), 1) AS watchers,
       round(coalesce(avg(forks), 0), 1) AS forks,
       round(coalesce(avg(open_issues), 0), 1) AS open_issues
FROM f8""",
)
def q_kpi_report(spark, d):
    from repolens.schemas import SUPPORTED_LANGUAGES

    # The page's topic rows: every language selected -> the frequency floor.
    topics = RP.filter_topics(RP.topics_data(_topic_rollup_table(spark, d), 1), list(SUPPORTED_LANGUAGES.values()))
    return RP.kpi_report(_f8(spark, d), topics)


# E4 -------------------------------------------------------------------------
@register(
    "repos_all_packages",
    """SELECT l.l_orderkey AS repo_id FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
WHERE p.p_brand IN ('Brand#1', 'Brand#2') GROUP BY l.l_orderkey HAVING count(DISTINCT p.p_brand) = 2""",
)
def q_repos_all_packages(spark, d):
    li = _t(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    p = _t(spark, d, "part").select("p_partkey", "p_brand")
    items = li.join(p, li["l_partkey"] == p["p_partkey"]).select(
        F.col("l_orderkey").alias("repo_id"), F.col("p_brand").alias("package")
    )
    return repos_with_all(items, ["Brand#1", "Brand#2"])


# J1, D0-D9, E2, E3, I2, H1, C16 ---------------------------------------------
EXPLORER_LANGS = ["Python", "Java", "Go", "C", "Rust", "HTML", "Shell"]
EXPLORER_TOPICS = ["small widget", "old rod", "hot ring", "large rod"]
EXPLORER_PACKAGES = ["red-plate", "small-widget"]
EXPLORER_LICENSES = [f"NATION_{i}" for i in (2, 3, 10, 11, 12, 13, 19, 21, 23, 24)]

_REPORT_COLS = """name, url, language, stars, forks, open_issues, archived, has_wiki, description, license,
       topics, owner, days_since_creation, days_since_last_commit, creation_date, last_commit_date"""


def _in(values):
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_EXPLORER_FULL_SQL = _with(B.REPO_SQL, B.REPO_TOPIC_SQL, "," + B.PACKAGE_SQL) + f""",
package_repos AS (
  SELECT repo_id FROM package WHERE package IN ({_in(EXPLORER_PACKAGES)})
  GROUP BY repo_id HAVING count(DISTINCT package) = {len(set(EXPLORER_PACKAGES))}),
filtered_repos AS (
  SELECT DISTINCT repo_id FROM repo_topic rt
  WHERE rt.topic IN ({_in(EXPLORER_TOPICS)}) AND rt.language IN ({_in(EXPLORER_LANGS)})),
rep AS (
  SELECT DISTINCT r.id, r.{_REPORT_COLS.replace(', ', ', r.').replace(chr(10) + '       ', chr(10) + '       r.')}
  FROM repo_full r
  WHERE r.id IN (SELECT repo_id FROM package_repos) AND r.id IN (SELECT repo_id FROM filtered_repos)
    AND r.creation_date BETWEEN TIMESTAMP '1995-06-01' AND TIMESTAMP '2000-12-31'
    AND r.last_commit_date BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '2002-12-31'
    AND r.language IN ({_in(EXPLORER_LANGS)}) AND r.license IN ({_in(EXPLORER_LICENSES)}))
SELECT {_REPORT_COLS} FROM rep ORDER BY stars DESC NULLS FIRST, id ASC LIMIT 100
"""


@register("explorer_full", _EXPLORER_FULL_SQL)
def q_explorer_full(spark, d):
    return repo_report(
        B.repo_t(spark, d),
        B.repo_topic_t(spark, d),
        B.package_t(spark, d),
        creation_date_range=("1995-06-01", "2000-12-31"),
        last_commit_date_range=("1995-01-01", "2002-12-31"),
        languages=EXPLORER_LANGS,
        topics=EXPLORER_TOPICS,
        licenses=EXPLORER_LICENSES,
        packages=EXPLORER_PACKAGES,
        sort_by="stars",
        limit=100,
        split=False,
    )


# D0, D5-D8, H1, H2, G2 ------------------------------------------------------
_EXPLORER_FLAGS_SQL = _with(B.REPO_SQL, B.REPO_TOPIC_SQL) + f""",
filtered_repos AS (SELECT DISTINCT repo_id FROM repo_topic rt WHERE rt.topic != '__NA__'),
rep AS (
  SELECT DISTINCT r.id, r.{_REPORT_COLS.replace(', ', ', r.').replace(chr(10) + '       ', chr(10) + '       r.')}
  FROM repo_full r
  WHERE r.id IN (SELECT repo_id FROM filtered_repos)
    AND r.archived = 0 AND r.has_wiki = 1 AND r.has_license = 1),
top AS (SELECT * FROM rep ORDER BY forks DESC NULLS FIRST, id ASC LIMIT 10000)
SELECT {_REPORT_COLS} FROM top ORDER BY forks DESC NULLS FIRST, id ASC LIMIT 100
"""


@register("explorer_flags", _EXPLORER_FLAGS_SQL)
def q_explorer_flags(spark, d):
    from repolens.operators.explorer import display_head

    rep = repo_report(
        B.repo_t(spark, d),
        B.repo_topic_t(spark, d),
        exclude_archived=True,
        exclude_without_wiki=True,
        exclude_without_license=True,
        exclude_without_topic=True,
        sort_by="forks",
        limit=10000,
        split=False,
    )
    return display_head(rep, 100)


# D13, H5 --------------------------------------------------------------------
_PAGED_SQL = _with(B.REPO_SQL) + """
SELECT id, name, lang_alias, stars, creation_date, last_commit_date FROM repo_full
WHERE last_commit_date >= TIMESTAMP '1998-01-01' AND stars >= 1 AND lang_alias IN ('python', 'java')
ORDER BY stars DESC NULLS FIRST, id ASC LIMIT 100 OFFSET 100
"""


@register("paged_search", _PAGED_SQL)
def q_paged_search(spark, d):
    page = paged_search(
        B.repo_t(spark, d), languages=["python", "java"], min_pushed_date="1998-01-01", min_stars=1, page=2
    )
    return page.select("id", "name", "lang_alias", "stars", "creation_date", "last_commit_date")


# F10, F19 -------------------------------------------------------------------
_CATEGORICAL_SQL = _with(B.REPO_SQL, rollup_cte()) + """,
lic_tot AS (SELECT license AS value, sum(n_repos) AS n FROM rollup
            WHERE license IS NOT NULL AND license <> '__NA__' GROUP BY license),
lic_top AS (SELECT value FROM lic_tot ORDER BY n DESC, value ASC LIMIT 5),
br_tot AS (SELECT default_branch AS value, count(*) AS n FROM repo_full
           WHERE default_branch IS NOT NULL AND default_branch <> '__NA__' GROUP BY default_branch),
br_top AS (SELECT value FROM br_tot ORDER BY n DESC, value ASC LIMIT 3)
SELECT 'license' AS dimension, CASE WHEN value IN (SELECT value FROM lic_top) THEN value ELSE 'Other' END AS value,
       CAST(sum(n) AS BIGINT) AS n_repos FROM lic_tot GROUP BY 1, 2
UNION ALL
SELECT 'default_branch', CASE WHEN value IN (SELECT value FROM br_top) THEN value ELSE 'Other' END,
       CAST(sum(n) AS BIGINT) FROM br_tot GROUP BY 1, 2
"""


@register("categorical_topn", _CATEGORICAL_SQL)
def q_categorical_topn(spark, d):
    lic = RP.categorical_top_n(_rollup_table(spark, d), "license", "n_repos", 5)
    br = RP.categorical_top_n(
        B.repo_t(spark, d).withColumn("n_repos", F.lit(1)), "default_branch", "n_repos", 3
    )
    return lic.select(F.lit("license").alias("dimension"), F.col("license").alias("value"), "n_repos").unionByName(
        br.select(F.lit("default_branch").alias("dimension"), F.col("default_branch").alias("value"), "n_repos")
    )


# F16 ------------------------------------------------------------------------
@register(
    "licenses_by_repos",
    _with(B.REPO_SQL, rollup_cte(), F8_CTE)
    + "SELECT license, CAST(sum(n_repos) AS BIGINT) AS n_repos FROM f8 GROUP BY license",
)
def q_licenses_by_repos(spark, d):
    return RP.licenses_by_repos(_f8(spark, d))


# F11 ------------------------------------------------------------------------
HAS_PROPS = [
    ("n_repos_with_license", "has_license"),
    ("n_archived_repos", "is_archived"),
    ("n_repos_with_wiki", "has_wiki"),
    ("n_repos_with_topic", "has_topic"),
]

_HAS_PROP_SQL = (
    _with(B.REPO_SQL, rollup_cte(), F8_CTE)
    + ",\ntot AS (SELECT "
    + ", ".join(f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c, _ in HAS_PROPS)
    + ", CAST(coalesce(sum(n_repos), 0) AS BIGINT) AS n FROM f8)\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{label}' AS property, 'Yes' AS answer, {c} AS n_repos FROM tot\n"
        f"UNION ALL SELECT '{label}', 'No', n - {c} FROM tot"
        for c, label in HAS_PROPS
    )
)


@register("has_property", _HAS_PROP_SQL)
def q_has_property(spark, d):
    # The four pie charts from one aggregate pass over the roll-up.
    return RP.has_properties(_f8(spark, d), HAS_PROPS)


# F12 ------------------------------------------------------------------------
_HIST_SQL = """
WITH per_order AS (SELECT CAST(l_orderkey AS VARCHAR) AS topic, count(*) AS n_repos FROM lineitem GROUP BY 1),
tot AS (SELECT topic, sum(n_repos) AS total FROM per_order GROUP BY topic),
b AS (SELECT CAST(CASE WHEN total >= 10 THEN 10 ELSE total END AS BIGINT) AS sort_key FROM tot)
SELECT CASE WHEN sort_key >= 10 THEN CAST(sort_key AS VARCHAR) || '+' ELSE CAST(sort_key AS VARCHAR) END AS freq,
       count(*) AS count, sort_key
FROM b GROUP BY sort_key
"""


@register("topic_histogram", _HIST_SQL)
def q_topic_histogram(spark, d):
    per_order = _t(spark, d, "lineitem").groupBy(F.col("l_orderkey").cast("string").alias("topic")).agg(
        F.count(F.lit(1)).alias("n_repos")
    )
    return RP.topic_histogram(per_order, threshold=10)


# F13-F15 --------------------------------------------------------------------
_BY_YEAR_SQL = _with(B.REPO_SQL, rollup_cte(), F8_CTE) + """
SELECT 'creation_year' AS dimension, CAST(creation_year AS VARCHAR) AS key, CAST(sum(n_repos) AS BIGINT) AS n_repos
FROM f8 GROUP BY 1, 2
UNION ALL
SELECT 'last_commit_year', CAST(last_commit_year AS VARCHAR), CAST(sum(n_repos) AS BIGINT) FROM f8 GROUP BY 1, 2
UNION ALL
SELECT 'language', language, CAST(sum(n_repos) AS BIGINT) FROM f8 GROUP BY 1, 2
"""


@register("repos_by_year_language", _BY_YEAR_SQL)
def q_repos_by_year_language(spark, d):
    # The three bar charts as one GROUPING SETS aggregation over the roll-up.
    return RP.repos_by_many(_f8(spark, d), ["creation_year", "last_commit_year", "language"])


# F17 ------------------------------------------------------------------------
CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber", "k"]


def _corr_sql() -> str:
    parts = []
    for i, a in enumerate(CORR_COLS):
        for b in CORR_COLS:
            expr = (
                f"round(covar_pop({a}, {b}) / nullif(stddev_pop({a}) * stddev_pop({b}), 0) * 100, 1) + 0.0"
            )
            parts.append(f"SELECT '{a}' AS \"row\", '{b}' AS col, {expr} AS corr FROM src")
    return (
        "WITH src AS (SELECT CAST(l_quantity AS DOUBLE) AS l_quantity, CAST(l_extendedprice AS DOUBLE) AS l_extendedprice,"
        " CAST(l_discount AS DOUBLE) AS l_discount, CAST(l_tax AS DOUBLE) AS l_tax,"
        " CAST(l_linenumber AS DOUBLE) AS l_linenumber, 1.0::DOUBLE AS k FROM lineitem)\n"
        + "\nUNION ALL\n".join(parts)
    )


@register("corr_matrix", _corr_sql())
def q_corr_matrix(spark, d):
    li = _t(spark, d, "lineitem").withColumn("k", F.lit(1.0))
    return RP.corr_matrix(li, CORR_COLS)


# F17 on the dashboard's own input: the filtered roll-up's six metrics.
def _corr_rollup_sql() -> str:
    cols = RP.CORR_COLUMNS
    parts = []
    for a in cols:
        for b in cols:
            ma = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END"
            mb = f"CASE WHEN {a} IS NOT NULL AND {b} IS NOT NULL THEN CAST({b} AS DOUBLE) END"
            expr = f"round(covar_pop({ma}, {mb}) / nullif(stddev_pop({ma}) * stddev_pop({mb}), 0) * 100, 1) + 0.0"
            parts.append(f"SELECT '{a}' AS \"row\", '{b}' AS col, {expr} AS corr FROM f8")
    return _with(B.REPO_SQL, rollup_cte(), F8_CTE) + "\nUNION ALL\n".join(parts)


@register("corr_rollup", _corr_rollup_sql())
def q_corr_rollup(spark, d):
    return RP.corr_matrix(_f8(spark, d))


# F18, H4, D18 ---------------------------------------------------------------
@register(
    "topic_cloud",
    _with(B.REPO_SQL, B.REPO_TOPIC_SQL, TOPIC_ROLLUP_CTE, TOPICS_DATA_CTE.format(min_repos=1))
    + """,
head AS (SELECT * FROM topics_data ORDER BY n_repos DESC, topic, language LIMIT 100)
SELECT topic, min(n_repos) AS n_repos FROM head GROUP BY topic HAVING topic <> '__NA__'""",
)
def q_topic_cloud(spark, d):
    return RP.topic_cloud(RP.topics_data(_topic_rollup_table(spark, d), 1), 100)


# D16 ------------------------------------------------------------------------
TOPIC_FLOOR = 60


@register(
    "topic_options",
    _with(B.REPO_SQL, B.REPO_TOPIC_SQL, TOPIC_ROLLUP_CTE, TOPICS_DATA_CTE.format(min_repos=1))
    + f"""
SELECT DISTINCT 'all' AS branch, topic FROM topics_data WHERE n_repos >= {TOPIC_FLOOR}
UNION ALL
SELECT DISTINCT 'narrow', topic FROM topics_data WHERE language IN ('Python', 'Go') AND topic <> '__NA__'""",
)
def q_topic_options(spark, d):
    from repolens.schemas import SUPPORTED_LANGUAGES

    td = RP.topics_data(_topic_rollup_table(spark, d), 1)
    all_langs = list(SUPPORTED_LANGUAGES.values())
    a = RP.topic_options(td, all_langs, None, TOPIC_FLOOR).select(F.lit("all").alias("branch"), "topic")
    n = RP.topic_options(td, all_langs, ["Python", "Go"], TOPIC_FLOOR, exclude_empty=True).select(
        F.lit("narrow").alias("branch"), "topic"
    )
    return a.unionByName(n)


# C17 ------------------------------------------------------------------------
@register(
    "decode_content",
    _with(B.CONTENT_SQL)
    + """SELECT repo_id,
       CASE WHEN length(regexp_replace(content, '[^A-Za-z0-9+/=]', '', 'g')) % 4 = 0
            THEN try(decode(from_base64(regexp_replace(content, '[^A-Za-z0-9+/=]', '', 'g')))) END AS text
FROM content""",
)
def q_decode_content(spark, d):
    c = B.landed_content(spark, d)
    return c.select("repo_id", decode_base64_text(F.col("content")).alias("text"))


# C18-C25, J4 ----------------------------------------------------------------
@register("parse_requirements", _with(B.PACKAGE_SQL) + "SELECT * FROM package")
def q_parse_requirements(spark, d):
    return B.package(spark, d)


# C22 ------------------------------------------------------------------------
_VERSION_SQL = """
WITH s AS (
  SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN p_name
                         ELSE p_name || ' ' || CAST(p_size AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR)
                              || '.' || CAST(p_partkey % 7 AS VARCHAR) || '.' || CAST(p_partkey % 3 AS VARCHAR) END AS s
  FROM part)
SELECT p_partkey, s, regexp_extract(s, '\\b\\d+(\\.\\d+){0,2}\\b', 0) AS version FROM s
"""


@register("extract_version", _VERSION_SQL)
def q_extract_version(spark, d):
    p = _t(spark, d, "part")
    k = F.col("p_partkey")
    s = F.when(k % 4 == 0, F.col("p_name")).otherwise(
        F.concat_ws(
            "",
            F.col("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit("."),
            (k % 10).cast("string"), F.lit("."), (k % 7).cast("string"), F.lit("."), (k % 3).cast("string"),
        )
    )
    return p.select("p_partkey", s.alias("s")).withColumn("version", extract_version(F.col("s")))


# A8, D10, D11, C26, J5 ------------------------------------------------------
TREE_PATTERN = r"^en/[0-9]+|\.html$"

_TREE_SQL = f"""
WITH pp AS (
  SELECT page_id, url, CASE WHEN page_id % 5 = 0 THEN upper(p) ELSE p END AS p
  FROM (SELECT page_id, url, regexp_extract(url, '^[a-z]+://[^/]+/(.*)$', 1) AS p FROM pages)),
entries AS (
  SELECT page_id AS repo_id, p AS path, CASE WHEN page_id % 3 = 0 THEN 'tree' ELSE 'blob' END AS type, url FROM pp
  UNION ALL SELECT page_id, p || '/index.html', 'blob', url || '/index.html' FROM pp
  UNION ALL SELECT page_id, p || '/notes.html', 'tree', url || '/notes.html' FROM pp
  UNION ALL SELECT page_id, 'setup.py', 'blob', url || '/setup.py' FROM pp)
SELECT repo_id, lower(path) AS path, url FROM entries
WHERE type = 'blob' AND regexp_matches(lower(path), '{TREE_PATTERN}')
"""


def _tree_pages(spark, d):
    """One landed tree response of four entries per page (no regrouping of pages)."""
    pages = _t(spark, d, "pages")
    path = F.regexp_extract("url", r"^[a-z]+://[^/]+/(.*)$", 1)
    path = F.when(F.col("page_id") % 5 == 0, F.upper(path)).otherwise(path)
    kind = F.when(F.col("page_id") % 3 == 0, F.lit("tree")).otherwise(F.lit("blob"))

    def entry(path, kind, url):
        return F.struct(path.alias("path"), kind.alias("type"), url.alias("url"))

    below = [("/index.html", "blob"), ("/notes.html", "tree")]
    tree = [entry(path, kind, F.col("url"))]
    tree += [entry(F.concat(path, F.lit(x)), F.lit(t), F.concat("url", F.lit(x))) for x, t in below]
    tree.append(entry(F.lit("setup.py"), F.lit("blob"), F.concat("url", F.lit("/setup.py"))))
    return pages.select(F.col("page_id").alias("repo_id"), F.lit("main").alias("branch"), F.array(*tree).alias("tree"))


@register("tree_blobs", _TREE_SQL)
def q_tree_blobs(spark, d):
    return tree_blobs(_tree_pages(spark, d), TREE_PATTERN)


# E6, A9 ---------------------------------------------------------------------
_FILES_OUTER_SQL = _with(B.REPO_SQL, "," + B.FILES_SQL) + """
SELECT r.id, r.owner, r.name AS repo, r.default_branch AS branch, f.path, f.url
FROM (SELECT DISTINCT id, owner, name, default_branch FROM repo_full WHERE lang_alias = 'python' AND stars >= 1) r
LEFT JOIN (SELECT repo_id, path, url FROM files WHERE regexp_matches(path, '/en/')) f ON f.repo_id = r.id
"""


@register("repo_files_outer", _FILES_OUTER_SQL)
def q_repo_files_outer(spark, d):
    repos = select_repos_to_crawl(B.repo_t(spark, d), "python", None, min_stars=1)
    f = B.files(spark, d).where(F.col("path").rlike("/en/")).select("repo_id", "path", "url")
    return repos_with_files(repos.withColumnRenamed("id", "repo_id"), f, "repo_id").withColumnRenamed("repo_id", "id")


# E7, D12 --------------------------------------------------------------------
def _files_pattern_sql(limit: int | None = None) -> str:
    parts = [
        f"SELECT repo_id, path, url, page_id, '{p}' AS key FROM files WHERE coalesce(regexp_matches(lower(path), lower('{p}')), false)"
        for p in B.FILE_PATTERNS
    ]
    body = "\nUNION ALL\n".join(parts)
    if limit is None:
        return _with(B.FILES_SQL) + body
    return _with(B.FILES_SQL) + f""",
m AS ({body}),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY path, page_id, repo_id) AS rn FROM m)
SELECT repo_id, path, url, page_id, key FROM r WHERE rn <= {limit}"""


@register("files_by_pattern", _files_pattern_sql())
def q_files_by_pattern(spark, d):
    return files_by_pattern(B.files(spark, d), B.FILE_PATTERNS)


@register("files_first_per_pattern", _files_pattern_sql(20))
def q_files_first_per_pattern(spark, d):
    return files_by_pattern(B.files(spark, d), B.FILE_PATTERNS, limit=20, order_cols=["path", "page_id", "repo_id"])


# A4, A5, E8, J6 -------------------------------------------------------------
_CONTENT_LOOKUP_SQL = _with(B.FILES_SQL) + """,
m AS (SELECT repo_id, path, url, page_id, '/en/' AS key FROM files WHERE regexp_matches(lower(path), '/en/')),
blobs AS (SELECT 'doc:' || CAST(doc_id AS VARCHAR) AS url, text AS content FROM documents)
SELECT m.repo_id, m.path, m.key, m.page_id, md5(b.content) AS content_md5,
       CAST(length(b.content) AS INTEGER) AS content_chars
FROM (SELECT m.*, 'doc:' || CAST((repo_id * 3 + page_id) % ids AS VARCHAR) AS doc_url
      FROM m, (SELECT count(*) + count(*) // 10 + 1 AS ids FROM documents)) m
LEFT JOIN blobs b ON b.url = m.doc_url
"""


@register("content_lookup", _CONTENT_LOOKUP_SQL)
def q_content_lookup(spark, d):
    # Files name all documents, and some that do not exist: a tenth more ids than documents.
    ids = _t(spark, d, "documents").agg(F.expr("count(1) + count(1) div 10 + 1").alias("ids")).scalar()
    m = files_by_pattern(B.files(spark, d), ["/en/"]).withColumn(
        "doc_url", F.concat(F.lit("doc:"), ((F.col("repo_id") * 3 + F.col("page_id")) % ids).cast("string"))
    )
    blobs = _t(spark, d, "documents").select(
        F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"), F.col("text").alias("content")
    )
    j = content_lookup(m.drop("url").withColumnRenamed("doc_url", "url"), blobs)
    return j.select(
        "repo_id", "path", "key", "page_id",
        F.md5("content").alias("content_md5"), F.length("content").alias("content_chars"),
    )


# E9 -------------------------------------------------------------------------
_BRANCH_SQL = _with(B.REPO_SQL) + """,
trees AS (
  SELECT id AS repo_id, 'main' AS branch FROM repo_full WHERE id % 3 = 0 AND id % 7 <> 0
  UNION ALL
  SELECT id, default_branch FROM repo_full WHERE id % 7 <> 0),
avail AS (SELECT DISTINCT repo_id, branch FROM trees)
SELECT r.id, r.branch, r.default_branch, coalesce(a1.branch, a2.branch) AS tree_branch
FROM (SELECT id, 'main' AS branch, default_branch FROM repo_full) r
LEFT JOIN avail a1 ON a1.repo_id = r.id AND a1.branch = r.branch
LEFT JOIN avail a2 ON a2.repo_id = r.id AND a2.branch = r.default_branch
"""


@register("branch_fallback", _BRANCH_SQL)
def q_branch_fallback(spark, d):
    r = B.repo_t(spark, d)
    trees = (
        r.where((F.col("id") % 3 == 0) & (F.col("id") % 7 != 0))
        .select(F.col("id").alias("repo_id"), F.lit("main").alias("branch"))
        .unionByName(r.where(F.col("id") % 7 != 0).select(F.col("id").alias("repo_id"), F.col("default_branch").alias("branch")))
    )
    repos = r.select("id", F.lit("main").alias("branch"), "default_branch")
    return branch_fallback(repos, trees)


# C31, C32 -------------------------------------------------------------------
SPINE_START, SPINE_END = dt.date(2023, 12, 28), dt.date(2024, 2, 3)

_SPINE_SQL = f"""
WITH days AS (SELECT CAST(generate_series AS DATE) AS date
              FROM generate_series(DATE '{SPINE_START}', DATE '{SPINE_END}', INTERVAL 1 DAY)),
per_day AS (SELECT CAST(ts AS DATE) AS date, count(*) AS n_events FROM events GROUP BY 1)
SELECT d.date, coalesce(p.n_events, 0) AS n_events FROM days d LEFT JOIN per_day p ON p.date = d.date
"""


@register("date_spine", _SPINE_SQL)
def q_date_spine(spark, d):
    days = D.date_range(spark, SPINE_START, D.shift_date(SPINE_END, 0))
    per_day = _t(spark, d, "events").groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n_events"))
    return days.join(per_day, "date", "left").select("date", F.coalesce("n_events", F.lit(0)).alias("n_events"))


# C33 ------------------------------------------------------------------------
PERIOD_AS_OF = dt.datetime(2024, 1, 20, 12, 0, 0)


def _period_sql() -> str:
    a = f"TIMESTAMP '{PERIOD_AS_OF.isoformat(sep=' ')}'"
    rows = [
        ("All date range", "NULL::TIMESTAMP", "NULL::TIMESTAMP"),
        ("Last 12 months", f"make_timestamp(year({a}) - 1, month({a}), 1, 0, 0, 0)", a),
        ("Current year", f"make_timestamp(year({a}), 1, 1, 0, 0, 0)", a),
        ("Last month", f"CAST(date_trunc('month', {a}) - INTERVAL 1 MONTH AS TIMESTAMP)", a),
        ("Current month", f"CAST(date_trunc('month', {a}) AS TIMESTAMP)", a),
    ]
    sel = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS period, {s} AS start_ts, {e} AS end_ts,"
        f" (SELECT count(*) FROM events WHERE ({s} IS NULL) OR ts BETWEEN {s} AND {e}) AS n_events"
        for n, s, e in rows
    )
    return sel


@register("period_presets", _period_sql())
def q_period_presets(spark, d):
    ev = _t(spark, d, "events")
    ranges = [(name, D.period_range(name, PERIOD_AS_OF)) for name in D.PERIODS]
    aggs = []
    for i, (name, rng) in enumerate(ranges):
        cond = F.lit(True) if rng is None else F.col("ts").between(ntz_lit(rng[0]), ntz_lit(rng[1]))
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"n{i}"))
    counts = ev.agg(*aggs)
    entries = []
    for i, (name, rng) in enumerate(ranges):
        s = ntz_lit(rng[0] if rng else None)
        e = ntz_lit(rng[1] if rng else None)
        entries.append(F.struct(F.lit(name).alias("period"), s.alias("start_ts"), e.alias("end_ts"), F.col(f"n{i}").alias("n_events")))
    return counts.select(F.inline(F.array(*entries)))


# B1-B4, A1-A3, J10 ----------------------------------------------------------
REFRESH_AS_OF = dt.date(1999, 1, 8)

_REFRESH_SQL = _with(B.NORM_SQL) + f"""
SELECT id, lang_alias AS language, CAST(base_created AS DATE) AS created_date,
       CASE WHEN CAST(base_created AS DATE) BETWEEN DATE '{REFRESH_AS_OF - dt.timedelta(days=7)}'
                                              AND DATE '{REFRESH_AS_OF - dt.timedelta(days=1)}'
            THEN stars + 1000 ELSE stars END AS stargazers_count
FROM (SELECT n.*, o.o_orderdate AS base_created FROM norm n JOIN orders o ON o.o_orderkey = n.id)
WHERE lang_alias IN ('python', 'jupyter-notebook', 'markdown', 'html', 'shell', 'java', 'javascript',
                     'typescript', 'c', 'cpp', 'csharp', 'rust', 'go')
"""


@register("partition_refresh", _REFRESH_SQL)
def q_partition_refresh(spark, d):
    # The landed responses (input of the sinks under test) come from a
    # one-off materialisation of the fixture rather than its recomputation
    # for each of the three writes.
    return P.partition_refresh_demo(spark, B.landed_repos(spark, d), REFRESH_AS_OF)


# B11, F20 -------------------------------------------------------------------
STAT_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@register(
    "table_stats",
    "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in STAT_TABLES),
)
def q_table_stats(spark, d):
    # Bytes differ from engine to engine; tests check them.
    return table_stats(spark, {t: f"{d}/{t}.parquet" for t in STAT_TABLES}).drop("total_bytes")


# J2, J3, J7-J9, J11 ---------------------------------------------------------
ETL_START, ETL_END = "1995-01-01", "2001-12-31"

_ETL_SQL = _with(B.REPO_SQL) + """,
lic AS (SELECT license FROM repo_full WHERE lang_alias <> 'kotlin' GROUP BY license
        ORDER BY count(*) DESC, license ASC NULLS LAST LIMIT 10),
br AS (SELECT default_branch FROM repo_full WHERE lang_alias <> 'kotlin' GROUP BY default_branch
       ORDER BY count(*) DESC, default_branch ASC NULLS LAST LIMIT 10),
repo_upd AS (
  SELECT * REPLACE (
    CASE WHEN license IN (SELECT license FROM lic) OR license = '__NA__' THEN license ELSE 'Other' END AS license,
    CASE WHEN default_branch IN (SELECT default_branch FROM br) OR default_branch = '__NA__'
         THEN default_branch ELSE 'Other' END AS default_branch)
  FROM repo_full WHERE lang_alias <> 'kotlin')""" + rollup_cte("repo_upd", ETL_START, ETL_END) + """
SELECT * FROM rollup
"""


@register("etl_marts", _ETL_SQL)
def q_etl_marts(spark, d):
    marts = P.build_repo_marts(
        B.landed_repos(spark, d), as_of=B.AS_OF, batch_ts=B.BATCH_TS, start=ETL_START, end=ETL_END
    )
    return marts["repo_analytics"].drop("updated_at")


# J11 ------------------------------------------------------------------------
PAGE_PACKAGE_FLOOR = 10


def _page_sql() -> str:
    def of(name: str, select: str, where: str = "") -> str:
        return f"SELECT {select} FROM ({SQL[name]}) {where}"

    head = _with(B.REPO_SQL, B.REPO_TOPIC_SQL, TOPIC_ROLLUP_CTE, TOPICS_DATA_CTE.format(min_repos=1))
    cloud = f"""{head},
head AS (SELECT * FROM topics_data WHERE n_repos >= 10 ORDER BY n_repos DESC, topic, language LIMIT 100)
SELECT topic, min(n_repos) AS n_repos FROM head GROUP BY topic HAVING topic <> '__NA__'"""
    kpis = ["n_repos", "n_owners", "language", "topics", "stars", "watchers", "forks", "open_issues"]
    n = "CAST(n_repos AS DOUBLE) AS value"
    parts = [of("kpi_report", f"'kpi' AS frame, '{k}' AS key, NULL::VARCHAR AS other, CAST({k} AS DOUBLE) AS value") for k in kpis]
    years = "concat_ws('-', creation_start_year, creation_end_year, last_commit_start_year, last_commit_end_year)"
    parts += [
        of("filters_info", f"'filters', language, {years}, {n}"),
        of("language_options", f"'language_options', language, NULL, {n}"),
        f"SELECT 'topic_options', topic, NULL, NULL FROM ({head} SELECT DISTINCT topic FROM topics_data WHERE n_repos >= 10)",
        f"SELECT 'topic_cloud', topic, NULL, {n} FROM ({cloud})",
        of("corr_rollup", "'corr', row, col, corr"),
        of("repos_by_year_language", f"'by_' || dimension, key, NULL, {n}"),
        of("licenses_by_repos", f"'by_license', license, NULL, {n}"),
        f"""SELECT 'top_licenses', CASE WHEN rk <= 5 THEN license ELSE 'Other' END, NULL, CAST(sum(n_repos) AS DOUBLE)
FROM (SELECT *, row_number() OVER (ORDER BY n_repos DESC, license) AS rk FROM ({SQL["licenses_by_repos"]}) WHERE license IS NOT NULL AND license <> '__NA__') GROUP BY 2""",
        of("has_property", f"property, answer, NULL, {n}"),
        of("package_freq", "'packages', package, language, CAST(freq AS DOUBLE)"),
        of("package_freq", "'package_options', package, NULL, NULL", f"WHERE freq >= {PAGE_PACKAGE_FLOOR} AND package IS NOT NULL"),
    ]
    return "\nUNION ALL\n".join(parts)


@register("dashboard_page", _page_sql())
def q_dashboard_page(spark, d):
    return P.dashboard_page(
        _rollup_table(spark, d), _topic_rollup_table(spark, d), B.package_t(spark, d),
        creation_date_range=F8_CREATION, last_commit_date_range=F8_COMMIT, languages=F8_LANGS,
    )


def queries() -> dict[str, QueryFn]:
    return dict(Q) | flows.QUERIES


def oracle_sql() -> dict[str, str]:
    return dict(SQL) | flows.SQL

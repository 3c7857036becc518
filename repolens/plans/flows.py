"""Queries of the stateful flows (J2-J9): several runs over the given tables, compared by their final tables.

Fixture rules (ours): the crawl's trees and blobs are derived from orders, pages' documents and requirement files;
runs use overlapping windows, so skipping, replacing and keep-latest all show in the result.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repolens.plans import bindings as B
from repolens.plans import content as C
from repolens.plans import etl as E
from repolens.plans import pipelines as P
from repolens.plans.marts import marts, refresh_marts
from repolens.schemas import SUPPORTED_LANGUAGES
from repolens.session import shared_scratch
from repolens.sources import readers as R

START, END = "1990-01-01", "2010-12-31"
#: The first window ends, the second begins.
FIRST_END, SECOND_START = "1998-06-30", "1998-01-01"
CRAWLED = ["python", "jupyter-notebook"]
MIN_STARS = 10
TS1, TS2 = dt.datetime(2002, 12, 1), dt.datetime(2003, 1, 1)

_SUPPORTED = ", ".join(f"'{a}'" for a in SUPPORTED_LANGUAGES)
_CRAWLED = ", ".join(f"'{a}'" for a in CRAWLED)


def _sql_ts(ts: dt.datetime) -> str:
    return f"TIMESTAMP '{ts.isoformat(sep=' ')}'"


# --- inputs ----------------------------------------------------------------


def trees(spark: SparkSession, d: str, second: bool = False) -> DataFrame:
    """A landed tree a repository: every third only under the branch ``main``. ``second``: as a later crawl would
    find it, with one more file."""
    docs = F.lit(max(1, B.table(spark, d, "documents").count()))
    k = F.col("repo_id")
    text = k.cast("string")

    def entry(path: str, kind: str, url, when=None):
        e = F.struct(F.lit(path).alias("path"), F.lit(kind).alias("type"), url.alias("url"))
        return e if when is None else F.when(when, e)

    blob = F.lit(B.URL_ROOT + "blob/")
    entries = [
        entry("requirements.txt", "blob", F.concat(blob, text), k % 9 != 0),
        entry("README.md", "blob", F.concat(F.lit("doc:"), (k % docs).cast("string")), k % 11 != 0),
        entry("src", "tree", F.concat(F.lit("tree:"), text)),
        entry("Docs/Requirements-dev.TXT", "blob", F.concat(blob, (k + 1).cast("string")), k % 4 == 0),
    ]
    if second:
        entries.append(entry("setup.py", "blob", F.concat(F.lit("setup:"), text)))
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("repo_id"), "o_orderpriority")
    branch = F.when(k % 3 == 0, F.lit("main")).otherwise(F.col("o_orderpriority"))
    return o.select("repo_id", branch.alias("branch"), F.filter(F.array(*entries), lambda e: e.isNotNull()).alias("tree"))


def current_branches(spark: SparkSession, d: str) -> DataFrame:
    """What the repositories call their default branch by now; every fifteenth one has no tree there."""
    o = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("repo_id"), "o_orderpriority")
    k = F.col("repo_id")
    return o.select("repo_id", F.when(k % 15 == 0, F.lit("gone")).when(k % 3 == 0, F.lit("main")).otherwise(F.col("o_orderpriority")).alias("default_branch"))


def blobs(spark: SparkSession, d: str) -> DataFrame:
    docs = B.table(spark, d, "documents").select(F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("url"), F.base64(F.encode("text", "UTF-8")).alias("content"))
    return B.landed_content(spark, d).select("url", "content").unionByName(docs)


def _landed_trees(spark: SparkSession, d: str, second: bool = False) -> DataFrame:
    """The trees as JSON responses, one a line, read back by the reader."""
    path = shared_scratch(spark, "trees")
    trees(spark, d, second).write.option("compression", "gzip").json(path)
    return R.read_tree_pages(spark, path, multi_line=False)


def _structure_run(spark: SparkSession, d: str, root: str) -> None:
    repo, now = B.repo_t(spark, d), current_branches(spark, d)
    pattern = C.FULL_PATH_PATTERN
    C.run_structure(spark, repo, _landed_trees(spark, d), f"{root}/structure", START, FIRST_END, CRAWLED, pattern, MIN_STARS, current_branches=now)
    C.run_structure(spark, repo, _landed_trees(spark, d, True), f"{root}/structure", SECOND_START, END, CRAWLED, pattern, MIN_STARS, current_branches=now)


def _content_run(spark: SparkSession, d: str, root: str) -> None:
    found = blobs(spark, d)
    C.run_content(spark, f"{root}/structure", found, f"{root}/content", START, FIRST_END, CRAWLED)
    C.run_content(spark, f"{root}/structure", found, f"{root}/content", SECOND_START, END, CRAWLED)


# --- queries ---------------------------------------------------------------


def structure_flow(spark: SparkSession, d: str) -> DataFrame:
    root = shared_scratch(spark, "structure-flow")
    _structure_run(spark, d, root)
    return R.read_structure(spark, f"{root}/structure").drop("created_month")


def content_flow(spark: SparkSession, d: str) -> DataFrame:
    root = shared_scratch(spark, "content-flow")
    _structure_run(spark, d, root)
    _content_run(spark, d, root)
    return R.read_content(spark, f"{root}/content").select("repo_id", "path", "url", "key", "language", "created_date", F.md5(F.regexp_replace("content", "[^A-Za-z0-9+/=]", "")).alias("content_md5"))


def package_flow(spark: SparkSession, d: str) -> DataFrame:
    root = shared_scratch(spark, "package-flow")
    _structure_run(spark, d, root)
    _content_run(spark, d, root)
    C.run_packages(spark, f"{root}/content", f"{root}/marts", TS1, START, FIRST_END, CRAWLED)
    return C.run_packages(spark, f"{root}/content", f"{root}/marts", TS2, SECOND_START, END, CRAWLED)


def second_batch(raw: DataFrame) -> DataFrame:
    """The landed items as a later search would find them: more stars, every tenth one in the next language,
    every fifth one with another topic."""
    aliases = F.array(*[F.lit(a) for a in B.FIXTURE_ALIASES])
    k = F.col("id")
    n = len(B.FIXTURE_ALIASES)
    return raw.withColumns({
        "stargazers_count": F.col("stargazers_count") + 1000,
        "language": F.when(k % 10 == 0, F.element_at(aliases, (((k + 1) % n) + 1).cast("int"))).otherwise(F.col("language")),
        "topics": F.when(k % 5 == 0, F.array(F.lit("Fresh topic"))).otherwise(F.col("topics")),
    })


def incremental_marts(spark: SparkSession, d: str) -> DataFrame:
    root = shared_scratch(spark, "marts")
    raw = B.landed_repos(spark, d)
    refresh_marts(spark, root, raw.where(F.col("created_date") <= F.lit(FIRST_END).cast("date")), B.AS_OF, TS1)
    refresh_marts(spark, root, second_batch(raw).where(F.col("created_date") >= F.lit(SECOND_START).cast("date")), B.AS_OF, TS2)
    found = marts(spark, root)
    month = {c: F.date_format(c, "yyyy-MM").alias(k) for c, k in (("creation_date", "k3"), ("last_commit_date", "k4"))}
    none, number = F.lit(None).cast("string"), F.lit(None).cast("long")

    def rows(name: str, k1, k2, k3, k4, n, m, x=None):
        x = F.lit(None).cast("double") if x is None else x
        return found[name].select(F.lit(name).alias("table_name"), k1.alias("k1"), k2.alias("k2"), k3.alias("k3"), k4.alias("k4"), n.alias("n"), m.alias("m"), x.alias("x"), "updated_at")

    c = F.col
    out = rows("repo", c("id").cast("string"), c("language"), c("license"), c("default_branch"), c("stars"), c("days_since_creation"))
    out = out.unionByName(rows("repo_topic", c("repo_id").cast("string"), c("topic"), c("language"), none, number, number))
    out = out.unionByName(rows("owner", c("url"), c("name"), none, none, c("n_repos"), number))
    out = out.unionByName(rows("repo_analytics", c("language"), c("license"), month["creation_date"], month["last_commit_date"], c("n_repos"), c("n_owners"), c("stars")))
    return out.unionByName(rows("topic_analytics", c("language"), c("topic"), month["creation_date"], month["last_commit_date"], c("n_repos"), number))


def _pages(spark: SparkSession, d: str) -> str:
    """Search responses, one a line, in folders by language alias; items of unsupported languages too."""
    path = shared_scratch(spark, "pages")
    raw = B.landed_repos(spark, d)
    item = F.struct(*[c for c in raw.columns if c not in ("language", "created_date", "created_month")])
    raw.select("language", F.lit(1).cast("long").alias("total_count"), F.array(item).alias("items")).write.partitionBy("language").option("compression", "gzip").json(path)
    return path


def file_metadata(spark: SparkSession, d: str) -> DataFrame:
    root, pages = shared_scratch(spark, "land"), _pages(spark, d)
    few = ["python", "go", "rust"]
    P.land_search_pages(spark, pages, f"{root}/info", "skip", few, False, f"{root}/meta", TS1)
    P.land_search_pages(spark, pages, f"{root}/info", "skip", None, False, f"{root}/meta", TS2)
    meta = P.landed_file_metadata(spark, f"{root}/meta")
    return meta.select(
        "repo_language", "repo_creation_date", "n_repos", (F.col("elapsed_time_seconds") >= 0).alias("timed"), "updated_at",
        F.regexp_extract("file_path", "language=([^/]+)/created_month=", 1).alias("folder"),
    )


def etl_all(spark: SparkSession, d: str) -> DataFrame:
    root, tree_path, blob_path = (shared_scratch(spark, n) for n in ("etl", "etl-trees", "etl-blobs"))
    trees(spark, d).write.option("compression", "gzip").json(tree_path)
    blobs(spark, d).write.option("compression", "zstd").parquet(blob_path)
    sources = E.Sources(_pages(spark, d), tree_path, blob_path, multi_line=False)
    now = current_branches(spark, d)
    for start, end, ts in ((START, FIRST_END, TS1), (SECOND_START, END, TS2)):
        E.run_etl(spark, sources, root, end, start=start, min_stars=MIN_STARS, batch_ts=ts, current_branches=now)
    tables = {
        "info": R.read_raw_repos(spark, f"{root}/info").select("language"),
        "file_metadata": P.landed_file_metadata(spark, f"{root}/file_metadata").select(F.col("repo_language").alias("language")),
        "structure": R.read_structure(spark, f"{root}/structure").select("language"),
        "content": R.read_content(spark, f"{root}/content").select("language"),
        "package": C.package(spark, f"{root}/marts").select("language"),
    }
    modelled = marts(spark, f"{root}/marts")
    tables |= {n: modelled[n].select("language") for n in ("repo", "repo_topic")}
    tables["owner"] = modelled["owner"].select(F.lit(None).cast("string").alias("language"))
    out = None
    for name, df in tables.items():
        part = df.groupBy("language").agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "language", "n")
        out = part if out is None else out.unionByName(part)
    return out


# --- SQL -------------------------------------------------------------------


def _structure_sql(second: bool) -> str:
    """CTE ``structure``; with ``second`` days after the first window have the later crawl's file."""
    return f""",
crawl AS (
  SELECT id, lang_alias AS language, CAST(creation_date AS DATE) AS created_date,
         id % 15 <> 0 OR id % 3 <> 0 AS found
  FROM repo_full WHERE lang_alias IN ({_CRAWLED}) AND stars >= {MIN_STARS}),
entries AS (
  SELECT id, 'requirements.txt' AS path, '{B.URL_ROOT}blob/' || CAST(id AS VARCHAR) AS url FROM crawl WHERE id % 9 <> 0
  UNION ALL SELECT id, 'readme.md', 'doc:' || CAST(id % (SELECT nullif(count(*), 0) FROM documents) AS VARCHAR) FROM crawl WHERE id % 11 <> 0
  UNION ALL SELECT id, 'docs/requirements-dev.txt', '{B.URL_ROOT}blob/' || CAST(id + 1 AS VARCHAR) FROM crawl WHERE id % 4 = 0
  UNION ALL SELECT id, 'setup.py', 'setup:' || CAST(id AS VARCHAR) FROM crawl WHERE {str(second).lower()} AND created_date > DATE '{FIRST_END}'),
structure AS (
  SELECT c.id AS repo_id, e.path, e.url, c.created_date, c.language
  FROM crawl c LEFT JOIN entries e ON e.id = c.id AND c.found)"""


_BLOB_SQL = B.CONTENT_SQL.replace("\ncontent AS (", "\nblob_files AS (", 1)
_CONTENT_ROWS = """,
blobs AS (
  SELECT url, content FROM blob_files
  UNION ALL SELECT 'doc:' || CAST(doc_id AS VARCHAR), to_base64(encode(text)) FROM documents),
keys(key) AS (VALUES ('^readme.md$'), ('requirements.*\\.txt')),
landed AS (
  SELECT s.*, k.key, b.content FROM structure s JOIN keys k ON regexp_matches(s.path, k.key)
  LEFT JOIN blobs b ON b.url = s.url)"""

_STRUCTURE = "WITH " + B.REPO_SQL.strip() + _structure_sql(True)
STRUCTURE_SQL = _STRUCTURE + "\nSELECT * FROM structure"
CONTENT_SQL = _STRUCTURE + "," + _BLOB_SQL + _CONTENT_ROWS + "\nSELECT repo_id, path, url, key, language, created_date, md5(regexp_replace(content, '[^A-Za-z0-9+/=]', '', 'g')) AS content_md5 FROM landed"
_PACKAGE_ROWS = """,
content AS (SELECT repo_id, path, url, content, language FROM landed WHERE key LIKE 'requirements%')""" + B.PACKAGE_SQL[len(B.CONTENT_SQL) :]
PACKAGE_SQL = (
    _STRUCTURE + "," + _BLOB_SQL + _CONTENT_ROWS + _PACKAGE_ROWS
    + f""",
days AS (SELECT id AS repo_id, created_date FROM crawl)
SELECT p.repo_id, p.language, p.package, p.version, p.operator,
       CASE WHEN d.created_date >= DATE '{SECOND_START}' THEN {_sql_ts(TS2)} ELSE {_sql_ts(TS1)} END AS updated_at
FROM package p JOIN days d USING (repo_id)
UNION ALL
SELECT p.repo_id, p.language, p.package, p.version, p.operator, {_sql_ts(TS1)}
FROM package p JOIN days d USING (repo_id)
WHERE p.package IS NULL AND d.created_date BETWEEN DATE '{SECOND_START}' AND DATE '{FIRST_END}'"""
)

_NEXT_ALIAS = "(SELECT l2.{c} FROM lang l2 WHERE l2.idx = (id + 1) % 14)"
MARTS_SQL = (
    "WITH " + B.REPO_SQL.strip() + f""",
dated AS (SELECT r.*, n.owner_url, n.topic_list, CAST(o.o_orderdate AS DATE) AS created_date
          FROM repo_full r JOIN norm n USING (id) JOIN orders o ON o.o_orderkey = r.id),
b1 AS (SELECT id, owner, owner_url, language, lang_alias, topic_list, license, default_branch, stars, days_since_creation, creation_date, last_commit_date
       FROM dated WHERE created_date <= DATE '{FIRST_END}' AND lang_alias IN ({_SUPPORTED})),
b2 AS (SELECT * FROM (
         SELECT id, owner, owner_url,
                CASE WHEN id % 10 = 0 THEN l.display ELSE language END AS language,
                CASE WHEN id % 10 = 0 THEN l.alias ELSE lang_alias END AS lang_alias,
                CASE WHEN id % 5 = 0 THEN ['fresh topic'] ELSE topic_list END AS topic_list,
                license, default_branch, stars + 1000 AS stars, days_since_creation, creation_date, last_commit_date
         FROM dated JOIN lang l ON l.idx = (id + 1) % 14 WHERE created_date >= DATE '{SECOND_START}')
       WHERE lang_alias IN ({_SUPPORTED})),
f AS (SELECT *, {_sql_ts(TS2)} AS updated_at FROM b2
      UNION ALL SELECT *, {_sql_ts(TS1)} FROM b1 WHERE id NOT IN (SELECT id FROM b2)),
touched AS (SELECT DISTINCT date_trunc('month', creation_date) AS m FROM b2),
top1 AS (SELECT license FROM b1 GROUP BY license ORDER BY count(*) DESC, license NULLS LAST LIMIT 10),
top2 AS (SELECT license FROM f GROUP BY license ORDER BY count(*) DESC, license NULLS LAST LIMIT 10),
g AS (SELECT f.* REPLACE (CASE WHEN license = '__NA__' OR CASE WHEN t.m IS NULL THEN license IN (SELECT license FROM top1) ELSE license IN (SELECT license FROM top2) END
                               THEN license ELSE 'Other' END AS license),
             CASE WHEN t.m IS NULL THEN {_sql_ts(TS1)} ELSE {_sql_ts(TS2)} END AS rolled_at
      FROM f LEFT JOIN touched t ON t.m = date_trunc('month', f.creation_date)),
t1 AS (SELECT id AS repo_id, language, coalesce(lower(t), '__NA__') AS topic FROM (
         SELECT id, language, unnest(CASE WHEN topic_list IS NULL OR len(topic_list) = 0 THEN [NULL::VARCHAR] ELSE topic_list END) AS t FROM b1)),
t2 AS (SELECT id AS repo_id, language, coalesce(lower(t), '__NA__') AS topic FROM (
         SELECT id, language, unnest(CASE WHEN topic_list IS NULL OR len(topic_list) = 0 THEN [NULL::VARCHAR] ELSE topic_list END) AS t FROM b2)),
t AS (SELECT *, {_sql_ts(TS2)} AS updated_at FROM t2
      UNION ALL SELECT *, {_sql_ts(TS1)} FROM t1 WHERE (repo_id, topic) NOT IN (SELECT repo_id, topic FROM t2)),
o1 AS (SELECT owner AS name, owner_url AS url, count(*) AS n FROM b1 WHERE owner IS NOT NULL GROUP BY 1, 2),
o2 AS (SELECT owner AS name, owner_url AS url, count(*) AS n FROM b2 WHERE owner IS NOT NULL GROUP BY 1, 2)
SELECT 'repo' AS table_name, CAST(id AS VARCHAR) AS k1, language AS k2, license AS k3, default_branch AS k4, stars AS n,
       CAST(days_since_creation AS BIGINT) AS m, NULL::DOUBLE AS x, updated_at FROM f
UNION ALL SELECT 'repo_topic', CAST(repo_id AS VARCHAR), topic, language, NULL, NULL, NULL, NULL, updated_at FROM t
UNION ALL SELECT 'owner', url, name, NULL, NULL, n, NULL, NULL, {_sql_ts(TS2)} FROM o2
UNION ALL SELECT 'owner', url, name, NULL, NULL, n, NULL, NULL, {_sql_ts(TS1)} FROM o1 WHERE url NOT IN (SELECT url FROM o2)
UNION ALL SELECT 'repo_analytics', language, license, strftime(creation_date, '%Y-%m'), strftime(last_commit_date, '%Y-%m'),
       count(DISTINCT id), count(DISTINCT owner), round(avg(stars), 1), max(rolled_at)
FROM g GROUP BY 2, 3, 4, 5
UNION ALL SELECT 'topic_analytics', g.language, t.topic, strftime(creation_date, '%Y-%m'), strftime(last_commit_date, '%Y-%m'),
       count(DISTINCT g.id), NULL, NULL, max(rolled_at)
FROM g JOIN t ON t.repo_id = g.id GROUP BY 2, 3, 4, 5"""
)

METADATA_SQL = (
    "WITH " + B.NORM_SQL.strip() + f"""
SELECT lang_alias AS repo_language, CAST(o.o_orderdate AS DATE) AS repo_creation_date, count(*) AS n_repos, true AS timed,
       CASE WHEN lang_alias IN ('python', 'go', 'rust') THEN {_sql_ts(TS1)} ELSE {_sql_ts(TS2)} END AS updated_at, lang_alias AS folder
FROM norm n JOIN orders o ON o.o_orderkey = n.id WHERE lang_alias IN ({_SUPPORTED}) GROUP BY 1, 2, 5"""
)

ETL_SQL = (
    "WITH " + B.REPO_SQL.strip() + B.REPO_TOPIC_SQL + _structure_sql(False) + "," + _BLOB_SQL + _CONTENT_ROWS + _PACKAGE_ROWS
    + f""",
known AS (SELECT r.*, CAST(o.o_orderdate AS DATE) AS day FROM repo_full r JOIN orders o ON o.o_orderkey = r.id WHERE lang_alias IN ({_SUPPORTED})),
packages AS (
  SELECT language FROM package
  UNION ALL SELECT p.language FROM package p JOIN crawl c ON c.id = p.repo_id
  WHERE p.package IS NULL AND c.created_date BETWEEN DATE '{SECOND_START}' AND DATE '{FIRST_END}')
SELECT 'info' AS table_name, lang_alias AS language, count(*) AS n FROM known GROUP BY 2
UNION ALL SELECT 'file_metadata', lang_alias, count(DISTINCT day) FROM known GROUP BY 2
UNION ALL SELECT 'repo', language, count(*) FROM known GROUP BY 2
UNION ALL SELECT 'repo_topic', language, count(*) FROM repo_topic WHERE repo_id IN (SELECT id FROM known) GROUP BY 2
UNION ALL SELECT 'owner', NULL, count(DISTINCT owner) FROM known
UNION ALL SELECT 'structure', language, count(*) FROM structure GROUP BY 2
UNION ALL SELECT 'content', language, count(*) FROM landed GROUP BY 2
UNION ALL SELECT 'package', language, count(*) FROM packages GROUP BY 2"""
)

QUERIES = {
    "structure_flow": structure_flow, "content_flow": content_flow, "package_flow": package_flow,
    "incremental_marts": incremental_marts, "file_metadata": file_metadata, "etl_all": etl_all,
}
SQL = {
    "structure_flow": STRUCTURE_SQL, "content_flow": CONTENT_SQL, "package_flow": PACKAGE_SQL,
    "incremental_marts": MARTS_SQL, "file_metadata": METADATA_SQL, "etl_all": ETL_SQL,
}

"""Dashboard report aggregates.

Every report reads a roll-up table; nothing is collected to the driver.
Top-n cuts are ``orderBy().limit(n)`` (bounded ``TakeOrderedAndProject``)
and are broadcast back only because n bounds them.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from repolens.functions.numeric import kpi_decimal, kpi_int
from repolens.functions.predicates import all_of, repo_conditions
from repolens.schemas import (
    NA,
    OTHER,
    PACKAGE_OPTION_FLOOR,
    SUPPORTED_LANGUAGES,
    TOPIC_OPTION_FLOOR,
)

CORR_COLUMNS = [
    "stars", "forks", "open_issues", "size", "days_since_creation", "days_since_last_commit",
]


def filters_info(rollup: DataFrame) -> DataFrame:
    """repositories and year span per language, most repositories first."""
    return (
        rollup.groupBy("language")
        .agg(
            F.sum("n_repos").cast("long").alias("n_repos"),
            F.min("creation_year").alias("creation_start_year"),
            F.max("creation_year").alias("creation_end_year"),
            F.min("last_commit_year").alias("last_commit_start_year"),
            F.max("last_commit_year").alias("last_commit_end_year"),
        )
        .orderBy(F.col("n_repos").desc_nulls_first(), F.col("language"))
    )


def topics_data(topic_rollup: DataFrame, min_repos: int = 1) -> DataFrame:
    """Repositories per (language, topic) with a HAVING floor."""
    return (
        topic_rollup.groupBy("language", "topic")
        .agg(F.sum("n_repos").cast("long").alias("n_repos"))
        .where(F.col("n_repos") >= min_repos)
        .orderBy(F.col("n_repos").desc_nulls_first(), "language", "topic")
    )


def packages_data(package: DataFrame) -> DataFrame:
    """rows per (language, package)."""
    return (
        package.groupBy("language", "package")
        .agg(F.count(F.lit(1)).alias("freq"))
        .orderBy(F.col("freq").desc(), "language", "package")
    )


def package_options(packages: DataFrame, threshold: int = PACKAGE_OPTION_FLOOR) -> DataFrame:
    """Package names with at least ``threshold`` rows, NULL dropped."""
    return packages.where((F.col("freq") >= threshold) & F.col("package").isNotNull()).select(
        "package"
    )


def rollup_filtered(
    rollup: DataFrame,
    creation_date_range=None,
    last_commit_date_range=None,
    languages=None,
) -> DataFrame:
    """F8: roll-up of the roll-up by language, licence and years, with the
    optional filters. Averages are unweighted means of the stored means."""
    conds = repo_conditions(
        creation_date_range=creation_date_range,
        last_commit_date_range=last_commit_date_range,
        languages=languages,
    )
    return (
        rollup.where(all_of(conds))
        .groupBy("language", "license", "creation_year", "last_commit_year")
        .agg(
            *[
                F.sum(c).cast("long").alias(c)
                for c in (
                    "n_repos", "n_owners", "n_archived_repos", "n_repos_with_license",
                    "n_repos_with_topic", "n_repos_with_desc", "n_repos_with_wiki",
                )
            ],
            F.round(F.avg("size")).alias("size"),
            *[F.round(F.avg(c), 1).alias(c) for c in ("stars", "watchers", "forks", "open_issues")],
            F.ceil(F.avg("days_since_creation")).cast("long").alias("days_since_creation"),
            F.ceil(F.avg("days_since_last_commit")).cast("long").alias("days_since_last_commit"),
        )
    )


def kpi_report(repos: DataFrame, topics: DataFrame, display: bool = True) -> DataFrame:
    """F9 (+C35): one-row KPI report. The distinct topic count is a scalar
    subquery, so the two aggregates meet without a join."""
    n_topics = topics.select(F.countDistinct("topic")).scalar()
    out = repos.agg(
        F.sum("n_repos").alias("n_repos"),
        F.sum("n_owners").alias("n_owners"),
        F.countDistinct("language").alias("language"),
        F.avg("stars").alias("stars"),
        F.avg("watchers").alias("watchers"),
        F.avg("forks").alias("forks"),
        F.avg("open_issues").alias("open_issues"),
    ).withColumn("topics", n_topics)
    if not display:
        return out
    return out.select(
        kpi_int(F.col("n_repos")).alias("n_repos"),
        kpi_int(F.col("n_owners")).alias("n_owners"),
        kpi_int(F.col("language")).alias("language"),
        kpi_int(F.col("topics")).alias("topics"),
        kpi_decimal(F.col("stars")).alias("stars"),
        kpi_decimal(F.col("watchers")).alias("watchers"),
        kpi_decimal(F.col("forks")).alias("forks"),
        kpi_decimal(F.col("open_issues")).alias("open_issues"),
    )


def categorical_top_n(
    data: DataFrame, group: str = "license", metric: str = "n_repos", top_n: int = 10
) -> DataFrame:
    """total ``metric`` per ``group``; ``__NA__`` (and NULL) removed
    first; the ``top_n`` largest kept (ties: value ascending), the rest
    summed as ``Other`` (merging with an existing ``Other``)."""
    totals = (
        data.where(F.col(group).isNotNull() & (F.col(group) != F.lit(NA)))
        .groupBy(group)
        .agg(F.sum(metric).alias(metric))
    )
    top = (
        totals.orderBy(F.col(metric).desc(), F.col(group).asc())
        .limit(top_n)
        .select(F.col(group).alias("__top"))
    )
    labelled = totals.join(F.broadcast(top), totals[group] == top["__top"], "left").select(
        F.when(F.col("__top").isNotNull(), F.col(group)).otherwise(F.lit(OTHER)).alias(group),
        F.col(metric),
    )
    return (
        labelled.groupBy(group)
        .agg(F.sum(metric).cast("long").alias(metric))
        .orderBy(F.col(metric).desc(), F.col(group))
    )


def has_property(data: DataFrame, col: str, label: str, metric: str = "n_repos") -> DataFrame:
    """Yes / No repository counts for a flag-sum column."""
    totals = data.agg(
        F.coalesce(F.sum(metric), F.lit(0)).cast("long").alias("__n"),
        F.coalesce(F.sum(col), F.lit(0)).cast("long").alias("__y"),
    )
    return totals.select(
        F.inline(
            F.array(
                F.struct(F.lit("Yes").alias(label), F.col("__y").alias(metric)),
                F.struct(F.lit("No").alias(label), (F.col("__n") - F.col("__y")).alias(metric)),
            )
        )
    )


def has_properties(data: DataFrame, specs: list[tuple[str, str]], metric: str = "n_repos") -> DataFrame:
    """F11 for several flags at once: (property, answer, n_repos) rows from
    a single aggregate pass (one sum per flag plus the total)."""
    aggs = [F.coalesce(F.sum(metric), F.lit(0)).cast("long").alias("__n")]
    aggs += [F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"__y{i}") for i, (c, _) in enumerate(specs)]
    totals = data.agg(*aggs)
    entries = []
    for i, (_, label) in enumerate(specs):
        y = F.col(f"__y{i}")
        entries.append(F.struct(F.lit(label).alias("property"), F.lit("Yes").alias("answer"), y.alias(metric)))
        entries.append(
            F.struct(F.lit(label).alias("property"), F.lit("No").alias("answer"), (F.col("__n") - y).alias(metric))
        )
    return totals.select(F.inline(F.array(*entries)))


def topic_histogram(data: DataFrame, threshold: int = 10, metric: str = "n_repos") -> DataFrame:
    """how many topics reach each total; totals at or above
    ``threshold`` share one ``"<threshold>+"`` bucket. ``sort_key`` orders
    the buckets."""
    totals = (
        data.where(F.col("topic").isNotNull())
        .groupBy("topic")
        .agg(F.sum(metric).alias("__total"))
    )
    bucket = F.when(F.col("__total") >= threshold, F.lit(threshold)).otherwise(F.col("__total"))
    counts = totals.groupBy(bucket.cast("long").alias("sort_key")).agg(
        F.count(F.lit(1)).alias("count")
    )
    label = F.when(
        F.col("sort_key") >= threshold, F.concat(F.col("sort_key").cast("string"), F.lit("+"))
    ).otherwise(F.col("sort_key").cast("string"))
    return counts.select(label.alias("freq"), "count", "sort_key").orderBy("sort_key")


def repos_by(data: DataFrame, col: str, metric: str = "n_repos", ascending_metric: bool = False) -> DataFrame:
    """total ``metric`` per ``col``; ordered by key, or by the
    metric ascending (F15)."""
    out = data.groupBy(col).agg(F.sum(metric).cast("long").alias(metric))
    return out.orderBy(metric, col) if ascending_metric else out.orderBy(col)


def repos_by_many(data: DataFrame, cols: list[str], metric: str = "n_repos") -> DataFrame:
    """F13-F15 in one pass: total ``metric`` per value of each of ``cols``
    as (dimension, key, metric) rows, using GROUPING SETS (a single
    aggregation over an Expand instead of one scan per chart)."""
    keyed = data.select(*[F.col(c).cast("string").alias(c) for c in cols], F.col(metric))
    grouped = keyed.groupingSets([[c] for c in cols], *cols).agg(
        F.sum(metric).cast("long").alias(metric), *[F.grouping(c).alias(f"__g_{c}") for c in cols]
    )
    dim = None
    key = None
    for c in cols:
        hit = F.col(f"__g_{c}") == 0
        dim = F.when(hit, F.lit(c)) if dim is None else dim.when(hit, F.lit(c))
        key = F.when(hit, F.col(c)) if key is None else key.when(hit, F.col(c))
    return grouped.select(dim.alias("dimension"), key.alias("key"), F.col(metric))


def licenses_by_repos(data: DataFrame) -> DataFrame:
    """F16: licences, most repositories first."""
    return (
        data.groupBy("license")
        .agg(F.sum("n_repos").alias("n_repos"))
        .orderBy(F.col("n_repos").desc(), "license")
        .select("license", "n_repos")
    )


def corr_matrix(data: DataFrame, columns: list[str] | None = None, scale: float = 100.0) -> DataFrame:
    """pairwise-complete Pearson correlation x100, one decimal, in long
    form (row, col, corr). A constant column gives NULL instead of an error.

    One narrow pass: rows are grouped by which columns are present, so that
    within a group every pair is complete and one aggregate of means,
    variances and covariances serves all pairs (no row per pair; with six
    columns 91 buffer fields, which whole-stage codegen takes). At most
    2 ** len(columns) groups remain; their moments are merged per pair about
    a mean of the pair's own, so values far from zero lose no digits and a
    column constant on a pair's rows has a variance of exactly zero. An
    empty input has no rows; a pair never present together has NULL. Up to
    62 columns."""
    columns = list(columns or CORR_COLUMNS)
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    values = [F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)]
    bits = [F.when(F.col(f"v{i}").isNull(), 0).otherwise(1 << i).cast("long") for i in range(len(columns))]
    present = reduce(lambda a, b: a + b, bits)
    moments = [F.count(F.lit(1)).alias("n")]
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        moments += [F.sum(v).alias(f"sum{i}"), F.min(v).alias(f"min{i}"), F.var_pop(v).alias(f"m{i}_{i}")]
    moments += [F.covar_pop(f"v{i}", f"v{j}").alias(f"m{i}_{j}") for i, j in pairs if i != j]
    groups = data.select(*values).groupBy(present.alias("present")).agg(*moments)

    def mean(i: int) -> Column:  # of a constant the value itself: a sum over a count may be off by a digit
        return F.when(F.col(f"m{i}_{i}") == 0, F.col(f"min{i}")).otherwise(F.col(f"sum{i}") / F.col("n"))

    entries = []
    for p, (i, j) in enumerate(pairs):
        both = F.col(f"m{i}_{j}").isNotNull()
        shares = {"n": F.col("n"), "x": mean(i), "y": mean(j)}
        shares |= {"xx": F.col(f"m{i}_{i}"), "yy": F.col(f"m{j}_{j}"), "xy": F.col(f"m{i}_{j}")}
        entries.append(F.struct(F.lit(p).alias("p"), *[F.when(both, c).alias(name) for name, c in shares.items()]))
    pair = Window.partitionBy("p")
    shifted = groups.select(F.inline(F.array(*entries))).select(
        "p", "n", "xx", "yy", "xy", (F.col("x") - F.min("x").over(pair)).alias("x"), (F.col("y") - F.min("y").over(pair)).alias("y")
    )

    def merged(a: str, b: str, within: str) -> Column:
        n, x, y = F.col("n"), F.col(a), F.col(b)
        return F.sum(n * F.col(within)) + F.sum(n * x * y) - F.sum(n * x) * F.sum(n * y) / F.sum(n)

    spread = F.sqrt(F.greatest(merged("x", "x", "xx"), F.lit(0.0))) * F.sqrt(F.greatest(merged("y", "y", "yy"), F.lit(0.0)))
    per_pair = shifted.groupBy("p").agg(F.round(F.try_divide(merged("x", "y", "xy"), spread) * F.lit(scale), 1).alias("corr"))
    # Pair index -> column names; both orientations of an off-diagonal pair
    # share one value.
    first = F.array(*[F.lit(columns[i]) for i, _ in pairs])
    second = F.array(*[F.lit(columns[j]) for _, j in pairs])
    r, c = F.element_at(first, F.col("p") + 1), F.element_at(second, F.col("p") + 1)
    return per_pair.select(
        F.inline(
            F.when(r == c, F.array(F.struct(r.alias("row"), c.alias("col"), "corr"))).otherwise(
                F.array(
                    F.struct(r.alias("row"), c.alias("col"), "corr"),
                    F.struct(c.alias("row"), r.alias("col"), "corr"),
                )
            )
        )
    )


def topic_cloud(topics: DataFrame, top_n: int = 100) -> DataFrame:
    """First ``top_n`` (language, topic) rows by repositories
    (ties: topic, language), one weight per topic (the smallest, i.e. the
    last seen in descending order), ``__NA__`` removed after the cut."""
    head = topics.orderBy(F.col("n_repos").desc(), "topic", "language").limit(top_n)
    return (
        head.groupBy("topic")
        .agg(F.min("n_repos").alias("n_repos"))
        .where(F.col("topic") != F.lit(NA))
    )


def language_options(filters: DataFrame) -> DataFrame:
    """Supported display languages only, order kept."""
    return filters.where(F.col("language").isin(list(SUPPORTED_LANGUAGES.values()))).select(
        "language", "n_repos"
    )


def filter_topics(
    topics: DataFrame,
    language_list: list[str],
    lang_filter: list[str] | None = None,
    min_freq: int = TOPIC_OPTION_FLOOR,
) -> DataFrame:
    """The (language, topic, n_repos) rows a page works with. With no
    narrower language choice, rows at or above the frequency floor; with a
    narrower choice, every row of those languages (no floor)."""
    values = lang_filter or language_list
    if len(language_list) != len(values):
        return topics.where(F.col("language").isin(list(lang_filter)))
    return topics.where(F.col("n_repos") >= min_freq)


def topic_options(
    topics: DataFrame,
    language_list: list[str],
    lang_filter: list[str] | None = None,
    min_freq: int = TOPIC_OPTION_FLOOR,
    exclude_empty: bool = False,
) -> DataFrame:
    """D16 (+D18): distinct topic names of ``filter_topics``; ``__NA__``
    dropped when empty topics are excluded."""
    out = filter_topics(topics, language_list, lang_filter, min_freq)
    if exclude_empty:
        out = out.where(F.col("topic") != F.lit(NA))
    return out.select("topic").distinct()


def record_count(df: DataFrame) -> DataFrame:
    """F20 as a one-row DataFrame (no action on the driver)."""
    return df.agg(F.count(F.lit(1)).alias("n_records"))

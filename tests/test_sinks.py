"""Landing modes: overwrite replaces only the batch's days, skip keeps
existing days, and the reader prunes by month."""

import datetime as dt

from pyspark.sql import functions as F

from repolens.schemas import RAW_REPO
from repolens.session import shared_scratch
from repolens.sources.readers import read_raw_repos
from repolens.sources.sinks import write_partitioned


def _batch(spark, days, stars):
    cols = [f.name for f in RAW_REPO.fields if f.name != "created_month"]
    rows = []
    for i, d in enumerate(days):
        r = {c: None for c in cols}
        r.update(id=i, language="python", created_date=d, stargazers_count=stars)
        rows.append(tuple(r[c] for c in cols))
    schema = [f for f in RAW_REPO.fields if f.name != "created_month"]
    from pyspark.sql import types as T

    return spark.createDataFrame(rows, T.StructType(schema))


def test_modes(spark):
    path = shared_scratch(spark, "test-landing")
    days = [dt.date(2024, 1, d) for d in (1, 2, 30)] + [dt.date(2024, 2, 1)]
    write_partitioned(_batch(spark, days, 1), path, mode="overwrite", schema=RAW_REPO)
    write_partitioned(_batch(spark, days + [dt.date(2024, 2, 2)], 2), path, mode="skip", schema=RAW_REPO)
    write_partitioned(_batch(spark, [dt.date(2024, 1, 2)], 3), path, mode="overwrite", schema=RAW_REPO)
    got = sorted(
        (r.created_date.day, r.created_date.month, r.stargazers_count)
        for r in read_raw_repos(spark, path).collect()
    )
    assert got == [(1, 1, 1), (1, 2, 1), (2, 1, 3), (2, 2, 2), (30, 1, 1)]
    win = read_raw_repos(spark, path, start="2024-01-30", end="2024-02-01")
    assert win.count() == 2
    plan = win._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "created_month" in plan

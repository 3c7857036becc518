"""Edge fixtures for the column expressions."""

import base64
import datetime as dt

import pytest
from pyspark.sql import functions as F

from repolens.functions import dates as D
from repolens.functions import requirements as R
from repolens.functions.text import join_topics_capped, split_topics


def test_round_to_day_half_even(spark):
    # 1970-01-01 is epoch day 0 (even), 1970-01-02 day 1 (odd).
    rows = [
        (dt.datetime(1970, 1, 1, 12, 0),),   # tie, even day -> stays
        (dt.datetime(1970, 1, 2, 12, 0),),   # tie, odd day -> next day
        (dt.datetime(1970, 1, 2, 11, 59),),  # below noon -> down
        (dt.datetime(1970, 1, 2, 12, 1),),   # above noon -> up
        (None,),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = [r[0] for r in df.select(D.round_to_day(F.col("ts"))).collect()]
    assert got == [
        dt.datetime(1970, 1, 1), dt.datetime(1970, 1, 3), dt.datetime(1970, 1, 2), dt.datetime(1970, 1, 3), None,
    ]


def test_round_iso_text(spark):
    df = spark.createDataFrame([("2021-05-04T13:00:00Z",), ("garbage",)], "s string")
    got = [r[0] for r in df.select(D.round_to_day(D.parse_iso_timestamp(F.col("s")))).collect()]
    assert got == [dt.datetime(2021, 5, 5), None]


def test_days_since_can_be_negative(spark):
    df = spark.createDataFrame([(dt.datetime(2003, 1, 2),)], "d timestamp_ntz")
    assert df.select(D.days_since(F.col("d"), dt.date(2003, 1, 1))).first()[0] == -1


def _cap(spark, lists, n=255):
    df = spark.createDataFrame([(x,) for x in lists], "t array<string>")
    return [r[0] for r in df.select(join_topics_capped(F.col("t"), n)).collect()]


def test_topics_cap_rules(spark):
    assert _cap(spark, [["a", "b"], [], None]) == ["a|b", "", ""]
    # exactly at a separator: last piece dropped even though complete
    assert _cap(spark, [["aaaa", "bbbb", "cc"]], 9) == ["aaaa"]
    # cut falls right after a separator
    assert _cap(spark, [["aaaa", "bbb", "cc"]], 9) == ["aaaa|bbb"]
    # a single topic longer than the cap -> ''
    assert _cap(spark, [["x" * 20]], 9) == [""]
    # under the cap -> unchanged
    assert _cap(spark, [["ab", "cd"]], 9) == ["ab|cd"]


def test_split_topics(spark):
    df = spark.createDataFrame([("a|b",), ("",)], "t string")
    assert [r[0] for r in df.select(split_topics(F.col("t"))).collect()] == [["a", "b"], ["__NA__"]]


def _b64(s: bytes) -> str:
    return base64.b64encode(s).decode()


def test_decode_base64_rules(spark):
    cases = [
        (_b64(b"abc"), "abc"),
        (_b64(b"hello world")[:8] + "\n" + _b64(b"hello world")[8:], "hello world"),  # line breaks ignored
        ("YWJ", None),          # bad padding (Python rejects)
        ("Y", None),
        ("!!!!", ""),           # foreign characters dropped, nothing left
        (_b64(b"\xff\xfe"), None),  # not UTF-8
        (None, None),
        ("", ""),
    ]
    df = spark.createDataFrame([(c,) for c, _ in cases], "c string")
    got = [r[0] for r in df.select(R.decode_base64_text(F.col("c"))).collect()]
    assert got == [e for _, e in cases]


@pytest.mark.parametrize(
    "line,expected",
    [
        ("numpy>=1.0,<2", ("numpy", ">=", "1.0")),
        ("pandas[x]==1", ("pandas", None, None)),
        ("a===2", ("a", None, "2")),
        ("foo!=3", ("foo", None, None)),
        ("bar 1.2", ("bar", None, "1.2")),
        ("requests ~= 2.31.0 # pinned", ("requests", "~=", "2.31.0")),
        ("django<4; python_version<'3.8'", ("django", "<", "4")),
        ("zope.interface", ("zope.interface", None, None)),
        ("émoji-lib==0.1", ("émoji-lib", "==", "0.1")),
    ],
)
def test_requirement_lines(spark, line, expected):
    df = spark.createDataFrame([(line,)], "l string")
    p, o, v = R.requirement_fields(F.col("l"))
    assert tuple(df.select(p, o, v).first()) == expected


def test_clean_and_extract_version(spark):
    df = spark.createDataFrame([(None,), ("1.2",), ("9" * 26,)], "v string")
    assert [r[0] for r in df.select(R.clean_version(F.col("v"))).collect()] == ["0.0.0", "1.2", None]
    df = spark.createDataFrame([("lib 1.2.3.4",), ("v1.2",), ("none",)], "s string")
    assert [r[0] for r in df.select(R.extract_version(F.col("s"))).collect()] == ["1.2.3", "2", ""]


def test_period_range():
    as_of = dt.datetime(2024, 1, 20, 12)
    assert D.period_range("All date range", as_of) is None
    assert D.period_range("Last month", as_of)[0] == dt.datetime(2023, 12, 1)
    assert D.period_range("Last 12 months", as_of)[0] == dt.datetime(2023, 1, 1)
    assert D.period_range("Current year", as_of) == (dt.datetime(2024, 1, 1), as_of)
    assert D.period_range("Current month", as_of)[0] == dt.datetime(2024, 1, 1)


def test_date_range(spark):
    assert D.date_range(spark, "2024-01-30", "2024-02-02").count() == 4
    with pytest.raises(ValueError):
        D.date_range(spark, "2024-02-02", "2024-01-30")


@pytest.mark.parametrize(
    "line",
    [
        "numpy>=1.0,<2", "pandas[x]==1", "a===2", "foo!=3", "bar 1.2", "requests ~= 2.31.0 # pinned",
        "django<4; python_version<'3.8'", "zope.interface", "émoji-lib==0.1", "x#>=1", "y >= #c 2",
        "win-lib==1.0\r", "tab\t>=\t3.4.5", "pkg==1.0\rtrailing", "a" * 40 + "==1",
    ],
)
def test_fast_requirement_fields_agree(spark, line):
    df = spark.createDataFrame([(line,)], "l string")
    slow = R.requirement_fields(F.col("l"))
    fast = R.requirement_fields_fast(F.col("l"))
    got = df.select(*slow, *fast).first()
    if "\r" in line and not line.endswith("\r"):
        # Java '.' stops at a bare CR, so the full pattern fails there; the
        # single pass matches it like Python's re does.
        assert tuple(got[3:]) == ("pkg", "==", "1.0")
    else:
        assert tuple(got[:3]) == tuple(got[3:])


def test_scale_conf_sizes_partitions():
    from repolens.session import scale_conf

    conf = scale_conf(100 * (1 << 40), executors_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    small = scale_conf(1 << 20, executors_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"

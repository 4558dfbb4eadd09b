"""Column helpers: OP-P1..P23."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.functions import cleaning, clock, depots, geo


def one(spark, expr, **values):
    """Value of an expression over a one-row frame; None columns are text."""
    fields = [
        T.StructField(k, T.StringType() if v is None else T._infer_type(v)) for k, v in values.items()
    ]
    return spark.createDataFrame([tuple(values.values())], T.StructType(fields)).select(expr).first()[0]


@pytest.mark.parametrize(
    "text,number",
    [
        ("3", 3),
        ("3.0", 3),
        (" 7 ", 7),
        ("-2", -2),
        ("3.9", 3),
        ("NaN", None),
        ("", None),
        ("1e3", None),
        ("3d", None),
        ("x", None),
        (None, None),
        ("99999999999", None),
    ],
)
def test_p2_whole_number(spark, text, number):
    assert one(spark, cleaning.whole_number("c"), c=text) == number


def test_p1_p2_trim_and_cast(spark):
    raw = spark.createDataFrame([(" a ", "3.0", " 1.5 ", "NaN"), (None, "x", "y", "NaN")], "s string, i string, d string, n string")
    schema = T.StructType(
        [
            T.StructField("s", T.StringType()),
            T.StructField("i", T.IntegerType()),
            T.StructField("d", T.DoubleType()),
            T.StructField("n", T.DoubleType()),
        ]
    )
    first, second = cleaning.cast_to(cleaning.trim_all(raw), schema).collect()
    assert tuple(first)[:3] == ("a", 3, 1.5) and math.isnan(first.n)
    assert tuple(second)[:3] == (None, None, None)


def test_p2_keeps_unnamed_columns(spark):
    raw = spark.createDataFrame([("1", "x")], "a string, extra string")
    out = cleaning.cast_to(raw, T.StructType([T.StructField("a", T.IntegerType())]))
    assert out.first().asDict() == {"a": 1, "extra": "x"}


@pytest.mark.parametrize(
    "value,date",
    [(20250715, dt.date(2025, 7, 15)), ("20250715", dt.date(2025, 7, 15)), (2025071, None), (99999999, None), (None, None)],
)
def test_p3_dates(spark, value, date):
    assert one(spark, cleaning.yyyymmdd_to_date("c"), c=value) == date


def test_p4_nan(spark):
    df = spark.createDataFrame([("NaN", float("nan"), 1), ("nan", 2.0, 2)], "s string, d double, k int")
    first, second = cleaning.nan_text_to_null(df).orderBy("k").collect()
    assert first.s is None and math.isnan(first.d) and second.s == "nan"
    assert cleaning.nan_text_to_null(df, nan_to_null=True).orderBy("k").first().d is None


def test_p5_p6_version_columns(spark):
    df = spark.createDataFrame([(1,)], "k int")
    out = cleaning.with_scd_columns(df, F.lit("2024-01-01").cast("timestamp"))
    row = cleaning.current(out).first()
    assert (row.start_dt_scd, row.end_dt_scd, row.is_current) == (dt.datetime(2024, 1, 1), None, True)


@pytest.mark.parametrize(
    "text,seconds",
    [
        ("07:05:00", 25500),
        ("25:01:00", 90060),
        ("7:05:09", 25509),
        (" 07:05:00", 25500),
        ("7:05", None),
        ("a:b:c", None),
        ("", None),
        (None, None),
    ],
)
def test_p10_hms(spark, text, seconds):
    assert one(spark, clock.hms_to_seconds("c"), c=text) == seconds


@settings(max_examples=3, deadline=None)
@given(st.lists(st.integers(0, 200 * 3600), min_size=50, max_size=200))
def test_p10_round_trip(spark, values):
    rows = [(v, f"{v // 3600:02d}:{v // 60 % 60:02d}:{v % 60:02d}") for v in values]
    df = spark.createDataFrame(rows, "v int, t string")
    assert df.filter(clock.hms_to_seconds("t") != F.col("v")).isEmpty()


@pytest.mark.parametrize(
    "text,at", [("86400", dt.datetime(1970, 1, 2)), ("soon", None), ("", None), (None, None), ("86400.7", dt.datetime(1970, 1, 2))]
)
def test_p9_epoch(spark, text, at):
    assert one(spark, cleaning.as_col(clock.epoch_to_ts("c")).cast("timestamp_ntz"), c=text) == at


@pytest.mark.parametrize(
    "date,seconds,anchor,local",
    [
        (dt.date(2025, 7, 15), 90060, "midnight", "2025-07-16 01:01:00"),
        (dt.date(2025, 3, 9), 28800, "midnight", "2025-03-09 09:00:00"),
        (dt.date(2025, 3, 9), 28800, "noon", "2025-03-09 08:00:00"),
        (dt.date(2025, 11, 2), 28800, "midnight", "2025-11-02 07:00:00"),
        (dt.date(2025, 11, 2), 28800, "noon", "2025-11-02 08:00:00"),
    ],
)
@pytest.mark.parametrize("session_zone", ["UTC", "Asia/Tokyo"])
def test_p11_schedule_does_not_depend_on_the_session_zone(spark, date, seconds, anchor, local, session_zone):
    tz = "America/New_York"
    spark.conf.set("spark.sql.session.timeZone", session_zone)
    try:
        epoch = one(spark, F.unix_seconds(clock.scheduled_ts("d", "s", tz, anchor)), d=date, s=seconds)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    from zoneinfo import ZoneInfo

    assert str(dt.datetime.fromtimestamp(epoch, ZoneInfo(tz)).replace(tzinfo=None)) == local


def test_p11_bad_anchor():
    with pytest.raises(ValueError):
        clock.service_midnight(F.lit(None), "UTC", "dawn")


@pytest.mark.parametrize(
    "trip,borough",
    [
        ("EN_C5-Weekday-031300_SBS82_903", "Brooklyn"),
        ("43206923-JKPC5-JK_C5-Weekday-03", "Brooklyn"),
        ("QVH_C5-X", "Manhattan"),
        ("CSg_C5-1", "Unknown"),
        ("xx", "Unknown"),
        ("ZZ_C5", "Unknown"),
        (None, "Unknown"),
    ],
)
def test_p12_p13_depot(spark, trip, borough):
    assert one(spark, depots.depot_borough("t"), t=trip) == borough


def test_p13_all_reachable_codes(spark):
    rows = [(f"{c}_x", b) for c, b in depots.DEPOT_BOROUGH.items() if c.isupper()]
    df = spark.createDataFrame(rows, "t string, b string")
    assert len(rows) == 30
    assert df.filter(depots.depot_borough("t") != F.col("b")).isEmpty()


def test_p14_p15_p16(spark):
    same = one(spark, geo.haversine_m("x", "y", "x", "y"), x=-74.0, y=40.7)
    assert same == 0.0
    degree = one(spark, geo.haversine_m(F.lit(0.0), F.lit(0.0), F.lit(0.0), "y"), y=1.0)
    assert degree == pytest.approx(math.pi / 180 * 6371000)
    null = F.lit(None).cast("double")
    assert one(spark, geo.haversine_m("x", null, "x", "x"), x=1.0) is None
    for d, status in [(99.9, "arrived"), (100.0, "arrived"), (100.1, "on_way")]:
        assert one(spark, geo.arrival_status("d"), d=d) == status
    assert one(spark, geo.arrival_status(null), d=1.0) == "on_way"
    at = dt.datetime(2024, 1, 1, 0, 0, 10)
    assert one(spark, geo.delay_seconds(F.lit("arrived"), "a", F.col("a") - F.expr("INTERVAL 7 SECONDS")), a=at) == 7
    assert one(spark, geo.delay_seconds(F.lit("on_way"), "a", "a"), a=at) is None


def test_p17_p23_distinct_and_patch(spark):
    df = spark.createDataFrame([(1, None, None), (2, "a", None), (3, "a", "a"), (4, "a", "b")], "k int, x string, y string")
    differs = cleaning.any_distinct({"x": F.col("x")}, {"x": F.col("y")})
    assert [r.k for r in df.filter(differs).orderBy("k").collect()] == [2, 4]
    patched = cleaning.patch(df, F.col("x").isNull(), {"x": F.lit("z")})
    assert [r.x for r in patched.orderBy("k").collect()] == ["z", "a", "a", "a"]


def test_p18_weekday_and_range(spark):
    names = ", ".join(f"{d} int" for d in clock.WEEKDAYS)
    monday = dt.date(2024, 1, 1)
    rows = [tuple(int(i == j) for j in range(7)) + (monday, monday + dt.timedelta(6)) for i in range(7)]
    df = spark.createDataFrame(rows, f"{names}, start_date date, end_date date")
    for i in range(7):
        hit = df.filter(clock.runs_on(monday + dt.timedelta(i))).collect()
        assert len(hit) == 1 and hit[0][i] == 1
    assert df.filter(clock.runs_on(monday + dt.timedelta(7))).isEmpty()
    assert df.filter(clock.runs_on(monday - dt.timedelta(1))).isEmpty()


def test_p21_p22(spark):
    assert one(spark, cleaning.fill_unknown("c"), c=None) == "Unknown"
    assert one(spark, cleaning.version_text("c"), c="2025-07-15 (latest)") == "2025-07-15"

"""Multi-layout timestamp parsing."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from viewstar.operators import quality as qa

LAYOUTS = ["%Y-%m-%d %H:%M:%S", "%d-%m-%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%d/%m/%Y %H:%M:%S",
           "%Y-%m-%dT%H:%M:%S"]


def parse(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    return [r[0] for r in qa.normalise_timestamps(df, ["s"]).collect()]


def test_each_layout_gives_same_time(spark):
    when = dt.datetime(2024, 7, 9, 13, 5, 59)
    assert parse(spark, [when.strftime(f) for f in LAYOUTS]) == [when] * len(LAYOUTS)


def test_bad_texts_become_null(spark):
    bad = ["2024-13-01 10:00:00", "not-a-date", "2024-02-31 10:00:00", None, "2024-1-01 10:00:00",
           "2024-01-01 10:00", "2024-13-01T10:00:00", "2024-01-01T24:00:00", " 2024-01-01 10:00:00"]
    assert parse(spark, bad) == [None] * len(bad)


def test_result_is_zone_free(spark):
    # A wall-clock time in a DST gap stays as written, whatever the session zone.
    prior = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        out = parse(spark, ["2024-03-10 02:30:00"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", prior)
    assert out == [dt.datetime(2024, 3, 10, 2, 30)]
    df = spark.createDataFrame([("2024-01-01 00:00:00",)], "s string")
    assert dict(qa.normalise_timestamps(df, ["s"]).dtypes)["s"] == "timestamp_ntz"


def test_typed_column_with_fraction_becomes_null(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-01-01 10:00:00.123' a, TIMESTAMP_NTZ'2023-01-01 10:00:00' b")
    row = qa.normalise_timestamps(df, ["a", "b"]).first()
    assert row["a"] is None and row["b"] == dt.datetime(2023, 1, 1, 10)
    kept = qa.normalise_timestamps(df, ["a"], keep_fraction=True).first()
    assert kept["a"] == dt.datetime(2023, 1, 1, 10)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(1000, 1, 1), max_value=dt.datetime(9999, 12, 31)),
                min_size=1, max_size=40))
def test_round_trip_any_time(spark, times):
    times = [t.replace(microsecond=0) for t in times]
    texts = [t.strftime(LAYOUTS[i % len(LAYOUTS)]) for i, t in enumerate(times)]
    assert parse(spark, texts) == times


def test_invalid_count(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00",), ("x",), (None,)], "viewed_at string")
    parsed = qa.normalise_timestamps(df, ["viewed_at"])
    assert qa.invalid_timestamp_counts(parsed, ["viewed_at"]).first()[0] == 2
    assert parsed.filter(F.col("viewed_at").isNull()).count() == 2

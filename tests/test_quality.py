"""C4-C12 on tiny literal frames."""

import datetime as dt
import math

from viewstar.operators import quality as qa


def test_drop_all_null_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, None)], "k int, gone string, part string")
    assert qa.drop_all_null_columns(df).columns == ["k", "part"]


def test_empty_table_unchanged(spark):
    df = spark.createDataFrame([], "k int, v string")
    assert qa.drop_all_null_columns(df).columns == ["k", "v"]
    assert qa.any_null(df).first()["has_nulls"] is False


def test_typed_fill_keeps_types(spark):
    ddl = ("s string, ts timestamp_ntz, d date, i int, f float, db double, b boolean, "
           "by tinyint, arr array<int>")
    df = spark.createDataFrame([(None,) * 9, ("x", dt.datetime(2024, 1, 1), dt.date(2024, 1, 1), 1, 1.5,
                                              2.5, True, 1, [1])], ddl)
    filled = qa.fill_nulls(df)
    assert filled.dtypes == df.dtypes
    row = filled.collect()[0]
    assert row["s"] == "Unknown"
    assert row["ts"] == dt.datetime(9999, 12, 31, 23, 59, 59)
    assert row["d"] == dt.date(9999, 12, 31)
    assert (row["i"], row["f"], row["db"], row["by"]) == (0, 0.0, 0.0, 0)
    assert row["b"] is None and row["arr"] is None


def test_null_profile_one_pass(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    row = qa.null_counts(df).first()
    assert (row["total_rows"], row["a"], row["b"]) == (3, 1, 2)
    assert qa.any_null(df).first()["has_nulls"] is True


def test_dedup_is_deterministic(spark):
    rows = [("u", "l", True, "reported"), ("u", "l", False, "contact_agent"), ("u", "l", None, "a")]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "user_id string, apartment_id string, w boolean, c string")
        out = qa.dedup(df.repartition(3), ["user_id", "apartment_id"]).collect()
        assert [tuple(r) for r in out] == [("u", "l", False, "contact_agent")]


def test_dedup_keeps_null_keys_as_one(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert sorted((str(r[0]), r[1]) for r in qa.dedup(df, ["k"]).collect()) == [("None", 1), ("a", 3)]
    rep = qa.duplicate_report(df, ["k"]).first()
    assert (rep["total_rows"], rep["distinct_keys"], rep["has_duplicates"]) == (3, 2, True)


def test_text_to_boolean(spark):
    texts = ["y", "n", "true", "false", "1", "0", "maybe", None]
    df = spark.createDataFrame([(t,) for t in texts], "w string")
    got = [r[0] for r in qa.to_boolean(df, ["w"]).collect()]
    assert got == [True, False, True, False, True, False, None, None]


def test_flag_to_boolean(spark):
    df = spark.createDataFrame([(1,), (0,), (None,)], "a tinyint")
    assert [r[0] for r in qa.to_boolean(df, ["a"]).collect()] == [True, False, None]


def test_nan_to_null(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, None)], "a double, b float")
    rows = qa.nan_to_null(df).collect()
    assert rows[0]["a"] is None and rows[0]["b"] == 1.0 and rows[1]["a"] == 2.0
    assert not any(isinstance(v, float) and math.isnan(v) for r in rows for v in r)


def test_cleaning_is_idempotent(spark):
    from conftest import SF_TINY
    from viewstar.sources import fixtures as fx
    once = qa.clean_viewings(fx.raw_viewings(spark, SF_TINY))
    twice = qa.clean_viewings(once.withColumn("is_wishlisted", once["is_wishlisted"].cast("string")))
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_all_null_probe_then_exact_count(spark):
    # 'late' has its only value past the probe: the full count must keep it.
    rows = [(i, None, "x" if i == 49 else None) for i in range(50)]
    df = spark.createDataFrame(rows, "k int, dead string, late string").repartition(4, "k")
    assert qa.all_null_columns(df, probe_rows=5) == ["dead"]
    assert qa.all_null_columns(df, probe_rows=500) == ["dead"]
    assert qa.all_null_columns(df.filter("k < 0"), probe_rows=5) == []

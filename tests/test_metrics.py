"""Rates, ranking, joins and time parts on tiny frames."""

import datetime as dt

from pyspark.sql import functions as F

from viewstar.functions.calendar import is_weekend
from viewstar.operators.engagement import engagement, with_engagement_rate
from viewstar.operators.joins import broadcast_if_small, measured_size
from viewstar.operators.ranking import mode_of, top_list, top_n
from viewstar.plans import kpis


def cube_rows(spark, rows):
    return spark.createDataFrame(rows, "view_hour int, apartment_id string, source string, views long, "
                                       "wishlists long, contacts long")


def test_engagement_rate_null_without_contacts(spark):
    c = cube_rows(spark, [(1, "a", "x", 3, 0, 0), (2, "a", "x", 2, 0, 1), (2, "b", "x", 1, 0, 0)])
    rates = {r["view_hour"]: r["engagement_rate"]
             for r in with_engagement_rate(engagement(c, ["view_hour"])).collect()}
    assert rates == {1: None, 2: 33.33}


def test_ties_take_smallest_ids_in_order(spark):
    c = cube_rows(spark, [(0, i, "x", 5, 0, 0) for i in ("40", "10", "30", "20")])
    views = c.groupBy("view_hour", "apartment_id").agg(F.sum("views").alias("total_views"))
    top = top_list(views, ["view_hour"], "apartment_id", 3, "top").first()["top"]
    assert top == "10, 20, 30"


def test_top_n_plans_partial_group_limit(spark):
    c = cube_rows(spark, [(h, str(i), "x", i, 0, 0) for h in range(3) for i in range(20)])
    views = c.groupBy("view_hour", "apartment_id").agg(F.sum("views").alias("total_views"))
    ranked = top_n(views, ["view_hour"], "apartment_id", 3)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert sorted(r["row_num"] for r in ranked.collect()) == [1, 1, 1, 2, 2, 2, 3, 3, 3]


def test_null_state_gets_null_platform(spark):
    cube = spark.createDataFrame(
        [(None, "c1", "web", 1, 0, 0, 1, True, 10), ("S", "c1", "app", 2, 1, 1, 1, True, 20)],
        "state string, cityname string, source string, views long, wishlists long, contacts long, "
        "dummy int, is_active boolean, price int")
    out = {r["state"]: r["source"] for r in kpis.state_city(cube).collect()}
    assert out == {None: None, "S": "app"}


def test_mode_counts_null_item(spark):
    c = cube_rows(spark, [(0, "a", None, 5, 0, 0), (0, "b", "web", 3, 0, 0)])
    views = c.groupBy("view_hour", "source").agg(F.sum("views").alias("total_views"))
    assert mode_of(views, ["view_hour"], "source").first()["source"] is None


def test_weekend_flag(spark):
    days = [dt.datetime(2024, 6, 1), dt.datetime(2024, 6, 2), dt.datetime(2024, 5, 31), None]
    df = spark.createDataFrame([(d,) for d in days], "t timestamp_ntz")
    assert [r[0] for r in df.select(is_weekend(F.col("t"))).collect()] == [True, True, False, False]


def test_broadcast_only_under_budget(spark):
    small = spark.range(100)
    rows, size = measured_size(small, 1 << 20)
    assert rows == 100 and size >= 800
    assert measured_size(small, 100) is None
    big = spark.range(10_000_000)
    assert measured_size(big, 1 << 10) is None
    fact = spark.range(1000).withColumn("k", F.col("id") % 100)
    plan = fact.join(broadcast_if_small(small.withColumnRenamed("id", "k")), "k", "left")
    assert "broadcast" in plan._jdf.queryExecution().optimizedPlan().toString().lower()


def test_salted_join_equals_plain_join(spark):
    from viewstar.operators.joins import salted_left_join
    # one key holds a third of the rows, one key has no dimension row
    keys = ["hot"] * 300 + [f"k{i % 50}" for i in range(500)] + ["none"] * 100
    fact = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "row long, key string")
    dim = spark.createDataFrame([("hot", "H")] + [(f"k{i}", f"V{i}") for i in range(50)], "id string, v string")
    counts = fact.groupBy("key").agg(F.count("*").alias("rows"))
    salted = salted_left_join(fact, dim, "key", "id", counts, partitions=8)
    plain = fact.join(dim, fact["key"] == dim["id"], "left")
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    assert salted.count() == 900
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "_fact_salt" in plan and "xxhash64" in plan


def test_salted_join_spreads_identical_copies(spark):
    """A hot key made of identical rows, over several input splits: joined
    rows equal the plain join, and the copies reach more than one task."""
    from viewstar.operators.joins import salted_left_join
    fact = spark.createDataFrame([("hot", 1)] * 400 + [(f"k{i}", 2) for i in range(400)],
                                 "key string, x int").repartition(8)
    dim = spark.createDataFrame([("hot", "H")], "id string, v string")
    counts = fact.groupBy("key").agg(F.count("*").alias("rows"))
    salted = salted_left_join(fact, dim, "key", "id", counts, partitions=8)
    plain = fact.join(dim, fact["key"] == dim["id"], "left")
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0
    # A shuffle join, not coalesced, so the task of a row is its salt's hash partition.
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        hot = salted.filter("key = 'hot'").select(F.spark_partition_id().alias("p"))
        assert hot.distinct().count() > 1
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_leaders_in_one_pass_equal_joined_branches(spark):
    """summary_with_leaders == triple, mode and top list built apart and joined
    with equality (null keys get null leaders), on ties and null items."""
    from viewstar.operators.engagement import triple, views_by
    from viewstar.operators.ranking import summary_with_leaders
    rows = [(h, a, s, v, v // 2, v % 3) for h, a, s, v in [
        (0, "10", "x", 5), (0, "20", "y", 5), (0, "30", None, 5), (0, "40", "y", 1),
        (1, "10", None, 7), (1, "20", "x", 2), (1, "20", "y", 2),
        (None, "50", "x", 4), (None, "60", "y", 9), (2, "70", "z", 1)]]
    c = spark.createDataFrame(rows, "view_hour int, apartment_id string, source string, views long, "
                                    "wishlists long, contacts long")
    keys = ["view_hour"]
    one_pass = summary_with_leaders(c, keys, triple(), [("source", 1, "platform"),
                                                        ("apartment_id", 3, "top")])
    joined = (engagement(c, keys)
              .join(mode_of(views_by(c, keys, "source"), keys, "source", "platform"),
                    keys, "left")
              .join(top_list(views_by(c, keys, "apartment_id"), keys, "apartment_id", 3, "top"),
                    keys, "left"))
    cols = ["view_hour", "total_views", "total_wishlists", "total_contact_agent", "platform", "top"]
    got = sorted(one_pass.select(*cols).collect(), key=lambda r: (r[0] is None, r[0]))
    want = sorted(joined.select(*cols).collect(), key=lambda r: (r[0] is None, r[0]))
    assert got == want
    assert got[0]["platform"] == "y" and got[0]["top"] == "10, 20, 30"
    assert got[-1]["view_hour"] is None and got[-1]["platform"] is None and got[-1]["top"] is None


def test_display_order_calendar_hour(spark):
    rows = [(2024, 5, 3, 1), (2024, 6, 1, 2), (2024, 6, 1, 0), (2023, 12, 31, 23)]
    df = spark.createDataFrame(rows, "view_year int, view_month int, view_day int, view_hour int")
    got = [tuple(r) for r in kpis.for_display(df, "calendar_hour").collect()]
    assert got == [(2024, 6, 1, 0), (2024, 6, 1, 2), (2024, 5, 3, 1), (2023, 12, 31, 23)]


def test_display_order_is_the_sinks_order(spark):
    from viewstar.plans import kpis
    rows = [(2024, 5, 2, 3), (2025, 1, 1, 0), (2024, 6, 1, 9), (2024, 6, 1, 2), (2024, 6, 3, 1)]
    df = spark.createDataFrame(rows, "view_year int, view_month int, view_day int, view_hour int")
    got = [tuple(r) for r in kpis.for_display(df.repartition(4), "calendar_hour").collect()]
    assert got == [(2025, 1, 1, 0), (2024, 6, 1, 2), (2024, 6, 1, 9), (2024, 6, 3, 1), (2024, 5, 2, 3)]
    hours = spark.createDataFrame([(h,) for h in (5, 1, 23, 0)], "view_hour int")
    assert [r[0] for r in kpis.for_display(hours.repartition(3), "hour_summary").collect()] == [0, 1, 5, 23]


def test_rank_runs_after_the_limit(spark):
    from viewstar.operators.ranking import ranked_with_ties
    df = spark.createDataFrame([("a", str(i), i % 7) for i in range(50)], "k string, item string, total_views long")
    plan = ranked_with_ties(df, ["k"], "item", 3)._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = lambda text: next(i for i, x in enumerate(lines) if text in x)
    assert at("rank(total_views") < at("WindowGroupLimit")
    got = [tuple(r) for r in ranked_with_ties(df, ["k"], "item", 3).orderBy("row_num").select("item", "rank", "row_num").collect()]
    assert got == [("13", 1, 1), ("20", 1, 2), ("27", 1, 3)]


def test_size_measure_is_an_upper_bound_or_none(spark):
    from viewstar.operators.joins import measured_size
    assert measured_size(spark.range(3).selectExpr("sequence(0, 1000) AS a"), 1 << 30) is None
    rows, size = measured_size(spark.range(10), 1 << 20)
    assert rows == 10 and size >= 160

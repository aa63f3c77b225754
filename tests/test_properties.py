"""Properties of the KPI tables over the tiny test tables."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_TINY
from viewstar.plans import kpis
from viewstar.plans import registry as r


@pytest.fixture(scope="module")
def cube(spark):
    return r.cube(spark, SF_TINY).cache()


@pytest.fixture(scope="module")
def fact_rows(spark):
    return r.clean_viewings(spark, SF_TINY).count()


def total(df, col="total_views"):
    return df.agg(F.sum(col)).first()[0]


def test_views_add_up_everywhere(cube, fact_rows):
    for table in (kpis.hour_summary(cube), kpis.day_of_month_summary(cube), kpis.calendar_hour(cube),
                  kpis.daily(cube), kpis.platform(cube)):
        assert total(table) == fact_rows


def test_counts_bounded_by_views(cube):
    for table in (kpis.hour_summary(cube), kpis.platform(cube)):
        assert table.filter("total_wishlists > total_views OR total_contact_agent > total_views").count() == 0


def test_ranks_run_one_to_k(cube):
    ranks = kpis.state_city(cube).groupBy("state").agg(F.collect_list("rank_city").alias("r")).collect()
    for row in ranks:
        assert sorted(row["r"]) == list(range(1, len(row["r"]) + 1)) and len(row["r"]) <= 5


def test_top_lists_hold_at_most_three(cube):
    for table in (kpis.hour_summary(cube), kpis.platform(cube)):
        for row in table.select("top_apartments").collect():
            assert row[0] is None or 1 <= len(row[0].split(", ")) <= 3


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.columns == ["view_hour", "total_views", "total_wishlists", "total_contact_agent",
                          "most_viewed_platform", "top_apartments", "engagement_rate"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    from oracle.sql import ORACLE_SQL
    from viewstar.plans.registry import _all_queries
    assert set(_all_queries()) == set(ORACLE_SQL)


def _brute_leaders(rows, n_top):
    """Plain-Python reference: per hour, the triple, the most viewed source and
    the top listings; ties to the smaller item, null items last; a null hour
    gets null leaders."""
    out = {}
    for hour in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == hour]
        tot = tuple(sum(r[i] for r in mine) for i in (3, 4, 5))
        def best(idx, k):
            views = {}
            for r in mine:
                views[r[idx]] = views.get(r[idx], 0) + r[3]
            order = sorted(views, key=lambda it: (-views[it], it is None, it or ""))
            return order[:k]
        src = best(2, 1)[0]
        top = ", ".join(x for x in best(1, n_top) if x is not None)
        out[hour] = (*tot, src if hour is not None else None, top if hour is not None else None)
    return out


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([None, 0, 1, 2]), st.sampled_from([None, "a1", "a2", "b1", "b2"]),
                          st.sampled_from([None, "web", "app"]), st.integers(1, 4),
                          st.integers(0, 2), st.integers(0, 2)), min_size=1, max_size=25))
def test_leaders_match_brute_force(spark, rows):
    from viewstar.operators.engagement import triple
    from viewstar.operators.ranking import summary_with_leaders
    df = spark.createDataFrame(rows, "view_hour int, apartment_id string, source string, views long, "
                                     "wishlists long, contacts long")
    got = summary_with_leaders(df, ["view_hour"], triple(),
                               [("source", 1, "src"), ("apartment_id", 3, "top")]).collect()
    got = {r["view_hour"]: (r["total_views"], r["total_wishlists"], r["total_contact_agent"],
                            r["src"], r["top"]) for r in got}
    assert got == _brute_leaders(rows, 3)


def test_each_kpi_reads_the_cube_once(spark, cube):
    """One scan of a written cube per KPI, ranking with a partial
    WindowGroupLimit: the branches of a KPI are not recomputed."""
    from viewstar import scratch_path
    path = scratch_path(spark, "t_cube_plan")
    cube.write.parquet(path)
    stored = spark.read.parquet(path)
    for name, build in kpis.KPIS.items():
        plan = build(stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1, name
        assert "Expand" in plan, name
        if name in ("hour_summary", "dayofmonth_summary", "platform", "state"):
            assert "WindowGroupLimit" in plan, name

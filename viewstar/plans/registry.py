"""Every registered query: (spark, sf_dir) -> DataFrame.

Each one starts from the shared test tables through the fixture rules
(``viewstar.sources.fixtures``), so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.operators import quality as qa
from viewstar.operators.engagement import (engagement, fact_cube, price_stats, row_triple, triple,
                                           views_by, with_engagement_rate, with_rates)
from viewstar.operators.ranking import mode_of, ranked_with_ties, top_list, top_n
from viewstar.plans import kpis, model
from viewstar.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

HOUR = ["view_hour"]
DAY = ["view_day"]
CAL_HOUR = list(schemas.CALENDAR_HOUR_KEYS)
CITY = ["state", "cityname"]


# -- shared chains ---------------------------------------------------------------
def parsed_viewings(spark, sf):
    return qa.to_boolean(qa.normalise_timestamps(fx.raw_viewings(spark, sf), ["viewed_at"]),
                         ["is_wishlisted"])


def typed_apartments(spark, sf):
    raw = fx.raw_apartments(spark, sf)
    return qa.to_boolean(qa.normalise_timestamps(raw, ["listing_created_on", "last_modified_timestamp"]),
                         ["is_active"])


def clean_viewings(spark, sf, keys=schemas.VIEWING_KEY):
    return qa.clean_viewings(fx.raw_viewings(spark, sf), keys)


def clean_apartments(spark, sf):
    return qa.clean_apartments(fx.raw_apartments(spark, sf))


def clean_attributes(spark, sf):
    return qa.clean_attributes(fx.raw_attributes(spark, sf))


def listing(spark, sf):
    """Join sizes are left to AQE, so building the plan starts no size-measuring job."""
    return model.listing_dim(clean_apartments(spark, sf), clean_attributes(spark, sf), None)


def cube_listing(spark, sf):
    """The listing for the cube's five columns: a column null throughout needs no probe there."""
    return model.listing_dim(qa.clean_apartments(fx.raw_apartments(spark, sf), drop_all_null=False),
                             qa.clean_attributes(fx.raw_attributes(spark, sf), drop_all_null=False), None)


def viewings(spark, sf):
    """Clean viewings with every declared column (no all-null probe)."""
    return qa.clean_viewings(fx.raw_viewings(spark, sf), drop_all_null=False)


def wide(spark, sf):
    fact = clean_viewings(spark, sf)
    return model.full_detail(fact, listing(spark, sf), cube=fact_cube(viewings(spark, sf)))


def time_cube(spark, sf):
    """The cube without listing columns, for groups that need none: the listing tables are not touched."""
    return fact_cube(viewings(spark, sf))


def cube(spark, sf):
    return model.engagement_cube(viewings(spark, sf), cube_listing(spark, sf), None)


def large_cube(spark, sf):
    return model.engagement_cube(qa.clean_viewings(fx.large_viewings(spark, sf), drop_all_null=False),
                                 cube_listing(spark, sf), None)


# -- query builders ----------------------------------------------------------------
def _on_cube(fn, of=cube) -> Query:
    return lambda spark, sf: fn(of(spark, sf))


def _views(keys, item, of=cube) -> Query:
    return _on_cube(lambda c: views_by(c, keys, item), of)


def _mode(keys, out) -> Query:
    return _on_cube(lambda c: mode_of(views_by(c, keys, "source"), keys, "source", out))


def _top3(keys, of=cube) -> Query:
    return _on_cube(lambda c: top_list(views_by(c, keys, "apartment_id"), keys, "apartment_id", 3,
                                       "top_apartments"), of)


def _rate(keys) -> Query:
    return _on_cube(lambda c: with_engagement_rate(engagement(c, keys)).select(*keys, "engagement_rate"), time_cube)


def _nan_attributes(spark, sf):
    raw = fx.raw_attributes(spark, sf)
    nan = F.when(F.col("id").cast("bigint") % 37 == 0, F.lit(float("nan")).cast("float"))
    return qa.nan_to_null(raw.withColumn("bathrooms", F.coalesce(nan, F.col("bathrooms"))))


def _dedup_listings(spark, sf):
    filled = qa.handle_nulls(typed_apartments(spark, sf))
    variants = filled.filter(F.col("id").cast("bigint") % 10 == 0).withColumn("title", F.upper("title"))
    return qa.dedup(filled.unionByName(variants), schemas.LISTING_KEY)


def _listing_rank(spark, sf):
    c = time_cube(spark, sf)
    return ranked_with_ties(views_by(c, HOUR, "apartment_id"), HOUR, "apartment_id", 3) \
        .select("view_hour", "apartment_id", "total_views", "rank", "row_num")


def _top5_cities(spark, sf):
    c = cube(spark, sf)
    return top_n(views_by(c, ["state"], "cityname"), ["state"], "cityname", 5, rank_col="rank_city") \
        .select("state", "cityname", "total_views", "rank_city")


QUERIES: dict[str, Query] = {
    # cleaning (C1-C12)
    "normalise_timestamps": lambda s, sf: qa.normalise_timestamps(fx.raw_viewings(s, sf), ["viewed_at"]),
    "invalid_timestamp_count": lambda s, sf: qa.invalid_timestamp_counts(parsed_viewings(s, sf),
                                                                          ["viewed_at"]),
    "normalise_typed_timestamps": lambda s, sf: qa.normalise_timestamps(
        fx.raw_apartments(s, sf), ["listing_created_on", "last_modified_timestamp"]),
    "null_profile": lambda s, sf: qa.null_counts(parsed_viewings(s, sf)),
    "any_null": lambda s, sf: qa.any_null(parsed_viewings(s, sf)),
    "drop_all_null_columns": lambda s, sf: qa.drop_all_null_columns(fx.raw_attributes(s, sf)),
    "fill_nulls": lambda s, sf: qa.fill_nulls(typed_apartments(s, sf)),
    "nan_to_null": _nan_attributes,
    "duplicate_report": lambda s, sf: qa.duplicate_report(qa.handle_nulls(parsed_viewings(s, sf)),
                                                          schemas.VIEWING_KEY),
    "dedup_viewings": lambda s, sf: qa.dedup(qa.handle_nulls(parsed_viewings(s, sf)), schemas.VIEWING_KEY),
    "dedup_viewings_two_key": lambda s, sf: clean_viewings(s, sf, schemas.VIEWING_KEY_TWO),
    "dedup_listings": _dedup_listings,
    "to_boolean": lambda s, sf: qa.to_boolean(fx.raw_viewings(s, sf), ["is_wishlisted"]),
    "clean_viewings": clean_viewings,
    "clean_listings": clean_apartments,
    "clean_attributes": clean_attributes,
    # star model
    "listing_dim": listing,
    "full_detail": wide,
    "time_parts": lambda s, sf: model.with_time_parts(clean_viewings(s, sf)).drop("is_weekend"),
    "weekend_split": _on_cube(kpis.weekend_split, time_cube),
    # aggregates
    "engagement_by_listing": lambda s, sf: viewings(s, sf).groupBy("apartment_id").agg(*row_triple()),
    "engagement_by_hour": _on_cube(lambda c: engagement(c, HOUR), time_cube),
    "engagement_by_day": _on_cube(lambda c: engagement(c, DAY), time_cube),
    "engagement_by_calendar_hour": _on_cube(lambda c: engagement(c, CAL_HOUR), time_cube),
    "engagement_by_city": _on_cube(lambda c: with_rates(c.groupBy(*CITY).agg(*triple(), *price_stats()))),
    "engagement_by_platform": _on_cube(
        lambda c: with_rates(c.groupBy("source").agg(*triple(), *price_stats(non_active=True)))),
    "engagement_rate_by_hour": _rate(HOUR),
    "engagement_rate_by_day": _rate(DAY),
    "engagement_rate_by_calendar_hour": _rate(CAL_HOUR),
    "platform_views_by_hour": _views(HOUR, "source"),
    "listing_views_by_hour": _views(HOUR, "apartment_id", time_cube),
    "platform_views_by_day": _views(DAY, "source"),
    "listing_views_by_day": _views(DAY, "apartment_id", time_cube),
    "platform_views_by_city": _views(CITY, "source"),
    "listing_views_by_platform": _views(["source"], "apartment_id"),
    "platform_views_by_calendar_hour": _views(CAL_HOUR, "source"),
    # ranking (W1-W8, A10)
    "top_platform_by_hour": _mode(HOUR, "most_viewed_platform"),
    "top_platform_by_day": _mode(DAY, "most_viewed_platform"),
    "top_platform_by_city": _mode(CITY, "source"),
    "top_platform_by_calendar_hour": _mode(CAL_HOUR, "most_viewed_platform"),
    "top3_listings_by_hour": _top3(HOUR, time_cube),
    "top3_listings_by_day": _top3(DAY, time_cube),
    "top3_listings_by_platform": _top3(["source"]),
    "listing_rank_by_hour": _listing_rank,
    "top5_cities_by_state": _top5_cities,
    # KPI tables (Q1-Q7)
    "kpi_apartment_performance": lambda s, sf: kpis.apartment_performance(
        time_cube(s, sf), listing(s, sf)),
    "kpi_hour_summary": _on_cube(kpis.hour_summary),
    "kpi_calendar_hour": _on_cube(kpis.calendar_hour),
    "kpi_day_of_month": _on_cube(kpis.day_of_month_summary),
    "kpi_state_city": _on_cube(kpis.state_city),
    "kpi_platform": _on_cube(kpis.platform),
    "kpi_daily": _on_cube(kpis.daily),
    "kpi_hour_summary_lineitem": lambda s, sf: kpis.hour_summary(large_cube(s, sf)),
    "kpi_platform_lineitem": lambda s, sf: kpis.platform(large_cube(s, sf)),
}


def _all_queries() -> dict[str, Query]:
    from viewstar.plans.history_queries import HISTORY_QUERIES
    from viewstar.plans.io_queries import IO_QUERIES
    from viewstar.plans.job_queries import JOB_QUERIES
    from viewstar.plans.stream_queries import STREAM_QUERIES
    return {**QUERIES, **IO_QUERIES, **STREAM_QUERIES, **JOB_QUERIES, **HISTORY_QUERIES}

"""The KPI tables (Q1-Q7) as pure functions of the engagement cube."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.functions.calendar import is_weekend
from viewstar.operators.engagement import (engagement, price_stats, triple, with_engagement_rate,
                                           with_rates)
from viewstar.operators.ranking import summary_with_leaders, top_n

TRIPLE = ("total_views", "total_wishlists", "total_contact_agent")


def apartment_performance(cube: DataFrame, listing: DataFrame) -> DataFrame:
    """Q1: every listing with its engagement; unviewed listings get null totals."""
    per_listing = engagement(cube, ["apartment_id"]).withColumnRenamed("apartment_id", "_viewed_id")
    joined = listing.join(per_listing, listing["id"] == per_listing["_viewed_id"], "left")
    perf = joined.withColumnRenamed("id", "apartment_id")
    return perf.select(*[c for c in schemas.APARTMENT_PERFORMANCE_COLUMNS if c in perf.columns])


def time_summary(cube: DataFrame, keys: Sequence[str], top_k: int | None = 3) -> DataFrame:
    """Q2 / Q3 / Q4 / Q7: the triple, top platform, top listings and rate per time group."""
    keys = list(keys)
    leaders = [("source", 1, "most_viewed_platform")]
    cols = [*keys, *TRIPLE, "most_viewed_platform"]
    if top_k:
        leaders.append(("apartment_id", top_k, "top_apartments"))
        cols.append("top_apartments")
    out = summary_with_leaders(cube, keys, triple(), leaders)
    return with_engagement_rate(out).select(*cols, "engagement_rate")


def hour_summary(cube: DataFrame) -> DataFrame:
    """Q2: per hour of day, across all days."""
    return time_summary(cube, ["view_hour"])


def day_of_month_summary(cube: DataFrame) -> DataFrame:
    """Q4: per day of month, across months and years."""
    return time_summary(cube, ["view_day"])


def calendar_hour(cube: DataFrame) -> DataFrame:
    """Q3: per calendar hour (year, month, day, hour); no top list."""
    return time_summary(cube, schemas.CALENDAR_HOUR_KEYS, top_k=None)


def daily(cube: DataFrame) -> DataFrame:
    """Q7: per calendar day; Q3 without the hour."""
    return time_summary(cube, schemas.CALENDAR_DAY_KEYS, top_k=None)


def state_city(cube: DataFrame, top_cities: int = 5) -> DataFrame:
    """Q5: the 5 most viewed cities per state, with their top platform."""
    keys = ["state", "cityname"]
    base = summary_with_leaders(cube, keys, [*triple(), *price_stats()], [("source", 1, "source")])
    ranked = top_n(with_rates(base), ["state"], "cityname", top_cities, rank_col="rank_city")
    return ranked.select(
        *keys, *TRIPLE, "min_price", "max_price", "total_active_apartment", "avg_price",
        "wishlist_rate", "contact_rate", "rank_city", "source")


def platform(cube: DataFrame) -> DataFrame:
    """Q6: per platform (listing source), with its top 3 listings."""
    base = summary_with_leaders(cube, ["source"], [*triple(), *price_stats(non_active=True)],
                                [("apartment_id", 3, "top_apartments")])
    return with_rates(base).select(
        "source", *TRIPLE, "min_price", "max_price", "total_active_apartment",
        F.col("`total_non-active_apartment`"), "avg_price", "wishlist_rate", "contact_rate",
        "top_apartments")


def weekend_split(cube: DataFrame) -> DataFrame:
    """P7 as a rollup: the triple for weekend and for weekday viewings.

    The cube's calendar keys carry each viewing's date, so the flag needs no
    row-level join of the fact with its listing.
    """
    day = F.make_date("view_year", "view_month", "view_day")
    return cube.withColumn("is_weekend", is_weekend(day)).groupBy("is_weekend").agg(*triple())


# Output orders for showing a KPI (O3, O4); never planned under a window.
# (column, descending) pairs, turned into Columns only when a session is up.
DISPLAY_ORDER = {
    "hour_summary": [("view_hour", False)],
    "dayofmonth_summary": [("view_day", False)],
    "calendar_hour": [("view_year", True), ("view_month", True), ("view_day", False),
                      ("view_hour", False)],
    "daily": [("view_year", True), ("view_month", True), ("view_day", False)],
    "state": [("state", False), ("rank_city", False)],
    "platform": [("total_views", True), ("source", False)],
}


def for_display(df: DataFrame, kpi: str) -> DataFrame:
    """A KPI table sorted for output (a range-partitioned sort, at the sink only)."""
    return df.orderBy(*[F.col(c).desc() if desc else F.col(c)
                        for c, desc in DISPLAY_ORDER[kpi]])


KPIS = {
    "hour_summary": hour_summary,
    "calendar_hour": calendar_hour,
    "dayofmonth_summary": day_of_month_summary,
    "state": state_city,
    "platform": platform,
    "daily": daily,
}

"""Engagement aggregates: the views / wishlists / contacts triple and rollups.

Row-level facts are first folded into an *engagement cube*: one row per
(listing, calendar hour) with three counts.  Every KPI is a rollup of the
cube, so the big fact is shuffled once, with map-side combining, instead
of once per group-by.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.functions.calendar import time_parts
from viewstar.functions.rates import engagement_rate, ratio

MEASURES = ("views", "wishlists", "contacts")


def row_counts() -> list[Column]:
    """The triple over row-level viewings."""
    return [
        F.count(F.lit(1)).alias("views"),
        F.count_if(F.col("is_wishlisted")).alias("wishlists"),
        F.count_if(F.col("call_to_action") == schemas.CONTACT_ACTION).alias("contacts"),
    ]


def row_triple() -> list[Column]:
    """The KPI triple straight over row-level viewings."""
    views, wishlists, contacts = row_counts()
    return [views.alias("total_views"), wishlists.alias("total_wishlists"),
            contacts.alias("total_contact_agent")]


def fact_cube(fact: DataFrame, keys: Sequence[str] = ("apartment_id",)) -> DataFrame:
    """Viewings folded to (keys, year, month, day, hour) with the three counts."""
    non_null = not fact.schema["viewed_at"].nullable
    return (fact.withColumns(time_parts(F.col("viewed_at"), non_null))
            .groupBy(*keys, *schemas.CALENDAR_HOUR_KEYS)
            .agg(*row_counts()))


def triple() -> list[Column]:
    """The KPI triple as a rollup of cube counts."""
    return [
        F.sum("views").alias("total_views"),
        F.sum("wishlists").alias("total_wishlists"),
        F.sum("contacts").alias("total_contact_agent"),
    ]


def price_stats(non_active: bool = False) -> list[Column]:
    """Price range, average and views of (non-)active listings, from the cube.

    ``avg_price`` is the view-weighted mean: the mean over viewing rows,
    exact because prices are whole numbers.
    """
    priced = F.col("price").isNotNull()
    out = [
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(F.when(F.col("is_active"), F.col("views")).otherwise(0)).alias("total_active_apartment"),
    ]
    if non_active:
        out.append(F.sum(F.when(~F.col("is_active"), F.col("views")).otherwise(0))
                   .alias("total_non-active_apartment"))
    out.append(F.round(F.sum(F.col("price").cast("bigint") * F.col("views"))
                       / F.sum(F.when(priced, F.col("views"))), 2).alias("avg_price"))
    return out


def with_engagement_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("engagement_rate",
                         engagement_rate(F.col("total_contact_agent"), F.col("total_views")))


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "wishlist_rate": ratio(F.col("total_wishlists"), F.col("total_views")),
        "contact_rate": ratio(F.col("total_contact_agent"), F.col("total_views")),
    })


def engagement(cube: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A1-A4: the triple per group."""
    return cube.groupBy(*keys).agg(*triple())


def views_by(cube: DataFrame, keys: Sequence[str], item: str) -> DataFrame:
    """View count per (group, item)."""
    return cube.groupBy(*keys, item).agg(F.sum("views").alias("total_views"))

"""Star model: listing dimension, wide fact, engagement cube."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.functions.calendar import is_weekend, time_parts
from viewstar.operators.engagement import fact_cube
from viewstar.operators.joins import (DEFAULT_BROADCAST_BYTES, broadcast_if_small, left_join_dim,
                                      left_join_dim_skew_safe)

# Listing columns the KPI rollups need; the cube carries only these.
CUBE_LISTING_COLUMNS = ("source", "state", "cityname", "is_active", "price")


def listing_dim(apartments: DataFrame, attributes: DataFrame,
                max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Apartments LEFT JOIN attributes USING (id)."""
    return apartments.join(broadcast_if_small(attributes, max_broadcast_bytes), "id", "left")


def with_time_parts(df: DataFrame, ts: str = "viewed_at") -> DataFrame:
    """P6 + P7: hour, day of month, month, year and the weekend flag."""
    non_null = not df.schema[ts].nullable
    return df.withColumns({**time_parts(F.col(ts), non_null), "is_weekend": is_weekend(F.col(ts))})


def full_detail(fact: DataFrame, listing: DataFrame,
                max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES,
                cube: DataFrame | None = None) -> DataFrame:
    """Every viewing with its listing and time parts (a row-level join).

    With ``cube`` given, per-listing view counts come from it for free, so a
    listing side too large to broadcast is joined with hot listings salted.
    """
    key_rows = None
    if cube is not None:
        key_rows = cube.groupBy("apartment_id").agg(F.sum("views").alias("rows"))
    joined = left_join_dim_skew_safe(fact, listing, "apartment_id", "id", key_rows, max_broadcast_bytes)
    return with_time_parts(joined.select(*fact.columns, *listing.columns))


def engagement_cube(fact: DataFrame, listing: DataFrame,
                    max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The fact folded per (listing, calendar hour), then given listing columns.

    The join runs on the folded fact: a hot listing id is one row per hour
    by then, and the dimension side carries five narrow columns only.
    """
    return with_listing(fact_cube(fact), listing, max_broadcast_bytes)


def with_listing(cube: DataFrame, listing: DataFrame,
                 max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The listing columns that KPIs group by, joined to a folded fact."""
    dim = listing.select("id", *[c for c in CUBE_LISTING_COLUMNS if c in listing.columns])
    return left_join_dim(cube, dim, "apartment_id", "id", max_broadcast_bytes).drop("id")

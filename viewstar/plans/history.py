"""Work over many run dates: repeats across dates, cubes kept per date, dates chosen by a calendar.

A dated run reads its own date's raw rows only.  What it needs of earlier
dates it takes from tables that earlier runs wrote: the keys of silver
viewings, and one small engagement cube per date.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.operators.engagement import MEASURES
from viewstar.operators.joins import DEFAULT_BROADCAST_BYTES, broadcast_if_small
from viewstar.plans import kpis, model
from viewstar.session import path_exists
from viewstar.sources import readers as rd

CUBE_DDL = ", ".join(["apartment_id STRING", *(f"{k} INT" for k in schemas.CALENDAR_HOUR_KEYS),
                      *(f"{m} LONG" for m in MEASURES)])


# -- C9 across dates -------------------------------------------------------------------
def new_viewings(spark: SparkSession, day: DataFrame, silver_viewings: str, dt: str,
                 keys: Sequence[str] = schemas.VIEWING_KEY) -> DataFrame:
    """Rows of ``day`` (clean, one per key) whose key no earlier date of the silver table holds.

    ``day`` should be a table with a filter on it (as the dated job's staged
    date is): the earlier dates' keys, much the larger side, are then tested
    against a Bloom filter of the day's keys before their shuffle
    (``session.DEFAULT_CONF`` sets its bounds).  Spark builds such filters for
    semi-joins, not for anti-joins; so the day's keys seen before are found
    first, and the anti-join is with those alone.  Keys are unique within a
    date, so no key is hot.  Dates are compared by ``dt``, so a rerun gives
    the same rows.
    """
    if not path_exists(spark, silver_viewings):
        return day
    earlier = rd.read_silver(spark, silver_viewings, schemas.SILVER_VIEWINGS_DDL) \
        .where(F.col("dt") < F.lit(dt).cast("date")).select(*keys)
    seen = earlier.join(day.select(*keys), list(keys), "left_semi")
    return day.join(seen, list(keys), "left_anti").select(*day.columns)


# -- A1-A9, Q1-Q7 over kept cubes --------------------------------------------------------
def read_cubes(spark: SparkSession, silver: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """The cubes of dates first..last (all without bounds) as one: counts are added, so cubes merge in any order."""
    cubes = spark.read.schema(f"{CUBE_DDL}, dt DATE").parquet(f"{silver}/engagement_cube")
    if first:
        cubes = cubes.where(F.col("dt") >= F.lit(first).cast("date"))
    if last:
        cubes = cubes.where(F.col("dt") <= F.lit(last).cast("date"))
    return cubes.groupBy("apartment_id", *schemas.CALENDAR_HOUR_KEYS).agg(*[F.sum(m).alias(m) for m in MEASURES])


def read_listing(spark: SparkSession, silver: str) -> DataFrame:
    apartments = rd.read_silver(spark, f"{silver}/apartments_cleaned", schemas.SILVER_APARTMENTS_DDL, dated=False)
    attributes = rd.read_silver(spark, f"{silver}/apartment_attributes_cleaned", schemas.SILVER_ATTRIBUTES_DDL, dated=False)
    return model.listing_dim(apartments, attributes, None)


def kpi_over_dates(spark: SparkSession, silver: str, kpi: str, first: str | None = None, last: str | None = None,
                   max_broadcast_bytes: int | None = None) -> DataFrame:
    """A KPI over many dates, with the listings as they are now, without reading any viewing."""
    cube, listing = read_cubes(spark, silver, first, last), read_listing(spark, silver)
    if kpi == "apartment_performance":
        return kpis.apartment_performance(cube, listing)
    return kpis.KPIS[kpi](model.with_listing(cube, listing, max_broadcast_bytes))


# -- S2 by a calendar ---------------------------------------------------------------------
def viewings_on(spark: SparkSession, silver: str, calendar: DataFrame, chosen,
                max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Silver viewings of the dates that ``calendar`` (dt, ...) marks by the condition ``chosen`` (a comparison:
    Spark does not take a bare flag for a selective condition, and would read every date).

    The dates are known at run time only; Spark passes them to the scan of the
    viewings (dynamic partition pruning), which opens those dates' folders and
    no other.  The calendar is broadcast when its measured size allows.
    """
    dates = calendar.where(chosen).select("dt").distinct()
    viewings = rd.read_silver(spark, f"{silver}/user_viewings_cleaned", schemas.SILVER_VIEWINGS_DDL)
    return viewings.join(broadcast_if_small(dates, max_broadcast_bytes), "dt").select(*schemas.VIEWING_COLUMNS, "dt")

"""Registered queries over kept tables: repeats across dates, merged cubes, co-located and pruned reads, footers,
quarantine, failed loads and display orders.

Two run dates as in ``job_queries``; where dates overlap, the second date
also brings again the first date's viewings of every user whose id ends in 0.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.operators.ordering import number_rows
from viewstar.plans import colocated, daily_job, history, kpis
from viewstar.plans import registry as r
from viewstar.plans.job_queries import DATES, of_date
from viewstar.session import scratch_path
from viewstar.sinks import writers as w
from viewstar.sources import fixtures as fx
from viewstar.sources import metadata
from viewstar.sources import readers as rd
from viewstar.streaming import jobs, windows
from viewstar.plans.stream_queries import message_ranges


def sent_again(raw: DataFrame) -> DataFrame:
    """Viewings of the first date that come again with the second."""
    return of_date(raw, 0).where(F.col("user_id").cast("bigint") % 10 == 0)


def _silver(spark: SparkSession, sf: str, again: bool = True, **options) -> str:
    silver = scratch_path(spark, "history_silver")
    opts = daily_job.JobOptions(**{"kpis": [], "write_full_detail": False, "write_quality_report": False} | options)
    for k, dt in enumerate(DATES):
        raw = fx.raw_viewings(spark, sf)
        day = of_date(raw, k)
        daily_job.run(spark, day.unionByName(sent_again(raw)) if again and k else day,
                      fx.raw_apartments(spark, sf), fx.raw_attributes(spark, sf), silver, dt, opts)
    return silver


def _database(spark: SparkSession) -> str:
    name = f"viewstar_{uuid.uuid4().hex[:10]}"
    w.create_database(spark, name, scratch_path(spark, "warehouse"))
    return name


def dedup_across_dates(spark: SparkSession, sf: str) -> DataFrame:
    """C9 over all dates: a viewing that comes again on a later date is in silver once."""
    silver = _silver(spark, sf, across_dates=True)
    return rd.read_silver(spark, f"{silver}/user_viewings_cleaned", schemas.SILVER_VIEWINGS_DDL)


def kpi_hour_summary_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Q2 over both dates from their kept cubes."""
    return history.kpi_over_dates(spark, _silver(spark, sf, across_dates=True, write_cube=True), "hour_summary")


def kpi_apartment_performance_merged(spark: SparkSession, sf: str) -> DataFrame:
    """Q1 over both dates from their kept cubes."""
    return history.kpi_over_dates(spark, _silver(spark, sf, across_dates=True, write_cube=True), "apartment_performance")


def dates_from_calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Silver viewings of the run dates that fall on a weekend by a calendar table."""
    silver, path = _silver(spark, sf, again=False), scratch_path(spark, "calendar")
    spark.createDataFrame([(d,) for d in DATES], "dt STRING").select(
        F.col("dt").cast("date").alias("dt"), F.dayofweek(F.col("dt").cast("date")).alias("weekday")) \
        .write.parquet(path)
    return history.viewings_on(spark, silver, spark.read.parquet(path), F.col("weekday").isin(1, 7))


def full_detail_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Q0 from tables bucketed by listing."""
    scratch, database = scratch_path(spark, "colocated"), _database(spark)
    w.write_parquet(r.viewings(spark, sf), f"{scratch}/fact")
    w.write_parquet(r.listing(spark, sf), f"{scratch}/listing")
    hot = colocated.write_colocated(spark, rd.read_parquet(spark, f"{scratch}/fact"),
                                    rd.read_parquet(spark, f"{scratch}/listing"), database, buckets=16)
    return colocated.full_detail(spark, database, hot)


def silver_value_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and values per column and date of the silver viewings, from footers."""
    silver = _silver(spark, sf, again=False)
    return metadata.value_counts(spark, f"{silver}/user_viewings_cleaned", schemas.VIEWING_COLUMNS, "dt")


def message_lines(raw: DataFrame) -> DataFrame:
    """Viewings as message lines; of users whose id ends in 3 broken off, in 5 no JSON, in 7 a JSON list."""
    digit = F.col("user_id").cast("bigint") % 10
    return raw.select(F.when(digit == 3, F.concat(F.lit('{"user_id": "'), "user_id"))
                      .when(digit == 5, F.concat(F.lit("no message "), "user_id"))
                      .when(digit == 7, F.concat(F.lit("["), "user_id", F.lit("]")))
                      .otherwise(F.to_json(F.struct(*schemas.VIEWING_COLUMNS))).alias("value"))


def landing_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Every line lands, viewings and malformed lines apart."""
    source, landing = scratch_path(spark, "lines"), scratch_path(spark, "landing")
    for k, dt in enumerate(DATES):
        message_lines(of_date(fx.raw_viewings(spark, sf), k)).write.text(f"{source}/{dt}")
        jobs.land_lines(spark, f"{source}/*", landing, f"{landing}_checkpoint", dt)
    return jobs.read_landed(spark, landing, None)


def stream_hour_windows(spark: SparkSession, sf: str) -> DataFrame:
    """T3 by event time: ranges of the log out of order, so whole ranges are late."""
    out, ckpt = scratch_path(spark, "windows"), scratch_path(spark, "ckpt_windows")
    for source in message_ranges(spark, sf):
        windows.split_by_lateness(spark, jobs.viewing_stream(spark, source), out, f"{ckpt}/split")
        windows.count_windows(spark, out, f"{ckpt}/windows")
    return windows.read_hour_windows(spark, out)


def kpi_failed_load(spark: SparkSession, sf: str) -> DataFrame:
    """K7: a date loaded, then a load of the same date that fails half-way: the rows loaded first are there."""
    scratch, table = scratch_path(spark, "kpi"), f"{_database(spark)}.kpi_hour_summary"
    w.write_parquet(kpis.hour_summary(r.cube(spark, sf)), scratch)
    summary = rd.read_parquet(spark, scratch)
    w.load_dated_table(spark, summary, table, DATES[0])
    broken = F.when(F.col("view_hour") < 12, F.col("view_hour")).otherwise(F.raise_error(F.lit("broken row")).cast("int"))
    try:
        w.load_dated_table(spark, summary.repartition(4).withColumn("view_hour", broken), table, DATES[0])
    except Exception as error:  # noqa: BLE001
        if "broken row" not in str(error):
            raise
    else:
        raise AssertionError("the load should have failed")
    return spark.table(table)


def _displayed(kpi: str):
    """A KPI with each row's position in its display order."""
    def query(spark: SparkSession, sf: str) -> DataFrame:
        order = [F.col(c).desc_nulls_last() if desc else F.col(c).asc_nulls_last() for c, desc in kpis.DISPLAY_ORDER[kpi]]
        return number_rows(kpis.KPIS[kpi](r.cube(spark, sf)), order, "position", 1)
    return query


HISTORY_QUERIES = {
    "dedup_across_dates": dedup_across_dates,
    "kpi_hour_summary_merged": kpi_hour_summary_merged,
    "kpi_apartment_performance_merged": kpi_apartment_performance_merged,
    "dates_from_calendar": dates_from_calendar,
    "full_detail_bucketed": full_detail_bucketed,
    "silver_value_counts": silver_value_counts,
    "landing_quarantine": landing_quarantine,
    "stream_hour_windows": stream_hour_windows,
    "kpi_failed_load": kpi_failed_load,
    **{f"display_{k}": _displayed(k) for k in kpis.DISPLAY_ORDER},
}

"""Registered queries over the dated job as a whole: landing, silver, KPIs, warehouse, report.

Viewings are dealt to two run dates by their user id, so both dates run over
all rows together and each has every kind of dirt.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.plans import daily_job
from viewstar.session import scratch_path
from viewstar.sinks import writers as w
from viewstar.sources import fixtures as fx
from viewstar.sources import readers as rd
from viewstar.streaming import jobs

DATES = ("2025-06-27", "2025-06-28")


def of_date(raw: DataFrame, k: int) -> DataFrame:
    return raw.where(F.col("user_id").cast("bigint") % len(DATES) == k)


def _landed(spark: SparkSession, sf: str) -> str:
    """Listings as JSON batches; viewings as messages, landed by the stream under their arrival date."""
    landing = scratch_path(spark, "job_landing")
    w.write_json_batches(fx.raw_apartments(spark, sf), f"{landing}/apartments")
    w.write_json_batches(fx.raw_attributes(spark, sf), f"{landing}/apartment_attributes")
    for k, dt in enumerate(DATES):
        of_date(fx.raw_viewings(spark, sf), k).write.json(f"{landing}/messages/{dt}")
        jobs.land_by_date(jobs.viewing_stream(spark, f"{landing}/messages/*"), f"{landing}/user_viewings",
                          f"{landing}/checkpoint", arrival_date=dt)
    return landing


def _silver(spark: SparkSession, sf: str, **options) -> str:
    silver = scratch_path(spark, "job_silver")
    for k, dt in enumerate(DATES):
        daily_job.run(spark, of_date(fx.raw_viewings(spark, sf), k), fx.raw_apartments(spark, sf),
                      fx.raw_attributes(spark, sf), silver, dt, daily_job.JobOptions(**options))
    return silver


def landing_job_hour_summary(spark: SparkSession, sf: str) -> DataFrame:
    """T1 -> dated job for each date -> the hour KPI read from silver."""
    landing, silver = _landed(spark, sf), scratch_path(spark, "job_silver")
    opts = daily_job.JobOptions(write_full_detail=False, kpis=["hour_summary"], write_quality_report=False)
    for dt in DATES:
        daily_job.run_from_landing(spark, landing, silver, dt, opts)
    return rd.read_parquet(spark, f"{silver}/kpi_hour_summary")


def job_silver_viewings(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, write_full_detail=False, kpis=[], write_quality_report=False)
    return rd.read_silver(spark, f"{silver}/user_viewings_cleaned", schemas.SILVER_VIEWINGS_DDL)


def job_full_detail(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, kpis=[], write_quality_report=False)
    return rd.read_silver(spark, f"{silver}/viewings_full_detail", schemas.FULL_DETAIL_DDL)


def job_kpi_state(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, write_full_detail=False, kpis=["state"], write_quality_report=False)
    return rd.read_parquet(spark, f"{silver}/kpi_state")


def job_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    silver = _silver(spark, sf, write_full_detail=False, kpis=[])
    return rd.read_parquet(spark, f"{silver}/quality_report")


def warehouse_load(spark: SparkSession, sf: str) -> DataFrame:
    """Two dates through the job into the warehouse, the second date loaded twice: rows per table and date."""
    silver = _silver(spark, sf, write_quality_report=False)
    database = f"viewstar_{uuid.uuid4().hex[:10]}"
    tables = []
    for dt in (*DATES, DATES[-1]):
        tables = daily_job.load_warehouse(spark, silver, database, dt, scratch_path(spark, "warehouse"))
    counts = None
    for name in sorted(tables):
        table = spark.table(f"{database}.{name}")
        dt = F.col("dt") if "dt" in table.columns else F.lit(None).cast("date")
        one = table.groupBy(dt.alias("dt")).agg(F.count(F.lit(1)).alias("rows")) \
            .select(F.lit(name).alias("table"), "dt", "rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts


JOB_QUERIES = {
    "landing_job_hour_summary": landing_job_hour_summary,
    "job_silver_viewings": job_silver_viewings,
    "job_full_detail": job_full_detail,
    "job_kpi_state": job_kpi_state,
    "job_quality_report": job_quality_report,
    "warehouse_load": warehouse_load,
}

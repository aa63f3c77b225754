"""T3 by event time: hour windows with a watermark, late rows merged exactly.

Two queries.  The *split* sends each batch's rows on: rows whose time is at
most ``delay`` before the latest time seen so far (this batch included) are on
time and go to ``ontime/batch_id=N``; older rows, and rows without a readable
time, go to ``late_rows/batch_id=N`` and are added to the side totals.  The
*windows* query reads the on-time rows as a stream, with the same delay as
its watermark, and keeps one state row per open hour, in update mode.

No row is lost between them: while the windows query reads rows of batch N,
its watermark comes from batches up to N only, less the delay, and a row of
batch N is not older than that.  So its operator drops nothing, state stays
bounded by the delay, and window totals plus side totals are the totals of
all rows, however late or out of order.

Totals are one row per calendar hour, so each batch writes them whole as a
new generation and removes the one before last: files do not pile up.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.functions.calendar import as_instant, time_parts
from viewstar.operators import quality as qa
from viewstar.operators.engagement import MEASURES, row_counts
from viewstar.session import get_text, list_names, path_exists, put_text, remove_path
from viewstar.streaming.jobs import _run

HOURS = list(schemas.CALENDAR_HOUR_KEYS)
TOTALS_DDL = ", ".join([*(f"{k} INT" for k in HOURS), *(f"{m} LONG" for m in MEASURES)])
ONTIME_DDL = "instant TIMESTAMP, viewed_at TIMESTAMP_NTZ, is_wishlisted BOOLEAN, call_to_action STRING"


def _generation(spark: SparkSession, folder: str, below: int | None = None) -> int | None:
    """The last whole generation (under ``below``)."""
    found = [int(n.removeprefix("gen=")) for n in list_names(spark, folder)
             if n.startswith("gen=") and path_exists(spark, f"{folder}/{n}/_SUCCESS")]
    return max((g for g in found if below is None or g < below), default=None)


def _totals(spark: SparkSession, folder: str, below: int | None = None) -> DataFrame:
    gen = _generation(spark, folder, below)
    return spark.createDataFrame([], TOTALS_DDL) if gen is None else spark.read.schema(TOTALS_DDL).parquet(f"{folder}/gen={gen}")


def _swap(spark: SparkSession, folder: str, gen: int, totals: DataFrame) -> None:
    """Write generation ``gen`` (one row per calendar hour); the one before stays for readers still in it."""
    totals.coalesce(1).write.mode("overwrite").parquet(f"{folder}/gen={gen}")
    before = _generation(spark, folder, gen)
    for name in list_names(spark, folder):
        if name.startswith("gen=") and before is not None and int(name.removeprefix("gen=")) < before:
            remove_path(spark, f"{folder}/{name}")


def split_by_lateness(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str, delay: str = "2 hours",
                      available_now: bool = True):
    """Raw viewing messages to on-time rows and side totals."""
    parsed = qa.to_boolean(qa.normalise_timestamps(stream, ["viewed_at"]), ["is_wishlisted"]) \
        .withColumn("instant", as_instant(F.col("viewed_at")))

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.persist()
        try:
            names = [n for n in list_names(spark, f"{out}/seen") if int(n.removesuffix(".json")) < batch_id]
            seen = json.loads(get_text(spark, f"{out}/seen/{names[-1]}"))["micros"] if names else None
            own = rows.agg(F.max(F.unix_micros("instant"))).first()[0]
            seen = max((x for x in (seen, own) if x is not None), default=None)
            limit = F.timestamp_micros(F.lit(seen).cast("long")) - F.expr(f"INTERVAL {delay}")
            on_time = F.coalesce(F.col("instant") >= limit, F.lit(False))
            columns = [c.split()[0] for c in ONTIME_DDL.split(", ")]
            rows.where(on_time).select(*columns).write.mode("overwrite").parquet(f"{out}/ontime/batch_id={batch_id}")
            late = qa.fill_nulls(rows.where(~on_time).drop("instant"))
            if not late.isEmpty():
                late.write.mode("overwrite").parquet(f"{out}/late_rows/batch_id={batch_id}")
                fresh = late.withColumns(time_parts(F.col("viewed_at"))).groupBy(*HOURS).agg(*row_counts())
                _swap(spark, f"{out}/late", batch_id, _totals(spark, f"{out}/late", batch_id).unionByName(
                    fresh.select(*HOURS, *MEASURES)).groupBy(*HOURS).agg(*[F.sum(m).alias(m) for m in MEASURES]))
            put_text(spark, f"{out}/seen/{batch_id:020d}.json", json.dumps({"micros": seen}))
            for name in names[:-1]:
                remove_path(spark, f"{out}/seen/{name}")
        finally:
            rows.unpersist()
    return _run(parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def count_windows(spark: SparkSession, out: str, checkpoint: str, delay: str = "2 hours", available_now: bool = True):
    """On-time rows to hour totals: an event-time window with a watermark, in update mode."""
    rows = spark.readStream.schema(f"{ONTIME_DDL}, batch_id LONG").parquet(f"{out}/ontime")
    windows = rows.withWatermark("instant", delay).groupBy(F.window("instant", "1 hour")).agg(
        *row_counts(), F.min("viewed_at").alias("viewed_at"))

    def write(batch: DataFrame, batch_id: int) -> None:
        # An update holds the window's total so far, so of two totals of an hour the larger one is the later one.
        fresh = batch.withColumns(time_parts(F.col("viewed_at"))).select(*HOURS, *MEASURES)
        _swap(spark, f"{out}/windows", batch_id, _totals(spark, f"{out}/windows", batch_id).unionByName(fresh)
              .groupBy(*HOURS).agg(*[F.max(m).alias(m) for m in MEASURES]))
    return _run(windows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint),
                available_now)


def read_hour_windows(spark: SparkSession, out: str) -> DataFrame:
    """Totals per calendar hour of all rows: windows plus what came late or had no readable time."""
    return _totals(spark, f"{out}/windows").unionByName(_totals(spark, f"{out}/late")).groupBy(*HOURS).agg(
        F.sum("views").alias("total_views"), F.sum("wishlists").alias("total_wishlists"),
        F.sum("contacts").alias("total_contact_agent"))

"""Registered streaming queries: the fixture viewings arrive as a message log
of five time ranges, out of order (later ranges before earlier ones, so late
rows occur), each range consumed by the streaming jobs with ``availableNow`` as
it lands; the result tables are returned for comparison with their batch
equivalents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.functions.calendar import as_instant
from viewstar.functions.timestamps import parse_timestamp
from viewstar.session import scratch_path
from viewstar.sources import fixtures as fx
from viewstar.sources import readers as rd
from viewstar.streaming import jobs


def message_ranges(spark: SparkSession, sf: str, batches: int = 5):
    """Raw viewings replayed in time ranges, the ranges out of order.

    The log is cut into ``batches`` time ranges (bounds from one percentile
    aggregate: ``batches - 1`` values reach the driver); unparsed times go
    first.  Yields one folder per range, each written by a parallel job
    (sorted within its files) just before it is yielded, so no range has to
    sit in one file or one task.  Odd ranges come before even ones.
    """
    path = scratch_path(spark, "viewing_messages")
    raw = fx.raw_viewings(spark, sf).withColumn("_t", parse_timestamp(F.col("viewed_at")))
    # Parse once and cut lineage: the range filters below would otherwise be
    # pushed under the parse and inline it into every comparison.
    raw = raw.withColumn("_m", F.unix_micros(as_instant(F.col("_t")))).checkpoint()
    micros = F.col("_m")
    cuts = raw.agg(F.percentile_approx(micros, [i / batches for i in range(1, batches)])).first()[0]
    bounds = [None, *cuts, None]
    ranges = list(enumerate(zip(bounds, bounds[1:])))
    for i, (lo, hi) in [*ranges[1::2], *ranges[::2]]:
        cond = F.lit(True) if lo is None else (micros >= lo)
        if hi is not None:
            cond = cond & (micros < hi)
        part = raw.filter(cond | F.col("_t").isNull()) if lo is None else raw.filter(cond)
        part.sortWithinPartitions(F.col("_t").asc_nulls_first()) \
            .drop("_t", "_m").write.mode("overwrite").json(f"{path}/r{i}")
        yield f"{path}/r*"


def _replay(spark, sf, run_job) -> None:
    """Run a stream job once per arriving range (``availableNow`` each time,
    one checkpoint throughout): each range is one distributed micro-batch."""
    for source in message_ranges(spark, sf):
        run_job(jobs.viewing_stream(spark, source))


def stream_land_by_date(spark: SparkSession, sf: str) -> DataFrame:
    landing = scratch_path(spark, "landing")
    ckpt = scratch_path(spark, "ckpt_land")
    _replay(spark, sf, lambda stream: jobs.land_by_date(stream, landing, ckpt))
    return rd.read_viewings_for_date(spark, landing)


def _dedup(spark, sf) -> str:
    out = scratch_path(spark, "stream_dedup")
    ckpt = scratch_path(spark, "ckpt_dedup")
    _replay(spark, sf, lambda stream: jobs.dedup_stream(spark, stream, out, ckpt))
    return out


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_deduped(spark, _dedup(spark, sf))


def stream_hour_engagement(spark: SparkSession, sf: str) -> DataFrame:
    return jobs.read_hour_engagement(spark, _dedup(spark, sf))


STREAM_QUERIES = {
    "stream_land_by_date": stream_land_by_date,
    "stream_dedup": stream_dedup,
    "stream_hour_engagement": stream_hour_engagement,
}

"""Streaming forms of the ingestion path.

T1 lands raw viewing messages in ``dt=`` folders, T2 cleans and de-duplicates
them continuously, T3 keeps engagement per calendar hour current.  All run
with any trigger; tests and the registered queries use ``availableNow`` so a
run ends when the input is consumed.  Sinks are exactly-once: a file sink
with a checkpoint, or ``foreachBatch`` writes keyed by batch id, so a retried
batch replaces its own output.

T2 and T3 keep no streaming state.  What earlier batches wrote *is* the state:
a batch looks up its keys in the output files of the event dates it touches
(``store`` keeps them few), so a row may arrive any time late, nothing is
dropped, and nothing has to expire.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.functions.calendar import time_parts
from viewstar.functions.timestamps import parse_timestamp
from viewstar.operators import quality as qa
from viewstar.streaming import store

MEASURES = ("views", "wishlists", "contacts")


def viewing_stream(spark: SparkSession, source: str, fmt: str = "json",
                   max_files_per_trigger: int | None = None,
                   kafka_options: dict[str, str] | None = None) -> DataFrame:
    """Raw viewing messages as a stream: JSON files, or a Kafka topic whose
    values are JSON rows (needs the Kafka connector on the classpath)."""
    if fmt == "kafka":
        reader = spark.readStream.format("kafka")
        for k, v in (kafka_options or {}).items():
            reader = reader.option(k, v)
        raw = reader.option("subscribe", source).load()
        return raw.select(F.from_json(F.col("value").cast("string"), schemas.VIEWINGS_DDL).alias("m")) \
            .select("m.*")
    reader = spark.readStream.schema(schemas.VIEWINGS_DDL)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.format(fmt).load(source)


def _run(writer, available_now: bool = True):
    query = (writer.trigger(availableNow=True) if available_now else writer).start()
    if available_now:
        query.awaitTermination()
    return query


# -- T1 -------------------------------------------------------------------------------
def land_by_date(stream: DataFrame, landing: str, checkpoint: str, available_now: bool = True,
                 arrival_date: str | None = None):
    """Append raw messages under ``landing/dt=<date>/`` as JSON lines.

    With ``arrival_date`` every message lands under that date: a dated run then
    reads each message once, those with unreadable times included.  Without,
    ``dt`` is the event date, and messages whose time does not parse land in
    the default (null) partition, which no dated read covers.  A landing
    folder belongs to one checkpoint: use the same one for every date.
    """
    dt = F.lit(arrival_date).cast("date") if arrival_date else F.to_date(parse_timestamp(F.col("viewed_at")))
    writer = (stream.withColumn("dt", dt).writeStream.format("json").outputMode("append").partitionBy("dt")
              .option("checkpointLocation", checkpoint).option("path", landing))
    return _run(writer, available_now)


#: Kinds of landed lines.
VIEWING, MALFORMED = "viewing", "malformed"


def land_lines(spark: SparkSession, source: str, landing: str, checkpoint: str, arrival_date: str | None = None,
               available_now: bool = True, max_files_per_trigger: int | None = None):
    """T1 with quarantine: every line of the source lands once, viewings and malformed lines apart.

    A line that is no JSON object, breaks off, or holds none of the fields is
    malformed; it lands as it came (column ``line``), so nothing turns into a
    viewing of ``Unknown`` and nothing is lost.  One pass and one file sink for
    both, under ``landing/kind=<kind>/dt=<date>/``, so both are exactly-once.
    Malformed lines have no event date: without ``arrival_date`` they lie
    under the null date.
    """
    reader = spark.readStream.schema("value STRING")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.format("text").load(source)
    message = F.from_json("value", f"{schemas.VIEWINGS_DDL}, _corrupt STRING", {"columnNameOfCorruptRecord": "_corrupt"})
    parsed = lines.select("value", message.alias("m")).select("value", "m.*")
    good = F.col("_corrupt").isNull() & F.coalesce(*[F.col(c) for c in schemas.VIEWING_COLUMNS]).isNotNull()
    day = F.lit(arrival_date).cast("date") if arrival_date else F.to_date(parse_timestamp(F.col("viewed_at")))
    landed = parsed.select(
        *[F.when(good, F.col(c)).alias(c) for c in schemas.VIEWING_COLUMNS], F.when(~good, F.col("value")).alias("line"),
        F.when(good, VIEWING).otherwise(MALFORMED).alias("kind"),
        (day if arrival_date else F.when(good, day)).alias("dt"))
    writer = (landed.writeStream.format("json").outputMode("append").partitionBy("kind", "dt")
              .option("checkpointLocation", checkpoint).option("path", landing))
    return _run(writer, available_now)


def read_landed(spark: SparkSession, landing: str, kind: str | None = VIEWING, dt: str | None = None) -> DataFrame:
    """What :func:`land_lines` wrote; ``kind`` and ``dt`` prune folders.  ``kind=None`` reads both kinds."""
    df = spark.read.schema(f"{schemas.VIEWINGS_DDL}, line STRING, kind STRING, dt DATE").json(landing)
    if kind:
        df = df.where(F.col("kind") == kind).drop("kind", *(["line"] if kind == VIEWING else schemas.VIEWING_COLUMNS))
    return df if dt is None else df.where(F.col("dt") == F.lit(dt).cast("date"))


# -- T2 and T3 ------------------------------------------------------------------------
def clean_stream(stream: DataFrame) -> DataFrame:
    """C1 -> C10 -> C7 on a stream (no all-null column drop: a stream's schema is fixed)."""
    df = qa.to_boolean(qa.normalise_timestamps(stream, ["viewed_at"]), ["is_wishlisted"])
    return qa.fill_nulls(df)


def _ordered(columns: Sequence[str]):
    """C9's order as one struct: the columns ascending, nulls last."""
    parts = []
    for c in columns:
        parts += [F.col(c).isNull().alias(f"_n_{c}"), F.col(c).alias(c)]
    return F.struct(*parts)


def dedup_stream(spark: SparkSession, stream: DataFrame, out: str, checkpoint: str,
                 keys: Sequence[str] = schemas.VIEWING_KEY, available_now: bool = True,
                 compact_after: int = store.COMPACT_AFTER, bucket_rows: int = store.BUCKET_ROWS):
    """Clean and de-duplicate continuously, and keep hour engagement current (T2 and T3, one read).

    A batch is folded to one row per key (C9's order), then compared with what
    earlier batches kept for those keys: a row is written if its key is new or
    the row comes first in that order, so the kept row per key is always C9's,
    however late its parts arrive.  Rows go to
    ``out/rows/batch_id=/event_date=``, ``out/hours/batch_id=`` holds the
    batch's change of each calendar hour's totals: a new key adds, a replaced
    row takes its old counts back.  Every ``compact_after`` batches are merged
    (``store``), so the files a batch reads do not grow with the batches before it.
    """
    write = batch_writer(spark, out, keys, compact_after, bucket_rows)
    return _run(clean_stream(stream).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint), available_now)


def batch_writer(spark: SparkSession, out: str, keys: Sequence[str] = schemas.VIEWING_KEY,
                 compact_after: int = store.COMPACT_AFTER, bucket_rows: int = store.BUCKET_ROWS):
    """The work of one batch of cleaned rows: (batch, its number) -> None."""
    keys = list(keys)
    if "viewed_at" not in keys:
        raise ValueError("viewed_at must be part of the key: it says which folders hold a key's earlier rows")
    rest = [c for c in schemas.VIEWING_COLUMNS if c not in keys]

    def fold(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys, "event_date").agg(F.min(_ordered(rest)).alias("row"))

    def plain(df: DataFrame) -> DataFrame:
        return df.select(*keys, *[F.col(f"row.{c}").alias(c) for c in rest], "event_date") \
            .select(*schemas.VIEWING_COLUMNS, "event_date")

    def write(batch: DataFrame, batch_id: int) -> None:
        held = store.compact(spark, out, batch_id, keys, lambda df: plain(fold(df)), compact_after, bucket_rows)
        fresh = fold(batch.withColumn("event_date", F.to_date("viewed_at"))).persist()
        try:
            changed = fresh.withColumn("was", F.lit(None).cast(fresh.schema["row"].dataType))
            if batch_id:
                earlier = fold(store.earlier_rows(spark, out, fresh, keys, batch_id, held)).withColumnRenamed("row", "was")
                changed = fresh.join(earlier, [*keys, "event_date"], "left") \
                    .where(F.col("was").isNull() | (F.col("row") < F.col("was")))
            changed = changed.persist()
            plain(changed).write.mode("overwrite").partitionBy("event_date").parquet(f"{out}/rows/batch_id={batch_id}")
            _hour_changes(changed).write.mode("overwrite").parquet(f"{out}/hours/batch_id={batch_id}")
            changed.unpersist()
        finally:
            fresh.unpersist()

    return write


def _hour_changes(changed: DataFrame) -> DataFrame:
    """Change of each calendar hour's counts from rows (key, row, was)."""
    def counts(row: str):
        wished = F.coalesce(F.col(f"{row}.is_wishlisted"), F.lit(False)).cast("long")
        contact = F.coalesce(F.col(f"{row}.call_to_action") == schemas.CONTACT_ACTION, F.lit(False)).cast("long")
        return F.when(F.col(row).isNull(), 0).otherwise(1).cast("long"), wished, contact
    new, old = counts("row"), counts("was")
    return changed.withColumns(time_parts(F.col("viewed_at"))).groupBy(*schemas.CALENDAR_HOUR_KEYS).agg(
        *[F.sum(a - b).alias(m) for m, a, b in zip(MEASURES, new, old)])


def read_deduped(spark: SparkSession, out: str, keys: Sequence[str] = schemas.VIEWING_KEY) -> DataFrame:
    """The de-duplicated stream output as one table: per key the row that comes first, one aggregate."""
    return qa.dedup(store.rows(spark, out).select(*schemas.VIEWING_COLUMNS), keys)


def read_hour_engagement(spark: SparkSession, out: str) -> DataFrame:
    """Totals per calendar hour: the sum of all batches' changes."""
    return store.hours(spark, out).groupBy(*schemas.CALENDAR_HOUR_KEYS).agg(
        F.sum("views").alias("total_views"), F.sum("wishlists").alias("total_wishlists"),
        F.sum("contacts").alias("total_contact_agent"))

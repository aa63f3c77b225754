"""Registered source/sink queries: write through a sink, read back through
the matching source, so each check covers both sides.

Scratch output goes under ``spark.checkpoint.dir`` (the cluster's shared
folder), one fresh folder per run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.functions.timestamps import parse_timestamp
from viewstar.plans import kpis
from viewstar.plans import registry as r
from viewstar.session import scratch_path
from viewstar.sinks import writers as w
from viewstar.sources import fixtures as fx
from viewstar.sources import readers as rd

RUN_DATES = ("2025-06-27", "2025-06-28")


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K3 -> S1 on listings: JSON-lines batches, read back by glob with the DDL."""
    path = scratch_path(spark, "apartments")
    w.write_json_batches(fx.raw_apartments(spark, sf), path)
    return rd.read_json(spark, f"{path}/part-*.json", schemas.APARTMENTS_DDL)


def json_batches(spark: SparkSession, sf: str) -> DataFrame:
    """K3 -> S1 on attributes (wide rows, an all-null column kept as null)."""
    path = scratch_path(spark, "apartment_attributes")
    w.write_json_batches(fx.raw_attributes(spark, sf), path)
    return rd.read_json(spark, path, schemas.ATTRIBUTES_DDL)


def dt_partition_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Viewings landed in ``dt=`` folders by event date, scanned with ``dt`` kept."""
    path = scratch_path(spark, "user_viewings")
    raw = fx.raw_viewings(spark, sf)
    (raw.withColumn("dt", F.to_date(parse_timestamp(F.col("viewed_at"))))
     .write.mode("overwrite").partitionBy("dt").json(path))
    return rd.read_viewings_for_date(spark, path)


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K10 -> S3: viewings as CSV with a header, read back with the DDL."""
    path = scratch_path(spark, "user_viewings_csv")
    w.write_csv(fx.raw_viewings(spark, sf), path)
    return rd.read_csv(spark, path, schemas.VIEWINGS_DDL)


def listings_with_text(spark: SparkSession, sf: str) -> DataFrame:
    """Listings whose titles and bodies hold quotes, commas and line breaks (``id`` as in ``part``)."""
    key, name = F.col("p_partkey"), F.col("p_name")
    title = (F.when(key % 3 == 0, F.concat(F.lit('He said "hi", then left: '), name))
             .when(key % 3 == 1, F.concat(name, F.lit("\nsecond line, with \"quotes\""))).otherwise(name))
    body = F.when(key % 5 != 0, F.concat(F.lit('"'), name, F.lit('",\n""'), key.cast("string")))
    return fx.table(spark, sf, "part").select(
        key.cast("string").alias("id"), title.alias("title"), F.col("p_type").alias("source"),
        F.floor("p_retailprice").cast("int").alias("price"), body.alias("body"),
        F.when(key % 4 == 0, F.lit(float("nan"))).otherwise(F.col("p_size") + 0.5).alias("fee"))


def csv_listings_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """K10 -> S4: listing text with quotes, commas and line breaks; NaN becomes null; no corrupt record."""
    path = scratch_path(spark, "listings_csv")
    w.write_csv(listings_with_text(spark, sf), path)
    return rd.read_csv(spark, path, "id STRING, title STRING, source STRING, price INT, body STRING, fee DOUBLE",
                       multi_line=True, corrupt_column="corrupt")


def time_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Viewings cut into 5 time-range batches, read back."""
    path = scratch_path(spark, "user_viewings_batches")
    w.write_time_batches(fx.raw_viewings(spark, sf), path, "viewed_at")
    return rd.read_json(spark, path, schemas.VIEWINGS_DDL).drop("batch")


def _database(spark: SparkSession) -> str:
    name = f"viewstar_{uuid.uuid4().hex[:10]}"
    w.create_database(spark, name, scratch_path(spark, "warehouse"))
    return name


def kpi_table_load(spark: SparkSession, sf: str) -> DataFrame:
    """K7: hour summary loaded for two run dates, the second date loaded twice."""
    table = f"{_database(spark)}.kpi_hour_summary"
    summary = kpis.hour_summary(r.cube(spark, sf)).checkpoint()
    for dt in (*RUN_DATES, RUN_DATES[-1]):
        w.load_dated_table(spark, summary, table, dt)
    return spark.table(table)


def fact_append_load(spark: SparkSession, sf: str) -> DataFrame:
    """K6 as in the original: appending the same run twice doubles the rows."""
    table = f"{_database(spark)}.fact_userviewings"
    fact = r.clean_viewings(spark, sf).checkpoint()
    for _ in range(2):
        w.load_table(fact, table, "append")
    return spark.table(table)


def dim_truncate_load(spark: SparkSession, sf: str) -> DataFrame:
    """K5: truncate-and-load twice leaves one copy."""
    table = f"{_database(spark)}.dim_apartments"
    dim = r.listing(spark, sf).checkpoint()
    for _ in range(2):
        w.load_table(dim, table, "overwrite")
    return spark.table(table)


def topic_messages(spark: SparkSession, sf: str) -> DataFrame:
    """K9: viewings in time-text order as (key, value) messages from index 0."""
    return w.topic_frame(fx.raw_viewings(spark, sf), ["viewed_at"], first_index=0)


IO_QUERIES = {
    "json_roundtrip": json_roundtrip,
    "json_batches": json_batches,
    "dt_partition_scan": dt_partition_scan,
    "csv_roundtrip": csv_roundtrip,
    "csv_listings_roundtrip": csv_listings_roundtrip,
    "time_batches": time_batches,
    "kpi_table_load": kpi_table_load,
    "fact_append_load": fact_append_load,
    "dim_truncate_load": dim_truncate_load,
    "topic_messages": topic_messages,
}

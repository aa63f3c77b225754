"""Raw tables derived from the shared test tables.

No data is invented: each raw column is a fixed rule over a column of
``events``, ``part`` or ``lineitem``, with dirt put in by key so that every
cleaning rule has cases to act on.  The same rules are written in SQL for
the DuckDB oracle (``oracle/``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.sources.readers import balanced


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _every(c: Column, n: int, r: int = 0) -> Column:
    return (c % n) == r


def _id_unless_every(key: Column, n: int) -> Column:
    """The key as text, except every ``n``-th key, which gets ``-(key + 1)``:
    an id no viewing uses.  Every part row stays; the renamed ones make
    viewings without a listing (or listings without attributes) and
    listings nobody viewed."""
    return F.when(_every(key, n), -(key + 1)).otherwise(key).cast("string")


def raw_viewings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw viewings from ``events``: five time layouts, bad times,
    free-text flags, missing listings and exact repeats."""
    ev = balanced(table(spark, sf_dir, "events"))
    eid = F.col("event_id")
    ts = F.col("ts")
    text_time = (F.when(_every(eid, 91, 4), F.lit("not-a-date"))
                 .when(_every(eid, 91, 5), F.lit("2024-02-31 10:00:00"))
                 .when(_every(eid, 7, 0), F.date_format(ts, "dd-MM-yyyy HH:mm:ss"))
                 .when(_every(eid, 7, 1), F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
                 .when(_every(eid, 7, 2), F.date_format(ts, "dd/MM/yyyy HH:mm:ss"))
                 .when(_every(eid, 7, 3), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"))
                 .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")))
    wish = (F.when(_every(eid, 5, 0), "y").when(_every(eid, 5, 1), "n")
            .when(_every(eid, 5, 2), "true").when(_every(eid, 5, 4), "maybe"))
    action = (F.when(F.col("event_type").isin("purchase", "view"), schemas.CONTACT_ACTION)
              .when(F.col("event_type") == "click", "shortlisted")
              .when(F.col("event_type") == "error", "reported"))
    rows = ev.select(
        eid.alias("_eid"),
        F.col("user_id").cast("string").alias("user_id"),
        F.when(~_every(eid, 53), F.get_json_object("props", "$.k")).alias("apartment_id"),
        text_time.alias("viewed_at"),
        wish.alias("is_wishlisted"),
        action.alias("call_to_action"),
    )
    repeats = rows.filter(_every(F.col("_eid"), 101))
    return rows.unionAll(repeats).drop("_eid")


def raw_apartments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings from ``part``; every 11th key is renamed, so its views find no listing."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    hours = key % 5000
    created = (F.when(_every(key, 19), F.lit(None).cast("timestamp_ntz"))
               .when(_every(key, 23), F.lit("2023-01-01 00:00:00.5").cast("timestamp_ntz"))
               .otherwise(F.timestamp_add("HOUR", hours, F.lit("2023-01-01 00:00:00").cast("timestamp_ntz"))))
    return p.select(
        _id_unless_every(key, 11).alias("id"),
        F.col("p_name").alias("title"),
        F.when(~_every(key, 17), F.col("p_type")).alias("source"),
        F.when(~_every(key, 13), F.floor("p_retailprice").cast("int")).alias("price"),
        F.lit("USD").alias("currency"),
        created.alias("listing_created_on"),
        (F.col("p_size") % 2).cast("tinyint").alias("is_active"),
        F.timestamp_add("HOUR", hours, F.lit("2023-06-01 00:00:00").cast("timestamp_ntz"))
        .alias("last_modified_timestamp"),
    )


def raw_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing attributes from ``part``; every 7th key is renamed (no attributes for
    that listing), amenities all null."""
    p = table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    size = F.col("p_size")
    return p.select(
        _id_unless_every(key, 7).alias("id"),
        F.col("p_brand").alias("category"),
        F.col("p_name").alias("body"),
        F.lit(None).cast("string").alias("amenities"),
        (size % 3 + 0.5).cast("float").alias("bathrooms"),
        F.when(~_every(key, 31), size % 4).cast("float").alias("bedrooms"),
        F.when(~_every(key, 2), F.lit(10.5)).cast("float").alias("fee"),
        F.when(_every(size, 2, 1), "Yes").otherwise("No").alias("has_photo"),
        F.when(~_every(key, 3), F.lit("Cats")).alias("pets_allowed"),
        F.concat(F.lit("$"), F.floor("p_retailprice").cast("string")).alias("price_display"),
        F.lit("Monthly").alias("price_type"),
        (size * 40).cast("int").alias("square_feet"),
        F.when(~_every(key, 5), F.concat(key.cast("string"), F.lit(" Main St"))).alias("address"),
        F.when(~_every(key, 29), F.concat(F.lit("City_"), (key % 12).cast("string"))).alias("cityname"),
        F.concat(F.lit("ST"), (key % 5).cast("string")).alias("state"),
        (30 + key % 20).cast("double").alias("latitude"),
        (-120 + key % 50).cast("double").alias("longitude"),
    )


def large_viewings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean raw viewings from ``lineitem``, one per line (the bench fact)."""
    li = balanced(table(spark, sf_dir, "lineitem"))
    when_viewed = F.timestamp_add("HOUR", F.col("l_orderkey") % 24, F.col("l_shipdate"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("user_id"),
        F.col("l_partkey").cast("string").alias("apartment_id"),
        F.date_format(when_viewed, "yyyy-MM-dd HH:mm:ss").alias("viewed_at"),
        F.when(F.col("l_returnflag") == "R", "y").when(F.col("l_returnflag") == "A", "n")
        .alias("is_wishlisted"),
        F.when(F.col("l_linestatus") == "O", schemas.CONTACT_ACTION)
        .when(F.col("l_returnflag") == "A", "shortlisted").otherwise("reported")
        .alias("call_to_action"),
    )


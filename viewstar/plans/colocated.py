"""J2 / K1 on co-located storage: the silver fact and the listings bucketed by listing.

Tables bucketed alike on the join key are joined bucket by bucket, without a
shuffle of the fact.  Nothing can split a bucket at run time, though, so a
listing that holds more rows than a fair bucket (the fill value of missing
ids may hold a third of all) would be one long task: such hot listings,
fewer than there are buckets, go to a table of their own, whose join
broadcasts just their listing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.plans import model

FACT, HOT, LISTING = "viewings_by_listing", "viewings_of_hot_listings", "listing_by_id"


def write_colocated(spark: SparkSession, fact: DataFrame, listing: DataFrame, database: str, buckets: int) -> list[str]:
    """Write the three tables of ``database``; returns the hot listings' ids (fewer than ``buckets``).

    ``fact`` and ``listing`` should be silver tables: both are read more than once.
    """
    per_key = fact.groupBy("apartment_id").agg(F.count(F.lit(1)).alias("rows"))
    total = per_key.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    large = per_key.where(F.col("apartment_id").isNotNull() & (F.col("rows") > max(total // buckets, 1)))
    hot = [r[0] for r in large.select("apartment_id").collect()]
    is_hot = F.col("apartment_id").isNull()  # a missing id joins nothing: its rows need no bucket
    if hot:
        is_hot = is_hot | F.col("apartment_id").isin(hot)
    # One file a bucket: the rows come to the task that writes it.
    (fact.where(~is_hot).repartition(buckets, "apartment_id").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "apartment_id").sortBy("apartment_id").saveAsTable(f"{database}.{FACT}"))
    fact.where(is_hot).write.mode("overwrite").format("parquet").saveAsTable(f"{database}.{HOT}")
    (listing.repartition(buckets, "id").write.mode("overwrite").format("parquet")
     .bucketBy(buckets, "id").sortBy("id").saveAsTable(f"{database}.{LISTING}"))
    return hot


def full_detail(spark: SparkSession, database: str, hot: list[str]) -> DataFrame:
    """Q0 from the co-located tables: no exchange of viewings."""
    listing = spark.table(f"{database}.{LISTING}")

    def joined(fact: DataFrame, side: DataFrame) -> DataFrame:
        both = fact.join(side, fact["apartment_id"] == side["id"], "left")
        return both.select(*fact.columns, *listing.columns)
    cold = joined(spark.table(f"{database}.{FACT}"), listing.hint("merge"))
    few = F.broadcast(listing.where(F.col("id").isin(hot)))  # one row per hot listing, fewer than buckets
    return model.with_time_parts(cold.unionByName(joined(spark.table(f"{database}.{HOT}"), few)))

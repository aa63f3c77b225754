"""Global order and position without a single-partition window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from viewstar.session import scratch_path


def number_rows(df: DataFrame, order: Sequence[Column], index: str = "position", first: int = 0) -> DataFrame:
    """``df`` with each row's place in ``order``, counted from ``first``.

    Rows are range-partitioned by the order and written once under the shared
    scratch folder, each with its range's number and its place in it; its
    index is the range's offset plus the place.  Offsets come from one row per
    range, so the broadcast is bounded by the partition count, not the data.
    Written once and read back, the sort runs once, and a lost executor costs
    a re-read of files.

    A row id from the input ends the sort key: equal rows (one group of
    copies may hold a third of the data) then still spread over many range
    partitions instead of landing in one task.
    """
    spark, names = df.sparkSession, [f"c{k}" for k in range(len(df.columns))]
    ordered = df.withColumn("_row", F.monotonically_increasing_id()).orderBy(*order, "_row")
    pid = F.spark_partition_id()
    placed = ordered.select(
        pid.alias("range"), (F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33)).alias("place"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names)])
    path = scratch_path(spark, "ordered")
    placed.write.parquet(path)
    placed = spark.read.schema(placed.schema).parquet(path)
    sized = placed.groupBy("range").agg(F.count(F.lit(1)).alias("size"))
    offsets = sized.select("range", F.sum("size").over(
        Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)).alias("start"))
    number = F.coalesce(F.col("start"), F.lit(0)) + F.col("place") + F.lit(first)
    return placed.join(F.broadcast(offsets), "range").select(
        *[F.col(n).alias(c) for c, n in zip(df.columns, names)], number.alias(index))

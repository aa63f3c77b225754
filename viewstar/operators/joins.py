"""Left joins onto dimensions, broadcasting only a side of proven size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only if its measured size stays under this budget.
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_ONE_WORD = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.DateType, T.FloatType, T.LongType,
             T.DoubleType, T.TimestampType, T.TimestampNTZType)


def _cell_bytes(field: T.StructField) -> Column | None:
    """Upper bound of a cell's bytes in Spark's row format; None if the type has no simple bound."""
    if isinstance(field.dataType, _ONE_WORD):
        return F.lit(8)
    if isinstance(field.dataType, T.DecimalType):
        return F.lit(24)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(field.name)), F.lit(0)) + 16  # offset word, padded bytes
    return None


def measured_size(df: DataFrame, max_bytes: int) -> tuple[int, int] | None:
    """(rows, bytes) of ``df`` if it fits in ``max_bytes``, else None; ``bytes`` is an upper bound.

    A side with a nested column has no such bound and never fits.

    One distributed aggregate: each task sums the widths of its own rows and
    only one partial row per task moves.  (A ``limit`` before the sum would
    look cheaper, but Spark plans it as a single-partition exchange: on a
    huge side every task would ship its rows into one task.)
    """
    width = F.lit(8 + 8 * (len(df.columns) // 64 + 1))  # row header and null bits
    for field in df.schema.fields:
        cell = _cell_bytes(field)
        if cell is None:
            return None
        width = width + cell
    row = df.agg(F.count(F.lit(1)).alias("rows"),
                 F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    if row["bytes"] > max_bytes or row["rows"] > max(max_bytes // 8, 1):
        return None
    return row["rows"], row["bytes"]


def broadcast_if_small(df: DataFrame, max_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast if measured under ``max_bytes``.

    Beyond the budget the side is left to a shuffle join, where AQE may
    still switch strategy from runtime sizes and splits skewed partitions.
    """
    if max_bytes is None or max_bytes <= 0:
        return df
    return F.broadcast(df) if measured_size(df, max_bytes) is not None else df


def left_join_dim(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                  max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``fact`` LEFT JOIN ``dim`` ON fact_key = dim_key; both key columns stay.

    ``dim`` must hold one row per key (cleaned dimensions do), so the join
    never multiplies fact rows.
    """
    side = broadcast_if_small(dim, max_broadcast_bytes)
    return fact.join(side, fact[fact_key] == side[dim_key], "left")


def salted_left_join(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                     key_rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """``fact`` LEFT JOIN ``dim`` as a shuffle join that splits hot keys.

    ``key_rows`` holds (``fact_key``, ``rows``): fact rows per key, e.g. from
    the engagement cube.  A key is hot when it holds more than a fair task's
    share, ``total / partitions`` rows, so fewer than ``partitions`` keys can
    be hot: that list is broadcast with a proven bound.  A hot key's fact
    rows are spread over ``ceil(rows / share)`` salt buckets by a hash of the
    row and its input partition id (deterministic, so a retried task sends
    each row where it went before; the partition id spreads even identical
    copies, split by split); its one dimension row is copied once per bucket.  Cold keys keep
    salt 0.  No row is dropped or capped; one key holding a third of all rows
    lands in many tasks instead of one.
    """
    spark = fact.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = key_rows.agg(F.sum("rows")).first()[0] or 0
    share = max(total // max(partitions, 1), 1)
    hot = F.broadcast(key_rows.filter(F.col("rows") > share).select(
        F.col(fact_key).alias("_hot_key"), F.ceil(F.col("rows") / F.lit(share)).cast("int").alias("_buckets")))

    spread = F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in fact.columns])
    # A null key matches nothing, so its rows may go anywhere: they are spread over all partitions.
    salted_fact = fact.join(hot, fact[fact_key] == hot["_hot_key"], "left").withColumn(
        "_fact_salt", F.when(fact[fact_key].isNull(), F.pmod(spread, F.lit(max(partitions, 1))))
        .when(F.col("_buckets").isNull(), F.lit(0)).otherwise(F.pmod(spread, F.col("_buckets"))))
    salted_fact = salted_fact.drop("_hot_key", "_buckets")
    copied_dim = dim.join(hot, dim[dim_key] == hot["_hot_key"], "left").withColumn(
        "_dim_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_buckets"), F.lit(1)) - 1)))
    copied_dim = copied_dim.drop("_hot_key", "_buckets")
    joined = salted_fact.join(
        copied_dim, (salted_fact[fact_key] == copied_dim[dim_key])
        & (salted_fact["_fact_salt"] == copied_dim["_dim_salt"]), "left")
    return joined.drop("_fact_salt", "_dim_salt")


def left_join_dim_skew_safe(fact: DataFrame, dim: DataFrame, fact_key: str, dim_key: str,
                            key_rows: DataFrame | None = None,
                            max_broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``dim`` if its measured size allows; else a salted shuffle join
    (given per-key row counts), else a plain shuffle join left to AQE."""
    if max_broadcast_bytes and measured_size(dim, max_broadcast_bytes) is not None:
        side = F.broadcast(dim)
        return fact.join(side, fact[fact_key] == side[dim_key], "left")
    if key_rows is not None:
        return salted_left_join(fact, dim, fact_key, dim_key, key_rows)
    return fact.join(dim, fact[fact_key] == dim[dim_key], "left")

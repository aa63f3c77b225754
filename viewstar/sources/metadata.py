"""A11 / C4 / C6 on silver tables from Parquet footers: row and value counts without reading a column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.session import list_names

#: The V2 Parquet reader answers COUNT from the footers' row and null counts.
PUSHDOWN_CONF = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def metadata_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same cluster and tables on disk) that pushes aggregates into footers."""
    beside = spark.newSession()
    for name, value in PUSHDOWN_CONF.items():
        beside.conf.set(name, value)
    return beside


def value_counts(spark: SparkSession, path: str, columns: Sequence[str] | None = None, partition: str | None = None) -> DataFrame:
    """``rows`` and, per column, its number of values: for the table, or per folder of ``partition``.

    Counts only (no group but the partition, no filter) are what footers
    answer, so each task reads footers and no data page.  The files of one
    folder must have the same columns, as every run's output has; folders that
    differ (a run drops columns null throughout) are asked one schema at a
    time, and a dropped column counts 0.
    """
    beside = metadata_session(spark)
    if partition is None:
        return _counts(beside.read.parquet(path), columns, None)
    by_schema: dict[str, list[str]] = {}
    for name in list_names(spark, path):
        if name.startswith(f"{partition}="):
            by_schema.setdefault(beside.read.parquet(f"{path}/{name}").schema.json(), []).append(f"{path}/{name}")
    parts = [beside.read.option("basePath", path).parquet(*folders) for folders in by_schema.values()]
    if not parts:
        raise FileNotFoundError(f"no {partition}= folder in {path}")
    wanted = columns or list(dict.fromkeys(c for part in parts for c in part.columns if c != partition))
    out = None
    for part in parts:
        one = _counts(part, wanted, partition)
        out = one if out is None else out.unionByName(one)
    return out


def _counts(df: DataFrame, columns: Sequence[str] | None, partition: str | None) -> DataFrame:
    wanted = [c for c in (columns or df.columns) if c != partition]
    there = [c for c in wanted if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in there]]
    found = df.groupBy(partition).agg(*aggs) if partition else df.agg(*aggs)
    return found.select(*([partition] if partition else []), "rows", *[
        F.col(f"`{c}`") if c in there else F.lit(0).cast("long").alias(c) for c in wanted])


def all_null_columns(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> list[str]:
    """C6's test on a Parquet table: columns without a value; empty tables have none."""
    row = value_counts(spark, path, columns).first().asDict()
    return [c for c, n in row.items() if c != "rows" and n == 0] if row["rows"] else []

"""Readers for the raw tables: JSON lines, dated folders, CSV, JDBC, Parquet.

Schemas are always given as DDL, never inferred: inference costs an extra
pass over the input and makes the table schema depend on the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.operators.quality import nan_to_null


def balanced(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread a scan over at least the cluster's parallelism.

    A file written as one row group scans as one task, leaving every later
    per-row step (regex parsing, partial dedup) single-threaded.  Only a scan
    of a handful of splits (under an eighth of the cores) is spread
    round-robin; that is at most a few file splits of data.  Any larger scan
    is returned untouched, no shuffle.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    few = max(1, target // 8) if min_partitions is None else min_partitions - 1
    return df.repartition(target) if df.rdd.getNumPartitions() <= few and target > 1 else df


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON lines (a folder or a glob such as ``.../apartments_batch*.json``)."""
    return spark.read.schema(ddl).json(path)


def read_viewings_for_date(spark: SparkSession, root: str, dt: str | None = None,
                           ddl: str = schemas.VIEWINGS_DDL) -> DataFrame:
    """Viewings landed under ``root/dt=YYYY-MM-DD/``.

    The root is read with ``dt`` as a partition column, so a date filter
    prunes folders at planning time and ``dt`` stays in the rows (reading
    the leaf folder would lose it).  ``dt=None`` reads every date.
    """
    df = spark.read.schema(f"{ddl}, dt DATE").json(root)
    return df if dt is None else df.where(F.col("dt") == F.lit(dt).cast("date"))


def read_csv(spark: SparkSession, path: str, ddl: str, header: bool = True, multi_line: bool = False,
             corrupt_column: str | None = None) -> DataFrame:
    """CSV with a header; empty fields and NaN floats become null.

    A quote inside a quoted field is doubled, as most writers do it.
    ``multi_line`` accepts line breaks inside quoted fields; each file is then
    one task, so use it for listing files, not for the viewing fact.
    ``corrupt_column`` adds a text column holding the raw record of every row
    that does not fit the schema (null otherwise), so they can be counted.
    """
    schema = f"{ddl}, `{corrupt_column}` STRING" if corrupt_column else ddl
    reader = (spark.read.schema(schema).option("header", header).option("nullValue", "")
              .option("quote", '"').option("escape", '"').option("multiLine", multi_line).option("mode", "PERMISSIVE"))
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return nan_to_null(reader.csv(path))


def read_jdbc(spark: SparkSession, url: str, table: str, *, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 1000,
              predicates: Sequence[str] | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """A relational table, read in parallel.

    A numeric ``partition_column`` is read in key ranges, which never overlap,
    unlike LIMIT/OFFSET paging without an ORDER BY.  For text keys give
    ``predicates``, one disjoint condition per task that together cover the
    table (:func:`key_predicates` makes hash ranges).  Without either the
    read is one task.
    """
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=list(predicates),
                               properties={"fetchsize": str(fetch_size), **(properties or {})})
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("fetchsize", fetch_size))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", lower_bound).option("upperBound", upper_bound)
                  .option("numPartitions", num_partitions))
    return reader.load()


def key_predicates(column: str, parts: int, hash_sql: str = "MOD(CRC32({column}), {parts})") -> list[str]:
    """Disjoint conditions that split a text key by a hash the database computes; null keys go with part 0."""
    value = hash_sql.format(column=column, parts=parts)
    return [f"{value} = {k}" + (f" OR {column} IS NULL" if k == 0 else "") for k in range(parts)]


def read_silver(spark: SparkSession, path: str, ddl: str, dt: str | None = None, dated: bool = True) -> DataFrame:
    """A silver table with its declared schema, whatever columns single files hold.

    A column that a date's run dropped (null throughout) reads as null there
    and stays readable on the other dates.  ``dt`` prunes to one date.
    """
    df = spark.read.schema(f"{ddl}, dt DATE" if dated else ddl).parquet(path)
    return df if dt is None else df.where(F.col("dt") == F.lit(dt).cast("date"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A silver table."""
    return spark.read.parquet(path)

"""Sinks.  Every write is idempotent by default: rerunning a date replaces
that date's rows (dynamic partition overwrite) instead of adding to them."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar.operators.ordering import number_rows
from viewstar.session import list_names, path_exists, put_text, remove_path

ISO_TIMESTAMP = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: a silver table."""
    df.write.mode(mode).parquet(path)


def write_dated(df: DataFrame, path: str, dt: str, partition: str = "dt") -> None:
    """K2: replace only the ``dt`` partition of a KPI table; other dates stay."""
    (df.withColumn(partition, F.lit(dt).cast("date"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def write_json_batches(df: DataFrame, path: str, max_records: int = 1000) -> None:
    """K3: JSON lines, at most ``max_records`` rows per file, ISO times."""
    (df.write.mode("overwrite").option("maxRecordsPerFile", max_records)
     .option("timestampNTZFormat", ISO_TIMESTAMP).option("timestampFormat", ISO_TIMESTAMP)
     .option("ignoreNullFields", "false").json(path))


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, no index column; quotes inside fields are doubled."""
    (df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .csv(path))


def write_time_batches(df: DataFrame, path: str, time_col: str, batches: int = 5,
                       parts: int | None = None) -> None:
    """The rows cut into ``batches`` consecutive time ranges of near equal
    size, one folder each (``batch=0`` first), every file sorted by time.

    The rows are range-partitioned on (time, row id) into ``parts`` ranges
    (default: the session's shuffle partition count), and consecutive ranges
    are grouped into the batches, so each batch is written by many tasks, not
    one.  Within a batch, file part numbers follow time.  The row id breaks
    time ties, so rows of one hot time (the fill sentinel) can straddle a cut
    and the batches stay near equal, as the original's equal slices of the
    sorted rows were.
    """
    spark = df.sparkSession
    parts = max(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), batches)
    with_id = df.withColumn("_row", F.monotonically_increasing_id())
    ranged = with_id.repartitionByRange(parts, time_col, "_row")
    batch = F.floor(F.spark_partition_id() * F.lit(batches) / F.lit(parts)).cast("int")
    (ranged.withColumn("batch", batch).sortWithinPartitions("batch", time_col, "_row")
     .drop("_row").write.mode("overwrite").partitionBy("batch").json(path))


def write_jdbc(df: DataFrame, url: str, table: str, *, mode: str = "overwrite",
               batch_size: int = 1000, column_types: str | None = None,
               properties: dict[str, str] | None = None) -> None:
    """K4: load a relational table (drop + create on overwrite), batched inserts."""
    writer = (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
              .option("batchsize", batch_size))
    if column_types:
        writer = writer.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        writer = writer.option(k, v)
    writer.save()


# -- warehouse tables (K5-K8) ---------------------------------------------------
#: Folder of a table's loads; its name keeps it out of partition discovery.
LOADS = "_loads"
#: Marks a load that another one has replaced.
REPLACED = "_REPLACED"


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """K8: create the dataset if absent."""
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{where}")


def load_table(df: DataFrame, table: str, mode: str, path: str | None = None,
               partition_by: Sequence[str] = ()) -> None:
    """K5 (``overwrite`` = truncate) and K6 (``append``: a rerun adds rows again)."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(table)


def _columns_ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _make_table(spark: SparkSession, table: str, ddl: str) -> None:
    try:
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} {ddl}")
    except AnalysisException:  # another thread made it meanwhile
        if not spark.catalog.tableExists(table):
            raise


def _described(spark: SparkSession, table: str, partition: str = "") -> str:
    """Location of a table or of one of its partitions."""
    rows = spark.sql(f"DESCRIBE FORMATTED {table} {partition}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"].rstrip("/")


def _stage(df: DataFrame, root: str, group: str) -> str:
    """``df`` written whole to a folder no reader looks at yet; a failed write leaves nothing but that folder."""
    spark, folder = df.sparkSession, f"{root}/{LOADS}/{group}/{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    try:
        df.write.mode("errorifexists").parquet(folder)
    except BaseException:
        remove_path(spark, folder)
        raise
    return folder


def _retire(spark: SparkSession, root: str, group: str, before: str | None) -> None:
    """Drop a group's loads that were replaced earlier.  The one replaced just now is marked and stays until the
    next load, for readers still in it; loads never replaced (the current one, others under way) are not touched."""
    for name in list_names(spark, f"{root}/{LOADS}/{group}"):
        folder = f"{root}/{LOADS}/{group}/{name}"
        if path_exists(spark, f"{folder}/{REPLACED}"):
            remove_path(spark, folder)
    if before and f"/{LOADS}/" in before:
        put_text(spark, f"{before}/{REPLACED}", "")


def load_dated_table(spark: SparkSession, df: DataFrame, table: str, dt: str,
                     path: str | None = None, partition: str = "dt") -> None:
    """K7 made rerunnable: one table per KPI, partitioned by run date; a rerun
    of a date replaces that date only, whole or not at all.

    The date's rows are written to a folder of their own under ``_loads``;
    naming that folder to the catalog as the date's location is the commit.  A
    load that fails before it leaves the date as it was, readers never meet a
    date half written, and no session setting decides what is overwritten.
    Concurrent loads of other dates or tables do not touch each other; of two
    loads of one date the one that commits last stays.
    """
    if not spark.catalog.tableExists(table):
        where = f" LOCATION '{path}'" if path else ""
        _make_table(spark, table, f"({_columns_ddl(df)}, `{partition}` DATE) USING parquet PARTITIONED BY (`{partition}`){where}")
    columns = [c for c in spark.table(table).columns if c != partition]
    root, spec = _described(spark, table), f"PARTITION (`{partition}` = DATE'{dt}')"
    folder = _stage(df.select(*columns), root, dt)
    before = None
    if spark.sql(f"SHOW PARTITIONS {table} {spec}").isEmpty():
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
    else:
        before = _described(spark, table, spec)
        spark.sql(f"ALTER TABLE {table} {spec} SET LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    _retire(spark, root, dt, before)


def replace_table(spark: SparkSession, df: DataFrame, table: str, path: str | None = None) -> None:
    """K5 without a moment in which the table is empty: the rows are written beside, then the table's
    location moves to them.  Other columns than before make the table anew once its rows are written."""
    columns = _columns_ddl(df)
    if spark.catalog.tableExists(table):
        root = _described(spark, table)
        root = root.split(f"/{LOADS}/")[0]
    else:
        root = path or f"{_database_location(spark, table)}/{table.rsplit('.', 1)[-1].strip('`')}"
    folder = _stage(df, root, "all")
    before = None
    if spark.catalog.tableExists(table) and _columns_ddl(spark.table(table)) == columns:
        before = _described(spark, table)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet LOCATION '{folder}'")
    spark.catalog.refreshTable(table)
    _retire(spark, root, "all", before)


def _database_location(spark: SparkSession, table: str) -> str:
    database = table.rsplit(".", 1)[0] if "." in table else spark.catalog.currentDatabase()
    return spark.catalog.getDatabase(database.strip("`")).locationUri.rstrip("/")


# -- topic messages (K9) ------------------------------------------------------------
def topic_frame(df: DataFrame, order_by: Sequence[str], first_index: int = 0) -> DataFrame:
    """K9: ``key`` = running index as text, ``value`` = the row as JSON.

    Rows are sorted once, distributed (``number_rows``).  Equal rows give equal
    values, so which copy takes which index changes no message.
    """
    order = list(order_by) + [c for c in df.columns if c not in order_by]
    numbered = number_rows(df, [F.col(f"`{c}`").asc_nulls_last() for c in order], "_index", first_index)
    return numbered.select(
        F.col("_index").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "false"}).alias("value"))

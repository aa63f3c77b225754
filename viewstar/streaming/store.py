"""The de-duplicated stream's tables: folders per batch, merged now and then into sorted date files.

``rows/batch_id=N/event_date=D`` and ``hours/batch_id=N`` hold what batch N
wrote.  Once ``COMPACT_AFTER`` batches are closed they are merged into
``base/gen=G/event_date=D/bucket=B`` (one row per key, C9's, sorted by key)
and ``hour_base/gen=G`` (one row per hour), G being the last batch merged.
Only the dates those batches touched are written anew; for any other date the
manifest goes on naming the files it has.  A date is cut into buckets by the
hash of the key, as many as its rows need, so that a batch reads only the
buckets its keys fall in, also of a date that keeps growing (the date of
unreadable times).

``manifest/<G>.json`` names, per date, the generation and its number of
buckets.  It appears whole, last, and is the commit: a merge that fails is
done again under the same name by the next batch.  What a merge replaces is
removed by the merge after it, so readers have that long to finish.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from viewstar import schemas
from viewstar.session import get_text, list_names, path_exists, put_text, remove_path

#: Closed batches a merge waits for, and rows a bucket should hold.
COMPACT_AFTER, BUCKET_ROWS = 16, 2_000_000
#: Buckets a lookup names one by one; beyond, it reads the date's files whole.
NAMED_BUCKETS = 4096

Fold = Callable[[DataFrame], DataFrame]


@dataclass
class Manifest:
    """What is merged: batches up to ``upto``; per date its generation, buckets and rows; folders to remove next."""
    upto: int = -1
    dates: dict[str, dict[str, int]] = field(default_factory=dict)
    replaced: list[str] = field(default_factory=list)


def manifest(spark: SparkSession, out: str) -> Manifest:
    names = [n for n in list_names(spark, f"{out}/manifest") if n.endswith(".json")]
    return Manifest(**json.loads(get_text(spark, f"{out}/manifest/{names[-1]}"))) if names else Manifest()


def _bucket(keys: Sequence[str], buckets: Column | int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), buckets if isinstance(buckets, Column) else F.lit(buckets)).cast("int")


ROW_DDL = f"{schemas.SILVER_VIEWINGS_DDL}, event_date DATE"


def _batches(spark: SparkSession, out: str, table: str, above: int, below: int | None = None) -> list[int]:
    found = [int(n.removeprefix("batch_id=")) for n in list_names(spark, f"{out}/{table}") if n.startswith("batch_id=")]
    return sorted(b for b in found if b > above and (below is None or b < below))


def _read(spark: SparkSession, root: str, paths: Sequence[str], ddl: str, partitions: str = "") -> DataFrame:
    schema = f"{ddl}, {partitions}" if partitions else ddl
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*paths)


def open_rows(spark: SparkSession, out: str, held: Manifest, below: int | None = None) -> DataFrame:
    """Rows of the batches not merged yet."""
    paths = [f"{out}/rows/batch_id={b}" for b in _batches(spark, out, "rows", held.upto, below)]
    return _read(spark, f"{out}/rows", paths, ROW_DDL, "batch_id LONG").drop("batch_id")


def base_rows(spark: SparkSession, out: str, held: Manifest, dates: Sequence[str] | None = None,
              buckets: dict[str, Sequence[int]] | None = None) -> DataFrame:
    """Merged rows, all or of some dates, of all buckets or of some (per date)."""
    paths = []
    for date in held.dates if dates is None else [d for d in dates if d in held.dates]:
        folder = f"{out}/base/gen={held.dates[date]['gen']}/event_date={date}"
        if buckets is None or date not in buckets:
            paths.append(folder)
        else:
            there = {f"{folder}/bucket={b}" for b in buckets[date]}
            paths += sorted(there & {f"{folder}/{n}" for n in list_names(spark, folder)})
    return _read(spark, f"{out}/base", paths, ROW_DDL, "gen LONG, bucket INT").drop("gen", "bucket")


def rows(spark: SparkSession, out: str) -> DataFrame:
    """Every row held; a key may have one in the base and some in open batches."""
    if not (path_exists(spark, f"{out}/rows") or path_exists(spark, f"{out}/manifest")):
        raise FileNotFoundError(f"no stream output in {out}")
    held = manifest(spark, out)
    return base_rows(spark, out, held).unionByName(open_rows(spark, out, held))


def earlier_rows(spark: SparkSession, out: str, fresh: DataFrame, keys: Sequence[str], batch_id: int,
                 held: Manifest | None = None) -> DataFrame:
    """Rows that earlier batches kept and that may share a key with ``fresh`` (keys, event_date).

    Reads at most COMPACT_AFTER open batch folders, and of the base the
    buckets that the batch's keys fall in: at most one per key and at most
    what its dates have, however many batches came before.
    """
    held = held or manifest(spark, out)
    dates = [str(r[0]) for r in fresh.select("event_date").distinct().collect()]  # a batch's messages lie close together
    named = {}
    several = {d: held.dates[d]["buckets"] for d in dates if d in held.dates and held.dates[d]["buckets"] > 1}
    if several and sum(several.values()) <= NAMED_BUCKETS:  # so many rows reach the driver at most
        count = F.coalesce(*[F.when(F.col("event_date") == F.lit(d).cast("date"), F.lit(n)) for d, n in several.items()])
        hit = fresh.select("event_date", _bucket(keys, count).alias("bucket")).where("bucket IS NOT NULL").distinct().collect()
        named = {d: [r["bucket"] for r in hit if str(r["event_date"]) == d] for d in several}
    base = base_rows(spark, out, held, dates, named)
    late = open_rows(spark, out, held, batch_id).where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))
    return base.unionByName(late)


HOUR_DDL = ", ".join([*(f"{k} INT" for k in schemas.CALENDAR_HOUR_KEYS), "views LONG, wishlists LONG, contacts LONG"])


def hours(spark: SparkSession, out: str, below: int | None = None) -> DataFrame:
    """Changes of the hours' totals, merged and open."""
    held = manifest(spark, out)
    open_ = [f"{out}/hours/batch_id={b}" for b in _batches(spark, out, "hours", held.upto, below)]
    base = [f"{out}/hour_base/gen={held.upto}"] if held.upto >= 0 else []
    return _read(spark, f"{out}/hours", open_, HOUR_DDL, "batch_id LONG").drop("batch_id").unionByName(
        _read(spark, f"{out}/hour_base", base, HOUR_DDL, "gen LONG").drop("gen"))


def compact(spark: SparkSession, out: str, batch_id: int, keys: Sequence[str], fold: Fold,
            after: int = COMPACT_AFTER, bucket_rows: int = BUCKET_ROWS) -> Manifest:
    """Merge the batches below ``batch_id`` if ``after`` of them wait.  ``fold`` keeps one row per key.

    Called as batch ``batch_id`` begins: every batch below it is closed then.
    """
    held = manifest(spark, out)
    waiting = _batches(spark, out, "rows", held.upto, batch_id)
    if len(waiting) < after:
        return held
    gen = waiting[-1]
    fresh = open_rows(spark, out, held, gen + 1)
    counts = {str(r["event_date"]): r["n"] for r in fresh.groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    sizes = {d: n + held.dates.get(d, {"rows": 0})["rows"] for d, n in counts.items()}
    buckets = {d: max(-(-n // bucket_rows), held.dates.get(d, {"buckets": 1})["buckets"]) for d, n in sizes.items()}
    merged = fold(base_rows(spark, out, held, list(counts)).unionByName(fresh))
    several = [F.when(F.col("event_date") == F.lit(d).cast("date"), F.lit(n)) for d, n in buckets.items() if n > 1]
    merged = merged.withColumn("bucket", _bucket(keys, F.coalesce(*several, F.lit(1))))
    remove_path(spark, f"{out}/base/gen={gen}")
    (merged.repartition("event_date", "bucket").sortWithinPartitions("event_date", "bucket", *keys)
     .write.partitionBy("event_date", "bucket").parquet(f"{out}/base/gen={gen}"))
    kept = {str(r["event_date"]): r["n"] for r in _read(
        spark, f"{out}/base", [f"{out}/base/gen={gen}"], ROW_DDL, "gen LONG, bucket INT")
        .groupBy("event_date").agg(F.count(F.lit(1)).alias("n")).collect()}
    totals = hours(spark, out, gen + 1).groupBy(*schemas.CALENDAR_HOUR_KEYS).agg(
        *[F.sum(m).alias(m) for m in ("views", "wishlists", "contacts")])
    remove_path(spark, f"{out}/hour_base/gen={gen}")
    totals.coalesce(1).write.parquet(f"{out}/hour_base/gen={gen}")  # one row per calendar hour

    replaced = [f"rows/batch_id={b}" for b in waiting] + [f"hours/batch_id={b}" for b in waiting] \
        + [f"base/gen={held.dates[d]['gen']}/event_date={d}" for d in counts if d in held.dates] \
        + ([f"hour_base/gen={held.upto}"] if held.upto >= 0 else [])
    dates = held.dates | {d: {"gen": gen, "buckets": buckets[d], "rows": kept[d]} for d in kept}
    new = Manifest(gen, dates, replaced)
    put_text(spark, f"{out}/manifest/{gen:020d}.json", json.dumps(new.__dict__))
    for folder in held.replaced:
        remove_path(spark, f"{out}/{folder}")
    for name in list_names(spark, f"{out}/manifest"):
        if name.endswith(".json") and int(name.removesuffix(".json")) < held.upto:
            remove_path(spark, f"{out}/manifest/{name}")
    return new

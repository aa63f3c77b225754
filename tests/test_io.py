"""Sources and sinks: batching, partition pruning, dated overwrite, topic keys."""

import glob
import json

from pyspark.sql import functions as F

from conftest import SF_TINY
from viewstar import schemas, scratch_path
from viewstar.sinks import writers as w
from viewstar.sources import fixtures as fx
from viewstar.sources import readers as rd


def test_json_batches_hold_at_most_max_records(spark):
    path = scratch_path(spark, "t_batches")
    w.write_json_batches(fx.raw_apartments(spark, SF_TINY).repartition(1), path, max_records=50)
    files = glob.glob(path.removeprefix("file:") + "/part-*.json")
    sizes = [sum(1 for _ in open(f)) for f in files]
    assert max(sizes) <= 50 and sum(sizes) == fx.raw_apartments(spark, SF_TINY).count()
    keys = {k for f in files for line in open(f) for k in json.loads(line)}
    assert all(set(json.loads(line)) == keys for f in files for line in open(f))  # nulls kept
    assert len(keys) == 8


def test_date_scan_prunes_folders(spark):
    path = scratch_path(spark, "t_landing")
    raw = fx.raw_viewings(spark, SF_TINY)
    raw.withColumn("dt", F.lit("2025-06-28").cast("date")).write.partitionBy("dt").json(path)
    raw.withColumn("dt", F.lit("2025-06-29").cast("date")).write.mode("append").partitionBy("dt").json(path)
    one = rd.read_viewings_for_date(spark, path, "2025-06-28")
    assert "PartitionFilters: [isnotnull(dt" in one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == raw.count() and one.columns[-1] == "dt"


def test_dated_write_replaces_only_its_date(spark):
    path = scratch_path(spark, "t_dated")
    df = spark.range(3)
    w.write_dated(df, path, "2025-06-27")
    w.write_dated(df, path, "2025-06-28")
    w.write_dated(spark.range(5), path, "2025-06-28")
    counts = {str(r["dt"]): r["count"] for r in spark.read.parquet(path).groupBy("dt").count().collect()}
    assert counts == {"2025-06-27": 3, "2025-06-28": 5}


def test_topic_keys_are_a_running_index(spark):
    raw = fx.raw_viewings(spark, SF_TINY)
    msgs = w.topic_frame(raw.repartition(4), ["viewed_at"], first_index=4999)
    keys = sorted(int(r["key"]) for r in msgs.collect())
    assert keys == list(range(4999, 4999 + raw.count()))
    first = msgs.filter("key = '4999'").first()["value"]
    smallest = raw.orderBy(F.col("viewed_at").asc_nulls_first(), "user_id", "apartment_id",
                           "is_wishlisted", "call_to_action").first()
    assert json.loads(first)["viewed_at"] == smallest["viewed_at"]


def test_csv_reader_turns_nan_to_null(spark):
    path = scratch_path(spark, "t_csv")
    spark.createDataFrame([("1", float("nan"))], "id string, bathrooms double").write.option("header", True).csv(path)
    row = rd.read_csv(spark, path, "id STRING, bathrooms DOUBLE").first()
    assert row["bathrooms"] is None


def test_time_batches_are_sorted_ranges(spark):
    path = scratch_path(spark, "t_time_batches")
    parsed = fx.large_viewings(spark, SF_TINY)
    w.write_time_batches(parsed, path, "viewed_at", batches=5, parts=20)
    root = path.removeprefix("file:")
    spans, sizes = [], []
    for b in range(5):
        files = sorted(glob.glob(f"{root}/batch={b}/part-*.json"))
        assert len(files) > 1                          # a batch is written by many tasks
        times = []
        for f in files:
            chunk = [json.loads(line)["viewed_at"] for line in open(f)]
            assert chunk == sorted(chunk)
            times += chunk
        assert times == sorted(times)                  # part numbers follow time
        spans.append((times[0], times[-1]))
        sizes.append(len(times))
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    assert max(sizes) < 2 * min(sizes)
    assert sum(sizes) == parsed.count()
    assert rd.read_json(spark, path, schemas.VIEWINGS_DDL).count() == parsed.count()

"""Stream jobs on hand-made message files, batch by batch."""

import glob
import json

import pytest

from viewstar import scratch_path
from viewstar.operators import quality as qa
from viewstar.streaming import jobs

COLUMNS = ["user_id", "apartment_id", "viewed_at", "is_wishlisted", "call_to_action"]


def _write_batch(spark, folder, rows, n):
    lines = [json.dumps(dict(zip(COLUMNS, r))) for r in rows]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("append").text(f"{folder}/b{n}")


BATCHES = [
    [("1", "a", "bad", "n", "reported"), ("2", "b", "bad", "y", "shortlisted"),
     ("3", "c", "2024-06-01 15:00:00", "y", "contact_agent"), ("3", "c", "2024-06-01 15:00:00", "y", "contact_agent")],
    [("1", "a", "bad", "n", "contact_agent"), ("2", "b", "nope", "y", "reported"),
     ("3", "c", "2024-06-01 15:00:00", "n", "reported"), ("4", "d", "2024-05-01 09:00:00", None, None)],
    [("4", "d", "01-05-2024 09:00:00", "y", "contact_agent"), ("5", "e", "2024-06-01 15:30:00", "y", "contact_agent"),
     ("3", "c", "2024-06-01 15:00:00", "y", "reported")],
]


def _replay(spark, out):
    src = scratch_path(spark, "t_msgs")
    for n, rows in enumerate(BATCHES):
        _write_batch(spark, src, rows, n)
        jobs.dedup_stream(spark, jobs.viewing_stream(spark, f"{src}/b*", max_files_per_trigger=1), out, f"{out}_ckpt")
    return spark.createDataFrame([r for b in BATCHES for r in b], ", ".join(f"{c} string" for c in COLUMNS))


def test_stream_equals_batch_with_late_and_replaced_rows(spark):
    """Late rows count, a later row that comes first in C9's order replaces the kept one, hours follow."""
    out = scratch_path(spark, "t_dedup")
    raw = _replay(spark, out)
    clean = qa.clean_viewings(raw, drop_all_null=False)
    got = jobs.read_deduped(spark, out)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, clean.select(*got.columns).collect()), key=str)
    hours = {(r.view_year, r.view_month, r.view_day, r.view_hour): (r.total_views, r.total_wishlists, r.total_contact_agent)
             for r in jobs.read_hour_engagement(spark, out).collect()}
    assert hours == {(9999, 12, 31, 23): (2, 1, 1), (2024, 6, 1, 15): (2, 1, 1), (2024, 5, 1, 9): (1, 1, 1)}


def test_damaged_output_raises(spark):
    out = scratch_path(spark, "t_damaged")
    _replay(spark, out)
    root = out.removeprefix("file:")
    files = glob.glob(f"{root}/rows/batch_id=*/event_date=9999-12-31/part-*.parquet")
    assert files
    with open(files[0], "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(Exception):
        jobs.read_deduped(spark, out).collect()
    with pytest.raises(Exception):
        jobs.read_deduped(spark, scratch_path(spark, "t_never_written")).collect()


def test_arrival_date_landing_loses_nothing(spark):
    from viewstar.sources import readers as rd
    src, landing = scratch_path(spark, "t_src"), scratch_path(spark, "t_land")
    for n, dt in enumerate(("2025-06-27", "2025-06-28")):
        _write_batch(spark, f"{src}/{dt}", BATCHES[n], n)
        jobs.land_by_date(jobs.viewing_stream(spark, f"{src}/*/b*"), landing, f"{landing}_ckpt", arrival_date=dt)
    counts = [rd.read_viewings_for_date(spark, landing, dt).count() for dt in ("2025-06-27", "2025-06-28")]
    assert counts == [len(BATCHES[0]), len(BATCHES[1])]
    assert rd.read_viewings_for_date(spark, landing).count() == sum(counts)


def test_files_read_per_batch_stay_flat(spark, monkeypatch, batches=40):
    """Many small batches, keys repeated and replaced, a date that keeps growing: lookups read a bounded number of
    files, folders do not pile up, and rows and hours equal the batch job's."""
    import random

    from pyspark.sql import functions as F
    from viewstar.session import list_names
    from viewstar.streaming import store
    rnd, out, read = random.Random(4), scratch_path(spark, "t_compact"), []
    monkeypatch.setattr(jobs.store, "earlier_rows", _counting(store.earlier_rows, read))
    spark.conf.set("spark.sql.shuffle.partitions", "1")  # four rows a batch
    write = jobs.batch_writer(spark, out, compact_after=8, bucket_rows=25)
    raw = []
    for n in range(batches):
        batch = [(str(rnd.randrange(6)), rnd.choice("ab"), rnd.choice([f"2024-06-01 {rnd.randrange(24):02d}:00:00", "bad",
                  f"2024-06-{1 + n // 10:02d} 10:00:00"]), rnd.choice("yn"), rnd.choice(["contact_agent", "reported"]))
                 for _ in range(3)] + [(f"u{n}", "a", "bad", "y", "reported")]
        raw += batch
        df = spark.createDataFrame(batch, ", ".join(f"{c} string" for c in COLUMNS)).coalesce(1)
        write(jobs.clean_stream(df), n)
    assert max(read[batches // 2:]) <= max(read[:batches // 2]) + 4 and max(read) <= 40
    assert len(list_names(spark, f"{out}/rows")) <= 18 and len(list_names(spark, f"{out}/hours")) <= 18
    held = store.manifest(spark, out)
    assert held.upto >= batches - 10 and held.dates["9999-12-31"]["buckets"] > 1
    clean = qa.clean_viewings(spark.createDataFrame(raw, ", ".join(f"{c} string" for c in COLUMNS)), drop_all_null=False)
    got = jobs.read_deduped(spark, out)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, clean.select(*got.columns).collect()), key=str)
    hours = {tuple(r)[:4]: r.total_views for r in jobs.read_hour_engagement(spark, out).collect() if r.total_views}
    from viewstar.functions.calendar import time_parts
    from viewstar import schemas
    plain = clean.withColumns(time_parts(F.col("viewed_at"))).groupBy(*schemas.CALENDAR_HOUR_KEYS).count().collect()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert hours == {tuple(r)[:4]: r["count"] for r in plain}


def _counting(lookup, read):
    def counted(*args, **options):
        df = lookup(*args, **options)
        read.append(len(df.inputFiles()))
        return df
    return counted


def test_a_merge_that_failed_is_done_again(spark, monkeypatch):
    from viewstar.streaming import store
    out = scratch_path(spark, "t_merge")
    write = jobs.batch_writer(spark, out, compact_after=2)
    rows = [tuple(r) for b in BATCHES for r in b]
    schema = ", ".join(f"{c} string" for c in COLUMNS)

    def batch(n):
        write(jobs.clean_stream(spark.createDataFrame(BATCHES[n % 3], schema)), n)
    batch(0)
    batch(1)
    real = store.put_text
    monkeypatch.setattr(store, "put_text", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        batch(2)  # the merged files are written, the manifest is not
    monkeypatch.setattr(store, "put_text", real)
    assert store.manifest(spark, out).upto == -1
    batch(2)
    assert store.manifest(spark, out).upto == 1
    for n in range(3, 9):
        batch(n)
        batch(n)  # a batch done twice replaces itself
    clean = qa.clean_viewings(spark.createDataFrame(rows, schema), drop_all_null=False)
    got = jobs.read_deduped(spark, out)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, clean.select(*got.columns).collect()), key=str)
    assert sum(r.total_views for r in jobs.read_hour_engagement(spark, out).collect()) == clean.count()


def test_malformed_lines_land_apart_and_every_line_lands(spark):
    src, landing = scratch_path(spark, "t_lines"), scratch_path(spark, "t_lines_landed")
    lines = ['{"user_id": "1", "apartment_id": "a", "viewed_at": "2024-06-01 15:00:00"}', '{"user_id": "1", "apar', "", "[]",
             "null", "{}", '{"other": 1}', '{"user_id": 5}', '[{"user_id": "6"}, 3]', "text", '{"user_id": "7"} trailing']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{src}/b0")
    for _ in range(2):  # the second run has nothing new
        jobs.land_lines(spark, f"{src}/b*", landing, f"{landing}_ckpt", "2025-06-27")
    bad = [r.line for r in jobs.read_landed(spark, landing, jobs.MALFORMED).collect()]
    good = [r.user_id for r in jobs.read_landed(spark, landing, jobs.VIEWING, "2025-06-27").collect()]
    assert len(bad) + len(good) == len(lines) and "1" in good and "5" in good
    assert {'{"user_id": "1", "apar', "text", "{}", '{"other": 1}', "null"} <= set(bad)
    assert jobs.read_landed(spark, landing, dt="2025-06-28").count() == 0


def test_hour_windows_with_late_unreadable_and_future_times(spark):
    """Late rows go beside and count; state drops nothing; a rerun of a batch changes nothing."""
    from pyspark.sql import functions as F
    from viewstar.functions.calendar import time_parts
    from viewstar import schemas
    from viewstar.session import list_names, path_exists
    from viewstar.streaming import windows
    src, out = scratch_path(spark, "t_win_src"), scratch_path(spark, "t_win")
    batches = [BATCHES[2], BATCHES[0], [("1", "a", "2024-06-01 20:10:00", "y", "contact_agent"), ("1", "a", "2024-06-01 13:10:00", "n", "x")],
               [("2", "a", "2024-06-01 18:30:00", "y", "x"), ("2", "b", "2024-06-01 17:59:00", "y", "x")],
               [("3", "a", "2031-01-01 00:00:00", "y", "x")], BATCHES[1]]
    for n, rows in enumerate(batches):
        _write_batch(spark, src, rows, n)
        windows.split_by_lateness(spark, jobs.viewing_stream(spark, f"{src}/b*"), out, f"{out}_ckpt/split")
        windows.count_windows(spark, out, f"{out}_ckpt/windows")
    raw = spark.createDataFrame([r for b in batches for r in b], ", ".join(f"{c} string" for c in COLUMNS))
    clean = qa.fill_nulls(qa.to_boolean(qa.normalise_timestamps(raw, ["viewed_at"]), ["is_wishlisted"]))
    from viewstar.operators.engagement import row_triple
    plain = clean.withColumns(time_parts(F.col("viewed_at"))).groupBy(*schemas.CALENDAR_HOUR_KEYS).agg(*row_triple())
    got = windows.read_hour_windows(spark, out)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.select(*got.columns).collect()))
    assert path_exists(spark, f"{out}/late_rows") and len(list_names(spark, f"{out}/windows")) == 2

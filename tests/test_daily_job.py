"""The dated job: outputs, reruns and a second date."""

from conftest import SF_TINY
from viewstar import scratch_path
from viewstar.plans import daily_job
from viewstar.sources import fixtures as fx


def run(spark, silver, dt):
    return daily_job.run(spark, fx.raw_viewings(spark, SF_TINY), fx.raw_apartments(spark, SF_TINY),
                         fx.raw_attributes(spark, SF_TINY), silver, dt)


def test_rerun_replaces_and_dates_accumulate(spark):
    silver = scratch_path(spark, "t_silver")
    out = run(spark, silver, "2025-06-27")
    fact_rows = spark.read.parquet(out["user_viewings_cleaned"]).count()
    run(spark, silver, "2025-06-28")
    run(spark, silver, "2025-06-28")
    fact = spark.read.parquet(out["user_viewings_cleaned"])
    assert fact.count() == 2 * fact_rows
    hours = spark.read.parquet(out["kpi_hour_summary"])
    assert hours.groupBy("dt").count().collect()[0]["count"] == 24
    assert hours.count() == 48
    full = spark.read.parquet(out["viewings_full_detail"])
    assert full.filter("dt = DATE'2025-06-28'").count() == fact_rows
    assert full.where("amenities IS NOT NULL").count() == 0 and "is_weekend" in full.columns


def test_unbroadcast_listing_gives_same_tables(spark):
    opts = daily_job.JobOptions(max_broadcast_bytes=0)  # force shuffle joins, salted full detail
    a = run(spark, scratch_path(spark, "t_silver_b"), "2025-06-28")
    b = daily_job.run(spark, fx.raw_viewings(spark, SF_TINY), fx.raw_apartments(spark, SF_TINY),
                      fx.raw_attributes(spark, SF_TINY), scratch_path(spark, "t_silver_s"), "2025-06-28", opts)
    for name in ("viewings_full_detail", "kpi_hour_summary", "kpi_platform", "kpi_state"):
        x, y = spark.read.parquet(a[name]), spark.read.parquet(b[name])
        assert x.columns == y.columns
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_run_all_finishes_every_step_then_raises():
    import threading

    import pytest
    done, lock = [], threading.Lock()

    def ok(i):
        def step():
            with lock:
                done.append(i)
        return step

    def bad():
        raise RuntimeError("write failed")

    steps = {"a": ok(1), "b": bad, "c": ok(2), "d": ok(3)}
    for workers in (1, 3):
        done.clear()
        with pytest.raises(RuntimeError, match="write failed"):
            daily_job.run_all(steps, workers)
        assert sorted(done) == [1, 2, 3]


def test_all_null_date_breaks_nothing(spark):
    """A date whose flag is null throughout, beside a good one: both run, columns stay readable."""
    from pyspark.sql import functions as F
    from viewstar import schemas
    from viewstar.sources import readers as rd
    silver = scratch_path(spark, "t_silver_nulls")
    raw, apartments, attributes = (fx.raw_viewings(spark, SF_TINY), fx.raw_apartments(spark, SF_TINY),
                                   fx.raw_attributes(spark, SF_TINY))
    opts = daily_job.JobOptions(kpis=["hour_summary"])
    daily_job.run(spark, raw.withColumn("is_wishlisted", F.lit(None).cast("string")), apartments, attributes, silver,
                  "2025-06-27", opts)
    out = daily_job.run(spark, raw, apartments, attributes.withColumn("amenities", F.lit("Pool")), silver, "2025-06-28", opts)
    fact = rd.read_silver(spark, out["user_viewings_cleaned"], schemas.SILVER_VIEWINGS_DDL)
    wished = {str(r.dt): r.n for r in fact.groupBy("dt").agg(F.count("is_wishlisted").alias("n")).collect()}
    assert wished["2025-06-27"] == 0 < wished["2025-06-28"]
    full = rd.read_silver(spark, out["viewings_full_detail"], schemas.FULL_DETAIL_DDL)
    pools = {str(r.dt): r.n for r in full.groupBy("dt").agg(F.count("amenities").alias("n")).collect()}
    assert pools["2025-06-27"] == 0 < pools["2025-06-28"]
    assert rd.read_parquet(spark, out["kpi_hour_summary"]).select("dt").distinct().count() == 2


def test_key_column_is_never_dropped(spark):
    from viewstar.operators import quality as qa
    df = spark.createDataFrame([(None, "a", "2024-01-01 00:00:00", None, None)] * 2,
                               "user_id string, apartment_id string, viewed_at string, is_wishlisted string, call_to_action string")
    assert [tuple(r)[0] for r in qa.clean_viewings(df).collect()] == ["Unknown"]


def test_scratch_is_gone_after_the_run(spark, monkeypatch):
    import os

    import pytest
    from viewstar.session import checkpoint_base
    root = os.path.join(checkpoint_base(spark).removeprefix("file:"), "viewstar")
    before = {d for d in os.listdir(root) if d.startswith("daily_job")} if os.path.isdir(root) else set()
    run(spark, scratch_path(spark, "t_silver_clean"), "2025-06-28")
    monkeypatch.setitem(daily_job.kpis.KPIS, "hour_summary", lambda cube: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, scratch_path(spark, "t_silver_failed"), "2025-06-28")
    assert {d for d in os.listdir(root) if d.startswith("daily_job")} == before


def test_private_scratch_only_for_local_masters(spark, monkeypatch):
    import pytest
    from viewstar import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_base(Session())


def test_undated_run_and_entry_point(spark):
    from viewstar.sinks import writers as w
    from viewstar.plans import job_queries as jq
    landing, silver = scratch_path(spark, "t_land"), scratch_path(spark, "t_silver_main")
    w.write_json_batches(fx.raw_apartments(spark, SF_TINY), f"{landing}/apartments")
    w.write_json_batches(fx.raw_attributes(spark, SF_TINY), f"{landing}/apartment_attributes")
    for k, dt in enumerate(jq.DATES):
        jq.of_date(fx.raw_viewings(spark, SF_TINY), k).write.json(f"{landing}/user_viewings/dt={dt}")
    daily_job.main(["--landing", landing, "--silver", silver])
    hours = spark.read.parquet(f"{silver}/kpi_hour_summary")
    assert hours.count() == 24 and "dt" not in hours.columns
    daily_job.main(["--landing", landing, "--silver", f"{silver}_dated", "--dt", jq.DATES[1]])
    assert spark.read.parquet(f"{silver}_dated/kpi_hour_summary").columns[-1] == "dt"


def test_concurrent_dated_loads_keep_every_date(spark):
    """Threads loading dates of one table in a session whose overwrite mode is static."""
    import uuid
    from concurrent.futures import ThreadPoolExecutor

    from viewstar.sinks import writers as w
    prior = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        database = f"viewstar_{uuid.uuid4().hex[:8]}"
        w.create_database(spark, database, scratch_path(spark, "t_wh"))
        table = f"{database}.kpi"
        dates = [f"2025-06-{d:02d}" for d in range(1, 9)]
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda i: w.load_dated_table(spark, spark.range(i + 1), table, dates[i]), range(8)))
        w.load_dated_table(spark, spark.range(3), table, dates[0])
        counts = {str(r["dt"]): r["count"] for r in spark.table(table).groupBy("dt").count().collect()}
        assert counts == {d: i + 1 if i else 3 for i, d in enumerate(dates)}
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prior)
